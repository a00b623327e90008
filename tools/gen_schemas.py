"""Write tidewater/schemas.py: the declared output schema (DDL text) of every
builder, read from the Spark plans (schemas only, no data is read)."""

import sys

sys.path.insert(0, ".")
from tidewater.plans.queries import AS_OF, sources  # noqa: E402
from tidewater.plans.registry import BUILDERS  # noqa: E402
from tidewater.session import local_session  # noqa: E402

spark = local_session(2)
t = sources(spark, "/root/testdata/sf0.001")
out = {name: b(t, AS_OF).schema.simpleString() for name, b in BUILDERS.items()}
with open("tidewater/schemas.py", "w") as fh:
    fh.write('"""Declared output schemas of the 15 builders (generated by tools/gen_schemas.py,\n'
             'checked by tests/test_schemas.py): column names, order, types and nested fields."""\n\n')
    fh.write("OUTPUTS = {\n")
    for k, v in out.items():
        fh.write(f"    {k!r}: (\n")
        for i in range(0, len(v), 100):
            fh.write(f"        {v[i:i + 100]!r}\n")
        fh.write("    ),\n")
    fh.write("}\n")
print("ok", len(out))
