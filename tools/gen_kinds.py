"""Write tidewater/plans/kinds.py: the output columns and value kinds of every
registered query, read from the Spark plans (no data is read: schemas only).
The oracle SQL is wrapped with the same conversions (``oracle.sql``)."""

import pprint
import sys

sys.path.insert(0, ".")
from tidewater.plans.queries import QUERIES, kind_of  # noqa: E402
from tidewater.session import local_session  # noqa: E402

spark = local_session(2)
kinds = {}
for name, fn in QUERIES.items():
    df = fn(spark, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001")
    kinds[name] = [(f.name, kind_of(f.dataType)) for f in df.schema.fields]
with open("tidewater/plans/kinds.py", "w") as fh:
    fh.write('"""Output columns and value kinds of the registered queries (generated by\n'
             'tools/gen_kinds.py; s text, i integer, d double, b boolean, t timestamp, D date)."""\n\n')
    fh.write("KINDS = " + pprint.pformat(kinds, width=110, compact=True) + "\n")
print("ok", len(kinds))
