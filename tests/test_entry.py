"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as entry_mod
from tidewater.plans.queries import QUERIES
from tidewater.schemas import OUTPUTS


def test_entry_is_the_flagship_with_its_declared_schema(spark):
    df = entry_mod.entry(spark)
    assert df.schema.simpleString() == "".join(OUTPUTS["asn_details"])
    assert df.count() > 0


def test_queries_and_oracles_line_up():
    qs, sql = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(sql) <= set(qs) and set(QUERIES) <= set(sql)
    assert all(s.lstrip().upper().startswith("WITH") for s in sql.values())
