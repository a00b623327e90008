"""Every builder's output against its declared schema and the reference's column counts."""

import pytest

from tidewater.plans.queries import AS_OF, sources
from tidewater.plans.registry import BUILDERS, COLUMNS
from tidewater.schemas import OUTPUTS
from tidewater.sources.catalog import ERP_TABLES, Sources
from tidewater.sources.inputs import INPUTS, checked

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return sources(spark, SF)


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_builder_schema(t, name):
    schema = BUILDERS[name](t, AS_OF).schema
    assert schema.simpleString() == "".join(OUTPUTS[name])
    assert len(schema.fields) == COLUMNS[name]


def test_nested_field_counts(t):
    lines = BUILDERS["po_lines_nested"](t, AS_OF).schema["po_lines"].dataType.elementType
    assert len(lines.fields) == 60
    doc = BUILDERS["purchase_order_nested"](t, AS_OF).schema["purchase_oder"].dataType
    assert len(doc.fields) == 33  # 27 scalars, 5 structs, the line array
    contacts = BUILDERS["vendor_contacts_nested"](t, AS_OF).schema["contacts"].dataType.elementType
    assert len(contacts.fields) == 30


def test_inputs_are_declared_and_checked(t, spark):
    assert set(INPUTS) == set(t) == set(ERP_TABLES)
    for name in t:
        checked(t[name], name)
    with pytest.raises(ValueError, match="currency_id is missing"):
        checked(t["transactions"].drop("currency_id"), "transactions")
    with pytest.raises(ValueError, match="trandate is string"):
        checked(t["transactions"].withColumn("trandate", t["transactions"]["trandate"].cast("string")), "transactions")


def test_catalog_tables_as_sources(t, spark):
    t["season"].write.mode("overwrite").saveAsTable("default.season")
    try:
        for database in ("default", "spark_catalog.default"):  # S1 and S2
            assert Sources.from_catalog(spark, database)["season"].count() == t["season"].count()
    finally:
        spark.sql("DROP TABLE default.season")
