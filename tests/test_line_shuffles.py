"""What a PO line is shuffled for, and keys that repeat on the way."""

import re

import pytest

from tidewater.plans import compliance
from tidewater.plans.queries import AS_OF, sources

PO = dict(transaction_id=1, tranid="PO1", transaction_type="Purchase Order")


@pytest.fixture
def planned_once(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_lines_are_grouped_and_nested_after_one_shuffle_on_the_po_number(spark, planned_once):
    df = compliance.po_lines_nested(sources(spark, "/root/testdata/sf0.001"), AS_OF)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    top = lines[: next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)]
    dealt = [x for x in top if re.search(r"Exchange (hash|range)partitioning", x)]
    assert len(dealt) == 1 and "hashpartitioning(po_number" in dealt[0]
    # the wide lines meet narrow rows by all their keys at once
    join = next(x for x in lines if "SortMergeJoin" in x)
    assert all(x in join for x in ("transaction_id", "item_id", "transaction_line_id"))


def test_repeated_and_missing_keys_give_the_rows_of_the_joins(tables):
    line = dict(transaction_id=1, brand_id=1, product_group_id=1, item_count=10.0, item_unit_price="2.0", amount=20.0)
    t = tables(
        # one number on two POs; an item twice; a line twice; a line without an item, one without a PO
        transactions=[PO, dict(PO, transaction_id=2)],
        transaction_lines=[dict(line, transaction_line_id=1, item_id=1), dict(line, transaction_line_id=1, item_id=1),
                           dict(line, transaction_line_id=2), dict(line, transaction_id=2, transaction_line_id=2),
                           dict(line, transaction_id=None, transaction_line_id=3, item_id=1)],
        items_cv=[dict(item_id=1, item_extid="S1"), dict(item_id=1, item_extid="S2"), dict(item_id=None, item_extid="S3")],
        brand=[dict(brand_id=1, brand_name="B")], product_group=[dict(product_group_id=1, product_group_name="G")],
        sb_receipts=[dict(po_number="PO1", received_sku="S1", RECORD_SOURCE=x, po_purchase_order_item_id=1, received_quantity=2.0) for x in ("A", "B")],
    )
    (row,) = compliance.po_lines_nested(t, AS_OF).collect()
    got = sorted((x.item_extid or "", x.transaction_line_id, x.on_order_quantity) for x in row.po_lines)
    # Two lines, each once a record source less 4; S2: two lines; no item: one line of each PO, in one group
    assert got == [("", 2, 20.0), ("S1", 1, 32.0), ("S2", 1, 20.0)]
    assert row.total_on_order_quantity == 10.0 + (10.0 - 8.0) + 10.0
