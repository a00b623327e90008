"""Property tests: lookups keep row counts on unique keys, nest
then explode gives back the children, J08 totals equal the sums over its own
array when every line has at most one receipt source."""

from collections import Counter
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import ops
from tidewater.plans import compliance

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=0, max_size=12)


@SETTINGS
@given(left=keys, dim_keys=st.sets(st.integers(0, 6)))
def test_lookup_keeps_row_count_on_unique_key(spark, left, dim_keys):
    df = spark.createDataFrame([(k,) for k in left], "k long")
    dim = spark.createDataFrame([(k, f"v{k}") for k in sorted(dim_keys)], "id long, v string")
    out = ops.lookup(df, dim, F.col("k"), "id", {"v": "v"}).collect()
    assert len(out) == len(left)
    assert all(r.v == (f"v{r.k}" if r.k in dim_keys else None) for r in out)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.text("ab", max_size=2))), max_size=12))
def test_nest_then_explode_gives_back_children(spark, rows):
    df = spark.createDataFrame(rows, "p int, v string")
    nested = ops.nest(df, ["p"], [F.col("v")], "arr")
    back = nested.select("p", F.explode("arr").alias("e")).select("p", "e.v").collect()
    assert Counter((r.p, r.v) for r in back) == Counter(rows)


@SETTINGS
@given(lines=st.lists(st.tuples(st.floats(0, 50, allow_nan=False).map(lambda x: round(x, 1)),
                                st.one_of(st.none(), st.floats(0, 20, allow_nan=False).map(lambda x: round(x, 1)))),
                      min_size=1, max_size=5))
def test_j08_totals_are_sums_of_the_array_with_one_source(tables, lines):
    tx = [dict(transaction_id=1, tranid="P", transaction_type="Purchase Order")]
    tl, items, rec = [], [], []
    for i, (qty, received) in enumerate(lines, start=1):
        tl.append(dict(transaction_id=1, transaction_line_id=i, item_id=i, brand_id=1, product_group_id=1,
                       item_count=qty, item_unit_price="2.0", amount=qty))
        items.append(dict(item_id=i, item_extid=f"S{i}"))
        if received is not None:
            rec.append(dict(po_number="P", received_sku=f"S{i}", RECORD_SOURCE="WMS", po_purchase_order_item_id=i,
                            received_quantity=received))
    t = tables(transactions=tx, transaction_lines=tl, items_cv=items, sb_receipts=rec,
               brand=[dict(brand_id=1, brand_name="B")], product_group=[dict(product_group_id=1, product_group_name="G")])
    row = compliance.po_lines_nested(t, datetime(2024, 3, 15, 12)).collect()[0]
    assert abs(row.total_on_order_quantity - sum(x.on_order_quantity for x in row.po_lines)) < 1e-9
    assert abs(row.total_on_order_cost - sum(x.on_order_cost for x in row.po_lines)) < 1e-9
    assert row.total_amount_lines == round(sum(q for q, _ in lines), 2)
