"""Large jobs in slices: the rows of the whole, and less on disk than its shuffles."""

import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewater.operators.slices import SLICES, Sliced, append_in_turn, slice_of
from tidewater.plans import compliance, queries
from tidewater.plans.queries import AS_OF, sources
from tidewater.sources.publish import _CLEANUP, freed, publish, scratch_path

SF = "/root/testdata/sf0.001"


def flat(df):
    """Rows as text; sums of doubles depend on their order in the last digits."""
    return sorted(re.sub(r"-?\d+\.\d+(e-?\d+)?", lambda m: f"{float(m[0]):.9g}", str(r)) for r in df.collect())


def test_slices_hold_every_row_once_and_can_go(spark):
    rows = spark.createDataFrame([(None if i % 7 == 0 else f"PO{i % 20}", i) for i in range(200)], "po string, id long")
    table = Sliced(spark, "sliced").add(rows.where("id < 100"), "po").add(rows.where("id >= 100"), "po")
    parts = [flat(table.of(i)) for i in range(SLICES)]
    assert sorted(sum(parts, [])) == flat(rows) and sum(map(bool, parts)) > 1
    assert parts[1] == flat(rows.where(slice_of("po") == 1))
    table.remove(1)
    assert [flat(table.of(i)) for i in range(SLICES)] == [[] if i == 1 else x for i, x in enumerate(parts)]
    table.remove()
    assert not os.path.exists(table.path.removeprefix("file:"))


def test_shuffle_files_go_when_a_job_ends(spark):
    before = spark.conf.get(_CLEANUP, None)
    with freed(spark):
        with freed(spark):
            pass
        assert spark.conf.get(_CLEANUP) == "true"
    assert spark.conf.get(_CLEANUP, None) == before


def test_documents_in_slices_are_those_of_one_job(spark):
    t = sources(spark, SF)
    before = spark.conf.get(_CLEANUP, None)
    names = ("line-keys-", "lines-met-", "purchase-orders-", "carrier-shipments-")
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    df = append_in_turn(spark, scratch_path(spark, "documents"), compliance.po_documents_in_slices(t, AS_OF))
    whole = compliance.po_document(t, AS_OF)
    assert flat(df) == flat(whole) and df.dtypes == whole.dtypes
    assert spark.conf.get(_CLEANUP, None) == before
    assert not [x for x in root.iterdir() if x.name.startswith(names)]


def test_slices_with_shared_and_missing_numbers(tables):
    po, line = dict(transaction_type="Purchase Order"), dict(brand_id=1, product_group_id=1, item_count=1.0, item_unit_price="2.0")
    t = tables(
        transactions=[dict(po, transaction_id=i, tranid=n) for i, n in ((1, "A"), (2, "A"), (3, "B"), (4, None), (3, "C"))],
        transaction_lines=[dict(line, transaction_id=i, transaction_line_id=k, item_id=i) for i in (1, 2, 3, 4, None) for k in (1, 2)],
        brand=[dict(brand_id=1, brand_name="B")], product_group=[dict(product_group_id=1, product_group_name="G")])
    got = append_in_turn(t.spark, scratch_path(t.spark, "odd"), compliance.po_lines_in_slices(t, AS_OF))
    assert flat(got) == flat(compliance.po_lines_nested(t, AS_OF))
    assert sorted(r.po_number for r in got.collect()) == ["A", "B", "C"]


@pytest.mark.parametrize("name", ["po_line_measures", "po_lines_nested_flat", "po_document_lines", "po_document_flat", "po_document_fields"])
def test_no_wide_shuffle_is_left_for_the_last_job(spark, name):
    """What a query returns is stored: reading it shuffles nothing."""
    plan = queries.run(name, spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan parquet" in plan


def test_a_layout_is_written_in_turns(spark, monkeypatch):
    """No shuffle of a layout moves more than its turn's rows; nothing is left behind."""
    from tidewater.sources import publish as P
    seen, real = [], P.in_parts

    def counted(rows, columns, low, high):
        seen.append(rows.count())
        return real(rows, columns, low, high)

    monkeypatch.setattr(P, "in_parts", counted)
    rows = spark.range(0, 4000, 1, 4).select(F.format_string("PO%05d", "id").alias("po"), (F.col("id") % 5).cast("string").alias("day"))
    root = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    path = publish(rows, scratch_path(spark, "laid"), partition_by="day", cluster_by="po", files=16)
    assert sum(seen) == 4000 and len(seen) == P.TURNS and max(seen) < 2000
    assert flat(spark.read.schema(rows.schema).parquet(path)) == flat(rows)
    assert not [x for x in root.iterdir() if x.name.startswith(("unlaid-", "turned-"))]
