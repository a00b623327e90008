"""K1: replacing a stored table; K2, K3: layout by key bounds; S4, K5: run folders."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater.plans import pipelines
from tidewater.plans.queries import AS_OF, sources
from tidewater.sources import tables
from tidewater.sources.layout import key_bounds, laid_out
from tidewater.sources.publish import publish, scratch_path, write_run
from tidewater.sources.store import Store

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def folders(path):
    at = Path(path.removeprefix("file:")) / "_runs"
    return sorted(x.name for x in at.iterdir())


def test_a_write_that_ends_midway_leaves_the_old_table(spark):
    path = scratch_path(spark, "replaced")
    first = publish(spark.range(100), path)
    assert ids(tables.read_table(spark, path)) == list(range(100))
    # Most tasks of the second write end well, one fails.
    bad = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(bad, path)
    assert tables.current(spark, path) == first and ids(tables.read_table(spark, path)) == list(range(100))
    assert len(folders(path)) == 1  # nothing of the failed run is left

    # A complete run is not seen before its commit; after it the old run is gone.
    run = tables.begin(path)
    folder = write_run(spark.range(5), path, run)
    assert ids(tables.read_table(spark, path)) == list(range(100))
    assert tables.commit(spark, path, run) == 2
    assert tables.current(spark, path) == folder and ids(tables.read_table(spark, path)) == list(range(5))
    assert folders(path) == [run]


def test_an_incomplete_run_cannot_be_committed_and_is_swept(spark):
    path = scratch_path(spark, "swept")
    publish(spark.range(3), path)
    run = tables.begin(path)
    spark.range(9).write.parquet(f"{tables.run_folder(path, run)}/part-of-it")
    with pytest.raises(ValueError, match="not complete"):
        tables.commit(spark, path, run)
    now = datetime.now(timezone.utc)
    assert tables.sweep(spark, path, now - timedelta(days=1)) == []
    assert tables.sweep(spark, path, now + timedelta(days=1)) == [run]
    assert ids(tables.read_table(spark, path)) == [0, 1, 2]


def test_writers_at_the_same_time_never_contend(spark):
    path = scratch_path(spark, "raced")
    runs = [tables.begin(path) for _ in range(6)]
    for k, run in enumerate(runs):
        write_run(spark.range(k + 1), path, run)
    with ThreadPoolExecutor(6) as pool:
        numbers = sorted(pool.map(lambda run: tables.commit(spark, path, run, keep=9), runs))
    assert numbers[0] == 1 and numbers == sorted(n for n, _ in tables.versions(spark, path))
    assert sorted(r for _, r in tables.versions(spark, path)) == sorted(runs)
    last = tables.versions(spark, path)[-1][1]
    assert ids(tables.read_table(spark, path)) == list(range(runs.index(last) + 1))


def test_kept_versions_and_view(spark):
    path = scratch_path(spark, "kept")
    for k in range(1, 5):
        publish(spark.range(k), path, keep=2)
        tables.show_as(spark, path, "tidewater_test_view")
        assert spark.table("tidewater_test_view").count() == k
    assert [n for n, _ in tables.versions(spark, path)] == [2, 3, 4] and len(folders(path)) == 3
    spark.sql("DROP VIEW tidewater_test_view")


def test_a_record_appears_whole_and_once(spark):
    store = Store(spark, scratch_path(spark, "records"))
    assert store.names() == [] and store.create("a.json", json.dumps({"x": "é"}))
    assert not store.create("a.json", "other") and json.loads(store.read("a.json")) == {"x": "é"} and store.names() == ["a.json"]
    store.remove()
    assert store.names() == []


# ---------------------------------------------------------------- layout

def spans(folder):
    """(least, largest) PO number of each file, from the Parquet footers."""
    out = []
    for file in sorted(Path(folder.removeprefix("file:")).rglob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        at = [c for c in range(meta.num_columns) if meta.row_group(0).column(c).path_in_schema == "po"][0]
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((str(file.parent.name), min(s.min for s in stats), max(s.max for s in stats)))
    return out


def test_files_hold_key_ranges_and_a_hot_date_is_split(spark):
    day = F.when(F.col("id") % 3 > 0, F.lit("2001-01-01")).when(F.col("id") % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("2001-02-0"), (F.col("id") % 7 + 1).cast("string"))).cast("date")
    rows = spark.range(0, 20_000, 1, 6).select(F.format_string("PO%06d", (F.col("id") * 7919) % 20_000).alias("po"), day.alias("day"), F.col("id"))
    path = scratch_path(spark, "laid")
    folder = publish(rows, path, partition_by="day", cluster_by="po", files=12)
    back = spark.read.parquet(folder)
    assert sorted(map(tuple, back.select("po", "day", "id").collect())) == sorted(map(tuple, rows.select("po", "day", "id").collect())) or back.exceptAll(rows.select(*back.columns)).isEmpty()
    files = spans(folder)
    hot = sorted((low, high) for day_, low, high in files if day_ == "day=2001-01-01")
    assert len(hot) >= 6 and all(a[1] < b[0] for a, b in zip(hot, hot[1:]))
    # A filter on one PO meets the range of at most one file of each date.
    for day_ in {x[0] for x in files}:
        assert sum(low <= "PO012345" <= high for d, low, high in files if d == day_) <= 1


def test_the_input_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 5000, 1, 4).withColumn("day", F.lit("2001-01-01").cast("date")).mapInArrow(count, "id long, day date").withColumnRenamed("id", "po")
    publish(rows, scratch_path(spark, "once"), partition_by="day", cluster_by="po", files=4)
    assert seen.value == 5000


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, 1), (None, 2)], [("a", 5)] * 40])
def test_odd_keys(spark, rows):
    df = spark.createDataFrame(rows, "lead string, key long")
    out = laid_out(df, ["lead", "key"], key_bounds(df, ["lead", "key"], 4))
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    out = laid_out(df, ["key"], key_bounds(df, ["key"], 4))
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


# ---------------------------------------------------------------- run folders

def tree(base):
    return sorted(str(p.relative_to(base)) for p in Path(base).rglob("*") if p.name.endswith(".parquet"))


def test_two_runs_at_once_on_one_base(spark):
    base = scratch_path(spark, "two-runs")
    with ThreadPoolExecutor(2) as pool:
        out = list(pool.map(lambda _: pipelines.run_pipeline_b(spark, sources(spark, SF), AS_OF, base, buckets=2), range(2)))
    for name in out[0]:
        layer = "stage" if name in ("purchase_orders_all", "po_lines_nested", "carrier_shipment_chr_nested", "vendor_contacts_stage", "contact_details_stage") else "final"
        path = f"{base}/{layer}/{name}"
        versions = tables.versions(spark, path)
        # The run that committed last is the current one; the other has gone.
        assert len(versions) == 1 and folders(path) == [versions[0][1]]
        assert tables.current(spark, path) in (out[0][name], out[1][name])
    doc = tables.read_table(spark, f"{base}/final/purchase_order_nested")
    staged = tables.read_table(spark, f"{base}/stage/purchase_orders_all")
    assert doc.count() == staged.count() > 0
    assert not [x.name for x in spark.catalog.listTables() if x.name.startswith("tidewater_stage_")]


def test_a_run_that_fails_leaves_nothing_and_stages_can_go(spark, monkeypatch):
    t, base = sources(spark, SF), scratch_path(spark, "failed-run")
    with monkeypatch.context() as m:
        m.setattr(pipelines, "vendor_document_from_stage", lambda *a: spark.range(1).select(F.raise_error(F.lit("lost")).alias("x")))
        with pytest.raises(Exception, match="lost"):
            pipelines.run_pipeline_b(spark, t, AS_OF, base, buckets=2)
    assert tree(base) == [] and not [x.name for x in spark.catalog.listTables() if x.name.startswith("tidewater_stage_")]
    out = pipelines.run_pipeline_b(spark, t, AS_OF, base, buckets=2, keep_stage=False)
    assert set(out) == {"purchase_order_nested", "vendor_contacts_nested", "vendor_edi_856_asn", "vendor_edi_856_asn_line"}
    assert all(x.startswith("final/") for x in tree(base))
