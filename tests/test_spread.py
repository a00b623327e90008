"""Ranks and joins with a key that holds most rows."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import spread


@pytest.fixture
def many_parts(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(keep, ("16", "-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def plain(rows, order):
    keys = {tuple(r[c] for c, _ in order) for r in rows}
    for c, up in reversed(list(enumerate(order))):
        keys = sorted(keys, key=lambda k: (k[c] is not None, k[c]) if up[1] else (k[c] is None, _Down(k[c])))
    place = {k: i for i, k in enumerate(keys, 1)}
    return sorted((r["id"], place[tuple(r[c] for c, _ in order)]) for r in rows)


class _Down:
    def __init__(self, x):
        self.x = x

    def __lt__(self, other):
        return self.x is not None and other.x is not None and self.x > other.x

    def __eq__(self, other):
        return self.x == other.x


def test_places_with_a_hot_key_and_nulls(spark, many_parts):
    df = spark.range(0, 6000, 1, 8).select(
        "id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 501)).alias("day"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("label"))
    rows = [r.asDict() for r in df.collect()]
    for order in ([("day", True)], [("day", True), ("label", False)], [("label", False), ("day", False)]):
        got = sorted((r.id, r.place) for r in spread.with_place(df, order).select("id", "place").collect())
        assert got == plain(rows, order)


def test_no_task_reads_most_rows_and_the_input_runs_once(spark, many_parts):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 30_000, 1, 8).withColumn("day", F.when(F.col("id") % 10 > 0, F.lit(0)).otherwise(F.col("id"))).mapInArrow(count, "id long, day long")
    placed = spread.with_place(df, [("day", True)])
    # Rows of each task of the result: nine tenths have one key.
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 0.3 * 30_000
    assert seen.value == 30_000


def test_empty_and_equal(spark):
    schema = "id long, day string"
    assert spread.with_place(spark.createDataFrame([], schema), [("day", True)]).collect() == []
    same = spark.createDataFrame([(1, None), (1, None)], schema)
    assert [tuple(r) for r in spread.with_place(same, [("day", False)]).collect()] == [(1, None, 1)] * 2


def test_grid_join_equals_a_join_and_spreads_one_key(spark, many_parts):
    left = spark.range(0, 3000, 1, 4).select(F.col("id").alias("l"), F.when(F.col("id") % 10 > 0, "usd").when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("lk"))
    right = spark.range(0, 400, 1, 4).select(F.col("id").alias("r"), F.when(F.col("id") % 20 > 0, "usd").when(F.col("id") % 40 == 0, F.lit(None)).otherwise("c1").alias("rk"))
    met = spread.grid_join(left, right, "lk", "rk", tile=64)
    want = left.join(right, left["lk"] == right["rk"])
    assert met.columns == want.columns
    assert met.exceptAll(want).isEmpty() and want.exceptAll(met).isEmpty() and met.count() == want.count() > 1_000_000
    sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.3 * sum(sizes) and len(sizes) >= 12  # one key has nearly all pairs
    text = met._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_grid_join_of_nothing_and_equal_rows(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), (None, 2)], "ak string, a long")
    b = spark.createDataFrame([("x", 7), ("x", 7), (None, 8)], "bk string, b long")
    assert spread.grid_join(a, b, "ak", "bk", tile=1).count() == 4
    assert spread.grid_join(a.limit(0), b, "ak", "bk").collect() == []
