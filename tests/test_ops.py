from pyspark.sql import functions as F

from tidewater.operators import ops


def test_nest_keeps_one_null_element_for_unmatched_left_join(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, "a"), (1, "b")], "pid long, v string")
    j = ops.lookup(parent, child, F.col("id"), "pid", {"v": "v"})
    out = {r.id: r.arr for r in ops.nest(j, ["id"], [F.col("v")], "arr").collect()}
    assert [x.v for x in out[1]] == ["a", "b"]
    assert len(out[2]) == 1 and out[2][0].v is None


def test_distinct_count_by_keeps_null_group(spark):
    df = spark.createDataFrame([("d1", "p1"), ("d1", "p1"), ("d1", "p2"), (None, "p3")], "d string, p string")
    out = {r.d: r.n for r in ops.distinct_count_by(df, "d", {"n": "p"}).collect()}
    assert out == {"d1": 2, None: 1}


def test_repeat_rows_at_least_once(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert ops.repeat_rows(df, F.lit(0)).count() == 1
    assert ops.repeat_rows(df, F.lit(2)).count() == 2


def test_live_lookup_is_inner_to_live_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    dim = spark.createDataFrame([(1, False), (2, True), (3, None)], "k long, _fivetran_deleted boolean")
    out = ops.lookup(df, dim, F.col("k"), "k", how="inner", live_only=True)
    assert [r.k for r in out.collect()] == [1]


def test_nest_by_runs_equals_nest_and_splits_a_large_parent(spark):
    # Nine tenths of all rows have one parent; equal first fields, NULLs and equal rows are among them.
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, F.lit("hot")).when(F.col("id") % 400 == 0, F.lit(None)).otherwise(F.concat(F.lit("p"), F.col("id") % 37)).alias("parent"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("a"), (F.col("id") * 7919 % 6007).alias("b"), F.lit(1).alias("one"))
    fields = [F.col("a"), F.col("b")]
    keep = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = ops.sorted_runs(df, ["parent"], fields, by=2).select("parent", "__part", F.size("__run").alias("n")).collect()
        got = ops.nest_runs(df, ["parent"], fields, "arr", sums={"n": F.col("one")}, maxima={"top": F.col("b")}, by=2)
        want = ops.nest(df, ["parent"], fields, "arr", [F.sum("one").alias("n"), F.max("b").alias("top")])
        assert {r.parent: r for r in got.collect()} == {r.parent: r for r in want.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    assert sum(r.n for r in runs) == 20_000 and max(r.n for r in runs) < 0.3 * 20_000
    assert len([r for r in runs if r.parent == "hot"]) >= 5


def test_nest_by_runs_of_nothing(spark):
    df = spark.createDataFrame([], "parent string, a long")
    assert ops.nest_runs(df, ["parent"], [F.col("a")], "arr").collect() == []


def test_lookup_deals_rows_of_null_keys(spark):
    # Nine tenths of the keys are NULL; the same rows come out, and no task reads most of them.
    df = spark.range(0, 20_000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 97).alias("fk"))
    dim = spark.range(0, 90, 1, 2).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).union(spark.createDataFrame([(None, "null")], "k long, v string"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        want = ops.lookup(df, dim, F.col("fk"), "k", {"v": "v"})
        got = ops.lookup(df, dim, F.col("fk"), "k", {"v": "v"}, spread_by=("id",))
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        sizes = lambda x: sorted(r["count"] for r in x.groupBy(F.spark_partition_id()).count().collect())
        assert max(sizes(want)) > 0.85 * 20_000 and max(sizes(got)) < 0.3 * 20_000
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
