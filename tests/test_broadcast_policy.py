"""Broadcast hints only for code lists, bounded by their definition; no job runs
and nothing is counted while a plan is built."""

from datetime import datetime

from tidewater.operators import ops
from tidewater.plans import asn, compliance
from tidewater.sources.catalog import CODE_LISTS, Sources

AS_OF = datetime(2001, 3, 15, 12)
SF = "/root/testdata/sf0.001"


def test_only_code_lists_are_hinted(spark):
    t = Sources.from_testdata(spark, SF, AS_OF)
    assert CODE_LISTS <= set(t)
    assert t.is_small("po_types")
    assert not any(t.is_small(x) for x in ("vendors", "brand", "locations", "dim_dates", "items_cv"))


def test_lookup_without_hint_is_left_to_the_optimizer(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, dim = spark.range(5), spark.range(3).withColumnRenamed("id", "k")
        plan = ops.lookup(left, dim, left["id"], "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan


def test_building_plans_runs_no_job(spark):
    t = Sources.from_testdata(spark, SF, AS_OF)
    for name in t:  # schemas of the given tables are read here
        t[name]
    sc = spark.sparkContext
    sc.setJobGroup("plans-only", "build plans")
    try:
        for build in (asn.asn_details, asn.asn_summary, asn.edi_po_vendor_fields, compliance.purchase_orders_all, compliance.po_lines_nested):
            build(t, AS_OF)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(sc.statusTracker().getJobIdsForGroup("plans-only")) == []
