"""Plan shapes the scale design relies on (initial physical plans, broadcasts
of the small test tables switched off so the shuffle structure is visible)."""

import re

import pytest

from tidewater.plans import asn, compliance, queries
from tidewater.plans.queries import AS_OF, sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return sources(spark, SF)


@pytest.fixture
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def tree(df):
    """Operator tree lines of the physical plan (one operator per line)."""
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def exchanges(lines):
    return [x for x in lines if re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", x)]


def test_j07_preaggregates_lines_and_ends_in_one_exchange(t, no_auto_broadcast):
    lines = tree(compliance.purchase_orders_all(t, AS_OF))
    text = "\n".join(lines)
    # the line pre-aggregate (partial + final sums) sits below the PO join
    assert re.search(r"HashAggregate\(keys=\[transaction_id.*department_id", text)
    # above the joins: one exchange on the PO number serves GROUP BY and DISTINCT
    top = [x for x in lines[: next(i for i, x in enumerate(lines) if "Join" in x)]]
    assert len(exchanges(top)) == 1 and "hashpartitioning(tranid" in "\n".join(top)


def test_j08_folds_receipts_before_they_meet_the_lines(t, no_auto_broadcast):
    text = "\n".join(tree(compliance.po_lines_nested(t, AS_OF)))
    assert not re.search(r"^\W*(\(\d+\) )?Window \[", text, re.M)
    # map-side sums of the raw receipts, by their four keys
    assert re.search(r"HashAggregate\(keys=\[po_number#\d+, received_sku#\d+, po_purchase_order_item_id#\d+L?, RECORD_SOURCE.*partial_sum", text)


def test_j05_pairs_are_distinct_without_a_shuffle_above_the_join(t, no_auto_broadcast):
    lines = tree(asn.edi_po_vendor_fields(t, AS_OF))
    top = lines[: next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)]
    assert not exchanges(top) and not any("Aggregate" in x for x in top)


def test_j05_values_are_normalised_before_the_pairs_are_made(spark, no_auto_broadcast):
    lines = tree(queries.run("currency_fanout_dedupe", spark, SF))
    meet = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    assert not any(re.search("date_format|FLOOR", x) for x in lines[:meet]) and any("date_format" in x for x in lines[meet:])
    assert re.search(r"size\(__pset.*= 1.*OR", lines[meet])


@pytest.fixture
def planned_once(spark):
    """Without adaptive execution the plan shows which shuffles are reused."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("build, names", [
    (asn.asn_details, ("orders", "lineitem")), (asn.asn_summary, ("orders", "lineitem"))])
def test_j01_j02_read_the_large_tables_once(t, no_auto_broadcast, planned_once, build, names):
    # transactions are made from orders, lines from lineitem; no other source of these two reads them
    text = "\n".join(tree(build(t, AS_OF)))
    for name in names:
        assert len(re.findall(rf"FileScan parquet .*{name}\.parquet", text)) == 1


def test_j03_reads_each_carrier_table_once(t, no_auto_broadcast):
    # transactions, carrier headers: one scan of orders each; shipments: one of lineitem
    text = "\n".join(tree(asn.carrier_shipment_info(t, AS_OF)))
    assert len(re.findall(r"FileScan parquet .*orders\.parquet", text)) == 2
    assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", text)) == 1


def test_j05_filters_lines_by_recent_pos_before_the_left_join(t):
    text = "\n".join(tree(asn.edi_po_vendor_fields(t, AS_OF)))
    assert "LeftSemi" in text


@pytest.mark.parametrize("build", [asn.vendor_contacts, compliance.vendor_contacts_stage])
def test_vendor_documents_read_vendors_once_and_keep_children_left(t, no_auto_broadcast, planned_once, build):
    text = "\n".join(tree(build(t)))
    # the vendor table is the one made from supplier that reads s_name; messages come from events
    assert len(re.findall(r"FileScan parquet .*events\.parquet", text)) == 1
    assert len(re.findall(r"FileScan parquet \[[^\]]*s_name", text)) == 1
    # a child tab reaches the vendors nested, one row a vendor: no join above has the child rows
    assert text.index("communications_tab") < text.index("FileScan parquet")


def test_hot_vendor_is_split_in_the_message_joins(spark):
    # One vendor holds nearly all messages; adaptive execution splits the hot
    # author of the left join, whose big side is the message table.
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    try:
        n = 60_000
        pad = "concat('m', sha2(cast(id as string), 512))"
        ids = spark.range(0, n, 1, 8)
        message = ids.selectExpr(f"5L company_id", "if(id % 50 = 0, id, 9L) author_id", "id % 100 recipient_id", "cast(null as timestamp) date_0", "'s' subject",
                                 "'to' to_0", "'from' from_0", "1L message_type_id", f"{pad} message", "false _fivetran_deleted")
        people = spark.range(n).selectExpr("id employee_id", "concat('E', id) full_name", "false _fivetran_deleted")
        out = asn._communications_tab({"message": message, "employees": people}, live_rows=False)
        assert out.selectExpr("size(communications_tab) n").collect()[0].n == n
        out.write.format("noop").mode("overwrite").save()
        df = asn._communications_tab({"message": message, "employees": people}, live_rows=False)
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_j02_distinct_counts_are_two_level(t):
    text = "\n".join(tree(asn.asn_summary(t, AS_OF)))
    assert "Expand" in text  # distinct counts expanded, then merged per division
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("build", [asn.contact_details, compliance.contact_details_stage])
def test_contact_children_never_multiply_as_rows(t, no_auto_broadcast, build):
    """No join has raw child rows on its null side: addresses are distinct values
    with counts and drive their join, types are nested by themselves."""
    text = "\n".join(tree(build(t)))
    # left joins: the lookups of contacts and one nested row a contact for its types
    assert "RightOuter" not in text and len(re.findall(r"Join \[contact_id#\d+L?\], \[__typed", text)) >= 1
    assert re.search(r"Join \[__addressed#\d+L?\], \[contact_id#\d+L?\], Inner", text)
    assert re.search(r"HashAggregate\(keys=\[entity_id#\d+L?, is_default_ship_address.*partial_count", text)


def test_hot_contact_is_split_over_its_addresses(spark):
    """One contact holds nearly all addresses; adaptive execution splits their join."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    for k, v in zip(keep, ("-1", "64k", "64k", "1.5")):
        spark.conf.set(k, v)
    try:
        t = sources(spark, SF)
        n = 60_000
        hot = t["contacts"].selectExpr("min(contact_id)").first()[0]
        book = spark.range(0, n, 1, 8).selectExpr(f"if(id % 50 = 0, -id, {hot}L) entity_id", "'T' is_default_ship_address", "cast(null as string) is_default_bill_address", "concat('a', sha2(cast(id as string), 512)) address")
        tables = {x: t[x] for x in ("contacts", "subsidiaries", "companies", "entity", "contact_types")} | {"address_book": book}
        from tidewater.sources.catalog import Sources
        df = asn.contact_details(Sources.from_tables(spark, tables))
        held = df.where(f"contact_id = {hot}").count()
        df.collect()
        assert held == n - n // 50 and "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
