"""Where contacts and carrier rows are grouped: after a shuffle, and after no more than one."""

import re

import pytest

from tidewater.plans import asn, compliance
from tidewater.plans.queries import AS_OF, sources

SF = "/root/testdata/sf0.001"


@pytest.fixture
def planned_once(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def tree(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


@pytest.mark.parametrize("build", [asn.contact_details, compliance.contact_details_stage])
def test_no_task_sorts_contacts_for_their_groups_before_they_are_dealt(spark, planned_once, build):
    lines = tree(build(sources(spark, SF)))
    grouped = [i for i, x in enumerate(lines) if "Aggregate(key" in x and "partial_count(1)" in x and "full_name" in x]
    assert grouped
    for i in grouped:  # what a partial aggregate reads has just been shuffled
        below = next(x for x in lines[i + 1 :] if "Exchange" in x or "Join" in x)
        assert "hashpartitioning(contact_id" in below and "REPARTITION" in below


def test_carrier_rows_are_distinct_and_nested_after_one_shuffle(spark, planned_once):
    lines = tree(compliance.carrier_shipments_nested(sources(spark, SF), AS_OF))
    top = lines[: next(i for i, x in enumerate(lines) if "Join" in x)]
    dealt = [x for x in top if re.search(r"Exchange (hash|range)partitioning", x)]
    assert len(dealt) == 1 and "hashpartitioning(tranid" in dealt[0]
    # the vendor is found before the shipments are
    text = "\n".join(lines)
    assert text.index("nc_id") < text.index("__entity")
