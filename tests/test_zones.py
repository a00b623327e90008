"""Days and texts are those of UTC in any session zone."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidewater.functions import expr as E
from tidewater.plans import asn, compliance
from tidewater.plans.queries import AS_OF, sources
from tidewater.sources.catalog import materialize
from tidewater.sources.publish import scratch_path

SF = "/root/testdata/sf0.001"
ZONES = ("America/Denver", "Asia/Tokyo", "Africa/Cairo")


@pytest.fixture
def zone(spark):
    def set_(name):
        spark.conf.set("spark.sql.session.timeZone", name)
    yield set_
    set_("UTC")


INSTANTS = [datetime(2001, 3, 15, 1, 30), datetime(2001, 3, 14, 23, 59, 59, 999_999), datetime(2001, 4, 1, 9, 30), datetime(1969, 12, 31, 23, 0, 1), datetime(2024, 3, 10, 2, 30), None]


@pytest.mark.parametrize("name", ("UTC", *ZONES))
def test_instants_dates_texts_and_zoneless(spark, zone, name):
    zone(name)
    rows = [(x and x.replace(tzinfo=timezone.utc), x and x.date(), x and x.isoformat(" "), x) for x in INSTANTS]
    df = spark.createDataFrame(rows, "t timestamp, d date, s string, n timestamp_ntz")
    got = df.select(*[f(F.col(x)).alias(f"{f.__name__}_{x}") for f in (E.utc_day, E.fmt_day, E.fmt_ts) for x in "tdsn"], F.unix_seconds(E.utc_midnight(F.col("t"))).alias("start")).collect()
    for x, r in zip(INSTANTS, got):
        for k in "tdsn":
            y = x if k != "d" else x and datetime(x.year, x.month, x.day)
            assert r[f"utc_day_{k}"] == (x and x.date())
            assert r[f"fmt_day_{k}"] == (x and f"{x:%m-%d-%Y}")
            assert r[f"fmt_ts_{k}"] == (y and f"{y:%m-%d-%Y %H:%M:%S}")
        assert r.start == (x and int(datetime(x.year, x.month, x.day, tzinfo=timezone.utc).timestamp()))


def test_status_days_and_snapshot(spark, zone):
    zone("America/Denver")
    df = spark.createDataFrame([("Fully Billed", datetime(2001, 3, 15, 1, 30, tzinfo=timezone.utc)), ("Open", None)], "s string, t timestamp")
    assert [r[0] for r in df.select(E.status_dated(F.col("s"), F.col("t"))).collect()] == [date(2001, 3, 15), date(1900, 1, 1)]
    start = spark.range(1).select(F.unix_seconds(E.snapshot_start(datetime(2024, 3, 11, 12)))).first()[0]
    assert start == int(datetime(2024, 3, 10, 6, tzinfo=timezone.utc).timestamp())


def test_tables_are_equal_under_other_zones(spark, zone):
    zone("UTC")
    names = ["transactions", "transaction_lines", "entity", "employees", "items_cv", "uom", "brand", "merchandise_division", "season", "year1", "po_types",
             "edi_document_type_status", "locations", "departments", "dim_dates", "payment_terms", "allocation_channel", "integrationstatuses", "po_category",
             "ready_for_860_transmit", "purchase_order_change_status", "acknowledgment_types", "acknowledgment_item_statuses", "edi_856_asn", "product_group",
             "sb_inventory", "sb_receipts", "vendors"]
    t = materialize(sources(spark, SF), scratch_path(spark, "zones"), names)
    builds = {"J01": lambda: asn.asn_details(t, AS_OF), "J05": lambda: asn.edi_po_vendor_fields(t, AS_OF), "J07": lambda: compliance.purchase_orders_all(t, AS_OF),
              "J08": lambda: compliance.po_line_groups(t, AS_OF), "J13": lambda: compliance.edi_856_asn(t)}
    want = {k: sorted(map(str, f().collect())) for k, f in builds.items()}
    assert all(want.values())
    for name in ZONES[:2]:
        zone(name)
        for k, f in builds.items():
            assert sorted(map(str, f().collect())) == want[k], (name, k)
