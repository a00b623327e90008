import os
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewater.functions import expr as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def one(spark, col, data=None, schema=None):
    df = spark.createDataFrame(data or [(1,)], schema or "x int")
    return [r[0] for r in df.select(col).collect()]


def test_as_key_rounds_doubles_half_away(spark):
    df = spark.createDataFrame([(2.5,), (2.4,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(E.as_key(df, "x")).collect()] == [3, 2, -3]
    df = spark.createDataFrame([("42",)], "x string")
    assert df.select(E.as_key(df, "x")).collect()[0][0] == 42


def test_flag_decoders(spark):
    data, schema = [("T",), ("F",), (None,), ("X",)], "f string"
    assert one(spark, E.t_yes_no(F.col("f")), data, schema) == ["Yes", "No", "No", "No"]
    assert one(spark, E.true_false_blank(F.col("f")), data, schema) == ["True", "False", "", ""]
    assert one(spark, E.not_f(F.col("f")), data, schema) == [True, False, True, True]
    data = [("No",), ("Yes",), (None,)]
    assert one(spark, E.active_status(F.col("f")), data, schema) == ["Active", "Inactive", "Inactive"]
    assert one(spark, E.company_type(F.col("f")), data, schema) == ["Company", "Individual", "Individual"]


def test_prices(spark):
    data, schema = [("12.50",), ("-10.0%",), (None,)], "p string"
    assert one(spark, E.text_price(F.col("p")), data, schema) == [12.5, -10.0, None]
    assert one(spark, E.rate_text(F.col("p")), data, schema) == ["12.50", "10.0", None]


def test_transit_window_cases(spark):
    as_of = datetime(2024, 3, 15, 12)
    rows = [  # C1, C2, C3, C4, C5
        (datetime(2024, 3, 10), datetime(2024, 3, 5)),
        (None, datetime(2024, 3, 5)),
        (None, None),
        (datetime(2024, 3, 1), None),
        (datetime(2024, 2, 29), None),
    ]
    df = spark.createDataFrame(rows, "est timestamp, ship timestamp")
    end = E.transit_window_end(F.col("est"), F.col("ship"))
    out = df.select(end.alias("e"), E.yes_no_window(as_of, end).alias("w")).collect()
    assert [r.e for r in out] == [date(2024, 3, 24), date(2024, 3, 19), None, date(2024, 3, 15), date(2024, 3, 14)]
    assert [r.w for r in out] == ["Yes", "Yes", "No", "Yes", "No"]


def test_snapshot_start_across_clock_change(spark):
    # Start of yesterday in Denver, minus 24 hours exactly.
    for as_of, want in [(datetime(2024, 3, 11, 12), datetime(2024, 3, 10, 6)),
                        (datetime(2024, 3, 10, 12), datetime(2024, 3, 9, 7)),
                        (datetime(2024, 3, 15, 12), datetime(2024, 3, 14, 6))]:
        assert one(spark, E.snapshot_start(as_of)) == [want]
        assert E.snapshot_start_value(as_of) == want


def test_days_past_due_and_minus_days(spark):
    as_of = datetime(2024, 3, 15, 12)
    data = [(datetime(2024, 3, 10),), (datetime(2024, 3, 20),), (None,)]
    assert one(spark, E.days_past_due(as_of, F.col("d")), data, "d timestamp") == [5, -5, 0]
    got = one(spark, E.minus_days(F.col("d"), F.lit(3)), [(datetime(2024, 3, 10, 6),)], "d timestamp")
    assert got == [datetime(2024, 3, 7, 6)]


def test_status_dated(spark):
    data = [("Pending Receipt", datetime(2024, 1, 2)), ("Closed", datetime(2024, 1, 2))]
    out = one(spark, E.fmt_day(E.status_dated(F.col("s"), F.col("d"))), data, "s string, d timestamp")
    assert out == ["01-02-2024", "01-01-1900"]


@pytest.mark.parametrize("zone", ["America/Denver", "Asia/Kolkata", "UTC"])
def test_recent_bound_does_not_depend_on_the_drivers_zone(zone):
    # F7/E28 in a Python process of another zone (the session's zone is UTC).
    code = (
        "from datetime import datetime\n"
        "from tidewater.session import local_session\n"
        "from tidewater.functions import expr as E\n"
        "spark = local_session(1)\n"
        "row = spark.range(1).select(E.recent_since(datetime(2024, 3, 15, 12)).cast('string')).first()\n"
        "print('BOUND', row[0])\n")
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": zone, "PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=120)
    assert "BOUND 2024-02-14 12:00:00" in done.stdout, done.stderr[-500:]
