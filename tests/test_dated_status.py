"""E17 in two steps: the flag of a status, and the day that it keeps."""

from datetime import date

from pyspark.sql import functions as F

from tidewater.functions import expr as E


def test_the_flag_and_its_day_are_status_dated(spark):
    df = spark.createDataFrame([("Pending Bill", date(2001, 3, 15)), ("Closed", date(2001, 3, 15)), (None, date(2001, 3, 15)), ("FULLY BILLED", None)], "s string, d date")
    rows = df.withColumn("f", E.is_dated(F.col("s"))).select(E.dated_day(F.col("f"), F.col("d")), E.status_dated(F.col("s"), F.col("d"))).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] == [date(2001, 3, 15), date(1900, 1, 1), date(1900, 1, 1), None]
