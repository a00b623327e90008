"""Column expressions shared by the table builders.

Every function here returns a ``Column`` built from ``pyspark.sql.functions``
only, so all of it stays inside whole-stage codegen. The run time is never
read from the clock: callers pass ``as_of`` (a ``datetime`` in UTC), and the
expressions turn it into literals, so pushed filters stay constant.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed output formats of the reference (BigQuery FORMAT_TIMESTAMP patterns
# "%m-%d-%Y" and "%m-%d-%Y %H:%M:%S"), written as Spark datetime patterns.
# (the second one is put together from the day and the time of day).
DAY_FORMAT = "MM-dd-yyyy"
SECONDS_OF_DAY = 86_400

# Fixed default date of the reference for missing or not-yet-valid dates.
DEFAULT_DAY = "1900-01-01"

# Fixed length of the transit window, in days.
TRANSIT_DAYS = 14

# Fixed look-back of the recency filters, in days.
RECENT_DAYS = 30

# Fixed statuses (lower case) for which the PO ship / cancel dates are kept.
DATED_STATUSES = (
    "partially received",
    "pending billing/partially received",
    "pending receipt",
    "pending bill",
    "fully billed",
)

# Fixed zone in which the inventory snapshot day starts.
SNAPSHOT_ZONE = "America/Denver"


def c(name: str) -> Column:
    return F.col(name)


# ---------------------------------------------------------------- run time

def as_of_ts(as_of: datetime) -> Column:
    """The run time as a TIMESTAMP literal (replaces current_timestamp())."""
    return F.lit(_utc(as_of)).cast("timestamp")


def as_of_date(as_of: datetime) -> Column:
    """The run day in UTC as a DATE literal (replaces current_date)."""
    return F.lit(_utc(as_of).date())


def _utc(as_of: datetime) -> datetime:
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return as_of.astimezone(timezone.utc)


# ---------------------------------------------------------------- keys and casts

def as_key(df: DataFrame, name: str) -> Column:
    """``cast(x as int64)`` of a join key.

    BIGINT stays as it is; integers widen; text is parsed; a DOUBLE is rounded
    half away from zero first, as the warehouse does, where a plain Spark cast
    would truncate.
    """
    dtype = df.schema[name].dataType
    col = df[name]
    if isinstance(dtype, T.LongType):
        return col
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.round(col).cast("bigint")
    return col.cast("bigint")


def text_price(price: Column) -> Column:
    """Price text with '%' removed, as DOUBLE (sign kept; bad text raises)."""
    return F.replace(price, F.lit("%"), F.lit("")).cast("double")


def rate_text(price: Column) -> Column:
    """Price text with every '%' and '-' removed, kept as text."""
    return F.regexp_replace(price, r"%|-", "")


# ---------------------------------------------------------------- dates

# Days and texts are those of UTC whatever the session's zone is: an instant is taken
# apart as a number of seconds, never by a cast or a pattern that asks the session.
# ``typeof`` is a constant of the plan, so only the branch of the column's type is left.

def _seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def utc_day(x: Column) -> Column:
    """The UTC day of a timestamp; a date is its own, text and zoneless
    timestamps are read as UTC."""
    instant = F.date_from_unix_date(F.floor(_seconds(x) / SECONDS_OF_DAY).cast("int"))
    return (F.when(F.typeof(x) == "timestamp", instant).when(F.typeof(x) == "date", x.cast("date"))
            .otherwise(x.cast("timestamp_ntz").cast("date")))


def utc_midnight(x: Column) -> Column:
    """``TIMESTAMP_TRUNC(TIMESTAMP(x), DAY)``: the start of the UTC day."""
    return F.timestamp_seconds(F.unix_date(utc_day(x)).cast("bigint") * SECONDS_OF_DAY)


def _utc_time(x: Column) -> Column:
    of_day = F.pmod(_seconds(x), F.lit(SECONDS_OF_DAY))
    parts = [F.floor(of_day / 3600), F.floor(of_day % 3600 / 60), of_day % 60]
    text = F.concat_ws(":", *[F.lpad(p.cast("int").cast("string"), 2, "0") for p in parts])
    return (F.when(F.typeof(x) == "timestamp", text).when(F.typeof(x) == "date", F.lit("00:00:00"))
            .otherwise(F.substring(x.cast("timestamp_ntz").cast("string"), 12, 8)))


def fmt_day(ts: Column) -> Column:
    """``FORMAT_TIMESTAMP('%m-%d-%Y', TIMESTAMP(x))``."""
    return F.date_format(utc_day(ts), DAY_FORMAT)  # a date has no zone


def fmt_ts(ts: Column) -> Column:
    """``FORMAT_TIMESTAMP('%m-%d-%Y %H:%M:%S', TIMESTAMP(x))``."""
    return F.when(ts.isNotNull(), F.concat(fmt_day(ts), F.lit(" "), _utc_time(ts)))


def transit_window_end(est_delivery: Column, shipped: Column) -> Column:
    """(estimated delivery day, else shipment day) + 14 days; NULL if both are."""
    return F.date_add(F.coalesce(utc_day(est_delivery), utc_day(shipped)), TRANSIT_DAYS)


def in_window(as_of: datetime, window_end: Column) -> Column:
    """Boolean: the run day is on or before the window end (NULL end -> NULL)."""
    return as_of_date(as_of) <= window_end


def yes_no_window(as_of: datetime, window_end: Column) -> Column:
    """E8: 'Yes' inside the window, else 'No' (a NULL window end gives 'No')."""
    return F.when(in_window(as_of, window_end), "Yes").otherwise("No")


def recent_since(as_of: datetime) -> Column:
    """Lower bound of the 30-day look-back, a TIMESTAMP literal. The value
    carries its zone, so the driver's own time zone plays no part."""
    return F.lit(_utc(as_of) - timedelta(days=RECENT_DAYS))


def days_past_due(as_of: datetime, due: Column) -> Column:
    """Days from the due day to the run day; 0 when there is no due date."""
    return F.when(due.isNotNull(), F.datediff(as_of_date(as_of), utc_day(due))).otherwise(0)


def minus_days(ts: Column, days: Column) -> Column:
    """``TIMESTAMP_SUB(ts, INTERVAL n DAY)`` with a column day count."""
    # Spark's own interval arithmetic moves days along the session zone's clock.
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) - days.cast("bigint") * (SECONDS_OF_DAY * 1_000_000))


def status_dated(status: Column, value: Column) -> Column:
    """The day when the status is one of DATED_STATUSES, else 1900-01-01."""
    return dated_day(is_dated(status), value)


def is_dated(status: Column) -> Column:
    """The status is one of DATED_STATUSES."""
    return F.lower(status).isin(*DATED_STATUSES)


def dated_day(dated: Column, value: Column) -> Column:
    """The day where ``dated`` holds, else 1900-01-01."""
    return F.when(dated, utc_day(value)).otherwise(F.lit(DEFAULT_DAY).cast("date"))


def snapshot_start(as_of: datetime, zone: str = SNAPSHOT_ZONE) -> Column:
    """Start of yesterday in ``zone``, as a UTC TIMESTAMP.

    ``timestamp_sub(TIMESTAMP_TRUNC(ts, DAY, zone), INTERVAL 1 DAY)``: local
    midnight of the run day, then minus 24 hours (not one calendar day).
    """
    return F.lit(snapshot_start_value(as_of, zone).replace(tzinfo=timezone.utc))


def snapshot_start_value(as_of: datetime, zone: str = SNAPSHOT_ZONE) -> datetime:
    """``snapshot_start`` as a naive UTC datetime."""
    local = _utc(as_of).astimezone(ZoneInfo(zone))
    midnight = local.replace(hour=0, minute=0, second=0, microsecond=0)
    return (midnight.astimezone(timezone.utc) - timedelta(hours=24)).replace(tzinfo=None)


# ---------------------------------------------------------------- flags and labels

def t_yes_no(flag: Column) -> Column:
    """E12: 'T' -> 'Yes', anything else (NULL too) -> 'No'."""
    return F.when(flag == "T", "Yes").otherwise("No")


def true_false_blank(flag: Column) -> Column:
    """E13: 'T' -> 'True', 'F' -> 'False', anything else -> ''."""
    return F.when(flag == "T", "True").when(flag == "F", "False").otherwise("")


def not_f(flag: Column) -> Column:
    """E14: 'F' -> False, anything else (NULL too) -> True."""
    return ~flag.eqNullSafe("F")


def active_status(isinactive: Column) -> Column:
    """E15: 'No' -> 'Active', else 'Inactive'."""
    return F.when(isinactive == "No", "Active").otherwise("Inactive")


def company_type(is_person: Column) -> Column:
    """E15: 'No' -> 'Company', else 'Individual'."""
    return F.when(is_person == "No", "Company").otherwise("Individual")


def flag(cond: Column) -> Column:
    """A condition as a BOOLEAN where NULL becomes False."""
    return F.when(cond, True).otherwise(False)


def live(alias: str | None = None) -> Column:
    """The row is not soft-deleted (``_fivetran_deleted = False``; NULL fails)."""
    name = "_fivetran_deleted" if alias is None else f"{alias}._fivetran_deleted"
    return F.col(name) == F.lit(False)
