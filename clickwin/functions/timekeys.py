"""Time keys: fixed-width digit strings that sort like the time they name.

Keys come in widths ``yyyyMMdd``, ``yyyyMMddHH``, ``yyyyMMddHHmm`` and
``yyyyMMddHHmmssSSS``.  Because they compare as strings, a short key is a
valid bound on a longer one: ``TIME >= '2024010100'`` works on 17-digit
keys and is pushed to the Parquet scan as a plain string range.

Parsing is strict: a key that does not match its pattern gives null (the
lenient JDK parser would roll ``2018093025`` into the next day).
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_KEY = "yyyyMMddHH"
MINUTE_KEY = "yyyyMMddHHmm"
DAY_KEY = "yyyyMMdd"
MILLI_KEY = "yyyyMMddHHmmssSSS"
DATETIME = "yyyy-MM-dd HH:mm:ss"
DATE = "yyyy-MM-dd"

# Unit names accepted by add_time, as the reference spells them
# (two are misspelled there: MIMUE = minute, SESCOND = second).
# YEAR, MONTH, DAY, HOUR, MIMUE, SESCOND, millisecond, WEEK
UNIT_NAMES = {
    "YEAR": "YEAR",
    "MONTH": "MONTH",
    "DAY": "DAY",
    "HOUR": "HOUR",
    "MIMUE": "MINUTE",
    "SESCOND": "SECOND",
    "millisecond": "MILLISECOND",
    "WEEK": "WEEK",
}
# Plain spellings accepted as well.
UNIT_NAMES.update({"MINUTE": "MINUTE", "SECOND": "SECOND", "MILLISECOND": "MILLISECOND"})


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def key_range(col, start: str | None, end: str | None) -> Column:
    """Half-open ``[start, end)`` on a string key; either bound may be None."""
    c = _c(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (c >= F.lit(start))
    if end is not None:
        cond = cond & (c < F.lit(end))
    return cond


def ts_to_key(ts, pattern: str = MILLI_KEY) -> Column:
    """Timestamp -> time key (``date2DateStr``)."""
    return F.date_format(_c(ts), pattern)


def ms_to_key(ms, pattern: str = MILLI_KEY) -> Column:
    """Epoch milliseconds (number or digit string) -> time key."""
    return F.date_format(F.timestamp_millis(_c(ms).cast("bigint")), pattern)


def key_to_ts(key, pattern: str = MILLI_KEY) -> Column:
    """Time key -> timestamp; null when the key does not match the pattern.

    Spark's formatter cannot parse the 17-digit ``yyyyMMddHHmmssSSS`` form
    (adjacent fraction digits), so that width is split into
    ``yyyyMMddHHmmss.SSS`` first.
    """
    k = _c(key)
    if pattern == MILLI_KEY:
        ok = k.rlike(r"^[0-9]{17}$")
        parsed = F.try_to_timestamp(
            F.concat(F.substring(k, 1, 14), F.lit("."), F.substring(k, 15, 3)),
            F.lit("yyyyMMddHHmmss.SSS"))
        return F.when(ok, parsed)
    digits = sum(1 for ch in pattern if ch.isalpha())
    if pattern.isalpha():
        # all-digit keys must have exactly the pattern's width
        return F.when(k.rlike(rf"^[0-9]{{{digits}}}$"), F.try_to_timestamp(k, F.lit(pattern)))
    return F.try_to_timestamp(k, F.lit(pattern))


def key_to_ms(key, pattern: str = MILLI_KEY) -> Column:
    """Time key -> epoch milliseconds (``dateStr2TimeStemp``)."""
    return F.unix_millis(key_to_ts(key, pattern))


def add_time(key, unit: str, amount: int | Column, pattern: str = MINUTE_KEY) -> Column:
    """Add ``amount`` units to a time key; returns epoch milliseconds.

    Calendar semantics: month and year steps clamp to the month's end
    (Jan 31 + 1 month = Feb 28/29).  An unknown unit leaves the time
    unchanged.
    """
    ts = key_to_ts(key, pattern)
    spark_unit = UNIT_NAMES.get(unit)
    if spark_unit is None:
        return F.unix_millis(ts)
    n = amount if isinstance(amount, Column) else F.lit(int(amount))
    return F.unix_millis(F.timestamp_add(spark_unit, n, ts))


def add_to_key(key, unit: str, amount: int | Column, pattern: str = HOUR_KEY) -> Column:
    """Add units to a key and format the result with the same pattern."""
    return ms_to_key(add_time(key, unit, amount, pattern), pattern)


def week_of_month(d) -> Column:
    """Week of month with weeks starting Sunday and a first week of >= 1 day
    (``Calendar.WEEK_OF_MONTH`` for US / China locales)."""
    c = _c(d)
    return (F.floor((F.dayofmonth(c) + F.dayofweek(F.trunc(F.to_date(c), "MM")) - 2) / 7) + 1
            ).cast("int")


def day_of_week(d) -> Column:
    """Day of week, Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_c(d))


def parse_datetime(x, pattern: str = DATETIME) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> epoch milliseconds (null when malformed)."""
    return F.unix_millis(F.try_to_timestamp(_c(x), F.lit(pattern)))


def format_now(now: datetime | None = None, pattern: str = DATETIME) -> Column:
    """Wall-clock time as text; ``now`` is injectable for reproducible runs."""
    if now is None:
        return F.date_format(F.current_timestamp(), pattern)
    return F.date_format(F.lit(now), pattern)


def now_millis(now: datetime | None = None) -> int:
    """Epoch milliseconds of ``now`` (UTC when naive); wall clock if None."""
    if now is None:
        now = datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    return int(now.timestamp() * 1000)


_PY_PATTERNS = {HOUR_KEY: "%Y%m%d%H", MINUTE_KEY: "%Y%m%d%H%M", DAY_KEY: "%Y%m%d"}


def shift_key(key: str, pattern: str, unit: str, amount: int) -> str:
    """Driver-side twin of ``add_to_key`` for one constant (a window bound).

    Calendar rules as in ``add_time``: month / year steps clamp to month end.
    """
    import calendar
    from datetime import timedelta

    fmt = _PY_PATTERNS[pattern]
    t = datetime.strptime(key, fmt)
    u = UNIT_NAMES.get(unit)
    if u in ("YEAR", "MONTH"):
        months = t.month - 1 + amount * (12 if u == "YEAR" else 1)
        y, m = t.year + months // 12, months % 12 + 1
        t = t.replace(year=y, month=m, day=min(t.day, calendar.monthrange(y, m)[1]))
    elif u is not None:
        step = {"WEEK": timedelta(weeks=1), "DAY": timedelta(days=1),
                "HOUR": timedelta(hours=1), "MINUTE": timedelta(minutes=1),
                "SECOND": timedelta(seconds=1), "MILLISECOND": timedelta(milliseconds=1)}[u]
        t = t + step * amount
    return t.strftime(fmt)
