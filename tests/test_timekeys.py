import calendar
import datetime as dt

from pyspark.sql import functions as F

from clickwin.functions import timekeys as tk


def _ms_to_key17(ms):
    t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)
    return t.strftime("%Y%m%d%H%M%S") + f"{t.microsecond // 1000:03d}"


def test_add_time_units_from_reference_inputs(spark):
    # 20180101000000000 plus one of each unit (17-digit default pattern)
    want = {"YEAR": "20190101000000000", "MONTH": "20180201000000000",
            "DAY": "20180102000000000", "HOUR": "20180101010000000",
            "MIMUE": "20180101000100000", "SESCOND": "20180101000001000",
            "millisecond": "20180101000000001", "WEEK": "20180108000000000",
            "BOGUS": "20180101000000000"}
    df = spark.range(1).select(*[tk.add_time(F.lit("20180101000000000"), u, 1, tk.MILLI_KEY)
                                 .alias(u) for u in want])
    row = df.first().asDict()
    assert {u: _ms_to_key17(v) for u, v in row.items()} == want


def test_month_end_clamp(spark):
    df = spark.range(1).select(
        tk.add_to_key(F.lit("2024013112"), "MONTH", 1).alias("a"),
        tk.add_to_key(F.lit("2023013112"), "MONTH", 1).alias("b"),
        tk.add_to_key(F.lit("2024022912"), "YEAR", 1).alias("c"))
    assert tuple(df.first()) == ("2024022912", "2023022812", "2025022812")
    assert tk.shift_key("2024013112", tk.HOUR_KEY, "MONTH", 1) == "2024022912"
    assert tk.shift_key("2024022912", tk.HOUR_KEY, "YEAR", 1) == "2025022812"
    assert tk.shift_key("2024013123", tk.HOUR_KEY, "HOUR", 1) == "2024020100"


def test_strict_parse(spark):
    df = spark.createDataFrame([("2018093025",), ("2018100101",), ("201810010",),
                                ("20181001010000000",), ("2018x001010000000",)], "k string")
    out = df.select("k", tk.key_to_ts("k", tk.HOUR_KEY).isNull().alias("bad_h"),
                    tk.key_to_ts("k").isNull().alias("bad_17")).collect()
    got = {r["k"]: (r["bad_h"], r["bad_17"]) for r in out}
    assert got["2018093025"][0] is True          # hour 25: lenient parsers roll over
    assert got["2018100101"][0] is False
    assert got["201810010"][0] is True
    assert got["20181001010000000"] == (True, False)
    assert got["2018x001010000000"][1] is True


def test_round_trip_17_digits(spark):
    df = spark.createDataFrame([("20240131235959999",), ("20240101000000000",)], "k string")
    out = df.select("k", tk.ms_to_key(tk.key_to_ms("k")).alias("back")).collect()
    assert all(r["k"] == r["back"] for r in out)


def _week_of_month_us(d: dt.date) -> int:
    # Calendar.WEEK_OF_MONTH, first day Sunday, minimal days in first week 1
    first_dow = (dt.date(d.year, d.month, 1).weekday() + 1) % 7  # Sunday = 0
    return (d.day + first_dow - 1) // 7 + 1


def test_week_of_month_and_day_of_week(spark):
    days = [dt.date(2018, 1, 1) + dt.timedelta(days=i) for i in range(0, 731, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = df.select("d", tk.week_of_month("d").alias("w"), tk.day_of_week("d").alias("dw"))
    for r in out.collect():
        assert r["w"] == _week_of_month_us(r["d"]), r["d"]
        assert r["dw"] == (r["d"].weekday() + 1) % 7 + 1
    assert calendar.SUNDAY == 6  # sanity: python weekday() Monday=0


def test_parse_datetime_and_ranges(spark):
    df = spark.createDataFrame([("2018-09-27 16:00:00",), ("bad",)], "x string")
    got = [r[0] for r in df.select(tk.parse_datetime("x")).collect()]
    assert got[0] == int(dt.datetime(2018, 9, 27, 16, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert got[1] is None
    keys = spark.createDataFrame([("20181001005959999",), ("20181001010000000",),
                                  ("20181001015959999",), ("20181001020000000",)], "t string")
    kept = [r[0] for r in keys.where(tk.key_range("t", "2018100101", "2018100102")).collect()]
    assert kept == ["20181001010000000", "20181001015959999"]


def test_format_now_takes_the_given_clock(spark):
    import datetime as dt
    row = spark.range(1).select(tk.format_now(dt.datetime(2024, 3, 1, 4, 5, 6)).alias("t")).first()
    assert row["t"] == "2024-03-01 04:05:06"
