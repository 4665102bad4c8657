"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the given tables (the click log is derived from
``events``) and covers them whole; window bounds below span the full month
of data unless the window itself is what the operator is about.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwin.functions import records as rec
from clickwin.functions import timekeys as tk
from clickwin.functions.labels import split_labels
from clickwin.operators import cells as cx
from clickwin.operators import counts, topn
from clickwin.operators import upsert as up
from clickwin.operators.batches import write_batches
from clickwin.plans import backfill as bf
from clickwin.plans import incremental as inc
from clickwin.session import scratch_path
from clickwin.sources import clicklog as cl
from clickwin.sources import tables as src
from clickwin.sources.cellstore import CellStore
from clickwin.sources.snapshots import Store, Table
from clickwin.streaming import counts as sc

# Fixed parameters of the registered queries.
START = "2024010100"           # default start (hour key), before the first event
MONTH_END = "2024020100"       # beyond the last event
NOW = datetime(2024, 3, 1)     # injected wall clock for reproducible guards
LAST_EVENING = datetime(2024, 1, 30, 22)

LATENESS = "0 seconds"         # the streams' input is whole in one micro-batch: nothing is late

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _utc(spark):
    # Time keys are read and written in UTC throughout.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _click(spark, sf_dir, start=None, end=None):
    # Window bounds become pushed filters on the stored event time.
    _utc(spark)
    return cl.clicklog(spark, sf_dir, start, end)


def _source(spark, sf_dir):
    """Source factory for the jobs: each window reads only its own slice."""
    return lambda start, end: _click(spark, sf_dir, start, end)


def _cells(spark, sf_dir):
    return cl.cells_from_clicklog(_click(spark, sf_dir))


# -- aggregations -----------------------------------------------------------

@register("dim_pv_window")
def dim_pv_window(spark, sf_dir):
    return counts.dim_pv_window(_click(spark, sf_dir, START, MONTH_END), START, MONTH_END)


@register("label_pv_window")
def label_pv_window(spark, sf_dir):
    return counts.label_pv_window(_click(spark, sf_dir, START, MONTH_END), START, MONTH_END)


@register("label_pv_minute")
def label_pv_minute(spark, sf_dir):
    return counts.label_pv_window(_click(spark, sf_dir, "202401010000", "202402010000"),
                                  "202401010000", "202402010000", null_as_empty=True)


@register("label_pv_day")
def label_pv_day(spark, sf_dir):
    return counts.label_counts_by_day(_click(spark, sf_dir, "20240101", "20240201"),
                                      "20240101", "20240201")


@register("label_pv_all")
def label_pv_all(spark, sf_dir):
    return counts.label_counts(_click(spark, sf_dir))


@register("scan_count")
def scan_count(spark, sf_dir):
    return counts.row_count(_click(spark, sf_dir), "N")


@register("split_labels")
def split_labels_q(spark, sf_dir):
    c = _click(spark, sf_dir)
    return c.select("ID", F.array_join(split_labels("CONTENT_LABEL"), "|").alias("PARTS"),
                    F.size(split_labels("CONTENT_LABEL")).alias("N_PARTS"))


# -- catch-up over all windows ---------------------------------------------

@register("backfill_windows")
def backfill_windows(spark, sf_dir):
    return bf.dim_backfill(_click(spark, sf_dir, START), START, 1, now=NOW)


@register("backfill_labels_5h")
def backfill_labels_5h(spark, sf_dir):
    return bf.label_backfill(_click(spark, sf_dir, START), START, 5, now=NOW)


# -- scans / sources ----------------------------------------------------------

@register("scan_table")
def scan_table(spark, sf_dir):
    events = src.scan_table(spark, cl.table_path(sf_dir, "events"))
    return cl.clicklog_from_events(events)


@register("scan_columns")
def scan_columns(spark, sf_dir):
    return src.scan_columns(_click(spark, sf_dir), ["TIME", "PLATFORM", "PARAM_TYPE",
                                                    "CONTENT_TYPE"])


@register("scan_sql_subquery")
def scan_sql_subquery(spark, sf_dir):
    return src.scan_sql_subquery(
        spark, "SELECT TIME, CONTENT_LABEL FROM clicklog "
               "WHERE TIME >= :s AND TIME < :e AND CONTENT_LABEL IS NOT NULL",
        {"clicklog": _click(spark, sf_dir, START, MONTH_END)}, {"s": START, "e": MONTH_END})


@register("query_with_args")
def query_with_args(spark, sf_dir):
    return src.scan_sql_subquery(
        spark, "SELECT CONTENT_TYPE, count(*) AS N FROM clicklog "
               "WHERE TIME >= ? AND TIME < ? GROUP BY CONTENT_TYPE",
        {"clicklog": _click(spark, sf_dir, START, MONTH_END)}, [START, MONTH_END])


MAP_COLS = ["UDID", "TIME", "CONTENT_TYPE"]


@register("scan_as_maps")
def scan_as_maps(spark, sf_dir):
    return src.scan_as_maps(_click(spark, sf_dir), MAP_COLS, "m").select(rec.map_as_text("m").alias("M"))


@register("scan_key_range")
def scan_key_range(spark, sf_dir):
    return cx.scan_key_range(_cells(spark, sf_dir), "0000", "0100", "info")


@register("scan_key_range_stored")
def scan_key_range_stored(spark, sf_dir):
    # cells stored in sorted key regions: regions outside [start, stop) are not
    # listed, the bounds are pushed to the scan of the others
    store = CellStore(spark, scratch_path(spark, "cells"))
    store.load(_cells(spark, sf_dir), unique=True)
    return store.scan("0000", "0100", "info")


@register("scan_qualifier")
def scan_qualifier(spark, sf_dir):
    return cx.scan_qualifier(_cells(spark, sf_dir), "info", "CONTENT_TYPE")


@register("project_rowkey")
def project_rowkey(spark, sf_dir):
    return cx.project_rowkey(cx.scan_key_range(_cells(spark, sf_dir), "0000", "0100"))


# -- projections / filters -----------------------------------------------------

COPY_COLS = ["ID", "TIME", "PARAM_TYPE", "URL", "TITLE", "CONTENT_TYPE"]


@register("project_columns")
def project_columns(spark, sf_dir):
    return _click(spark, sf_dir).select(*COPY_COLS)


@register("project_alias")
def project_alias(spark, sf_dir):
    return _click(spark, sf_dir).groupBy("CONTENT_TYPE").agg(
        F.count(F.lit(1)).alias("FREQUENCY"), F.max("TIME").alias("maxEndTime"))


@register("filter_time_range")
def filter_time_range(spark, sf_dir):
    return counts.in_window(_click(spark, sf_dir, "2024011000", "2024012000"), "2024011000",
                            "2024012000").select(
        "ID", "TIME")


@register("filter_not_null")
def filter_not_null(spark, sf_dir):
    return _click(spark, sf_dir).where(F.col("CONTENT_LABEL").isNotNull()).select(
        "ID", "CONTENT_LABEL")


@register("filter_in_list")
def filter_in_list(spark, sf_dir):
    return _click(spark, sf_dir).where(F.col("CONTENT_TYPE").isin("click", "view")).select(
        "ID", "UDID", "CONTENT_TYPE")


@register("upper_columns")
def upper_columns(spark, sf_dir):
    return up.upper_columns(cl.load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props"))


# -- cells ---------------------------------------------------------------------

@register("cells_to_map")
def cells_to_map(spark, sf_dir):
    m = cx.cells_to_map(_cells(spark, sf_dir))
    return m.select("rowkey", rec.map_as_text("cells").alias("CELLS"))


@register("filter_cell_count")
def filter_cell_count(spark, sf_dir):
    m = cx.cells_to_map(cx.cells_of_rows_with_n(_cells(spark, sf_dir), 9))
    return m.select("rowkey", rec.map_as_text("cells").alias("CELLS"))


@register("cells_to_wide")
def cells_to_wide(spark, sf_dir):
    m = cx.filter_cell_count(cx.cells_to_map(_cells(spark, sf_dir)), 9)
    return cx.cells_to_wide(m, 9, 14)


def _latest_n_from_cells(spark, sf_dir):
    # J4: key range -> cells to sorted map -> full rows -> wide -> top 3 per
    # device (col8 = UDID) by time (col6 = TIME), ties by col3 = ID.
    cells = cx.scan_key_range(_cells(spark, sf_dir), "0000", None, "info")
    wide = cx.cells_to_wide(cx.cells_to_map(cx.cells_of_rows_with_n(cells, 9)), 9, 14)
    top = topn.latest_n_per_group(wide, "col8", "col6", 3, tie_break="col3")
    return topn.sort_desc(top.select("col1", "col2", "col3", "col6", "col8", "rank"), "col2")


@register("job_latest_n")
def job_latest_n(spark, sf_dir):
    return _latest_n_from_cells(spark, sf_dir)


@register("rows_to_cells")
def rows_to_cells(spark, sf_dir):
    top = _latest_n_from_cells(spark, sf_dir)
    # every column becomes a cell, the row-key column included (as the
    # reference's writer did); col3 (the event id here) is the row key
    keyed = top.withColumn("rank", F.col("rank").cast("string")).withColumn("_rk", F.col("col3"))
    return cx.rows_to_cells(keyed, "_rk", ["col1", "col2", "col3", "col6", "col8", "rank"],
                            "info", null_text="null")


# -- window, sorts, lookups ----------------------------------------------------

@register("latest_n_per_group")
def latest_n_per_group(spark, sf_dir):
    top = topn.latest_n_per_group(_click(spark, sf_dir), "CONTENT_TYPE", "TIME", 3,
                                  tie_break="ID")
    return top.select("CONTENT_TYPE", "TIME", "ID", "rank")


@register("sort_desc")
def sort_desc(spark, sf_dir):
    return topn.sort_desc(_click(spark, sf_dir).select("ID", "TIME"), "TIME", "ID")


@register("top_one")
def top_one(spark, sf_dir):
    return topn.top_one(_click(spark, sf_dir).select("TIME"), "TIME")


@register("limit_n")
def limit_n(spark, sf_dir):
    return topn.limit_n(_click(spark, sf_dir).select("ID", "TIME"), 100, "TIME", "ID")


@register("range_exists")
def range_exists(spark, sf_dir):
    return topn.range_exists(_click(spark, sf_dir, "2024013023", "2024013100"),
                             tk.key_range("TIME", "2024013023", "2024013100"))


def _label_windows(spark, sf_dir):
    return bf.label_backfill(_click(spark, sf_dir, START), START, 5, now=NOW)


@register("max_window_end")
def max_window_end(spark, sf_dir):
    return counts.max_value(_label_windows(spark, sf_dir), "ENDTIME", "MAX_ENDTIME")


@register("lookup_first")
def lookup_first(spark, sf_dir):
    ordered = topn.top_one(_label_windows(spark, sf_dir).select("ENDTIME"), "ENDTIME")
    return topn.lookup_first(ordered, "ENDTIME", "VALUE")


@register("lookup_exactly_one")
def lookup_exactly_one(spark, sf_dir):
    one = _click(spark, sf_dir).where(F.col("CONTENT_TYPE") == "view").select(
        "CONTENT_TYPE").distinct()
    return topn.lookup_exactly_one(one, "CONTENT_TYPE", "VALUE")


# -- time keys -------------------------------------------------------------------

@register("ms_to_key")
def ms_to_key(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    _utc(spark)
    ev = cl.load(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("ID"),
                     tk.ms_to_key(ms.cast("string")).alias("KEY17"),
                     tk.ms_to_key(ms, tk.HOUR_KEY).alias("KEYH"))


@register("ts_to_key")
def ts_to_key(spark, sf_dir):
    _utc(spark)
    ev = cl.load(spark, sf_dir, "events")
    return ev.select(F.col("event_id").cast("string").alias("ID"),
                     tk.ts_to_key("ts", tk.DAY_KEY).alias("K_DAY"),
                     tk.ts_to_key("ts", tk.HOUR_KEY).alias("K_HOUR"),
                     tk.ts_to_key("ts", tk.MINUTE_KEY).alias("K_MINUTE"))


@register("key_to_ms")
def key_to_ms(spark, sf_dir):
    c = _click(spark, sf_dir)
    return c.select("ID", tk.key_to_ms("TIME").alias("MS"),
                    tk.key_to_ms(F.substring("TIME", 1, 10), tk.HOUR_KEY).alias("HOUR_MS"))


@register("key17_to_ts")
def key17_to_ts(spark, sf_dir):
    c = _click(spark, sf_dir)
    return c.select("ID", F.date_format(tk.key_to_ts("TIME"), "yyyy-MM-dd HH:mm:ss.SSS")
                    .alias("TS"))


@register("key_to_ts")
def key_to_ts(spark, sf_dir):
    # strict parse: the 13-digit prefix does not match yyyyMMddHH -> null
    c = _click(spark, sf_dir)
    return c.select("ID",
                    F.date_format(tk.key_to_ts(F.substring("TIME", 1, 10), tk.HOUR_KEY),
                                  "yyyy-MM-dd HH:mm:ss").alias("HOUR_TS"),
                    tk.key_to_ts(F.substring("TIME", 1, 13), tk.HOUR_KEY).isNull()
                    .alias("BAD_IS_NULL"))


def _days(spark, sf_dir):
    return _click(spark, sf_dir).select(
        F.to_date(tk.key_to_ts(F.substring("TIME", 1, 8), tk.DAY_KEY)).alias("D")).distinct()


@register("week_of_month")
def week_of_month(spark, sf_dir):
    return _days(spark, sf_dir).select(F.col("D").cast("string").alias("DAY"),
                                       tk.week_of_month("D").alias("WOM"))


@register("day_of_week")
def day_of_week(spark, sf_dir):
    return _days(spark, sf_dir).select(F.col("D").cast("string").alias("DAY"),
                                       tk.day_of_week("D").alias("DOW"))


@register("add_time_units")
def add_time_units(spark, sf_dir):
    m = _click(spark, sf_dir).select(F.substring("TIME", 1, 12).alias("K")).distinct()
    return m.select("K", *[tk.add_time("K", u, 1).alias(f"PLUS_{u.upper()}")
                           for u in ["YEAR", "MONTH", "DAY", "HOUR", "MIMUE", "SESCOND",
                                     "millisecond", "WEEK", "UNKNOWN"]])


@register("parse_datetime")
def parse_datetime(spark, sf_dir):
    c = _click(spark, sf_dir)
    text = F.date_format(tk.key_to_ts("TIME"), tk.DATETIME)
    return c.select("ID", tk.parse_datetime(text).alias("MS"))


# -- records ---------------------------------------------------------------------

REC_SCHEMA = T.StructType([T.StructField("ID", T.LongType()),
                           T.StructField("UDID", T.StringType()),
                           T.StructField("Platform", T.StringType())])


def _rec_maps(spark, sf_dir):
    c = _click(spark, sf_dir)
    return c.select(F.create_map(F.lit("ID"), F.col("ID"), F.lit("udid"), F.col("UDID"),
                                 F.lit("Platform"), F.col("PLATFORM")).alias("m"))


@register("map_to_struct")
def map_to_struct(spark, sf_dir):
    s_ = rec.map_to_struct("m", REC_SCHEMA)
    return _rec_maps(spark, sf_dir).select(s_.alias("r")).select("r.*")


@register("map_to_struct_ci")
def map_to_struct_ci(spark, sf_dir):
    s_ = rec.map_to_struct_ci("m", REC_SCHEMA)
    return _rec_maps(spark, sf_dir).select(s_.alias("r")).select("r.*")


def _lookups(spark, sf_dir, record):
    """The exactly-one rule on lookups that find no, one and many rows."""
    rows = _rec_maps(spark, sf_dir)
    number = F.col("m")["ID"].cast("bigint")
    least = rows.agg(F.min(number).alias("LEAST"))
    found = {"none": rows.where(number < 0),
             "one": rows.join(least, number == F.col("LEAST"), "left_semi"), "many": rows}
    parts = [topn.lookup_object(df, record).select(F.lit(name).alias("ROWS_FOUND"), "R.*")
             for name, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("lookup_object")
def lookup_object(spark, sf_dir):
    return _lookups(spark, sf_dir, rec.map_to_struct("m", REC_SCHEMA))


@register("lookup_object_ci")
def lookup_object_ci(spark, sf_dir):
    return _lookups(spark, sf_dir, rec.map_to_struct_ci("m", REC_SCHEMA))


@register("struct_to_map")
def struct_to_map(spark, sf_dir):
    c = _click(spark, sf_dir)
    return c.select("ID", rec.map_as_text(rec.struct_to_map(["TIME", "PLATFORM", "TITLE"]))
                    .alias("M"))


@register("struct_to_array")
def struct_to_array(spark, sf_dir):
    c = _click(spark, sf_dir)
    arr = rec.struct_to_array(["UDID", "PLATFORM", "CONTENT_LABEL"])
    return c.select("ID", F.array_join(F.transform(arr, lambda x: F.coalesce(x, F.lit("\\N"))),
                                       "|").alias("A"))


# -- keyed writes ----------------------------------------------------------------

def _old_new(spark, sf_dir):
    old = counts.in_window(_click(spark, sf_dir, None, "2024011600"), None, "2024011600")
    new = counts.in_window(_click(spark, sf_dir, "2024011000", None), "2024011000", None)
    new = new.withColumn(
        "PLATFORM", F.coalesce("PLATFORM", F.lit("web"))).withColumn(
        "TITLE", F.concat("TITLE", F.lit("*")))
    return old, new


@register("upsert_by_key")
def upsert_by_key(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return up.merge_upsert(old, new, ["ID"], dedupe=True, order_desc=["TIME"], one_pass=True)


@register("upsert_partial")
def upsert_partial(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return up.merge_upsert(old, new.select("ID", "TITLE"), ["ID"])


@register("upsert_batch")
def upsert_batch(spark, sf_dir):
    # device-keyed table; the batch repeats keys, the latest write wins
    old, new = _old_new(spark, sf_dir)
    old_latest = up.dedupe_latest(old, ["UDID"], ["TIME", "ID"])
    return up.merge_upsert(old_latest, new, ["UDID"], dedupe=True, order_desc=["TIME", "ID"],
                           one_pass=True)


@register("upsert_positional")
def upsert_positional(spark, sf_dir):
    lc = counts.label_counts(_click(spark, sf_dir), START, MONTH_END)
    tuples = lc.select(F.lit(MONTH_END), F.lit(START), "WORD", "FREQUENCY")
    return up.positional(tuples, ["ENDTIME", "STARTTIME", "WORD", "FREQUENCY"])


@register("upsert_ragged_maps")
def upsert_ragged_maps(spark, sf_dir):
    c = _click(spark, sf_dir)
    maps = src.scan_as_maps(c, cl.CLICK_COLUMNS, "m").select(
        F.col("m")["ID"].alias("ID"), F.map_filter("m", lambda k, v: v.isNotNull()).alias("m"))
    return up.ragged_maps_to_rows(maps, "m", ["ID"])


@register("marker_upsert")
def marker_upsert(spark, sf_dir):
    windows = bf.dim_backfill(_click(spark, sf_dir, START), START, 1, now=NOW)
    marks = windows.select(F.lit("STAT_PARAMTYPE_CONTENTTYPE").alias("TABLE_NAME"),
                           "ENDTIME", "STARTTIME").distinct()
    # half of the markers are there already, with another start
    recorded = marks.where("ENDTIME < '2024011600'").withColumn("STARTTIME", F.lit("old"))
    return up.merge_upsert(recorded, marks, ["TABLE_NAME", "ENDTIME"])


@register("keyed_write_counts")
def keyed_write_counts(spark, sf_dir):
    """Affected rows of an upsert, an update and a delete on one stored table."""
    old, new = _old_new(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "keyed-table"))
    layout = Table(T.StructType(), ("DAY",))
    # clicks of hour 5 have no day: a null partition is one like any other
    day = F.when(F.substring("TIME", 9, 2) != "05", F.substring("TIME", 1, 8)).alias("DAY")
    store.run(lambda tx: tx.upsert("clicks", old.select("*", day), ["ID"], layout))
    counts_ = [store.run(lambda tx: tx.upsert("clicks", new.select("*", day), ["ID"])),
               store.run(lambda tx: tx.rewrite("clicks", F.col("PLATFORM") == "web",
                                               {"TITLE": F.upper("TITLE")})),
               store.run(lambda tx: tx.rewrite("clicks", F.col("CONTENT_TYPE") == "error"))]
    left = store.read("clicks")
    return left.agg(*[F.lit(n).cast("bigint").alias(c) for n, c in
                      zip(counts_, ("UPSERTED", "UPDATED", "DELETED"))],
                    F.count(F.lit(1)).alias("ROWS_LEFT"),
                    F.count_if(F.col("TITLE") == F.upper("TITLE")).alias("UPPER_TITLES"))


@register("upsert_sql_store")
def upsert_sql_store(spark, sf_dir):
    # a SQL statement with bound values, upserted by position into a stored table
    _click(spark, sf_dir).createOrReplaceTempView("clicklog")
    path = scratch_path(spark, "sql-table")
    for bound in ("2024011600", MONTH_END):
        up.upsert_sql(spark, path, "SELECT CONTENT_TYPE, ? AS ENDTIME, count(*) AS FREQUENCY "
                      "FROM clicklog WHERE TIME < ? GROUP BY CONTENT_TYPE", [bound, bound],
                      ["CONTENT_TYPE"])
    return up.read_table(spark, path)


@register("upsert_ragged_store")
def upsert_ragged_store(spark, sf_dir):
    # ragged maps, every key a column, upserted twice into a stored table
    maps = src.scan_as_maps(_click(spark, sf_dir), cl.CLICK_COLUMNS, "m").select(
        F.map_filter("m", lambda k, v: v.isNotNull()).alias("m"))
    path = scratch_path(spark, "ragged-table")
    rows = up.ragged_maps_to_rows(maps, "m", [], union=True)
    for _ in range(2):
        up.write_upsert(spark, path, rows, ["ID"])
    return up.read_table(spark, path).select(*cl.CLICK_COLUMNS)


@register("cells_upsert_store")
def cells_upsert_store(spark, sf_dir):
    # cells stored in key regions; later titles replace earlier ones there
    cells = _cells(spark, sf_dir)
    store = CellStore(spark, scratch_path(spark, "cell-table"))
    store.load(cells, unique=True)                      # events are keyed by ID
    store.upsert(cells.where("qualifier = 'TITLE'").withColumn("value", F.upper("value")),
                 unique=True)
    return store.scan()


@register("upsert_batches_store")
def upsert_batches_store(spark, sf_dir):
    """Device-keyed table written in numbered batches of about ten days, each
    committed on its own; AFFECTED is the count that the job reports."""
    store = Store(spark, scratch_path(spark, "batch-table"))
    rows = _click(spark, sf_dir).select("UDID", "ID", "TIME", "TITLE")
    affected = write_batches(store, "devices", rows, ["UDID"], "load",
                             F.ceil(F.substring("TIME", 7, 2).cast("int") / 11),
                             ["TIME", "ID"], require=F.col("ID").isNotNull())
    return store.read("devices").withColumn("AFFECTED", F.lit(affected).cast("bigint"))


@register("delete_where")
def delete_where(spark, sf_dir):
    c = _click(spark, sf_dir).select("ID", "CONTENT_TYPE", "PLATFORM")
    return up.delete_where(c, F.col("CONTENT_TYPE") == "error")


@register("update_where")
def update_where(spark, sf_dir):
    c = _click(spark, sf_dir).select("ID", "PLATFORM", "TITLE")
    return up.update_where(c, {"PLATFORM": F.lit("web"), "TITLE": F.upper("TITLE")},
                           F.col("PLATFORM").isNull())


# -- incremental control ---------------------------------------------------------

@register("next_window_hour")
def next_window_hour(spark, sf_dir):
    recorded = bf.dim_backfill(_click(spark, sf_dir, START), START, 1, now=NOW)
    return inc.next_window(spark, recorded, 1, "HOUR", tk.HOUR_KEY, START, NOW, "start")


@register("next_window_minute")
def next_window_minute(spark, sf_dir):
    recorded = _click(spark, sf_dir).select(F.substring("TIME", 1, 12).alias("ENDTIME"))
    return inc.next_window(spark, recorded, 10, "MIMUE", tk.MINUTE_KEY, "202401010000", NOW,
                           "end")


@register("window_ready")
def window_ready(spark, sf_dir):
    return inc.window_ready(_source(spark, sf_dir), "2024011600", tk.HOUR_KEY, "next_hour")


def _run_job(spark, sf_dir, kind):
    root = scratch_path(spark, f"job-{kind}")
    store = inc.label_store(root) if kind == "label" else inc.dim_store(root)
    click = _source(spark, sf_dir)
    for _ in range(2):  # second launch stops at the gate (no data after the month)
        inc.run_window_job(spark, click, store, kind, 360, now=NOW, default_start=START)
    res = store.results(spark)
    return res.select("ENDTIME", "STARTTIME", *[c for c in res.columns
                                                if c not in ("ENDTIME", "STARTTIME")])


@register("job_label_pv")
def job_label_pv(spark, sf_dir):
    return _run_job(spark, sf_dir, "label")


@register("job_label_hourly")
def job_label_hourly(spark, sf_dir):
    # the catch-up does the month up to its last evening with data, hourly launches the rest
    store = inc.label_store(scratch_path(spark, "job-label-hourly"))
    inc.run_catch_up(spark, _source(spark, sf_dir), store, "label", 1, now=LAST_EVENING,
                     default_start=START, gate="any_later")
    while inc.run_window_job(spark, _source(spark, sf_dir), store, "label", 1, now=NOW,
                             default_start=START, gate="any_later")["status"] == "done":
        pass
    return store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY")


@register("job_label_minute")
def job_label_minute(spark, sf_dir):
    # the minute-grain job: null labels count as the empty one, guard on the window's end;
    # windows of a week until the gate closes
    store = inc.label_store(scratch_path(spark, "job-label-minute"))
    while inc.run_window_job(spark, _source(spark, sf_dir), store, "label", 7 * 24 * 60, now=NOW,
                             default_start="202401010000", gate="any_later", unit="MIMUE",
                             pattern=tk.MINUTE_KEY, guard="end",
                             null_as_empty=True)["status"] == "done":
        pass
    return store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY")


@register("job_dim_pv")
def job_dim_pv(spark, sf_dir):
    return _run_job(spark, sf_dir, "dim")


@register("job_label_pv_stored")
def job_label_pv_stored(spark, sf_dir):
    # the same two launches against a log stored by day: every window read
    # and gate probe prunes to the day folders it needs
    log = scratch_path(spark, "daylog")
    cl.write_clicklog(_click(spark, sf_dir), log)
    root = scratch_path(spark, "job-label-stored")
    store = inc.label_store(root)
    for _ in range(2):
        inc.run_window_job(spark, lambda s, e: cl.read_clicklog(spark, log, s, e), store,
                           "label", 360, now=NOW, default_start=START)
    return store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY")


@register("job_catch_up")
def job_catch_up(spark, sf_dir):
    # scheduler-style catch-up: the first run does every ready 5-hour window
    # in one pass, the second finds the next window not ready yet
    store = inc.label_store(scratch_path(spark, "job-catch-up"))
    for _ in range(2):
        inc.run_catch_up(spark, _source(spark, sf_dir), store, "label", 5, now=NOW,
                         default_start=START)
    return store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY")


@register("job_copy_window")
def job_copy_window(spark, sf_dir):
    dst = scratch_path(spark, "copy")
    inc.copy_window(spark, _source(spark, sf_dir), dst, COPY_COLS, START, MONTH_END,
                    unique=True)        # events are keyed by ID
    return up.read_table(spark, dst, [cl.DAY_PARTITION]).select(*COPY_COLS)


# -- streaming -------------------------------------------------------------------

def _run_stream(spark, sf_dir, kind):
    _utc(spark)
    events = sc.event_stream(spark, cl.table_path(sf_dir, "events"))
    df = (sc.stream_label_counts(events, delay=LATENESS) if kind == "label"
          else sc.stream_dim_counts(events, delay=LATENESS))
    sink = scratch_path(spark, f"stream-{kind}")
    q = sc.start_to_parquet(df, sink, sink + "-checkpoint")
    q.awaitTermination()
    return spark.read.parquet(sink)


@register("stream_label_pv")
def stream_label_pv(spark, sf_dir):
    return _run_stream(spark, sf_dir, "label")


@register("stream_dim_pv")
def stream_dim_pv(spark, sf_dir):
    return _run_stream(spark, sf_dir, "dim")


@register("stream_label_store")
def stream_label_store(spark, sf_dir):
    # the stream writes closed windows into the label job's keyed store
    _utc(spark)
    events = sc.event_stream(spark, cl.table_path(sf_dir, "events"))
    store = inc.label_store(scratch_path(spark, "stream-store"))
    sc.start_to_store(sc.stream_label_counts(events, delay=LATENESS), store,
                      scratch_path(spark, "stream-store-checkpoint")).awaitTermination()
    return store.results(spark).select("ENDTIME", "STARTTIME", "WORD", "FREQUENCY")
