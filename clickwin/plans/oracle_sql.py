"""DuckDB SQL equal to each registered query (the correctness oracle).

The tables ``events`` etc. are registered as views by the checker; every
statement re-derives the click log from ``events`` in a CTE so that both
engines start from the same given table.
"""

from __future__ import annotations

CLICKLOG_SQL = """
SELECT CAST(event_id AS VARCHAR) AS ID,
       strftime(ts, '%Y%m%d%H%M%S%g') AS TIME,
       lpad(CAST(user_id AS VARCHAR), CAST(greatest(len(CAST(user_id AS VARCHAR)), 4) AS INTEGER), '0') AS UDID,
       CASE user_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' END AS PLATFORM,
       concat('p', CAST(event_id % 4 AS VARCHAR)) AS PARAM_TYPE,
       event_type AS CONTENT_TYPE,
       concat('/', event_type, '/', CAST(user_id AS VARCHAR)) AS URL,
       concat(event_type, '-', CAST(event_id AS VARCHAR)) AS TITLE,
       CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ','
            WHEN 3 THEN concat(event_type, ',,') WHEN 4 THEN concat(',', event_type)
            ELSE concat(event_type, ',u', CAST(user_id % 10 AS VARCHAR), ',', event_type) END
         AS CONTENT_LABEL
FROM events
"""

# Java-style comma split (trailing empties dropped, '' -> [''], ',,' -> []).
def java_split(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^,+$') THEN []::VARCHAR[] "
            f"ELSE string_split(regexp_replace({x}, ',+$', ''), ',') END")


def with_clicklog(body: str, extra_ctes: str = "") -> str:
    ctes = f"clicklog AS ({CLICKLOG_SQL})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def label_count_sql(where: str, null_as_empty: bool = False) -> str:
    lab = "coalesce(CONTENT_LABEL, '')" if null_as_empty else "CONTENT_LABEL"
    nn = "" if null_as_empty else " AND CONTENT_LABEL IS NOT NULL"
    return (f"SELECT w AS WORD, CAST(count(*) AS BIGINT) AS FREQUENCY FROM ("
            f"SELECT unnest({java_split(lab)}) AS w FROM clicklog WHERE {where}{nn}) s "
            f"GROUP BY w")


START = "2024010100"
START_TS = "TIMESTAMP '2024-01-01 00:00:00'"
MONTH_END = "2024020100"


def tag(end: str, start: str, body: str, cols: str = "*") -> str:
    return f"SELECT '{end}' AS ENDTIME, '{start}' AS STARTTIME, {cols} FROM ({body}) t"


DIMS = "PLATFORM, PARAM_TYPE, CONTENT_TYPE"


def _hour_key(expr: str) -> str:
    return f"strftime({START_TS} + to_hours(CAST({expr} AS BIGINT)), '%Y%m%d%H')"


def backfill_sql(h: int, key_select: str, keys: str, hourly_from: str) -> str:
    """All ready windows of ``h`` hours from START (gate: data in the next hour)."""
    ctes = f"""
hours AS (SELECT DISTINCT CAST((epoch_ms(strptime(substr(TIME, 1, 10), '%Y%m%d%H'))
                   - epoch_ms({START_TS})) // 3600000 AS BIGINT) AS K
          FROM clicklog WHERE TIME >= '{START}'),
ready AS (SELECT DISTINCT K // {h} - 1 AS I FROM hours WHERE K % {h} = 0 AND K >= {h}),
cand AS (SELECT I + 1 AS I FROM ready UNION ALL SELECT 0 AS I),
ff AS (SELECT min(I) AS F FROM cand WHERE I NOT IN (SELECT I FROM ready)),
rows_k AS (SELECT CAST((epoch_ms(strptime(substr(TIME, 1, 10), '%Y%m%d%H'))
                   - epoch_ms({START_TS})) // 3600000 AS BIGINT) AS K, {key_select}
           FROM {hourly_from} WHERE TIME >= '{START}')"""
    body = f"""
SELECT {_hour_key(f'(W + 1) * {h}')} AS ENDTIME, {_hour_key(f'W * {h}')} AS STARTTIME,
       {keys}, CAST(FREQUENCY AS BIGINT) AS FREQUENCY
FROM (SELECT K // {h} AS W, {keys}, count(*) AS FREQUENCY FROM rows_k
      WHERE K >= 0 AND K // {h} < (SELECT F FROM ff) GROUP BY ALL) x"""
    return with_clicklog(body, ctes)


SQL: dict[str, str] = {}

SQL["dim_pv_window"] = with_clicklog(tag(
    MONTH_END, START,
    f"SELECT {DIMS}, CAST(count(*) AS BIGINT) AS FREQUENCY FROM clicklog "
    f"WHERE TIME >= '{START}' AND TIME < '{MONTH_END}' GROUP BY ALL"))

SQL["label_pv_window"] = with_clicklog(tag(
    MONTH_END, START, label_count_sql(f"TIME >= '{START}' AND TIME < '{MONTH_END}'")))

SQL["label_pv_minute"] = with_clicklog(tag(
    "202402010000", "202401010000",
    label_count_sql("TIME >= '202401010000' AND TIME < '202402010000'", null_as_empty=True)))

SQL["label_pv_day"] = with_clicklog(
    "SELECT DAY AS TIME, w AS WORD, CAST(count(*) AS BIGINT) AS FREQUENCY FROM ("
    f"SELECT substr(TIME, 1, 8) AS DAY, unnest({java_split('CONTENT_LABEL')}) AS w FROM clicklog "
    "WHERE TIME >= '20240101' AND TIME < '20240201' AND CONTENT_LABEL IS NOT NULL) s GROUP BY ALL")

SQL["label_pv_all"] = with_clicklog(label_count_sql("TRUE"))

SQL["scan_count"] = with_clicklog("SELECT CAST(count(*) AS BIGINT) AS N FROM clicklog")

SQL["split_labels"] = with_clicklog(
    f"SELECT ID, array_to_string({java_split('CONTENT_LABEL')}, '|') AS PARTS, "
    f"CAST(len({java_split('CONTENT_LABEL')}) AS INTEGER) AS N_PARTS FROM clicklog")

SQL["backfill_windows"] = backfill_sql(1, DIMS, DIMS, "clicklog")

SQL["backfill_labels_5h"] = backfill_sql(
    5, "WORD", "WORD",
    f"(SELECT TIME, unnest({java_split('CONTENT_LABEL')}) AS WORD FROM clicklog "
    f"WHERE CONTENT_LABEL IS NOT NULL) lw")

# -- cells ---------------------------------------------------------------------

CELL_COLS = "ID, TIME, UDID, PLATFORM, PARAM_TYPE, CONTENT_TYPE, URL, TITLE, CONTENT_LABEL"
CELLS_CTE = f"""cells AS (
  SELECT rowkey, 'info' AS family, qualifier, value FROM (
    UNPIVOT (SELECT concat(UDID, '_', TIME, '_', ID) AS rowkey, {CELL_COLS} FROM clicklog)
    ON {CELL_COLS} INTO NAME qualifier VALUE value))"""


def with_cells(body: str, extra: str = "") -> str:
    return with_clicklog(body, CELLS_CTE + (",\n" + extra if extra else ""))


MAP_TEXT = "string_agg(qualifier || '=' || coalesce(value, '\\N'), ';' ORDER BY qualifier)"
WIDE = ", ".join([f"v[{min(i, 8) + 1}] AS col{i + 1}" for i in range(14)])
WIDE_CTE = ("wide AS (SELECT " + WIDE + " FROM (SELECT rowkey, list(value ORDER BY qualifier) AS v"
            " FROM cells WHERE rowkey >= '{lo}' AND rowkey < '{hi}' AND family = 'info'"
            " GROUP BY rowkey HAVING count(*) = 9) x)")
LATEST_CTE = ("top AS (SELECT col1, col2, col3, col6, col8, rank FROM ("
              "SELECT *, CAST(row_number() OVER (PARTITION BY col8 ORDER BY col6 DESC, col3)"
              " AS INTEGER) AS rank FROM wide) y WHERE rank <= 3)")

SQL["scan_table"] = with_clicklog("SELECT * FROM clicklog")
SQL["scan_columns"] = with_clicklog(
    "SELECT TIME, PLATFORM, PARAM_TYPE, CONTENT_TYPE FROM clicklog")
SQL["scan_sql_subquery"] = with_clicklog(
    f"SELECT TIME, CONTENT_LABEL FROM clicklog WHERE TIME >= '{START}' "
    f"AND TIME < '{MONTH_END}' AND CONTENT_LABEL IS NOT NULL")
SQL["query_with_args"] = with_clicklog(
    f"SELECT CONTENT_TYPE, CAST(count(*) AS BIGINT) AS N FROM clicklog WHERE TIME >= '{START}' "
    f"AND TIME < '{MONTH_END}' GROUP BY CONTENT_TYPE")
SQL["scan_as_maps"] = with_clicklog(
    "SELECT 'CONTENT_TYPE=' || coalesce(CONTENT_TYPE, '\\N') || ';TIME=' || coalesce(TIME, '\\N')"
    " || ';UDID=' || coalesce(UDID, '\\N') AS M FROM clicklog")
SQL["scan_key_range"] = with_cells(
    "SELECT * FROM cells WHERE rowkey >= '0000' AND rowkey < '0100' AND family = 'info'")
SQL["scan_qualifier"] = with_cells(
    "SELECT * FROM cells WHERE family = 'info' AND qualifier = 'CONTENT_TYPE'")
SQL["project_rowkey"] = with_cells(
    "SELECT DISTINCT rowkey FROM cells WHERE rowkey >= '0000' AND rowkey < '0100' "
    "AND family = 'info'")

SQL["project_columns"] = with_clicklog(
    "SELECT ID, TIME, PARAM_TYPE, URL, TITLE, CONTENT_TYPE FROM clicklog")
SQL["project_alias"] = with_clicklog(
    'SELECT CONTENT_TYPE, CAST(count(*) AS BIGINT) AS FREQUENCY, max(TIME) AS "maxEndTime" '
    "FROM clicklog GROUP BY CONTENT_TYPE")
SQL["filter_time_range"] = with_clicklog(
    "SELECT ID, TIME FROM clicklog WHERE TIME >= '2024011000' AND TIME < '2024012000'")
SQL["filter_not_null"] = with_clicklog(
    "SELECT ID, CONTENT_LABEL FROM clicklog WHERE CONTENT_LABEL IS NOT NULL")
SQL["filter_in_list"] = with_clicklog(
    "SELECT ID, UDID, CONTENT_TYPE FROM clicklog WHERE CONTENT_TYPE IN ('click', 'view')")
SQL["upper_columns"] = ("SELECT event_id AS EVENT_ID, user_id AS USER_ID, event_type AS EVENT_TYPE,"
                        " value AS VALUE, props AS PROPS FROM events")

SQL["cells_to_map"] = with_cells(f"SELECT rowkey, {MAP_TEXT} AS CELLS FROM cells GROUP BY rowkey")
SQL["filter_cell_count"] = with_cells(
    f"SELECT rowkey, {MAP_TEXT} AS CELLS FROM cells GROUP BY rowkey HAVING count(*) = 9")
SQL["cells_to_wide"] = with_cells("SELECT * FROM wide", WIDE_CTE.format(lo="", hi="~"))
SQL["job_latest_n"] = with_cells(
    "SELECT * FROM top", WIDE_CTE.format(lo="0000", hi="~") + ",\n" + LATEST_CTE)
SQL["rows_to_cells"] = with_cells(
    "SELECT rowkey, 'info' AS family, qualifier, coalesce(value, 'null') AS value FROM ("
    "SELECT col3 AS rowkey, col1, col2, col3, col6, col8, CAST(rank AS VARCHAR) AS rank FROM top)"
    " UNPIVOT INCLUDE NULLS (value FOR qualifier IN (col1, col2, col3, col6, col8, rank))",
    WIDE_CTE.format(lo="0000", hi="~") + ",\n" + LATEST_CTE)

# -- window, sorts, lookups ----------------------------------------------------

SQL["latest_n_per_group"] = with_clicklog(
    "SELECT CONTENT_TYPE, TIME, ID, rank FROM (SELECT CONTENT_TYPE, TIME, ID, "
    "CAST(row_number() OVER (PARTITION BY CONTENT_TYPE ORDER BY TIME DESC, ID) AS INTEGER) "
    "AS rank FROM clicklog) t WHERE rank <= 3")
SQL["sort_desc"] = with_clicklog("SELECT ID, TIME FROM clicklog ORDER BY TIME DESC, ID")
SQL["top_one"] = with_clicklog("SELECT TIME FROM clicklog ORDER BY TIME DESC LIMIT 1")
SQL["limit_n"] = with_clicklog("SELECT ID, TIME FROM clicklog ORDER BY TIME, ID LIMIT 100")
SQL["range_exists"] = with_clicklog(
    "SELECT count(*) > 0 AS \"EXISTS\" FROM clicklog "
    "WHERE TIME >= '2024013023' AND TIME < '2024013100'")

LABEL_5H = backfill_sql(
    5, "WORD", "WORD",
    f"(SELECT TIME, unnest({java_split('CONTENT_LABEL')}) AS WORD FROM clicklog "
    f"WHERE CONTENT_LABEL IS NOT NULL) lw")
DIM_1H = backfill_sql(1, DIMS, DIMS, "clicklog")

SQL["max_window_end"] = f"SELECT max(ENDTIME) AS MAX_ENDTIME FROM ({LABEL_5H}) b"
SQL["lookup_first"] = f"SELECT max(ENDTIME) AS VALUE FROM ({LABEL_5H}) b"
SQL["lookup_exactly_one"] = with_clicklog(
    "SELECT CASE WHEN count(*) = 1 THEN min(CONTENT_TYPE) END AS VALUE FROM "
    "(SELECT DISTINCT CONTENT_TYPE FROM clicklog WHERE CONTENT_TYPE = 'view') t")

# -- time keys -------------------------------------------------------------------

TS17 = ("(strptime(substr(TIME, 1, 14), '%Y%m%d%H%M%S') "
        "+ to_milliseconds(CAST(substr(TIME, 15, 3) AS BIGINT)))")
SQL["ms_to_key"] = (
    "SELECT CAST(event_id AS VARCHAR) AS ID, "
    "strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y%m%d%H%M%S%g') AS KEY17, "
    "strftime(make_timestamp(epoch_us(ts) // 1000 * 1000), '%Y%m%d%H') AS KEYH FROM events")
SQL["ts_to_key"] = (
    "SELECT CAST(event_id AS VARCHAR) AS ID, strftime(ts, '%Y%m%d') AS K_DAY, "
    "strftime(ts, '%Y%m%d%H') AS K_HOUR, strftime(ts, '%Y%m%d%H%M') AS K_MINUTE FROM events")
SQL["key_to_ms"] = with_clicklog(
    f"SELECT ID, epoch_ms({TS17}) AS MS, "
    "epoch_ms(strptime(substr(TIME, 1, 10), '%Y%m%d%H')) AS HOUR_MS FROM clicklog")
SQL["key17_to_ts"] = with_clicklog(
    f"SELECT ID, strftime({TS17}, '%Y-%m-%d %H:%M:%S.%g') AS TS FROM clicklog")
SQL["key_to_ts"] = with_clicklog(
    "SELECT ID, strftime(strptime(substr(TIME, 1, 10), '%Y%m%d%H'), '%Y-%m-%d %H:%M:%S') "
    "AS HOUR_TS, try_strptime(substr(TIME, 1, 13), '%Y%m%d%H') IS NULL AS BAD_IS_NULL "
    "FROM clicklog")
DAYS = ("(SELECT DISTINCT CAST(strptime(substr(TIME, 1, 8), '%Y%m%d') AS DATE) AS D "
        "FROM clicklog) d")
SQL["week_of_month"] = with_clicklog(
    "SELECT CAST(D AS VARCHAR) AS DAY, CAST(floor((day(D) + (dayofweek(date_trunc('month', D))"
    f" + 1) - 2) / 7) + 1 AS INTEGER) AS WOM FROM {DAYS}")
SQL["day_of_week"] = with_clicklog(
    f"SELECT CAST(D AS VARCHAR) AS DAY, CAST(dayofweek(D) + 1 AS INTEGER) AS DOW FROM {DAYS}")
_UNITS = [("YEAR", "INTERVAL 1 YEAR"), ("MONTH", "INTERVAL 1 MONTH"), ("DAY", "INTERVAL 1 DAY"),
          ("HOUR", "INTERVAL 1 HOUR"), ("MIMUE", "INTERVAL 1 MINUTE"),
          ("SESCOND", "INTERVAL 1 SECOND"), ("MILLISECOND", "INTERVAL 1 MILLISECOND"),
          ("WEEK", "INTERVAL 7 DAY"), ("UNKNOWN", "INTERVAL 0 SECOND")]
SQL["add_time_units"] = with_clicklog(
    "SELECT K, " + ", ".join(f"epoch_ms(strptime(K, '%Y%m%d%H%M') + {iv}) AS PLUS_{u}"
                             for u, iv in _UNITS)
    + " FROM (SELECT DISTINCT substr(TIME, 1, 12) AS K FROM clicklog) k")
SQL["parse_datetime"] = with_clicklog(
    "SELECT ID, epoch_ms(strptime(substr(TIME, 1, 14), '%Y%m%d%H%M%S')) AS MS FROM clicklog")

# -- records ---------------------------------------------------------------------

SQL["map_to_struct"] = with_clicklog(
    'SELECT CAST(ID AS BIGINT) AS ID, CAST(NULL AS VARCHAR) AS UDID, PLATFORM AS "Platform" '
    "FROM clicklog")
SQL["map_to_struct_ci"] = with_clicklog(
    'SELECT CAST(ID AS BIGINT) AS ID, UDID, PLATFORM AS "Platform" FROM clicklog')
SQL["struct_to_map"] = with_clicklog(
    "SELECT ID, 'PLATFORM=' || coalesce(PLATFORM, '\\N') || ';TIME=' || coalesce(TIME, '\\N')"
    " || ';TITLE=' || coalesce(TITLE, '\\N') AS M FROM clicklog")
SQL["struct_to_array"] = with_clicklog(
    "SELECT ID, coalesce(UDID, '\\N') || '|' || coalesce(PLATFORM, '\\N') || '|' || "
    "coalesce(CONTENT_LABEL, '\\N') AS A FROM clicklog")

# -- keyed writes ----------------------------------------------------------------

ALL_COLS = CELL_COLS.split(", ")
OLD_NEW = ("o AS (SELECT * FROM clicklog WHERE TIME < '2024011600'),\n"
           "n0 AS (SELECT ID, TIME, UDID, coalesce(PLATFORM, 'web') AS PLATFORM, PARAM_TYPE, "
           "CONTENT_TYPE, URL, concat(TITLE, '*') AS TITLE, CONTENT_LABEL FROM clicklog "
           "WHERE TIME >= '2024011000')")


def _merge(cols_new: list[str], key: str, o: str = "o", n: str = "n") -> str:
    sel = ", ".join(
        f"CASE WHEN {n}.nw THEN {n}.{c} ELSE {o}.{c} END AS {c}" if c in cols_new
        else f"{o}.{c} AS {c}" for c in ALL_COLS)
    return f"SELECT {sel} FROM {o} FULL OUTER JOIN {n} ON {o}.{key} IS NOT DISTINCT FROM {n}.{key}"


SQL["upsert_by_key"] = with_clicklog(
    _merge(ALL_COLS, "ID"), OLD_NEW + ",\nn AS (SELECT *, TRUE AS nw FROM n0)")
SQL["upsert_partial"] = with_clicklog(
    _merge(["ID", "TITLE"], "ID"), OLD_NEW + ",\nn AS (SELECT ID, TITLE, TRUE AS nw FROM n0)")
_LATEST = ("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY UDID "
           "ORDER BY TIME DESC NULLS LAST, ID DESC NULLS LAST) AS rn FROM {t}) x WHERE rn = 1")
SQL["upsert_batch"] = with_clicklog(
    _merge(ALL_COLS, "UDID", "ol", "n"),
    OLD_NEW + ",\nol AS (" + _LATEST.format(t="o") + "),\nn AS (SELECT *, TRUE AS nw FROM ("
    + _LATEST.format(t="n0") + ") z)")
SQL["upsert_positional"] = with_clicklog(tag(
    MONTH_END, START, label_count_sql(f"TIME >= '{START}' AND TIME < '{MONTH_END}'")))
_NN = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in ALL_COLS)
SQL["upsert_ragged_maps"] = with_clicklog(
    "SELECT " + ", ".join(f"CASE WHEN (SELECT {c} IS NOT NULL FROM w) THEN {c} END AS {c}"
                          for c in ALL_COLS) + " FROM clicklog",
    f"w AS (SELECT * FROM clicklog ORDER BY {_NN} DESC, ID LIMIT 1)")
SQL["marker_upsert"] = (
    "SELECT 'STAT_PARAMTYPE_CONTENTTYPE' AS TABLE_NAME, ENDTIME, STARTTIME "
    f"FROM ({DIM_1H}) b GROUP BY ENDTIME, STARTTIME")
SQL["delete_where"] = with_clicklog(
    "SELECT ID, CONTENT_TYPE, PLATFORM FROM clicklog WHERE NOT coalesce(CONTENT_TYPE = 'error', "
    "FALSE)")
SQL["update_where"] = with_clicklog(
    "SELECT ID, CASE WHEN PLATFORM IS NULL THEN 'web' ELSE PLATFORM END AS PLATFORM, "
    "CASE WHEN PLATFORM IS NULL THEN upper(TITLE) ELSE TITLE END AS TITLE FROM clicklog")

# -- incremental control ---------------------------------------------------------

NOW_MS = "epoch_ms(TIMESTAMP '2024-03-01 00:00:00')"
SQL["next_window_hour"] = (
    "SELECT M AS STARTTIME, strftime(strptime(M, '%Y%m%d%H') + INTERVAL 1 HOUR, '%Y%m%d%H') "
    f"AS ENDTIME, CASE WHEN {NOW_MS} - epoch_ms(strptime(M, '%Y%m%d%H')) < 3600000 "
    "THEN 'caught_up' ELSE 'run' END AS STATUS FROM (SELECT coalesce(max(ENDTIME), "
    f"'{START}') AS M FROM ({DIM_1H}) b) m")
SQL["next_window_minute"] = with_clicklog(
    "SELECT M AS STARTTIME, strftime(strptime(M, '%Y%m%d%H%M') + INTERVAL 10 MINUTE, "
    f"'%Y%m%d%H%M') AS ENDTIME, CASE WHEN {NOW_MS} < epoch_ms(strptime(M, '%Y%m%d%H%M') "
    "+ INTERVAL 10 MINUTE) THEN 'caught_up' ELSE 'run' END AS STATUS FROM (SELECT "
    "coalesce(max(substr(TIME, 1, 12)), '202401010000') AS M FROM clicklog) m")
SQL["window_ready"] = with_clicklog(
    "SELECT count(*) > 0 AS READY FROM clicklog WHERE TIME >= '2024011600' "
    "AND TIME < '2024011601'")


def _two_launches(select_window: str) -> str:
    """Launch 1 runs [S, S+360h) if hour S+360h has data; launch 2 runs the
    next 360 hours if launch 1 ran and hour S+720h has data."""
    w1 = ("2024010100", "2024011600")
    w2 = ("2024011600", "2024013100")

    def ready(end):
        nxt = end[:8] + "01"
        return (f"EXISTS (SELECT 1 FROM clicklog WHERE TIME >= '{end}' "
                f"AND TIME < '{nxt}')")
    p1 = tag(w1[1], w1[0], select_window.format(s=w1[0], e=w1[1]))
    p2 = tag(w2[1], w2[0], select_window.format(s=w2[0], e=w2[1]))
    return with_clicklog(f"SELECT * FROM ({p1}) a WHERE {ready(w1[1])} UNION ALL "
                         f"SELECT * FROM ({p2}) b WHERE {ready(w1[1])} AND {ready(w2[1])}")


SQL["job_label_pv"] = _two_launches(label_count_sql("TIME >= '{s}' AND TIME < '{e}'"))
SQL["job_dim_pv"] = _two_launches(
    f"SELECT {DIMS}, CAST(count(*) AS BIGINT) AS FREQUENCY FROM clicklog "
    "WHERE TIME >= '{s}' AND TIME < '{e}' GROUP BY ALL")
SQL["job_copy_window"] = with_clicklog(
    f"SELECT ID, TIME, PARAM_TYPE, URL, TITLE, CONTENT_TYPE FROM clicklog WHERE TIME >= '{START}'"
    f" AND TIME < '{MONTH_END}'")

SQL["job_label_minute"] = with_clicklog(" UNION ALL ".join(
    tag(e, s, label_count_sql(f"TIME >= '{s}' AND TIME < '{e}'", null_as_empty=True))
    for s, e in ((f"202401{d:02d}0000", f"202401{d + 7:02d}0000") for d in (1, 8, 15, 22))))
_MERGED = ("(SELECT * FROM n0 UNION ALL SELECT * FROM o WHERE TIME < '2024011000')")
SQL["keyed_write_counts"] = with_clicklog(
    "SELECT (SELECT count(*) FROM n0) AS UPSERTED, count(*) FILTER (PLATFORM = 'web') AS UPDATED, "
    "count(*) FILTER (CONTENT_TYPE = 'error') AS DELETED, "
    "count(*) FILTER (CONTENT_TYPE IS DISTINCT FROM 'error') AS ROWS_LEFT, "
    "count(*) FILTER (CONTENT_TYPE IS DISTINCT FROM 'error' AND (PLATFORM = 'web' "
    f"OR TITLE = upper(TITLE))) AS UPPER_TITLES FROM {_MERGED} m", OLD_NEW)
SQL["upsert_sql_store"] = with_clicklog(
    f"SELECT CONTENT_TYPE, '{MONTH_END}' AS ENDTIME, CAST(count(*) AS BIGINT) AS FREQUENCY "
    f"FROM clicklog WHERE TIME < '{MONTH_END}' GROUP BY CONTENT_TYPE")
SQL["upsert_ragged_store"] = SQL["scan_table"]
SQL["cells_upsert_store"] = with_cells(
    "SELECT rowkey, family, qualifier, CASE WHEN qualifier = 'TITLE' THEN upper(value) "
    "ELSE value END AS value FROM cells")

SQL["upsert_batches_store"] = with_clicklog(
    "SELECT UDID, ID, TIME, TITLE, (SELECT count(*) FROM (SELECT DISTINCT UDID, "
    "ceil(CAST(substr(TIME, 7, 2) AS INT) / 11) FROM clicklog) d) AS AFFECTED FROM clicklog "
    "QUALIFY row_number() OVER (PARTITION BY UDID ORDER BY TIME DESC, ID DESC) = 1")

# -- streaming -------------------------------------------------------------------

_WEND = "(strptime(substr(TIME, 1, 10), '%Y%m%d%H') + INTERVAL 1 HOUR)"
_CLOSED = f"{_WEND} <= (SELECT max(ts) FROM events)"
SQL["stream_label_pv"] = with_clicklog(
    f"SELECT strftime({_WEND}, '%Y%m%d%H') AS ENDTIME, substr(TIME, 1, 10) AS STARTTIME, WORD, "
    "CAST(count(*) AS BIGINT) AS FREQUENCY FROM (SELECT TIME, "
    f"unnest({java_split('CONTENT_LABEL')}) AS WORD FROM clicklog WHERE CONTENT_LABEL IS NOT NULL"
    f") s WHERE {_CLOSED} GROUP BY ALL")
SQL["stream_dim_pv"] = with_clicklog(
    f"SELECT strftime({_WEND}, '%Y%m%d%H') AS ENDTIME, substr(TIME, 1, 10) AS STARTTIME, {DIMS},"
    f" CAST(count(*) AS BIGINT) AS FREQUENCY FROM clicklog WHERE {_CLOSED} GROUP BY ALL")

# the exactly-one rule over no, one and many rows (ids below 0, equal to the least, all)
_LOOKUPS = " UNION ALL ".join(
    f"SELECT '{c}' AS ROWS_FOUND, CASE WHEN count(*) = 1 THEN min(CAST(ID AS BIGINT)) END AS ID, "
    "CASE WHEN count(*) = 1 THEN {udid} END AS UDID, CASE WHEN count(*) = 1 THEN min(PLATFORM) "
    f"END AS \"Platform\" FROM clicklog WHERE {w}"
    for c, w in (("none", "CAST(ID AS BIGINT) < 0"),
                 ("one", "CAST(ID AS BIGINT) = (SELECT min(event_id) FROM events)"),
                 ("many", "TRUE")))
SQL["lookup_object"] = with_clicklog(_LOOKUPS.replace("{udid}", "CAST(NULL AS VARCHAR)"))
SQL["lookup_object_ci"] = with_clicklog(_LOOKUPS.replace("{udid}", "min(UDID)"))

SQL["job_label_pv_stored"] = SQL["job_label_pv"]

SQL["scan_key_range_stored"] = SQL["scan_key_range"]

SQL["job_catch_up"] = LABEL_5H

SQL["stream_label_store"] = SQL["stream_label_pv"]

# every hour that is over by the last event
SQL["job_label_hourly"] = SQL["stream_label_pv"]
