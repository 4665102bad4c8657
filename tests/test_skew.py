"""One key holding a third of all rows: results stay exact and the hot key is
reduced on the map side (partial aggregate / partial group limit) before any
shuffle."""

from pyspark.sql import functions as F

from clickwin.operators import counts, topn
from clickwin.operators import upsert as up


def _skewed(spark, n=30000):
    # a third of the rows share label "hot", group "g0" and upsert key "k0"
    return spark.range(n).select(
        F.format_string("2024010%d%02d%02d000", (F.col("id") % 9) + 1, F.col("id") % 24,
                        F.col("id") % 60).alias("TIME"),
        F.when(F.col("id") % 3 == 0, F.lit("hot,x"))
         .otherwise(F.concat(F.lit("l"), (F.col("id") % 50).cast("string"))).alias(
            "CONTENT_LABEL"),
        F.when(F.col("id") % 3 == 0, F.lit("g0"))
         .otherwise(F.concat(F.lit("g"), (F.col("id") % 97).cast("string"))).alias("G"),
        F.when(F.col("id") % 3 == 0, F.lit("k0"))
         .otherwise(F.col("id").cast("string")).alias("K"),
        F.col("id"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_label_counts_exact_with_partial_aggregate(spark):
    df = _skewed(spark).repartition(8)
    got = {r["WORD"]: r["FREQUENCY"] for r in counts.label_counts(df).collect()}
    assert got["hot"] == 10000 and got["x"] == 10000
    assert sum(got.values()) == 10000 * 2 + 20000
    plan = _plan(counts.label_counts(df))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(WORD")


def test_hot_group_top_n_is_limited_before_shuffle(spark):
    df = _skewed(spark).repartition(8)
    top = topn.latest_n_per_group(df, "G", "TIME", 3, tie_break="id")
    rows = top.where(F.col("G") == "g0").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2, 3]
    want = sorted(((r["TIME"], -r["id"]) for r in df.where(F.col("G") == "g0").collect()),
                  reverse=True)[:3]
    assert [(r["TIME"], -r["id"]) for r in rows] == want
    top.collect()
    assert "WindowGroupLimit" in _plan(top) and "Partial" in _plan(top)


def test_hot_upsert_key_dedups_to_latest(spark):
    df = _skewed(spark).repartition(8).select("K", "TIME", "id")
    old = spark.createDataFrame([("k0", "old", -1)], "K string, TIME string, id bigint")
    merged = up.merge_upsert(old, df, ["K"], dedupe=True, order_desc=["TIME", "id"])
    hot = merged.where(F.col("K") == "k0").collect()
    assert len(hot) == 1
    best = df.where(F.col("K") == "k0").orderBy(F.col("TIME").desc(), F.col("id").desc()).first()
    assert (hot[0]["TIME"], hot[0]["id"]) == (best["TIME"], best["id"])
    assert merged.count() == 20000 + 1
