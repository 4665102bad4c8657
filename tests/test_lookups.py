import os

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickwin.operators import topn
from clickwin.operators import upsert as up
from clickwin.sources import tables as src


def test_students_demo_rows_view_projection(spark):
    # in-memory rows with an explicit all-string schema, a view, a projection
    schema = StructType([StructField(n, StringType(), True) for n in ("rowKey", "name", "age")])
    rows = [("1", "jack1", "12"), ("2", "jack2", "32"), ("3", "jack3", "45"),
            ("4", "jack4", "212"), ("5", "jack5", "54")]
    df = spark.createDataFrame(rows, schema)
    out = src.scan_sql_subquery(spark, "SELECT rowKey, name, age FROM student", {"student": df})
    assert [tuple(r) for r in out.orderBy("rowKey").collect()] == rows


def test_lookups_on_empty_one_many(spark):
    empty = spark.createDataFrame([], "v string")
    one = spark.createDataFrame([("a",)], "v string")
    many = spark.createDataFrame([("a",), ("b",)], "v string")
    assert topn.lookup_first(empty, "v").first()["v"] is None
    assert topn.lookup_first(topn.top_one(many, "v"), "v").first()["v"] == "b"
    assert topn.lookup_exactly_one(empty, "v").first()["v"] is None
    assert topn.lookup_exactly_one(one, "v").first()["v"] == "a"
    assert topn.lookup_exactly_one(many, "v").first()["v"] is None
    rec = F.struct(F.col("v").alias("name"))
    assert topn.lookup_object(one, rec).first()["R"]["name"] == "a"
    assert topn.lookup_object(many, rec).first()["R"] is None


def test_range_exists_and_top_one_nulls_last(spark):
    df = spark.createDataFrame([(None,), ("2024010100",), ("2024010200",)], "ENDTIME string")
    assert topn.top_one(df, "ENDTIME").first()["ENDTIME"] == "2024010200"
    assert topn.range_exists(df, F.col("ENDTIME") >= "2024010150").first()["EXISTS"] is True
    assert topn.range_exists(df, F.col("ENDTIME") >= "2025").first()["EXISTS"] is False


def test_upsert_sql_with_bound_values(spark, tmp_root):
    path = os.path.join(tmp_root, "markers")
    sql = "SELECT ? AS TABLE_NAME, ? AS ENDTIME, ? AS STARTTIME"
    up.upsert_sql(spark, path, sql, ["T", "2024010101", "2024010100"], ["TABLE_NAME", "ENDTIME"])
    up.upsert_sql(spark, path, sql, ["T", "2024010101", "2024010100"], ["TABLE_NAME", "ENDTIME"])
    up.upsert_sql(spark, path, sql, ["T", "2024010102", "2024010101"], ["TABLE_NAME", "ENDTIME"])
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [("T", "2024010101", "2024010100"), ("T", "2024010102", "2024010101")]
