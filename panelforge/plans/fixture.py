"""The reference panel from the star-schema tables: orders per nation and year in a base and two later batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import table

TABLE = "SeriesOrders"


def observations(spark: SparkSession, d: str) -> DataFrame:
    """entity, code, k, year and value: orders of each nation's customers in each year, over all orders."""
    orders = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    # Orders are counted per customer and year before they meet the nations.
    per = orders.groupBy("o_custkey", "year").agg(F.count("*").alias("n"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("entity"))
    got = per.join(customers, "o_custkey").groupBy("c_nationkey", "year").agg(F.sum("n").cast("double").alias("value")).join(nations, "c_nationkey")
    return got.select("entity", F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("code"), F.col("c_nationkey").cast("int").alias("k"), F.col("year").cast("int").alias("year"), "value")


def batches(spark: SparkSession, d: str) -> DataFrame:
    """batch, seq, table_name, entity, code, year, value: base until 2000, A from 1998, B from 2000 for some nations."""
    obs = observations(spark, d)
    k, y, v = F.col("k"), F.col("year"), F.col("value")
    tagged = F.explode(F.array(
        F.struct(F.lit("base").alias("batch"), F.lit(0).alias("seq"), (y <= 2000).alias("keep"), F.when((k % 7 == 3) & (y == 1997), None).otherwise(v).alias("value")),
        F.struct(F.lit("A").alias("batch"), F.lit(1).alias("seq"), (y >= 1998).alias("keep"), F.when((k % 5 == 0) & (y == 1999), None).when((k == 4) & (y == 1999), v * 10).otherwise(v + 1).alias("value")),
        F.struct(F.lit("B").alias("batch"), F.lit(2).alias("seq"), ((y >= 2000) & (k < 10)).alias("keep"), (v + 2).alias("value")),
    ))
    each = obs.select("entity", "code", "year", tagged.alias("_b")).where("_b.keep")
    return each.select("_b.batch", "_b.seq", F.lit(TABLE).alias("table_name"), "entity", "code", "year", "_b.value")


def part(rows: DataFrame, batch: str) -> DataFrame:
    return rows.where(F.col("batch") == batch).drop("batch", "seq")


#: The same in SQL.
SQL = """
obs AS (SELECT n.n_name AS entity, concat('N', lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')) AS code, n.n_nationkey AS k,
  CAST(year(o.o_orderdate) AS INT) AS year, CAST(count(*) AS DOUBLE) AS value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name, n.n_nationkey, year(o.o_orderdate)),
batches AS (
  SELECT 'base' AS batch, 0 AS seq, 'SeriesOrders' AS table_name, entity, code, year, CASE WHEN k % 7 = 3 AND year = 1997 THEN NULL ELSE value END AS value FROM obs WHERE year <= 2000
  UNION ALL SELECT 'A', 1, 'SeriesOrders', entity, code, year, CASE WHEN k % 5 = 0 AND year = 1999 THEN NULL WHEN k = 4 AND year = 1999 THEN value * 10 ELSE value + 1 END FROM obs WHERE year >= 1998
  UNION ALL SELECT 'B', 2, 'SeriesOrders', entity, code, year, value + 2 FROM obs WHERE year >= 2000 AND k < 10),
base AS (SELECT * FROM batches WHERE batch = 'base'),
a_ AS (SELECT * FROM batches WHERE batch = 'A'),
merged AS (SELECT table_name, entity, code, year, max_by(value, seq) FILTER (WHERE value IS NOT NULL) AS value,
  coalesce(max_by(batch, seq) FILTER (WHERE value IS NOT NULL), 'base') AS origin FROM batches GROUP BY ALL)"""
