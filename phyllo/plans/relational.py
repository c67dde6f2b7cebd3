"""Generic relational shapes over the star schema: what the curation queries are made of, at its simplest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phyllo.operators import catalog
from phyllo.operators.evaluate import upper_median
from phyllo.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("SELECT c_nationkey, c_mktsegment, count(*) AS n, CAST(sum(CAST(c_acctbal > 0 AS INTEGER)) AS BIGINT) AS positive FROM customer GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_nationkey), ())")
def rel_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.groupingSets([["c_nationkey", "c_mktsegment"], ["c_nationkey"], []], "c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("positive"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def rel_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 45)")
def rel_semi_join(spark: SparkSession, d: str) -> DataFrame:
    big = table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").join(big, "o_orderkey", "left_semi").select("o_orderkey")


@query("SELECT l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n <= 3")
def rel_top_per_group(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return table(spark, d, "lineitem").withColumn("n", F.row_number().over(w)).where("n <= 3").select("l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT t.threshold, count(*) AS n, count(*) FILTER (l_discount >= t.threshold) AS accepted, count(*) FILTER (l_discount >= t.threshold AND l_returnflag = 'N') AS right FROM lineitem, (SELECT unnest([0.02, 0.04, 0.06, 0.08]::DOUBLE[]) AS threshold) t GROUP BY t.threshold")
def rel_threshold_grid(spark: SparkSession, d: str) -> DataFrame:
    grid = F.explode(F.array(*[F.lit(t) for t in (0.02, 0.04, 0.06, 0.08)])).alias("threshold")
    rows = table(spark, d, "lineitem").select("l_discount", "l_returnflag", grid)
    ok = F.col("l_discount") >= F.col("threshold")
    return rows.groupBy("threshold").agg(F.count("*").alias("n"), F.count_if(ok).alias("accepted"), F.count_if(ok & (F.col("l_returnflag") == "N")).alias("right"))


@query("SELECT n_name, count(*) AS orders, count(DISTINCT c_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def rel_star_join(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(catalog.maybe_broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    o = table(spark, d, "orders").select("o_custkey")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("n_name").agg(F.count("*").alias("orders"), F.countDistinct("c_custkey").alias("customers"))


@query("SELECT p_brand, list_sort(list(p_size))[len(list(p_size)) // 2 + 1] AS median FROM part GROUP BY p_brand")
def rel_upper_median(spark: SparkSession, d: str) -> DataFrame:
    return upper_median(table(spark, d, "part"), ["p_brand"], "p_size")


@query("SELECT user_id, event_id, ts FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type")
def rel_changes(spark: SparkSession, d: str) -> DataFrame:
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("event_id"))
    return table(spark, d, "events").withColumn("before", before).where("before IS NULL OR before <> event_type").select("user_id", "event_id", "ts")
