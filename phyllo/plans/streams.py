"""Queries that run as streams over the events and come back as tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phyllo.session import keep_until_exit, shared_dir, table
from phyllo.sources.files import is_folder
from phyllo.streaming import streams


def _through(spark: SparkSession, d: str, make, mode: str = "append") -> DataFrame:
    base = f"{shared_dir(spark)}/phyllo/stream-{uuid.uuid4().hex}"
    keep_until_exit(spark, base)
    schema = table(spark, d, "events").schema
    # a stream reads folders: a table that is one file is picked out of the folder it is in
    reader = spark.readStream.schema(schema)
    source = reader.parquet(f"{d}/events.parquet") if is_folder(spark, f"{d}/events.parquet") else reader.option("pathGlobFilter", "events.parquet").parquet(d)
    streams.run(make(source), f"{base}/out", f"{base}/checkpoint", mode)
    return spark.read.parquet(f"{base}/out")


def str02_stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return _through(spark, d, lambda s: streams.dedupe(s.select("user_id", "event_type"), ["user_id", "event_type"]))


def str03_stream_quota(spark: SparkSession, d: str) -> DataFrame:
    out = _through(spark, d, lambda s: streams.quota(s.select("event_id", "user_id"), "user_id", "event_id", 3))
    return out.select("event_id", "user_id")


def str04_stream_static(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return _through(spark, d, lambda s: streams.resolve(s.select("event_id", "user_id"), known, "user_id")).select("event_id", "user_id", "c_mktsegment")


QUERIES = {"str02_stream_dedupe": str02_stream_dedupe, "str03_stream_quota": str03_stream_quota, "str04_stream_static": str04_stream_static}
SQL = {
    "str02_stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
    "str03_stream_quota": "SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n <= 3",
    "str04_stream_static": "SELECT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON c_custkey = user_id",
}
