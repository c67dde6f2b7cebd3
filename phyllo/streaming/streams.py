"""Structured Streaming: appended manifests, resumable dedupe, quotas by key, resolution against a growing table.

State is keyed and, where event time is known, bounded by a watermark. Batches that fail are replayed from the checkpoint in
the shared folder; sinks write each batch under its number, so a replay writes the same rows to the same place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from phyllo.session import ship


def read_parquet(spark: SparkSession, path: str, schema, per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def dedupe(stream: DataFrame, keys: list[str], at: str | None = None, late: str = "30 days") -> DataFrame:
    """The first row of each key; with an event time, keys are forgotten when the watermark has passed them."""
    if at is None:
        return stream.dropDuplicates(keys)
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def quota(stream: DataFrame, key: str, order: str, quota: int) -> DataFrame:
    """At most ``quota`` rows of each key, in the order of arrival; the count of a key is its whole state.

    Batches pass in order; within a batch rows are taken by ``order``.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema)

    def take(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        had = state.get[0] if state.exists else 0
        whole = pd.concat(list(parts)).sort_values(order).head(max(0, quota - had))
        state.update((had + len(whole),))
        yield whole

    ship(stream.sparkSession)
    return stream.groupBy(key).applyInPandasWithState(take, fields, "n long", "append", GroupStateTimeout.NoTimeout)


def counts(stream: DataFrame, at: str, width: str, late: str, key: str) -> DataFrame:
    """Events by key and window of event time, late rows within the watermark counted in their own window."""
    own = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return own.groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def resolve(stream: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Stream rows with what the known table has for their key; null where it has nothing yet."""
    return stream.join(known.where(" AND ".join(f"{c} IS NOT NULL" for c in known.columns)), key, "left")


def run(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Process what there is and stop; called again it goes on where it ended."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(target).awaitTermination()


def append_batches(stream: DataFrame, target: str, checkpoint: str) -> None:
    """foreachBatch sink: each batch overwrites its own folder, so a replayed batch is no second append."""

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").json(f"{target}/batch={n}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
