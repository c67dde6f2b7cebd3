"""Feature caches, prediction slots and image hashes: where Python is needed, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phyllo.session import ship
from phyllo.sources.files import exists


def dct_matrix(n: int = 32) -> np.ndarray:
    """The type II cosine transform as a matrix, unnormalised."""
    k = np.arange(n)
    return np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))


def picture_hash(grey: Column) -> Column:
    """The 64-bit hash (16 hex digits) of a 32 x 32 grey picture given as an array of 1,024 numbers; null otherwise.

    Bit i, the highest first, tells whether the i-th of the 8 x 8 lowest frequencies is above the median of all but the first.
    """

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        m = dct_matrix()
        out: list[str | None] = []
        for r in rows:
            if r is None or len(r) != 1024:
                out.append(None)
                continue
            low = (m @ np.asarray(r, float).reshape(32, 32) @ m.T)[:8, :8].ravel()
            bits = low > np.median(low[1:])
            out.append(f"{int(''.join('1' if b else '0' for b in bits), 2):016x}")
        return pd.Series(out, dtype=object)

    return run(grey)


def predict(images: DataFrame, make: Callable[[], Callable[[pd.DataFrame], np.ndarray]], columns: list[str]) -> DataFrame:
    """images with ``p``: make() is called once a task and gives a function from a batch to its probabilities."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in images.select(*columns).schema) + ", p array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for b in batches:
            yield b[columns].assign(p=[list(map(float, x)) for x in model(b)])

    ship(images.sparkSession)
    return images.mapInPandas(run, schema)


def encoded(rows: DataFrame, encode: Callable[[DataFrame], DataFrame], signature: str, folder: str, key: str = "image_id", parts: int = 16) -> DataFrame:
    """encode(rows), kept part by part under ``folder``: parts of the same signature are read back, others are made again.

    A part is written whole or not at all, so a run that dies goes on at the first part that is missing; another signature
    starts over in a folder of its own.
    """
    spark: SparkSession = rows.sparkSession
    tag = spark.range(1).select(F.sha2(F.lit(signature), 256)).first()[0][:16]
    base = f"{folder}/signature={tag}"
    for n in range(parts):
        if not exists(spark, f"{base}/part={n}/_SUCCESS"):
            encode(rows.where(F.pmod(F.xxhash64(key), F.lit(parts)) == n)).write.mode("overwrite").parquet(f"{base}/part={n}")
    return spark.read.parquet(*[f"{base}/part={n}" for n in range(parts)])


def input_sizes(pixels: int, most: int = 448) -> tuple[int, int]:
    """(input, load): what a model takes and the somewhat larger size pictures are loaded in."""
    load = round(pixels * 256 / 224)
    if pixels < 32 or load > most:
        raise ValueError(f"{pixels} pixels can't be served from pictures of {most}")
    return pixels, load


def sized_masks(labels: DataFrame, masks: DataFrame) -> DataFrame:
    """(mask, class_idx, class_id) of masks (mask, class_id) over the labels, in their order; empty and full masks fall away."""
    n = labels.agg(F.count("*").alias("n")).scalar()
    rows = masks.distinct().join(labels, "class_id")
    sizes = rows.groupBy("mask").agg(F.count("*").alias("k")).where(F.col("k") < n).select("mask")
    return rows.join(sizes, "mask", "left_semi").select("mask", "class_idx", "class_id")


def parse_masks(arguments: list[str]) -> dict[str, str]:
    """name=file arguments; the first = parts them."""
    out = {}
    for a in arguments:
        name, eq, path = a.partition("=")
        if not eq or not name or not path:
            raise ValueError(f"not name=file: {a}")
        out[name] = path
    return out
