"""Text folding shared by names, authors and passages."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phyllo.session import ship

#: Letters that decomposition leaves whole. Fixed values.
WHOLE = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "ł": "l", "þ": "th", "ı": "i"}
SPACES = re.compile(r"\s+")


def fold(s: str) -> str:
    """Lower case without accents; compatible forms are unified, white space is left as it is."""
    if s.isascii():
        return s.lower()
    bare = unicodedata.normalize("NFKD", s.casefold())
    for c in set(bare):  # a text has few different letters, and replacing one is a quick scan
        if c >= "\x80" and (unicodedata.combining(c) or c in WHOLE):
            bare = bare.replace(c, WHOLE.get(c, ""))
    return bare


def map_distinct(df: DataFrame, column: str, alias: str, f, kind: T.DataType, keep: list[str] | None = None) -> DataFrame:
    """df with f(column) as ``alias``, f called once for each distinct value of an Arrow batch; f(None) gives null."""
    keep = df.columns if keep is None else keep
    if alias in keep:
        raise ValueError(f"{alias} is a column already")
    schema = T.StructType([df.schema[c] for c in keep]).add(alias, kind)
    to = pa.string() if isinstance(kind, T.StringType) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(column).dictionary_encode()
            new = pa.array([None if v is None else f(v) for v in values.dictionary.to_pylist()], to)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pc.take(new, values.indices)], names=[*keep, alias])

    ship(df.sparkSession)
    return df.select(*dict.fromkeys([*keep, column])).mapInArrow(run, schema)


def blank(c: Column | str) -> Column:
    """Null or nothing but white space."""
    c = F.col(c) if isinstance(c, str) else c
    return ~F.coalesce(c.rlike(r"[^\s\p{Z}\x{200B}\x{FEFF}]"), F.lit(False))
