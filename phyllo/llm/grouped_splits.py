"""Splits that keep related records together: Hash-to-Min components, then weighted rendezvous hashing of components.

Records are related by keys (an observation at a source; an author's pictures of a species). Each key becomes one node
named by the smallest ``seq`` that holds it; a record with several shared keys is an edge from one of them to each other, so a
key that a third of all rows share is one node, not a clique. Keys that only one record holds cannot relate anything and are dropped
before the graph is built.

Defined results: null and blank keys relate nothing; repeated rows are related through their keys like any others; a
record without relatives is its own group; an empty table gives an empty table. ``seq`` must be unique and not null.
Columns of the input other than those named are not read, so extra columns can't clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phyllo.functions.text import blank, fold, map_distinct
from phyllo.operators.components import components
from phyllo.session import materialize, release

#: Stand-ins for "no name", as sorted words. Fixed values.
NO_NAME = {
    "", "a n", "anon", "anonym", "anonyme", "anonymous", "anonymus", "anonimo", "author no", "author not stated", "author unknown", "author unspecified",
    "autor unbekannt", "autore sconosciuto", "auteur inconnu", "inconnu", "keine angabe", "keiner", "kein name", "n n", "na", "name no", "name ohne", "nobody", "none",
    "nil", "null", "no one", "nomen nescio", "not provided", "not stated", "not available", "not specified", "photographer unknown", "sans nom", "sconosciuto", "artist unknown",
    "unbekannt", "undefined", "undetermined", "unknown", "unknown user", "unnamed", "unspecified", "tbd", "user unknown", "nan", "missing", "author", "ignoto",
    "by unknown", "creator unknown", "deleted user", "account deleted",
}
MARK = re.compile(r"©|\(\s*c\s*\)|&copy;|\bcopyright\b|\bcopr\b\.?|℗|®", re.I)
WORD = re.compile(r"\w+")


def author_key(raw: str) -> str | None:
    """One key for all spellings of an author: case, accents, blanks, order of names and copyright marks don't matter."""
    words = sorted(w for w in WORD.findall(fold(MARK.sub(" ", raw)).replace("_", " ")))
    key = " ".join(words)
    return None if key in NO_NAME or not any(c.isalpha() for c in key) else key


def with_author_key(df: DataFrame, author: str = "author", alias: str = "author_key", keep: list[str] | None = None) -> DataFrame:
    return map_distinct(df, author, alias, author_key, T.StringType(), keep)


def related(rows: DataFrame, seq: str, keys: list[Column]) -> DataFrame:
    """(seq, first_seq) of the records that have a relative: those of a group of at least two.

    Two records are related if one of ``keys`` (null: none) is equal, or through others.
    """
    if not keys:
        raise ValueError("at least one key")
    # read once a key and once more below, so the keys are made once
    own = materialize(rows.select(F.col(seq).alias("seq"), *[k.alias(f"k{i}") for i, k in enumerate(keys)]).where(F.coalesce(*[k for k in keys]).isNotNull()), "keys")
    label = own
    for i in range(len(keys)):
        shared = own.where(f"k{i} IS NOT NULL").groupBy(f"k{i}").agg(F.min("seq").alias(f"hub{i}"), F.count("*").alias("n")).where("n > 1").drop("n")
        label = label.join(shared, f"k{i}", "left").drop(f"k{i}")
    hubs = [F.col(f"hub{i}") for i in range(len(keys))]
    label = materialize(label.where(F.coalesce(*hubs).isNotNull()).select("seq", *[f"hub{i}" for i in range(len(keys))]), "labels")
    release(own)
    if len(keys) == 1:
        return label.withColumnRenamed("hub0", "first_seq")
    first = F.coalesce(*hubs)
    edges = label.select(first.alias("a"), F.explode(F.array(*hubs)).alias("b")).where("a <> b").distinct()
    return label.select("seq", first.alias("node")).join(components(edges), "node", "left").select("seq", F.coalesce("root", "node").alias("first_seq"))


def record_groups(records: DataFrame) -> DataFrame:
    """(seq, first_seq) of the image records that share an observation of a source or an author's species with others."""
    rows = with_author_key(records, keep=["seq", "source", "observation_id", "species"])
    observation = F.when(~blank("observation_id"), F.concat_ws("\x01", F.coalesce("source", F.lit("\x02")), F.trim("observation_id")))
    authored = F.when(F.col("author_key").isNotNull() & F.col("species").isNotNull(), F.concat_ws("\x01", "species", "author_key"))
    return related(rows, "seq", [observation, authored])


def rendezvous(group: Column, weights: list[tuple[str, float]], salt: str) -> Column:
    """The split of a group by weighted rendezvous hashing: each split scores -w / ln(u), u a hash of salt, split and group.

    Changing one weight moves only the groups that this split wins or loses.
    """
    scores = []
    for name, w in weights:
        if w <= 0:
            continue
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(salt), F.lit(name), group), 11).cast("double") + 0.5) / float(1 << 53)
        scores.append(F.struct((F.lit(-float(w)) / F.log(u)).alias("score"), F.lit(name).alias("split")))
    return F.array_max(F.array(*scores))["split"]


def assign_splits(records: DataFrame, ratios: tuple[tuple[str, float], ...] = (("train", 0.8), ("val", 0.1), ("test", 0.1)), salt: str = "phyllo-1", heavy_share: float = 0.002, step: float = 0.02, weights: dict[str, float] | None = None) -> DataFrame:
    """(seq, first_seq, split) of every record: every group is whole, and the shares are near ``ratios``.

    Groups of more than ``heavy_share`` of all records, of which there are 1 / heavy_share at most, are placed one after
    the other, largest first, where most room is left; the rest goes by rendezvous hashing with the room left as weights,
    rounded to ``step`` of all, so that small changes of the data change no weight and move no other group. ``weights``:
    those of an earlier run in place of the room left, to keep its assignments whatever has come since.
    """
    groups = record_groups(records)
    label = records.select("seq").join(groups, "seq", "left").select("seq", F.coalesce("first_seq", "seq").alias("first_seq"))
    sizes = groups.groupBy("first_seq").agg(F.count("*").alias("n"))
    total = records.count()
    room = {name: share * total / sum(w for _, w in ratios) for name, share in ratios}
    placed: list[tuple[int, str]] = []
    for r in sorted(sizes.where(F.col("n") > max(1, heavy_share * total)).collect(), key=lambda r: (-r["n"], r["first_seq"])):
        name = max(room, key=lambda k: (room[k], k))
        room[name] -= r["n"]
        placed.append((r["first_seq"], name))
    open_ = [(name, step * max(0, round(left / total / step)) if total else 0.0) for name, left in room.items()]
    given = list(weights.items()) if weights else open_ if any(w for _, w in open_) else list(ratios)
    split = rendezvous(F.col("first_seq"), given, salt)
    if placed:
        fixed = F.create_map(*[x for k, name in placed for x in (F.lit(k).cast("long"), F.lit(name))])
        split = F.coalesce(F.try_element_at(fixed, F.col("first_seq")), split)
    return label.withColumn("split", split)
