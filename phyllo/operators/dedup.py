"""Exact and near duplicates of pictures, and pictures that carry two species.

Statuses only ever go from kept to duplicate or review. All choices follow explicit order columns, never physical order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phyllo.operators.components import components
from phyllo.operators.hamming import hash_bits, self_pairs

NEAR = 6


def exact_duplicates(records: DataFrame) -> DataFrame:
    """records with status, reason and duplicate_of after the exact pass: of kept rows of one checksum the first stays.

    The first row is found by aggregation with map-side combine and joined back, so a hot checksum is no single task.
    Blank and null checksums are compared with none.
    """
    usable = (F.col("status") == "kept") & (F.coalesce(F.trim("checksum"), F.lit("")) != "")
    first = records.where(usable).groupBy("checksum").agg(F.min("seq").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    both = records.join(first, "checksum", "left")
    later = F.coalesce(usable & (F.col("seq") > F.col("_first")), F.lit(False))
    return both.select(
        *[c for c in records.columns if c not in ("status", "reason", "duplicate_of")],
        F.when(later, "duplicate").otherwise(F.col("status")).alias("status"),
        F.when(later, "exact duplicate").otherwise(F.col("reason")).alias("reason"),
        F.when(later, F.col("checksum")).otherwise(F.col("duplicate_of")).alias("duplicate_of"),
    )


def hash_classes(rows: DataFrame, within: str | None = None, row_id: str = "seq", h: str = "h") -> DataFrame:
    """(id, class) of the rows that have a hash: rows of equal hash (and group) are a class, named by its smallest id."""
    keys = [F.col(h).alias("h"), *([F.col(within).alias("g")] if within else [])]
    own = rows.select(F.col(row_id).alias("id"), *keys).where("h IS NOT NULL")
    names = ["h"] + (["g"] if within else [])
    return own.join(own.groupBy(*names).agg(F.min("id").alias("class")), names).select("id", "class")


def near_pairs(rows: DataFrame, t: int = NEAR, within: str | None = None, row_id: str = "seq", h: str = "h") -> DataFrame:
    """(a, b, distance), a < b, of the classes of rows whose different hashes (bigint) lie within t bits.

    Rows of equal hash are one class, named by its smallest id (``hash_classes`` has the members), so blank pictures are not
    paired one by one; within: only hashes of equal values there, null with none. The exact Hamming self-join finds the
    pairs, with a hash of the group in its buckets, so that a hot group is cut; the group itself is compared at the end.
    """
    group = F.col(within) if within else F.lit("")
    own = rows.select(F.col(row_id).alias("id"), F.col(h).alias("h"), group.alias("g")).where("h IS NOT NULL AND g IS NOT NULL")
    classes = own.groupBy("g", "h").agg(F.min("id").alias("id")).withColumn("k", F.xxhash64("g"))
    met = self_pairs(classes, "h", t, group="k")
    side = lambda h, g, i: classes.select("k", F.col("h").alias(h), F.col("g").alias(g), F.col("id").alias(i))
    both = met.join(side("a", "g", "i"), ["k", "a"]).join(side("b", "g2", "j"), ["k", "b"]).where("g = g2")
    return both.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "distance")


def hash_links(rows: DataFrame, t: int = NEAR, within: str | None = None) -> DataFrame:
    """(a, b): links between the rows (seq, h) that are near twins; equal hashes are a star around their first row."""
    keys = ["h"] + ([within] if within else [])
    own = rows.select("seq", *keys).dropna(subset=keys)
    hubs = own.groupBy(*keys).agg(F.min("seq").alias("hub"))
    close = near_pairs(hubs.withColumnRenamed("hub", "seq"), t, within)
    stars = own.join(hubs, keys).where("seq <> hub").select(F.col("hub").alias("a"), F.col("seq").alias("b"))
    return close.select("a", "b").unionByName(stars)


def hash_components(rows: DataFrame, t: int = NEAR, within: str | None = None) -> DataFrame:
    """(seq, root) of the rows (seq, h) that have a near twin, single linkage; root is the smallest seq of the group."""
    return components(hash_links(rows, t, within)).select(F.col("node").alias("seq"), "root")


def mark_duplicates(records: DataFrame, t: int = NEAR) -> DataFrame:
    """records after the exact pass and then the near pass: of near twins of one species the earliest download stays kept."""
    exact = exact_duplicates(records)
    kept = exact.where("status = 'kept'").select("seq", "species", hash_bits("phash").alias("h"), "downloaded_at", "checksum")
    groups = hash_components(kept, t, "species")
    members = kept.select("seq", "downloaded_at", "checksum").join(groups, "seq")
    keeper = members.groupBy("root").agg(F.min(F.struct(F.coalesce("downloaded_at", F.lit("")).alias("at"), "seq", "checksum")).alias("k"))
    losers = members.join(keeper, "root").where("seq <> k.seq").select("seq", F.col("k.checksum").alias("_of"))
    both = exact.join(losers, "seq", "left")
    lost = F.col("_of").isNotNull()
    return both.select(
        *[c for c in exact.columns if c not in ("status", "reason", "duplicate_of")],
        F.when(lost, "duplicate").otherwise(F.col("status")).alias("status"),
        F.when(lost, "near-duplicate (perceptual hash)").otherwise(F.col("reason")).alias("reason"),
        F.when(lost, F.col("_of")).otherwise(F.col("duplicate_of")).alias("duplicate_of"),
    )


def cross_species(records: DataFrame, t: int = NEAR) -> DataFrame:
    """(seq, other_seq) of kept rows nearly identical to a row of another species; other_seq is the smallest such row."""
    kept = records.where("status = 'kept'").select("seq", "species", hash_bits("phash").alias("h")).where("h IS NOT NULL AND species IS NOT NULL")
    hubs = kept.groupBy("h", "species").agg(F.min("seq").alias("first"))
    near = self_pairs(hubs, "h", t).select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p"))
    # hashes of one species only have no neighbour of another species at distance 0
    mixed = hubs.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("x"), F.col("h").alias("y"))
    met = near.select("p.x", "p.y").unionByName(mixed)
    others = hubs.select(F.col("h").alias("y"), F.col("species").alias("other"), "first")
    found = met.join(hubs.select(F.col("h").alias("x"), "species"), "x").join(others, "y").where("species <> other")
    best = found.groupBy(F.col("x").alias("h"), "species").agg(F.min("first").alias("other_seq"))
    return kept.join(best, ["h", "species"]).select("seq", "other_seq")


def first_in_group(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The first row of each group, by row_number with an explicit order; Spark prunes it before the shuffle."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")
