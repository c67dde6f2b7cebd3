"""Answers of name and count services as tables: best taxon, counts over codes, first bindings, mapped ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phyllo.functions.names import comparable, internal_id

#: Ranks of a species or what is below it. Fixed values.
SPECIES_RANKS = ["species", "subspecies", "variety", "form", "hybrid"]


def best_taxon(results: DataFrame) -> DataFrame:
    """results (asked, pos, id, name, rank, matched_term, is_active) to the taxon of each asked name.

    Only active taxa of species rank count; one of the asked name goes before an earlier one that matches by a synonym.
    """
    rows = results.where(F.coalesce("is_active", F.lit(True)) & F.lower("rank").isin(*SPECIES_RANKS))
    own = comparable("asked")
    kind = F.when(comparable("name") == own, 0).when(comparable("matched_term") == own, 1)
    return rows.withColumn("_k", kind).where("_k IS NOT NULL").groupBy("asked").agg(F.min(F.struct("_k", "pos", "id", "name")).alias("x")).select("asked", "x.id", "x.name", (F.col("x._k") == 1).alias("is_synonym"))


def counts_over_codes(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """(species, n): the sum over licence codes; -1 where the service could not resolve the species."""
    n = counts.groupBy("species").agg(F.sum("n").alias("n"))
    return asked.select("species").join(n, "species", "left").select("species", F.coalesce("n", F.lit(-1).cast("long")).alias("n"))


def first_bindings(bindings: DataFrame, key: str, value: str) -> DataFrame:
    """The first value of each key in the order of arrival (seq)."""
    return bindings.groupBy(key).agg(F.min_by(value, "seq").alias(value))


def mapped_classes(names: DataFrame, labels: DataFrame) -> DataFrame:
    """names (id, name) of a foreign data set to our classes (class_id); many may go to one."""
    return names.select("id", internal_id("name").alias("class_id")).join(labels.select("class_id"), "class_id", "left_semi")


def foreign_counts(metadata: DataFrame, mapping: DataFrame, licences: list[str]) -> DataFrame:
    """(kind, key, n) of a foreign data set: licences over all images, then whole and per organ over ours of good licence."""
    every = metadata.select(F.lit("license").alias("kind"), F.coalesce("license", F.lit("?")).alias("key"))
    ours = metadata.where(F.col("license").isin(*licences)).join(mapping.withColumnRenamed("id", "species_id"), "species_id")
    parts = F.explode(F.array(F.struct(F.lit("whole").alias("kind"), F.lit("").alias("key")), F.struct(F.lit("organ").alias("kind"), F.coalesce("organ", F.lit("?")).alias("key")), F.struct(F.lit("species").alias("kind"), F.col("class_id").alias("key")))).alias("x")
    return every.unionByName(ours.select(parts).select("x.kind", "x.key")).groupBy("kind", "key").agg(F.count("*").alias("n"))


def coverage(resolved: DataFrame) -> DataFrame:
    """One row: distinct names, those with a class, distinct classes, names given more than once (of name, id, label)."""
    once = resolved.groupBy("id").agg(F.count("*").alias("n"), F.max("label").alias("label"))
    return once.agg(F.count("*").alias("names"), F.count("label").alias("resolved"), F.countDistinct("label").alias("classes"), F.count_if(F.col("n") > 1).alias("repeated"))


def verdict(best: Column, second: Column, least: float = 0.10, sure: float = 0.70, margin: float = 0.25) -> Column:
    """What a device says: nothing, accepted, or uncertain."""
    return F.when(best < least, "no candidate").when((best >= sure) & (best - second >= margin), "accepted").otherwise("uncertain")
