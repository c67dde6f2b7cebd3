"""From nested pages to candidates and the manifest: filters, anti joins, statistics, attributions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phyllo.functions.licenses import is_allowed, parse_license
from phyllo.functions.scalars import large_photo, photo_id_of
from phyllo.operators.nested import child_table, inat_results


def given(*cs: Column) -> Column:
    """The first that is neither null nor empty; the last one as it is."""
    return F.coalesce(*[F.when(c != "", c) for c in cs[:-1]], cs[-1])


def with_allowed_license(candidates: DataFrame, share_alike: bool = False) -> DataFrame:
    """The candidates whose licence can be read and allows commercial use and derivatives."""
    return candidates.where(is_allowed(parse_license("license"), share_alike))


def gbif_candidates(pages: DataFrame) -> DataFrame:
    """Still images of occurrences with an http address; the medium's own licence before the occurrence's.

    source_id counts all media of the occurrence, so it stays the same whatever the filter.
    """
    carry = {"occ_key": "occ_key", "license": "occ_license", "rights_holder": "occ_holder", "recorded_by": "recorded_by", "ref_url": "occ_url", "dataset_key": "dataset_key", "publishing_org_key": "org"}
    media = {"media_type": "media_type", "identifier": "image_url", "license": "own_license", "rights_holder": "own_holder", "creator": "creator", "publisher": "publisher"}
    rows = child_table(pages, {"page_id": "page_id"}, [{"array": "results", "pos": "result_pos", "carry": carry}, {"array": "media", "pos": "photo_pos"}], media)
    c = F.col
    return rows.where("media_type = 'StillImage' AND image_url LIKE 'http%'").select(
        "page_id", F.concat(c("occ_key").cast("string"), F.lit("#"), c("photo_pos")).alias("source_id"), F.lit("gbif").alias("source"), "image_url",
        given(c("own_license"), c("occ_license")).alias("license"), given(c("creator"), c("own_holder"), c("recorded_by"), c("occ_holder")).alias("author"),
        c("occ_key").cast("string").alias("observation_id"), c("occ_url").alias("original_url"), given(c("publisher"), c("org")).alias("publisher"), "dataset_key",
    )


def inat_candidates(pages: DataFrame) -> DataFrame:
    """Photos that are not hidden and carry a licence of their own, in the large size."""
    nested = inat_results(pages)
    carry = {"id": "observation", "uri": "uri", "quality_grade": "quality_grade", "captive": "captive", "user_name": "user_name", "user_login": "user_login"}
    rows = child_table(nested, {"page_id": "page_id"}, [{"array": "results", "pos": "result_pos", "carry": carry}, {"array": "photos", "pos": "photo_pos"}], {"id": "photo_id", "license_code": "license", "url": "url", "hidden": "hidden"})
    c = F.col
    return rows.where("url LIKE 'http%' AND NOT coalesce(hidden, false) AND license <> ''").select(
        "page_id", F.concat(c("observation").cast("string"), F.lit("#"), c("photo_id")).alias("source_id"), F.lit("inaturalist").alias("source"), large_photo("url").alias("image_url"), "license",
        given(c("user_name"), c("user_login")).alias("author"), c("observation").cast("string").alias("observation_id"), c("uri").alias("original_url"), "quality_grade", "captive", "photo_id",
    )


def new_candidates(candidates: DataFrame, manifest: DataFrame, order: list[str]) -> DataFrame:
    """Candidates whose (source, source_id) the manifest does not hold in any status; of one photo only the first."""
    fresh = candidates.join(manifest.select("source", "source_id").distinct(), ["source", "source_id"], "left_anti")
    photo = F.coalesce(photo_id_of("image_url"), F.col("image_url"))
    return fresh.withColumn("_n", F.row_number().over(Window.partitionBy(photo).orderBy(*order))).where("_n = 1").drop("_n")


def manifest_stats(records: DataFrame) -> DataFrame:
    """Long form counts: species by status, and of kept records by licence and by source, in one pass of grouping sets."""
    kept = F.col("status") == "kept"
    rows = records.select("species", "status", "license", "source")
    whole = rows.groupingSets([["species", "status"], ["status", "license"], ["status", "source"]], "species", "status", "license", "source").agg(
        F.count("*").alias("n"), F.grouping("species").alias("_sp"), F.grouping("license").alias("_l"), F.grouping("source").alias("_so"),
    )
    part = whole.where((F.col("_sp") == 0) | kept)
    return part.select("species", F.when(F.col("_sp") == 0, F.col("status")).alias("status"), "license", "source", "n")


def first_names(records: DataFrame) -> DataFrame:
    """The species name of each plant id, as its first record has it."""
    rows = records.where("internal_plant_id <> ''")
    first = rows.groupBy("internal_plant_id").agg(F.min(F.struct("seq", "species")).alias("x"))
    return first.select("internal_plant_id", F.col("x.species").alias("species"))


def attributions(records: DataFrame) -> DataFrame:
    """The kept records with what a credit line needs, ordered by species, author and source_id."""
    return records.where("status = 'kept'").select("species", "author", "source", "source_id", "license", "license_url", "original_url", "path").orderBy("species", "author", "source_id")


def resolve(names: DataFrame, cache: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """(resolved, misses) of names (name) against a cache (name, value): a cached null is a miss and is asked again."""
    hit = cache.where(F.col(value).isNotNull())
    return names.join(hit, "name"), names.join(hit, "name", "left_anti")


def first_usable(names: DataFrame, responses: DataFrame) -> DataFrame:
    """names (id, names array) to the first of their names, in order, that has a usable response (name, usable, ...)."""
    spread = names.select("id", F.posexplode("names").alias("pos", "name"))
    usable = responses.where("usable")
    met = spread.join(usable, "name")
    return met.groupBy("id").agg(F.min_by(F.struct(*[c for c in met.columns if c not in ("id", "pos")]), "pos").alias("match")).select("id", "match.*")


def taxon_usable(rank: Column, match_type: Column, confidence: Column) -> Column:
    """Whether a name service's answer is a plant: exact, or fuzzy with a confidence of 95 or more, at species rank or below."""
    ok = F.upper(rank).isin("SPECIES", "SUBSPECIES", "VARIETY", "FORM") & ((match_type == "EXACT") | ((match_type == "FUZZY") & (confidence >= 95)))
    return F.coalesce(ok, F.lit(False))


def merge_manifests(shards: list[DataFrame]) -> DataFrame:
    """The rows of all shards under one schema; columns that a shard lacks are null there."""
    if not shards:
        raise ValueError("no shard")
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def merge_caches(shards: list[DataFrame], key: str = "name") -> DataFrame:
    """One value a key: that of the last shard that holds the key."""
    whole = None
    for i, s in enumerate(shards):
        part = s.withColumn("_i", F.lit(i))
        whole = part if whole is None else whole.unionByName(part)
    rest = [c for c in whole.columns if c not in (key, "_i")]
    return whole.groupBy(key).agg(F.max_by(F.struct(*rest), "_i").alias("v")).select(key, "v.*")
