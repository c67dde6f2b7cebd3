"""Nested records to related flat tables, by Arrow buffers: no row is parsed or copied one by one.

``child_table`` turns a column of arrays of objects (any depth) into the flat table of one level. Per Arrow batch it
takes the list offsets of every level, derives the parent index and the position of each child from them, and
propagates the keys by a vectorised ``take``. Partitions are independent, so there is no shuffle.

Defined results: a null or empty array has no children; a null element is a child row whose fields are null and whose
position counts; null keys are kept; an empty table gives an empty table; field names may equal key names as long as
the aliases differ (equal aliases raise ValueError).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phyllo.session import ship


def _positions(parent: pa.Array) -> pa.Array:
    """0, 1, 2 ... within each run of equal parent indices."""
    n = len(parent)
    if not n:
        return pa.array([], pa.int32())
    import numpy as np

    p = parent.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    lengths = np.diff(np.r_[starts, n])
    return pa.array((np.arange(n) - np.repeat(starts, lengths)).astype("int32"))


def explode_batch(batch: pa.RecordBatch, keys: dict[str, str], levels: list[dict], fields: dict[str, str]) -> pa.RecordBatch:
    """The rows of the last level in one batch. keys: {column: alias}; levels: [{array, pos, carry: {field: alias}}]."""
    out = {alias: batch.column(name) for name, alias in keys.items()}
    objects = None
    for level in levels:
        lists = batch.column(level["array"]) if objects is None else pc.struct_field(objects, level["array"])
        parent = pc.list_parent_indices(lists)
        objects = pc.list_flatten(lists)
        out = {alias: pc.take(values, parent) for alias, values in out.items()}
        out[level["pos"]] = _positions(parent)
        for name, alias in level.get("carry", {}).items():
            out[alias] = pc.struct_field(objects, name)
    for name, alias in fields.items():
        out[alias] = pc.struct_field(objects, name)
    return pa.RecordBatch.from_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in out.values()], names=list(out))


def child_table(df: DataFrame, keys: dict[str, str], levels: list[dict], fields: dict[str, str]) -> DataFrame:
    """The flat table of the last of ``levels``, with keys and positions that link it to its parents.

    keys: {column of df: name in the result}; levels: from the outermost array inwards, each with ``array`` (the
    column, or the field of the level above), ``pos`` (name of the position from 0) and optionally ``carry`` (fields of
    that level's objects kept as keys of their children); fields: {field of the last level: name in the result}.
    """
    names = [*keys.values(), *(x for lv in levels for x in (lv["pos"], *lv.get("carry", {}).values())), *fields.values()]
    if len({x.lower() for x in names}) < len(names):
        raise ValueError(f"two columns of the result have one name: {names}")
    source = df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{levels[0]['array']}`"))
    schema, kind = T.StructType(), None
    for k, alias in keys.items():
        schema.add(alias, df.schema[k].dataType)
    for lv in levels:
        kind = (df.schema if kind is None else kind)[lv["array"]].dataType.elementType
        schema.add(lv["pos"], T.IntegerType())
        for f, alias in lv.get("carry", {}).items():
            schema.add(alias, kind[f].dataType)
    for f, alias in fields.items():
        schema.add(alias, kind[f].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield explode_batch(batch, keys, levels, fields)

    ship(df.sparkSession)
    return source.mapInArrow(run, schema)


def stated(c: Column | str) -> Column:
    """Neither null nor blank; any Unicode white space is blank."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(r"[^\s\p{Z}\x{200B}\x{FEFF}]"), F.lit(False))


GBIF_PARENT = {
    "occ_key": "parent_id", "dataset_key": "dataset_key", "basis_of_record": "basis_of_record", "license": "license",
    "recorded_by": "recorded_by", "rights_holder": "rights_holder", "ref_url": "ref_url",
    "publishing_org_key": "publishing_org_key", "scientific_name": "scientific_name",
}
GBIF_MEDIA = {
    "media_type": "media_type", "media_format": "media_format", "ref_url": "ref_url", "created": "created", "creator": "creator",
    "publisher": "publisher", "license": "license", "rights_holder": "rights_holder", "identifier": "url",
}


def gbif_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """pages, parents (occurrences) and photos (media) of GBIF occurrence pages; every level keeps page_id and positions."""
    outer = {"array": "results", "pos": "result_pos"}
    return {
        "pages": pages.select("page_id", "fetched_at", "page_offset", "page_limit", "end_of_records", "total_count", F.size(F.coalesce("results", F.array())).alias("n_results")),
        "parents": child_table(pages, {"page_id": "page_id"}, [outer], GBIF_PARENT),
        "photos": child_table(pages, {"page_id": "page_id"}, [outer | {"carry": {"occ_key": "parent_id"}}, {"array": "media", "pos": "photo_pos"}], GBIF_MEDIA),
    }


def inat_results(pages: DataFrame) -> DataFrame:
    """The bodies as typed nested columns, read by Spark's variant parser in the JVM.

    Each field is read on its own, so a key that is missing, null, misplaced or of another type gives a null there and
    harms nothing else; numbers may be text. A single photo object counts as an array of one. A body that is null or no
    JSON (cut off) has ``readable`` false and no results; an error message is readable and has no results.
    """
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))

    def photo(p: Column) -> Column:
        return F.when(p.isNotNull() & ~F.is_variant_null(p), F.struct(
            get(p, "$.id", "string").alias("id"), get(p, "$.license_code", "string").alias("license_code"), get(p, "$.url", "string").alias("url"),
            get(p, "$.attribution", "string").alias("attribution"), get(p, "$.original_dimensions.width", "int").alias("width"),
            get(p, "$.original_dimensions.height", "int").alias("height"), get(p, "$.hidden", "boolean").alias("hidden"),
        ))

    def result(r: Column) -> Column:
        photos = get(r, "$.photos", "variant")
        many = F.when(is_object(photos), F.array(photos)).otherwise(get(r, "$.photos", "array<variant>"))
        return F.when(r.isNotNull() & ~F.is_variant_null(r), F.struct(
            get(r, "$.id", "bigint").alias("id"), get(r, "$.uri", "string").alias("uri"), get(r, "$.quality_grade", "string").alias("quality_grade"),
            get(r, "$.captive", "boolean").alias("captive"), get(r, "$.license_code", "string").alias("license_code"),
            get(r, "$.user.login", "string").alias("user_login"), get(r, "$.user.name", "string").alias("user_name"),
            get(r, "$.taxon.id", "bigint").alias("taxon_id"), get(r, "$.taxon.name", "string").alias("taxon_name"),
            F.transform(many, photo).alias("photos"),
        ))

    body = pages.select("page_id", "fetched_at", "http_status", F.try_parse_json("body").alias("v"))
    return body.select(
        "page_id", "fetched_at", "http_status", F.col("v").isNotNull().alias("readable"),
        get(F.col("v"), "$.total_results", "bigint").alias("total_results"), get(F.col("v"), "$.page", "int").alias("page"), get(F.col("v"), "$.per_page", "int").alias("per_page"),
        F.transform(get(F.col("v"), "$.results", "array<variant>"), result).alias("results"),
    )


INAT_PARENT = {
    "id": "parent_id", "uri": "uri", "quality_grade": "quality_grade", "captive": "captive", "license_code": "license_code",
    "user_login": "user_login", "user_name": "user_name", "taxon_id": "taxon_id", "taxon_name": "taxon_name",
}
INAT_PHOTO = {"id": "photo_id", "license_code": "license", "url": "url", "attribution": "attribution", "width": "width", "height": "height", "hidden": "hidden"}


def inat_tables(pages: DataFrame) -> dict[str, DataFrame]:
    """pages, parents (observations) and photos of iNaturalist observation pages, linked like ``gbif_tables``."""
    nested = inat_results(pages)
    outer = {"array": "results", "pos": "result_pos"}
    return {
        "pages": nested.select("page_id", "fetched_at", "http_status", "readable", "total_results", "page", "per_page", F.size(F.coalesce("results", F.expr("array()"))).alias("n_results")),
        "parents": child_table(nested, {"page_id": "page_id"}, [outer], INAT_PARENT),
        "photos": child_table(nested, {"page_id": "page_id"}, [outer | {"carry": {"id": "parent_id"}}, {"array": "photos", "pos": "photo_pos"}], INAT_PHOTO),
    }


def complete_photos(gbif_pages: DataFrame, inat_pages: DataFrame) -> DataFrame:
    """The photos of both services whose own licence and own address are both stated."""
    out = None
    for service, photos in (("gbif", gbif_tables(gbif_pages)["photos"]), ("inaturalist", inat_tables(inat_pages)["photos"])):
        part = photos.where(stated("license") & stated("url")).select(F.lit(service).alias("service"), "page_id", "result_pos", "parent_id", "photo_pos", "license", "url")
        out = part if out is None else out.unionByName(part)
    return out
