"""Queries over the nested pages (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phyllo.operators import nested
from phyllo.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    found = nested.complete_photos(table(spark, d, "gbif_pages"), table(spark, d, "inat_pages"))
    return found.select("service", "page_id", "result_pos", "parent_id", "photo_pos")


def p1_gbif_photos(spark: SparkSession, d: str) -> DataFrame:
    return nested.gbif_tables(table(spark, d, "gbif_pages"))["photos"].select("page_id", "result_pos", "parent_id", "photo_pos", "license", "url", "media_type")


def p1_gbif_parents(spark: SparkSession, d: str) -> DataFrame:
    return nested.gbif_tables(table(spark, d, "gbif_pages"))["parents"].select("page_id", "result_pos", "parent_id", "license", "recorded_by", "scientific_name")


def p1_inat_photos(spark: SparkSession, d: str) -> DataFrame:
    return nested.inat_tables(table(spark, d, "inat_pages"))["photos"].select("page_id", "result_pos", "parent_id", "photo_pos", "license", "url", "photo_id")


def p1_inat_parents(spark: SparkSession, d: str) -> DataFrame:
    return nested.inat_tables(table(spark, d, "inat_pages"))["parents"].select("page_id", "result_pos", "parent_id", "uri", "user_login", "taxon_name")


_GBIF_RESULTS = "SELECT page_id, unnest(results) AS r, unnest(range(len(results))) AS result_pos FROM gbif_pages"
_GBIF_PHOTOS = f"SELECT page_id, result_pos, r.occ_key AS parent_id, unnest(r.media) AS m, unnest(range(len(r.media))) AS photo_pos FROM ({_GBIF_RESULTS})"
_INAT_RESULTS = """SELECT page_id, r, result_pos FROM (
  SELECT page_id, unnest(rs) AS r, unnest(range(len(rs))) AS result_pos FROM (
    SELECT page_id, from_json(CASE WHEN json_valid(body) THEN json_extract(body, '$.results') END, '["JSON"]') AS rs FROM inat_pages))"""
_INAT_PHOTOS = f"""SELECT page_id, result_pos, TRY_CAST(r->>'$.id' AS BIGINT) AS parent_id, unnest(ps) AS m, unnest(range(len(ps))) AS photo_pos FROM (
  SELECT page_id, result_pos, r, from_json(CASE json_type(r, '$.photos') WHEN 'OBJECT' THEN json_array(r->'$.photos') WHEN 'ARRAY' THEN r->'$.photos' END, '["JSON"]') AS ps FROM ({_INAT_RESULTS}))"""
_STATED = r"regexp_matches(coalesce({0}, ''), '[^\s\p{{Z}}]')"

QUERIES = {"p1_found": p1_found, "p1_gbif_photos": p1_gbif_photos, "p1_gbif_parents": p1_gbif_parents, "p1_inat_photos": p1_inat_photos, "p1_inat_parents": p1_inat_parents}
SQL = {
    "p1_found": f"""SELECT 'gbif' AS service, page_id, CAST(result_pos AS INTEGER) AS result_pos, parent_id, CAST(photo_pos AS INTEGER) AS photo_pos
FROM ({_GBIF_PHOTOS}) WHERE {_STATED.format("m.license")} AND {_STATED.format("m.identifier")}
UNION ALL SELECT 'inaturalist', page_id, CAST(result_pos AS INTEGER), parent_id, CAST(photo_pos AS INTEGER)
FROM ({_INAT_PHOTOS}) WHERE {_STATED.format("(m->>'$.license_code')")} AND {_STATED.format("(m->>'$.url')")}""",
    "p1_gbif_photos": f"SELECT page_id, CAST(result_pos AS INTEGER) AS result_pos, parent_id, CAST(photo_pos AS INTEGER) AS photo_pos, m.license AS license, m.identifier AS url, m.media_type AS media_type FROM ({_GBIF_PHOTOS})",
    "p1_gbif_parents": f"SELECT page_id, CAST(result_pos AS INTEGER) AS result_pos, r.occ_key AS parent_id, r.license AS license, r.recorded_by AS recorded_by, r.scientific_name AS scientific_name FROM ({_GBIF_RESULTS})",
    "p1_inat_photos": f"SELECT page_id, CAST(result_pos AS INTEGER) AS result_pos, parent_id, CAST(photo_pos AS INTEGER) AS photo_pos, m->>'$.license_code' AS license, m->>'$.url' AS url, m->>'$.id' AS photo_id FROM ({_INAT_PHOTOS})",
    "p1_inat_parents": f"SELECT page_id, CAST(result_pos AS INTEGER) AS result_pos, TRY_CAST(r->>'$.id' AS BIGINT) AS parent_id, r->>'$.uri' AS uri, r->>'$.user.login' AS user_login, r->>'$.taxon.name' AS taxon_name FROM ({_INAT_RESULTS})",
}
