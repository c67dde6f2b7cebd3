"""Queries of ingest, names, licences, duplicates and splits over the collection's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phyllo.functions import licenses, names, scalars
from phyllo.operators import catalog, dedup, ingest, logs, splits
from phyllo.operators.hamming import hash_bits
from phyllo.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_HASH = "CASE WHEN regexp_matches(trim(phash), '^[0-9A-Fa-f]{16}$') THEN CAST('0x' || trim(phash) AS UBIGINT) END"
_KEPT = f"kept AS (SELECT seq, species, checksum, coalesce(downloaded_at, '') AS at, {_HASH} AS h FROM records WHERE status = 'kept')"
_CAPTIVE = "coalesce(lower(trim(extra['captive'])) IN ('true', 'yes', '1', 't', 'y', 'on'), false)"
_GROUP = "source || ':' || coalesce(nullif(trim(observation_id), ''), source_id)"
_FRACTION = "CAST('0x' || substr(sha256('flora-v1:' || {0}), 1, 8) AS BIGINT) / 4294967295.0::DOUBLE"
_SPLIT = f"CASE WHEN {_FRACTION} < 0.8 THEN 'train' WHEN {_FRACTION} < 0.9 THEN 'val' ELSE 'test' END"

# --- duplicates --------------------------------------------------------------------------------------------------------


@query("""SELECT seq, CASE WHEN later THEN 'duplicate' ELSE status END AS status, CASE WHEN later THEN checksum ELSE duplicate_of END AS duplicate_of FROM (
  SELECT seq, status, checksum, duplicate_of, status = 'kept' AND coalesce(trim(checksum), '') <> '' AND row_number() OVER (PARTITION BY checksum, status ORDER BY seq) > 1 AS later FROM records)""")
def ded01_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, d, "records")).select("seq", "status", "duplicate_of")


@query(f"WITH {_KEPT}, c AS (SELECT min(seq) AS id, h, species FROM kept WHERE h IS NOT NULL GROUP BY h, species) SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM c a JOIN c b ON a.species = b.species AND a.id < b.id AND bit_count(xor(a.h, b.h)) <= 6")
def ded02_near_pairs(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "records").where("status = 'kept'").select("seq", "species", hash_bits("phash").alias("h"))
    return dedup.near_pairs(kept, 6, "species")


@query(f"WITH {_KEPT} SELECT seq AS id, min(seq) OVER (PARTITION BY h, species) AS class FROM kept WHERE h IS NOT NULL")
def ded02_classes(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "records").where("status = 'kept'").select("seq", "species", hash_bits("phash").alias("h"))
    return dedup.hash_classes(kept, "species")


_BLOCK = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
  m AS (SELECT vec_id, label, e, list_sort(e[2:])[32] AS med FROM v),
  hs AS (SELECT vec_id, label, CAST(list_sum(list_transform(range(64), lambda i: CASE WHEN e[i + 1] > med THEN CAST(power(2, 63 - i) AS UBIGINT)::HUGEINT ELSE 0::HUGEINT END)) AS UBIGINT) AS h FROM m)"""


def _hashes(spark: SparkSession, d: str) -> DataFrame:
    """The embeddings read as 8 x 8 blocks of frequencies."""
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("seq"), F.col("label").alias("species"), scalars.hash_of_block(F.transform("embedding", lambda x: x.cast("double"))).alias("h"))


@query(f"WITH {_BLOCK} SELECT a.vec_id AS a, b.vec_id AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance FROM (SELECT min(vec_id) AS vec_id, h FROM hs GROUP BY h) a JOIN (SELECT min(vec_id) AS vec_id, h FROM hs GROUP BY h) b ON a.vec_id < b.vec_id AND bit_count(xor(a.h, b.h)) <= 20")
def ded02_near_pairs_t20(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_pairs(_hashes(spark, d), 20)


_NEAR_EDGES = f"""{_KEPT}, edge AS (SELECT a.seq AS a, b.seq AS b FROM kept a JOIN kept b ON a.species = b.species AND a.seq <> b.seq AND bit_count(xor(a.h, b.h)) <= 6),
  reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)"""


@query(f"WITH RECURSIVE {_NEAR_EDGES} SELECT a AS seq, least(a, min(b)) AS root FROM reach GROUP BY a")
def ded03_components(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "records").where("status = 'kept'").select("seq", "species", hash_bits("phash").alias("h"))
    return dedup.hash_components(kept, 6, "species")


@query(f"""WITH RECURSIVE exact AS (SELECT *, status = 'kept' AND coalesce(trim(checksum), '') <> '' AND row_number() OVER (PARTITION BY checksum, status ORDER BY seq) > 1 AS later FROM records),
  kept AS (SELECT seq, species, coalesce(downloaded_at, '') AS ts, {_HASH} AS h FROM exact WHERE status = 'kept' AND NOT later),
  edge AS (SELECT a.seq AS a, b.seq AS b FROM kept a JOIN kept b ON a.species = b.species AND a.seq <> b.seq AND bit_count(xor(a.h, b.h)) <= 6),
  reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
  grp AS (SELECT a AS seq, least(a, min(b)) AS root FROM reach GROUP BY a),
  lost AS (SELECT seq FROM (SELECT grp.seq, row_number() OVER (PARTITION BY root ORDER BY ts, grp.seq) AS n FROM grp JOIN kept USING (seq)) WHERE n > 1)
  SELECT CASE WHEN later THEN 'duplicate' WHEN seq IN (SELECT seq FROM lost) THEN 'duplicate' ELSE status END AS status,
    CASE WHEN later THEN 'exact duplicate' WHEN seq IN (SELECT seq FROM lost) THEN 'near-duplicate (perceptual hash)' ELSE 'unchanged' END AS step, count(*) AS n FROM exact GROUP BY ALL""")
def ded04_marked_counts(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "records")
    marked = dedup.mark_duplicates(records).select("seq", F.col("status").alias("now"), F.col("reason").alias("why"))
    both = records.select("seq", "status").join(marked, "seq")
    return both.groupBy(F.col("now").alias("status"), F.when(F.col("now") == F.col("status"), "unchanged").otherwise(F.col("why")).alias("step")).agg(F.count("*").alias("n"))


@query(f"WITH {_KEPT} SELECT a.seq, min(b.seq) AS other_seq FROM kept a JOIN kept b ON a.species <> b.species AND bit_count(xor(a.h, b.h)) <= 6 GROUP BY a.seq")
def ded05_cross_species(spark: SparkSession, d: str) -> DataFrame:
    return dedup.cross_species(table(spark, d, "records"))


# --- manifest and splits -----------------------------------------------------------------------------------------------


@query("""SELECT species, status, CAST(NULL AS VARCHAR) AS license, CAST(NULL AS VARCHAR) AS source, count(*) AS n FROM records GROUP BY species, status
  UNION ALL SELECT NULL, NULL, license, NULL, count(*) FROM records WHERE status = 'kept' GROUP BY license
  UNION ALL SELECT NULL, NULL, NULL, source, count(*) FROM records WHERE status = 'kept' GROUP BY source""")
def agg01_manifest_stats(spark: SparkSession, d: str) -> DataFrame:
    return ingest.manifest_stats(table(spark, d, "records"))


@query("SELECT species, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM splits GROUP BY species")
def agg03_split_counts(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_counts(table(spark, d, "splits").select("species", "split"))


@query("SELECT species FROM splits GROUP BY species HAVING count(*) FILTER (split = 'val') = 0 ORDER BY species LIMIT 8")
def agg04_without_validation(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "splits").groupBy("species").agg(F.count_if(F.col("split") == "val").alias("n"))
    return counts.where("n = 0").orderBy("species").limit(8).select("species")


@query(f"SELECT seq, {_SPLIT.format(_GROUP)} AS split, {_FRACTION.format(_GROUP)} AS fraction FROM records WHERE status = 'kept'")
def spl02_hash_split(spark: SparkSession, d: str) -> DataFrame:
    key = scalars.group_key("source", "observation_id", "source_id")
    return table(spark, d, "records").where("status = 'kept'").select("seq", scalars.split_of(key).alias("split"), scalars.split_fraction(key).alias("fraction"))


_GROUPS = f"""own AS (SELECT seq, species, checksum, {_GROUP} AS key, {_HASH} AS h FROM records WHERE status = 'kept'),
  edge AS (SELECT a.seq AS a, b.seq AS b FROM own a JOIN own b ON a.seq <> b.seq AND (a.key = b.key OR (a.checksum = b.checksum AND a.checksum <> '') OR (a.species = b.species AND bit_count(xor(a.h, b.h)) <= 6))),
  reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
  root AS (SELECT own.seq, least(own.seq, coalesce(min(b), own.seq)) AS root FROM own LEFT JOIN reach ON a = own.seq GROUP BY own.seq),
  named AS (SELECT root.seq, o.key AS group_id FROM root JOIN own o ON o.seq = root.root)"""


@query(f"WITH RECURSIVE {_GROUPS} SELECT seq, group_id FROM named")
def spl01_groups(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_groups(table(spark, d, "records"))


@query(f"WITH RECURSIVE {_GROUPS} SELECT r.species, {_SPLIT.format('group_id')} AS split, CASE WHEN {_CAPTIVE} THEN '1' ELSE '0' END AS captive, count(*) AS n FROM named JOIN records r USING (seq) GROUP BY ALL")
def spl05_split_counts(spark: SparkSession, d: str) -> DataFrame:
    return splits.make_splits(table(spark, d, "records"), repaired=False).groupBy("species", "split", "captive").agg(F.count("*").alias("n"))


def _moves(side: str, have: str, least: int, train: str) -> str:
    """CTEs that give the groups of ``train`` to move to a side: the smallest that suffices, or the smallest together, whichever moves fewer rows."""
    return f"""{side}_tr AS (SELECT t.species, group_id, n, {least} - {have} AS missing, row_number() OVER w AS k, sum(n) OVER w AS c, count(*) OVER (PARTITION BY t.species) AS g, sum(n) OVER (PARTITION BY t.species) AS total
    FROM {train} t JOIN side USING (species) WHERE {have} < {least} WINDOW w AS (PARTITION BY t.species ORDER BY n, group_id ROWS UNBOUNDED PRECEDING)),
  {side}_plan AS (SELECT species, min(k) AS low, min(k) AS high, min(n) AS weight, 1 AS len, any_value(g) AS g, any_value(total) AS total FROM {side}_tr WHERE n >= missing GROUP BY species
    UNION ALL SELECT species, 1, min(k), min(c), min(k), any_value(g), any_value(total) FROM {side}_tr WHERE c >= missing GROUP BY species),
  {side}_best AS (SELECT *, row_number() OVER (PARTITION BY species ORDER BY weight, len) AS place FROM {side}_plan WHERE len < g AND total - weight >= 25),
  {side}_moved AS (SELECT t.species, t.group_id, '{side}' AS split FROM {side}_tr t JOIN {side}_best b ON b.species = t.species AND b.place = 1 AND t.k BETWEEN b.low AND b.high)"""


@query(f"""WITH s AS (SELECT species, group_id, split, count(*) AS n FROM splits GROUP BY ALL),
  side AS (SELECT species, coalesce(sum(n) FILTER (split = 'val'), 0) AS v, coalesce(sum(n) FILTER (split = 'test'), 0) AS t FROM s GROUP BY species),
  train AS (SELECT species, group_id, n FROM s WHERE split = 'train'), {_moves('val', 'v', 3, 'train')},
  rest AS (SELECT * FROM train ANTI JOIN val_moved USING (species, group_id)), {_moves('test', 't', 1, 'rest')}
  SELECT * FROM val_moved UNION ALL SELECT * FROM test_moved""")
def spl04_repair(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "splits").groupBy("species", "group_id", "split").agg(F.count("*").alias("n"))
    return splits.repair(sizes)


_ENOUGH = """SELECT internal_plant_id, count(*) FILTER (split = 'train') AS n_train FROM splits GROUP BY 1
  HAVING n_train >= 20 AND count(*) FILTER (split = 'val') >= 3 AND count(*) FILTER (split = 'test') >= 3 ORDER BY n_train DESC, internal_plant_id LIMIT 40"""


@query(_ENOUGH)
def top02_largest_classes(spark: SparkSession, d: str) -> DataFrame:
    return splits.choose_classes(table(spark, d, "splits"), 40, 20, 3, 3)


@query(f"""SELECT path, internal_plant_id, split FROM (SELECT DISTINCT path, internal_plant_id, split, dense_rank() OVER (PARTITION BY internal_plant_id, split ORDER BY path) AS n FROM splits
  WHERE internal_plant_id IN (SELECT internal_plant_id FROM ({_ENOUGH}))) WHERE n <= CASE split WHEN 'train' THEN 20 ELSE 3 END""")
def spl07_quota_sample(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "splits").select("path", "internal_plant_id", "split")
    chosen = splits.choose_classes(own, 40, 20, 3, 3)
    return splits.quota_sample(own.distinct(), {"train": 20, "val": 3, "test": 3}, chosen).select("path", "internal_plant_id", "split")


_INDOOR, _OUTDOOR = "family IN ('Paroraceae', 'Ganallaceae')", "family IN ('Ganallaceae', 'Valillaceae', 'Lenollaceae')"


@query(f"""WITH t AS (SELECT DISTINCT path, internal_plant_id, captive, coalesce(group_id, '') AS group_id FROM splits WHERE split = 'test'),
  m AS (SELECT group_id FROM t GROUP BY 1 HAVING count(*) >= 2 AND group_id <> ''), i AS (SELECT internal_id FROM plants WHERE {_INDOOR}), o AS (SELECT internal_id FROM plants WHERE {_OUTDOOR}),
  k AS (SELECT *, CASE WHEN group_id IN (SELECT group_id FROM m) THEN 'multi' WHEN internal_plant_id IN (FROM i) THEN CASE WHEN captive = '1' THEN 'indoor' END WHEN internal_plant_id IN (FROM o) THEN 'outdoor' ELSE 'ood_plant' END AS slice,
    CASE WHEN group_id <> '' THEN group_id ELSE path END AS g FROM t
    UNION ALL SELECT DISTINCT path, '', '0', split_part(path, '/', 1), 'ood_other', split_part(path, '/', 1) FROM records WHERE status = 'rejected' AND path <> ''),
  n AS (SELECT slice, g, count(*) AS n FROM k WHERE slice IS NOT NULL GROUP BY ALL),
  c AS (SELECT slice, g, sum(n) OVER (PARTITION BY slice ORDER BY md5('slice-1-' || slice || ':' || g), g) - n AS before FROM n)
  SELECT slice, path, internal_plant_id, group_id, captive FROM k JOIN (SELECT slice, g FROM c WHERE before < 120) USING (slice, g)""")
def spl08_slices(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plants")
    side = lambda where: p.where(where).select(F.col("internal_id").alias("class_id"))
    rejected = table(spark, d, "records").where("status = 'rejected' AND path <> ''")  # they stand in for pictures of no plant
    other = rejected.select("path", F.split("path", "/")[0].alias("folder")).distinct()
    return splits.slices(table(spark, d, "splits"), side(_INDOOR), side(_OUTDOOR), 120, other=other)


@query("SELECT internal_plant_id FROM splits GROUP BY 1 HAVING count(*) FILTER (split = 'train') >= 25 AND count(*) FILTER (split = 'val') >= 3")
def prd09_usable_classes(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "splits").groupBy("internal_plant_id").agg(F.count_if(F.col("split") == "train").alias("t"), F.count_if(F.col("split") == "val").alias("v"))
    return n.where("t >= 25 AND v >= 3").select("internal_plant_id")


@query("SELECT group_id, count(*) AS n, arg_max(captive, path) AS captive, string_agg(path, '|' ORDER BY path) AS paths FROM splits WHERE split = 'test' AND group_id <> '' GROUP BY group_id HAVING count(*) >= 2")
def src06_test_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "splits").where("split = 'test' AND group_id <> ''")
    return rows.groupBy("group_id").agg(F.count("*").alias("n"), F.max_by("captive", "path").alias("captive"), F.array_join(F.array_sort(F.collect_list("path")), "|").alias("paths")).where("n >= 2")


@query("SELECT split, count(*) AS n, count(*) FILTER (EXISTS (SELECT 1 FROM records r WHERE r.path = s.path)) AS present FROM splits s GROUP BY split")
def src03_present_files(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "records").select("path").distinct().withColumn("there", F.lit(True))
    return table(spark, d, "splits").select("path", "split").join(known, "path", "left").groupBy("split").agg(F.count("*").alias("n"), F.count("there").alias("present"))


@query("SELECT internal_plant_id, arg_min(species, seq) AS species FROM records WHERE internal_plant_id <> '' GROUP BY 1")
def src10_species_names(spark: SparkSession, d: str) -> DataFrame:
    return ingest.first_names(table(spark, d, "records"))


@query("SELECT species, author, source_id, license, original_url FROM records WHERE status = 'kept'")
def snk03_attributions(spark: SparkSession, d: str) -> DataFrame:
    return ingest.attributions(table(spark, d, "records")).select("species", "author", "source_id", "license", "original_url")


@query("""SELECT seq, CASE status WHEN 'rejected' THEN '_rejected/' WHEN 'duplicate' THEN '_duplicates/' WHEN 'review' THEN '_review/' ELSE '' END || regexp_replace(path, '^(_rejected|_duplicates|_review)/', '') AS path
  FROM records WHERE path <> ''""")
def snk11_relocated(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "records").where("path <> ''").select("seq", scalars.status_path("status", "path").alias("path"))


# --- ingest ------------------------------------------------------------------------------------------------------------

_MEDIA = """SELECT page_id, r, result_pos, unnest(r.media) AS m, unnest(range(len(r.media))) AS pos FROM (SELECT page_id, unnest(results) AS r, unnest(range(len(results))) AS result_pos FROM gbif_pages)"""


@query(f"""SELECT page_id, r.occ_key || '#' || pos AS source_id, m.identifier AS image_url, coalesce(nullif(m.license, ''), r.license) AS license,
  coalesce(nullif(m.creator, ''), nullif(m.rights_holder, ''), nullif(r.recorded_by, ''), r.rights_holder) AS author FROM ({_MEDIA}) WHERE m.media_type = 'StillImage' AND m.identifier LIKE 'http%'""")
def prd04_gbif_candidates(spark: SparkSession, d: str) -> DataFrame:
    return ingest.gbif_candidates(table(spark, d, "gbif_pages")).select("page_id", "source_id", "image_url", "license", "author")


@query("""WITH r AS (SELECT page_id, unnest(from_json(CASE WHEN json_valid(body) THEN json_extract(body, '$.results') END, '["JSON"]')) AS r FROM inat_pages),
  p AS (SELECT page_id, r, unnest(from_json(CASE json_type(r, '$.photos') WHEN 'OBJECT' THEN json_array(r->'$.photos') WHEN 'ARRAY' THEN r->'$.photos' END, '["JSON"]')) AS p FROM r)
  SELECT page_id, (r->>'$.id') || '#' || (p->>'$.id') AS source_id, replace(p->>'$.url', '/square.', '/large.') AS image_url, p->>'$.license_code' AS license FROM p
  WHERE p->>'$.url' LIKE 'http%' AND coalesce(p->>'$.hidden', 'false') <> 'true' AND p->>'$.license_code' <> ''""")
def prd05_inat_candidates(spark: SparkSession, d: str) -> DataFrame:
    return ingest.inat_candidates(table(spark, d, "inat_pages")).select("page_id", "source_id", "image_url", "license")


@query(f"""WITH c AS (SELECT r.occ_key || '#' || pos AS source_id, m.identifier AS image_url, page_id FROM ({_MEDIA}) WHERE m.media_type = 'StillImage' AND m.identifier LIKE 'http%')
  SELECT source_id, image_url FROM (SELECT *, row_number() OVER (PARTITION BY photo ORDER BY page_id, source_id) AS n FROM (
    SELECT *, coalesce(nullif(regexp_extract(image_url, '/photos/(\\d+)/', 1), ''), image_url) AS photo FROM c WHERE source_id NOT IN (SELECT source_id FROM records WHERE source = 'gbif' AND source_id IS NOT NULL))) WHERE n = 1""")
def jn04_new_candidates(spark: SparkSession, d: str) -> DataFrame:
    found = ingest.gbif_candidates(table(spark, d, "gbif_pages"))
    return ingest.new_candidates(found, table(spark, d, "records").where("source = 'gbif'"), ["page_id", "source_id"]).select("source_id", "image_url")


@query("""SELECT seq, first_seq FROM (SELECT seq, min(seq) OVER (PARTITION BY checksum) AS first_seq FROM records WHERE coalesce(checksum, '') <> '') WHERE seq <> first_seq""")
def jn06_known_checksums(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "records").where("coalesce(checksum, '') <> ''").select("seq", "checksum")
    first = rows.groupBy("checksum").agg(F.min("seq").alias("first_seq"))
    return rows.join(first, "checksum").where("seq <> first_seq").select("seq", "first_seq")


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id, count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM events) WHERE b < 3")
def win03_running_quota(spark: SparkSession, d: str) -> DataFrame:
    return splits.running_quota(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "purchase", F.lit(3)).select("event_id", "user_id")


@query("SELECT internal_id, CAST((row_number() OVER (ORDER BY scientific_name, internal_id) - 1) % 3 AS INTEGER) AS shard FROM plants")
def win12_round_robin(spark: SparkSession, d: str) -> DataFrame:
    return splits.round_robin(table(spark, d, "plants").select("internal_id", "scientific_name"), ["scientific_name", "internal_id"], 3).select("internal_id", "shard")


# --- names and licences ------------------------------------------------------------------------------------------------


@query("SELECT internal_id, internal_id AS made, regexp_replace(regexp_replace(replace(scientific_name, '×', 'x'), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM plants")
def scl03_slug_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plants").select("internal_id", names.internal_id("scientific_name").alias("made"), names.slug("scientific_name").alias("slug"))


@query("SELECT internal_id, genus, CASE WHEN scientific_name LIKE '× %' THEN genus ELSE epithet END AS epithet FROM plants")
def scl05_genus_epithet(spark: SparkSession, d: str) -> DataFrame:
    s = names.canonical_name("scientific_name")
    return table(spark, d, "plants").select("internal_id", names.genus_of(s).alias("genus"), names.epithet_of(s).alias("epithet"))


@query("""SELECT license, n, code, CASE code WHEN 'CC0 1.0' THEN 'https://creativecommons.org/publicdomain/zero/1.0/' ELSE 'https://creativecommons.org/licenses/' || lower(split_part(code, ' ', 2)) || '/' || split_part(code, ' ', 3) || '/' END AS url,
    NOT contains(code, 'NC') AS commercial, contains(code, 'SA') AS share_alike, NOT contains(code, 'ND') AS derivatives, coalesce(NOT contains(code, 'NC') AND NOT contains(code, 'ND') AND NOT contains(code, 'SA'), false) AS allowed
  FROM (SELECT license, count(*) AS n, CASE
    WHEN license IN ('CC BY 4.0', 'CC_BY_4_0', 'cc-by') THEN 'CC BY 4.0' WHEN license IN ('CC0 1.0', 'cc0') THEN 'CC0 1.0' WHEN license = 'CC BY-NC 4.0' THEN 'CC BY-NC 4.0'
    WHEN license = 'CC BY-SA 4.0' THEN 'CC BY-SA 4.0' WHEN license = 'CC BY 3.0' THEN 'CC BY 3.0' END AS code FROM records GROUP BY license)""")
def scl10_parse_license(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "records").groupBy("license").agg(F.count("*").alias("n")).withColumn("l", licenses.parse_license("license"))
    return rows.select("license", "n", *[F.col(f"l.{c}").alias(c) for c in ("code", "url", "commercial", "share_alike", "derivatives")], licenses.is_allowed(F.col("l")).alias("allowed"))


@query("SELECT seq, nullif(regexp_extract(image_url, '/photos/(\\d+)/', 1), '') AS photo_id FROM records")
def scl07_photo_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "records").select("seq", scalars.photo_id_of("image_url").alias("photo_id"))


@query("""SELECT doc_id, substr(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#039;', ''''), '&nbsp;', ' '), '[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g')), 1, 200) AS plain FROM documents""")
def scl09_plain_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scalars.plain_text("text").alias("plain"))


@query(f"SELECT CAST(i AS INTEGER) AS band, CAST((h >> CAST(64 * i // 7 AS UBIGINT)) & CAST((1 << (64 * (i + 1) // 7 - 64 * i // 7)) - 1 AS UBIGINT) AS BIGINT) AS value, count(*) AS n FROM (SELECT {_HASH} AS h FROM records) r, (SELECT unnest(range(7)) AS i) WHERE h IS NOT NULL GROUP BY ALL")
def scl16_band_values(spark: SparkSession, d: str) -> DataFrame:
    """How many hashes have each value in each of the seven bands."""
    from phyllo.operators.hamming import band, bands

    rows = table(spark, d, "records").select(hash_bits("phash").alias("h")).where("h IS NOT NULL")
    return rows.select(F.posexplode(F.array(*[band(F.col("h"), c) for c in bands(7)])).alias("band", "value")).groupBy("band", "value").agg(F.count("*").alias("n"))


# --- catalogue ---------------------------------------------------------------------------------------------------------

#: Of a synonym genus, hybrid sign and epithet, as an id; what follows them is its authority.
_SYNONYM = "regexp_extract(lower(trim(regexp_replace(replace(replace(strip_accents(s), '×', ' x '), '_', ' '), '[\\s\\x{A0}]+', ' ', 'g'))), '^([a-z-]+ (?:x )?[a-z-]+)', 1)"
_ALIAS = f"SELECT alias, internal_id FROM (SELECT internal_id, replace({_SYNONYM}, ' ', '-') AS alias FROM (SELECT internal_id, unnest(string_split(synonyms, '|')) AS s FROM plants WHERE synonyms <> '')) WHERE alias <> ''"


@query(f"SELECT alias, min(internal_id) AS internal_id FROM (SELECT internal_id AS alias, internal_id FROM plants UNION ALL {_ALIAS}) GROUP BY alias")
def jn09_alias_map(spark: SparkSession, d: str) -> DataFrame:
    return catalog.alias_map(table(spark, d, "plants"))


@query()
def jn01_match_catalog(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "name_answers").select("answer_id", F.coalesce("matched_as", "canonical_name").alias("name"))
    return catalog.match_to_catalog(asked, table(spark, d, "plants"), "answer_id", "name")


@query("SELECT string_agg(internal_id, '|' ORDER BY internal_id) AS ids, genus FROM plants GROUP BY genus HAVING count(*) > 1")
def agg09_same_key_groups(spark: SparkSession, d: str) -> DataFrame:
    return catalog.same_key_groups(table(spark, d, "plants"), "genus", "internal_id").select("genus", F.array_join("members", "|").alias("ids"))


@query("SELECT genus, string_agg(epithet, '|' ORDER BY epithet) AS epithets FROM (SELECT DISTINCT genus, epithet FROM plants WHERE epithet <> '') GROUP BY genus")
def agg08_distinct_members(spark: SparkSession, d: str) -> DataFrame:
    return catalog.distinct_members(table(spark, d, "plants"), "genus", "epithet").select("genus", F.array_join("members", "|").alias("epithets"))


@query("""SELECT internal_id FROM (SELECT internal_id, row_number() OVER (PARTITION BY regexp_replace(internal_id, '(^|-)x-', '\\1') ORDER BY internal_id) AS n FROM plants
  WHERE regexp_replace(internal_id, '(^|-)x-', '\\1') NOT IN (SELECT regexp_replace(internal_plant_id, '(^|-)x-', '\\1') FROM splits WHERE internal_plant_id IS NOT NULL)) WHERE n = 1""")
def sel01_keep_candidates(spark: SparkSession, d: str) -> DataFrame:
    plants = table(spark, d, "plants").select("internal_id", F.col("internal_id").alias("ord"))
    known = table(spark, d, "splits").select(F.col("internal_plant_id").alias("id")).where("id IS NOT NULL").distinct()
    return catalog.keep_new(plants, known, "internal_id", "ord").select("internal_id")


@query("""WITH c AS (SELECT p.internal_id, count(r.seq) AS n FROM plants p LEFT JOIN records r ON r.internal_plant_id = p.internal_id AND r.status = 'kept' GROUP BY 1)
  SELECT CASE WHEN n < 0 THEN 'unresolved' WHEN n = 0 THEN 'empty' WHEN n < 25 THEN 'thin' ELSE 'solid' END AS band, count(*) AS n, median(n) FILTER (n >= 25) AS median FROM c GROUP BY 1""")
def agg05_bands(spark: SparkSession, d: str) -> DataFrame:
    counts = catalog.counts_per_plant(table(spark, d, "plants"), table(spark, d, "records"))
    return catalog.verdict(counts, 25)


@query("""WITH offered AS (SELECT species, count(*) AS n FROM records WHERE source = 'wikimedia' GROUP BY 1), already AS (SELECT species, count(*) AS n FROM records WHERE source <> 'wikimedia' GROUP BY 1)
  SELECT count(*) AS species, count(*) FILTER (o.n > 0) AS known, CAST(sum(o.n) AS BIGINT) AS total, median(o.n) AS median, count(*) FILTER (o.n < 10) AS thin, count(*) FILTER (a.n > 0 AND o.n >= a.n) AS doubled
  FROM offered o LEFT JOIN already a USING (species)""")
def agg06_gain(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "records")
    return catalog.gain(rows.where("source = 'wikimedia'").groupBy("species").agg(F.count("*").alias("n")), rows.where("source <> 'wikimedia'").groupBy("species").agg(F.count("*").alias("n")), 10)


@query("""SELECT source, count(*) AS n_all, count(*) FILTER (license IN ('CC BY 4.0', 'CC0 1.0', 'CC_BY_4_0', 'cc-by', 'cc0', 'CC BY 3.0')) AS n_free,
  count(DISTINCT species) FILTER (status = 'kept') AS kept_species, count(*) FILTER (extra['quality_grade'] = 'research') AS research FROM records GROUP BY source""")
def agg07_filtered_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "records")
    free = licenses.is_allowed(licenses.parse_license("license"))
    return rows.groupBy("source").agg(
        F.count("*").alias("n_all"), F.count_if(free).alias("n_free"), F.countDistinct(F.when(F.col("status") == "kept", F.col("species"))).alias("kept_species"),
        F.count_if(F.try_element_at("extra", F.lit("quality_grade")) == "research").alias("research"),
    )


@query("SELECT internal_id, kind FROM (SELECT DISTINCT r.internal_plant_id AS internal_id, CASE WHEN p.internal_id IS NULL THEN 'unlisted' ELSE 'listed' END AS kind FROM records r LEFT JOIN plants p ON p.internal_id = r.internal_plant_id WHERE r.internal_plant_id <> '') UNION ALL SELECT internal_id, 'unused' FROM plants WHERE internal_id NOT IN (SELECT internal_plant_id FROM records WHERE internal_plant_id IS NOT NULL)")
def jn15_class_algebra(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "records").where("internal_plant_id <> ''").select(F.col("internal_plant_id").alias("id"))
    return catalog.compare_sets(used, table(spark, d, "plants").select(F.col("internal_id").alias("id")), "unlisted", "unused", "listed").withColumnRenamed("id", "internal_id")


_RUNS = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text LIKE '%kept (gbif%'"
_FAILED = scalars.LOG_FAILED


@query(rf"SELECT reason, count(*) AS n FROM (SELECT doc_id, regexp_extract(line, '{_FAILED}', 1) AS name, arg_min(regexp_extract(line, '{_FAILED}', 2), pos) AS reason FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents WHERE text LIKE '%kept (gbif%') WHERE regexp_matches(line, '{_FAILED}') GROUP BY doc_id, name) GROUP BY reason")
def agg11_fail_reasons(spark: SparkSession, d: str) -> DataFrame:
    return logs.reasons(_lines(spark, d))


@query(rf"SELECT p.internal_id FROM plants p WHERE p.scientific_name NOT IN (SELECT regexp_extract(line, '^\[\d+/\d+\]\s+(.+?):\s', 1) FROM ({_RUNS}))")
def jn20_never_reached(spark: SparkSession, d: str) -> DataFrame:
    expected = table(spark, d, "plants").select("internal_id", F.col("scientific_name").alias("name"))
    return logs.never_reached(_lines(spark, d), expected).select("internal_id")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the run logs among the documents."""
    rows = table(spark, d, "documents").where(F.col("text").contains("kept (gbif"))
    return rows.select(F.col("doc_id").alias("log_id"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
