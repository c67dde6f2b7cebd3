"""Queries that write a table by a sink and read it back by a source, through the shared folder.

What is written is deleted when the driver ends.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phyllo.functions import scalars
from phyllo.operators import evaluate as ev
from phyllo.operators import features, ingest, logs
from phyllo.operators import vectors as vec
from phyllo.operators.hamming import hash_bits
from phyllo.plans import curation
from phyllo.plans.evaluation import _P, _read, probs
from phyllo.session import keep_until_exit, shared_dir, table
from phyllo.sources import commons, files, paged, sinks
from phyllo.sources.schemas import RECORD_TEXTS
from phyllo.streaming import streams

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _place(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/phyllo/{what}-{uuid.uuid4().hex}"
    keep_until_exit(spark, path)
    return path


_TEXTS = ", ".join(f"coalesce({c}, '{'kept' if c == 'status' else ''}') AS {c}" for c in RECORD_TEXTS)
_MANIFEST = f"SELECT {_TEXTS}, coalesce(width, 0) AS width, coalesce(height, 0) AS height, coalesce(cardinality(extra), 0) AS extras FROM records"


def _manifest(m: DataFrame) -> DataFrame:
    return m.select(*RECORD_TEXTS, "width", "height", F.greatest(F.size("extra"), F.lit(0)).cast("long").alias("extras"))


@query(_MANIFEST)
def snk01_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest as appended JSON lines, in two goes, read back with its defaults."""
    path, r = _place(spark, "manifest"), table(spark, d, "records")
    for half in (0, 1):
        sinks.append_manifest(r.where(f"seq % 2 = {half}"), path)
    return _manifest(files.read_manifest(spark, path))


@query(_MANIFEST.replace("coalesce(status, 'kept') AS status", "CASE WHEN source = 'gbif' THEN 'review' ELSE coalesce(status, 'kept') END AS status"))
def snk02_rewritten_manifest(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "rewritten")
    sinks.append_manifest(table(spark, d, "records"), path)
    own = files.read_manifest(spark, path)
    sinks.rewrite_manifest(own.withColumn("status", F.when(F.col("source") == "gbif", "review").otherwise(F.col("status"))), path)
    return _manifest(files.read_manifest(spark, path))


@query("SELECT internal_id, scientific_name, coalesce(family, '') AS family, gbif_key, nullif(trim(wikidata_id), '') AS wikidata_id, nullif(trim(image), '') AS image, coalesce(common_en, '') AS en, len(list_filter(string_split(coalesce(synonyms, ''), '|'), lambda s: trim(s) <> '')) AS n_synonyms FROM plants")
def snk06_plants(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue written, read, written again from what was read, and read."""
    path, again = _place(spark, "plants"), _place(spark, "plants")
    raw = table(spark, d, "plants")
    sinks.replace(raw.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in raw.columns]), path, "csv", header=True, emptyValue="", escape='"')
    sinks.write_plants(files.read_plants(spark, path), again)
    p = files.read_plants(spark, again)
    return p.select("internal_id", "scientific_name", "family", "gbif_key", "wikidata_id", "image", F.coalesce(F.try_element_at("common_names", F.lit("en")), F.lit("")).alias("en"), F.size("synonyms").cast("long").alias("n_synonyms"))


@query("SELECT path, species, nullif(internal_plant_id, '') AS internal_plant_id, group_id, coalesce(captive = '1', false) AS captive FROM splits WHERE split = 'test' AND path IN (SELECT path FROM records)")
def snk04_test_rows(spark: SparkSession, d: str) -> DataFrame:
    """The splits written in their order; of them the test rows whose file exists are read."""
    path = _place(spark, "splits")
    sinks.write_splits(table(spark, d, "splits"), path)
    rows = files.read_splits(spark, path, "test", table(spark, d, "records"))
    return rows.select("path", "species", "internal_plant_id", F.col("group").alias("group_id"), "captive")


@query("SELECT DISTINCT trim(matched_as) AS value FROM name_answers WHERE trim(matched_as, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) <> ''")
def src09_lines(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "lines")
    table(spark, d, "name_answers").select(F.concat(F.lit("  "), F.coalesce("matched_as", F.lit("")), F.lit("  ")).alias("value")).write.text(path)
    return files.read_lines(spark, path).select("value").distinct()


@query("SELECT internal_id AS class_id, CAST(row_number() OVER (ORDER BY internal_id) - 1 AS INTEGER) AS class_idx FROM plants")
def src23_labels(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "labels")
    table(spark, d, "plants").select("internal_id").orderBy("internal_id").coalesce(1).write.text(path)
    return files.read_labels(spark, path)


@query(f"WITH {_P}, {_read()} SELECT 'c' || truth AS truth, 'c' || guess AS prediction, count(*) AS n FROM rd GROUP BY ALL")
def src22_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Truths and predictions as an earlier run has left them."""
    path, name = _place(spark, "pairs"), lambda c: F.concat(F.lit("c"), F.col(c).cast("string"))
    sinks.replace(ev.read(probs(spark, d)).select(name("truth").alias("truth"), name("guess").alias("prediction")), path, "csv", header=True)
    return files.read_pairs(spark, path).groupBy("truth", "prediction").agg(F.count("*").alias("n"))


@query("SELECT species, count(*) AS n FROM records WHERE source = 'gbif' AND species IS NOT NULL GROUP BY species")
def snk08_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by species, written from the most to the fewest."""
    path = _place(spark, "counts")
    counts = table(spark, d, "records").where("source = 'gbif' AND species IS NOT NULL").groupBy("species").agg(F.count("*").alias("n"))
    sinks.write_counts(counts, path, "species")
    return files.read_counts(spark, path)


@query(rf"""SELECT doc_id, name FROM (SELECT DISTINCT doc_id, regexp_extract(line, '{scalars.LOG_FAILED}', 1) AS name FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text LIKE '%kept (gbif%') WHERE regexp_matches(line, '{scalars.LOG_FAILED}'))""")
def snk09_retry_lists(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "retry")
    sinks.write_retry_lists(logs.failures(curation._lines(spark, d)), path)
    return spark.read.schema("value string, log_id long").text(path).select(F.col("log_id").alias("doc_id"), F.col("value").alias("name"))


@query("SELECT internal_plant_id, arg_max(species, seq) AS species FROM (SELECT DISTINCT path FROM splits WHERE split = 'val') JOIN records USING (path) GROUP BY internal_plant_id")
def snk13_sample_manifest(spark: SparkSession, d: str) -> DataFrame:
    return sinks.sample_records(table(spark, d, "splits").where("split = 'val'").select("path").distinct(), table(spark, d, "records"))


@query("SELECT seq, row_number() OVER (PARTITION BY species ORDER BY author NULLS FIRST, source_id NULLS FIRST, seq) = 1 AS heading FROM records WHERE status = 'kept'")
def win10_headings(spark: SparkSession, d: str) -> DataFrame:
    return sinks.with_headings(table(spark, d, "records").where("status = 'kept'")).select("seq", "heading")


@query("SELECT seq, trim(regexp_replace(replace(species, '×', 'x'), '[^A-Za-z0-9]+', '_', 'g'), '_') || '/' || substr(checksum, 1, 16) || '.jpg' AS path FROM records WHERE species IS NOT NULL AND checksum IS NOT NULL")
def snk12_content_paths(spark: SparkSession, d: str) -> DataFrame:
    from phyllo.functions import names

    return table(spark, d, "records").where("species IS NOT NULL AND checksum IS NOT NULL").select("seq", scalars.content_path(names.slug("species"), "checksum").alias("path"))


@query("SELECT vec_id AS id, CAST(label AS INTEGER) AS label FROM embeddings")
def fea01_encoded_cache(spark: SparkSession, d: str) -> DataFrame:
    """Features kept part by part: the second call reads what the first has made, and encodes nothing."""
    path, rows = _place(spark, "features"), table(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), "label")
    made = features.encoded(rows, lambda part: part, "v1", path, parts=4)
    again = features.encoded(rows.limit(0), lambda part: part, "v1", path, parts=4)
    return made.join(again.select("image_id"), "image_id", "left_semi").select(F.col("image_id").alias("id"), "label")


@query(f"WITH {_P}, {_read()} SELECT key AS image_id, CAST(guess AS INTEGER) AS guess, round(best, 6) AS best FROM rd")
def evl01_predicted(spark: SparkSession, d: str) -> DataFrame:
    """A model as Python code over Arrow batches, made once a task."""

    def make():
        import numpy as np

        def model(batch):
            x = np.exp(np.stack([np.asarray(v[:10], float) for v in batch["embedding"]]))
            return x / x.sum(1, keepdims=True)

        return model

    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("image_id"), F.col("label").alias("truth"), F.lit(False).alias("captive"), "embedding")
    r = ev.read(features.predict(e, make, ["image_id", "truth", "captive"]), keep=("image_id",))
    return r.select("image_id", F.col("guess").cast("int").alias("guess"), F.round("best", 6).alias("best"))


@query("SELECT px AS pixels, CAST(round_even(px * 256 / 224.0, 0) AS INTEGER) AS load FROM (SELECT CAST(unnest(range(32, 393)) AS INTEGER) AS px)")
def scl25_input_sizes(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([features.input_sizes(px) for px in range(32, 393)], "pixels int, load int")


@query("SELECT seq AS id, 'commons:' || seq AS source_id, coalesce(nullif(trim(license_url), ''), license) AS license FROM records WHERE source = 'wikimedia' AND image_url LIKE 'http%' AND seq % 3 <> 0 AND coalesce(nullif(trim(license_url), ''), license) IS NOT NULL")
def prd06_commons_files(spark: SparkSession, d: str) -> DataFrame:
    """The records of the file repository as its pages would hold them, every third one no photograph by type or title."""
    value = lambda c: F.struct(F.col(c).alias("value"))
    r = table(spark, d, "records").where("source = 'wikimedia'").withColumns({"u": F.when(F.trim("license_url") != "", F.trim("license_url")), "s": F.col("license")})
    r = r.where("coalesce(u, s) IS NOT NULL")
    info = F.struct(
        F.when(F.col("seq") % 6 == 3, "image/svg+xml").otherwise("image/jpeg").alias("mime"), F.col("image_url").alias("url"), F.lit("").alias("thumburl"), F.col("original_url").alias("descriptionurl"),
        F.map_filter(F.create_map(F.lit("LicenseUrl"), value("u"), F.lit("LicenseShortName"), value("s")), lambda k, v: v["value"].isNotNull()).alias("extmetadata"),
    )
    title = F.concat(F.when(F.col("seq") % 6 == 0, "File:Botanical plate ").otherwise("File:Leaf "), F.col("seq").cast("string"))
    page = F.struct(F.col("seq").alias("pageid"), title.alias("title"), F.array(info).alias("imageinfo"))
    bodies = r.select(F.to_json(F.struct(F.struct(F.array(page).alias("pages")).alias("query"))).alias("body"))
    return commons.files(bodies).select(F.expr("cast(substring(source_id, 9) AS bigint)").alias("id"), "source_id", "license")


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IS NOT NULL")
def str01_appended_batches(spark: SparkSession, d: str) -> DataFrame:
    """A stream appended batch by batch, each in a folder of its own; run again, it adds nothing."""
    base, e = _place(spark, "appended"), table(spark, d, "events").select("event_id", "user_id", "event_type")
    e.repartition(3).write.parquet(f"{base}/in")
    for _ in range(2):
        streams.append_batches(streams.read_parquet(spark, f"{base}/in", e.schema).where("event_type IS NOT NULL"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema("event_id long, user_id long, event_type string").json(f"{base}/out").select("event_id", "user_id", "event_type")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def str05_windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts as a stream that keeps late rows of ten years, resumed half way."""
    base, e = _place(spark, "windows"), table(spark, d, "events").where("ts IS NOT NULL").select("ts", "event_type")
    for half in (0, 1):
        e.where(F.pmod(F.xxhash64("ts", "event_type"), F.lit(2)) == half).write.mode("append").parquet(f"{base}/in")
        made = streams.counts(streams.read_parquet(spark, f"{base}/in", e.schema), "ts", "1 hour", "3650 days", "event_type")
        latest = made.writeStream.foreachBatch(lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{base}/out"))
        latest.option("checkpointLocation", f"{base}/checkpoint").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    last = out.groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))
    return last.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT internal_id AS image_id, CAST(gbif_key AS VARCHAR) AS species_id, family AS license, genus AS organ FROM plants")
def src19_metadata(spark: SparkSession, d: str) -> DataFrame:
    """A description of images as one object of objects, here of the catalogue, which is fixed."""
    path, p = _place(spark, "metadata"), table(spark, d, "plants")
    item = F.struct(F.col("gbif_key").cast("string").alias("species_id"), F.col("family").alias("license"), F.col("genus").alias("organ"))
    whole = p.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.col("internal_id"), item))).alias("m"))
    whole.select(F.to_json("m").alias("value")).write.text(path)
    return files.read_metadata(spark, path)


@query("""WITH g AS (SELECT vec_id AS id, i // 32 AS y, i % 32 AS x, CAST(embedding[(i * 7 + i // 32) % 64 + 1] AS DOUBLE) * (1 + i % 5) AS v FROM embeddings, (SELECT unnest(range(1024)) AS i)),
  h AS (SELECT id, y, u, sum(v * cos(pi() * (2 * x + 1) * u / 64)) AS v FROM g, (SELECT unnest(range(8)) AS u) GROUP BY ALL),
  f AS (SELECT id, w, u, sum(v * cos(pi() * (2 * y + 1) * w / 64)) AS v FROM h, (SELECT unnest(range(8)) AS w) GROUP BY ALL),
  m AS (SELECT id, quantile_disc(v, 0.5) AS m FROM f WHERE w > 0 OR u > 0 GROUP BY id)
  SELECT id, CAST(sum(CASE WHEN v > m THEN 1 ELSE 0 END) AS BIGINT) AS ones, string_agg(CASE WHEN v > m THEN '1' ELSE '0' END, '' ORDER BY w, u) AS bits FROM f JOIN m USING (id) GROUP BY id""")
def scl17_picture_hash(spark: SparkSession, d: str) -> DataFrame:
    """Perceptual hashes of 32 x 32 grey pictures that are made from the embeddings."""
    grey = F.transform(F.sequence(F.lit(0), F.lit(1023)), lambda i: F.element_at("embedding", (i * 7 + F.floor(i / 32).cast("int")) % 64 + 1).cast("double") * (1 + i % 5))
    h = hash_bits(features.picture_hash(grey))
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), h.alias("h"))
    return rows.select("id", F.bit_count("h").cast("long").alias("ones"), F.lpad(F.bin("h"), 64, "0").alias("bits"))


def _pictures(spark: SparkSession, d: str) -> str:
    """A folder of one small file a plant of the catalogue, by family, every fourth of them no picture by its name."""
    path, at = _place(spark, "pictures"), F.pmod(F.length("internal_id"), F.lit(4))
    suffix = F.when(at == 0, ".txt").when(at == 1, ".JPG").when(at == 2, ".webp").otherwise(".png")
    own = table(spark, d, "plants").select(F.concat("family", F.lit("/"), "internal_id", suffix).alias("name"), F.encode("scientific_name", "utf-8").alias("content"))
    sinks.write_contents(own, path)
    return path


@query("SELECT internal_id, family AS folder, CAST(octet_length(encode(scientific_name)) AS BIGINT) AS size FROM plants WHERE length(internal_id) % 4 <> 0")
def src21_listed_pictures(spark: SparkSession, d: str) -> DataFrame:
    rows = files.list_images(spark, _pictures(spark, d))
    return rows.select(F.regexp_extract("path", r"([^/]+)\.\w+$", 1).alias("internal_id"), "folder", "size")


@query("SELECT internal_id, sha256(scientific_name) AS checksum FROM plants WHERE octet_length(encode(scientific_name)) <= 24")
def src20_read_pictures(spark: SparkSession, d: str) -> DataFrame:
    """Contents and checksums of the files that are no larger than a cap of 24 bytes."""
    rows = files.read_images(spark, _pictures(spark, d), 24)
    return rows.select(F.regexp_extract("path", r"([^/]+)\.\w+$", 1).alias("internal_id"), "checksum")


def recorded(asked: str, page: int) -> tuple[int, str | None, bool]:
    """A service as a test sees it: three pages a name, but one that is busy at first, one that stays so, one that is unknown."""
    if asked == "busy":
        return 429, None, False
    if asked == "unknown":
        return 404, "no such name", True
    if asked == "slow" and page not in _seen:
        _seen.add(page)
        return 503, None, False
    return 200, f"{asked} {page}", page == 2


_seen: set[int] = set()


@query("""SELECT q AS query, CAST(p AS INTEGER) AS page, 200 AS http_status, q || ' ' || p AS body FROM (VALUES ('ficus'), ('slow')) t(q), (VALUES (0), (1), (2)) u(p)
  UNION ALL SELECT 'busy', 0, 429, NULL UNION ALL SELECT 'unknown', 0, 404, NULL""")
def str06_paged_service(spark: SparkSession, d: str) -> DataFrame:
    """Pages of a service read in parallel, a name a partition: busy ones are asked again, and fail no other."""
    paged.register(spark)
    asked = json.dumps(["ficus", "busy", "slow", "unknown"])
    return spark.read.format("paged").option("queries", asked).option("fetcher", f"{__name__}:recorded").option("attempts", "3").option("wait", "0").load()


@query("""SELECT 'sha256' AS check, (SELECT sha256(text) = (SELECT max(sha256(text)) FROM documents WHERE doc_id = 5) FROM documents WHERE doc_id = 5 LIMIT 1) AS ok UNION ALL SELECT 'size', false UNION ALL SELECT 'classes', count(*) = 1200 FROM plants""")
def snk14_release_checks(spark: SparkSession, d: str) -> DataFrame:
    """A file, here a document's text, against a card that states its hash rightly and its size wrongly."""
    own = table(spark, d, "documents").where("doc_id = 5 AND text IS NOT NULL").limit(1).select(F.lit("m").alias("name"), F.encode("text", "utf-8").alias("content"))
    card = own.select("name", F.sha2("content", 256).alias("sha256"), (F.length("content") + 1).alias("size"), F.lit(1200).cast("long").alias("classes"))
    return sinks.release_checks(own, table(spark, d, "plants").select(F.col("internal_id").alias("class_id")), card)


@query("SELECT species, count(*) AS n FROM records WHERE status = 'kept' GROUP BY species")
def snk05_stats(spark: SparkSession, d: str) -> DataFrame:
    path = _place(spark, "stats")
    sinks.write_stats(ingest.manifest_stats(table(spark, d, "records")), path)
    s = spark.read.schema("species string, status string, license string, source string, n long").json(path)
    return s.where("status = 'kept'").groupBy("species").agg(F.sum("n").alias("n"))


@query("SELECT vec_id AS id, label, round(CAST(embedding[64] AS DOUBLE), 6) AS last FROM embeddings WHERE label IN (1, 3, 5)")
def scl29_masked_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the classes that a mask file names."""
    path = _place(spark, "mask")
    spark.createDataFrame([("1",), ("3",), ("5",)], "value string").coalesce(1).write.text(path)
    named = features.parse_masks([f"odd={path}"])
    kept = files.read_lines(spark, named["odd"]).select(F.col("value").cast("int").alias("label"))
    e = table(spark, d, "embeddings").join(kept, "label", "left_semi")
    return e.select(F.col("vec_id").alias("id"), "label", F.round(F.element_at(vec.cut("embedding", [63]), 1).cast("double"), 6).alias("last"))


