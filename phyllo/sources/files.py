"""File sources: manifests, catalogues, splits, lists, logs, images. All lazily, all with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phyllo.functions.names import canonical_name, epithet_of, genus_of, internal_id
from phyllo.sources.schemas import PLANT, RECORD, RECORD_TEXTS, SPLIT

IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "webp")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines: unknown keys are dropped, missing ones get their default, an absent file is an empty table.

    Blank lines are skipped; a broken line fails the read. ``seq`` is the order of the lines within files.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("seq", T.LongType()), *RECORD]))
    rows = spark.read.schema(RECORD).option("mode", "FAILFAST").json(path)
    defaults = [F.coalesce(c, F.lit("kept" if c == "status" else "")).alias(c) for c in RECORD_TEXTS]
    sizes = [F.coalesce(c, F.lit(0)).alias(c) for c in ("width", "height")]
    extra = F.coalesce("extra", F.create_map().cast("map<string,string>")).alias("extra")
    return rows.select(F.monotonically_increasing_id().alias("seq"), *defaults, *sizes, extra)


def read_plants(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue: names are brought to canonical form, rows without one are dropped, lists and maps are unpacked."""
    raw = spark.read.schema(PLANT).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    name = canonical_name("scientific_name")
    text = lambda c: F.when(F.trim(c) != "", F.trim(c))
    common = F.map_filter(F.create_map(*[x for lang in ("fr", "en", "de", "it") for x in (F.lit(lang), F.coalesce(f"common_{lang}", F.lit("")))]), lambda k, v: v != "")
    rows = raw.withColumn("name", name).where("name <> ''")
    return rows.select(
        F.coalesce(text("internal_id"), internal_id("name")).alias("internal_id"), F.col("name").alias("scientific_name"), genus_of("name").alias("genus"), epithet_of("name").alias("epithet"),
        F.coalesce("family", F.lit("")).alias("family"), common.alias("common_names"),
        F.filter(F.transform(F.split(F.coalesce("synonyms", F.lit("")), r"\|"), lambda s: F.trim(s)), lambda s: s != "").alias("synonyms"),
        text("gbif_key").try_cast("long").alias("gbif_key"), text("wikidata_id").alias("wikidata_id"), text("plantnet_id").alias("plantnet_id"), text("image").alias("image"),
    )


def read_splits(spark: SparkSession, path: str, split: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """The splits with captive as boolean; only one split and only rows whose file (path) exists, where asked."""
    rows = spark.read.schema(SPLIT).option("header", True).csv(path).withColumn("captive", F.coalesce(F.col("captive") == "1", F.lit(False)))
    rows = rows.where(F.col("split") == split) if split else rows
    return rows.join(files.select("path").distinct(), "path", "left_semi") if files is not None else rows


def read_lines(spark: SparkSession, path: str, words: bool = False) -> DataFrame:
    """(seq, value): the lines of a list, trimmed, blank ones dropped; or its words, wherever they stand."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), "value")
    if not words:
        return rows.select(F.col("line").alias("seq"), F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("value")).where("value <> ''")
    return rows.select("line", F.posexplode(F.split("value", r"(?U)\s+")).alias("at", "value")).where("value <> ''").select((F.col("line") * 4096 + F.col("at")).alias("seq"), "value")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(class_idx, class_id): the number of a label is its place in the list, which is one small file."""
    from pyspark.sql import Window

    rows = read_lines(spark, path, words=True)
    return rows.select((F.row_number().over(Window.orderBy("seq")) - 1).alias("class_idx"), F.col("value").alias("class_id"))


def read_logs(spark: SparkSession, *paths: str) -> DataFrame:
    """(log_id, pos, line) of collection logs; a log is a file."""
    rows = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("log_id"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    return rows


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(truth, prediction) as an earlier run has written them."""
    return spark.read.schema("truth string, prediction string").option("header", True).csv(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(species, n): -1 stays the mark of an unresolved species."""
    return spark.read.schema("species string, n long").option("header", True).csv(path)


def list_images(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, folder) of the image files below a folder, content unread."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("size"))
    parts = F.split("path", "/")
    suffix = F.lower(F.element_at(F.split("path", r"\."), -1))
    return rows.where(suffix.isin(*IMAGE_SUFFIXES)).withColumn("folder", F.element_at(parts, -2))


def read_images(spark: SparkSession, root: str, most_bytes: int = 25 * 1024 * 1024) -> DataFrame:
    """(path, checksum, content) of images no larger than the cap."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).where(F.col("length") <= most_bytes)
    return rows.select("path", F.sha2("content", 256).alias("checksum"), "content")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, species_id, license, organ) of a file that is one object of objects."""
    kind = "map<string,struct<species_id:string,license:string,organ:string>>"
    rows = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", kind)).alias("image_id", "m"))
    return rows.select("image_id", "m.species_id", "m.license", "m.organ")
