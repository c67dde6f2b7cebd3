"""Sinks: every whole-file result is written beside its target and moved over it, so a reader never sees half of it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phyllo.operators.ingest import attributions
from phyllo.session import ship
from phyllo.sources.schemas import PLANT_COLUMNS, RECORD_TEXTS


def _swap(spark: SparkSession, made: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{target}.old-{uuid.uuid4().hex}"
    had = fs.exists(path(target))
    if had:
        fs.rename(path(target), path(old))
    if not fs.rename(path(made), path(target)):
        if had:
            fs.rename(path(old), path(target))
        raise OSError(f"{target} could not be written")
    if had:
        fs.delete(path(old), True)


def replace(df: DataFrame, target: str, form: str, **options) -> None:
    """Write df as a folder of files and put it in the place of ``target``, which df may have been read from."""
    made = f"{target}.new-{uuid.uuid4().hex}"
    df.write.format(form).options(**options).save(made)
    _swap(df.sparkSession, made, target)


def manifest_lines(records: DataFrame) -> DataFrame:
    """(value): records as JSON objects of sorted keys."""
    names = sorted([*RECORD_TEXTS, "width", "height", "extra"])
    return records.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value"))


def append_manifest(records: DataFrame, target: str) -> None:
    manifest_lines(records).write.mode("append").text(target)


def rewrite_manifest(records: DataFrame, target: str) -> None:
    replace(manifest_lines(records), target, "text")


def write_splits(splits: DataFrame, target: str) -> None:
    """Ordered by species and path, ranges of the order in files of that order."""
    rows = splits.select("path", "species", "internal_plant_id", "split", F.col("group_id").alias("group"), "captive").orderBy("species", "path")
    replace(rows, target, "csv", header=True)


def write_attributions(records: DataFrame, target: str) -> None:
    replace(attributions(records), target, "csv", header=True)


def attributions_text(records: DataFrame, none: str = "author not stated") -> DataFrame:
    """(species, value): the credit lines of each species under its heading."""
    rows = attributions(records).select("species", F.struct("author", "source_id", F.concat(F.lit("- "), F.when(F.trim("author") != "", F.col("author")).otherwise(none), F.lit(", "), "license", F.lit(", "), "original_url").alias("line")).alias("x"))
    lines = F.transform(F.array_sort(F.collect_list("x")), lambda x: x["line"])
    return rows.groupBy("species").agg(F.concat(F.lit("## "), F.first("species"), F.lit("\n\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("value")).orderBy("species")


def pack_plants(plants: DataFrame) -> DataFrame:
    """The inverse of read_plants: maps and lists as plain columns, nulls as empty texts."""
    own = plants.withColumns({f"common_{lang}": F.try_element_at("common_names", F.lit(lang)) for lang in ("fr", "en", "de", "it")}).withColumn("synonyms", F.array_join("synonyms", "|"))
    return own.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in PLANT_COLUMNS])


def write_plants(plants: DataFrame, target: str) -> None:
    replace(pack_plants(plants), target, "csv", header=True, emptyValue="", escape='"')


def write_retry_lists(failures: DataFrame, target: str) -> None:
    """One folder a log with the names to try again."""
    failures.select("log_id", "name").write.mode("overwrite").partitionBy("log_id").text(target)


def write_counts(counts: DataFrame, target: str, name: str, n: str = "n") -> None:
    """From the most to the fewest, equal ones by name; lists of a name's members are joined by |."""
    lists = [f.name for f in counts.schema if f.dataType.typeName() == "array"]
    replace(counts.withColumns({c: F.array_join(c, "|") for c in lists}).orderBy(F.desc(n), name), target, "csv", header=True)


def write_contents(rows: DataFrame, target: str) -> int:
    """Write each row (name, content) as a file of that name under ``target``, a URI; how many there are.

    A task that runs again writes the same files, so what a lost executor has left does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(target)
        n = 0
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                path = f"{root}/{name}"
                system.create_dir(path.rpartition("/")[0], recursive=True)
                with system.open_output_stream(path) as out:
                    out.write(content)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    ship(rows.sparkSession)
    return rows.select("name", "content").where("name IS NOT NULL AND content IS NOT NULL").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_stats(stats: DataFrame, target: str) -> None:
    replace(stats, target, "json")


def sample_records(sample: DataFrame, records: DataFrame) -> DataFrame:
    """(internal_plant_id, species) of a sample, the last name of an id winning."""
    rows = sample.select("path").join(records.select("path", "seq", "species", "internal_plant_id"), "path")
    return rows.groupBy("internal_plant_id").agg(F.max_by("species", "seq").alias("species")).orderBy("internal_plant_id")


def with_headings(rows: DataFrame) -> DataFrame:
    """rows with ``heading`` at the first of each species in the order of the credit list; species are independent."""
    n = F.row_number().over(Window.partitionBy("species").orderBy("author", "source_id", *(["seq"] if "seq" in rows.columns else [])))
    return rows.withColumn("heading", n == 1)


def release_checks(files: DataFrame, labels: DataFrame, card: DataFrame) -> DataFrame:
    """(check, ok) before publishing: sha-256, size and label count must be those the card states.

    files (name, content); labels (class_id); card (name, sha256, size, classes), one row.
    """
    n = labels.agg(F.count("*").alias("n")).scalar()
    met = card.join(files.select("name", F.sha2("content", 256).alias("_sha"), F.length("content").alias("_size")), "name", "left")
    checks = F.array(
        F.struct(F.lit("sha256").alias("check"), F.coalesce(F.col("_sha") == F.col("sha256"), F.lit(False)).alias("ok")),
        F.struct(F.lit("size").alias("check"), F.coalesce(F.col("_size") == F.col("size"), F.lit(False)).alias("ok")),
        F.struct(F.lit("classes").alias("check"), F.coalesce(n == F.col("classes"), F.lit(False)).alias("ok")),
    )
    return met.select(F.inline(checks))
