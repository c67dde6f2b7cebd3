"""Collection logs (log_id, pos, line): what failed first and why, and what was never reached."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phyllo.functions.scalars import failed_name, failure, seen_name


def failures(lines: DataFrame) -> DataFrame:
    """(log_id, name, reason) of every name that failed in a log, with its first reason."""
    rows = lines.select("log_id", "pos", failed_name("line").alias("name"), failure("line").alias("reason")).where("name IS NOT NULL")
    return rows.groupBy("log_id", "name").agg(F.min_by("reason", "pos").alias("reason"))


def reasons(lines: DataFrame) -> DataFrame:
    return failures(lines).groupBy("reason").agg(F.count("*").alias("n"))


def never_reached(lines: DataFrame, expected: DataFrame) -> DataFrame:
    """The expected rows (name, ...) that no line names."""
    seen = lines.select(seen_name("line").alias("name")).where("name IS NOT NULL").distinct()
    return expected.join(seen, "name", "left_anti")
