"""Vectors by label: prototypes, separability, leave-one-out, permutation control, column cuts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phyllo.operators.splits import hash_range
from phyllo.session import ship


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column | str) -> Column:
    """v as doubles over its length, which counts as 1e-12 at least."""
    v = F.transform(F.col(v) if isinstance(v, str) else v, lambda x: x.cast("double"))
    return F.transform(F.array(v), lambda a: F.transform(a, lambda x: x / F.greatest(F.sqrt(dot(a, a)), F.lit(1e-12))))[0]


def units(df: DataFrame, v: str = "embedding", id_: str = "vec_id", label: str = "label") -> DataFrame:
    return df.select(F.col(id_).alias("id"), F.col(label).alias("label"), normalised(v).alias("v"))


def sums(rows: DataFrame) -> DataFrame:
    """(label, n, s): the sum of the unit vectors of each label, added up map-side by dimension."""
    long = rows.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    return long.groupBy("label").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("s"))


def prototypes(rows: DataFrame) -> DataFrame:
    """(label, n, v): the mean direction of each label."""
    return sums(rows).select("label", "n", normalised("s").alias("v"))


def separability(rows: DataFrame) -> DataFrame:
    """One row: mean cosine of pairs within and across labels, exact and without pairs.

    The sum of all dots of a set is the square of its sum vector, so the sums by label and of all tell both means.
    """
    own = sums(rows)
    per = own.select("n", dot(F.col("s"), F.col("s")).alias("q"), "s")
    squares = rows.agg(F.sum(dot(F.col("v"), F.col("v"))).alias("diag")).scalar()
    long = per.select(F.posexplode("s").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).agg(F.sum(F.col("x") * F.col("x")).alias("all")).scalar()
    one = per.agg(F.sum("q").alias("q"), F.sum(F.col("n") * (F.col("n") - 1)).alias("within"), F.sum("n").alias("n")).withColumns({"diag": squares, "all": long})
    across = F.col("n") * (F.col("n") - 1) - F.col("within")
    return one.select(((F.col("q") - F.col("diag")) / F.col("within")).alias("intra"), ((F.col("all") - F.col("q")) / across).alias("inter"))


def _nearest(ids: np.ndarray, own: np.ndarray, v: np.ndarray, labels: np.ndarray, n: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the best cosine to a label's sum, without the row itself in its own, and that label; equal ones: the smallest.

    Labels ascend; a label whose only row it is counts as minus infinity.
    """
    c = (v @ s.T) / np.maximum(np.sqrt((s * s).sum(1)), 1e-12)
    at = np.searchsorted(labels, own)
    here = np.flatnonzero((at < len(labels)) & (labels[np.minimum(at, len(labels) - 1)] == own))
    rest = s[at[here]] - v[here]
    c[here, at[here]] = np.where(n[at[here]] > 1, (rest * v[here]).sum(1) / np.maximum(np.sqrt((rest * rest).sum(1)), 1e-12), -np.inf)
    best = c.argmax(1)
    return c[np.arange(len(ids)), best], labels[best]


def leave_one_out(rows: DataFrame, most_labels: int = 5_000, piece: int = 20_000) -> DataFrame:
    """(id, label, guess): the nearest prototype, the row itself left out of its own label's.

    Rows whose label has no other row are not classifiable. Up to ``most_labels`` sums are broadcast as a matrix and
    multiplied with each Arrow batch; more labels are cut into blocks, rows into slices of about ``piece``, and each pair of a
    block and a slice is a product of its own, of which the best are merged. Labels are integers.
    """
    own = sums(rows).select(F.col("label").cast("long").alias("label"), "n", "s")
    kind = rows.schema["id"].dataType.simpleString()
    found = sorted(own.limit(most_labels + 1).collect(), key=lambda r: r["label"])
    if len(found) < 2:
        return rows.limit(0).select("id", "label", F.col("label").alias("guess"))
    base = rows.select("id", F.col("label").cast("long").alias("label"), "v").where("label IS NOT NULL")
    ship(rows.sparkSession)
    matrix = lambda column: np.stack([np.asarray(x, float) for x in column])
    if len(found) <= most_labels:
        shared = rows.sparkSession.sparkContext.broadcast((np.array([r["label"] for r in found]), np.array([r["n"] for r in found]), matrix([r["s"] for r in found])))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            label, n, _ = shared.value
            for b in batches:
                b = b[b["label"].isin(label[n > 1])]
                if len(b):
                    _, guess = _nearest(b["id"].to_numpy(), b["label"].to_numpy(), matrix(b["v"]), *shared.value)
                    yield pd.DataFrame({"id": b["id"], "label": b["label"], "guess": guess})

        out = base.select("id", "label", "v").mapInPandas(run, f"id {kind}, label long, guess long")
    else:
        base = base.join(own.where("n > 1").select("label"), "label", "left_semi")
        blocks, slices = -(-own.count() // most_labels), max(1, -(-base.count() // piece))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = base.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")).withColumn("block", every(blocks))
        right = own.withColumn("block", F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int")).withColumn("slice", every(slices))

        def one(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"id": a["id"][:0], "label": a["label"][:0], "c": np.empty(0), "guess": np.empty(0, np.int64)})
            b = b.sort_values("label")
            c, guess = _nearest(a["id"].to_numpy(), a["label"].to_numpy(), matrix(a["v"]), b["label"].to_numpy(), b["n"].to_numpy(), matrix(b["s"]))
            return pd.DataFrame({"id": a["id"], "label": a["label"], "c": c, "guess": guess})

        per = left.groupBy("block", "slice").cogroup(right.groupBy("block", "slice")).applyInPandas(one, f"id {kind}, label long, c double, guess long")
        best = per.groupBy("id", "label").agg(F.max(F.struct("c", (-F.col("guess")).alias("g"))).alias("x"))
        out = best.select("id", "label", (-F.col("x.g")).alias("guess"))
    return out.select("id", *[F.col(c).cast(rows.schema["label"].dataType).alias(c) for c in ("label", "guess")])


def _ranked(rows: DataFrame, key: Column) -> DataFrame:
    """rows (draw, ...) with r, the place by ``key`` (hex digits) within the draw, counted over ranges of the key."""
    own = rows.withColumn("_h", key).withColumn("_part", hash_range(F.col("_h")))
    sizes = own.groupBy("draw", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("draw").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    at = F.row_number().over(Window.partitionBy("draw", "_part").orderBy("_h", "id"))
    return own.withColumn("_at", at).join(sizes.select("draw", "_part", before.alias("_before")), ["draw", "_part"]).withColumn("r", F.col("_at") + F.col("_before")).drop("_h", "_part", "_at", "_before")


def permutation_control(rows: DataFrame, draws: int, salt: str = "draw") -> DataFrame:
    """(draw, intra, inter, gap): mean cosines within and across labels, observed (draw 0) and with labels shuffled.

    Each draw gives the labels in order of one hash to the ids in order of another. Both orders are counted over ranges of
    the hash, and without the vectors, so no draw is one task; the means come from sums, not from pairs. Null gaps: a draw
    of one label, or of one row a label.
    """
    hashed = lambda what: F.md5(F.concat_ws(":", F.lit(salt), F.lit(what), F.col("draw").cast("string"), F.col("id").cast("string")).cast("binary"))
    given = rows.select("id", "label", F.lit(0).alias("draw"))
    if draws:
        spread = rows.select("id", "label", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
        a = _ranked(spread.select("draw", "id"), hashed("id"))
        b = _ranked(spread, hashed("label")).select("draw", "r", "label")
        given = given.unionByName(a.join(b, ["draw", "r"]).select("id", "label", "draw"))
    base = rows.select("id", "v").join(given, "id")
    long = base.select("draw", "label", F.posexplode("v").alias("i", "x")).groupBy("draw", "label", "i").agg(F.sum("x").alias("x"), F.count("*").alias("n"), F.sum(F.col("x") * F.col("x")).alias("xx"))
    per = long.groupBy("draw", "label").agg(F.sum(F.col("x") * F.col("x")).alias("q"), F.sum("xx").alias("diag"), F.max("n").alias("n"))
    whole = long.groupBy("draw", "i").agg(F.sum("x").alias("x")).groupBy("draw").agg(F.sum(F.col("x") * F.col("x")).alias("all"))
    one = per.groupBy("draw").agg(F.sum("q").alias("q"), F.sum("diag").alias("diag"), F.sum(F.col("n") * (F.col("n") - 1)).alias("within"), F.sum("n").alias("n")).join(whole, "draw")
    across = F.nullif(F.col("n") * (F.col("n") - 1) - F.col("within"), F.lit(0))
    means = one.select("draw", ((F.col("q") - F.col("diag")) / F.nullif("within", F.lit(0))).alias("intra"), ((F.col("all") - F.col("q")) / across).alias("inter"))
    return means.withColumn("gap", F.col("intra") - F.col("inter"))


def p_value(control: DataFrame) -> DataFrame:
    """One row: the observed gap, the mean of the draws, and p: the share of draws that do as well, the observed one included."""
    seen = control.agg(F.max(F.when(F.col("draw") == 0, F.col("gap"))).alias("gap"), F.avg(F.when(F.col("draw") > 0, F.col("gap"))).alias("mean_gap"), F.count(F.when(F.col("draw") > 0, F.col("gap"))).alias("draws"), F.collect_list(F.when(F.col("draw") > 0, F.col("gap"))).alias("_all"))
    as_well = F.size(F.filter("_all", lambda x: x >= F.col("gap")))
    return seen.select("gap", "mean_gap", F.when(F.col("gap").isNotNull() & (F.col("draws") > 0), F.round((1 + as_well) / (1 + F.col("draws")), 4)).alias("p"), "draws")


def cut(row: Column | str, kept: list[int]) -> Column:
    """The kept columns of an array row, in that order."""
    row = F.col(row) if isinstance(row, str) else row
    return F.array(*[row[i] for i in kept])
