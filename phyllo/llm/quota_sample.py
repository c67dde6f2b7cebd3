"""A sample that matches target category shares: mergeable reservoirs in one pass, trimmed to feasible quotas.

A target asks for ``need = max(min_rows, ceil(share_permille * sample_rows / 1000))`` records of one category (species,
source, captive). Every kept record has a priority, the hash of its identity; the sample of a category are its records
of lowest priority, which is a uniform draw, the same on every run and layout.

1. Deliveries of one record are merged (map-side first), which also spreads a category that a third of all records share
   evenly over the tasks. 2. Each task keeps of every target one reservoir: the ``need`` members of lowest priority, and
   the count of all it saw. A reservoir never holds more, and only reservoirs are shuffled. 3. Reservoirs of one target
   and one of ``SLICES`` ranges of the priority merge by taking their rows together; their counts add up. 4. After the
   final counts every draw gets feasible quotas (``quotas``), and the merged reservoirs are trimmed to them.

Quotas: the rows of a draw never exceed its ``sample_rows`` unless its minimums alone do. Each target gets its minimum or
its share of a common size, whichever is more, and that size is as large as the draw allows (all of ``sample_rows`` if no
minimum exceeds its share). What an exhausted category can't give is not made up by others, which would spoil their
shares; it is reported.

The list of targets is broadcast only up to ``MAX_BROADCAST`` rows, else joined by shuffle. Defined results: a record
(source, source_id) counts once a category however often it was delivered; null source_id makes the row's ``seq`` its
identity; captive is 1 only if extra.captive says so (true, yes, y, t, 1, on; any case), and null or anything else is 0;
null species or sources match no target; a target with no records is exhausted with 0 available; null numbers in a target
are 0; an empty table of records leaves every target that needs rows short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phyllo.session import ship

SLICES = 64
MAX_BROADCAST = 20_000
#: Spellings of true. Fixed values.
TRUE = ["true", "yes", "y", "t", "1", "1.0", "on", "oui", "ja", "si", "vrai", "wahr", "vero"]


def captive_flag(extra: Column | str = "extra") -> Column:
    extra = F.col(extra) if isinstance(extra, str) else extra
    return F.coalesce(F.lower(F.trim(F.try_element_at(extra, F.lit("captive")))).isin(TRUE), F.lit(False)).cast("int")


def _number(c: str) -> Column:
    return F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))


def needs(targets: DataFrame) -> DataFrame:
    share = F.expr("(coalesce(cast(share_permille AS BIGINT), 0) * coalesce(sample_rows, 0) + 999) div 1000")
    return targets.select("target_id", "draw_id", "species", "source", F.col("captive").cast("int").alias("captive"), F.greatest(_number("min_rows"), share).alias("need"))


def quotas(shares: list[int], least: list[int], size: int) -> list[int]:
    """Rows of each target of a draw of ``size`` rows: shares in permille, least the minimums; see the module.

    Whole numbers only; what rounding down leaves goes to the largest remainders, then to the first.
    """
    shares, least = [max(0, s) for s in shares], [max(0, m) for m in least]
    if sum(least) >= size:
        return least
    # targets leave the common scale, rows to parts, for their minimum from the highest ratio of minimum to share down
    order = sorted(range(len(shares)), key=lambda i: (-(least[i] / shares[i] if shares[i] else math.inf), i))
    rows, parts, free = size, sum(shares), []
    for n, i in enumerate(order):
        whole = (size, 1000) if rows * 1000 > parts * size else (rows, parts)  # shares of under 1000 leave rows undrawn
        if shares[i] and whole[0] * shares[i] >= least[i] * whole[1]:
            free = order[n:]
            break
        rows, parts = rows - least[i], parts - shares[i]
    if not free:
        return least
    out = list(least)
    for i in free:
        out[i] = whole[0] * shares[i] // whole[1]
    spare = whole[0] * parts // whole[1] - sum(out[i] for i in free)
    for i in sorted(free, key=lambda i: (-(whole[0] * shares[i] % whole[1]), i))[:spare]:
        out[i] += 1
    return out


def with_quotas(targets: DataFrame) -> DataFrame:
    """needs(targets) with the feasible quota of each target; a draw's targets, a list by hand, are taken together."""
    plain = targets.select("target_id", "draw_id", _number("share_permille").alias("share"), _number("min_rows").alias("least"), _number("sample_rows").alias("size"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("target_id")
        pdf["quota"] = quotas(pdf["share"].tolist(), pdf["least"].tolist(), int(pdf["size"].max()))
        return pdf[["target_id", "quota"]]

    ship(targets.sparkSession)
    return needs(targets).join(plain.groupBy("draw_id").applyInPandas(one, "target_id long, quota long"), "target_id")


def _members(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, need, seq, priority), once a target and identity, of every kept record of a category."""
    wanted = needs(targets)
    small = targets.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    identity = F.concat_ws("\x01", "source", F.coalesce("source_id", F.concat(F.lit("\x02"), F.col("seq").cast("string"))))
    kept = records.where(F.lower(F.trim("status")) == "kept").select("species", "source", captive_flag().alias("captive"), identity.alias("identity"), "seq")
    key = ["species", "source", "captive"]
    rows = kept.join(F.broadcast(wanted) if small else wanted, key).groupBy("target_id", "need", "identity").agg(F.min("seq").alias("seq"))
    return rows.select("target_id", "need", "seq", F.xxhash64(F.lit("phyllo-draw"), "target_id", "identity").alias("priority"))


def reservoirs(members: DataFrame) -> DataFrame:
    """(target_id, seen, seq, priority) of each task's reservoirs: at most ``need`` rows a target, the count on the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # target -> [need, seen, priorities, seqs, rows not yet trimmed]

        def trim(r: list) -> None:
            p, s = np.concatenate(r[2]), np.concatenate(r[3])
            if len(p) > r[0]:
                keep = np.lexsort((s, p))[: r[0]]
                p, s = p[keep], s[keep]
            r[2:] = [p], [s], 0

        for batch in batches:
            t, need, seq, priority = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("target_id", "need", "seq", "priority"))
            order = np.argsort(t, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(t[order])) + 1):
                if not len(part):
                    continue
                r = held.setdefault(int(t[part[0]]), [int(need[part[0]]), 0, [], [], 0])
                r[1] += len(part)
                r[2].append(priority[part])
                r[3].append(seq[part])
                r[4] += len(part)
                if r[4] > max(r[0], 4096):
                    trim(r)
        for target, r in held.items():
            trim(r)
            # a target that needs nothing still tells its count, on a row of its own
            p, s = (r[2][0], r[3][0]) if r[0] else (np.zeros(1, np.int64), np.zeros(1, np.int64))
            seen, real = np.zeros(len(p), np.int64), np.full(len(p), r[0] > 0)
            seen[0] = r[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), target)), pa.array(seen), pa.array(s, mask=~real), pa.array(p, mask=~real)], names=["target_id", "seen", "seq", "priority"])

    ship(members.sparkSession)
    return members.select(F.col("target_id").cast("long"), "need", F.col("seq").cast("long"), "priority").mapInArrow(run, "target_id long, seen long, seq long, priority long")


def _merged(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, available, quota, need, seq, at) of all reservoirs: at is a row's place by priority within its target."""
    biased = F.col("priority").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))  # the slice of a priority, in its order as signed
    part = F.coalesce(F.shiftrightunsigned(biased, 64 - SLICES.bit_length() + 1), F.lit(0)).cast("int")
    rows = reservoirs(_members(records, targets)).withColumn("slice", part)
    counts = rows.groupBy("target_id", "slice").agg(F.count("priority").alias("n"), F.sum("seen").alias("seen"))
    whole = Window.partitionBy("target_id")  # SLICES rows a target at most
    before = F.coalesce(F.sum("n").over(whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    counts = counts.select("target_id", "slice", before.alias("before"), F.sum("seen").over(whole).alias("available"))
    order = F.row_number().over(Window.partitionBy("target_id", "slice").orderBy("priority", "seq"))
    return rows.where("priority IS NOT NULL").withColumn("at", order).join(counts, ["target_id", "slice"]).select("target_id", "available", "seq", (F.col("at") + F.col("before")).alias("at"))


def draw(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, seq, available) of the drawn records: of each target the ``quota`` of lowest priority, or all there are.

    ``seq`` is the first delivery of the record in that category, ``available`` the final count of the category.
    """
    quota = with_quotas(targets).select("target_id", "quota")
    return _merged(records, targets).join(quota, "target_id").where("at <= quota").select("target_id", "seq", "available")


def sample(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, seq) of the drawn records."""
    return draw(records, targets).select("target_id", "seq")


def _available(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id, available) by the counts that the reservoirs carry; targets without a record are absent."""
    return reservoirs(_members(records, targets)).groupBy("target_id").agg(F.sum("seen").alias("available"))


def report(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target with what it asked for, what there was, what of it could be taken and what is missing; exhausted: it fell short."""
    zero = F.lit(0).cast("long")
    out = needs(targets).join(_available(records, targets), "target_id", "left").select("target_id", "draw_id", "need", F.coalesce("available", zero).alias("available"))
    out = out.withColumn("taken", F.least("need", "available"))
    return out.withColumn("short", F.col("need") - F.col("taken")).withColumn("exhausted", F.col("taken") < F.col("need"))


def drawn(records: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target with its feasible quota, the rows the sample really has of it, and what the quota is short of."""
    got = draw(records, targets).groupBy("target_id").agg(F.count("*").alias("drawn"))
    out = with_quotas(targets).join(got, "target_id", "left").select("target_id", "draw_id", "quota", F.coalesce("drawn", F.lit(0).cast("long")).alias("drawn"))
    return out.withColumn("short", F.col("quota") - F.col("drawn"))


def exhausted(records: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_id) of the targets that fall short."""
    return report(records, targets).where("exhausted").select("target_id")
