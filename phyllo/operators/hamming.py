"""Similarity self-join of 64-bit hashes within a Hamming distance: exact, by bands, verified in vectorised blocks.

Any bits, cut into ``t + 1`` bands, will do: two hashes within t bits agree on one of the bands. So every hash goes to one
bucket a band, the buckets are shuffled as (scheme, band, value, hash) and sorted, and each bucket is joined with itself
where it arrives: bands are cut again, out of the bits that tell its hashes apart, and only hashes that agree on one of
those are compared, whole columns at a time. In the JVM a hash join of the same pairs took six times the CPU, as it visits
them row by row.

With groups, only hashes of one group are paired: the group is part of the bucket, so that a group which a third of all
rows share is cut like any other full bucket.

A bucket of more than ``bucket`` hashes is not shuffled as one: it gets a scheme of its own, bands of the bits that vary in
it, up to ``LEVELS`` - 1 times. What is still full then (hashes that differ in very few bits) is cut into chunks, and each pair of
chunks is a bucket. So band values that a third of all hashes share make no giant bucket, and buckets stay small when
the input grows. Equal hashes are collapsed before. No step drops a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phyllo.session import ship

Cut = tuple[int, int]
LEVELS = 3
#: Buckets up to this size are compared as they are.
SMALL = 48
#: A bit tells hashes apart if the rarer of its values has this share.
VARIES = 0.1


def hash_bits(c: Column | str) -> Column:
    """16 hex digits as a signed long of the same bits; anything else is null. Case and outer blanks don't matter."""
    t = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(t.rlike("^[0-9A-Fa-f]{16}$"), F.conv(t, 16, -10).cast("long"))


def bands(n: int, bits: int = 64) -> list[Cut]:
    """(start, width) of n bands of nearly even width, from the lowest bit up."""
    at = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


def band(c: Column, cut: Cut) -> Column:
    start, width = cut
    return F.shiftrightunsigned(c, start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def scheme(counts: np.ndarray, n: int, t: int) -> list[int]:
    """Masks of t + 1 bands out of the bits that vary among n hashes, of which counts[k] have bit k set."""
    share = np.minimum(counts, n - counts) / max(n, 1)
    bits = [int(k) for k in np.flatnonzero(share >= VARIES)]
    if len(bits) < 2 * (t + 1):  # too few of them: the most varied bits
        bits = sorted(int(k) for k in np.argsort(-share, kind="stable")[: max(2 * (t + 1), int((share > 0).sum()))])
    return [sum(1 << b for b in bits[start : start + width]) for start, width in bands(t + 1, len(bits))]


def _near(h: np.ndarray, starts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs within t bits in each run of h: each hash against the one d places on, for all d at once a column."""
    ends = np.repeat(np.r_[starts[1:], len(h)], np.diff(np.r_[starts, len(h)]))
    at, d, left, right = np.arange(len(h)), 1, [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while True:
        at = at[at + d < ends[at]]
        if not len(at):
            return np.concatenate(left), np.concatenate(right)
        near = at[np.bitwise_count(h[at] ^ h[at + d]) <= t]
        left.append(near)
        right.append(near + d)
        d += 1


def _compare(h: np.ndarray, key: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within t bits among hashes of equal key."""
    order = np.argsort(key, kind="stable")
    h, key = h[order], key[order]
    a, b = _near(h, np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), t)
    return h[a], h[b]


def bucket_pairs(h: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (a < b as signed) within t bits of one bucket of distinct hashes."""
    u = h.view(np.uint64)
    if len(u) <= SMALL:
        found = [_compare(u, np.zeros(len(u), np.uint8), t)]
    else:
        counts = np.unpackbits(u.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        found = [_compare(u, u & np.uint64(m), t) for m in scheme(counts, len(u), t)]
    a, b = (np.concatenate([p[k] for p in found]).view(np.int64) for k in (0, 1))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def self_pairs(hashes: DataFrame, c: str = "h", t: int = 6, bucket: int = 50_000, group: str | None = None) -> DataFrame:
    """(a, b, distance), a < b, of all pairs of different values of the bigint column c within t bits, each once.

    group: a bigint column; pairs of equal groups only, as (group, a, b, distance). Nulls in either are ignored and repeated
    values count once. 0 <= t <= 30.
    """
    if not 0 <= t <= 30:
        raise ValueError("0 <= t <= 30")
    spark = hashes.sparkSession
    own = hashes.select(F.col(c).alias("h"), (F.col(group) if group else F.lit(0)).cast("long").alias("g")).where("h IS NOT NULL AND g IS NOT NULL").distinct()
    h = F.col("h")
    masks = [sum(1 << b for b in range(start, start + width)) for start, width in bands(t + 1)]
    rows = own.select("g", F.lit(0).alias("s"), h, F.posexplode(F.array(*[h.bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks])).alias("i", "v"))
    key, parts, last = ["g", "s", "i", "v"], [], 0
    for depth in range(1, LEVELS + 1):
        full = rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > bucket).collect()
        if not full:
            parts.append(rows)
            break
        big = F.broadcast(spark.createDataFrame([tuple(r)[:4] for r in full], "g long, s int, i int, v long"))  # one row for ``bucket`` hashes
        parts.append(rows.join(big, key, "left_anti"))
        crowded = rows.join(big, key, "left_semi")
        if depth == LEVELS:
            plans = [(*tuple(r)[:4], last + n, -(-r["n"] // bucket)) for n, r in enumerate(full, 1)]
            plan = F.broadcast(spark.createDataFrame(plans, "g long, s int, i int, v long, own int, k int"))
            k, chunk = F.col("k"), F.pmod(F.xxhash64("h"), F.col("k")).cast("int")
            met = F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.least(chunk, j) * k + F.greatest(chunk, j))
            parts.append(crowded.join(plan, key).select("g", F.col("own").alias("s"), "h", F.explode(met).alias("i"), F.lit(0).cast("long").alias("v")))
            break
        bits = crowded.groupBy(*key).agg(F.count("*").alias("n"), F.array(*[F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(1).cast("long"))) for k in range(64)]).alias("bits"))
        plans = []
        for r in bits.collect():
            last += 1
            plans.append((*(r[k] for k in key), last, [_signed(m) for m in scheme(np.array(r["bits"]), r["n"], t)]))
        plan = F.broadcast(spark.createDataFrame(plans, "g long, s int, i int, v long, own int, masks array<long>"))
        rows = crowded.join(plan, key).select("g", F.col("own").alias("s"), h, F.posexplode("masks").alias("i", "m")).select("g", "s", "h", "i", h.bitwiseAND(F.col("m")).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(columns: list[np.ndarray]) -> pa.RecordBatch:
            """Of whole buckets: the small ones together, the others one by one."""
            g, x = columns[0], columns[4]
            cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])) + 1
            starts = np.r_[0, cuts]
            size = np.diff(np.r_[starts, len(x)])
            rows = np.flatnonzero(np.repeat((size > 1) & (size <= SMALL), size))
            few = size[(size > 1) & (size <= SMALL)]
            a, b = _near(x[rows].view(np.uint64), np.r_[0, np.cumsum(few)[:-1]], t) if len(rows) else (rows, rows)
            a, b = rows[a], rows[b]
            out = [(g[a], np.minimum(x[a], x[b]), np.maximum(x[a], x[b]))]
            for k in np.flatnonzero(size > SMALL):
                low, high = bucket_pairs(x[starts[k] : starts[k] + size[k]], t)
                out.append((np.full(len(low), g[starts[k]]), low, high))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[n] for o in out])) for n in range(3)], names=["g", "a", "b"])

        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in (*key, "h")]
            # the last bucket of a batch may go on in the next
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:4]])) + 1
            first = [c[0] for c in columns[:4]] == [c[-1] for c in waiting[-1][:4]] if waiting else True
            cut = int(change[-1]) if len(change) else (0 if first else -1)
            if cut == 0:
                waiting.append(columns)
                continue
            if cut < 0:  # one bucket, another than the one that waits
                yield pairs([np.concatenate(c) for c in zip(*waiting)])
                waiting = [columns]
                continue
            waiting.append([c[:cut] for c in columns])
            yield pairs([np.concatenate(c) for c in zip(*waiting)])
            waiting = [[c[cut:] for c in columns]]
        if waiting:
            yield pairs([np.concatenate(c) for c in zip(*waiting)])

    ship(spark)
    found = None
    for part in parts:
        one = part.select(*key, "h").repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "g long, a long, b long")
        found = one if found is None else found.unionByName(one)
    return found.distinct().select(*([F.col("g").alias(group)] if group else []), "a", "b", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("distance"))
