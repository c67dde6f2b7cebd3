"""The same or nearly the same pictures across splits: an exact prefix-filter join on rare shingles of the hash.

A 64-bit hash is a set of four positional shingles, its 16-bit pieces. Two hashes within 6 bits cannot differ much in all
of them: for any radii r with sum(r_i + 1) = 7 over some of the pieces there is a piece i within r_i bits. So each
evaluation hash is indexed by a prefix: its rarest pieces, each with the variants within that piece's radius. The rarest
pieces get the larger radii; the most frequent one is matched exactly, or, where its value is hot, left out and the rarest
takes radius 2 for it (radii 1, 1, 1, 0 or 2, 1, 1, none). Training hashes probe the index with their four pieces as they
are. A candidate passes the length filter (numbers of set bits differ by 6 at most), the position filter (it is kept only
at its first piece within the radius, so no distinct is needed) and is verified on all 64 bits. Every step is exact.

Evaluation is the smaller side, as splits are; the counts of shingles are a table of 4 x 65,536 rows at most. Beyond
``MANY`` training hashes three pieces of 21 and 22 bits take the place of the four, with radii 2, 1, 1: five times the index
for a sixth of the candidates (1.3e-4 of all pairs in place of 8e-4), as these grow with the square of the input.

Defined results: null, blank or malformed hashes match nothing; checksums are compared without case, null and blank ones
match nothing; a row of both sides is paired with others but not with itself; each pair comes once; repeated split rows
count once; split rows without a record and records without a split row have no part; empty tables give empty tables.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phyllo.functions.text import blank
from phyllo.operators.hamming import band, bands, hash_bits
from phyllo.session import materialize

#: Above so many training hashes three wider pieces are used: more index entries, far fewer candidates.
MANY = 20_000_000


def _flips(radius: int, width: int) -> list[int]:
    """All xor masks of a piece within that many bits."""
    return [sum(1 << b for b in at) for n in range(radius + 1) for at in combinations(range(width), n)]


def _xor_with(base: Column):
    return lambda m: base.bitwiseXOR(m.cast("long"))


def _radii(t: int, pieces: int) -> tuple[list[int], list[int]]:
    """Radii of the pieces from the rarest to the most frequent, without and with a hot last piece (-1: not indexed)."""
    even = [(t + 1 + pieces - 1 - k) // pieces - 1 for k in range(pieces)]
    skip = [(t + 1 + pieces - 2 - k) // (pieces - 1) - 1 for k in range(pieces - 1)] + [-1]
    return even, skip


def near_pairs(evaluation: DataFrame, training: DataFrame, t: int = 6, hot: float = 1 / 512, pieces: int | None = None) -> DataFrame:
    """(e, r, distance) of all pairs of an evaluation hash e and a training hash r (bigint column h) within t bits.

    A piece value is hot if it is in more than ``hot`` of the training hashes (and in 64). 3 <= t <= 11; equal hashes are
    pairs too. pieces: 4 (of 16 bits), or 3 (of 21 and 22) for very many training hashes; chosen by their number if None.
    """
    if not 3 <= t <= 11:
        raise ValueError("3 <= t <= 11")
    h = F.col("h")
    ev = evaluation.select("h").where("h IS NOT NULL").distinct()
    tr = training.select("h").where("h IS NOT NULL").distinct()
    total = tr.count()
    pieces = pieces or (3 if total > MANY else 4)
    cuts = bands(pieces)
    top = max(w for _, w in cuts)
    spread = F.posexplode(F.array(*[band(h, c) for c in cuts])).alias("i", "value")
    key = lambda i, value: F.shiftleft(i.cast("long"), top).bitwiseOR(value)
    probes = tr.select(h.alias("r"), spread).select("r", key(F.col("i"), F.col("value")).alias("k"))
    counts = probes.groupBy("k").agg(F.count("*").alias("n"))
    counts = F.broadcast(counts) if pieces == 4 else counts  # at most 4 x 65,536 rows
    own = ev.select(h, spread).select("h", "i", key(F.col("i"), F.col("value")).alias("k"))
    ranked = own.join(counts, "k", "left").groupBy("h").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("i")))).alias("order"))
    even, skip = _radii(t, pieces)
    is_hot = F.col("order")[pieces - 1]["n"] > F.lit(max(64, int(hot * total)))
    radii = [F.when(is_hot, skip[k]).otherwise(even[k]) for k in range(pieces)]
    of = lambda i: sum((F.when(F.col("order")[k]["i"] == i, radii[k] + 1).otherwise(0) for k in range(pieces)), F.lit(0)) - 1
    # the radii of the pieces, 4 bits each, plus 1, travel with the index entry for the position filter
    packed = sum((F.shiftleft((of(i) + 1).cast("int"), 4 * i) for i in range(pieces)), F.lit(0))
    planned = ranked.select("h", packed.alias("radii"))
    radius = lambda i: F.shiftright(F.col("radii"), 4 * i).bitwiseAND(F.lit(15)) - 1
    entries = []
    for i, c in enumerate(cuts):
        masks = F.lit(None).cast("array<int>")
        for r in sorted({*even, *skip} - {-1}):
            masks = F.when(radius(i) == r, F.array(*[F.lit(m) for m in _flips(r, c[1])])).otherwise(masks)
        base = F.lit(i << top).cast("long").bitwiseOR(band(h, c))
        entries.append(F.transform(F.coalesce(masks, F.array().cast("array<int>")), _xor_with(base)))
    index = planned.select(F.col("h").alias("e"), "radii", F.explode(F.concat(*entries)).alias("k"))
    x = F.col("e").bitwiseXOR(F.col("r"))
    at = F.shiftright(F.col("i.k"), top)
    earlier = F.lit(False)
    for i in range(pieces - 1):
        earlier = earlier | ((at > i) & (F.bit_count(band(x, cuts[i])) <= radius(i)))
    passes = (F.abs(F.bit_count("e") - F.bit_count("r")) <= t) & (F.bit_count(x) <= t) & ~earlier
    return probes.alias("p").join(index.alias("i").hint("shuffle_hash"), (F.col("p.k") == F.col("i.k")) & passes).select("e", "r", F.bit_count(x).alias("distance"))


def sides(records: DataFrame, splits: DataFrame, train: tuple[str, ...] = ("train",), held: tuple[str, ...] = ("val", "test")) -> DataFrame:
    """seq, source, checksum (lower case, as bytes), hash and the splits of every record that has a split row."""
    split = F.lower(F.trim("split"))
    flags = (
        splits.where("path IS NOT NULL").groupBy("path")
        .agg(F.max(split.isin(*train)).alias("in_train"), F.max(split.isin(*held)).alias("in_held"), F.array_sort(F.collect_set(F.when(split.isin(*held), split))).alias("held"))
        .where("in_train OR in_held")
    )
    checksum = F.when(~blank("checksum"), F.coalesce(F.try_to_binary(F.lower(F.trim("checksum")), F.lit("hex")), F.encode(F.lower(F.trim("checksum")), "utf-8")))
    own = records.select("seq", "source", "path", checksum.alias("checksum"), hash_bits("phash").alias("h"))
    return own.join(flags, "path").drop("path")


def overlaps(records: DataFrame, splits: DataFrame, t: int = 6) -> DataFrame:
    """(held_seq, train_seq, held, source, train_source, exact, distance) of all overlaps of held-out and training records.

    A pair of equal checksums is exact; any other pair has hashes within t bits. A row on both sides is met from both.
    """
    rows = materialize(sides(records, splits), "sides")  # read five times below
    ev = rows.where("in_held").select(F.col("seq").alias("held_seq"), "held", "source", "checksum", "h")
    tr = rows.where("in_train").select(F.col("seq").alias("train_seq"), F.col("source").alias("train_source"), F.col("checksum").alias("train_checksum"), F.col("h").alias("train_h"))
    columns = ["held_seq", "train_seq", "held", "source", "train_source", "exact", "distance"]
    exact = ev.join(tr, F.col("checksum") == F.col("train_checksum")).select("*", F.lit(True).alias("exact"), F.bit_count(F.col("h").bitwiseXOR(F.col("train_h"))).alias("distance"))
    close = near_pairs(ev.select("h"), tr.select(F.col("train_h").alias("h")), t)
    near = ev.join(close, F.col("h") == F.col("e")).join(tr, F.col("train_h") == F.col("r")).where(~F.coalesce(F.col("checksum") == F.col("train_checksum"), F.lit(False))).withColumn("exact", F.lit(False))
    return exact.select(columns).unionByName(near.select(columns)).where("held_seq <> train_seq")


def overlap_pairs(records: DataFrame, splits: DataFrame, t: int = 6) -> DataFrame:
    """(seq_a, seq_b), smaller first, each pair once."""
    both = overlaps(records, splits, t).select(F.least("held_seq", "train_seq").alias("seq_a"), F.greatest("held_seq", "train_seq").alias("seq_b"))
    return both.distinct()


def overlap_report(records: DataFrame, splits: DataFrame, t: int = 6) -> DataFrame:
    """Counts of overlapping pairs and of held-out records touched, by split and source of the held-out record.

    Records of equal checksum and hash are one class with a count, so that a picture held k times and trained on m times is
    counted as k x m pairs without making them.
    """
    own = sides(records, splits)
    key = ["checksum", "h"]
    rows = materialize(own.groupBy(*key, "source", "in_held", "held", "in_train").agg(F.count("*").alias("n")), "classes")  # read several times
    train = rows.where("in_train").groupBy(*key).agg(F.sum("n").alias("m"))
    held = rows.where("in_held").select(*key, "source", "held", F.col("in_train").cast("int").alias("both"), F.col("n").alias("k"))
    per_file = train.where("checksum IS NOT NULL").groupBy("checksum").agg(F.sum("m").alias("same_file"))
    close = near_pairs(rows.where("in_held").select("h"), train.select("h"), t)
    per_hash = train.where("h IS NOT NULL").groupBy("h").agg(F.sum("m").alias("m")).withColumnRenamed("h", "r")
    alike = close.join(per_hash, "r").groupBy(F.col("e").alias("h")).agg(F.sum("m").alias("alike"))
    # counted by both: training classes of the same checksum whose hash is near as well
    x = F.bit_count(F.col("a.h").bitwiseXOR(F.col("b.h")))
    twice = held.select(*key).where("checksum IS NOT NULL AND h IS NOT NULL").distinct().alias("a").join(train.alias("b"), (F.col("a.checksum") == F.col("b.checksum")) & (x <= t))
    twice = twice.groupBy(F.col("a.checksum").alias("checksum"), F.col("a.h").alias("h")).agg(F.sum("b.m").alias("twice"))
    n = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    met = held.join(per_file, "checksum", "left").join(alike, "h", "left").join(twice, key, "left")
    # a record on both sides is not its own partner
    self_exact = F.when(F.col("checksum").isNotNull(), F.col("both")).otherwise(0)
    self_near = F.when(F.col("h").isNotNull(), F.col("both")).otherwise(0)
    exact = n("same_file") - self_exact
    pairs = n("same_file") + n("alike") - n("twice") - F.greatest(self_exact, self_near)
    found = met.select("source", "k", F.explode("held").alias("split"), exact.alias("x"), pairs.alias("p")).where("p > 0")
    return found.groupBy("split", "source").agg(F.sum(F.col("k") * F.col("p")).alias("n_pairs"), F.sum(F.col("k") * F.col("x")).alias("n_exact"), F.sum("k").alias("n_records"))
