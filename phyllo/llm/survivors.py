"""The best representative of each group of records of one picture, chosen by consistent bundles of fields.

Groups: records of equal checksum or of hashes within 6 bits, directly or through others (exact Hamming self-join of the
distinct hashes, Hash-to-Min components). Fields that depend on each other form bundles that are taken whole from one
record: standing (status, reason, duplicate_of), origin (source, source_id, original_url, publisher, dataset_key,
observation_id), rights (license, license_url, author), file (width, height, path, image_url), time (downloaded_at) and
name (species, internal_plant_id). Two functional dependencies bind bundles: a delivered item has one licence,
so rights may not contradict a licence that the origin's own record states; an observation has one species, so the name
must be that of the origin's record if that belongs to an observation. Branch and bound (``solve``) picks all six bundles:
the greatest total trust under these, of equal totals one that a single record gives whole, then the best name. Where one
record wins every bundle that has an order of its own (all but the name), it is the best row of the group.
Per group only the best candidate of each (licence, species) and bundle and the best whole record of each are kept, which
loses nothing, since the dependencies see no other field; candidates are merged map-side, so no group is ever collected.

Order within a bundle: kept over any other status; smaller trust_rank (an unknown source comes last); a stated licence over
a blank one; larger width (null, 0 and less: unknown); a stated species; then the later ``downloaded_at`` (as an instant;
blank or unreadable is earliest; without a zone UTC), then the smaller ``seq``.

Defined results: null, blank or malformed hashes and checksums link nothing; a record without links makes no group and is
its own survivor, so it is not listed; exact copies of all fields tie, and then no row is ``best_seq``; empty tables give
empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phyllo.functions.text import blank
from phyllo.operators.components import components
from phyllo.operators.hamming import hash_bits, self_pairs
from phyllo.session import materialize, ship

BUNDLES = {
    "standing": ["status", "reason", "duplicate_of"],
    "origin": ["source", "source_id", "original_url", "publisher", "dataset_key", "observation_id"],
    "rights": ["license", "license_url", "author"],
    "file": ["width", "height", "path", "image_url"],
    "name": ["species", "internal_plant_id"],
    "time": ["downloaded_at"],
}
#: Weight of a bundle's trust in the total.
WEIGHTS = {"standing": 8.0, "origin": 4.0, "rights": 3.0, "file": 2.0, "name": 1.0, "time": 0.5}
#: Sums of the same gains in another order may differ by so much.
SLACK = 1e-9


def checksum_bytes(c: str = "checksum") -> Column:
    low = F.lower(F.trim(c))
    return F.when(~blank(c), F.coalesce(F.try_to_binary(low, F.lit("hex")), F.encode(low, "utf-8")))


def instant(c: str = "downloaded_at") -> Column:
    """Microseconds since 1970; blank or unreadable: the smallest long. A text without a zone is in UTC."""
    t = F.trim(c)
    zoned = F.when(t.rlike(r"([zZ]|[+-]\d{2}:?\d{2}|[+-]\d{2})$") & t.rlike("[tT ]"), t).when(t.rlike("[tT ]"), F.concat(t, F.lit("Z"))).otherwise(F.concat(t, F.lit("T00:00:00Z")))
    zoned = F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = F.when(t.rlike(r"^[+-]?\d{4,6}-\d{1,2}-\d{1,2}"), zoned)  # a bare time would be taken as one of today
    return F.coalesce(F.unix_micros(zoned.try_cast("timestamp")), F.lit(-(1 << 63)).cast("long"))


def picture_groups(records: DataFrame, t: int = 6) -> DataFrame:
    """(seq, part, root) of the records in groups of at least two; (part, root) names the group.

    part 0: groups that hold a hash, root is their smallest hash as a signed long; part 1: groups of equal checksums
    without any hash, root is their smallest seq.
    """
    rows = records.select("seq", checksum_bytes().alias("c"), hash_bits("phash").alias("h"))
    # per checksum: its range of hashes tells whether it links different ones; three or more are fetched one by one
    files = rows.where("c IS NOT NULL").groupBy("c").agg(F.min("h").alias("low"), F.max("h").alias("high"), F.count("h").alias("nh"), F.count("*").alias("n"), F.min("seq").alias("first")).where("n > 1")
    files = materialize(files, "files")
    wide = files.where("low < high")
    links = wide.select(F.col("low").alias("a"), F.col("high").alias("b"))
    more = rows.where("h IS NOT NULL").join(wide.where("nh > 2").select("c", "low"), "c").where("h <> low").select(F.col("low").alias("a"), F.col("h").alias("b"))
    near = self_pairs(rows, "h", t).select("a", "b")
    roots = components(links.unionByName(more).unionByName(near))
    repeated = rows.where("h IS NOT NULL").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select(F.col("h").alias("node"), F.col("h").alias("root"))
    bare = rows.where("h IS NULL AND c IS NOT NULL").join(files.select("c", "low", "first"), "c").select("seq", "low", "first").withColumn("part", F.col("low").isNull().cast("int"))
    # a checksum shared with a row without hash makes a group of its own hash, linked or not
    lent = bare.where("part = 0").select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    known = roots.unionByName(repeated).unionByName(lent).groupBy("node").agg(F.min("root").alias("root"))
    hashed = rows.where("h IS NOT NULL").select("seq", F.col("h").alias("node")).unionByName(bare.where("part = 0").select("seq", F.col("low").alias("node")))
    out = hashed.join(known, "node").select("seq", F.lit(0).alias("part"), "root")
    return out.unionByName(bare.where("part = 1").select("seq", "part", F.col("first").alias("root")))


def _quality(records: DataFrame, sources: DataFrame) -> DataFrame:
    ranks = sources.select("source", "trust_rank").groupBy("source").agg(F.min("trust_rank").alias("trust_rank"))
    ranks = F.broadcast(ranks) if sources.limit(10_001).count() <= 10_000 else ranks
    out = records.select(
        "seq", "source", F.coalesce(F.lower(F.trim("status")) == "kept", F.lit(False)).cast("int").alias("kept"), (~blank("license")).cast("int").alias("licensed"),
        F.greatest(F.coalesce("width", F.lit(0)), F.lit(0)).alias("width"), instant().alias("at"), F.when(~blank("license"), F.lower(F.trim("license"))).alias("lic"),
        F.when(~blank("species"), F.trim("species")).alias("sp"), (~blank("observation_id")).alias("observed"),
    ).join(ranks, "source", "left")
    return out.withColumn("trust", -F.coalesce("trust_rank", F.lit(2**31 - 1)).cast("long")).drop("trust_rank", "source")


def solve(candidates: dict[str, list[dict]]) -> dict[str, int]:
    """The seq of each bundle: branch and bound over candidates {seq, gain, lic, sp, observed}, most trust first.

    Bundles are bound in the order origin, rights, standing, file, time, name; the bound is the trust so far plus the best of
    each bundle left. A branch is cut when its bound can't reach the best found; rights and name always have a candidate that
    fits, that of the origin's own licence and species. Of equal totals (the name not counted) one record that gives every
    bundle but the name goes first, then the better name, then the order of the lists (by gain; equal gains as given).
    """
    order = [b for b in ("origin", "rights", "standing", "file", "time", "name") if b in candidates]
    lists = [sorted(candidates[b], key=lambda c: -c["gain"]) for b in order]
    counted = [b != "name" for b in order]
    rest = [0.0] * (len(order) + 1)
    for k in reversed(range(len(order))):
        rest[k] = rest[k + 1] + (lists[k][0]["gain"] if counted[k] else 0.0)
    best: tuple[float, bool, float] = (-1.0, False, -1.0)
    chosen: list[int] = []
    by_seq = [{c["seq"]: c for c in own} for own in lists]

    def fits(b: str, c: dict, origin: dict) -> bool:
        if b == "rights":
            return origin["lic"] is None or c["lic"] == origin["lic"]
        return b != "name" or not origin["observed"] or c["sp"] == origin["sp"]

    def options(k: int, origin: dict) -> Iterator[dict]:
        """What need be tried after the origin: its own record, which keeps the bundles together, and the best that fits."""
        own = by_seq[k].get(origin["seq"])
        first = next(c for c in lists[k] if fits(order[k], c, origin))
        if own is not None and own["gain"] == first["gain"] and fits(order[k], own, origin):
            yield own
        yield first

    def branch(k: int, total: float, picked: list[int], name: float, origin: dict) -> None:
        nonlocal best, chosen
        if total + rest[k] < best[0] - SLACK:
            return
        if k == len(order):
            found = (total, all(s == picked[0] for s, c in zip(picked, counted) if c), name)
            if found > best:
                best, chosen = found, picked
            return
        for c in options(k, origin):
            branch(k + 1, total + (c["gain"] if counted[k] else 0.0), [*picked, c["seq"]], name if counted[k] else c["gain"], origin)

    for c in lists[0]:
        if c["gain"] + rest[1] < best[0] - SLACK:
            break
        branch(1, c["gain"], [c["seq"]], 0.0, c)
    return dict(zip(order, chosen))


def _gains(items: list[int], weight: float) -> list[float]:
    """Ranks of trust keys, scaled to the bundle's weight; equal keys gain the same."""
    rank = {x: n for n, x in enumerate(sorted(set(items)), 1)}
    return [weight * rank[x] / len(rank) for x in items]


#: The key by which candidates of a bundle are ordered.
KEYS = {"standing": "kept", "origin": "trust", "rights": "licensed", "file": "width", "name": "named", "time": "at"}


def choose(options: list[dict]) -> dict[str, int]:
    """The seq of each bundle of one group: ``options`` holds of each (lic, sp) the candidates {s, t, v, observed} of the
    bundles and the best whole record {s, observed, kept, trust, licensed, width, at, named}; s is the seq, negated."""
    candidates = {}
    for b, key in KEYS.items():
        own = {(o[b]["s"]): (o[b]["v"], o[b]["t"], o[b]["observed"], o) for o in options}
        own |= {o["whole"]["s"]: (o["whole"][key], o["whole"]["at"], o["whole"]["observed"], o) for o in options}
        items = sorted(own.items(), key=lambda x: (-x[1][1], -x[0]))  # later, then smaller seq first
        gains = _gains([v for _, (v, *_) in items], WEIGHTS[b])
        candidates[b] = [{"seq": -s, "gain": g, "lic": o["lic"], "sp": o["sp"], "observed": seen} for g, (s, (_, _, seen, o)) in zip(gains, items)]
    return solve(candidates)


def survivors(records: DataFrame, sources: DataFrame, t: int = 6) -> DataFrame:
    """One row a group: first_seq, n_rows, best_seq and the seq each bundle is taken from (standing_seq ...).

    best_seq is the record that wins standing, origin, rights, file and time, checked exactly to be the one row that is at
    least as good as every other in status, trust, licence, width and time and better than each in one; null if there is none.
    """
    groups = picture_groups(records, t)
    rows = groups.join(_quality(records, sources), "seq").withColumn("named", F.col("sp").isNotNull().cast("int"))
    five = ["kept", "trust", "licensed", "width", "at"]
    seq = F.col("seq")
    top = lambda c: F.max(F.struct(F.col(c).cast("long").alias("v"), F.col("at").alias("t"), (-seq).alias("s"), "observed"))
    # of each (licence, species): the best of each bundle, the best whole record, and whether that has an equal
    part = rows.groupBy("part", "root", "lic", "sp").agg(
        F.count("*").alias("n"), F.min("seq").alias("first"), *[F.max(c).alias(c) for c in five], *[top(c).alias(b) for b, c in KEYS.items()],
        F.max(F.struct(*five, (-seq).alias("s"), "observed", "named")).alias("whole"), F.max(F.struct(*five, seq)).alias("last"),
    )
    options = F.collect_list(F.struct("lic", "sp", "whole", *KEYS)).alias("options")
    whole = part.groupBy("part", "root").agg(
        F.sum("n").alias("n_rows"), F.min("first").alias("first_seq"), F.struct(*[F.max(c).alias(c) for c in five]).alias("most"), F.max("last").alias("last"), F.max("whole").alias("top"), options
    ).where("n_rows > 1")
    attained = F.col("last.seq") == -F.col("top.s")
    for c in five:
        attained = attained & (F.col(f"top.{c}") == F.col(f"most.{c}"))
    known = whole.select("first_seq", "n_rows", F.when(attained, -F.col("top.s")).alias("exact"), "options")
    names = [f"{b}_seq" for b in BUNDLES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [choose(options) for options in batch.column("options").to_pylist()]
            won = [c["origin"] if len({s for b, s in c.items() if b != "name"}) == 1 else None for c in chosen]
            best = [w if w == x else None for w, x in zip(won, batch.column("exact").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("first_seq"), batch.column("n_rows"), pa.array(best, pa.int64()), *(pa.array([c[b] for c in chosen], pa.int64()) for b in BUNDLES)], names=["first_seq", "n_rows", "best_seq", *names]
            )

    ship(records.sparkSession)
    return known.mapInArrow(run, "first_seq long, n_rows long, best_seq long, " + ", ".join(f"{n} long" for n in names))


def build_survivors(records: DataFrame, sources: DataFrame, t: int = 6) -> DataFrame:
    """The surviving record of each group, field by field: first_seq, n_rows and the fields of every bundle."""
    taken = F.inline(F.array(*[F.struct(F.lit(b).alias("bundle"), F.col(f"{b}_seq").alias("seq")) for b in BUNDLES]))
    chosen = survivors(records, sources, t).select("first_seq", "n_rows", taken)
    fields = [f for own in BUNDLES.values() for f in own]
    rows = records.select("seq", *fields).join(chosen, "seq")
    # one row a group and bundle: max only picks it
    whole = rows.groupBy("first_seq", "n_rows").agg(*[F.max(F.when(F.col("bundle") == b, F.struct(*own))).alias(f"_{b}") for b, own in BUNDLES.items()])
    return whole.select("first_seq", "n_rows", *[F.col(f"_{b}.{f}").alias(f) for b, own in BUNDLES.items() for f in own])
