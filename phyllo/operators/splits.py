"""Leakage-free splits: group keys, stable hash splits, minimal coverage repair, quota samples, frozen slices."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phyllo.functions.scalars import group_key, split_of
from phyllo.operators.components import components
from phyllo.operators.dedup import hash_links
from phyllo.operators.hamming import hash_bits
from phyllo.session import ship

MIN_VAL, MIN_TEST, MIN_TRAIN = 3, 1, 25
#: Spellings of true in free flags. Fixed values.
TRUE = ["true", "yes", "1", "t", "y", "on"]


def captive(extra: Column | str = "extra") -> Column:
    e = F.col(extra) if isinstance(extra, str) else extra
    return F.coalesce(F.lower(F.trim(F.try_element_at(e, F.lit("captive")))).isin(*TRUE), F.lit(False))


def assign_groups(records: DataFrame, t: int = 6) -> DataFrame:
    """(seq, group_id) of kept records: observations, merged where they share a file or near twins of a species.

    A group is named by the key of its smallest seq, so groups without such links keep their observation's own key.
    """
    kept = records.where("status = 'kept'").select("seq", "species", "checksum", group_key("source", "observation_id", "source_id").alias("key"), hash_bits("phash").alias("h"))
    hub = lambda c: kept.where(f"{c} IS NOT NULL AND {c} <> ''").groupBy(c).agg(F.min("seq").alias("hub"))
    links = None
    for c in ("key", "checksum"):
        part = kept.join(hub(c), c).where("seq <> hub").select(F.col("hub").alias("a"), F.col("seq").alias("b"))
        links = part if links is None else links.unionByName(part)
    roots = components(links.unionByName(hash_links(kept.select("seq", "species", "h"), t, "species"))).withColumnRenamed("node", "seq")
    named = kept.select("seq", "key").join(roots, "seq", "left").select("seq", F.coalesce("root", "seq").alias("root"))
    return named.join(kept.select(F.col("seq").alias("root"), F.col("key").alias("group_id")), "root").select("seq", "group_id")


def moves(sizes: list[tuple[str, int]], missing: int, least: int = MIN_TRAIN) -> list[str]:
    """Which training groups to give to a side that lacks ``missing`` rows: the fewest rows that do, or none.

    sizes: (group, rows) of the groups in training. Either the smallest single group that suffices, or the smallest groups
    together; a plan must leave a group and ``least`` rows in training.
    """
    by_size = sorted(sizes, key=lambda x: (x[1], x[0]))
    total = sum(n for _, n in sizes)
    plans = [[x] for x in by_size if x[1] >= missing][:1]
    taken, n = [], 0
    for x in by_size:
        taken.append(x)
        n += x[1]
        if n >= missing:
            plans.append(taken)
            break
    weight = lambda plan: sum(n for _, n in plan)
    good = [p for p in plans if len(p) < len(by_size) and total - weight(p) >= least]
    return [g for g, _ in min(good, key=lambda p: (weight(p), len(p), [g for g, _ in p]))] if good else []


def repair(sizes: DataFrame, min_val: int = MIN_VAL, min_test: int = MIN_TEST, min_train: int = MIN_TRAIN) -> DataFrame:
    """(species, group_id, split) of the groups that must move so that each species can be validated and tested.

    sizes: (species, group_id, split, n). Only species that lack a side are touched, and only training groups move.
    """
    side = lambda name: F.sum(F.when(F.col("split") == name, F.col("n")).otherwise(0))
    short = sizes.groupBy("species").agg(side("val").alias("_v"), side("test").alias("_t")).where((F.col("_v") < min_val) | (F.col("_t") < min_test)).select("species")
    # a species with many groups has all sides, so what is grouped here is small
    lacking = sizes.join(short, "species", "left_semi").select("species", "group_id", "split", "n")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = {g: [s, int(n)] for g, s, n in zip(pdf["group_id"], pdf["split"], pdf["n"])}
        out = []
        for side, target in (("val", min_val), ("test", min_test)):
            have = sum(n for s, n in rows.values() if s == side)
            if have >= target:
                continue
            for g in moves([(g, n) for g, (s, n) in rows.items() if s == "train"], target - have, min_train):
                rows[g][0] = side
                out.append((pdf["species"].iloc[0], g, side))
        return pd.DataFrame(out, columns=["species", "group_id", "split"])

    ship(sizes.sparkSession)
    return lacking.groupBy("species").applyInPandas(one, "species string, group_id string, split string")


def make_splits(records: DataFrame, t: int = 6, repaired: bool = True) -> DataFrame:
    """(seq, path, species, internal_plant_id, split, group_id, captive) of the kept records."""
    groups = assign_groups(records, t)
    rows = records.where("status = 'kept'").select("seq", "path", "species", "internal_plant_id", F.when(captive(), "1").otherwise("0").alias("captive")).join(groups, "seq").withColumn("split", split_of("group_id"))
    if repaired:
        moved = repair(rows.groupBy("species", "group_id", "split").agg(F.count("*").alias("n"))).withColumnRenamed("split", "_to")
        rows = rows.join(moved, ["species", "group_id"], "left").withColumn("split", F.coalesce("_to", "split")).drop("_to")
    return rows.select("seq", "path", "species", "internal_plant_id", "split", "group_id", "captive")


def split_counts(splits: DataFrame) -> DataFrame:
    return splits.groupBy("species").pivot("split", ["train", "val", "test"]).count().na.fill(0)


def choose_classes(splits: DataFrame, how_many: int, train: int, val: int, test: int) -> DataFrame:
    """The largest classes (internal_plant_id, n_train) that can fill every quota."""
    n = lambda s: F.count_if(F.col("split") == s)
    counts = splits.groupBy("internal_plant_id").agg(n("train").alias("n_train"), n("val").alias("n_val"), n("test").alias("n_test"))
    enough = counts.where((F.col("n_train") >= train) & (F.col("n_val") >= val) & (F.col("n_test") >= test))
    return enough.orderBy(F.desc("n_train"), "internal_plant_id").limit(how_many).select("internal_plant_id", "n_train")


def quota_sample(splits: DataFrame, quotas: dict[str, int], chosen: DataFrame, order: str = "path") -> DataFrame:
    """The first rows of each chosen class (internal_plant_id) and split, up to the quota of the split."""
    n = F.row_number().over(Window.partitionBy("internal_plant_id", "split").orderBy(order))
    quota = F.create_map(*[F.lit(x) for s, q in quotas.items() for x in (s, q)])
    most = max(quotas.values())
    return splits.join(chosen.select("internal_plant_id"), "internal_plant_id", "left_semi").withColumn("_n", n).where((F.col("_n") <= most) & (F.col("_n") <= F.try_element_at(quota, F.col("split")))).drop("_n")


def hash_range(key: Column) -> Column:
    """The range, 0 to 255, that the hash (32 hex digits) of a key lies in."""
    return F.conv(F.substring(key, 1, 2), 16, 10).cast("int")


def soft_cap(groups: DataFrame, cap: int, salt: str) -> DataFrame:
    """Groups (group_id, n) in hash order until their rows reach ``cap``; the last group may go over it.

    The running sum is computed in two levels over ranges of the hash, so the order of all groups is no single task.
    """
    rank = F.md5(F.concat(F.lit(salt + ":"), "group_id").cast("binary"))
    ranked = groups.select("group_id", "n", rank.alias("rank")).withColumn("part", hash_range(F.col("rank")))
    parts = ranked.groupBy("part").agg(F.sum("n").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    offsets = parts.select("part", before.alias("before"))  # 256 rows
    own = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("rank", "group_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    return ranked.withColumn("own", own).join(F.broadcast(offsets), "part").where(F.col("own") + F.col("before") < cap).select("group_id", "n")


def slices(splits: DataFrame, indoor: DataFrame, outdoor: DataFrame, cap: int, salt: str = "slice-1", other: DataFrame | None = None) -> DataFrame:
    """(slice, path, internal_plant_id, group_id, captive) of the test rows, for a frozen benchmark.

    multi: groups (not blank) of two pictures or more, whole. Of all other rows: indoor, captive pictures of the classes
    of ``indoor`` (class_id); outdoor, those of ``outdoor`` that are no indoor class; ood_plant, those of neither. ood_other are the
    files of ``other`` (path, folder), pictures of no plant, whose group is their folder. A slice of more than
    ``cap`` rows keeps whole groups, drawn in hash order until the cap is reached; a blank group is its own path.
    """
    rows = splits.where("split = 'test'").select("path", "internal_plant_id", "captive", F.coalesce("group_id", F.lit("")).alias("group_id")).distinct()
    sizes = rows.groupBy("group_id").agg(F.count("*").alias("n"))
    multi = sizes.where("n >= 2 AND group_id <> ''").select("group_id", F.lit(True).alias("_m"))
    side = lambda of, name: of.select(F.col("class_id").alias("internal_plant_id"), F.lit(True).alias(name)).distinct()
    rows = rows.join(multi, "group_id", "left").join(side(indoor, "_i"), "internal_plant_id", "left").join(side(outdoor, "_o"), "internal_plant_id", "left")
    kind = F.when(F.col("_m"), "multi").when(F.col("_i") & (F.col("captive") == "1"), "indoor").when(F.col("_o") & F.col("_i").isNull(), "outdoor").when(F.col("_i").isNull() & F.col("_o").isNull(), "ood_plant")
    rows = rows.withColumn("slice", kind).where("slice IS NOT NULL").withColumn("_g", F.when(F.col("group_id") != "", F.col("group_id")).otherwise(F.col("path")))
    columns = ["slice", "path", "internal_plant_id", "group_id", "captive", "_g"]
    rows, out = rows.select(columns), None
    if other is not None:
        rows = rows.unionByName(other.select(F.lit("ood_other").alias("slice"), "path", F.lit("").alias("internal_plant_id"), F.col("folder").alias("group_id"), F.lit("0").alias("captive"), F.col("folder").alias("_g")))
    for name in ("multi", "indoor", "outdoor", "ood_plant", *(["ood_other"] if other is not None else [])):
        part = rows.where(F.col("slice") == name)
        drawn = soft_cap(part.groupBy(F.col("_g").alias("group_id")).agg(F.count("*").alias("n")), cap, f"{salt}-{name}").select(F.col("group_id").alias("_g"))
        one = part.join(drawn, "_g", "left_semi").select("slice", "path", "internal_plant_id", "group_id", "captive")
        out = one if out is None else out.unionByName(one)
    return out


def running_quota(candidates: DataFrame, key: str, order: str, ok: Column, quota: Column) -> DataFrame:
    """Candidates taken while their key's successes before them stay below the quota."""
    before = F.coalesce(F.sum(ok.cast("long")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    return candidates.withColumn("_before", before).where(F.col("_before") < quota).drop("_before")


def round_robin(df: DataFrame, order: list[str], shards: int) -> DataFrame:
    """df with its shard by rank: row i goes to shard i mod shards. The order is global, so this is for catalogues."""
    n = F.row_number().over(Window.orderBy(*order))
    return df.withColumn("shard", F.pmod(n - 1, F.lit(shards)))


def replay_sample(n: int, k: int, seed: int) -> Iterator[int]:
    """The positions that a seeded sample of k of n takes, for joining on a row number."""
    import random

    yield from random.Random(seed).sample(range(n), k)
