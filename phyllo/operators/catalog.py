"""The catalogue of plants: matching, new candidates, groups, bands and gains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phyllo.functions.names import canonical_name, id_variants, internal_id, without_cross

SMALL = 50_000
#: Words of categories to visit first, in this order, and of those not to visit. Fixed values.
PREFERRED = ["potted", "in pots", "indoor", "houseplant", "cultivars", "cultivated", "in gardens", "garden"]
REFUSED = ["illustration", "herbarium", "specimen", "products", "stamps", "coins", "maps", "diagram", "seeds", "wood", "timber"]


def maybe_broadcast(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df with a broadcast hint if it has no more than ``most`` rows; beyond that the join is left to the optimizer."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def match_to_catalog(asked: DataFrame, plants: DataFrame, key: str, name: str) -> DataFrame:
    """(key, internal_id) of every asked name: by canonical name, else by synonym; null if the catalogue has neither.

    Of plants of one canonical name the last id wins, of plants of one synonym the first.
    """
    own = plants.select("internal_id", canonical_name("scientific_name").alias("name")).where("name <> ''").groupBy("name").agg(F.max("internal_id").alias("by_name"))
    syn = plants.select("internal_id", F.explode(F.split("synonyms", r"\|")).alias("s")).select("internal_id", canonical_name("s").alias("name")).where("name <> ''")
    syn = syn.groupBy("name").agg(F.min("internal_id").alias("by_synonym"))
    rows = asked.select(key, canonical_name(name).alias("name"))
    return rows.join(maybe_broadcast(own), "name", "left").join(maybe_broadcast(syn), "name", "left").select(key, F.coalesce("by_name", "by_synonym").alias("internal_id"))


def alias_pairs(plants: DataFrame) -> DataFrame:
    """(alias, internal_id, p): every id a plant goes by: its own, its synonyms' (separated by | ; or ,), its name's."""
    parts = F.concat(
        F.array(F.struct(F.lit(0).alias("p"), F.col("internal_id").alias("alias"))),
        F.transform(F.split(F.coalesce("synonyms", F.lit("")), "[|;,]"), lambda s: F.struct(F.lit(1).alias("p"), internal_id(s).alias("alias"))),
        F.array(F.struct(F.lit(2).alias("p"), internal_id("scientific_name").alias("alias"))),
    )
    return plants.select("internal_id", F.inline(parts)).where("alias <> ''").select("alias", "internal_id", "p")


def alias_map(plants: DataFrame) -> DataFrame:
    """(alias, internal_id): of the plants that go by an alias the first by id."""
    return alias_pairs(plants).groupBy("alias").agg(F.min(F.struct("internal_id", "p")).alias("x")).select("alias", F.col("x.internal_id").alias("internal_id"))


def resolve_labels(names: DataFrame, labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, id, label, how): each name directly, through an alias, or as the hybrid of its genus; null label if none.

    aliases (alias, internal_id): an alias may belong to several plants, of which the first by id that is a label counts.
    """
    asked = names.select("name", internal_id("name").alias("id"))
    parts = F.split("id", "-")
    crossed = F.when(F.size(parts) == 2, F.concat(parts[0], F.lit("-x-"), parts[1]))
    own = labels.select(F.col("class_id").alias("label"))
    direct = asked.join(own.withColumnRenamed("label", "l0"), F.col("id") == F.col("l0"), "left")
    named = aliases.join(own.withColumnRenamed("label", "internal_id"), "internal_id").groupBy("alias").agg(F.min("internal_id").alias("l1"))
    via = direct.join(named, F.col("id") == F.col("alias"), "left")
    hybrid = via.withColumn("c", crossed).join(own.withColumnRenamed("label", "l2"), F.col("c") == F.col("l2"), "left")
    how = F.when(F.col("l0").isNotNull(), "direct").when(F.col("l1").isNotNull(), "synonym").when(F.col("l2").isNotNull(), "hybrid")
    return hybrid.select("name", "id", F.coalesce("l0", "l1", "l2").alias("label"), how.alias("how"))


def keep_new(candidates: DataFrame, known: DataFrame, id_: str, order: str) -> DataFrame:
    """Candidates of which no variant (with or without x) is known, and of equal variants the first only.

    Rows that are known never stand in the way of later ones: the anti join comes first. Variant sets meet exactly where
    the ids without x are equal, so the second step is one window.
    """
    spread = candidates.select(F.col(id_), F.explode(id_variants(id_)).alias("_v")).join(known.select(F.col("id").alias("_v")), "_v", "left_semi").select(id_).distinct()
    crossed = known.select(without_cross("id").alias("_w")).distinct()
    fresh = candidates.join(spread, id_, "left_anti").withColumn("_w", without_cross(id_)).join(crossed, "_w", "left_anti")
    return fresh.withColumn("_n", F.row_number().over(Window.partitionBy("_w").orderBy(order, id_))).where("_n = 1").drop("_n", "_w")


#: Ranks that make a class. Fixed values.
CLASS_RANKS = ["species", "hybrid"]


def of_class_rank(rows: DataFrame, rank: str = "rank") -> DataFrame:
    """The rows whose rank makes a class: species and hybrids, as the service writes them."""
    return rows.where(F.col(rank).isin(*CLASS_RANKS))


def selected(plants: DataFrame, order: str, only: list[str] | None = None, listed: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """The plants that are named by ``only`` or in ``listed`` (value), whatever the case, all if neither is given; then the
    first ``limit`` of them by ``order``."""
    asked = None
    if only:
        asked = plants.sparkSession.createDataFrame([(x,) for x in only], "value string")
    if listed is not None:
        asked = listed.select("value") if asked is None else asked.unionByName(listed.select("value"))
    if asked is not None:
        key = F.lower(F.trim("scientific_name"))
        plants = plants.withColumn("_k", key).join(asked.select(F.lower(F.trim("value")).alias("_k")).distinct(), "_k", "left_semi").drop("_k")
    return plants.orderBy(order).limit(limit) if limit else plants


def surplus(groups: DataFrame) -> DataFrame:
    """One row: the groups (members) and how many classes are too many if each group is one class."""
    return groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.size("members") - 1), F.lit(0).cast("long")).alias("too_many"))


def shortened(rows: DataFrame, value: str, most: int) -> DataFrame:
    """One row: the first ``most`` values in their order, joined by commas, and how many more there are."""
    first = rows.select(value).orderBy(value).limit(most).agg(F.array_join(F.array_sort(F.collect_list(value)), ", ").alias("shown"))
    n = rows.agg(F.count(value).alias("n"))
    return first.withColumn("_k", F.lit(0)).join(n.withColumn("_k", F.lit(0)), "_k").select("shown", F.greatest(F.col("n") - most, F.lit(0).cast("long")).alias("more"))


def first_existing(asked: DataFrame, names: Column, existing: DataFrame) -> DataFrame:
    """asked (id, ...) with the first of its names (an array) that exists (existing.name); null where none does."""
    spread = asked.select("id", F.posexplode(names).alias("pos", "name")).join(existing.select("name").distinct(), "name", "left_semi")
    found = spread.groupBy("id").agg(F.min_by("name", "pos").alias("name"))
    return asked.select("id").join(found, "id", "left")


def register(existing: DataFrame, candidates: DataFrame, order: str) -> DataFrame:
    """Candidates (name) that are new plants by id, the first of each."""
    own = candidates.withColumn("internal_id", internal_id("name")).join(existing.select("internal_id"), "internal_id", "left_anti")
    return own.withColumn("_n", F.row_number().over(Window.partitionBy("internal_id").orderBy(order))).where("_n = 1").drop("_n")


def same_key_groups(rows: DataFrame, key: str, member: str) -> DataFrame:
    """(key, members sorted) of keys with more than one member; a null key never groups."""
    out = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(member)).alias("members"))
    return out.where(F.size("members") > 1)


def distinct_members(rows: DataFrame, key: str, member: str) -> DataFrame:
    return rows.where(F.coalesce(F.col(member), F.lit("")) != "").groupBy(key).agg(F.array_sort(F.collect_set(member)).alias("members"))


def counts_per_plant(plants: DataFrame, records: DataFrame) -> DataFrame:
    """(internal_id, n) of all plants; 0 where there is no kept record."""
    n = records.where("status = 'kept'").groupBy(F.col("internal_plant_id").alias("internal_id")).agg(F.count("*").alias("n"))
    return plants.select("internal_id").join(n, "internal_id", "left").select("internal_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def band(n: Column, threshold: int) -> Column:
    return F.when(n < 0, "unresolved").when(n == 0, "empty").when(n < threshold, "thin").otherwise("solid")


def verdict(counts: DataFrame, threshold: int) -> DataFrame:
    """(band, n, median): how many plants are in each band, and the median of the solid ones."""
    n = F.col("n")
    return counts.groupBy(band(n, threshold).alias("band")).agg(F.count("*").alias("n"), F.median(F.when(n >= threshold, n)).alias("median"))


def gain(offered: DataFrame, already: DataFrame, thin: int) -> DataFrame:
    """One row: species, known, total, median of the known, thin ones, and those that would at least double."""
    rows = offered.select("species", F.col("n").alias("o")).join(already.select("species", F.col("n").alias("a")), "species", "left")
    o, a = F.col("o"), F.col("a")
    return rows.agg(F.count("*").alias("species"), F.count_if(o > 0).alias("known"), F.sum("o").alias("total"), F.median(F.when(o > 0, o)).alias("median"), F.count_if((o > 0) & (o < thin)).alias("thin"), F.count_if((a > 0) & (o >= a)).alias("doubled"))


def compare_sets(a: DataFrame, b: DataFrame, only_a: str, only_b: str, both: str) -> DataFrame:
    """(id, kind) of all ids of two tables."""
    rows = a.select("id").distinct().withColumn("_a", F.lit(1)).join(b.select("id").distinct().withColumn("_b", F.lit(1)), "id", "full_outer")
    return rows.select("id", F.when(F.col("_b").isNull(), only_a).when(F.col("_a").isNull(), only_b).otherwise(both).alias("kind"))


def ranked_categories(names: DataFrame, limit: int = 6, preferred: list[str] | None = None, refused: list[str] | None = None) -> DataFrame:
    """Names (name, pos) without a refused word, those with a preferred word first (in the order of the words), capped."""
    low, words = F.lower("name"), PREFERRED if preferred is None else preferred
    has = lambda w: F.contains(low, F.lit(w))
    rank, bad = F.lit(len(words)), F.lit(False)
    for i in reversed(range(len(words))):
        rank = F.when(has(words[i]), i).otherwise(rank)
    for w in REFUSED if refused is None else refused:
        bad = bad | has(w)
    return names.where(~bad).orderBy(rank, "pos").limit(limit)
