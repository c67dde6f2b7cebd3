"""Readings of class probabilities: one row an image, ``p`` an array of doubles, ``truth`` the index of its class.

Everything that concerns one image is an array expression inside the scan's stage; only counts are shuffled. Parameter
grids are exploded from literals beside each row and aggregated map-side, so a grid costs no pass of its own. Ties go to
the lower class index. Comparisons are made on doubles, unrounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: So many photos of one group are held at a time.
PHOTOS = 1024


def ranked(p: Column | str, k: int | None = None) -> Column:
    """array of struct(neg, i): classes by falling probability, the k best of them."""
    p = F.col(p) if isinstance(p, str) else p
    out = F.array_sort(F.transform(p, lambda x, i: F.struct((-x).alias("neg"), i.alias("i"))))
    return out if k is None else F.slice(out, 1, k)


def softmax(v: Column) -> Column:
    e = F.transform(v, lambda x: F.exp(x.cast("double")))
    return F.transform(F.array(e), lambda a: F.transform(a, lambda x: x / F.aggregate(a, F.lit(0.0), lambda s, y: s + y)))[0]


def read(df: DataFrame, p: str = "p", keep: tuple[str, ...] = ()) -> DataFrame:
    """truth, captive, the kept columns, and best, second (probabilities), guess (index), right, in_top3."""
    t = df.select("truth", "captive", *keep, ranked(p, 3).alias("_t"))
    second = F.coalesce(-F.try_element_at("_t", F.lit(2))["neg"], F.lit(0.0))
    out = t.select("truth", "captive", *keep, (-F.col("_t")[0]["neg"]).alias("best"), second.alias("second"), F.col("_t")[0]["i"].alias("guess"), F.exists("_t", lambda x: x["i"] == F.col("truth")).alias("in_top3"))
    return out.withColumn("right", F.col("guess") == F.col("truth"))


def masked(p: Column | str, kept: list[int], renormalise: bool = False) -> Column:
    """p with 0 for classes out of ``kept`` (zeros stay in place); optionally divided by what is left, if that is not 0."""
    p = F.col(p) if isinstance(p, str) else p
    zeroed = F.transform(p, lambda x, i: F.when(i.isin(*kept), x).otherwise(0.0))
    if not renormalise:
        return zeroed
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, y: s + y)
    return F.transform(F.array(zeroed), lambda a: F.when(total(a) > 0, F.transform(a, lambda x: x / total(a))).otherwise(a))[0]


def context_mask(p: Column | str, kept: list[int], least: float = 1e-6) -> Column:
    """masked and renormalised, but unchanged where hardly any mass is left."""
    p = F.col(p) if isinstance(p, str) else p
    mass = F.aggregate(F.filter(p, lambda x, i: i.isin(*kept)), F.lit(0.0), lambda s, y: s + y)
    return F.when(mass < least, p).otherwise(masked(p, kept, True))


def truncated(p: Column | str, k: int) -> Column:
    """The k best kept, the others 0; unchanged for k <= 0 or k >= the number of classes."""
    p = F.col(p) if isinstance(p, str) else p
    if k <= 0:
        return p
    best = F.transform(ranked(p, k), lambda x: x["i"])
    return F.when(F.size(p) <= k, p).otherwise(F.transform(p, lambda x, i: F.when(F.array_contains(best, i), x).otherwise(0.0)))


def group_mass(p: Column | str, groups: list[int]) -> Column:
    """Probability mass of each group, by group number; groups[i] is the group of class i."""
    p = F.col(p) if isinstance(p, str) else p
    # classes in the order of their groups, and where each group lies in it: two literals, whatever the number of classes
    order = sorted(range(len(groups)), key=lambda i: (groups[i], i))
    n = max(groups) + 1
    sizes = [groups.count(k) for k in range(n)]
    starts = [sum(sizes[:k]) for k in range(n)]
    ints = lambda xs: F.expr(f"array({', '.join(map(str, xs))})")
    total = lambda own: F.aggregate(own, F.lit(0.0), lambda x, y: x + y)
    sorted_p = F.transform(ints(order), lambda i: p[i])
    return F.transform(F.array(sorted_p), lambda q: F.transform(F.arrays_zip(ints(starts).alias("at"), ints(sizes).alias("size")), lambda g: total(F.slice(q, g["at"] + 1, g["size"]))))[0]


def accuracy(readings: DataFrame, by: list[str] | None = None) -> DataFrame:
    count = lambda c: F.count_if(c)
    return readings.groupBy(*(by or [])).agg(F.count("*").alias("images"), count("right").alias("top1"), count("in_top3").alias("top3"), F.avg("best").alias("confidence"))


def accepted(readings: DataFrame, thresholds: list[float], margins: list[float], by: list[str] | None = None) -> DataFrame:
    """(threshold, margin, images, accepted, right) of the whole grid, in one pass."""
    grid = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(m).alias("margin")) for t in thresholds for m in margins])).alias("g")
    ok = (F.col("best") >= F.col("g.threshold")) & (F.col("best") - F.col("second") >= F.col("g.margin"))
    rows = readings.select(*(by or []), "best", "second", "right", grid)
    return rows.groupBy(*(by or []), F.col("g.threshold").alias("threshold"), F.col("g.margin").alias("margin")).agg(F.count("*").alias("images"), F.count_if(ok).alias("accepted"), F.count_if(ok & F.col("right")).alias("right"))


def tally(readings: DataFrame, threshold: float) -> DataFrame:
    """One row: images, top1, top3, accepted, and right among the accepted."""
    ok = F.col("best") >= threshold
    return readings.agg(F.count("*").alias("images"), F.count_if("right").alias("top1"), F.count_if("in_top3").alias("top3"), F.count_if(ok).alias("accepted"), F.count_if(ok & F.col("right")).alias("right"))


def per_class(readings: DataFrame) -> DataFrame:
    """(class, support, predicted, hits) of every class that is a truth or an answer."""
    both = F.explode(F.array(F.struct(F.col("truth").cast("int").alias("c"), F.lit(1).alias("s"), F.lit(0).alias("q")), F.struct(F.col("guess").cast("int").alias("c"), F.lit(0).alias("s"), F.lit(1).alias("q")))).alias("x")
    rows = readings.select(both, "right")
    return rows.groupBy(F.col("x.c").alias("class")).agg(F.sum("x.s").alias("support"), F.sum("x.q").alias("predicted"), F.sum(F.when(F.col("right"), F.col("x.s")).otherwise(0)).alias("hits"))


def macro_f1(readings: DataFrame) -> DataFrame:
    """One row: the mean F1 of the classes with support (0 where nothing was hit)."""
    f1 = F.when(F.col("hits") == 0, 0.0).otherwise(2.0 * F.col("hits") / (F.col("support") + F.col("predicted")))
    return per_class(readings).where("support > 0").agg(F.count("*").alias("classes"), F.avg(f1).alias("macro_f1"))


def class_weights(classes: DataFrame, counts: DataFrame) -> DataFrame:
    """(class, weight): total / (classes * max(1, count)) of every class, also of those that never occur."""
    rows = classes.join(counts, "class", "left").select("class", F.coalesce("n", F.lit(0)).alias("n"))
    total, k = rows.agg(F.sum("n").alias("x")).scalar(), rows.agg(F.count("*").alias("x")).scalar()
    return rows.select("class", (total / (k * F.greatest(F.col("n"), F.lit(1)))).alias("weight"))


def confusion(readings: DataFrame, genus: Column, family: Column, genus_guess: Column, family_guess: Column) -> DataFrame:
    """(level, images): right, within_genus, same_family, outside_family."""
    level = F.when(F.col("right"), "right").when(genus == genus_guess, "within_genus").when(family == family_guess, "same_family").otherwise("outside_family")
    return readings.groupBy(level.alias("level")).agg(F.count("*").alias("images"))


def between(readings: DataFrame, a: Column, b: Column) -> DataFrame:
    """Directed counts of errors that cross from one group to another."""
    return readings.where(~F.col("right")).select(a.alias("a"), b.alias("b")).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("images"))


def taxa(classes: DataFrame, plants: DataFrame) -> DataFrame:
    """classes (class_id) with genus and family, in lower case, as the catalogue (internal_id, scientific_name, family) has them.

    A class that is not listed has the genus that its id begins with, and a family of its own ('?' and the id), which is
    never equal to another. Of repeated ids in the catalogue the smallest values are taken.
    """
    name, own = F.trim("scientific_name"), F.lower(F.trim("family"))
    known = plants.where("internal_id IS NOT NULL").groupBy(F.col("internal_id").alias("class_id")).agg(F.min(F.when(name != "", F.lower(F.split(name, r"\s+")[0]))).alias("_g"), F.min(own).alias("_f"))
    rows = classes.join(known, "class_id", "left")
    return rows.withColumns({"genus": F.coalesce("_g", F.split("class_id", "-")[0]), "family": F.coalesce("_f", F.concat(F.lit("?"), "class_id"))}).drop("_g", "_f")


def by_chance(classes: DataFrame) -> DataFrame:
    """One row: how often an error would stay within genus and family by chance; classes (class, genus, family).

    beyond: how often it would leave the family; alone: classes without another of their genus. With fewer than two
    classes there is no error, and all shares and ``alone`` are 0.
    """
    g = F.count("*").over(Window.partitionBy("genus"))
    f = F.count("*").over(Window.partitionBy("family"))
    n = F.count("*")
    rows = classes.withColumn("_g", g).withColumn("_f", f)
    pairs = F.nullif(n * (n - 1), F.lit(0))
    share = lambda x: F.coalesce(F.sum(x) / pairs, F.lit(0.0))
    out = rows.agg(n.alias("classes"), share(F.col("_g") - 1).alias("genus"), share(F.col("_f") - F.col("_g")).alias("family"), F.count_if(F.col("_g") == 1).alias("alone"))
    rest = 1.0 - F.col("genus") - F.col("family")
    some = F.col("classes") >= 2
    return out.select("classes", "genus", "family", F.when(some & (rest > 1e-12), rest).otherwise(0.0).alias("beyond"), F.when(some, F.col("alone")).otherwise(0).alias("alone"))


def genus_sizes(classes: DataFrame) -> DataFrame:
    """One row: classes, genera, genera of a single class, and the size of the richest; classes (class, genus)."""
    sizes = classes.groupBy("genus").agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    return sizes.agg(F.coalesce(F.sum("n"), zero).alias("classes"), F.count("*").alias("genera"), F.count_if(F.col("n") == 1).alias("lone"), F.coalesce(F.max("n"), zero).alias("richest"))


def shared_genus_share(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """One row: images, and those of a class whose genus holds several; rows (class), classes (class, genus)."""
    sizes = classes.groupBy("genus").agg(F.count("*").alias("n"))
    known = rows.join(classes.join(sizes, "genus").select("class", "n"), "class")
    return known.agg(F.count("*").alias("images"), F.count_if(F.col("n") > 1).alias("of_several"))


def rates(readings: DataFrame, minimum: int = 5) -> DataFrame:
    """(truth, seen, missed) of classes seen often enough to be measured."""
    out = readings.groupBy("truth").agg(F.count("*").alias("seen"), F.count_if(~F.col("right")).alias("missed"))
    return out.where(F.col("seen") >= minimum)


def weakness(readings: DataFrame, minimum: int = 5) -> DataFrame:
    """One row: measurable classes, those never right, under a quarter and under half (nested)."""
    rate = (F.col("seen") - F.col("missed")) / F.col("seen")
    return rates(readings, minimum).agg(F.count("*").alias("measurable"), F.count_if(rate == 0).alias("zero"), F.count_if(rate < 0.25).alias("under_25"), F.count_if(rate < 0.5).alias("under_50"))


def struggling(readings: DataFrame, minimum: int, limit: int) -> DataFrame:
    """The worst classes with their commonest wrong answer."""
    wrong = readings.where(~F.col("right")).groupBy("truth", "guess").agg(F.count("*").alias("n"))
    most = wrong.withColumn("_r", F.row_number().over(Window.partitionBy("truth").orderBy(F.desc("n"), "guess"))).where("_r = 1").select("truth", F.col("guess").alias("mostly"), F.col("n").alias("times"))
    worst = rates(readings, minimum).join(most, "truth").withColumn("rate", F.col("missed") / F.col("seen"))
    return worst.orderBy(F.desc("rate"), F.desc("seen"), "truth").limit(limit).drop("rate")


def answer(p: str, mass: Column | str, threshold: float, group_threshold: float | None = None) -> Column:
    """struct(kind, i): the species if it is sure enough, else the group of most mass, else nothing."""
    top = ranked(p, 1)[0]
    best_group = ranked(mass, 1)[0]
    sure, group_sure = -top["neg"] >= threshold, -best_group["neg"] >= (threshold if group_threshold is None else group_threshold)
    made = lambda kind, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"))
    return F.when(sure, made("species", top["i"])).when(group_sure, made("genus", best_group["i"])).otherwise(made("nothing", F.lit(-1)))


def genus_measure(df: DataFrame, groups: list[int], threshold: float, top: int = 0) -> DataFrame:
    """One row: how often the species, else the genus, else nothing is answered, and how often that is right.

    Rates are shares of all images; autonomy is that of answers of either kind; precisions are null where nothing was
    answered. top: the mass of genera counts the best classes only.
    """
    mass = group_mass(truncated("p", top), groups)
    own = F.element_at(F.array(*[F.lit(g) for g in groups]), F.col("truth") + 1)
    a = df.select("truth", own.alias("g"), answer("p", mass, threshold).alias("a"))
    kind, i = F.col("a.kind"), F.col("a.i")
    counts = a.agg(
        F.count("*").alias("images"), F.count_if(kind == "species").alias("s"), F.count_if((kind == "species") & (i == F.col("truth"))).alias("sr"),
        F.count_if(kind == "genus").alias("g"), F.count_if((kind == "genus") & (i == F.col("g"))).alias("gr"),
    )
    share = lambda x, y: F.when(y > 0, x / y)
    c = F.col
    return counts.select(
        "images", share(c("s"), c("images")).alias("species_rate"), share(c("sr"), c("s")).alias("species_precision"), share(c("g"), c("images")).alias("genus_rate"), share(c("gr"), c("g")).alias("genus_precision"),
        share(c("s") + c("g"), c("images")).alias("autonomy"), share(c("sr") + c("gr"), c("s") + c("g")).alias("precision"),
    )


def tallies(df: DataFrame, by: list[str], threshold: Column | float) -> DataFrame:
    """(by ..., images, top1, top3, accepted, right) of rows that carry their reading's ``p``; threshold may be a column."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    t = df.select(*by, "truth", limit.alias("_limit"), ranked("p", 3).alias("_t"))
    best, right = -F.col("_t")[0]["neg"], F.col("_t")[0]["i"] == F.col("truth")
    ok = best >= F.col("_limit")
    return t.groupBy(*by).agg(F.count("*").alias("images"), F.count_if(right).alias("top1"), F.count_if(F.exists("_t", lambda x: x["i"] == F.col("truth"))).alias("top3"), F.count_if(ok).alias("accepted"), F.count_if(ok & right).alias("right"))


def compare(outputs: DataFrame, labels: dict[str, list[int]], thresholds: list[float], threshold: float = 0.70) -> DataFrame:
    """(ground, model, reading, threshold, images, top1, top3, accepted, right) of two models over the classes both know.

    outputs (model, image_id, truth, captive, p): one row an image and model; labels: the classes of each model. Grounds: the
    images of common classes, and of those the captive ones. Readings: masked to the common classes, full, and masked and
    renormalised at each of ``thresholds``. Besides, under the ground 'gained', the second model alone (full) over the
    classes that it adds. Both models are read in one pass, readings and grounds are exploded beside each row.
    """
    a, b = labels
    shared, gained = sorted(set(labels[a]) & set(labels[b])), sorted(set(labels[b]) - set(labels[a]))
    truth = F.col("truth")
    grounds = F.array_compact(F.array(
        F.when(truth.isin(*shared), F.lit("common")), F.when(truth.isin(*shared) & F.col("captive"), F.lit("captive")), F.when(truth.isin(*gained) & (F.col("model") == b), F.lit("gained")),
    ))
    readings = F.array(F.lit("masked"), F.lit("full"), F.lit("renormalised"))
    rows = outputs.select("model", "truth", "p", F.explode(grounds).alias("ground")).select("*", F.explode(readings).alias("reading")).where("ground <> 'gained' OR reading = 'full'")
    p = F.when(F.col("reading") == "full", F.col("p")).when(F.col("reading") == "masked", masked("p", shared)).otherwise(masked("p", shared, True))
    limits = F.explode(F.when(F.col("reading") == "renormalised", F.array(*[F.lit(t) for t in thresholds])).otherwise(F.array(F.lit(threshold)))).alias("threshold")
    return tallies(rows.select("ground", "model", "reading", "truth", p.alias("p"), limits), ["ground", "model", "reading", "threshold"], F.col("threshold"))


def cost_table(df: DataFrame, sets: dict[int, list[int]], core: list[int], threshold: float) -> DataFrame:
    """(photos, exposed, part, images, top1, top3, accepted, right): what more exposed classes cost the core, and add.

    sets: the exposed classes by size; part 'core' are the images of core classes, 'added' those of the others exposed;
    photos are 'all' and of them 'captive'. Outputs are masked to the exposed classes and renormalised.
    """
    parts = []
    for n, kept in sorted(sets.items()):
        part = F.when(F.col("truth").isin(*core), "core").when(F.col("truth").isin(*kept), "added")
        parts.append(F.named_struct(F.lit("exposed"), F.lit(n), F.lit("part"), part, F.lit("p"), masked("p", kept, True)))
    photos = F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("captive"), F.lit("captive"))))).alias("photos")
    rows = df.select("truth", photos, F.explode(F.array(*parts)).alias("x")).select("truth", "photos", "x.*").where("part IS NOT NULL")
    return tallies(rows, ["photos", "exposed", "part"], threshold)


def restricted_reading(df: DataFrame, kept: list[int], threshold: float) -> DataFrame:
    """(reading, images, top1, top3, accepted, right) of a catalogue restricted to ``kept``.

    whole and restricted (masked and renormalised) over its images, captive: whole over its captive ones, and rest: whole
    over all other images.
    """
    inside = F.col("truth").isin(*kept)
    own = F.array(F.struct(F.lit("whole").alias("reading"), F.col("p").alias("p")), F.struct(F.lit("restricted").alias("reading"), masked("p", kept, True).alias("p")))
    potted = F.when(F.col("captive"), F.array(F.struct(F.lit("captive").alias("reading"), F.col("p").alias("p"))))
    rest = F.array(F.struct(F.lit("rest").alias("reading"), F.col("p").alias("p")))
    rows = df.select("truth", F.inline(F.when(inside, F.concat(own, F.coalesce(potted, F.slice(own, 1, 0)))).otherwise(rest)))
    return tallies(rows, ["reading"], threshold)


def most_asserted(readings: DataFrame, id_: str, limit: int) -> DataFrame:
    """The images that are named most surely, with the name and the runner-up's probability."""
    return readings.select(id_, "guess", "best", "second").orderBy(F.desc("best"), id_).limit(limit)


def combine(df: DataFrame, group: str, geometric: bool = False, photos: int | None = None, order: str = "image_id") -> DataFrame:
    """One row a group: the mean (or the geometric mean) of its photos' probabilities; optionally of its first ones."""
    at = F.row_number().over(Window.partitionBy(group).orderBy(order))
    df = df.select(group, order, "truth", "captive", "p").withColumn("_n", at)
    if photos is not None:
        df = df.withColumn("_c", F.count("*").over(Window.partitionBy(group))).where((F.col("_n") <= photos) & (F.col("_c") >= photos))
    x = F.transform("p", lambda v: F.log(F.greatest(v, F.lit(1e-9)))) if geometric else F.col("p")
    add = lambda of: F.aggregate(F.slice(of, 2, PHOTOS), F.col(of)[0], lambda s, p: F.zip_with(s, p, lambda u, v: u + v))
    # arrays are added place by place, PHOTOS at a time; the window has brought each group together, so nothing is shuffled again
    own = df.select(group, "truth", "captive", x.alias("_x"), F.expr(f"(_n - 1) div {PHOTOS}").alias("_part"))
    some = own.groupBy(group, "_part").agg(F.min("truth").alias("truth"), F.max("captive").alias("captive"), F.count("*").alias("_k"), F.collect_list("_x").alias("_all"))
    some = some.select(group, "truth", "captive", "_k", add("_all").alias("_sum"))
    g = some.groupBy(group).agg(F.min("truth").alias("truth"), F.max("captive").alias("captive"), F.sum("_k").alias("_k"), F.collect_list("_sum").alias("_all"))
    total = F.aggregate("_all", F.transform(F.col("_all")[0], lambda _: F.lit(0.0)), lambda s, p: F.zip_with(s, p, lambda u, v: u + v))
    mean = F.transform(total, lambda v: F.exp(v / F.col("_k")) if geometric else v / F.col("_k"))
    return g.select(group, "truth", "captive", mean.alias("p"))


def like_app(df: DataFrame, group: str, top_k: int, cut: float) -> DataFrame:
    """One row a group, as a device that sees only short lists combines its photos.

    Of each photo the top_k classes of at least ``cut`` are known, the others stand at its floor (its last known value, but
    no more than cut; cut if it has none). Over the classes known to any photo: geometric mean, scaled to the mean covered
    mass, within 0 and 1. One photo alone stays as it is; where no class is known all are 0.
    """
    known = F.filter(ranked("p", top_k), lambda x: -x["neg"] >= cut)
    floor = F.when(F.size(known) > 0, F.least(-F.element_at(known, -1)["neg"], F.lit(cut))).otherwise(F.lit(cut))
    rows = df.select(group, "truth", "captive", "p", F.map_from_entries(F.transform(known, lambda x: F.struct(x["i"], -x["neg"]))).alias("known"), floor.alias("floor"))
    photos = F.collect_list(F.struct("known", "floor", "p"))
    g = rows.groupBy(group).agg(F.min("truth").alias("truth"), F.max("captive").alias("captive"), photos.alias("photos"))
    ids = F.array_distinct(F.flatten(F.transform("photos", lambda x: F.map_keys(x["known"]))))
    n = F.size(F.col("photos")[0]["p"])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, y: s + y)
    logs = lambda i: total(F.transform("photos", lambda x: F.log(F.greatest(F.coalesce(F.try_element_at(x["known"], i), x["floor"]), F.lit(1e-9))))) / F.size("photos")
    g = g.withColumn("ids", ids).withColumn("raw", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(F.array_contains("ids", i), F.exp(logs(i))).otherwise(0.0)))
    covered = total(F.transform("photos", lambda x: total(F.map_values(x["known"])))) / F.size("photos")
    g = g.withColumn("cov", covered).withColumn("sum", total(F.col("raw")))
    scaled = F.transform("raw", lambda x: F.when(F.col("sum") > 0, F.least(F.greatest(x * F.col("cov") / F.col("sum"), F.lit(0.0)), F.lit(1.0))).otherwise(0.0))
    return g.select(group, "truth", "captive", F.when(F.size("photos") == 1, F.col("photos")[0]["p"]).otherwise(scaled).alias("p"))


def nested_sets(classes: DataFrame, sizes: list[int]) -> DataFrame:
    """(size, class): growing sets of classes (class, tier, prio); the core (tier 0) is in all of them.

    Classes are ranked in one task: they are the labels of a model.
    """
    rank = F.row_number().over(Window.orderBy("tier", "prio", "class"))
    ranked_rows = classes.withColumn("rank", rank)
    core = ranked_rows.agg(F.count_if(F.col("tier") == 0).alias("n"), F.count("*").alias("m")).first()
    real = sorted({min(max(s, core["n"]), core["m"]) for s in sizes})
    return ranked_rows.select("class", "rank", F.explode(F.array(*[F.lit(s) for s in real])).alias("size")).where("rank <= size").select("size", "class")


def theft_costs(df: DataFrame, core: list[int], candidates: list[int]) -> DataFrame:
    """(candidate, cost): images right among the core that a candidate class would take, strictly above the truth."""
    own = df.select("truth", "p", ranked(masked("p", core), 1)[0]["i"].alias("guess")).where(F.col("truth").isin(*core) & (F.col("guess") == F.col("truth")))
    rows = own.select(F.explode(F.array(*[F.struct(F.lit(c).alias("candidate"), (F.col("p")[c] > F.get("p", F.col("truth"))).cast("int").alias("taken")) for c in candidates])).alias("x"))
    return rows.groupBy(F.col("x.candidate").alias("candidate")).agg(F.sum("x.taken").alias("cost"))


def by_theft(costs: DataFrame, priority: dict[int, int]) -> DataFrame:
    """Candidates with their rank: by cost, then by priority (unknown last), then by class; candidates are classes, a list of one task."""
    own = costs.sparkSession.createDataFrame(list(priority.items()), "candidate int, _prio int")
    rows = costs.join(own, "candidate", "left").withColumn("_prio", F.coalesce("_prio", F.lit(len(priority))))
    return rows.withColumn("rank", F.row_number().over(Window.orderBy("cost", "_prio", "candidate"))).drop("_prio")


def off_topic(readings: DataFrame, folder: str) -> DataFrame:
    """(folder or null for all, band, n, top): how surely images of no known class are named; with the upper median."""
    band = F.when(F.col("best") < 0.10, "silent").when(F.col("best") < 0.70, "uncertain").otherwise("asserted").alias("band")
    rows = readings.select(F.col(folder).alias("folder"), "best", band)
    return rows.groupingSets([["folder", "band"], ["band"]], "folder", "band").agg(F.count("*").alias("n"), F.max("best").alias("top"), F.grouping("folder").alias("whole"))


def upper_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The upper median, exact, from counts of distinct values instead of collected lists."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by)
    run = counts.withColumn("_to", F.sum("_c").over(w.orderBy(value))).withColumn("_all", F.sum("_c").over(w))
    half = F.floor(F.col("_all") / 2)
    return run.where((F.col("_to") > half) & (F.col("_to") - F.col("_c") <= half)).select(*by, F.col(value).alias("median"))
