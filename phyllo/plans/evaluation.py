"""Queries of model evaluation and vectors; the embeddings stand in for a model's outputs.

Probabilities are the softmax of the first ten numbers of an embedding, truth is its label, every third image is captive,
three images in a row are one observation, three classes a genus, five a family.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phyllo.operators import evaluate as ev
from phyllo.operators import vectors as vec
from phyllo.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
KEPT = [0, 1, 2, 3, 4, 5]
CORE, CANDIDATES = [0, 1, 2, 3], [4, 5, 6, 7, 8, 9]
GENUS = [i // 3 for i in range(10)]
THRESHOLDS, MARGINS = [0.15, 0.2, 0.25, 0.3], [0.0, 0.02, 0.05]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def probs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("image_id"), F.col("label").alias("truth"), (F.col("vec_id") % 3 == 0).alias("captive"), F.expr("vec_id div 3").alias("grp"), ev.softmax(F.slice("embedding", 1, 10)).alias("p"))


_P = """e AS (SELECT vec_id, label, list_transform(embedding[1:10], lambda x: exp(CAST(x AS DOUBLE))) AS x FROM embeddings),
  prob AS (SELECT vec_id AS image_id, label AS truth, vec_id % 3 = 0 AS captive, vec_id // 3 AS grp, list_transform(x, lambda y: y / list_sum(x)) AS p FROM e)"""


def _read(p: str = "p", frm: str = "prob", key: str = "image_id") -> str:
    """CTEs that give rd(key, truth, captive, best, second, guess, ok, in3) of an array column."""
    return f"""lg AS (SELECT {key} AS key, truth, captive, unnest({p}) AS x, unnest(range(len({p}))) AS k FROM {frm}),
  rk AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY x DESC, k) AS n FROM lg),
  rd AS (SELECT key, any_value(truth) AS truth, any_value(captive) AS captive, max(x) FILTER (n = 1) AS best, max(x) FILTER (n = 2) AS second, max(k) FILTER (n = 1) AS guess,
    bool_or(n = 1 AND k = truth) AS ok, bool_or(n <= 3 AND k = truth) AS in3 FROM rk GROUP BY key)"""


_KEPT = "list_transform(range(10), lambda i: CASE WHEN i < 6 THEN p[i + 1] ELSE 0.0::DOUBLE END)"
_TALLY = "SELECT count(*) AS images, count(*) FILTER (ok) AS top1, count(*) FILTER (in3) AS top3, count(*) FILTER (best >= {0}) AS accepted, count(*) FILTER (best >= {0} AND ok) AS right FROM rd"


@query(f"WITH {_P}, {_read()} SELECT captive, count(*) AS images, count(*) FILTER (ok) AS top1, count(*) FILTER (in3) AS top3, round(avg(best), 6) AS confidence FROM rd GROUP BY captive")
def agg13_topk_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return ev.accuracy(ev.read(probs(spark, d)), ["captive"]).withColumn("confidence", F.round("confidence", 6))


_CLASS = "SELECT c AS class, CAST(sum(s) AS BIGINT) AS support, CAST(sum(q) AS BIGINT) AS predicted, CAST(sum(h) AS BIGINT) AS hits FROM (SELECT truth AS c, 1 AS s, 0 AS q, CAST(ok AS INTEGER) AS h FROM rd UNION ALL SELECT CAST(guess AS INTEGER), 0, 1, 0 FROM rd) GROUP BY c"


@query(f"WITH {_P}, {_read()} {_CLASS}")
def agg14_per_class(spark: SparkSession, d: str) -> DataFrame:
    return ev.per_class(ev.read(probs(spark, d)))


@query(f"WITH {_P}, {_read()} SELECT count(*) AS classes, round(avg(CASE WHEN hits = 0 THEN 0.0 ELSE 2.0 * hits / (support + predicted) END), 6) AS macro_f1 FROM ({_CLASS}) WHERE support > 0")
def agg14_macro_f1(spark: SparkSession, d: str) -> DataFrame:
    return ev.macro_f1(ev.read(probs(spark, d))).withColumn("macro_f1", F.round("macro_f1", 6))


_GRID = "(SELECT unnest([0.15, 0.2, 0.25, 0.3]::DOUBLE[]) AS threshold) t, (SELECT unnest([0.0, 0.02, 0.05]::DOUBLE[]) AS margin) m"


@query(f"WITH {_P}, {_read()} SELECT threshold, margin, count(*) AS images, count(*) FILTER (best >= threshold AND best - second >= margin) AS accepted, count(*) FILTER (best >= threshold AND best - second >= margin AND ok) AS right FROM rd, {_GRID} GROUP BY ALL")
def agg15_threshold_curve(spark: SparkSession, d: str) -> DataFrame:
    return ev.accepted(ev.read(probs(spark, d)), THRESHOLDS, MARGINS)


@query(f"WITH {_P}, {_read()} SELECT captive, threshold, margin, count(*) AS images, count(*) FILTER (best >= threshold) AS accepted, count(*) FILTER (best >= threshold AND ok) AS right FROM (SELECT * FROM rd WHERE captive), (SELECT unnest([0.15, 0.2, 0.25]::DOUBLE[]) AS threshold, 0.0::DOUBLE AS margin) GROUP BY ALL")
def agg16_captive_curve(spark: SparkSession, d: str) -> DataFrame:
    return ev.accepted(ev.read(probs(spark, d)).where("captive"), [0.15, 0.2, 0.25], [-1e9], ["captive"]).withColumn("margin", F.lit(0.0))


@query("SELECT label AS class, round((SELECT count(*) FROM embeddings) / ((SELECT count(DISTINCT label) FROM embeddings) * CAST(count(*) AS DOUBLE)), 9) AS weight FROM embeddings GROUP BY label")
def agg12_class_weights(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("label").alias("class"))
    return ev.class_weights(e.distinct(), e.groupBy("class").agg(F.count("*").alias("n"))).withColumn("weight", F.round("weight", 9))


_LEVEL = "CASE WHEN ok THEN 'right' WHEN truth // 3 = guess // 3 THEN 'within_genus' WHEN truth // 5 = guess // 5 THEN 'same_family' ELSE 'outside_family' END"


@query(f"WITH {_P}, {_read()} SELECT {_LEVEL} AS level, count(*) AS images FROM rd GROUP BY 1")
def agg18_confusion_levels(spark: SparkSession, d: str) -> DataFrame:
    g = lambda c, n: F.expr(f"{c} div {n}")
    return ev.confusion(ev.read(probs(spark, d)), g("truth", 3), g("truth", 5), g("guess", 3), g("guess", 5))


@query(f"WITH {_P}, {_read()} SELECT CAST(truth // 3 AS BIGINT) AS a, CAST(guess // 3 AS BIGINT) AS b, count(*) AS images FROM rd WHERE NOT ok AND truth // 3 <> guess // 3 GROUP BY ALL")
def agg18_between_genera(spark: SparkSession, d: str) -> DataFrame:
    return ev.between(ev.read(probs(spark, d)), F.expr("truth div 3"), F.expr("guess div 3"))


@query("WITH c AS (SELECT internal_id, genus, family FROM plants), g AS (SELECT genus, count(*) AS n FROM c GROUP BY 1), f AS (SELECT family, count(*) AS n FROM c GROUP BY 1), k AS (SELECT count(*) AS n FROM c) SELECT k.n AS classes, round((SELECT sum(n * (n - 1)) FROM g) / (k.n * (k.n - 1)), 9) AS genus, round(((SELECT sum(n * n) FROM f) - (SELECT sum(n * n) FROM g)) / (k.n * (k.n - 1)), 9) AS family FROM k")
def agg19_by_chance(spark: SparkSession, d: str) -> DataFrame:
    out = ev.by_chance(table(spark, d, "plants").select(F.col("internal_id").alias("class"), "genus", "family"))
    return out.select("classes", F.round("genus", 9).alias("genus"), F.round("family", 9).alias("family"))


_RATE = "SELECT truth, count(*) AS seen, count(*) FILTER (NOT ok) AS missed FROM rd GROUP BY truth HAVING count(*) >= 5"


@query(f"WITH {_P}, {_read()} {_RATE}")
def agg20_rates(spark: SparkSession, d: str) -> DataFrame:
    return ev.rates(ev.read(probs(spark, d)))


@query(f"WITH {_P}, {_read()} SELECT count(*) AS measurable, count(*) FILTER (missed = seen) AS zero, count(*) FILTER ((seen - missed) / seen < 0.25) AS under_25, count(*) FILTER ((seen - missed) / seen < 0.5) AS under_50 FROM ({_RATE})")
def agg21_weakness(spark: SparkSession, d: str) -> DataFrame:
    return ev.weakness(ev.read(probs(spark, d)))


@query(f"WITH {_P}, {_read()}, w AS (SELECT truth, guess AS mostly, count(*) AS times FROM rd WHERE NOT ok GROUP BY ALL) SELECT r.truth, seen, missed, CAST(mostly AS INTEGER) AS mostly, times FROM ({_RATE}) r JOIN (SELECT *, row_number() OVER (PARTITION BY truth ORDER BY times DESC, mostly) AS n FROM w) m ON m.truth = r.truth AND n = 1 ORDER BY missed / seen DESC, seen DESC, r.truth LIMIT 4")
def top03_struggling(spark: SparkSession, d: str) -> DataFrame:
    return ev.struggling(ev.read(probs(spark, d)), 5, 4)


@query(f"WITH {_P}, mk AS (SELECT image_id, truth, captive, {_KEPT} AS p FROM prob WHERE truth < 6), {_read('p', 'mk')} {_TALLY.format(0.2)}")
def evl02_masked_tally(spark: SparkSession, d: str) -> DataFrame:
    rows = probs(spark, d).where(F.col("truth").isin(*KEPT)).withColumn("p", ev.masked("p", KEPT))
    return ev.tally(ev.read(rows), 0.2)


@query(f"WITH {_P}, m0 AS (SELECT image_id, truth, captive, {_KEPT} AS q FROM prob WHERE truth < 6), mk AS (SELECT image_id, truth, captive, list_transform(q, lambda x: x / list_sum(q)) AS p FROM m0), {_read('p', 'mk')} {_TALLY.format(0.3)}")
def evl02_renormalised_tally(spark: SparkSession, d: str) -> DataFrame:
    rows = probs(spark, d).where(F.col("truth").isin(*KEPT)).withColumn("p", ev.masked("p", KEPT, True))
    return ev.tally(ev.read(rows), 0.3)


@query(f"WITH {_P}, m0 AS (SELECT image_id, truth, captive, {_KEPT} AS q FROM prob), mk AS (SELECT image_id, truth, captive, list_transform(q, lambda x: x / list_sum(q)) AS p FROM m0), {_read('p', 'mk')} SELECT key AS image_id, CAST(guess AS INTEGER) AS guess, round(best, 6) AS best FROM rd")
def evl03_apply_mask(spark: SparkSession, d: str) -> DataFrame:
    rows = probs(spark, d).withColumn("p", ev.context_mask("p", KEPT))
    return ev.read(rows, keep=("image_id",)).select("image_id", "guess", F.round("best", 6).alias("best"))


_MASS = "[p[1] + p[2] + p[3], p[4] + p[5] + p[6], p[7] + p[8] + p[9], p[10]]"


@query(f"WITH {_P} SELECT image_id, round(unnest({_MASS}), 6) AS mass, CAST(unnest(range(4)) AS INTEGER) AS genus FROM prob")
def evl04_genus_mass(spark: SparkSession, d: str) -> DataFrame:
    rows = probs(spark, d).select("image_id", F.posexplode(ev.group_mass("p", GENUS)).alias("genus", "mass"))
    return rows.select("image_id", "genus", F.round("mass", 6).alias("mass"))


_ANSWER = f"""gm AS (SELECT image_id, truth, captive, p, {_MASS} AS m FROM prob),
  an AS (SELECT image_id, truth, CASE WHEN list_max(p) >= 0.25 THEN 'species' WHEN list_max(m) >= 0.4 THEN 'genus' ELSE 'nothing' END AS kind, list_position(p, list_max(p)) - 1 AS sp, list_position(m, list_max(m)) - 1 AS ge FROM gm)"""


@query(f"WITH {_P}, {_ANSWER} SELECT kind, count(*) AS images, count(*) FILTER (CASE kind WHEN 'species' THEN sp = truth WHEN 'genus' THEN ge = truth // 3 ELSE false END) AS right FROM an GROUP BY kind")
def evl05_answers(spark: SparkSession, d: str) -> DataFrame:
    rows = probs(spark, d).withColumn("m", ev.group_mass("p", GENUS))
    a = ev.answer("p", "m", 0.25, 0.4)
    out = rows.select("truth", a.alias("a"))
    right = F.when(F.col("a.kind") == "species", F.col("a.i") == F.col("truth")).when(F.col("a.kind") == "genus", F.col("a.i") == F.expr("truth div 3")).otherwise(False)
    return out.groupBy(F.col("a.kind").alias("kind")).agg(F.count("*").alias("images"), F.count_if(right).alias("right"))


@query(f"WITH {_P}, {_read()} SELECT key AS image_id, round(sum(x), 6) AS mass, count(*) AS n FROM rk WHERE n <= 3 GROUP BY key")
def evl06_truncated(spark: SparkSession, d: str) -> DataFrame:
    rows = probs(spark, d).withColumn("p", ev.truncated("p", 3))
    return rows.select("image_id", F.round(F.aggregate("p", F.lit(0.0), lambda s, x: s + x), 6).alias("mass"), F.size(F.filter("p", lambda x: x > 0)).cast("long").alias("n"))


_COMBINE = """cb AS (SELECT grp, min(truth) AS truth, bool_or(captive) AS captive, list({0} ORDER BY k) AS p FROM (
  SELECT grp, k, min(truth) AS truth, bool_or(captive) AS captive, {1} AS v FROM (SELECT grp, truth, captive, unnest(p) AS x, unnest(range(10)) AS k FROM prob) GROUP BY grp, k) GROUP BY grp)"""


@query(f"WITH {_P}, {_COMBINE.format('v', 'avg(x)')}, {_read('p', 'cb', 'grp')} {_TALLY.format(0.2)}")
def evl07_combine_mean(spark: SparkSession, d: str) -> DataFrame:
    return ev.tally(ev.read(ev.combine(probs(spark, d), "grp")), 0.2)


@query(f"WITH {_P}, {_COMBINE.format('v', 'exp(avg(ln(greatest(x, 1e-9))))')}, {_read('p', 'cb', 'grp')} {_TALLY.format(0.18)}")
def evl07_combine_geometric(spark: SparkSession, d: str) -> DataFrame:
    return ev.tally(ev.read(ev.combine(probs(spark, d), "grp", geometric=True)), 0.18)


@query(f"""WITH {_P}, {_read()}, kn AS (SELECT p.grp, p.truth, p.captive, r.key, r.k, r.x FROM rk r JOIN prob p ON p.image_id = r.key WHERE r.n <= 3 AND r.x >= 0.12),
  fl AS (SELECT p.grp, p.image_id, least(coalesce(min(x), 0.12), 0.12) AS f FROM prob p LEFT JOIN kn ON kn.key = p.image_id GROUP BY ALL),
  ids AS (SELECT DISTINCT grp, k FROM kn), n AS (SELECT grp, count(*) AS n FROM prob GROUP BY grp),
  rw AS (SELECT ids.grp, ids.k, exp(avg(ln(greatest(coalesce(kn.x, fl.f), 1e-9)))) AS v FROM ids JOIN fl USING (grp) LEFT JOIN kn ON kn.key = fl.image_id AND kn.k = ids.k GROUP BY ALL),
  cv AS (SELECT grp, sum(x) AS c FROM kn GROUP BY grp), tt AS (SELECT grp, sum(v) AS t FROM rw GROUP BY grp),
  fi AS (SELECT rw.grp, max(v * c / n.n / t) AS best FROM rw JOIN cv USING (grp) JOIN tt USING (grp) JOIN n USING (grp) WHERE n.n > 1 GROUP BY rw.grp)
  SELECT n.grp AS grp, round(CASE WHEN n.n = 1 THEN (SELECT max(best) FROM rd JOIN prob ON image_id = key WHERE prob.grp = n.grp) ELSE least(coalesce(fi.best, 0.0), 1.0) END, 6) AS best FROM n LEFT JOIN fi USING (grp)""")
def evl08_like_app(spark: SparkSession, d: str) -> DataFrame:
    return ev.like_app(probs(spark, d), "grp", 3, 0.12).select("grp", F.round(F.array_max("p"), 6).alias("best"))


@query(f"WITH {_P}, two AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY image_id) AS rn, count(*) OVER (PARTITION BY grp) AS gn FROM prob) WHERE rn <= 2 AND gn >= 2), {_COMBINE.format('v', 'avg(x)').replace('FROM prob', 'FROM two')}, {_read('p', 'cb', 'grp')} {_TALLY.format(0.2)}")
def evl09_two_photos(spark: SparkSession, d: str) -> DataFrame:
    return ev.tally(ev.read(ev.combine(probs(spark, d), "grp", photos=2)), 0.2)


@query(f"WITH {_P}, {_COMBINE.format('v', 'avg(x)')}, {_read('p', 'cb', 'grp')} SELECT threshold, margin, count(*) AS images, count(*) FILTER (best >= threshold AND best - second >= margin) AS accepted, count(*) FILTER (best >= threshold AND best - second >= margin AND ok) AS right FROM rd, {_GRID} GROUP BY ALL")
def evl10_sweep(spark: SparkSession, d: str) -> DataFrame:
    return ev.accepted(ev.read(ev.combine(probs(spark, d), "grp")), THRESHOLDS, MARGINS)


@query("WITH c AS (SELECT internal_id AS class, CASE WHEN family = 'Vaduraceae' THEN 0 ELSE 1 END AS tier, genus AS prio FROM plants), r AS (SELECT *, row_number() OVER (ORDER BY tier, prio, class) AS rank FROM c), s AS (SELECT DISTINCT least(greatest(s, (SELECT count(*) FROM c WHERE tier = 0)), (SELECT count(*) FROM c)) AS size FROM (SELECT unnest([10, 200, 700, 5000]) AS s)) SELECT CAST(size AS INTEGER) AS size, class FROM r JOIN s ON rank <= size")
def sel02_nested_sets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "plants").select(F.col("internal_id").alias("class"), F.when(F.col("family") == "Vaduraceae", 0).otherwise(1).alias("tier"), F.col("genus").alias("prio"))
    return ev.nested_sets(rows, [10, 200, 700, 5000])


_THEFT = f"WITH {_P}, own AS (SELECT * FROM prob WHERE truth < 4 AND list_position(p[1:4], list_max(p[1:4])) - 1 = truth) SELECT k AS candidate, CAST(count(*) FILTER (p[k + 1] > p[truth + 1]) AS BIGINT) AS cost FROM own, (SELECT CAST(unnest([4, 5, 6, 7, 8, 9]) AS INTEGER) AS k) GROUP BY k"


@query(_THEFT)
def sel03_theft_costs(spark: SparkSession, d: str) -> DataFrame:
    return ev.theft_costs(probs(spark, d), CORE, CANDIDATES)


@query(f"SELECT candidate, CAST(row_number() OVER (ORDER BY cost, CASE candidate WHEN 9 THEN 0 WHEN 4 THEN 1 ELSE 2 END, candidate) AS INTEGER) AS rank FROM ({_THEFT})")
def top05_order_by_theft(spark: SparkSession, d: str) -> DataFrame:
    return ev.by_theft(ev.theft_costs(probs(spark, d), CORE, CANDIDATES), {9: 0, 4: 1}).select("candidate", "rank")


@query(f"WITH {_P}, {_read()}, b AS (SELECT truth AS folder, CASE WHEN best < 0.10 THEN 'silent' WHEN best < 0.70 THEN 'uncertain' ELSE 'asserted' END AS band, best FROM rd) SELECT folder, band, count(*) AS n, round(max(best), 6) AS top FROM b GROUP BY GROUPING SETS ((folder, band), (band))")
def agg27_bands_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = ev.read(probs(spark, d)).withColumn("place", F.col("truth"))
    return ev.off_topic(rows, "place").select("folder", "band", "n", F.round("top", 6).alias("top"))


@query(f"WITH {_P}, {_read()} SELECT truth, round(list_sort(list(best))[len(list(best)) // 2 + 1], 6) AS median FROM rd GROUP BY truth")
def agg27_upper_median(spark: SparkSession, d: str) -> DataFrame:
    return ev.upper_median(ev.read(probs(spark, d)), ["truth"], "best").select("truth", F.round("median", 6).alias("median"))


_UNIT = """v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
  u AS (SELECT id, label, list_transform(e, lambda x: x / greatest(sqrt(list_sum(list_transform(e, lambda y: y * y))), 1e-12)) AS v FROM v),
  ul AS (SELECT id, label, unnest(v) AS x, unnest(range(len(v))) AS i FROM u), s AS (SELECT label, i, sum(x) AS x, count(*) AS n FROM ul GROUP BY ALL)"""


@query(f"WITH {_UNIT}, q AS (SELECT label, sqrt(sum(x * x)) AS l FROM s GROUP BY label) SELECT s.label, CAST(i AS INTEGER) AS i, round(x / l, 6) AS x FROM s JOIN q USING (label)")
def vec02_prototypes(spark: SparkSession, d: str) -> DataFrame:
    out = vec.prototypes(vec.units(table(spark, d, "embeddings")))
    return out.select("label", F.posexplode("v").alias("i", "x")).select("label", "i", F.round("x", 6).alias("x"))


@query(f"WITH {_UNIT}, pr AS (SELECT a.label = b.label AS same, list_dot_product(a.v, b.v) AS c FROM u a JOIN u b ON a.id < b.id) SELECT round(avg(c) FILTER (same), 6) AS intra, round(avg(c) FILTER (NOT same), 6) AS inter FROM pr")
def vec03_cosine_gap(spark: SparkSession, d: str) -> DataFrame:
    out = vec.separability(vec.units(table(spark, d, "embeddings")))
    return out.select(F.round("intra", 6).alias("intra"), F.round("inter", 6).alias("inter"))


@query(f"""WITH {_UNIT}, sc AS (SELECT ul.id, ul.label, s.label AS g, CASE WHEN s.label = ul.label THEN s.x - ul.x ELSE s.x END AS y, ul.x FROM ul JOIN s USING (i)),
  c AS (SELECT id, label, g, sum(x * y) / greatest(sqrt(sum(y * y)), 1e-12) AS c FROM sc GROUP BY ALL) SELECT id, label, g AS guess FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, g) AS n FROM c) WHERE n = 1""")
def vec04_leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    return vec.leave_one_out(vec.units(table(spark, d, "embeddings")))


_DRAWS = f"""{_UNIT.strip()}, pm AS (SELECT id, label, 0 AS draw FROM u UNION ALL SELECT a.id, b.label, a.draw FROM
    (SELECT id, draw, row_number() OVER (PARTITION BY draw ORDER BY md5('draw:id:' || draw || ':' || id), id) AS r FROM u, (SELECT CAST(unnest(range(1, 20)) AS INTEGER) AS draw)) a JOIN
    (SELECT id, label, draw, row_number() OVER (PARTITION BY draw ORDER BY md5('draw:label:' || draw || ':' || id), id) AS r FROM u, (SELECT CAST(unnest(range(1, 20)) AS INTEGER) AS draw)) b USING (draw, r)),
  st AS (SELECT draw, pm.label, i, sum(x) AS x, count(*) AS n, sum(x * x) AS xx FROM pm JOIN ul USING (id) GROUP BY ALL),
  lb AS (SELECT draw, label, sum(x * x) AS q, sum(xx) AS diag, max(n) AS n FROM st GROUP BY ALL), al AS (SELECT draw, sum(x * x) AS w FROM (SELECT draw, i, sum(x) AS x FROM st GROUP BY ALL) GROUP BY draw),
  mn AS (SELECT draw, sum(q - diag) / sum(n * (n - 1)) AS intra, (any_value(w) - sum(q)) / (sum(n) * (sum(n) - 1) - sum(n * (n - 1))) AS inter FROM lb JOIN al USING (draw) GROUP BY draw)"""


@query(f"WITH {_DRAWS} SELECT draw, round(intra, 6) AS intra, round(inter, 6) AS inter FROM mn")
def vec05_permutation(spark: SparkSession, d: str) -> DataFrame:
    out = vec.permutation_control(vec.units(table(spark, d, "embeddings")), 19)
    return out.select("draw", F.round("intra", 6).alias("intra"), F.round("inter", 6).alias("inter"))


@query(f"WITH {_DRAWS}, g AS (SELECT draw, intra - inter AS gap FROM mn) SELECT round((1 + count(*) FILTER (draw > 0 AND gap >= (SELECT gap FROM g WHERE draw = 0))) / 20.0, 4) AS p, count(*) - 1 AS draws, round(max(gap) FILTER (draw = 0), 6) AS gap, round(avg(gap) FILTER (draw > 0), 6) AS mean_gap FROM g")
def vec05_p_value(spark: SparkSession, d: str) -> DataFrame:
    out = vec.p_value(vec.permutation_control(vec.units(table(spark, d, "embeddings")), 19))
    return out.select("p", "draws", F.round("gap", 6).alias("gap"), F.round("mean_gap", 6).alias("mean_gap"))


@query("SELECT vec_id, round(CAST(embedding[3] AS DOUBLE), 6) AS a, round(CAST(embedding[1] AS DOUBLE), 6) AS b FROM embeddings")
def vec06_cut_columns(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", vec.cut("embedding", [2, 0]).alias("v"))
    return e.select("vec_id", F.round(F.col("v")[0].cast("double"), 6).alias("a"), F.round(F.col("v")[1].cast("double"), 6).alias("b"))
