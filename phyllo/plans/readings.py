"""Readings of models and of the catalogue that compose several operators: taxa, genera, comparisons, restricted catalogues.

As in ``evaluation``, embeddings stand in for a model's outputs: their first ten numbers for the one model, the ten after
them for another; class k is the k-th plant of the catalogue by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phyllo.functions import names, scalars
from phyllo.operators import catalog, ingest, services
from phyllo.operators import evaluate as ev
from phyllo.operators import vectors as vec
from phyllo.plans import evaluation
from phyllo.plans.evaluation import _ANSWER, _P, _TALLY, _read, probs
from phyllo.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
LABELS = {"A": list(range(8)), "B": list(range(2, 10))}
SETS = {4: [0, 1, 2, 3], 6: [0, 1, 2, 3, 4, 5], 10: list(range(10))}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- names and families ------------------------------------------------------------------------------------------------

_TAXA = """taxa AS (SELECT c.class_id, coalesce(lower(split_part(p.scientific_name, ' ', 1)), split_part(c.class_id, '-', 1)) AS genus, coalesce(lower(trim(p.family)), '?' || c.class_id) AS family
  FROM ({0}) c LEFT JOIN (SELECT * FROM plants WHERE NOT starts_with(internal_id, 'h')) p ON p.internal_id = c.class_id)"""
_USED = "SELECT DISTINCT internal_plant_id AS class_id FROM records WHERE internal_plant_id IS NOT NULL"


def _listed(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue as a model's owner may have it, without some plants, so that fallbacks are needed."""
    return table(spark, d, "plants").where("NOT startswith(internal_id, 'h')")


@query(f"WITH {_TAXA.format(_USED)} SELECT class_id, genus, family FROM taxa")
def jn18_names_families(spark: SparkSession, d: str) -> DataFrame:
    return ev.taxa(table(spark, d, "records").select(F.col("internal_plant_id").alias("class_id")).where("class_id IS NOT NULL").distinct(), _listed(spark, d))


def _classes(spark: SparkSession, d: str) -> DataFrame:
    """(class, class_id, genus, family) of the ten classes."""
    first = table(spark, d, "plants").select("internal_id").orderBy("internal_id").limit(40)
    at = F.row_number().over(Window.orderBy("internal_id")) - 1  # forty rows
    own = first.select(F.col("internal_id").alias("class_id"), at.alias("n")).where("n % 4 = 0").select("class_id", F.expr("n div 4").cast("int").alias("class"))
    return ev.taxa(own, _listed(spark, d))


_CLASSES = "SELECT internal_id AS class_id, CAST(n // 4 AS INTEGER) AS class FROM (SELECT internal_id, row_number() OVER (ORDER BY internal_id) - 1 AS n FROM plants) WHERE n < 40 AND n % 4 = 0"
_TEN = f"{_TAXA.format('SELECT class_id FROM cls')}, ten AS (SELECT class, class_id, genus, family FROM cls JOIN taxa USING (class_id))"


@query(f"""WITH {_P}, {_read()}, cls AS ({_CLASSES}), {_TEN}
  SELECT CASE WHEN ok THEN 'right' WHEN a.genus = b.genus THEN 'within_genus' WHEN a.family = b.family THEN 'same_family' ELSE 'outside_family' END AS level, count(*) AS images
  FROM rd JOIN ten a ON a.class = truth JOIN ten b ON b.class = guess GROUP BY 1""")
def evl12_confusion_reading(spark: SparkSession, d: str) -> DataFrame:
    c = _classes(spark, d).select("class", "genus", "family")
    side = lambda of: F.broadcast(c.select(*[F.col(x).alias(f"{of}_{x}") for x in ("class", "genus", "family")]))
    r = ev.read(probs(spark, d)).join(side("t"), F.col("truth") == F.col("t_class")).join(side("g"), F.col("guess") == F.col("g_class"))
    return ev.confusion(r, F.col("t_genus"), F.col("t_family"), F.col("g_genus"), F.col("g_family"))


@query(f"""WITH {_TAXA.format(_USED)}, g AS (SELECT genus, count(*) AS n FROM taxa GROUP BY 1), f AS (SELECT family, count(*) AS n FROM taxa GROUP BY 1), k AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM taxa),
  s AS (SELECT k.n, (SELECT sum(n * (n - 1)) FROM g) / (k.n * (k.n - 1)) AS genus, ((SELECT sum(n * n) FROM f) - (SELECT sum(n * n) FROM g)) / (k.n * (k.n - 1)) AS family FROM k)
  SELECT CAST(n AS BIGINT) AS classes, round(genus, 9) AS genus, round(family, 9) AS family, round(1 - genus - family, 9) AS beyond, (SELECT count(*) FROM g WHERE n = 1) AS alone FROM s""")
def agg19_baseline(spark: SparkSession, d: str) -> DataFrame:
    c = jn18_names_families(spark, d).withColumnRenamed("class_id", "class")
    return ev.by_chance(c).select("classes", *[F.round(x, 9).alias(x) for x in ("genus", "family", "beyond")], "alone")


# --- genera ------------------------------------------------------------------------------------------------------------


@query(f"""WITH {_P}, {_ANSWER}, c AS (SELECT count(*) AS n, count(*) FILTER (kind = 'species') AS s, count(*) FILTER (kind = 'species' AND sp = truth) AS sr, count(*) FILTER (kind = 'genus') AS g, count(*) FILTER (kind = 'genus' AND ge = truth // 3) AS gr FROM an)
  SELECT n AS images, round(s / n, 9) AS species_rate, round(sr / nullif(s, 0), 9) AS species_precision, round(g / n, 9) AS genus_rate, round(gr / nullif(g, 0), 9) AS genus_precision, round((s + g) / n, 9) AS autonomy, round((sr + gr) / nullif(s + g, 0), 9) AS precision FROM c""".replace("list_max(m) >= 0.4", "list_max(m) >= 0.25"))
def agg24_genus_measure(spark: SparkSession, d: str) -> DataFrame:
    out = ev.genus_measure(probs(spark, d), evaluation.GENUS, 0.25)
    return out.select("images", *[F.round(c, 9).alias(c) for c in out.columns if c != "images"])


@query(f"WITH {_TAXA.format(_USED)}, g AS (SELECT genus, count(*) AS n FROM taxa GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS classes, count(*) AS genera, count(*) FILTER (n = 1) AS lone, max(n) AS richest FROM g")
def agg25_genus_sizes(spark: SparkSession, d: str) -> DataFrame:
    return ev.genus_sizes(jn18_names_families(spark, d).withColumnRenamed("class_id", "class"))


@query(f"WITH {_TAXA.format(_USED)}, g AS (SELECT genus, count(*) AS n FROM taxa GROUP BY 1) SELECT count(*) AS images, count(*) FILTER (n > 1) AS of_several FROM records r JOIN taxa ON class_id = internal_plant_id JOIN g USING (genus)")
def agg25_shared_genus(spark: SparkSession, d: str) -> DataFrame:
    return ev.shared_genus_share(table(spark, d, "records").select(F.col("internal_plant_id").alias("class")), jn18_names_families(spark, d).withColumnRenamed("class_id", "class"))


# --- comparisons -------------------------------------------------------------------------------------------------------


def _softmax(e: str) -> str:
    return f"list_transform({e}, lambda x: exp(CAST(x AS DOUBLE)))"


_KEEP = "list_transform(range(10), lambda i: CASE WHEN {0} THEN p[i + 1] ELSE 0.0::DOUBLE END)"
_BOTH = f"""raw AS (SELECT vec_id AS id, label AS truth, vec_id % 3 = 0 AS captive, 'A' AS model, {_softmax('embedding[1:10]')} AS x FROM embeddings UNION ALL SELECT vec_id, label, vec_id % 3 = 0, 'B', {_softmax('embedding[11:20]')} FROM embeddings),
  outp AS (SELECT id, truth, captive, model, list_transform(x, lambda y: y / list_sum(x)) AS p FROM raw)"""
_THREE = f"""m AS (SELECT *, {_KEEP.format('i BETWEEN 2 AND 7')} AS q FROM outp),
  r AS (SELECT *, 'full' AS reading, 0.70::DOUBLE AS threshold, p AS z FROM m UNION ALL SELECT *, 'masked', 0.70::DOUBLE, q FROM m UNION ALL SELECT m.*, 'renormalised', t, list_transform(q, lambda y: y / list_sum(q)) FROM m, (SELECT unnest([0.2, 0.3]::DOUBLE[]) AS t)),
  gr AS (SELECT *, 'common' AS ground FROM r WHERE truth BETWEEN 2 AND 7 UNION ALL SELECT *, 'captive' FROM r WHERE truth BETWEEN 2 AND 7 AND captive UNION ALL SELECT *, 'gained' FROM r WHERE truth > 7 AND model = 'B' AND reading = 'full'),
  s AS (SELECT *, list_max(z) AS best, list_position(z, list_max(z)) - 1 AS guess, len(list_filter(range(10), lambda i: z[i + 1] > z[truth + 1] OR (z[i + 1] = z[truth + 1] AND i < truth))) AS above FROM gr)"""
_COUNTS = "count(*) AS images, count(*) FILTER (guess = truth) AS top1, count(*) FILTER (above < 3) AS top3, count(*) FILTER (best >= {0}) AS accepted, count(*) FILTER (best >= {0} AND guess = truth) AS right"


def _outputs(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    models = F.inline(F.array(*[F.struct(F.lit(m).alias("model"), ev.softmax(F.slice("embedding", at, 10)).alias("p")) for m, at in (("A", 1), ("B", 11))]))
    return e.select(F.col("vec_id").alias("image_id"), F.col("label").alias("truth"), (F.col("vec_id") % 3 == 0).alias("captive"), models)


@query(f"WITH {_BOTH}, {_THREE} SELECT ground, model, reading, threshold, {_COUNTS.format('threshold')} FROM s GROUP BY ALL")
def evl13_compare_models(spark: SparkSession, d: str) -> DataFrame:
    return ev.compare(_outputs(spark, d), LABELS, [0.2, 0.3])


_INSIDE = f"""m AS (SELECT *, {_KEEP.format('i < 6')} AS q FROM prob),
  r AS (SELECT 'whole' AS reading, truth, p AS z FROM m WHERE truth < 6 UNION ALL SELECT 'restricted', truth, list_transform(q, lambda y: y / list_sum(q)) FROM m WHERE truth < 6 UNION ALL SELECT 'captive', truth, p FROM m WHERE truth < 6 AND captive UNION ALL SELECT 'rest', truth, p FROM m WHERE truth >= 6),
  s AS (SELECT *, list_max(z) AS best, list_position(z, list_max(z)) - 1 AS guess, len(list_filter(range(10), lambda i: z[i + 1] > z[truth + 1] OR (z[i + 1] = z[truth + 1] AND i < truth))) AS above FROM r)"""


@query(f"WITH {_P}, {_INSIDE} SELECT reading, {_COUNTS.format(0.2)} FROM s GROUP BY reading")
def evl14_restricted_reading(spark: SparkSession, d: str) -> DataFrame:
    return ev.restricted_reading(probs(spark, d), evaluation.KEPT, 0.2)


@query(f"""WITH {_P}, ex AS (SELECT unnest([4, 6, 10]) AS exposed), m AS (SELECT image_id, truth, captive, exposed, list_transform(range(10), lambda i: CASE WHEN i < exposed THEN p[i + 1] ELSE 0.0::DOUBLE END) AS q FROM prob, ex WHERE truth < exposed),
  r AS (SELECT image_id, truth, captive, exposed, CASE WHEN truth < 4 THEN 'core' ELSE 'added' END AS part, list_transform(q, lambda y: y / list_sum(q)) AS z FROM m),
  b AS (SELECT *, 'all' AS photos FROM r UNION ALL SELECT *, 'captive' FROM r WHERE captive),
  s AS (SELECT *, list_max(z) AS best, list_position(z, list_max(z)) - 1 AS guess, len(list_filter(range(10), lambda i: z[i + 1] > z[truth + 1] OR (z[i + 1] = z[truth + 1] AND i < truth))) AS above FROM b)
  SELECT photos, CAST(exposed AS INTEGER) AS exposed, part, {_COUNTS.format(0.3)} FROM s GROUP BY ALL""")
def sel04_cost_table(spark: SparkSession, d: str) -> DataFrame:
    return ev.cost_table(probs(spark, d), SETS, evaluation.CORE, 0.3)


@query(f"WITH {_P}, {_read()} SELECT key AS image_id, CAST(guess AS INTEGER) AS guess, round(best, 6) AS best, round(second, 6) AS second FROM rd ORDER BY best DESC, key LIMIT 25")
def top06_most_asserted(spark: SparkSession, d: str) -> DataFrame:
    out = ev.most_asserted(ev.read(probs(spark, d), keep=("image_id",)), "image_id", 25)
    return out.select("image_id", F.col("guess").cast("int").alias("guess"), F.round("best", 6).alias("best"), F.round("second", 6).alias("second"))


@query(f"""WITH {_P}, {_read()}, b AS (SELECT truth AS folder, CASE WHEN best < 0.10 THEN 'silent' WHEN best < 0.70 THEN 'uncertain' ELSE 'asserted' END AS band, best FROM rd)
  SELECT folder, count(*) AS n, count(*) FILTER (band = 'silent') AS silent, count(*) FILTER (band = 'uncertain') AS uncertain, count(*) FILTER (band = 'asserted') AS asserted, round(list_sort(list(best))[len(list(best)) // 2 + 1], 6) AS median FROM b GROUP BY folder""")
def evl15_off_topic(spark: SparkSession, d: str) -> DataFrame:
    """Each folder of pictures of no known class: how surely they are named, and the upper median."""
    r = ev.read(probs(spark, d)).withColumn("folder", F.col("truth"))
    bands = ev.off_topic(r, "folder").where("whole = 0").groupBy("folder").agg(F.sum("n").alias("n"), *[F.coalesce(F.sum(F.when(F.col("band") == b, F.col("n"))), F.lit(0).cast("long")).alias(b) for b in ("silent", "uncertain", "asserted")])
    return bands.join(ev.upper_median(r, ["folder"], "best"), "folder").withColumn("median", F.round("median", 6))


@query(f"""WITH {_P}, {evaluation._COMBINE.format('v', 'avg(x)')}, m AS (SELECT grp, truth, {_KEEP.format('i < 6')} AS q FROM cb), z AS (SELECT grp, truth, list_transform(q, lambda y: y / list_sum(q)) AS z FROM m),
  s AS (SELECT grp, list_sort(z, 'DESC') AS o, list_position(z, list_max(z)) - 1 AS guess FROM z)
  SELECT grp, CAST(guess AS INTEGER) AS guess, round(o[1], 6) AS best, CASE WHEN o[1] < 0.10 THEN 'no candidate' WHEN o[1] >= 0.24 AND o[1] - o[2] >= 0.02 THEN 'accepted' ELSE 'uncertain' END AS verdict FROM s""")
def evl16_identify(spark: SparkSession, d: str) -> DataFrame:
    """What a device answers for an observation of several photos: their mean, the mask of the context, the verdict."""
    rows = ev.combine(probs(spark, d), "grp").withColumn("p", ev.context_mask("p", evaluation.KEPT))
    r = ev.read(rows, keep=("grp",))
    return r.select("grp", F.col("guess").cast("int").alias("guess"), F.round("best", 6).alias("best"), services.verdict(F.col("best"), F.col("second"), 0.10, 0.24, 0.02).alias("verdict"))


@query("SELECT vec_id AS id, label, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS length, round(CAST(embedding[1] AS DOUBLE) / greatest(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 1e-12), 6) AS first FROM embeddings")
def vec01_unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    u = vec.units(e).select("id", "label", F.round(F.col("v")[0], 6).alias("first"))
    x = F.transform("embedding", lambda v: v.cast("double"))
    return e.select(F.col("vec_id").alias("id"), F.round(F.sqrt(vec.dot(x, x)), 6).alias("length")).join(u, "id")


@query("WITH k AS (SELECT vec_id AS id, list_transform(list_filter(range(10), lambda i: i < 6), lambda i: exp(CAST(embedding[i + 1] AS DOUBLE))) AS x FROM embeddings) SELECT id, round(list_max(x) / list_sum(x), 6) AS best FROM k")
def vec07_truncated_softmax(spark: SparkSession, d: str) -> DataFrame:
    """The best of the masked and renormalised outputs: the softmax over the kept columns alone."""
    rows = probs(spark, d).withColumn("p", ev.masked("p", evaluation.KEPT, True))
    return rows.select(F.col("image_id").alias("id"), F.round(F.array_max("p"), 6).alias("best"))


# --- catalogue ---------------------------------------------------------------------------------------------------------


@query("SELECT CAST(sum(n - 1) AS BIGINT) AS too_many, count(*) AS groups FROM (SELECT count(*) AS n FROM plants WHERE genus IS NOT NULL GROUP BY genus HAVING count(*) > 1)")
def agg10_classes_too_many(spark: SparkSession, d: str) -> DataFrame:
    return catalog.surplus(catalog.same_key_groups(table(spark, d, "plants"), "genus", "internal_id"))


@query("SELECT (SELECT string_agg(n, ', ' ORDER BY n) FROM (SELECT DISTINCT species AS n FROM splits WHERE species IS NOT NULL ORDER BY 1 LIMIT 12)) AS shown, greatest(count(DISTINCT species) - 12, 0) AS more FROM splits")
def top10_and_more(spark: SparkSession, d: str) -> DataFrame:
    return catalog.shortened(table(spark, d, "splits").select("species").where("species IS NOT NULL").distinct(), "species", 12)


@query("""SELECT internal_id FROM plants WHERE lower(trim(scientific_name)) IN (SELECT lower(trim(matched_as)) FROM name_answers WHERE matched_as IS NOT NULL UNION SELECT 'hicella sananus') ORDER BY internal_id LIMIT 60""")
def prd10_selected_plants(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "name_answers").select(F.col("matched_as").alias("value")).where("value IS NOT NULL")
    return catalog.selected(table(spark, d, "plants"), "internal_id", ["hicella sananus"], listed, 60).select("internal_id")


@query("SELECT taxon_rank, count(*) AS n FROM name_answers WHERE taxon_rank IN ('species', 'hybrid') GROUP BY 1")
def prd13_class_ranks(spark: SparkSession, d: str) -> DataFrame:
    return catalog.of_class_rank(table(spark, d, "name_answers"), "taxon_rank").groupBy("taxon_rank").agg(F.count("*").alias("n"))


@query("SELECT seq, CASE WHEN seq % 7 = 0 THEN false ELSE seq % 9 <> 1 END AS turned FROM records")
def prd14_needs_rewrite(spark: SparkSession, d: str) -> DataFrame:
    orientation = F.when(F.col("seq") % 7 != 0, F.col("seq") % 9)  # the table does not know it
    return table(spark, d, "records").select("seq", scalars.needs_rewrite(orientation).alias("turned"))


@query("SELECT p.internal_id AS id, CASE WHEN scientific_name IN (SELECT species FROM records) THEN scientific_name WHEN replace(scientific_name, '×', 'x') IN (SELECT species FROM records) THEN replace(scientific_name, '×', 'x') WHEN trim(regexp_replace(replace(scientific_name, '×', ' '), '\\s+', ' ', 'g')) IN (SELECT species FROM records) THEN trim(regexp_replace(replace(scientific_name, '×', ' '), '\\s+', ' ', 'g')) END AS name FROM plants p")
def src15_first_category(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "plants").select(F.col("internal_id").alias("id"), "scientific_name")
    return catalog.first_existing(asked, names.title_variants("scientific_name"), table(spark, d, "records").select(F.col("species").alias("name")))


@query("SELECT source, row_number() OVER (ORDER BY CASE WHEN source LIKE '%page%' THEN 0 WHEN source LIKE '%note%' THEN 1 ELSE 2 END, source) AS place FROM (SELECT DISTINCT source FROM documents WHERE source NOT LIKE '%herb%') QUALIFY place <= 6")
def top01_ranked_categories(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "documents").select(F.col("source").alias("name"), F.col("source").alias("pos")).distinct()
    out = catalog.ranked_categories(own, 6, ["page", "note"], ["herb"])
    rank = F.when(F.col("name").contains("page"), 0).when(F.col("name").contains("note"), 1).otherwise(2)
    return out.select(F.col("name").alias("source"), F.row_number().over(Window.orderBy(rank, "pos")).alias("place"))  # six rows


@query("SELECT id, part FROM (SELECT internal_id AS id, unnest(list_distinct([internal_id, regexp_replace(internal_id, '(^|-)x-', '\\1'), regexp_replace(regexp_replace(internal_id, '(^|-)x-', '\\1'), '^([^-]*)-', '\\1-x-')])) AS part FROM plants)")
def scl20_id_variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plants").select(F.col("internal_id").alias("id"), F.explode(names.id_variants("internal_id")).alias("part"))


@query("SELECT internal_id, scientific_name AS name FROM plants")
def scl02_canonical_names(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue names are canonical, so they come back as they are, also after dirt is added."""
    dirty = F.concat(F.lit("  "), F.regexp_replace("scientific_name", " ", "  "), F.lit(" (L.) Mill., 1768"))
    return table(spark, d, "plants").select("internal_id", names.canonical_name(dirty).alias("name"))


@query("SELECT internal_id, strip_accents(coalesce(common_fr, '')) AS fr, strip_accents(coalesce(common_de, '')) AS de, strip_accents(coalesce(common_it, '')) AS it FROM plants")
def scl01_folded_accents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plants").select("internal_id", *[names.fold_accents(F.coalesce(f"common_{x}", F.lit(""))).alias(x) for x in ("fr", "de", "it")])


@query("SELECT internal_id, string_agg(v, '|' ORDER BY k) AS titles FROM (SELECT internal_id, v, min(k) AS k FROM (SELECT internal_id, unnest([scientific_name, replace(scientific_name, '×', 'x'), trim(regexp_replace(replace(scientific_name, '×', ' '), '\\s+', ' ', 'g'))]) AS v, unnest([1, 2, 3]) AS k FROM plants) GROUP BY internal_id, v) GROUP BY internal_id")
def scl08_title_variants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plants").select("internal_id", F.array_join(names.title_variants("scientific_name"), "|").alias("titles"))


@query("SELECT answer_id, nullif(trim(regexp_extract(translate(matched_as, '‘’ʻʼʽ′`´', ''''''''''''''''''), '''([^'']+)''', 1)), '') AS cultivar FROM name_answers")
def scl11_cultivars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "name_answers").select("answer_id", names.cultivar("matched_as", F.lit("")).alias("cultivar"))


@query("SELECT doc_id, strftime(fetched_at, '%Y-%m-%dT%H:%M:%SZ') AS at FROM documents")
def scl22_iso_instants(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", scalars.iso_instant("fetched_at").alias("at"))


@query("SELECT answer_id, '\"' || replace(matched_as, '\"', '') || '\"' AS literal FROM name_answers")
def scl27_quoted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "name_answers").select("answer_id", scalars.quoted("matched_as").alias("literal"))


@query("SELECT doc_id, sha256(text) AS sha FROM documents WHERE text IS NOT NULL")
def scl18_sha256(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.sha2(F.encode("text", "utf-8"), 256).alias("sha"))


@query("SELECT DISTINCT n AS id FROM (SELECT internal_id AS n FROM plants UNION SELECT internal_plant_id FROM splits WHERE internal_plant_id <> '')")
def set07_known_classes(spark: SparkSession, d: str) -> DataFrame:
    a, b = table(spark, d, "plants").select(F.col("internal_id").alias("id")), table(spark, d, "splits").select(F.col("internal_plant_id").alias("id")).where("id <> ''")
    return catalog.compare_sets(a, b, "catalogue", "labels", "both").select("id")


@query("SELECT species, n FROM (SELECT species, count(*) AS n FROM records WHERE species IS NOT NULL GROUP BY 1)")
def jn03_resolved_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that a cache (here of names counted before) answers, and the rest asked again, are all there is."""
    counts = table(spark, d, "records").where("species IS NOT NULL").groupBy(F.col("species").alias("name")).agg(F.count("*").alias("n"))
    cache = counts.withColumn("n", F.when(F.xxhash64("name") % 2 == 0, F.col("n")))
    hit, miss = ingest.resolve(counts.select("name"), cache, "n")
    return hit.select("name", "n").unionByName(counts.join(miss, "name", "left_semi")).select(F.col("name").alias("species"), "n")


@query("""WITH n AS (SELECT internal_id AS id, unnest([scientific_name, genus || ' ' || epithet, common_en]) AS name, unnest([0, 1, 2]) AS pos FROM plants),
  r AS (SELECT matched_as AS name, max(answer_id) AS answer_id FROM name_answers WHERE matched_as IS NOT NULL GROUP BY 1)
  SELECT id, arg_min(answer_id, pos) AS answer_id FROM n JOIN r USING (name) GROUP BY id""")
def jn02_first_usable(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "plants").select(F.col("internal_id").alias("id"), F.array("scientific_name", F.concat_ws(" ", "genus", "epithet"), "common_en").alias("names"))
    answers = table(spark, d, "name_answers").where("matched_as IS NOT NULL").groupBy(F.col("matched_as").alias("name")).agg(F.max("answer_id").alias("answer_id"))
    return ingest.first_usable(asked, answers.withColumn("usable", F.lit(True))).select("id", "answer_id")


@query("SELECT species AS asked, min(seq) AS id FROM records r WHERE species IS NOT NULL AND status = 'kept' GROUP BY species")
def prd03_best_taxon(spark: SparkSession, d: str) -> DataFrame:
    """Every species as the service answers it: of its taxa (here the records) the first active one of its own name."""
    r = table(spark, d, "records").where("species IS NOT NULL")
    found = r.select(F.col("species").alias("asked"), F.col("seq").alias("pos"), F.col("seq").alias("id"), F.col("species").alias("name"), F.lit("species").alias("rank"), F.lit("").alias("matched_term"), (F.col("status") == "kept").alias("is_active"))
    return services.best_taxon(found).select("asked", "id")
