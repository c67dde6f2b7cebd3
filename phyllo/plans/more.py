"""Further queries: set algebra, services, resolution, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phyllo.functions import names
from phyllo.operators import catalog, evaluate, features, ingest, services, splits
from phyllo.plans import curation, evaluation
from phyllo.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT internal_id FROM plants WHERE genus = 'Hicella' UNION SELECT internal_id FROM plants WHERE family = 'Paroraceae'")
def set01_union(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plants")
    return p.where("genus = 'Hicella'").select("internal_id").union(p.where("family = 'Paroraceae'").select("internal_id")).distinct()


@query("SELECT internal_id FROM plants WHERE internal_id IN (SELECT internal_plant_id FROM splits)")
def set02_intersection(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plants")
    return p.join(table(spark, d, "splits").select(F.col("internal_plant_id").alias("internal_id")), "internal_id", "left_semi").select("internal_id")


@query("SELECT internal_id FROM plants EXCEPT SELECT internal_plant_id FROM records")
def set03_difference(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plants").select("internal_id").subtract(table(spark, d, "records").select("internal_plant_id"))


@query("SELECT seq, path, species, CASE WHEN seq % 2 = 0 THEN status END AS status FROM records")
def set05_shards_merged(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "records")
    return ingest.merge_manifests([r.where("seq % 2 = 0").select("seq", "path", "species", "status"), r.where("seq % 2 = 1").select("species", "seq", "path")])


@query("""WITH a AS (SELECT matched_as AS name, answer_id % 3 AS shard, max(answer_id) AS answer_id FROM name_answers WHERE matched_as IS NOT NULL GROUP BY ALL)
  SELECT name, arg_max(answer_id, shard) AS answer_id FROM a GROUP BY name""")
def set06_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Each third of the answers is the cache of one shard: name to its last answer."""
    own = table(spark, d, "name_answers").where("matched_as IS NOT NULL")
    shards = [own.where(f"answer_id % 3 = {i}").groupBy(F.col("matched_as").alias("name")).agg(F.max("answer_id").alias("answer_id")) for i in range(3)]
    return ingest.merge_caches(shards)


_FIRST = "SELECT asked_by, arg_min(match_type, answer_id) AS match_type FROM (SELECT * FROM name_answers WHERE match_type IS NOT NULL) GROUP BY asked_by"


@query(_FIRST)
def src17_first_binding(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "name_answers").where("match_type IS NOT NULL").withColumn("seq", F.col("answer_id"))
    return services.first_bindings(rows, "asked_by", "match_type")


@query("SELECT p.scientific_name AS species, coalesce((SELECT CAST(count(*) AS BIGINT) FROM records r WHERE r.species = p.scientific_name AND r.license IN ('CC0 1.0', 'CC BY 4.0') HAVING count(*) > 0), -1) AS n FROM plants p")
def src18_counts_over_codes(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "plants").select(F.col("scientific_name").alias("species"))
    codes = table(spark, d, "records").where(F.col("license").isin("CC0 1.0", "CC BY 4.0")).groupBy("species", "license").agg(F.count("*").alias("n"))
    return services.counts_over_codes(asked, codes)


@query("SELECT answer_id, coalesce(upper(taxon_rank) IN ('SPECIES', 'SUBSPECIES', 'VARIETY', 'FORM') AND (match_type = 'EXACT' OR (match_type = 'FUZZY' AND confidence >= 95)), false) AS usable FROM name_answers")
def prd02_usable(spark: SparkSession, d: str) -> DataFrame:
    from phyllo.operators.ingest import taxon_usable

    c = F.col
    return table(spark, d, "name_answers").select("answer_id", taxon_usable(c("taxon_rank"), c("match_type"), c("confidence")).alias("usable"))


@query("SELECT seq, CASE WHEN extra['format'] IS NULL THEN 'unreadable' WHEN extra['format'] <> 'image/jpeg' THEN 'format' WHEN seq % 50 = 0 THEN 'animated' WHEN least(width, height) < 320 THEN 'too small' WHEN greatest(width, height) > 12.0 * least(width, height) THEN 'too narrow' END AS verdict FROM records")
def prd08_image_verdict(spark: SparkSession, d: str) -> DataFrame:
    from phyllo.functions.scalars import image_verdict

    form = F.upper(F.element_at(F.split(F.try_element_at("extra", F.lit("format")), "/"), -1))
    frames = F.when(F.col("seq") % 50 == 0, 2).otherwise(1)  # the table does not know them
    return table(spark, d, "records").select("seq", image_verdict(form, frames, F.col("width"), F.col("height")).alias("verdict"))


@query(f"WITH {evaluation._P}, {evaluation._read()} SELECT key AS image_id, CASE WHEN best < 0.10 THEN 'no candidate' WHEN best >= 0.14 AND best - second >= 0.01 THEN 'accepted' ELSE 'uncertain' END AS verdict FROM rd")
def prd12_verdict(spark: SparkSession, d: str) -> DataFrame:
    r = evaluate.read(evaluation.probs(spark, d), keep=("image_id",))
    return r.select("image_id", services.verdict(F.col("best"), F.col("second"), 0.10, 0.14, 0.01).alias("verdict"))


@query(f"""WITH l AS (SELECT DISTINCT internal_plant_id AS id FROM splits WHERE internal_plant_id <> ''),
  a AS (SELECT alias, min(internal_id) AS via FROM (SELECT internal_id AS alias, internal_id FROM plants UNION ALL {curation._ALIAS}) WHERE internal_id IN (FROM l) GROUP BY alias),
  x AS (SELECT internal_id, CASE WHEN internal_id IN (FROM l) THEN internal_id END AS direct, via, CASE WHEN len(string_split(internal_id, '-')) = 2 AND replace(internal_id, '-', '-x-') IN (FROM l) THEN replace(internal_id, '-', '-x-') END AS crossed
    FROM plants LEFT JOIN a ON alias = internal_id)
  SELECT internal_id AS asked, coalesce(direct, via, crossed) AS label, CASE WHEN direct IS NOT NULL THEN 'direct' WHEN via IS NOT NULL THEN 'synonym' WHEN crossed IS NOT NULL THEN 'hybrid' END AS how FROM x""")
def jn10_resolve_labels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plants")
    labels = table(spark, d, "splits").select(F.col("internal_plant_id").alias("class_id")).where("class_id <> ''").distinct()
    out = catalog.resolve_labels(p.select(F.col("scientific_name").alias("name")), labels, catalog.alias_pairs(p))
    return out.select(F.col("id").alias("asked"), "label", "how")


@query("SELECT internal_id, o FROM (SELECT replace(replace(lower(replace(species, '×', 'x')), ' ', '-'), '.', '') AS internal_id, min(seq) AS o FROM records GROUP BY 1) WHERE internal_id NOT IN (SELECT internal_id FROM plants WHERE family = 'Vaduraceae')")
def jn12_register(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "plants").where("family = 'Vaduraceae'")
    found = table(spark, d, "records").groupBy(F.col("species").alias("name")).agg(F.min("seq").alias("o"))
    return catalog.register(have, found, "o").select("internal_id", "o")


_ID = "trim(regexp_replace(lower(replace({0}, '×', 'x')), '[^a-z0-9]+', '-', 'g'), '-')"


@query(f"SELECT DISTINCT species AS id, {_ID.format('species')} AS class_id FROM records WHERE {_ID.format('species')} IN (SELECT internal_id FROM plants WHERE family = 'Paroraceae')")
def jn13_mapped_classes(spark: SparkSession, d: str) -> DataFrame:
    foreign = table(spark, d, "records").select(F.col("species").alias("id"), F.col("species").alias("name")).distinct()
    labels = table(spark, d, "plants").where("family = 'Paroraceae'").select(F.col("internal_id").alias("class_id"))
    return services.mapped_classes(foreign, labels).select("id", "class_id")


@query("SELECT coalesce(license, '?') AS key, 'license' AS kind, count(*) AS n FROM records WHERE source = 'plantnet300k' GROUP BY 1 UNION ALL SELECT '', 'whole', count(*) FROM records r WHERE source = 'plantnet300k' AND license IN ('CC0 1.0', 'CC BY 4.0') AND species IN (SELECT scientific_name FROM plants) UNION ALL SELECT status, 'organ', count(*) FROM records WHERE source = 'plantnet300k' AND license IN ('CC0 1.0', 'CC BY 4.0') AND species IN (SELECT scientific_name FROM plants) GROUP BY status UNION ALL SELECT p.internal_id, 'species', count(*) FROM records r JOIN plants p ON p.scientific_name = r.species WHERE source = 'plantnet300k' AND license IN ('CC0 1.0', 'CC BY 4.0') GROUP BY 1")
def jn14_foreign_counts(spark: SparkSession, d: str) -> DataFrame:
    meta = table(spark, d, "records").where("source = 'plantnet300k'").select(F.col("species").alias("species_id"), "license", F.col("status").alias("organ"))
    mapping = table(spark, d, "plants").select(F.col("scientific_name").alias("id"), F.col("internal_id").alias("class_id"))
    return services.foreign_counts(meta, mapping, ["CC0 1.0", "CC BY 4.0"])


@query("""SELECT count(*) AS names, count(p.internal_id) AS resolved, count(DISTINCT p.internal_id) AS classes, count(*) FILTER (n > 1) AS repeated
  FROM (SELECT species, count(*) AS n FROM records WHERE species IS NOT NULL GROUP BY 1) r LEFT JOIN plants p ON p.scientific_name = r.species""")
def agg23_coverage(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "plants")
    asked = table(spark, d, "records").where("species IS NOT NULL").select(F.col("species").alias("name"))
    return services.coverage(catalog.resolve_labels(asked, p.select(F.col("internal_id").alias("class_id")), catalog.alias_pairs(p)))


@query(f"WITH c AS ({evaluation._THEFT}) SELECT count(*) FILTER (cost <= 0) AS none, count(*) FILTER (cost <= 2) AS two, count(*) FILTER (cost <= 5) AS five, count(*) FILTER (cost <= 20) AS twenty, count(*) FILTER (cost > 20) AS more FROM c")
def agg29_theft_bands(spark: SparkSession, d: str) -> DataFrame:
    c = evaluate.theft_costs(evaluation.probs(spark, d), evaluation.CORE, evaluation.CANDIDATES)
    n = lambda most: F.count_if(F.col("cost") <= most)
    return c.agg(n(0).alias("none"), n(2).alias("two"), n(5).alias("five"), n(20).alias("twenty"), F.count_if(F.col("cost") > 20).alias("more"))


@query("SELECT split, count(*) AS n, count(DISTINCT species) AS species FROM splits WHERE species <> '' GROUP BY split")
def agg30_slice_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "splits").where("species <> ''").groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("species").alias("species"))


@query("SELECT count(DISTINCT species) AS species, count(DISTINCT species) FILTER (species IN (SELECT scientific_name FROM plants)) AS shared, round(count(*) FILTER (license IN ('CC0 1.0', 'CC BY 4.0')) / count(*), 9) AS usable FROM records")
def agg31_overlap_share(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "plants").select(F.col("scientific_name").alias("species"), F.lit(1).alias("k"))
    r = table(spark, d, "records").join(known, "species", "left")
    return r.agg(F.countDistinct("species").alias("species"), F.countDistinct(F.when(F.col("k") == 1, F.col("species"))).alias("shared"), F.round(F.count_if(F.col("license").isin("CC0 1.0", "CC BY 4.0")) / F.count("*"), 9).alias("usable"))


@query("SELECT species, status, count(*) AS n FROM records GROUP BY species, status ORDER BY n DESC, species, status LIMIT 12")
def top04_most_common(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "records").groupBy("species", "status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "species", "status").limit(12)


@query(f"WITH {evaluation._P}, {evaluation._read()} SELECT key AS image_id, CAST(n AS INTEGER) AS rank, CAST(k AS INTEGER) AS class FROM rk WHERE n <= 5")
def top07_five_best(spark: SparkSession, d: str) -> DataFrame:
    rows = evaluation.probs(spark, d).select("image_id", F.posexplode(evaluate.ranked("p", 5)).alias("rank", "x"))
    return rows.select("image_id", (F.col("rank") + 1).alias("rank"), F.col("x.i").cast("int").alias("class"))


@query("SELECT lower(trim(name)) AS name FROM (SELECT DISTINCT coalesce(matched_as, canonical_name) AS name FROM name_answers) WHERE trim(coalesce(name, '')) <> '' GROUP BY 1 HAVING count(*) > 1")
def set09_names_given_twice(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "name_answers").select(F.coalesce("matched_as", "canonical_name").alias("name")).distinct().where("trim(coalesce(name, '')) <> ''")
    return n.groupBy(F.lower(F.trim("name")).alias("name")).agg(F.count("*").alias("n")).where("n > 1").select("name")


@query("SELECT 'wide' AS mask, class_id, class_idx FROM (SELECT internal_id AS class_id, CAST(row_number() OVER (ORDER BY internal_id) - 1 AS INTEGER) AS class_idx, family FROM plants) WHERE family = 'Paroraceae'")
def snk07_sized_masks(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "plants").select(F.col("internal_id").alias("class_id"), (F.row_number().over(Window.orderBy("internal_id")) - 1).alias("class_idx"), "family")
    masks = labels.where("family = 'Paroraceae'").select(F.lit("wide").alias("mask"), "class_id").union(labels.select(F.lit("full"), "class_id")).union(labels.limit(0).select(F.lit("none"), "class_id"))
    return features.sized_masks(labels.drop("family"), masks)


_MASKED = f"mk AS (SELECT image_id, truth, captive, {evaluation._KEPT} AS p FROM prob)"
_TOP1 = "SELECT count(*) FILTER (ok) FROM rd"


@query(f"SELECT (WITH {evaluation._P}, {evaluation._read()} {_TOP1}) - (WITH {evaluation._P}, {_MASKED}, {evaluation._read('p', 'mk')} {_TOP1}) AS top1")
def agg22_cost_of_breadth(spark: SparkSession, d: str) -> DataFrame:
    p = evaluation.probs(spark, d)
    whole = evaluate.tally(evaluate.read(p), 0.2).select("top1").scalar()
    masked = evaluate.tally(evaluate.read(p.withColumn("p", evaluate.masked("p", evaluation.KEPT))), 0.2).select("top1").scalar()
    return spark.range(1).select((whole - masked).alias("top1"))


@query()
def spl09_seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """A replayed draw of positions, joined on the row number of the table's own key."""
    p = table(spark, d, "plants")
    drawn = list(splits.replay_sample(p.count(), 50, 7))
    at = F.row_number().over(Window.orderBy("internal_id")) - 1
    return p.select("internal_id", at.alias("at")).join(F.broadcast(spark.createDataFrame([(i,) for i in drawn], "at int")), "at").select("internal_id", "at")


@query("SELECT internal_id, trim(regexp_replace(replace(lower(scientific_name), '×', ' '), '\\s+', ' ', 'g')) AS comparable FROM plants")
def scl06_comparable(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "plants").select("internal_id", names.comparable("scientific_name").alias("comparable"))
