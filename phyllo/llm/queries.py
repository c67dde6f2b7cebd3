"""Queries of the operators for training data, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phyllo.llm import bpe, cross_split, eval_leaks, grouped_splits, keyword_spam, name_matching, quota_sample, survivors
from phyllo.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return grouped_splits.record_groups(table(spark, d, "records"))


def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    return grouped_splits.assign_splits(table(spark, d, "records"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return name_matching.match_names(table(spark, d, "name_answers"), table(spark, d, "plants"))


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return name_matching.unmatched(table(spark, d, "name_answers"), table(spark, d, "plants"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.overlap_pairs(table(spark, d, "records"), table(spark, d, "splits"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.overlap_report(table(spark, d, "records"), table(spark, d, "splits"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.exhausted(table(spark, d, "records"), table(spark, d, "sample_targets"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.report(table(spark, d, "records"), table(spark, d, "sample_targets"))


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.sample(table(spark, d, "records"), table(spark, d, "sample_targets"))


def p5_quotas(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.drawn(table(spark, d, "records"), table(spark, d, "sample_targets"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = survivors.survivors(table(spark, d, "records"), table(spark, d, "sources"))
    return found.where("best_seq IS NOT NULL").select("first_seq", "best_seq")


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivors.build_survivors(table(spark, d, "records"), table(spark, d, "sources"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The round trip: every text, encoded and decoded again."""
    return bpe.decode(bpe.encode(table(spark, d, "documents"))).select("doc_id", "text")


def _names(spark: SparkSession, d: str) -> DataFrame:
    """Genera and epithets of the catalogue, which stand for names in templates."""
    return table(spark, d, "plants").select(F.explode(F.split("scientific_name", "[^\\p{L}-]+")).alias("name")).where("name NOT IN ('', 'x', 'var')").distinct()


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    found = eval_leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), _names(spark, d))
    return found.select("doc_id", "item_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return eval_leaks.leak_report(table(spark, d, "documents"), table(spark, d, "eval_items"), _names(spark, d))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return keyword_spam.spam(table(spark, d, "documents")).select("doc_id")


def p9_measures(spark: SparkSession, d: str) -> DataFrame:
    return keyword_spam.measure(table(spark, d, "documents"))


QUERIES = {
    "p2_found": p2_found, "p2_splits": p2_splits,
    "p3_found": p3_found, "p3_unmatched": p3_unmatched,
    "p4_found": p4_found, "p4_report": p4_report,
    "p5_found": p5_found, "p5_report": p5_report, "p5_sample": p5_sample, "p5_quotas": p5_quotas,
    "p6_found": p6_found, "p6_survivors": p6_survivors,
    "p7_ids": p7_ids, "p7_decoded": p7_decoded,
    "p8_found": p8_found, "p8_report": p8_report,
    "p9_found": p9_found, "p9_measures": p9_measures,
}

# --- SQL ---------------------------------------------------------------------------------------------------------------

_STATED = r"regexp_matches(coalesce({0}, ''), '[^\s\p{{Z}}]')"
_HASH = "CASE WHEN regexp_matches(trim(phash), '^[0-9A-Fa-f]{16}$') THEN CAST('0x' || trim(phash) AS UBIGINT) END"
_NO_NAME = ", ".join(f"'{x}'" for x in sorted(grouped_splits.NO_NAME))
_AUTHOR = r"array_to_string(list_sort(list_filter(string_split_regex(strip_accents(lower(regexp_replace(author, '©|\(c\)', ' ', 'gi'))), '[^\p{L}\p{N}]+'), lambda x: x <> '')), ' ')"
_EDGES = rf"""rec AS (SELECT seq, CASE WHEN {_STATED.format("observation_id")} THEN source || '|' || trim(observation_id) END AS k0, species || '|' || a AS k1
    FROM (SELECT seq, source, observation_id, species, CASE WHEN regexp_matches({_AUTHOR}, '\p{{L}}') AND {_AUTHOR} NOT IN ({_NO_NAME}) THEN {_AUTHOR} END AS a FROM records)),
  hub AS (SELECT seq, min(seq) OVER (PARTITION BY k) AS h FROM (SELECT seq, 'o' || k0 AS k FROM rec WHERE k0 IS NOT NULL UNION ALL SELECT seq, 'a' || k1 FROM rec WHERE k1 IS NOT NULL)),
  edge AS (SELECT seq AS a, h AS b FROM hub WHERE seq <> h UNION SELECT h, seq FROM hub WHERE seq <> h)"""
_NEED = "greatest(coalesce(min_rows, 0), (coalesce(share_permille, 0) * coalesce(sample_rows, 0) + 999) // 1000)"
_AVAILABLE = f"""SELECT t.target_id, t.draw_id, {_NEED} AS need, (SELECT count(DISTINCT r.source_id) FROM records r
    WHERE r.status = 'kept' AND r.species = t.species AND r.source = t.source
      AND t.captive = CAST(coalesce(lower(trim(r.extra['captive'])) IN ('true', 'yes', 'y', 't', '1', 'on'), false) AS INTEGER)) AS available
  FROM sample_targets t"""
_SIDES = f"""side AS (SELECT r.seq, r.source, lower(r.checksum) AS c, {_HASH} AS h, s.tr, s.val, s.test
    FROM records r JOIN (SELECT path, bool_or(split = 'train') AS tr, bool_or(split = 'val') AS val, bool_or(split = 'test') AS test FROM splits GROUP BY path) s USING (path)),
  pair AS (SELECT e.seq AS e, t.seq AS t, e.source, e.val, e.test, coalesce(e.c = t.c, false) AS exact FROM side e JOIN side t
    ON (e.val OR e.test) AND t.tr AND e.seq <> t.seq AND (e.c = t.c OR bit_count(xor(e.h, t.h)) <= 6))"""

SQL: dict[str, str] = {
    "p2_found": f"""WITH RECURSIVE {_EDGES},
  reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
  SELECT a AS seq, min(b) AS first_seq FROM reach GROUP BY a""",
    "p4_found": f"WITH {_SIDES} SELECT DISTINCT least(e, t) AS seq_a, greatest(e, t) AS seq_b FROM pair",
    "p4_report": f"""WITH {_SIDES}, named AS (SELECT 'val' AS split, * FROM pair WHERE val UNION ALL SELECT 'test', * FROM pair WHERE test)
  SELECT split, source, count(*) AS n_pairs, CAST(sum(CAST(exact AS INTEGER)) AS BIGINT) AS n_exact, count(DISTINCT e) AS n_records FROM named GROUP BY split, source""",
    "p5_found": f"SELECT target_id FROM ({_AVAILABLE}) WHERE available < need",
    "p5_report": f"""SELECT target_id, draw_id, need, available, least(need, available) AS taken, greatest(need - available, 0) AS short, available < need AS exhausted
  FROM ({_AVAILABLE})""",
    "p5_quotas": f"""WITH asked AS (SELECT target_id, draw_id, greatest(coalesce(share_permille, 0), 0) AS s, greatest(coalesce(min_rows, 0), 0) AS m, coalesce(sample_rows, 0) AS z FROM sample_targets),
  ranked AS (SELECT *, row_number() OVER w AS n, z - (sum(m) OVER w - m) AS rows, sum(s) OVER (PARTITION BY draw_id) - (sum(s) OVER w - s) AS parts, sum(m) OVER (PARTITION BY draw_id) >= z AS only_least
    FROM asked WINDOW w AS (PARTITION BY draw_id ORDER BY CASE WHEN s = 0 THEN 'infinity'::DOUBLE ELSE m / s END DESC, target_id ROWS UNBOUNDED PRECEDING)),
  scaled AS (SELECT *, CASE WHEN rows * 1000 > parts * z THEN z ELSE rows END AS a, CASE WHEN rows * 1000 > parts * z THEN 1000 ELSE parts END AS b FROM ranked),
  cut AS (SELECT draw_id, min(n) AS n FROM scaled WHERE s > 0 AND a * s >= m * b AND NOT only_least GROUP BY draw_id),
  common AS (SELECT x.draw_id, x.n AS first, x.a, x.b, x.parts FROM scaled x JOIN cut USING (draw_id, n)),
  based AS (SELECT r.target_id, r.draw_id, r.m, r.n >= c.first AS free, CAST(c.a * r.s AS BIGINT) // CAST(c.b AS BIGINT) AS base, CAST(c.a * r.s AS BIGINT) % CAST(c.b AS BIGINT) AS left_over,
      CAST(c.a * c.parts AS BIGINT) // CAST(c.b AS BIGINT) AS total FROM ranked r LEFT JOIN common c USING (draw_id)),
  spared AS (SELECT *, total - sum(base) OVER (PARTITION BY draw_id, free) AS spare, row_number() OVER (PARTITION BY draw_id, free ORDER BY left_over DESC, target_id) AS place FROM based),
  quota AS (SELECT target_id, draw_id, CAST(CASE WHEN coalesce(free, false) THEN base + CAST(place <= spare AS INTEGER) ELSE m END AS BIGINT) AS quota FROM spared)
  SELECT target_id, q.draw_id, quota, least(quota, available) AS drawn, greatest(quota - available, 0) AS short FROM quota q JOIN ({_AVAILABLE}) x USING (target_id)""",
    "p7_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p6_found": f"""WITH RECURSIVE rec AS (SELECT r.seq, lower(r.checksum) AS c, {_HASH} AS h, r.status = 'kept' AS kept, coalesce(s.trust_rank, 2147483647) AS trust,
      {_STATED.format("r.license")} AS licensed, greatest(coalesce(r.width, 0), 0) AS width, coalesce(TRY_CAST(nullif(trim(r.downloaded_at), '') AS TIMESTAMPTZ), TIMESTAMPTZ '0001-01-01 00:00:00+00') AS at
    FROM records r LEFT JOIN sources s USING (source)),
  edge AS (SELECT a.seq AS a, b.seq AS b FROM rec a JOIN rec b ON a.seq <> b.seq AND (a.c = b.c OR bit_count(xor(a.h, b.h)) <= 6)),
  reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
  member AS (SELECT a AS seq, min(b) AS first_seq FROM (SELECT a, b FROM reach UNION SELECT a, a FROM reach) GROUP BY a),
  m AS (SELECT first_seq, rec.* FROM member JOIN rec USING (seq))
  SELECT x.first_seq, x.seq AS best_seq FROM m x WHERE NOT EXISTS (SELECT 1 FROM m y WHERE y.first_seq = x.first_seq AND y.seq <> x.seq AND NOT (
    x.kept >= y.kept AND x.trust <= y.trust AND x.licensed >= y.licensed AND x.width >= y.width AND x.at >= y.at
    AND (x.kept > y.kept OR x.trust < y.trust OR x.licensed > y.licensed OR x.width > y.width OR x.at > y.at)))""",
}
