"""Queries of de-duplication, resolution, clustering and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.facts import interpretation
from verdant.functions.number import unit_family
from verdant.functions.text import STOPWORDS, metric_key, word_tokens
from verdant.operators import cluster, dedup, resolve, star, vectors
from verdant.plans.catalogue import query
from verdant.plans.facts import _INTERPRETED
from verdant.plans.star import FACTS, OBS
from verdant.sources import read_table


def _facts_by_report(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Facts, deliveries folded inside their report: the one shuffle, by doc_id, serves all groupings that have doc_id among their keys."""
    rows = read_table(spark, folder, "extracted_fact").select("fact_id", "doc_id", *columns).repartition("doc_id")
    return star.once(rows, ["doc_id", "fact_id"], "ingested_at")


def _cascade_rows(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts_by_report(spark, folder, "metric", "value", "unit", "evidence", "decision", "confidence", "chunk_id")
    return facts.withColumn("seq", dedup.running_number(F.col("fact_id")))  # the running number is the order of arrival


def _stage(source: str, keys: str, applies: str) -> str:
    return f"""(SELECT * FROM {source} WHERE NOT ({applies}) UNION ALL SELECT * EXCLUDE (n, every) REPLACE (list_sort(list_filter(every, lambda x: x <> chunk_id)) AS merged) FROM (
 SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY a DESC, b DESC, c DESC, d DESC, e DESC, seq) AS n, list_distinct(flatten(list(list_concat([chunk_id], merged)) OVER (PARTITION BY {keys}))) AS every FROM {source} WHERE {applies}) WHERE n = 1)"""


_CLEAN = "trim(regexp_replace(lower(coalesce({c}, '')), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'))"
_KEY = """array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(regexp_replace(lower(coalesce(metric, '')), '[^a-z% ]+', ' ', 'g'), ' '),
 lambda w: CASE WHEN length(w) > 4 AND suffix(w, 's') THEN left(w, length(w) - 1) ELSE w END), lambda w: w <> ''))), ' ')"""


_SCORED_FACTS = f"""f AS (SELECT fact_id, doc_id, chunk_id, metric, decision, confidence, evidence, period, entity, segment, CAST(regexp_replace(fact_id, '[^0-9]', '', 'g') AS BIGINT) AS seq, CAST([] AS VARCHAR[]) AS merged,
 {_CLEAN.format(c='evidence')} AS s, {_CLEAN.format(c='value')} AS v, {_CLEAN.format(c='unit')} AS u, {_CLEAN.format(c='metric')} AS m, {_KEY} AS k FROM {FACTS}),
g AS (SELECT *, replace(regexp_extract(v, '(-?[0-9][0-9,]*\\.?[0-9]*)', 1), ',', '') AS x, CASE WHEN u IN ('percentage', 'percent', 'per cent', 'pct') THEN '%' ELSE u END AS cu FROM f),
r0 AS (SELECT fact_id, doc_id, chunk_id, seq, merged, s, v, u, m, k, cu, period, evidence, entity, segment, CASE WHEN x = '' THEN v ELSE regexp_replace(regexp_replace(x, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') END AS num,
 CASE decision WHEN 'keep' THEN 3 WHEN 'rescue' THEN 2 WHEN 'drop' THEN 1 ELSE 0 END AS a, CASE WHEN confidence IS NULL OR isnan(confidence) OR NOT confidence BETWEEN 0 AND 1 THEN 0.0 ELSE confidence END AS b,
 CASE WHEN trim(coalesce(metric, '')) = '' THEN 0 ELSE len(list_filter(string_split(k, ' '), lambda w: w <> '')) + CASE WHEN regexp_matches(metric, '[A-Za-z]') THEN 3 ELSE 0 END END AS c, CASE WHEN cu IN ('', '-') THEN 0 ELSE 3 END AS d, -length(coalesce(evidence, '')) AS e FROM g)"""


@query("dedup_cascade", f"""
WITH {_SCORED_FACTS},
r1 AS {_stage('r0', 'doc_id, s, v, u, m', "s <> ''")}, r2 AS {_stage('r1', 'doc_id, s, num, cu', "s <> ''")},
r3 AS {_stage('r2', 'doc_id, s, num', "s <> '' AND len(regexp_extract_all(s, '[0-9][0-9,]*[.]?[0-9]*')) = 1")}, r4 AS {_stage('r3', 'doc_id, k, num, cu', "k <> ''")}
SELECT fact_id, doc_id, chunk_id, array_to_string(merged, ',') AS merged FROM r4""")
def dedup_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup_cascade(_cascade_rows(spark, folder)).select("fact_id", "doc_id", "chunk_id", F.array_join("merged", ",").alias("merged"))


def _bound(column: str) -> str:
    return f"CASE WHEN {_CLEAN.format(c=column)} IN ('', '-') THEN 0 ELSE 1 END"


@query("anchored_facts", f"""
WITH {_SCORED_FACTS}, x AS (SELECT *, coalesce(evidence, '') AS s2 FROM r0), {_INTERPRETED.format(source='x', text='s2')},
w AS (SELECT fact_id, greatest({_bound('entity')}, {_bound('segment')}) AS spec, k, doc_id, num, cu, period, kind, first, second, {_CLEAN.format(c='entity')} AS en, {_CLEAN.format(c='segment')} AS sg, a, b, c, d, e, seq FROM z),
r AS (SELECT *, max(spec) OVER (PARTITION BY doc_id, k, num, cu, period, kind, first, second) AS most, row_number() OVER (PARTITION BY doc_id, k, num, cu, period, kind, first, second, en, sg, spec ORDER BY a DESC, b DESC, c DESC, d DESC, e DESC, seq) AS n FROM w)
SELECT fact_id, spec = 1 AS specific FROM r WHERE n = 1 AND spec = most""")
def anchored_facts(spark: SparkSession, folder: str) -> DataFrame:
    """One fact for each anchor: report, metric words, value, unit, period and what the evidence says of a change; facts bound to an entity or segment go first."""
    facts = _facts_by_report(spark, folder, "metric", "value", "unit", "period", "entity", "segment", "evidence", "decision", "confidence")
    said = interpretation(F.col("evidence"))
    keys = {
        "k0": F.col("doc_id"), "k1": metric_key(F.col("metric")), "k2": dedup.clean_number(F.col("value")), "k3": dedup.clean_unit(F.col("unit")), "k4": F.col("period"),
        "k5": said["kind"], "k6": said["first"], "k7": said["second"],
    }
    score = dedup.fact_score(F.col("decision"), F.col("confidence"), F.col("metric"), F.col("unit"), F.col("evidence"))
    ordered = facts.withColumn("seq", dedup.running_number(F.col("fact_id")))
    return dedup.anchored(ordered, keys, ["entity", "segment"], score, "seq", "fact_id").withColumnRenamed("record", "fact_id")


_CL = "trim(regexp_replace(lower(coalesce({c}, '')), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'))"


@query("exact_duplicate_facts", f"""
SELECT doc_id, count(*) AS members, count(DISTINCT chunk_id) AS chunks, min(fact_id) AS first FROM {FACTS}
GROUP BY doc_id, {_CL.format(c='metric')}, {_CL.format(c='value')}, {_CL.format(c='unit')}, {_CL.format(c='evidence')} HAVING count(*) > 1""")
def exact_duplicate_facts(spark: SparkSession, folder: str) -> DataFrame:
    keys = {f"k{i}": dedup.clean(F.col(c)) for i, c in enumerate(("metric", "value", "unit", "evidence"))}
    rows = star.facts(spark, folder).select("doc_id", "fact_id", "chunk_id", *(v.alias(n) for n, v in keys.items()))
    grouped = rows.groupBy("doc_id", *keys).agg(F.count(F.lit(1)).alias("members"), F.count_distinct("chunk_id").alias("chunks"), F.min("fact_id").alias("first"))
    return grouped.where("members > 1").select("doc_id", "members", "chunks", "first")


@query("dedup_by_canonical", f"""
SELECT obs_id, source_doc_id, canonical_id, period_label, raw_value, members FROM (
 SELECT *, count(*) OVER w2 AS members, row_number() OVER (PARTITION BY source_doc_id, canonical_id, period_label, raw_value ORDER BY CASE normalization_status WHEN 'normalized' THEN 0 WHEN 'partial' THEN 1 ELSE 2 END, obs_id) AS n
 FROM {OBS} WHERE canonical_id IS NOT NULL WINDOW w2 AS (PARTITION BY source_doc_id, canonical_id, period_label, raw_value)) WHERE n = 1""")
def dedup_by_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup_by_canonical(star.observations(spark, folder), {"normalized": 0, "partial": 1})


@query("dedup_by_canonical_chunks", f"""
WITH r AS (SELECT *, row_number() OVER w AS n, count(*) OVER g AS members FROM {OBS} WHERE canonical_id IS NOT NULL
 WINDOW g AS (PARTITION BY source_doc_id, canonical_id, period_label, raw_value), w AS (PARTITION BY source_doc_id, canonical_id, period_label, raw_value ORDER BY CASE normalization_status WHEN 'normalized' THEN 0 WHEN 'partial' THEN 1 ELSE 2 END, obs_id))
SELECT min(obs_id) FILTER (n = 1) AS obs_id, source_doc_id, canonical_id, period_label, raw_value, count(*) AS members, coalesce(array_to_string(list_sort(list_distinct(list(chunk_id) FILTER (n > 1 AND trim(coalesce(chunk_id, '')) <> ''))), ','), '') AS merged FROM r GROUP BY source_doc_id, canonical_id, period_label, raw_value""")
def dedup_by_canonical_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """dedup_by_canonical with `merged`, the chunk ids of the rows replaced."""
    kept = dedup.dedup_by_canonical(star.observations(spark, folder), {"normalized": 0, "partial": 1}, "chunk_id")
    return kept.withColumn("merged", F.array_join("merged", ","))


@query("renumbered_candidates", f"""
WITH f AS (SELECT chunk_id, min(fact_id) AS fact_id FROM {FACTS} GROUP BY chunk_id, {_CL.format(c='evidence')}, {_CL.format(c='value')}, {_CL.format(c='unit')})
SELECT chunk_id, fact_id, 'c' || lpad(CAST(row_number() OVER (PARTITION BY chunk_id ORDER BY fact_id) AS VARCHAR), 3, '0') AS candidate FROM f""")
def renumbered_candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.facts(spark, folder).select("chunk_id", "fact_id", "evidence", "value", "unit")
    return dedup.renumber_candidates(rows, "chunk_id", [dedup.clean(F.col(c)) for c in ("evidence", "value", "unit")], "fact_id")


@query("unique_section_ids", """
WITH s AS (SELECT *, lower(trim(coalesce(section_title, ''))) AS name FROM (SELECT DISTINCT doc_id, section_id, section_title FROM report_section)),
c AS (SELECT *, count(*) OVER (PARTITION BY name) AS n, row_number() OVER (PARTITION BY name ORDER BY section_id) AS k FROM s)
SELECT section_id, CASE WHEN n = 1 THEN name ELSE name || '_' || regexp_replace(lower(doc_id), '[^a-z0-9]+', '-', 'g') || '_' || k END AS unique_id FROM c""")
def unique_section_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "report_section").select("doc_id", "section_id", F.lower(F.trim(F.coalesce("section_title", F.lit("")))).alias("name")).distinct()
    return dedup.distinct_ids(rows, "name", "doc_id", "section_id").select("section_id", "unique_id")


@query("alias_join", f"""
WITH a AS (SELECT key, min(canonical_id) AS canonical_id FROM (SELECT canonical_id, lower(trim(unnest(list_concat([display_name, canonical_id], aliases)))) AS key FROM consumer_master_registry_v1) GROUP BY key)
SELECT f.fact_id, a.canonical_id FROM {FACTS} f LEFT JOIN a ON lower(trim(f.metric)) = a.key""")
def alias_join(spark: SparkSession, folder: str) -> DataFrame:
    aliases = resolve.alias_map(read_table(spark, folder, "consumer_master_registry_v1"))
    return resolve.by_alias(read_table(spark, folder, "extracted_fact").select("fact_id", "metric").distinct(), "metric", aliases).select("fact_id", "canonical_id")


_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_TOK = "list_filter(regexp_extract_all(lower({c}), '[a-z0-9]+'), lambda w: w NOT IN (" + _STOP + "))"


@query("idf_weights", f"""
WITH d AS (SELECT DISTINCT metric FROM extracted_fact WHERE metric IS NOT NULL), n AS (SELECT count(*) AS n FROM d),
t AS (SELECT unnest(list_distinct({_TOK.format(c='metric')})) AS token FROM d)
SELECT token, count(*) AS df, round(ln((1 + max(n.n)) / (1 + count(*))) + 1, 8) AS idf FROM t, n GROUP BY token""")
def idf_weights(spark: SparkSession, folder: str) -> DataFrame:
    texts = read_table(spark, folder, "extracted_fact").select("metric").where("metric is not null").distinct()
    return resolve.idf_weights(texts, word_tokens(F.col("metric"))).withColumn("idf", F.round("idf", 8))


@query("hashed_tfidf_top3", f"""
WITH q AS (SELECT DISTINCT metric AS k, metric AS t FROM extracted_fact WHERE metric IS NOT NULL), e AS (SELECT canonical_id AS k, display_name AS t FROM consumer_master_registry_v1),
v AS (SELECT src, k, CAST('0x' || right(md5(tok), 3) AS INT) % 512 AS slot, count(*)::DOUBLE AS x FROM (
  SELECT 'q' AS src, k, unnest({_TOK.format(c='t')}) AS tok FROM q UNION ALL SELECT 'e', k, unnest({_TOK.format(c='t')}) FROM e) GROUP BY ALL),
u AS (SELECT src, k, slot, x / sqrt(sum(x * x) OVER (PARTITION BY src, k)) AS w FROM v),
s AS (SELECT a.k AS metric, b.k AS canonical_id, round(sum(a.w * b.w), 6) AS score FROM u a JOIN u b ON a.slot = b.slot AND a.src = 'q' AND b.src = 'e' GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS rank, round(score - lead(score, 1, 0) OVER w, 6) AS margin FROM s WINDOW w AS (PARTITION BY metric ORDER BY score DESC, canonical_id))
SELECT metric, canonical_id, score, rank, margin FROM r WHERE rank <= 3""")
def hashed_tfidf_top3(spark: SparkSession, folder: str) -> DataFrame:
    names = read_table(spark, folder, "extracted_fact").select("metric").where("metric is not null").distinct()
    registry = read_table(spark, folder, "consumer_master_registry_v1")
    q = resolve.hashed_vectors(names, "metric", "metric")
    e = resolve.hashed_vectors(registry, "canonical_id", "display_name")
    return resolve.top_matches(q, e, "metric", "canonical_id", 3)


@query("match_decisions", f"""
SELECT verdict, count(*) AS n FROM (SELECT metric, CASE WHEN score >= 0.65 AND margin >= 0.2 THEN 'accept' WHEN score >= 0.65 THEN 'review' ELSE 'none' END AS verdict
FROM (SELECT DISTINCT metric AS m FROM extracted_fact WHERE metric IS NOT NULL) LEFT JOIN (%s) ON metric = m AND rank = 1) GROUP BY ALL""")
def match_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """How many metrics are decided which way; those that share no word with an entry are none."""
    metrics = read_table(spark, folder, "extracted_fact").select("metric").where("metric is not null").distinct()
    top = metrics.join(hashed_tfidf_top3(spark, folder).where("rank = 1"), "metric", "left")
    return top.groupBy(resolve.accept(F.col("score"), F.col("margin")).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


@query("embedding_neighbours", """
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS len FROM n),
s AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, round(list_dot_product(a.e, b.e) / (a.len * b.len), 5) + 0.0 AS score FROM u a JOIN u b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query, neighbour, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour) AS rank FROM s) WHERE rank <= 5""")
def embedding_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    return vectors.nearest(rows, rows.where("vec_id % 20 = 0"), "vec_id", "embedding", 5)


def _provisional(spark: SparkSession, folder: str) -> DataFrame:
    """Names of new metrics: one row per name and company, with unit family and words."""
    new = star.observations(spark, folder, "normalization_status = 'new_metric' and company_id is not null and raw_name is not null")
    rows = new.groupBy(metric_key(F.col("raw_name")).alias("name"), "company_id").agg(F.min(unit_family(F.col("raw_unit_string"))).alias("family"))
    return rows.where("name <> ''").withColumns({"id": F.concat_ws("|", "company_id", "name"), "tokens": F.split("name", " ")})


@query("blocked_pairs", "")
def blocked_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return cluster.blocked_pairs(_provisional(spark, folder), "id", "company_id", "family", "tokens", 0.6).withColumn("jaccard", F.round("jaccard", 6))


def _clusters(spark: SparkSession, folder: str) -> DataFrame:
    names = _provisional(spark, folder)
    pairs = cluster.blocked_pairs(names, "id", "company_id", "family", "tokens", 0.6)
    return names.join(cluster.connected_components(names.select("id"), pairs), "id")


@query("provisional_clusters", "")
def provisional_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _clusters(spark, folder).select("id", "component")


@query("cluster_recurrence", "")
def cluster_recurrence(spark: SparkSession, folder: str) -> DataFrame:
    g = _clusters(spark, folder).groupBy("component").agg(F.count_distinct("company_id").alias("recurrence"), F.count(F.lit(1)).alias("members"), F.max_by("name", F.struct(F.length("name"), "name")).alias("label"))
    action = F.when(F.col("recurrence") >= 3, "promote").when(F.col("recurrence") == 2, "watch").otherwise("keep")
    return g.withColumn("action", action)


@query("name_similarity")
def name_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence ratio of each observation's name with the display name of its metric."""
    from verdant.functions.similarity import sequence_ratio_udf

    names = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "display_name")
    obs = read_table(spark, folder, "observation").select("raw_name", "canonical_id").where("canonical_id is not null").distinct()
    return obs.join(names, "canonical_id").withColumn("ratio", F.round(sequence_ratio_udf("raw_name", "display_name"), 6)).drop("display_name")


def _fill_statements() -> None:
    """Statements built on others: the pairs, and the components of their graph by a recursive query."""
    from verdant.functions.number import UNIT_FAMILIES
    from verdant.plans.catalogue import _ORACLES
    from verdant.plans.scalars import _case

    key = """array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(regexp_replace(lower(coalesce(raw_name, '')), '[^a-z% ]+', ' ', 'g'), ' '),
 lambda w: CASE WHEN length(w) > 4 AND suffix(w, 's') THEN left(w, length(w) - 1) ELSE w END), lambda w: w <> ''))), ' ')"""
    family = _case("trim(coalesce(raw_unit_string, ''))", UNIT_FAMILIES, "'unknown'")
    names = f"""p AS (SELECT name, company_id, min(family) AS family, company_id || '|' || name AS id, string_split(name, ' ') AS tokens FROM (
 SELECT {key} AS name, company_id, {family} AS family FROM {OBS} WHERE normalization_status = 'new_metric' AND company_id IS NOT NULL AND raw_name IS NOT NULL) WHERE name <> '' GROUP BY name, company_id)"""
    pairs = """e AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.tokens, b.tokens)) / len(list_distinct(list_concat(a.tokens, b.tokens))) AS jaccard
 FROM p a JOIN p b ON a.family = b.family AND a.company_id <> b.company_id AND a.id < b.id AND list_has_any(a.tokens, b.tokens))"""
    reach = """g AS (SELECT a, b FROM e WHERE jaccard >= 0.6 - 1e-12 UNION SELECT b, a FROM e WHERE jaccard >= 0.6 - 1e-12),
c AS (SELECT id, id AS seen FROM p UNION SELECT c.id, g.b FROM c JOIN g ON c.seen = g.a), k AS (SELECT id, min(seen) AS component FROM c GROUP BY id)"""
    _ORACLES["blocked_pairs"] = f"WITH {names}, {pairs} SELECT a, b, round(jaccard, 6) AS jaccard FROM e WHERE jaccard >= 0.6 - 1e-12"
    _ORACLES["provisional_clusters"] = f"WITH RECURSIVE {names}, {pairs}, {reach} SELECT id, component FROM k"
    _ORACLES["cluster_recurrence"] = f"""WITH RECURSIVE {names}, {pairs}, {reach} SELECT component, count(DISTINCT company_id) AS recurrence, count(*) AS members, arg_max(name, (length(name), name)) AS label,
 CASE WHEN count(DISTINCT company_id) >= 3 THEN 'promote' WHEN count(DISTINCT company_id) = 2 THEN 'watch' ELSE 'keep' END AS action FROM k JOIN p USING (id) GROUP BY component"""
    _ORACLES["match_decisions"] = _ORACLES["match_decisions"] % _ORACLES["hashed_tfidf_top3"]


_fill_statements()
