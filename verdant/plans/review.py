"""Queries of review, audit and context tables, each beside its statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import text
from verdant.operators import resolve, review, star
from verdant.plans.catalogue import query
from verdant.plans.resolution import _TOK
from verdant.plans.rules import alias_gate
from verdant.plans.star import CHUNKS, DOCS, FACTS, LOADED, OBS
from verdant.sources import read_table

_SCORED = f"""q AS (SELECT DISTINCT metric AS k, metric AS t FROM extracted_fact WHERE metric IS NOT NULL), e AS (SELECT canonical_id AS k, display_name AS t FROM consumer_master_registry_v1),
v AS (SELECT src, k, CAST('0x' || right(md5(tok), 3) AS INT) % 512 AS slot, count(*)::DOUBLE AS x FROM (
  SELECT 'q' AS src, k, unnest({_TOK.format(c='t')}) AS tok FROM q UNION ALL SELECT 'e', k, unnest({_TOK.format(c='t')}) FROM e) GROUP BY ALL),
u AS (SELECT src, k, slot, x / sqrt(sum(x * x) OVER (PARTITION BY src, k)) AS w FROM v),
s AS (SELECT a.k AS metric, b.k AS canonical_id, round(sum(a.w * b.w), 6) AS score FROM u a JOIN u b ON a.slot = b.slot AND a.src = 'q' AND b.src = 'e' GROUP BY ALL)"""


def _shortlist(spark: SparkSession, folder: str, most: int) -> DataFrame:
    names = read_table(spark, folder, "extracted_fact").select("metric").where("metric is not null").distinct()
    known = resolve.hashed_vectors(read_table(spark, folder, "consumer_master_registry_v1"), "canonical_id", "display_name")
    return resolve.top_matches(resolve.hashed_vectors(names, "metric", "metric"), known, "metric", "canonical_id", most)


@query("margin_ties", f"""
WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY score DESC, canonical_id) AS place, max(score) OVER (PARTITION BY metric) AS top FROM s)
SELECT metric, canonical_id, score, place FROM r WHERE score >= round(top - 0.20, 9) AND place <= 3""")
def margin_ties(spark: SparkSession, folder: str) -> DataFrame:
    return review.margin_ties(_shortlist(spark, folder, 3).drop("rank", "margin"), "metric", "canonical_id", "score")


@query("definition_audit", f"""
WITH {_SCORED}, b AS (SELECT metric, max(score) AS best FROM s GROUP BY metric)
SELECT count(*) AS metrics, round(avg(best), 6) AS mean, min(best) AS least, round(quantile_cont(best, 0.1), 6) AS p10 FROM b""")
def definition_audit(spark: SparkSession, folder: str) -> DataFrame:
    best = F.col("score")
    return _shortlist(spark, folder, 1).agg(F.count(F.lit(1)).alias("metrics"), F.round(F.avg(best), 6).alias("mean"), F.min(best).alias("least"), F.round(F.percentile(best, F.lit(0.1)), 6).alias("p10"))


@query("ordered_streams", f"""
SELECT fact_id, CASE WHEN contains(lower(coalesce(metric, '')), 'csr') THEN 'financial' WHEN decision = 'keep' THEN 'kept' WHEN decision = 'rescue' THEN 'rescued' ELSE 'dropped' END AS stream,
 CASE WHEN contains(lower(coalesce(metric, '')), 'csr') THEN 0 WHEN decision = 'keep' THEN 1 WHEN decision = 'rescue' THEN 2 ELSE 3 END AS precedence FROM {FACTS}""")
def ordered_streams(spark: SparkSession, folder: str) -> DataFrame:
    facts = star.facts(spark, folder).select("fact_id", "metric", "decision")
    streams = [("financial", facts.where(F.lower("metric").contains("csr"))), ("kept", facts.where("decision = 'keep'")), ("rescued", facts.where("decision = 'rescue'")), ("dropped", facts)]
    return review.in_order([(name, df.select("fact_id")) for name, df in streams], "fact_id")


@query("mapped_periods", f"""
SELECT obs_id, coalesce(CASE period_label WHEN 'FY2020' THEN 'FY2019-20' WHEN 'FY2021' THEN 'FY2020-21' WHEN 'FY2022' THEN 'FY2021-22' WHEN 'FY2023' THEN 'FY2022-23' WHEN 'FY2024' THEN 'FY2023-24' END, d.fiscal_year, period_label) AS stored
FROM {OBS} o LEFT JOIN {DOCS} d ON o.source_doc_id = d.doc_id""")
def mapped_periods(spark: SparkSession, folder: str) -> DataFrame:
    stored = F.create_map(*(F.lit(x) for y in range(2020, 2025) for x in (f"FY{y}", f"FY{y - 1}-{y % 100}")))
    docs = star.report_documents(spark, folder).select(F.col("doc_id").alias("source_doc_id"), "fiscal_year")
    obs = star.observations(spark, folder).select("obs_id", "period_label", "source_doc_id").join(docs, "source_doc_id", "left")
    return obs.select("obs_id", F.coalesce(F.try_element_at(stored, F.col("period_label")), "fiscal_year", "period_label").alias("stored"))


@query("review_candidates", f"""
WITH l AS (SELECT obs_id, company_id, canonical_id, source_doc_id, normalised_value AS v FROM {LOADED} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL),
n AS (SELECT a.obs_id AS asked, b.obs_id AS found, coalesce(a.source_doc_id = b.source_doc_id, false) AS same_document, abs(b.v - a.v) AS gap FROM l a JOIN l b ON a.company_id = b.company_id AND a.canonical_id = b.canonical_id AND a.obs_id <> b.obs_id
 AND sign(a.v) = sign(b.v) AND abs(b.v - a.v) <= 0.04 * abs(a.v) WHERE CAST(right(a.obs_id, 8) AS INT) % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY CASE WHEN same_document THEN 0 ELSE 1 END, gap, found) AS place FROM n)
SELECT asked, found, same_document, gap, place FROM r WHERE place <= 5""")
def review_candidates(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id is not null and company_id is not null").select("obs_id", "company_id", "canonical_id", "source_doc_id", "normalised_value")
    asked = obs.where(F.substring("obs_id", -8, 8).cast("int") % 20 == 0)  # the stated query set, against all rows
    return review.nearest_values(asked, obs, ["company_id", "canonical_id"], "obs_id", "obs_id", "normalised_value", "source_doc_id")


@query("review_counters", f"""
SELECT 'normalization_status' AS field, normalization_status AS category, count(*) AS n FROM {OBS} GROUP BY ALL UNION ALL SELECT 'normalisation_confidence', normalisation_confidence, count(*) FROM {OBS} GROUP BY ALL
UNION ALL SELECT 'period_confidence', period_confidence, count(*) FROM {OBS} GROUP BY ALL""")
def review_counters(spark: SparkSession, folder: str) -> DataFrame:
    return review.counters(star.observations(spark, folder), ["normalization_status", "normalisation_confidence", "period_confidence"])


_TOKENS = text.NUMERIC_TOKEN.replace("'", "''")


@query("high_signal_pages", f"""
SELECT doc_id, regexp_matches(t, 'plant\\s+locations?|manufacturing\\s+locations?|factory\\s+locations?|sustainability\\s+spend|sustainable\\s+operations') OR (n >= 5 AND regexp_matches(t, 'sustainability|factory|plant|operations|supply chain|logistics')) AS isolated, n
FROM (SELECT doc_id, lower(text) AS t, len(regexp_extract_all(regexp_replace(text, '[^\\P{{L}}a-zA-Z]|\\p{{M}}', 'a', 'g'), '(?i){_TOKENS}')) AS n FROM documents WHERE text IS NOT NULL AND lang = 'en')""")
def high_signal_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages in English whose text alone makes them worth adding to a selection."""
    docs = read_table(spark, folder, "documents").where("text is not null and lang = 'en'").select("doc_id", F.lower("text").alias("t"), text.numeric_tokens(F.col("text")).alias("n"))
    named = F.col("t").rlike(r"plant\s+locations?|manufacturing\s+locations?|factory\s+locations?|sustainability\s+spend|sustainable\s+operations")
    broad = (F.col("n") >= 5) & F.col("t").rlike("sustainability|factory|plant|operations|supply chain|logistics")
    return docs.select("doc_id", (named | broad).alias("isolated"), F.col("n").cast("long").alias("n"))


@query("range_pages", """
WITH p AS (SELECT DISTINCT doc_id, company_id, fiscal_year, page, lower(text) AS t FROM documents WHERE company_id IS NOT NULL AND fiscal_year IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL),
h AS (SELECT company_id, fiscal_year, min(page) AS first FROM p WHERE contains(left(t, length(t) // 2), 'sustainability') OR contains(left(t, length(t) // 2), 'emissions') GROUP BY ALL)
SELECT p.doc_id, h.first FROM p JOIN h USING (company_id, fiscal_year) WHERE p.page BETWEEN h.first AND h.first + 70 AND regexp_matches(t, '[0-9]')""")
def range_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with numbers within 70 pages of the first whose upper half names the subject."""
    p = read_table(spark, folder, "documents").dropna(subset=["company_id", "fiscal_year", "page", "text"]).select("doc_id", "company_id", "fiscal_year", "page", F.lower("text").alias("t")).distinct()
    upper = F.substring(F.col("t"), F.lit(1), F.floor(F.length("t") / 2).cast("int"))
    first = p.where(upper.contains("sustainability") | upper.contains("emissions")).groupBy("company_id", "fiscal_year").agg(F.min("page").alias("first"))
    near = p.join(first, ["company_id", "fiscal_year"]).where((F.col("page") >= F.col("first")) & (F.col("page") <= F.col("first") + 70) & F.col("t").rlike("[0-9]"))
    return near.select("doc_id", "first")


_KEYS = {"company": "company_id", "report_document": "doc_id", "report_section": "section_id", "report_chunk": "chunk_id", "extracted_fact": "fact_id", "observation": "obs_id", "consumer_master_registry_v1": "canonical_id", "unit_conversion": "from_symbol", "eval_item": "item_id"}


@query("repeated_keys", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeated FROM (SELECT {k}, count(*) AS n FROM {t} WHERE {k} IS NOT NULL GROUP BY {k})" for t, k in _KEYS.items()))
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """For each of the nine keys: how many there are and how many rows repeat one."""
    out = None
    for table, key in _KEYS.items():
        n = read_table(spark, folder, table).where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        part = n.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated")).withColumn("table", F.lit(table))
        out = part if out is None else out.unionByName(part)
    return out


@query("recommended_actions", f"""
WITH g AS (%s), o AS (SELECT obs_id, coalesce(raw_name, '') AS t FROM {OBS})
SELECT obs_id, CASE WHEN eligible THEN 'alias_candidate' WHEN regexp_matches(t, '(?i)\\b(brsr|gri|sasb|scope\\s*[123]|energy|water|waste|epr|plastic|emissions?|ghg|effluent|renewable)\\b') THEN 'standard_mapping_candidate'
 WHEN contains(reasons, 'untyped') OR contains(reasons, 'role_mismatch') THEN 'true_provisional' ELSE 'do_not_promote' END AS action FROM g JOIN o USING (obs_id)""")
def recommended_actions(spark: SparkSession, folder: str) -> DataFrame:
    names = star.observations(spark, folder).select("obs_id", F.coalesce("raw_name", F.lit("")).alias("t"))
    standard = F.col("t").rlike(r"(?i)\b(brsr|gri|sasb|scope\s*[123]|energy|water|waste|epr|plastic|emissions?|ghg|effluent|renewable)\b")
    action = F.when(F.col("eligible"), "alias_candidate").when(standard, "standard_mapping_candidate").when(F.col("reasons").contains("untyped") | F.col("reasons").contains("role_mismatch"), "true_provisional").otherwise("do_not_promote")
    return alias_gate(spark, folder).join(names, "obs_id").select("obs_id", action.alias("action"))


@query("keyword_hits", """
WITH k AS (SELECT list_sort(list_distinct(list(lower(display_name)))) AS words FROM consumer_master_registry_v1)
SELECT doc_id, array_to_string(list_filter(words, lambda w: contains(lower(text), w)), '; ') AS hits, left(trim(regexp_replace(replace(text, chr(10), ' '), '[ \\t\\xA0]+', ' ', 'g'), ' '), 420) AS preview FROM documents, k WHERE text IS NOT NULL""")
def keyword_hits(spark: SparkSession, folder: str) -> DataFrame:
    """The registry's names that a page holds, and the first 420 characters shown beside them."""
    words = read_table(spark, folder, "consumer_master_registry_v1").agg(F.array_sort(F.collect_set(F.lower("display_name")))).scalar()
    docs = read_table(spark, folder, "documents").where("text is not null").select("doc_id", "text", words.alias("words"))
    held = F.filter("words", lambda w: F.contains(F.lower("text"), w))
    shown = F.substring(F.trim(F.regexp_replace(F.regexp_replace("text", "\n", " "), "[ \\t\u00a0]+", " ")), 1, 420)
    return docs.select("doc_id", F.array_join(held, "; ").alias("hits"), shown.alias("preview"))


@query("filtered_facts", f"SELECT fact_id FROM {FACTS} WHERE contains(lower(coalesce(company_id, '')), 'co_0') AND contains(lower(coalesce(metric, '')), 'water') AND confidence >= 0.5 AND NOT isnan(confidence)")
def filtered_facts(spark: SparkSession, folder: str) -> DataFrame:
    return review.keep_by_filter(star.facts(spark, folder).select("fact_id", "company_id", "metric", "confidence"), company_id="CO_0", metric="water", confidence=0.5).select("fact_id")


@query("rescue_context", f"""
SELECT f.fact_id, k.section_title, k.chunk_type, CASE WHEN o.n IS NULL THEN 'not loaded' WHEN o.ok > 0 THEN 'confirmed' ELSE 'open' END AS verdict FROM {FACTS} f LEFT JOIN {CHUNKS} k USING (chunk_id)
LEFT JOIN (SELECT source_fact_id, count(*) AS n, count(*) FILTER (normalization_status = 'normalized') AS ok FROM {OBS} GROUP BY ALL) o ON o.source_fact_id = f.fact_id WHERE f.decision = 'rescue'""")
def rescue_context(spark: SparkSession, folder: str) -> DataFrame:
    facts = star.facts(spark, folder, "decision = 'rescue'").select("fact_id", "chunk_id")
    chunk = read_table(spark, folder, "report_chunk").select("chunk_id", "section_title", "chunk_type").dropDuplicates(["chunk_id"])
    seen = star.observations(spark, folder).groupBy(F.col("source_fact_id").alias("fact_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("normalization_status") == "normalized").alias("ok"))
    verdict = F.when(F.col("n").isNull(), "not loaded").when(F.col("ok") > 0, "confirmed").otherwise("open")
    return facts.join(chunk, "chunk_id", "left").join(seen, "fact_id", "left").select("fact_id", "section_title", "chunk_type", verdict.alias("verdict"))


@query("document_context", f"""
SELECT d.doc_id, coalesce(c.name, d.company_id, 'unknown') AS company, coalesce(d.report_type, 'annual_report') AS report_type, d.fiscal_year AS primary_period, coalesce(d.filing_year, CAST(right(d.fiscal_year, 4) AS INT)) AS filing_year,
 CASE WHEN d.calendar_type = 'calendar_year' THEN 12 ELSE 3 END AS end_month, coalesce(n.chunks, 0) AS chunks FROM {DOCS} d LEFT JOIN company c USING (company_id) LEFT JOIN (SELECT doc_id, count(DISTINCT chunk_id) AS chunks FROM report_chunk GROUP BY doc_id) n USING (doc_id)""")
def document_context(spark: SparkSession, folder: str) -> DataFrame:
    """What is known of each report, defaults filled in: the context its facts are validated in."""
    company = read_table(spark, folder, "company").select("company_id", "name")
    chunks = read_table(spark, folder, "report_chunk").groupBy("doc_id").agg(F.count_distinct("chunk_id").alias("chunks"))
    docs = star.report_documents(spark, folder).join(company, "company_id", "left").join(chunks, "doc_id", "left")
    return docs.select(
        "doc_id", F.coalesce("name", "company_id", F.lit("unknown")).alias("company"), F.coalesce("report_type", F.lit("annual_report")).alias("report_type"), F.col("fiscal_year").alias("primary_period"),
        F.coalesce("filing_year", F.substring("fiscal_year", -4, 4).cast("int")).alias("filing_year"), F.when(F.col("calendar_type") == "calendar_year", 12).otherwise(3).alias("end_month"), F.coalesce("chunks", F.lit(0)).alias("chunks"),
    )


@query("type_hints", f"""
SELECT fact_id, CASE WHEN regexp_matches(lower(coalesce(metric, '')), 'revenue|turnover|profit|capex|spend|expenditure') THEN 'financial_metric' WHEN fact_type IN ('target', 'baseline') THEN fact_type || '_metric' ELSE 'operational_metric' END AS hint FROM {FACTS}""")
def type_hints(spark: SparkSession, folder: str) -> DataFrame:
    money = F.lower(F.coalesce("metric", F.lit(""))).rlike("revenue|turnover|profit|capex|spend|expenditure")
    hint = F.when(money, "financial_metric").when(F.col("fact_type").isin("target", "baseline"), F.concat("fact_type", F.lit("_metric"))).otherwise("operational_metric")
    return star.facts(spark, folder).select("fact_id", hint.alias("hint"))


@query("review_rows", f"""
SELECT obs_id, coalesce(canonical_id, '') AS canonical_id, CASE WHEN normalization_status = 'new_metric' THEN 'provisional' WHEN normalization_status = 'quarantine' THEN 'blocked' ELSE 'done' END AS bucket,
 CASE WHEN normalization_status IN ('normalized', 'partial') THEN 'automatic' ELSE 'manual' END AS automation, printf('%.3f', CASE normalisation_confidence WHEN 'exact' THEN 1.0 WHEN 'inferred' THEN 0.85 WHEN 'needs_context' THEN 0.5 ELSE 0.0 END) AS score FROM {OBS}""")
def review_rows(spark: SparkSession, folder: str) -> DataFrame:
    s, how = F.col("normalization_status"), F.col("normalisation_confidence")
    score = F.when(how == "exact", 1.0).when(how == "inferred", 0.85).when(how == "needs_context", 0.5).otherwise(0.0)
    return star.observations(spark, folder).select(
        "obs_id", F.coalesce("canonical_id", F.lit("")).alias("canonical_id"), F.when(s == "new_metric", "provisional").when(s == "quarantine", "blocked").otherwise("done").alias("bucket"),
        F.when(s.isin("normalized", "partial"), "automatic").otherwise("manual").alias("automation"), F.format_string("%.3f", score).alias("score"),
    )


@query("load_summary", f"""
SELECT source_doc_id, period_label, count(*) AS n, count(DISTINCT canonical_id) AS metrics, count(*) FILTER (normalization_status = 'quarantine') AS quarantined FROM {OBS} GROUP BY ALL""")
def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    held = F.count_if(F.col("normalization_status") == "quarantine").alias("quarantined")
    return star.observations(spark, folder).groupBy("source_doc_id", "period_label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("canonical_id").alias("metrics"), held)


@query("superseded", f"""
SELECT obs_id, normalised_value < m AS superseded FROM (
 SELECT obs_id, normalised_value, max(normalised_value) OVER (PARTITION BY company_id, canonical_id, period, source_doc_id) AS m FROM {LOADED} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL AND period IS NOT NULL AND source_doc_id IS NOT NULL)""")
def superseded(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a report states a larger value of the same metric and period beside an observation."""
    keys = ["company_id", "canonical_id", "period", "source_doc_id"]
    obs = star.loaded(spark, folder, "canonical_id is not null and company_id is not null and source_doc_id is not null").where("period is not null").select("obs_id", *keys, "normalised_value")
    most = obs.groupBy(*keys).agg(F.max("normalised_value").alias("m"))
    return obs.join(most, keys).select("obs_id", (F.col("normalised_value") < F.col("m")).alias("superseded"))


@query("merged_registry", f"""
WITH o AS (SELECT canonical_id, min(normalised_unit_symbol) AS unit, list_sort(list_distinct(list(lower(trim(raw_name))))) AS names FROM {OBS} WHERE canonical_id IS NOT NULL AND normalization_status = 'normalized' AND raw_name IS NOT NULL GROUP BY ALL)
SELECT canonical_id, coalesce(o.unit, r.unit) AS unit, len(list_distinct(list_transform(list_concat(coalesce(r.aliases, []), coalesce(o.names, [])), lambda x: lower(trim(x))))) AS aliases
FROM consumer_master_registry_v1 r FULL JOIN o USING (canonical_id)""")
def merged_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry overridden by what was observed: its unit, and the names of both together."""
    base = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "unit", "aliases")
    seen = star.observations(spark, folder, "canonical_id is not null and normalization_status = 'normalized' and raw_name is not null")
    seen = seen.groupBy("canonical_id").agg(F.min("normalised_unit_symbol").alias("unit"), F.array_sort(F.collect_set(F.lower(F.trim("raw_name")))).alias("aliases"))
    return review.merge_registry(base, seen, "canonical_id", "aliases").select("canonical_id", "unit", F.size("aliases").alias("aliases"))


@query("chunk_surroundings", f"""
SELECT chunk_id, lag(section_title) OVER w AS before, lead(section_title) OVER w AS after, lead(section_title, 2) OVER w AS second_after FROM {CHUNKS} WHERE doc_id IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY page_start NULLS FIRST, chunk_id)""")
def chunk_surroundings(spark: SparkSession, folder: str) -> DataFrame:
    chunk = read_table(spark, folder, "report_chunk").where("doc_id is not null").select("doc_id", "chunk_id", "page_start", "section_title").distinct()
    return review.surrounding(chunk, "doc_id", ["page_start", "chunk_id"], "section_title").select("chunk_id", "before", "after", "second_after")


@query("default_decisions", f"""
SELECT o.obs_id, coalesce(d.decision, 'needs_manual_review') AS decision FROM {OBS} o LEFT JOIN (SELECT company_id, canonical_id, normalised_unit_symbol, CASE WHEN count(*) > 1 THEN 'accept' END AS decision
 FROM {OBS} WHERE normalization_status = 'normalized' GROUP BY ALL) d ON o.company_id = d.company_id AND o.canonical_id = d.canonical_id AND o.normalised_unit_symbol = d.normalised_unit_symbol""")
def default_decisions(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["company_id", "canonical_id", "normalised_unit_symbol"]
    known = star.observations(spark, folder, "normalization_status = 'normalized'").groupBy(*keys).agg(F.when(F.count(F.lit(1)) > 1, "accept").alias("decision"))
    obs = star.observations(spark, folder).select("obs_id", *keys)
    return obs.join(known, keys, "left").select("obs_id", F.coalesce("decision", F.lit("needs_manual_review")).alias("decision"))


def _fill() -> None:
    from verdant.plans.catalogue import _ORACLES

    _ORACLES["recommended_actions"] = _ORACLES["recommended_actions"] % _ORACLES["alias_gate"]


_fill()
