"""Queries that prove the scalar functions on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import number, period, semantics, text
from verdant.operators import star
from verdant.plans.catalogue import query
from verdant.plans.star import CHUNKS, DOCS, FACTS, OBS
from verdant.sources import read_table


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _case(column: str, rules, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN regexp_matches({column}, {_q('(?i)' + p)}) THEN {_q(n) if isinstance(n, str) else n}" for n, p in rules)
    return f"CASE {arms} ELSE {default} END"


@query("unit_families", f"SELECT fact_id, {_case("trim(coalesce(unit, ''))", number.UNIT_FAMILIES, "'unknown'")} AS unit_family FROM {FACTS}")
def unit_families(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", number.unit_family(F.col("unit")).alias("unit_family"))


_NUMS = "regexp_extract_all(coalesce(value, ''), '" + number.NUMBER_PATTERN + "')"
_BOTH = "lower(coalesce(value, '') || ' ' || coalesce(evidence, ''))"


@query("primary_numbers", f"""
SELECT fact_id, CASE WHEN len({_NUMS}) = 1 THEN try_cast(replace({_NUMS}[1], ',', '') AS DOUBLE)
  WHEN len({_NUMS}) = 2 AND ((contains({_BOTH}, 'from') AND contains({_BOTH}, 'to')) OR (contains(lower(trim(coalesce(value, ''))), ' to ')
  AND regexp_matches(coalesce(evidence, ''), {_q("(?i)" + number.MOVEMENT_PATTERN)}))) AND NOT regexp_matches({_BOTH}, {_q("(?i)" + number.GUIDANCE_PATTERN)})
  THEN try_cast(replace({_NUMS}[2], ',', '') AS DOUBLE) END AS number FROM {FACTS}""")
def primary_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", number.primary_number(F.col("value"), F.col("evidence")).alias("number"))


@query("value_scales", f"SELECT fact_id, CAST({_case("coalesce(value, '') || ' ' || coalesce(unit, '')", [(f, p) for f, p in number.SCALE_PATTERNS], '1')} AS BIGINT) AS scale FROM {FACTS}")
def value_scales(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", number.scale_of(F.col("value"), F.col("unit")).alias("scale"))


_QUANTITY = " + ".join(f"len(regexp_extract_all(text, {_q('(?i)' + p)}))" for p in text.QUANTITY_PATTERNS)
_EXCLUDE = " + ".join(f"CASE WHEN contains(lower(text), {_q(k)}) THEN {w} ELSE 0 END" for k, w in text.EXCLUDED_PHRASES.items())


@query("page_scores", f"""
SELECT doc_id, CAST({_QUANTITY} AS INT) AS quantity, CAST({_EXCLUDE} AS INT) AS exclude, CAST(len(regexp_extract_all(regexp_replace(text, '[^\\P{{L}}a-zA-Z]|\\p{{M}}', 'a', 'g'), {_q('(?i)' + text.NUMERIC_TOKEN)})) AS INT) AS numeric_tokens,
CAST(CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, (length(text) + 3) // 4) END AS INT) AS tokens FROM documents WHERE text IS NOT NULL""")
def page_scores(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "documents").where(F.col("text").isNotNull())
    t = F.col("text")
    return pages.select("doc_id", text.quantity_score(t).cast("int").alias("quantity"), text.phrase_score(t, text.EXCLUDED_PHRASES).alias("exclude"), text.numeric_tokens(t).alias("numeric_tokens"), text.token_estimate(t).alias("tokens"))


@query("token_estimates", f"SELECT chunk_id, token_estimate AS stored, CAST(CASE WHEN length(content) = 0 THEN 0 ELSE greatest(1, (length(content) + 3) // 4) END AS INT) AS estimate FROM {CHUNKS}")
def token_estimates(spark: SparkSession, folder: str) -> DataFrame:
    chunks = star.once(read_table(spark, folder, "report_chunk").select("chunk_id", "token_estimate", "content", "ingested_at"), "chunk_id", "ingested_at")
    return chunks.select("chunk_id", F.col("token_estimate").alias("stored"), text.token_estimate(F.col("content")).alias("estimate"))


@query("token_totals", f"SELECT doc_id, chunk_type, CAST(sum((length(content) + 3) // 4) AS BIGINT) AS tokens, count(*) AS chunks FROM {CHUNKS} GROUP BY ALL")
def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    chunks = read_table(spark, folder, "report_chunk").select("chunk_id", "doc_id", "chunk_type", text.token_estimate(F.col("content")).alias("t")).dropDuplicates(["chunk_id"])
    return chunks.groupBy("doc_id", "chunk_type").agg(F.sum("t").alias("tokens"), F.count(F.lit(1)).alias("chunks"))


_REP = "CASE WHEN d.calendar_type = 'calendar_year' THEN 'CY' ELSE 'FY' END || "
_YEAR = "CAST(regexp_extract(d.fiscal_year, '([0-9]{4})', 1) AS INT)"


@query("period_labels", f"""
SELECT f.fact_id, CASE WHEN f.period IS NULL OR lower(f.period) IN ('', 'unknown', 'none', 'open_ended') THEN {_REP} {_YEAR}
 WHEN regexp_matches(f.period, '20[0-9]{{2}}[-/][0-9]{{2}}') THEN 'FY20' || regexp_extract(f.period, '20[0-9]{{2}}[-/]([0-9]{{2}})', 1)
 WHEN len(regexp_extract_all(f.period, '\\b(20[0-9]{{2}})\\b')) > 0 THEN {_REP} regexp_extract_all(f.period, '\\b(20[0-9]{{2}})\\b', 1)[-1] ELSE {_REP} {_YEAR} END AS label
FROM {FACTS} f JOIN {DOCS} d USING (doc_id)""")
def period_labels(spark: SparkSession, folder: str) -> DataFrame:
    docs = star.report_documents(spark, folder).select("doc_id", "calendar_type", period.label_year(F.col("fiscal_year")).alias("y"))
    joined = star.facts(spark, folder).select("fact_id", "doc_id", "period").join(docs, "doc_id")
    return joined.select("fact_id", period.normalise_label(F.col("period"), F.col("y"), F.col("calendar_type")).alias("label"))


_FY = "CAST(regexp_extract(label, '([0-9]{4})', 1) AS INT)"


@query("period_bounds", f"""
WITH o AS (SELECT obs_id, period_label AS label, coalesce(period_type, 'unknown') AS kind FROM {OBS} WHERE regexp_matches(period_label, '^(FY|CY)[0-9]{{4}}$')),
b AS (SELECT *, CASE WHEN starts_with(label, 'CY') THEN make_date({_FY}, 1, 1) ELSE make_date({_FY} - 1, 4, 1) END AS s, CASE WHEN starts_with(label, 'CY') THEN make_date({_FY}, 12, 31) ELSE make_date({_FY}, 3, 31) END AS e FROM o)
SELECT obs_id, CAST(CASE WHEN kind IN ('full_year', 'baseline') THEN s END AS VARCHAR) AS start, CAST(CASE WHEN kind IN ('full_year', 'baseline', 'point_in_time') THEN e END AS VARCHAR) AS "end",
CASE WHEN kind IN ('full_year', 'baseline') THEN 'range' WHEN kind = 'point_in_time' THEN 'point' ELSE 'unresolvable' END AS resolution FROM b""")
def period_bounds(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder, F.col("period_label").rlike(r"^(FY|CY)\d{4}$"))
    b = period.resolve_bounds(F.col("period_label"), F.col("period_type"), F.lit(3))
    return obs.select("obs_id", b.alias("b")).select("obs_id", F.col("b.start").cast("string").alias("start"), F.col("b.end").cast("string").alias("end"), "b.resolution")


@query("period_inference", f"""
WITH x AS (SELECT f.fact_id, f.period AS raw, coalesce(f.evidence, '') AS s, d.fiscal_year AS own FROM {FACTS} f JOIN {DOCS} d USING (doc_id)),
y AS (SELECT *, coalesce(raw, '') AS r FROM x),
z AS (SELECT *, {", ".join(f"nullif(regexp_extract({c}, '(?i)FY ?(20[0-9][0-9])', 1), '') AS {p}fy, nullif(regexp_extract({c}, '(?i)CY ?(20[0-9][0-9])', 1), '') AS {p}cy, nullif(regexp_extract({c}, '20[0-9][0-9][-/]([0-9][0-9])([^0-9]|$)', 1), '') AS {p}rg, nullif(regexp_extract({c}, '(^|[^0-9])(20[0-9][0-9])([^0-9]|$)', 2), '') AS {p}by" for c, p in (('r', 'a'), ('s', 'b')))} FROM y)
SELECT fact_id, coalesce('FY' || afy, 'CY' || acy, 'FY20' || arg, left(own, 2) || aby, 'FY' || bfy, 'CY' || bcy, 'FY20' || brg, left(own, 2) || bby, own) AS label,
CASE WHEN coalesce(afy, acy, arg, aby, bfy, bcy, brg, bby) IS NOT NULL THEN 'extracted' ELSE 'inferred' END AS confidence FROM z""")
def period_inference(spark: SparkSession, folder: str) -> DataFrame:
    docs = star.report_documents(spark, folder).select("doc_id", F.col("fiscal_year").alias("own"))
    joined = star.facts(spark, folder).select("fact_id", "doc_id", "period", "evidence").join(docs, "doc_id")
    label, how = period.infer_label(F.col("period"), F.col("evidence"), F.col("own"))
    return joined.select("fact_id", label.alias("label"), how.alias("confidence"))


@query("quarter_bounds", """
SELECT o_orderkey, CAST(make_date(y, m, 1) AS VARCHAR) AS first_day, CAST(last_day(make_date(y, m, 1) + INTERVAL 2 MONTH) AS VARCHAR) AS last_day FROM (
 SELECT o_orderkey, year(o_orderdate) AS y, 1 + 3 * ((month(o_orderdate) - 1) // 3) AS m FROM orders)""")
def quarter_bounds(spark: SparkSession, folder: str) -> DataFrame:
    day = F.add_months(F.col("o_orderdate").cast("date"), 9)
    first, last = period.quarter_bounds(F.year(day), F.lit(3), F.quarter(day))
    return read_table(spark, folder, "orders").select("o_orderkey", first.cast("string").alias("first_day"), last.cast("string").alias("last_day"))


_T = "lower(trim(coalesce(metric, '')))"


@query("financial_flags", f"SELECT fact_id, {_T} IN ({", ".join(_q(n) for n in semantics.FINANCIAL_NAMES)}) OR regexp_matches({_T}, {_q(semantics.FINANCIAL_PATTERN)}) OR regexp_matches({_T}, {_q(semantics.GROWTH_PATTERN)}) AS financial FROM {FACTS}")
def financial_flags(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", semantics.is_financial(F.col("metric")).alias("financial"))


_S = "lower(coalesce(metric, ''))"


@query("metric_semantics", f"""
WITH t AS (SELECT fact_id, {_case(_S, semantics.SUBJECTS)} AS subject, {_case(_S, semantics.ROLES)} AS said, {_case(_S, semantics.ENERGY_SOURCES)} AS energy_source, {_case(_S, semantics.DENOMINATORS)} AS denominator FROM {FACTS}),
s AS (SELECT * EXCLUDE (said), CASE WHEN denominator IS NOT NULL AND coalesce(said, '') NOT IN ('intensity', 'generation', 'consumption', 'withdrawal') THEN 'intensity' ELSE said END AS role FROM t)
SELECT *, CASE {" ".join(f"WHEN role = '{r}' THEN '{p}'" for r, p in semantics.POLARITIES.items())} END AS polarity FROM s""")
def metric_semantics(spark: SparkSession, folder: str) -> DataFrame:
    s = semantics.semantics_of(F.lower(F.coalesce("metric", F.lit(""))))
    return star.facts(spark, folder).select("fact_id", s.alias("s")).select("fact_id", "s.*")


@query("semantic_gate", f"""
WITH o AS (SELECT obs_id, canonical_id, lower(coalesce(raw_name, '')) AS t, {_case("trim(coalesce(raw_unit_string, ''))", number.UNIT_FAMILIES, "'unknown'")} AS fam FROM {OBS} WHERE canonical_id IS NOT NULL),
r AS (SELECT canonical_id, lower(display_name) AS t, {_case("trim(unit)", number.UNIT_FAMILIES, "'unknown'")} AS fam FROM consumer_master_registry_v1),
x AS (SELECT o.obs_id, o.fam AS of, r.fam AS rf, {", ".join(f"{_case('o.t', rules)} AS o{i}, {_case('r.t', rules)} AS r{i}" for i, rules in enumerate((semantics.SUBJECTS, semantics.ENERGY_SOURCES)))} FROM o JOIN r USING (canonical_id))
SELECT obs_id, o0 IS NOT NULL AND r0 IS NOT NULL AND o0 <> r0 AS subject_differs, o1 IS NOT NULL AND r1 IS NOT NULL AND o1 <> r1 AS source_differs, of <> rf AND of <> 'unknown' AND rf <> 'unknown' AS unit_differs FROM x""")
def semantic_gate(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder, "canonical_id is not null")
    obs = obs.select("obs_id", "canonical_id", semantics.semantics_of(F.lower(F.coalesce("raw_name", F.lit("")))).alias("a"), number.unit_family(F.col("raw_unit_string")).alias("af"))
    reg = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", semantics.semantics_of(F.lower("display_name")).alias("b"), number.unit_family(F.col("unit")).alias("bf"))
    why = obs.join(reg, "canonical_id").select("obs_id", semantics.gate_reasons(F.col("a"), F.col("b"), F.col("af"), F.col("bf")).alias("why"))
    return why.select("obs_id", F.array_contains("why", "subject_mismatch").alias("subject_differs"), F.array_contains("why", "energy_source_mismatch").alias("source_differs"), F.array_contains("why", "unit_family_mismatch").alias("unit_differs"))


@query("metric_keys", f"""
SELECT fact_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(regexp_replace({_S}, '[^a-z% ]+', ' ', 'g'), ' '),
 lambda w: CASE WHEN length(w) > 4 AND suffix(w, 's') THEN left(w, length(w) - 1) ELSE w END), lambda w: w <> ''))), ' ') AS metric_key FROM {FACTS}""")
def metric_keys(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", text.metric_key(F.col("metric")).alias("metric_key"))


@query("slugs", "SELECT canonical_id, trim(regexp_replace(lower(display_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM consumer_master_registry_v1")
def slugs(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", text.slug(F.col("display_name")).alias("slug"))


@query("json_props", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY ALL")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_type", F.from_json("props", "struct<k: bigint>").alias("p"))
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("k"))


@query("value_accuracy", f"""
SELECT o.company_id, count(*) AS n, count(*) FILTER (CASE WHEN v = 0 THEN abs(o.normalised_value) <= 1e-6 ELSE abs(o.normalised_value - v) / abs(v) <= 0.01 END) AS near
FROM {OBS} o JOIN (SELECT fact_id, try_cast(replace(value, ',', '') AS DOUBLE) AS v FROM {FACTS}) f ON o.source_fact_id = f.fact_id
WHERE v IS NOT NULL AND o.normalised_value IS NOT NULL AND NOT isnan(o.normalised_value) GROUP BY ALL""")
def value_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    facts = star.facts(spark, folder).select(F.col("fact_id").alias("source_fact_id"), F.regexp_replace("value", ",", "").try_cast("double").alias("v")).where("v is not null")
    obs = star.observations(spark, folder, F.col("normalised_value").isNotNull() & ~F.isnan("normalised_value"))
    return obs.join(facts, "source_fact_id").groupBy("company_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(number.close_to(F.col("normalised_value"), F.col("v"))).alias("near"))
