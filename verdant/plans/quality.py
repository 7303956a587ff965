"""Queries on quality: checks, accuracy, calibration, coverage, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdant.operators import star, validate
from verdant.plans.catalogue import query
from verdant.plans.star import CHUNKS, DOCS, FACTS, LOADED, OBS
from verdant.sources import read_table
from verdant.streaming.resume import windowed_counts

_TEXT = "coalesce(value, '')"
_EV = "coalesce(evidence, '')"
_FAILS = [
    ("specific_number", f"len(regexp_extract_all({_TEXT}, '-?[0-9][0-9,]*\\.?[0-9]*')) >= 1 AND NOT (regexp_matches({_TEXT}, '[0-9]\\s*(?:-|–|to)\\s*[0-9]') AND NOT contains(lower({_TEXT}), 'from'))"),
    ("unit_clear", "trim(coalesce(unit, '')) NOT IN ('', '-')"),
    ("period_determinable", f"regexp_matches(coalesce(period, ''), '(?:19|20)[0-9]{{2}}') OR regexp_matches({_EV}, '(?:FY|CY)\\s?20[0-9]{{2}}|20[0-9]{{2}}[-/][0-9]{{2}}')"),
    ("is_actual", f"NOT regexp_matches(lower({_EV}), '\\b(target|aim to|plans? to|expected to)\\b')"),
    ("unambiguous", "trim(coalesce(metric, '')) <> ''"),
]
_FAILED = "list_filter([" + ", ".join(f"CASE WHEN NOT ({sql}) THEN '{name}' END" for name, sql in _FAILS) + "], lambda x: x IS NOT NULL)"


@query("fact_checks", f"""
SELECT fact_id, array_to_string(f, ',') AS failed, CASE WHEN len(f) = 0 THEN 'keep' WHEN len(f) <= 2 THEN 'rescue' ELSE 'drop' END AS verdict FROM (SELECT fact_id, {_FAILED} AS f FROM {FACTS})""")
def fact_checks(spark: SparkSession, folder: str) -> DataFrame:
    facts = star.facts(spark, folder)
    failed = validate.failed_checks(validate.fact_checks(*(F.col(c) for c in ("value", "unit", "evidence", "period", "metric"))))
    return facts.select("fact_id", failed.alias("f")).select("fact_id", F.array_join("f", ",").alias("failed"), validate.verdict(F.col("f")).alias("verdict"))


@query("unit_report", f"""
WITH c AS (SELECT source_doc_id, normalisation_confidence, count(*) AS n FROM {OBS} GROUP BY ALL)
SELECT * FROM c UNION ALL SELECT '(all)', normalisation_confidence, CAST(sum(n) AS BIGINT) FROM c GROUP BY ALL""")
def unit_report(spark: SparkSession, folder: str) -> DataFrame:
    return validate.rollup_counts(star.observations(spark, folder), "source_doc_id", "normalisation_confidence")


@query("failed_units", f"SELECT trim(raw_unit_string) AS unit, count(*) AS n FROM {OBS} WHERE normalisation_confidence = 'failed' AND trim(coalesce(raw_unit_string, '')) <> '' GROUP BY ALL")
def failed_units(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder, (F.col("normalisation_confidence") == "failed") & (F.trim(F.coalesce("raw_unit_string", F.lit(""))) != ""))
    return obs.groupBy(F.trim("raw_unit_string").alias("unit")).agg(F.count(F.lit(1)).alias("n"))


@query("category_counters", " UNION ALL ".join(f"SELECT '{c}' AS field, coalesce(CAST({c} AS VARCHAR), '(null)') AS category, count(*) AS n FROM {OBS} GROUP BY ALL" for c in ("period_type", "fact_type", "period_confidence", "normalization_status")))
def category_counters(spark: SparkSession, folder: str) -> DataFrame:
    fields = ("period_type", "fact_type", "period_confidence", "normalization_status")
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("(null)")).alias("category")) for c in fields))
    return star.observations(spark, folder).select(F.inline(pairs)).groupBy("field", "category").agg(F.count(F.lit(1)).alias("n"))


@query("accuracy_by_group", f"""
WITH x AS (SELECT f.fact_type, f.decision, o.canonical_id IS NOT NULL AS linked, o.normalised_value IS NOT NULL AND NOT isnan(o.normalised_value) AS valued FROM {FACTS} f LEFT JOIN {OBS} o ON o.source_fact_id = f.fact_id)
SELECT fact_type, decision, count(*) AS facts, count(*) FILTER (linked) AS linked, count(*) FILTER (valued) AS valued, round(count(*) FILTER (linked AND valued) / count(*), 6) AS accuracy FROM x GROUP BY ALL""")
def accuracy_by_group(spark: SparkSession, folder: str) -> DataFrame:
    facts = read_table(spark, folder, "extracted_fact").select("fact_id", "fact_type", "decision").distinct()
    obs = star.observations(spark, folder).select(F.col("source_fact_id").alias("fact_id"), F.col("canonical_id").isNotNull().alias("linked"), (F.col("normalised_value").isNotNull() & ~F.isnan("normalised_value")).alias("valued"))
    joined = facts.join(obs, "fact_id", "left")
    both = F.count_if(F.col("linked") & F.col("valued"))
    return joined.groupBy("fact_type", "decision").agg(F.count(F.lit(1)).alias("facts"), F.count_if("linked").alias("linked"), F.count_if("valued").alias("valued"), F.round(both / F.count(F.lit(1)), 6).alias("accuracy"))


@query("confidence_percentiles", f"""
SELECT decision, round(quantile_cont(confidence, 0.1), 6) AS p10, round(quantile_cont(confidence, 0.5), 6) AS p50, round(avg(confidence), 6) AS mean, max(confidence) AS most FROM {FACTS}
WHERE confidence IS NOT NULL AND NOT isnan(confidence) AND confidence BETWEEN 0 AND 1 GROUP BY ALL""")
def confidence_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    ok = F.col("confidence").isNotNull() & ~F.isnan("confidence") & F.col("confidence").between(0, 1)
    g = read_table(spark, folder, "extracted_fact").select("fact_id", "decision", "confidence").where(ok).distinct().groupBy("decision")
    return g.agg(F.round(F.percentile("confidence", F.lit(0.1)), 6).alias("p10"), F.round(F.percentile("confidence", F.lit(0.5)), 6).alias("p50"), F.round(F.avg("confidence"), 6).alias("mean"), F.max("confidence").alias("most"))


@query("field_presence", " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS rows, count({c}) AS present, count(*) FILTER (trim({c}) <> '') AS filled FROM {FACTS}" for c in ("metric", "value", "unit", "period", "evidence", "entity", "segment")))
def field_presence(spark: SparkSession, folder: str) -> DataFrame:
    return validate.presence(star.facts(spark, folder), ["metric", "value", "unit", "period", "evidence", "entity", "segment"])


@query("exact_without_value", f"SELECT company_id, normalisation_confidence, count(*) AS n, count(*) FILTER (normalised_value IS NULL OR isnan(normalised_value)) AS without_value FROM {OBS} GROUP BY ALL")
def exact_without_value(spark: SparkSession, folder: str) -> DataFrame:
    """For each company and confidence, the observations and those without a value: none may be exact or inferred."""
    no_value = F.col("normalised_value").isNull() | F.isnan("normalised_value")
    return star.observations(spark, folder).groupBy("company_id", "normalisation_confidence").agg(F.count(F.lit(1)).alias("n"), F.count_if(no_value).alias("without_value"))


@query("missing_dimension_rows", f"""
SELECT 'unit' AS dimension, count(*) AS n FROM {OBS} o WHERE normalised_unit_symbol IS NOT NULL AND NOT EXISTS (SELECT 1 FROM unit_conversion u WHERE u.from_symbol = o.normalised_unit_symbol)
UNION ALL SELECT 'metric', count(*) FROM {OBS} o WHERE canonical_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM consumer_master_registry_v1 r WHERE r.canonical_id = o.canonical_id)
UNION ALL SELECT 'document', count(*) FROM {OBS} o WHERE source_doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM report_document d WHERE d.doc_id = o.source_doc_id)""")
def missing_dimension_rows(spark: SparkSession, folder: str) -> DataFrame:
    obs, out = star.observations(spark, folder), None
    for name, column, table, key in (("unit", "normalised_unit_symbol", "unit_conversion", "from_symbol"), ("metric", "canonical_id", "consumer_master_registry_v1", "canonical_id"), ("document", "source_doc_id", "report_document", "doc_id")):
        known = read_table(spark, folder, table).select(F.col(key).alias(column))
        lost = obs.where(F.col(column).isNotNull()).join(known, column, "left_anti").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dimension"), "n")
        out = lost if out is None else out.unionByName(lost)
    return out


@query("filled_provenance", f"""
SELECT o.obs_id, coalesce(nullif(trim(o.chunk_id), ''), nullif(trim(f.chunk_id), '')) AS chunk_id, coalesce(o.page, f.page_start, k.page_start) AS page, coalesce(nullif(trim(f.evidence), ''), left(k.content, 120)) AS evidence
FROM {OBS} o LEFT JOIN {FACTS} f ON f.fact_id = o.source_fact_id LEFT JOIN {CHUNKS} k ON k.chunk_id = o.chunk_id""")
def filled_provenance(spark: SparkSession, folder: str) -> DataFrame:
    def filled(c):
        return F.nullif(F.trim(c), F.lit(""))

    facts = star.facts(spark, folder).select(F.col("fact_id").alias("source_fact_id"), F.col("chunk_id").alias("f_chunk"), F.col("page_start").alias("f_page"), "evidence")
    chunk = read_table(spark, folder, "report_chunk").select("chunk_id", F.col("page_start").alias("k_page"), F.substring("content", 1, 120).alias("head")).dropDuplicates(["chunk_id"])
    joined = star.observations(spark, folder).select("obs_id", "source_fact_id", "chunk_id", "page").join(facts, "source_fact_id", "left").join(chunk, "chunk_id", "left")
    return joined.select("obs_id", F.coalesce(filled("chunk_id"), filled("f_chunk")).alias("chunk_id"), F.coalesce("page", "f_page", "k_page").alias("page"), F.coalesce(filled("evidence"), F.col("head")).alias("evidence"))


@query("readable_export", f"""
WITH a AS (SELECT *, row_number() OVER (PARTITION BY doc_id, metric, value ORDER BY fact_id) AS n FROM {FACTS}), b AS (SELECT *, row_number() OVER (PARTITION BY source_doc_id, raw_name, raw_value ORDER BY obs_id) AS n FROM {OBS})
SELECT a.fact_id, b.obs_id, b.normalization_status FROM a LEFT JOIN b ON a.doc_id = b.source_doc_id AND a.metric IS NOT DISTINCT FROM b.raw_name AND a.value IS NOT DISTINCT FROM b.raw_value AND a.n = b.n""")
def readable_export(spark: SparkSession, folder: str) -> DataFrame:
    facts = star.facts(spark, folder).select("fact_id", "doc_id", "metric", "value")
    obs = star.observations(spark, folder).select("obs_id", "normalization_status", F.col("source_doc_id").alias("doc_id"), F.col("raw_name").alias("metric"), F.col("raw_value").alias("value"))
    return validate.multiset_join(facts, obs, ["doc_id", "metric", "value"], "fact_id", "obs_id").select("fact_id", "obs_id", "normalization_status")


@query("recurring_names", f"""
SELECT lower(trim(raw_name)) AS name, count(DISTINCT period_label) AS periods, array_to_string(list_sort(list(DISTINCT period_label)), ',') AS listed FROM {OBS} WHERE raw_name IS NOT NULL AND period_label IS NOT NULL
GROUP BY ALL HAVING count(DISTINCT period_label) > 1""")
def recurring_names(spark: SparkSession, folder: str) -> DataFrame:
    obs = read_table(spark, folder, "observation").where("raw_name is not null and period_label is not null")
    g = obs.groupBy(F.lower(F.trim("raw_name")).alias("name")).agg(F.collect_set("period_label").alias("p"))
    return g.where(F.size("p") > 1).select("name", F.size("p").cast("long").alias("periods"), F.array_join(F.array_sort("p"), ",").alias("listed"))


@query("review_memory", f"""
SELECT lower(trim(raw_name)) AS name, CASE WHEN count(DISTINCT coalesce(canonical_id, '(none)')) = 1 THEN arg_max(coalesce(canonical_id, '(none)'), obs_id) END AS decision, count(DISTINCT coalesce(canonical_id, '(none)')) > 1 AS conflict
FROM {OBS} WHERE raw_name IS NOT NULL GROUP BY ALL""")
def review_memory(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder, "raw_name is not null")
    rows = obs.select(F.lower(F.trim("raw_name")).alias("name"), F.coalesce("canonical_id", F.lit("(none)")).alias("signature"), "obs_id")
    return validate.merge_reviews(rows, "name", "signature", "obs_id")


@query("currency_mentions", """
SELECT company_id, CAST(sum(len(regexp_extract_all(text, '₹|\\bINR\\b|\\bRs\\b'))) AS BIGINT) AS inr, CAST(sum(len(regexp_extract_all(text, '\\$|\\bUSD\\b'))) AS BIGINT) AS usd,
CASE WHEN sum(len(regexp_extract_all(text, '₹|\\bINR\\b|\\bRs\\b'))) > 3 THEN 'INR' ELSE 'USD' END AS currency FROM documents WHERE text IS NOT NULL GROUP BY ALL""")
def currency_mentions(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    g = read_table(spark, folder, "documents").where("text is not null").groupBy("company_id")
    g = g.agg(F.sum(F.regexp_count(t, F.lit(r"₹|\bINR\b|\bRs\b"))).alias("inr"), F.sum(F.regexp_count(t, F.lit(r"\$|\bUSD\b"))).alias("usd"))
    return g.withColumn("currency", F.when(F.col("inr") > 3, "INR").otherwise("USD"))


@query("report_chunk_pages", f"SELECT d.doc_id, d.report_type, count(k.chunk_id) AS chunks, min(k.page_start) AS first_page, max(coalesce(k.page_end, k.page_start)) AS last_page FROM {DOCS} d LEFT JOIN {CHUNKS} k USING (doc_id) GROUP BY ALL")
def report_chunk_pages(spark: SparkSession, folder: str) -> DataFrame:
    chunk = read_table(spark, folder, "report_chunk").select("chunk_id", "doc_id", "page_start", "page_end").distinct()
    joined = star.report_documents(spark, folder).join(chunk, "doc_id", "left")
    return joined.groupBy("doc_id", "report_type").agg(F.count("chunk_id").alias("chunks"), F.min("page_start").alias("first_page"), F.max(F.coalesce("page_end", "page_start")).alias("last_page"))


@query("late_facts", "SELECT company_id, count(*) AS late FROM (SELECT fact_id, company_id, min(ingested_at) AS a, min(extracted_at) AS e FROM extracted_fact GROUP BY ALL) WHERE a > e + INTERVAL 3 DAY GROUP BY ALL")
def late_facts(spark: SparkSession, folder: str) -> DataFrame:
    first = read_table(spark, folder, "extracted_fact").groupBy("fact_id", "company_id").agg(F.min("ingested_at").alias("a"), F.min("extracted_at").alias("e"))
    return first.where(F.col("a") > F.col("e") + F.expr("INTERVAL 3 DAY")).groupBy("company_id").agg(F.count(F.lit(1)).alias("late"))


@query("event_windows", "SELECT CAST(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS VARCHAR) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    w = windowed_counts(read_table(spark, folder, "events"), "ts", ["event_type"], "6 hours", "1 day")
    return w.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


@query("series_rank", f"""
SELECT canonical_id, period, company_id, v AS value, rank FROM (SELECT *, rank() OVER (PARTITION BY canonical_id, period ORDER BY v DESC) AS rank FROM (
 SELECT canonical_id, period, company_id, max(normalised_value) AS v FROM {LOADED} WHERE canonical_id IS NOT NULL AND period IS NOT NULL AND company_id IS NOT NULL GROUP BY ALL)) WHERE rank <= 3""")
def series_rank(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder).dropna(subset=["canonical_id", "period", "company_id"])
    m = obs.groupBy("canonical_id", "period", "company_id").agg(F.max("normalised_value").alias("value"))  # one row a company: small groups
    return m.withColumn("rank", F.rank().over(Window.partitionBy("canonical_id", "period").orderBy(F.desc("value")))).where("rank <= 3")
