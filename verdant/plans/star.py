"""The analytic query surface over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdant.operators import star
from verdant.operators.review import touching_bands, value_band
from verdant.plans.catalogue import query
from verdant.sources import read_table

OBS = "(SELECT DISTINCT * EXCLUDE (loaded_at) FROM observation)"
DOCS = "(SELECT DISTINCT * EXCLUDE (ingested_at) FROM report_document)"
FACTS = "(SELECT DISTINCT * EXCLUDE (ingested_at) FROM extracted_fact)"
CHUNKS = "(SELECT DISTINCT * EXCLUDE (ingested_at) FROM report_chunk)"
SECTIONS = "(SELECT DISTINCT * EXCLUDE (ingested_at) FROM report_section)"
LOADED = f"""(SELECT o.*, d.fiscal_year AS document_period,
  CASE WHEN regexp_matches(o.period_label, '^(FY|CY)20[0-9][0-9]$') THEN o.period_label
       WHEN regexp_matches(o.period_label, '^20[0-9][0-9][-/][0-9][0-9]$') THEN 'FY20' || right(o.period_label, 2)
       ELSE d.fiscal_year END AS period
  FROM {OBS} o LEFT JOIN {DOCS} d ON o.source_doc_id = d.doc_id
  WHERE o.normalization_status IN ('normalized','partial','new_metric') AND o.normalised_value IS NOT NULL AND NOT isnan(o.normalised_value))"""


@query("cross_company_compare", f"""
SELECT canonical_id, period, company_id, obs_id, normalised_value, normalised_unit_symbol FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical_id, period, company_id ORDER BY normalised_value DESC, obs_id) AS n
  FROM {LOADED} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL AND period IS NOT NULL) WHERE n = 1""")
def cross_company_compare(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder).select("canonical_id", "period", "company_id", "obs_id", "normalised_value", "normalised_unit_symbol")
    return star.argmax_rows(obs.dropna(subset=["canonical_id", "period", "company_id"]), ["canonical_id", "period", "company_id"], "normalised_value", "obs_id")


@query("metric_time_series", f"""
SELECT company_id, canonical_id, period, normalised_unit_symbol, max(normalised_value) AS value, count(*) AS observations
FROM {LOADED} WHERE canonical_id IS NOT NULL GROUP BY ALL""")
def metric_time_series(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id is not null")
    return obs.groupBy("company_id", "canonical_id", "period", "normalised_unit_symbol").agg(F.max("normalised_value").alias("value"), F.count(F.lit(1)).alias("observations"))


@query("bounded_time_series", f"""
SELECT c.name, l.period, max(l.normalised_value) AS value FROM {LOADED} l JOIN company c USING (company_id)
JOIN consumer_master_registry_v1 r USING (canonical_id) WHERE r.category = 'water' AND l.normalised_value < 1e6 GROUP BY ALL""")
def bounded_time_series(spark: SparkSession, folder: str) -> DataFrame:
    metrics = read_table(spark, folder, "consumer_master_registry_v1").where("category = 'water'").select("canonical_id")
    obs = star.loaded(spark, folder, "normalised_value < 1e6").join(metrics, "canonical_id")
    named = obs.join(read_table(spark, folder, "company").select("company_id", "name"), "company_id")
    return named.groupBy("name", "period").agg(F.max("normalised_value").alias("value"))


@query("two_metric_compare", f"""
SELECT company_id, canonical_id, max(normalised_value) AS value FROM {LOADED}
WHERE canonical_id IN ('energy_green', 'energy_total') AND period = 'FY2024' GROUP BY ALL""")
def two_metric_compare(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, F.col("canonical_id").isin("energy_green", "energy_total")).where("period = 'FY2024'")
    return obs.groupBy("company_id", "canonical_id").agg(F.max("normalised_value").alias("value"))


@query("share_of_total", f"""
SELECT company_id, period, part, total, round(100 - 100 * part / total, 4) AS rest_percent FROM (
  SELECT company_id, period, max(CASE WHEN canonical_id = 'energy_green' THEN normalised_value END) AS part,
         max(CASE WHEN canonical_id = 'energy_total' THEN normalised_value END) AS total
  FROM {LOADED} GROUP BY ALL) WHERE part IS NOT NULL AND total > 0""")
def share_of_total(spark: SparkSession, folder: str) -> DataFrame:
    def most(metric):
        return F.max(F.when(F.col("canonical_id") == metric, F.col("normalised_value")))

    obs = star.loaded(spark, folder, F.col("canonical_id").isin("energy_green", "energy_total"))
    both = obs.groupBy("company_id", "period").agg(most("energy_green").alias("part"), most("energy_total").alias("total"))
    return both.where("part is not null and total > 0").withColumn("rest_percent", F.round(100 - 100 * F.col("part") / F.col("total"), 4))


@query("metric_ratio_self_join", f"""
SELECT a.company_id, a.period, round(max(a.normalised_value / b.normalised_value), 6) AS ratio
FROM {LOADED} a JOIN {LOADED} b ON a.company_id = b.company_id AND a.period = b.period
WHERE a.canonical_id = 'water_loop' AND b.canonical_id = 'water_in' AND b.normalised_value > 0 GROUP BY ALL""")
def metric_ratio_self_join(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id in ('water_loop', 'water_in')").select("company_id", "period", "canonical_id", "normalised_value")
    # The largest ratio is the largest numerator over the smallest denominator of its sign: one aggregation, no self-join.
    up, down = F.col("canonical_id") == "water_loop", (F.col("canonical_id") == "water_in") & (F.col("normalised_value") > 0)
    v = F.col("normalised_value")
    g = obs.where(up | down).groupBy("company_id", "period").agg(F.max(F.when(up, v)).alias("n"), F.min(F.when(down, v)).alias("lo"), F.max(F.when(down, v)).alias("hi"))
    g = g.where("n is not null and lo is not null and period is not null and company_id is not null")
    return g.select("company_id", "period", F.round(F.when(F.col("n") >= 0, F.col("n") / F.col("lo")).otherwise(F.col("n") / F.col("hi")), 6).alias("ratio"))


@query("raw_name_percent", f"""
SELECT company_id, raw_name, max(normalised_value) AS value FROM {LOADED}
WHERE contains(lower(raw_name), 'renewable') AND normalised_unit_symbol = '%' GROUP BY ALL""")
def raw_name_percent(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, F.lower("raw_name").contains("renewable") & (F.col("normalised_unit_symbol") == "%"))
    return obs.groupBy("company_id", "raw_name").agg(F.max("normalised_value").alias("value"))


@query("best_with_evidence", f"""
SELECT company_id, canonical_id, obs_id, name, display_name, report_type, section_title, evidence FROM (
  SELECT l.company_id, l.canonical_id, l.obs_id, c.name, r.display_name, d.report_type, k.section_title, f.evidence,
    row_number() OVER (PARTITION BY l.company_id, l.canonical_id ORDER BY l.normalised_value DESC, l.obs_id) AS n
  FROM {LOADED} l JOIN company c USING (company_id) JOIN consumer_master_registry_v1 r USING (canonical_id)
  JOIN {DOCS} d ON d.doc_id = l.source_doc_id JOIN {CHUNKS} k ON k.chunk_id = l.chunk_id
  JOIN {FACTS} f ON f.fact_id = l.source_fact_id) WHERE n = 1""")
def best_with_evidence(spark: SparkSession, folder: str) -> DataFrame:
    chunk = star.once(read_table(spark, folder, "report_chunk").select("chunk_id", "section_title", "ingested_at"), "chunk_id", "ingested_at")
    fact = read_table(spark, folder, "extracted_fact").select(F.col("fact_id").alias("source_fact_id"), "evidence").dropDuplicates(["source_fact_id"])
    doc = star.report_documents(spark, folder).select(F.col("doc_id").alias("source_doc_id"), "report_type")
    company = read_table(spark, folder, "company").select("company_id", "name")
    metric = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "display_name")
    obs = star.loaded(spark, folder).select("company_id", "canonical_id", "obs_id", "normalised_value", "source_doc_id", "chunk_id", "source_fact_id")
    whole = obs.join(company, "company_id").join(metric, "canonical_id").join(doc, "source_doc_id").join(chunk.select("chunk_id"), "chunk_id", "left_semi")
    whole = whole.join(fact.select("source_fact_id"), "source_fact_id", "left_semi")
    best = star.argmax_rows(whole, ["company_id", "canonical_id"], "normalised_value", "obs_id")  # texts join the winners only
    return best.join(chunk, "chunk_id").join(fact, "source_fact_id").select("company_id", "canonical_id", "obs_id", "name", "display_name", "report_type", "section_title", "evidence")


@query("metric_explorer", f"""
SELECT canonical_id, period, company_id, round(max(normalised_value) / 1000.0, 6) AS value_thousands
FROM {LOADED} WHERE period IN ('FY2023', 'FY2024') AND canonical_id IS NOT NULL GROUP BY ALL""")
def metric_explorer(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id is not null").where(F.col("period").isin("FY2023", "FY2024"))
    return obs.groupBy("canonical_id", "period", "company_id").agg(F.round(F.max("normalised_value") / 1000.0, 6).alias("value_thousands"))


@query("keyword_or_metric", f"""
SELECT o.obs_id, o.raw_name, c.name FROM {OBS} o LEFT JOIN company c USING (company_id)
WHERE EXISTS (SELECT 1 FROM consumer_master_registry_v1 r WHERE r.canonical_id = o.canonical_id AND r.category = 'waste')
   OR (o.canonical_id IS NULL AND contains(lower(o.raw_name), 'waste'))""")
def keyword_or_metric(spark: SparkSession, folder: str) -> DataFrame:
    metrics = read_table(spark, folder, "consumer_master_registry_v1").where("category = 'waste'").select("canonical_id").distinct().withColumn("hit", F.lit(True))
    obs = star.observations(spark, folder).join(metrics, "canonical_id", "left")
    kept = obs.where(F.col("hit").isNotNull() | (F.col("canonical_id").isNull() & F.lower("raw_name").contains("waste")))
    return kept.join(read_table(spark, folder, "company").select("company_id", "name"), "company_id", "left").select("obs_id", "raw_name", "name")


@query("headcount_rows", f"""
SELECT obs_id, company_id, raw_name, normalised_value FROM {LOADED} WHERE canonical_id = 'staff_total'
AND normalised_value BETWEEN 10 AND 1000000 AND NOT contains(lower(raw_name), 'restated') AND NOT contains(lower(raw_name), 'contract')""")
def headcount_rows(spark: SparkSession, folder: str) -> DataFrame:
    name = F.lower("raw_name")
    obs = star.loaded(spark, folder, (F.col("canonical_id") == "staff_total") & F.col("normalised_value").between(10, 1_000_000))
    return obs.where(~name.contains("restated") & ~name.contains("contract")).select("obs_id", "company_id", "raw_name", "normalised_value")


@query("raw_name_listing", f"""
SELECT company_id, raw_name, raw_value, raw_unit_string, page FROM {OBS} WHERE starts_with(lower(raw_name), 'scope')""")
def raw_name_listing(spark: SparkSession, folder: str) -> DataFrame:
    return star.observations(spark, folder, F.lower("raw_name").startswith("scope")).select("company_id", "raw_name", "raw_value", "raw_unit_string", "page")


@query("graph_stats", f"""
SELECT 'observation' AS kind, count(*) AS n FROM {OBS} UNION ALL SELECT 'document', count(*) FROM {DOCS}
UNION ALL SELECT 'chunk', count(*) FROM {CHUNKS} UNION ALL SELECT 'section', count(*) FROM {SECTIONS}
UNION ALL SELECT 'company', count(*) FROM company UNION ALL SELECT 'metric', count(*) FROM consumer_master_registry_v1
UNION ALL SELECT 'period', count(DISTINCT period) FROM {LOADED}""")
def graph_stats(spark: SparkSession, folder: str) -> DataFrame:
    keys = {"observation": ("observation", "obs_id"), "document": ("report_document", "doc_id"), "chunk": ("report_chunk", "chunk_id"), "section": ("report_section", "section_id"), "company": ("company", "company_id"), "metric": ("consumer_master_registry_v1", "canonical_id")}
    out = star.loaded(spark, folder).agg(F.count_distinct("period").alias("n")).select(F.lit("period").alias("kind"), "n")
    for kind, (table, key) in keys.items():
        out = out.unionByName(read_table(spark, folder, table).agg(F.count_distinct(key).alias("n")).select(F.lit(kind).alias("kind"), "n"))
    return out


@query("observations_of_metric", f"""
SELECT canonical_id, company_id, period, count(*) AS n, min(normalised_value) AS least, max(normalised_value) AS most FROM {LOADED}
WHERE canonical_id IS NOT NULL GROUP BY ALL""")
def observations_of_metric(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id is not null")
    return obs.groupBy("canonical_id", "company_id", "period").agg(F.count(F.lit(1)).alias("n"), F.min("normalised_value").alias("least"), F.max("normalised_value").alias("most"))


@query("provisional_frequency", f"""
SELECT lower(trim(raw_name)) AS name, count(*) AS n, count(DISTINCT company_id) AS companies FROM {OBS}
WHERE normalization_status = 'new_metric' GROUP BY ALL ORDER BY n DESC, name LIMIT 20""")
def provisional_frequency(spark: SparkSession, folder: str) -> DataFrame:
    new = star.observations(spark, folder, "normalization_status = 'new_metric'")
    counts = new.groupBy(F.lower(F.trim("raw_name")).alias("name")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("company_id").alias("companies"))
    return counts.orderBy(F.desc("n"), "name").limit(20)  # a top-20 report


@query("facts_of_chunk", f"""
SELECT k.chunk_id, count(f.fact_id) AS facts, count(o.obs_id) AS loaded FROM {CHUNKS} k LEFT JOIN {FACTS} f USING (chunk_id)
LEFT JOIN {OBS} o ON o.source_fact_id = f.fact_id GROUP BY ALL""")
def facts_of_chunk(spark: SparkSession, folder: str) -> DataFrame:
    chunks = read_table(spark, folder, "report_chunk").select("chunk_id").distinct()
    facts = read_table(spark, folder, "extracted_fact").select("fact_id", "chunk_id").distinct()
    obs = read_table(spark, folder, "observation").select("obs_id", F.col("source_fact_id").alias("fact_id")).distinct()
    joined = chunks.join(facts, "chunk_id", "left").join(obs, "fact_id", "left")
    return joined.groupBy("chunk_id").agg(F.count("fact_id").alias("facts"), F.count("obs_id").alias("loaded"))


@query("load_verification", f"""
SELECT source_doc_id, count(DISTINCT obs_id) AS observations, count(DISTINCT chunk_id) AS chunks, count(DISTINCT canonical_id) AS metrics
FROM {OBS} GROUP BY ALL""")
def load_verification(spark: SparkSession, folder: str) -> DataFrame:
    obs = read_table(spark, folder, "observation")
    return obs.groupBy("source_doc_id").agg(F.count_distinct("obs_id").alias("observations"), F.count_distinct("chunk_id").alias("chunks"), F.count_distinct("canonical_id").alias("metrics"))


@query("status_pivot", f"""
SELECT company_id, count(*) FILTER (normalization_status = 'normalized') AS normalized, count(*) FILTER (normalization_status = 'partial') AS "partial",
count(*) FILTER (normalization_status = 'new_metric') AS new_metric, count(*) FILTER (normalization_status = 'quarantine') AS quarantine FROM {OBS} GROUP BY ALL""")
def status_pivot(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("normalization_status")
    return star.observations(spark, folder).groupBy("company_id").agg(*(F.count_if(status == s).alias(s) for s in ("normalized", "partial", "new_metric", "quarantine")))


@query("metric_cross_listing", f"""
SELECT canonical_id, count(DISTINCT company_id) AS companies, count(DISTINCT source_doc_id) AS documents FROM {OBS} WHERE canonical_id IS NOT NULL
GROUP BY ALL HAVING count(DISTINCT company_id) > 1""")
def metric_cross_listing(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder, "canonical_id is not null")
    return obs.groupBy("canonical_id").agg(F.count_distinct("company_id").alias("companies"), F.count_distinct("source_doc_id").alias("documents")).where("companies > 1")


@query("change_first_to_last", f"""
WITH m AS (SELECT company_id, canonical_id, period, max(normalised_value) AS v FROM {LOADED} WHERE canonical_id IS NOT NULL AND starts_with(period, 'FY') GROUP BY ALL)
SELECT company_id, canonical_id, min(period) AS first_period, max(period) AS last_period,
  round(100 * (arg_max(v, period) - arg_min(v, period)) / arg_min(v, period), 4) AS change_percent
FROM m GROUP BY ALL HAVING count(*) > 1 AND arg_min(v, period) <> 0""")
def change_first_to_last(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id is not null").where("period like 'FY%'")
    m = obs.groupBy("company_id", "canonical_id", "period").agg(F.max("normalised_value").alias("v"))
    ends = m.groupBy("company_id", "canonical_id").agg(F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.min_by("v", "period").alias("a"), F.max_by("v", "period").alias("b"), F.count(F.lit(1)).alias("n"))
    return ends.where("n > 1 and a <> 0").select("company_id", "canonical_id", "first_period", "last_period", F.round(100 * (F.col("b") - F.col("a")) / F.col("a"), 4).alias("change_percent"))


@query("largest_summed_scopes", f"""
WITH m AS (SELECT company_id, period, canonical_id, max(normalised_value) AS v FROM {LOADED}
  WHERE canonical_id IN ('ghg_direct_total', 'ghg_power_location', 'ghg_value_chain') GROUP BY ALL),
s AS (SELECT company_id, period, round(sum(v), 2) AS total FROM m GROUP BY ALL)
SELECT period, company_id, total FROM (SELECT *, row_number() OVER (PARTITION BY period ORDER BY total DESC, company_id) AS n FROM s WHERE period IS NOT NULL) WHERE n = 1""")
def largest_summed_scopes(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, F.col("canonical_id").isin("ghg_direct_total", "ghg_power_location", "ghg_value_chain")).where("period is not null")
    m = obs.groupBy("company_id", "period", "canonical_id").agg(F.max("normalised_value").alias("v"))
    s = m.groupBy("company_id", "period").agg(F.round(F.sum("v"), 2).alias("total"))
    return star.argmax_rows(s, ["period"], "total", "company_id").select("period", "company_id", "total")


@query("orphan_documents", f"SELECT doc_id, company_id FROM {DOCS} d WHERE NOT EXISTS (SELECT 1 FROM observation o WHERE o.source_doc_id = d.doc_id AND o.normalization_status = 'normalized')")
def orphan_documents(spark: SparkSession, folder: str) -> DataFrame:
    seen = read_table(spark, folder, "observation").where("normalization_status = 'normalized'").select(F.col("source_doc_id").alias("doc_id"))
    return star.report_documents(spark, folder).join(seen, "doc_id", "left_anti").select("doc_id", "company_id")


@query("provenance_path", f"""
SELECT o.obs_id, k.chunk_id, s.section_id, d.doc_id, d.company_id FROM {OBS} o JOIN {CHUNKS} k ON k.chunk_id = o.chunk_id
JOIN {SECTIONS} s ON s.section_id = k.section_id JOIN {DOCS} d ON d.doc_id = s.doc_id""")
def provenance_path(spark: SparkSession, folder: str) -> DataFrame:
    obs = read_table(spark, folder, "observation").select("obs_id", "chunk_id").distinct()
    chunk = read_table(spark, folder, "report_chunk").select("chunk_id", "section_id").distinct()
    section = read_table(spark, folder, "report_section").select("section_id", "doc_id").distinct()
    doc = star.report_documents(spark, folder).select("doc_id", "company_id")
    return obs.join(chunk, "chunk_id").join(section, "section_id").join(doc, "doc_id").select("obs_id", "chunk_id", "section_id", "doc_id", "company_id")


@query("company_total_ties", f"""
SELECT obs_id, company_id, canonical_id, normalised_value FROM (
  SELECT *, max(normalised_value) OVER (PARTITION BY company_id, canonical_id, period) AS most FROM {LOADED} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL AND period IS NOT NULL) WHERE normalised_value = most""")
def company_total_ties(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["company_id", "canonical_id", "period"]
    obs = star.loaded(spark, folder).dropna(subset=keys).select("obs_id", *keys, "normalised_value")
    most = obs.groupBy(*keys).agg(F.max("normalised_value").alias("most"))
    return obs.join(most, keys).where("normalised_value = most").select("obs_id", "company_id", "canonical_id", "normalised_value")


@query("status_refresh", f"""
SELECT o.obs_id, CASE WHEN o.normalization_status = 'new_metric' AND r.canonical_id IS NOT NULL THEN 'normalized' ELSE o.normalization_status END AS status,
coalesce(o.canonical_id, CASE WHEN o.normalization_status = 'new_metric' THEN r.canonical_id END) AS canonical_id
FROM {OBS} o LEFT JOIN (SELECT canonical_id, lower(display_name) AS key FROM consumer_master_registry_v1) r ON lower(trim(o.raw_name)) = r.key""")
def status_refresh(spark: SparkSession, folder: str) -> DataFrame:
    names = read_table(spark, folder, "consumer_master_registry_v1").select(F.col("canonical_id").alias("known"), F.lower("display_name").alias("key"))
    obs = star.observations(spark, folder)
    joined = obs.join(names, F.lower(F.trim("raw_name")) == F.col("key"), "left")
    new = F.col("normalization_status") == "new_metric"
    return joined.select("obs_id", F.when(new & F.col("known").isNotNull(), "normalized").otherwise(F.col("normalization_status")).alias("status"), F.coalesce("canonical_id", F.when(new, F.col("known"))).alias("canonical_id"))


@query("tolerance_match", f"""
SELECT a.obs_id AS incoming, b.obs_id AS existing FROM {LOADED} a JOIN {LOADED} b
ON a.company_id = b.company_id AND a.canonical_id = b.canonical_id AND a.period = b.period AND a.source_doc_id > b.source_doc_id
AND b.normalised_value BETWEEN least(a.normalised_value * 0.99, a.normalised_value * 1.01) AND greatest(a.normalised_value * 0.99, a.normalised_value * 1.01)""")
def tolerance_match(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder).select("obs_id", "company_id", "canonical_id", "period", "source_doc_id", "normalised_value")
    v = F.col("a.normalised_value")
    # Values meet in bands of one percent, so a hot key is not compared with itself.
    a = obs.withColumn("band", F.explode(touching_bands(F.col("normalised_value"), 0.01))).alias("a")
    b = obs.withColumn("band", value_band(F.col("normalised_value"), 0.01)).alias("b")
    same = (F.col("a.company_id") == F.col("b.company_id")) & (F.col("a.canonical_id") == F.col("b.canonical_id")) & (F.col("a.period") == F.col("b.period")) & (F.col("a.band") == F.col("b.band"))
    near = F.col("b.normalised_value").between(F.least(v * 0.99, v * 1.01), F.greatest(v * 0.99, v * 1.01)) & (F.col("a.source_doc_id") > F.col("b.source_doc_id"))
    return a.join(b, same & near).select(F.col("a.obs_id").alias("incoming"), F.col("b.obs_id").alias("existing"))


@query("nearest_facts", f"""
SELECT obs_id, other, rank FROM (
  SELECT a.obs_id, b.obs_id AS other, row_number() OVER (PARTITION BY a.obs_id ORDER BY abs(a.normalised_value - b.normalised_value), b.obs_id) AS rank
  FROM {LOADED} a JOIN {LOADED} b ON a.company_id = b.company_id AND a.canonical_id = b.canonical_id AND a.period = b.period AND a.obs_id <> b.obs_id
  WHERE abs(a.normalised_value - b.normalised_value) <= CASE WHEN a.normalised_value = 0 THEN 1 ELSE 0.02 * abs(a.normalised_value) END) WHERE rank <= 5""")
def nearest_facts(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder).select("obs_id", "company_id", "canonical_id", "period", "normalised_value")
    # Bands of two percent; what lies within 1 of zero meets zeros in a band of its own.
    x = F.col("normalised_value")
    zero = F.array(F.struct(F.lit(9).alias("sign"), F.lit(0).cast("long").alias("band")))
    a = obs.withColumn("band", F.explode(F.when(x == 0, zero).otherwise(touching_bands(x, 0.02)))).alias("a")
    own = F.array(value_band(x, 0.02))
    b = obs.withColumn("band", F.explode(F.when(F.abs(x) <= 1, F.concat(own, zero)).otherwise(own))).alias("b")
    v, gap = F.col("a.normalised_value"), F.abs(F.col("a.normalised_value") - F.col("b.normalised_value"))
    same = (F.col("a.company_id") == F.col("b.company_id")) & (F.col("a.canonical_id") == F.col("b.canonical_id")) & (F.col("a.period") == F.col("b.period")) & (F.col("a.obs_id") != F.col("b.obs_id")) & (F.col("a.band") == F.col("b.band"))
    near = a.join(b, same & (gap <= F.when(v == 0, 1.0).otherwise(F.lit(0.02) * F.abs(v)))).select(F.col("a.obs_id").alias("obs_id"), F.col("b.obs_id").alias("other"), gap.alias("gap"))
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("obs_id").orderBy("gap", "other"))).where("rank <= 5").select("obs_id", "other", "rank")


@query("cross_document_dedup", f"""
SELECT obs_id, company_id, canonical_id, period, source_doc_id FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, canonical_id, period, round(normalised_value, 2)
    ORDER BY abs(CAST(regexp_extract(period, '([0-9][0-9][0-9][0-9])', 1) AS INT) - CAST(regexp_extract(document_period, '([0-9][0-9][0-9][0-9])', 1) AS INT)) NULLS LAST, source_doc_id, obs_id) AS n
  FROM {LOADED} WHERE canonical_id IS NOT NULL AND period IS NOT NULL AND company_id IS NOT NULL) WHERE n = 1""")
def cross_document_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from verdant.functions.period import label_year

    obs = star.loaded(spark, folder).dropna(subset=["canonical_id", "period", "company_id"])
    far = F.coalesce(F.abs(label_year(F.col("period")) - label_year(F.col("document_period"))), F.lit(2**30))
    obs = obs.withColumns({"far": far, "v": F.round("normalised_value", 2)})
    best = obs.groupBy("company_id", "canonical_id", "period", "v").agg(F.min(F.struct("far", "source_doc_id", "obs_id")).alias("b"))
    return best.select(F.col("b.obs_id").alias("obs_id"), "company_id", "canonical_id", "period", F.col("b.source_doc_id").alias("source_doc_id"))


@query("registry_override_merge", f"""
WITH seen AS (SELECT canonical_id, min(normalised_unit_symbol) AS unit FROM {OBS} WHERE canonical_id IS NOT NULL GROUP BY ALL)
SELECT coalesce(r.canonical_id, s.canonical_id) AS canonical_id, coalesce(r.unit, s.unit) AS keep_base, coalesce(s.unit, r.unit) AS keep_override
FROM consumer_master_registry_v1 r FULL OUTER JOIN seen s ON r.canonical_id = s.canonical_id""")
def registry_override_merge(spark: SparkSession, folder: str) -> DataFrame:
    seen = star.observations(spark, folder, "canonical_id is not null").groupBy("canonical_id").agg(F.min("normalised_unit_symbol").alias("over"))
    base = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "unit")
    return base.join(seen, "canonical_id", "full").select("canonical_id", F.coalesce("unit", "over").alias("keep_base"), F.coalesce("over", "unit").alias("keep_override"))


@query("upsert_latest_events", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def upsert_latest_events(spark: SparkSession, folder: str) -> DataFrame:
    return star.upsert_latest(read_table(spark, folder, "events").select("user_id", "event_id", "event_type", "value", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("measured_in_edges", f"SELECT DISTINCT o.obs_id, u.from_symbol AS symbol FROM {OBS} o JOIN unit_conversion u ON o.normalised_unit_symbol = u.from_symbol")
def measured_in_edges(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder)
    units = read_table(spark, folder, "unit_conversion").select(F.col("from_symbol").alias("symbol"))
    return star.edges(obs, units, "normalised_unit_symbol", "symbol", ["obs_id", "symbol"])


@query("provisional_numbering", f"""
SELECT company_id, name, CAST(number AS INT) AS number, 'prov_' || company_id || '_' || lpad(CAST(number AS VARCHAR), 6, '0') AS id FROM (
  SELECT company_id, name, row_number() OVER (PARTITION BY company_id ORDER BY first, name) AS number FROM (
    SELECT company_id, lower(trim(raw_name)) AS name, min(obs_id) AS first FROM {OBS} WHERE normalization_status = 'new_metric' AND company_id IS NOT NULL GROUP BY ALL))""")
def provisional_numbering(spark: SparkSession, folder: str) -> DataFrame:
    new = star.observations(spark, folder, "normalization_status = 'new_metric' and company_id is not null").select("company_id", F.lower(F.trim("raw_name")).alias("name"), "obs_id")
    label = F.concat(F.lit("prov_"), F.col("company_id"), F.lit("_"), F.lpad(F.col("number").cast("string"), 6, "0"))
    return star.numbered_first_seen(new, "company_id", "name", "obs_id", label)


@query("uniqueness_violations", "SELECT obs_id, count(*) AS rows FROM observation GROUP BY obs_id HAVING count(*) > 1")
def uniqueness_violations(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "observation").groupBy("obs_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


@query("year_chain", f"""
SELECT fiscal_year, prefix, lead(fiscal_year) OVER (PARTITION BY prefix ORDER BY fiscal_year) AS next_year FROM (
  SELECT DISTINCT fiscal_year, left(fiscal_year, 2) AS prefix FROM {DOCS} WHERE fiscal_year IS NOT NULL)""")
def year_chain(spark: SparkSession, folder: str) -> DataFrame:
    years = star.report_documents(spark, folder, "fiscal_year is not null").select("fiscal_year", F.substring("fiscal_year", 1, 2).alias("prefix")).distinct()
    return years.withColumn("next_year", F.lead("fiscal_year").over(Window.partitionBy("prefix").orderBy("fiscal_year")))


@query("extreme_movement", f"""
WITH m AS (SELECT company_id, canonical_id, period, max(normalised_value) AS v FROM {LOADED} WHERE canonical_id IS NOT NULL AND starts_with(period, 'FY') GROUP BY ALL),
w AS (SELECT *, lag(v) OVER (PARTITION BY company_id, canonical_id ORDER BY period) AS prior FROM m)
SELECT company_id, canonical_id, period, v AS value, prior FROM w WHERE prior IS NOT NULL AND prior <> 0 AND abs((v - prior) / prior) > 1""")
def extreme_movement(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.loaded(spark, folder, "canonical_id is not null").where("period like 'FY%'")
    m = obs.groupBy("company_id", "canonical_id", "period").agg(F.max("normalised_value").alias("value"))
    m = m.withColumn("prior", F.lag("value").over(Window.partitionBy("company_id", "canonical_id").orderBy("period")))  # one row a year
    return m.where("prior <> 0 and abs((value - prior) / prior) > 1")


@query("category_rollup", """
WITH RECURSIVE tree AS (SELECT 'region:' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent FROM region
  UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation),
up AS (SELECT id, id AS top FROM tree WHERE parent IS NULL UNION ALL SELECT t.id, u.top FROM tree t JOIN up u ON t.parent = u.id)
SELECT u.top, count(c.c_custkey) AS customers, round(sum(c.c_acctbal), 2) AS balance FROM up u JOIN customer c ON u.id = 'nation:' || c.c_nationkey GROUP BY ALL""")
def category_rollup(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation").join(read_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation = nation.select("n_nationkey", F.concat(F.lit("region:"), F.col("r_regionkey").cast("string")).alias("top"))
    by_nation = read_table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("b"))
    joined = by_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("top").agg(F.sum("n").alias("customers"), F.round(F.sum("b"), 2).alias("balance"))


@query("fiscal_year_sales", """
SELECT n.n_name, CASE WHEN month(o.o_orderdate) >= 4 THEN 'FY' || (year(o.o_orderdate) + 1) ELSE 'FY' || year(o.o_orderdate) END AS period, p.p_type, max(l.l_extendedprice) AS most
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey GROUP BY ALL""")
def fiscal_year_sales(spark: SparkSession, folder: str) -> DataFrame:
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = read_table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(nation, "n_nationkey")
    year = F.year(F.add_months(F.col("o_orderdate").cast("date"), 9))
    orders = read_table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.concat(F.lit("FY"), year.cast("string")).alias("period"))
    part = read_table(spark, folder, "part").select("p_partkey", "p_type")
    lines = read_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    joined = lines.join(orders, "o_orderkey").join(customer, "c_custkey").join(part, "p_partkey")
    return joined.groupBy("n_name", "period", "p_type").agg(F.max("l_extendedprice").alias("most"))
