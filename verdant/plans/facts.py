"""Queries on what facts say, how they match the registry, and how units are normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import facts as say
from verdant.operators import matching, star
from verdant.plans.catalogue import query
from verdant.plans.star import FACTS, LOADED
from verdant.sources import providers, read_table


_N = "(-?[0-9][0-9,]*\\.?[0-9]*)"
_FT = f"(?i)\\bfrom\\s+{_N}[^.;]*?\\bto\\s+{_N}"
_BA = f"(?i)\\bbetween\\s+{_N}[^.;]*?\\band\\s+{_N}"
_BY = f"(?i)\\b(?:by|of)\\s+{_N}\\s*(?:%|per\\s?cent|percent|bps|basis points)"


def _num(pattern: str, group: int, text: str = "s") -> str:
    return f"try_cast(nullif(replace(regexp_extract({text}, '{pattern}', {group}), ',', ''), '') AS DOUBLE)"


_UP, _DOWN = "(?i)\\b(increas|rose|risen|grew|grown|improv|higher|climbed)", "(?i)\\b(reduc|declin|decreas|fell|fallen|lower|cut|saved)"
_INTERPRETED = f"""y AS (SELECT *, {_num(_FT, 1, '{text}')} AS a1, {_num(_FT, 2, '{text}')} AS b1, {_num(_BA, 1, '{text}')} AS a2, {_num(_BA, 2, '{text}')} AS b2, {_num(_BY, 1, '{text}')} AS by_, regexp_matches({{text}}, '{_UP}') AS up, regexp_matches({{text}}, '{_DOWN}') AS down FROM {{source}}),
y2 AS (SELECT *, CASE WHEN a1 IS NOT NULL AND b1 IS NOT NULL THEN 'transition' WHEN a2 IS NOT NULL AND b2 IS NOT NULL THEN 'range' WHEN by_ IS NOT NULL THEN 'change' ELSE 'scalar' END AS kind FROM y),
z AS (SELECT *, CASE kind WHEN 'transition' THEN a1 WHEN 'range' THEN a2 WHEN 'change' THEN by_ END AS first, CASE kind WHEN 'transition' THEN b1 WHEN 'range' THEN b2 END AS second,
 coalesce(CASE WHEN kind = 'transition' AND a1 < b1 THEN 'up' WHEN kind = 'transition' AND a1 > b1 THEN 'down' END, CASE WHEN down AND NOT up THEN 'down' WHEN up AND NOT down THEN 'up' END) AS direction FROM y2)"""


@query("fact_interpretation", f"""
WITH x AS (SELECT fact_id, coalesce(evidence, '') AS s FROM {FACTS}), {_INTERPRETED.format(source='x', text='s')} SELECT fact_id, kind, first, second, direction FROM z""")
def fact_interpretation(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", say.interpretation(F.col("evidence")).alias("i")).select("fact_id", "i.*")


@query("fact_dimensions", f"""
WITH x AS (SELECT fact_id, lower(coalesce(metric, '')) AS t FROM {FACTS}), y AS (SELECT *, regexp_matches(t, '\\b(women|female|females)\\b') AS f, regexp_matches(t, '\\b(men|male|males)\\b') AS m,
 regexp_extract(t, '\\b(plastic|paper|glass|metal|cartonboard)\\b', 1) AS p, regexp_extract(t, '\\bin (india|brazil|france|germany|spain|china|usa|japan)\\b', 1) AS c FROM x)
SELECT fact_id, CASE WHEN f OR m THEN 'gender' WHEN contains(t, 'pack') AND p <> '' THEN 'packaging' WHEN c <> '' THEN 'country' END AS type,
CASE WHEN f THEN 'female' WHEN m THEN 'male' WHEN contains(t, 'pack') AND p <> '' THEN p WHEN c <> '' THEN c END AS member FROM y""")
def fact_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", say.dimension(F.col("metric")).alias("d")).select("fact_id", "d.type", "d.member")


@query("period_types", f"""
WITH x AS (SELECT fact_id, lower(trim(period_type)) AS k, fact_type, lower(coalesce(period, '') || ' ' || coalesce(evidence, '')) AS t FROM {FACTS})
SELECT fact_id, CASE WHEN k IS NOT NULL AND k NOT IN ('', 'unknown') THEN k WHEN fact_type = 'target' OR regexp_matches(t, '\\bby (?:19|20)[0-9]{{2}}\\b') THEN 'target'
 WHEN fact_type = 'baseline' OR contains(t, 'baseline') THEN 'baseline' WHEN regexp_matches(t, '\\bsince\\b|\\bcumulative') THEN 'cumulative' WHEN regexp_matches(t, '\\bas (?:of|at|on)\\b') THEN 'point_in_time'
 WHEN regexp_matches(t, '\\b(?:q[1-4]|h[12]|quarter|half[- ]year|months ended)\\b') THEN 'partial' WHEN regexp_matches(t, '(?:fy|cy)\\s?20[0-9]{{2}}|20[0-9]{{2}}[-/][0-9]{{2}}') THEN 'full_year' ELSE 'unknown' END AS period_type FROM x""")
def period_types(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", say.period_type(F.col("period_type"), F.col("period"), F.col("evidence"), F.col("fact_type")).alias("period_type"))


def _scored(spark: SparkSession, folder: str, unmatched: bool = True) -> DataFrame:
    facts = star.facts(spark, folder).select(F.col("fact_id").alias("key"), F.lower(F.trim("metric")).alias("name"), "unit")
    return matching.candidates(facts, read_table(spark, folder, "consumer_master_registry_v1"), unmatched=unmatched)


@query("metric_candidates")
def metric_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, unmatched=False)


@query("metric_decisions")
def metric_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return matching.decide(_scored(spark, folder))


@query("match_calibration")
def match_calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the decisions against the metrics of the loaded observations."""
    truth = star.observations(spark, folder, "canonical_id is not null").groupBy(F.col("source_fact_id").alias("key")).agg(F.min("canonical_id").alias("expected"))
    return matching.calibrate(matching.decide(_scored(spark, folder)), truth)


@query("magnitude_guard", f"""
SELECT l.obs_id, CASE WHEN l.canonical_id = 'ghg_value_chain' AND l.normalised_value < 0.01 * t.top THEN 'quarantine' ELSE l.normalization_status END AS status FROM {LOADED} l
LEFT JOIN (SELECT source_doc_id, max(normalised_value) AS top FROM {LOADED} WHERE canonical_id = 'ghg_direct_total' GROUP BY ALL) t ON t.source_doc_id = l.source_doc_id""")
def magnitude_guard(spark: SparkSession, folder: str) -> DataFrame:
    return matching.magnitude_guard(star.loaded(spark, folder), ["source_doc_id"], "ghg_value_chain", "ghg_direct_total").select("obs_id", "status")


@query("extracted_from_chunks")
def extracted_from_chunks(spark: SparkSession, folder: str) -> DataFrame:
    chunks = read_table(spark, folder, "report_chunk").select("chunk_id", "content").dropDuplicates(["chunk_id"])
    return providers.extract_facts(chunks)
