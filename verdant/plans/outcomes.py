"""Outcome rows: definitions, bindings, flags, back-filled confidence and gaps, each beside its statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions.period import fiscal_bounds, label_year
from verdant.operators import star
from verdant.plans.catalogue import _ORACLES, query
from verdant.plans.review import _SCORED, _shortlist
from verdant.plans.rules import alias_gate
from verdant.plans.star import DOCS, FACTS, OBS
from verdant.sources import read_table

# How a metric without a definition of its own is described, by the family of its unit.
DEFINITIONS = {
    "count": "The number or count of {} reported during the period.", "percentage": "The percentage, rate, or share associated with {}.", "percent": "The percentage, rate, or share associated with {}.",
    "ratio": "A ratio-based measure of {}.", "time": "The amount of time associated with {}.", "volume": "The volume associated with {}.", "weight": "The weight or mass associated with {}.",
    "money": "The monetary amount associated with {}.", "monetary": "The monetary amount associated with {}.",
}
OTHERWISE = "A business metric measuring {}."
# Texts that stand for a definition that could not be made.
NO_DEFINITION = ("unknown", "n/a", "na", "none", "null", "a mathematical ratio expressed as a fraction of 100.")


def described(family: Column, alias: Column) -> Column:
    templates = F.create_map(*(F.lit(x) for pair in DEFINITIONS.items() for x in pair))
    return F.replace(F.coalesce(F.try_element_at(templates, F.lower(F.trim(family))), F.lit(OTHERWISE)), F.lit("{}"), alias)


def definition_failed(text: Column) -> Column:
    """Whether a definition is missing, a placeholder or under four words."""
    t = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))
    return (t == "") | t.isin(*NO_DEFINITION) | (F.size(F.split(t, " ")) < 4)


_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DEFINITIONS.items())


@query("definitions", f"""
WITH a AS (SELECT canonical_id, notes, lower(trim(unit_family)) AS f, lower(trim(coalesce(aliases[1], display_name))) AS alias FROM consumer_master_registry_v1)
SELECT canonical_id, CASE WHEN trim(coalesce(notes, '')) = '' OR lower(trim(notes)) IN ('unknown', 'n/a', 'na', 'none', 'null') OR len(string_split(trim(regexp_replace(notes, '\\s+', ' ', 'g')), ' ')) < 4
 THEN replace(CASE f {_CASES} ELSE '{OTHERWISE}' END, '{{}}', alias) ELSE notes END AS definition FROM a""")
def definitions(spark: SparkSession, folder: str) -> DataFrame:
    """A definition of every registry entry: its notes, or a sentence made from its unit family and first alias."""
    reg = read_table(spark, folder, "consumer_master_registry_v1")
    alias = F.lower(F.trim(F.coalesce(F.get("aliases", F.lit(0)), "display_name")))
    return reg.select("canonical_id", F.when(definition_failed(F.col("notes")), described(F.col("unit_family"), alias)).otherwise(F.col("notes")).alias("definition"))


@query("facts_with_definitions", f"""
WITH d AS ({_ORACLES.get('definitions', '%s')}), k AS (SELECT key, min(canonical_id) AS canonical_id FROM (SELECT canonical_id, lower(trim(unnest(list_concat(coalesce(aliases, []), [display_name])))) AS key FROM consumer_master_registry_v1) GROUP BY key)
SELECT f.fact_id, k.canonical_id, d.definition, CASE WHEN d.definition IS NULL THEN 'low' WHEN f.confidence >= 0.8 AND NOT isnan(f.confidence) THEN 'high' ELSE 'medium' END AS confidence
FROM {FACTS} f LEFT JOIN k ON lower(trim(f.metric)) = k.key LEFT JOIN d ON d.canonical_id = k.canonical_id""")
def facts_with_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with the definition of the entry their name is an alias of; without one the confidence is low."""
    reg = read_table(spark, folder, "consumer_master_registry_v1")
    names = reg.select("canonical_id", F.explode(F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array("display_name"))).alias("n"))
    keys = names.groupBy(F.lower(F.trim("n")).alias("key")).agg(F.min("canonical_id").alias("canonical_id"))
    facts = star.facts(spark, folder).select("fact_id", F.lower(F.trim("metric")).alias("key"), F.col("confidence").alias("c"))
    joined = facts.join(keys, "key", "left").join(definitions(spark, folder), "canonical_id", "left")
    sure = (F.col("c") >= 0.8) & ~F.isnan("c")
    return joined.select("fact_id", "canonical_id", "definition", F.when(F.col("definition").isNull(), "low").when(sure, "high").otherwise("medium").alias("confidence"))


@query("bound_names", f"""
WITH b AS (SELECT fact_id, trim(coalesce(metric, '')) AS m, nullif(nullif(trim(coalesce(entity, '')), ''), '-') AS e, nullif(nullif(trim(coalesce(segment, '')), ''), '-') AS s FROM {FACTS})
SELECT fact_id, CASE WHEN m <> '' AND coalesce(s, e) IS NOT NULL AND NOT contains(lower(m), lower(coalesce(s, e))) THEN m || ' (' || coalesce(s, e) || ')' ELSE m END AS name,
 CASE WHEN s IS NOT NULL THEN 'segment' WHEN e IS NOT NULL THEN 'entity' ELSE 'none' END AS dimension_type, coalesce(s, e, '') AS member, CASE WHEN coalesce(s, e) IS NULL THEN 'whole' ELSE 'sub_entity' END AS scope FROM b""")
def bound_names(spark: SparkSession, folder: str) -> DataFrame:
    """Facts' names with the segment or entity they speak of, and that as their dimension."""

    def stated(c: str) -> Column:
        return F.nullif(F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit("")), F.lit("-"))

    b = star.facts(spark, folder).select("fact_id", F.trim(F.coalesce("metric", F.lit(""))).alias("m"), stated("entity").alias("e"), stated("segment").alias("s")).withColumn("x", F.coalesce("s", "e"))
    apart = (F.col("m") != "") & F.col("x").isNotNull() & ~F.lower("m").contains(F.lower("x"))
    name = F.when(apart, F.concat("m", F.lit(" ("), "x", F.lit(")"))).otherwise(F.col("m"))
    kind = F.when(F.col("s").isNotNull(), "segment").when(F.col("e").isNotNull(), "entity").otherwise("none")
    return b.select("fact_id", name.alias("name"), kind.alias("dimension_type"), F.coalesce("x", F.lit("")).alias("member"), F.when(F.col("x").isNull(), "whole").otherwise("sub_entity").alias("scope"))


@query("fact_flags", f"""
SELECT fact_id, coalesce(nullif(lower(trim(period_type)), ''), 'unknown') AS period_type, coalesce(nullif(trim(fact_type), ''), 'measurement') AS fact_type, coalesce(decision, 'drop') AS decision, coalesce(rescue_pass, false) AS rescued,
 CASE WHEN confidence IS NULL OR isnan(confidence) OR confidence NOT BETWEEN 0 AND 1 THEN 'low' WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.5 THEN 'medium' ELSE 'low' END AS level,
 trim(coalesce(segment, '')) NOT IN ('', '-') AS segmented, trim(coalesce(metric, '')) <> '' AND (trim(coalesce(segment, '')) IN ('', '-') OR len(string_split(trim(metric), ' ')) > 1) AS unambiguous FROM {FACTS}""")
def fact_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Facts with defaults filled in, the level of their confidence, and whether their name stands for itself."""
    c, segment, metric = F.col("confidence"), F.trim(F.coalesce("segment", F.lit(""))), F.trim(F.coalesce("metric", F.lit("")))
    valid = c.isNotNull() & ~F.isnan(c) & c.between(0, 1)
    level = F.when(~valid, "low").when(c >= 0.8, "high").when(c >= 0.5, "medium").otherwise("low")
    segmented = ~segment.isin("", "-")
    return star.facts(spark, folder).select(
        "fact_id", F.coalesce(F.nullif(F.lower(F.trim("period_type")), F.lit("")), F.lit("unknown")).alias("period_type"), F.coalesce(F.nullif(F.trim("fact_type"), F.lit("")), F.lit("measurement")).alias("fact_type"),
        F.coalesce("decision", F.lit("drop")).alias("decision"), F.coalesce("rescue_pass", F.lit(False)).alias("rescued"), level.alias("level"), segmented.alias("segmented"),
        ((metric != "") & (~segmented | (F.size(F.split(metric, " ")) > 1))).alias("unambiguous"),
    )


@query("backfilled_confidence", f"""
WITH g AS (%s) SELECT o.obs_id, CASE WHEN g.obs_id IS NULL THEN CASE WHEN normalization_status IN ('new_metric', 'quarantine') THEN 'fail' ELSE 'not_applicable' END WHEN eligible THEN 'pass'
 WHEN len(list_filter(string_split(reasons, ','), lambda r: r NOT IN ('', 'canonical_untyped', 'fact_untyped'))) > 0 THEN 'fail' ELSE 'not_applicable' END AS gate,
 CASE normalisation_confidence WHEN 'exact' THEN 0.95 WHEN 'inferred' THEN 0.75 WHEN 'needs_context' THEN 0.55 ELSE 0.0 END::DOUBLE AS similarity FROM {OBS} o LEFT JOIN g USING (obs_id)""")
def backfilled_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The gate's result and the similarity of observations that were stored without."""
    gate = alias_gate(spark, folder).withColumn("seen", F.lit(True))
    obs = star.observations(spark, folder).select("obs_id", "normalization_status", "normalisation_confidence").join(gate, "obs_id", "left")
    substantial = F.size(F.filter(F.split("reasons", ","), lambda r: ~r.isin("", "canonical_untyped", "fact_untyped"))) > 0
    unseen = F.when(F.col("normalization_status").isin("new_metric", "quarantine"), "fail").otherwise("not_applicable")
    result = F.when(F.col("seen").isNull(), unseen).when(F.col("eligible"), "pass").when(substantial, "fail").otherwise("not_applicable")
    how = F.col("normalisation_confidence")
    score = F.when(how == "exact", 0.95).when(how == "inferred", 0.75).when(how == "needs_context", 0.55).otherwise(0.0)
    return obs.select("obs_id", result.alias("gate"), score.alias("similarity"))


@query("dry_run", f"""
SELECT company_id, count(*) FILTER (normalization_status IN ('normalized', 'partial')) AS accept, count(*) FILTER (normalization_status = 'new_metric') AS provisional, count(*) FILTER (normalization_status = 'quarantine') AS quarantine FROM {OBS} GROUP BY ALL""")
def dry_run(spark: SparkSession, folder: str) -> DataFrame:
    """What a load would do for each company, without doing it."""
    s = F.col("normalization_status")
    return star.observations(spark, folder).groupBy("company_id").agg(
        F.count_if(s.isin("normalized", "partial")).alias("accept"), F.count_if(s == "new_metric").alias("provisional"), F.count_if(s == "quarantine").alias("quarantine")
    )


@query("gap_candidates", f"""
WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY score DESC, canonical_id) AS n FROM s), n AS (SELECT raw_name, count(*) AS uses FROM {OBS} WHERE normalization_status = 'new_metric' AND raw_name IS NOT NULL GROUP BY ALL)
SELECT n.raw_name, uses, r.canonical_id AS nearest, r.score, CASE WHEN r.score >= 0.75 THEN 'alias' WHEN r.score >= 0.5 THEN 'review' ELSE 'new entry' END AS action FROM n LEFT JOIN r ON r.metric = n.raw_name AND r.n = 1""")
def gap_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """New metric names with their nearest registry entry and what that suggests."""
    uses = star.observations(spark, folder, "normalization_status = 'new_metric' and raw_name is not null").groupBy("raw_name").agg(F.count(F.lit(1)).alias("uses"))
    top = _shortlist(spark, folder, 1).select(F.col("metric").alias("raw_name"), F.col("canonical_id").alias("nearest"), "score")
    action = F.when(F.col("score") >= 0.75, "alias").when(F.col("score") >= 0.5, "review").otherwise("new entry")
    return uses.join(top, "raw_name", "left").select("raw_name", "uses", "nearest", "score", action.alias("action"))


@query("patched_units", f"""
SELECT obs_id, coalesce(r.unit, o.normalised_unit_symbol) AS unit, o.normalised_unit_symbol IS DISTINCT FROM coalesce(r.unit, o.normalised_unit_symbol) AS patched FROM {OBS} o LEFT JOIN consumer_master_registry_v1 r ON o.canonical_id = r.canonical_id AND o.normalization_status = 'partial'""")
def patched_units(spark: SparkSession, folder: str) -> DataFrame:
    """Observations with the registry's unit put in where they were only partly normalised."""
    reg = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "unit")
    obs = star.observations(spark, folder).select("obs_id", "canonical_id", "normalization_status", "normalised_unit_symbol").join(reg, "canonical_id", "left")
    unit = F.coalesce(F.when(F.col("normalization_status") == "partial", F.col("unit")), "normalised_unit_symbol")
    return obs.select("obs_id", unit.alias("unit"), (~F.col("normalised_unit_symbol").eqNullSafe(unit)).alias("patched"))


PROMPT = "Company: {company}\nPeriod: {period}\nFiscal year ends in month {month}.\n"


@query("prompts", f"""
SELECT d.doc_id, replace(replace(replace('Company: {{company}}' || chr(10) || 'Period: {{period}}' || chr(10) || 'Fiscal year ends in month {{month}}.' || chr(10), '{{company}}', coalesce(c.name, d.company_id, 'unknown')), '{{period}}', coalesce(d.fiscal_year, '')),
 '{{month}}', CASE WHEN d.calendar_type = 'calendar_year' THEN '12' ELSE '3' END) AS prompt FROM {DOCS} d LEFT JOIN company c USING (company_id)""")
def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The head of an extraction prompt for each report, its placeholders filled from the report's context."""
    company = read_table(spark, folder, "company").select("company_id", "name")
    docs = star.report_documents(spark, folder).join(company, "company_id", "left")
    filled = F.lit(PROMPT)
    for name, value in {"company": F.coalesce("name", "company_id", F.lit("unknown")), "period": F.coalesce("fiscal_year", F.lit("")), "month": F.when(F.col("calendar_type") == "calendar_year", "12").otherwise("3")}.items():
        filled = F.replace(filled, F.lit(f"{{{name}}}"), value)
    return docs.select("doc_id", filled.alias("prompt"))


@query("period_display", f"""
SELECT obs_id, CASE WHEN regexp_matches(period_label, '^FY[0-9]{{4}}$') THEN period_label || ' (' || (CAST(right(period_label, 4) AS INT) - 1) || '-04-01 to ' || right(period_label, 4) || '-03-31)'
 WHEN regexp_matches(period_label, '^CY[0-9]{{4}}$') THEN period_label || ' (' || right(period_label, 4) || '-01-01 to ' || right(period_label, 4) || '-12-31)' ELSE coalesce(period_label, 'no period') END AS shown FROM {OBS}""")
def period_display(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("period_label")
    start, end = fiscal_bounds(label_year(label), F.when(label.startswith("CY"), 12).otherwise(3))
    known = label.rlike(r"^(FY|CY)\d{4}$")
    shown = F.concat(label, F.lit(" ("), start.cast("string"), F.lit(" to "), end.cast("string"), F.lit(")"))
    return star.observations(spark, folder).select("obs_id", F.when(known, shown).otherwise(F.coalesce(label, F.lit("no period"))).alias("shown"))


_ORACLES["backfilled_confidence"] = _ORACLES["backfilled_confidence"] % _ORACLES["alias_gate"]
