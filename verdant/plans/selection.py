"""Which pages and values are kept: page rules, review signals, matches within a tolerance, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdant.functions import text
from verdant.functions.period import label_year
from verdant.operators import star
from verdant.operators.review import touching_bands, value_band
from verdant.plans import chunks, scalars
from verdant.plans.rules import numeric_pages  # noqa: F401 - its statement is part of those here
from verdant.plans.catalogue import _ORACLES, query
from verdant.plans.scalars import _q
from verdant.plans.star import CHUNKS, FACTS, LOADED, OBS
from verdant.sources import read_table

_ISOLATED = r"(?i)plant\s+locations?|plants?\s+are\s+located|manpower\s+figure|manufacturing\s+locations?|factory\s+locations?|ninth\s+factory|9th\s+factory|sustainability\s+spend|sustainable\s+operations"
# Subjects of operation, and those that make a page full of numbers worth a look.
_OPERATIONAL = ("sustainability", "environment", "emissions", "energy", "renewable", "water", "waste", "plastic", "packaging", "supply chain", "manufacturing", "factory", "safety", "training", "employee", "diversity", "distribution", "outlet")
_DENSE = ("manufacturing", "factory", "distribution", "employee", "water", "safety")


def _any(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, {_q(w)})" for w in words) + ")"


_ASCII = "regexp_replace(text, '[^\\P{L}a-zA-Z]|\\p{M}', 'a', 'g')"
_SIGNAL = f"""k AS ({_ORACLES["keyword_scores"]}),
p AS (SELECT d.doc_id, d.company_id, d.fiscal_year, d.page, lower(d.text) AS t, coalesce(k.score, 0) AS include, CAST({scalars._EXCLUDE} AS INT) AS exclude, CAST({scalars._QUANTITY} AS INT) AS quantity,
 len(regexp_extract_all({_ASCII}, {_q("(?i)" + text.NUMERIC_TOKEN)})) AS numbers, len(list_filter(regexp_split_to_array(d.text, '\\s+'), lambda w: w <> '')) AS words, n.numeric AS numeric
 FROM documents d LEFT JOIN k USING (doc_id) JOIN ({_ORACLES["numeric_pages"]}) n ON n.doc_id = d.doc_id WHERE d.text IS NOT NULL),
s AS (SELECT *, words >= 40 AND include > exclude AND ((numeric AND include >= 3) OR quantity >= 3) AS selected FROM p)"""


def _signals(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("text")
    docs = read_table(spark, folder, "documents").where("text is not null").select("doc_id", "company_id", "fiscal_year", "page", "text")
    pages = docs.join(chunks.keyword_scores(spark, folder).select("doc_id", F.col("score").alias("include")), "doc_id", "left").fillna(0, ["include"])
    pages = pages.select(
        "doc_id", "company_id", "fiscal_year", "page", F.lower(t).alias("t"), "include", text.phrase_score(t, text.EXCLUDED_PHRASES).alias("exclude"), text.quantity_score(t).alias("quantity"),
        text.numeric_tokens(t).alias("numbers"), F.size(F.filter(F.split(t, r"\s+"), lambda w: w != "")).alias("words"), text.states_quantity(t).alias("numeric"),
    )
    chosen = (F.col("words") >= 40) & (F.col("include") > F.col("exclude")) & ((F.col("numeric") & (F.col("include") >= 3)) | (F.col("quantity") >= 3))
    return pages.withColumn("selected", chosen)


def operational_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of 40 words and more that speak more of operations than of statements, with quantities."""
    return _signals(spark, folder).where("selected").select("doc_id", F.col("include").cast("long").alias("include"), "exclude")


def review_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Pages left out that a reviewer should see, how urgent and why: the first rule that holds."""
    keys = ["company_id", "fiscal_year", "page"]
    s = _signals(spark, folder)
    beside = s.where("selected").select("company_id", "fiscal_year", F.explode(F.array(F.col("page") - 1, F.col("page") + 1)).alias("page")).dropna().distinct().withColumn("beside", F.lit(True))
    s = s.where("not selected").join(beside, keys, "left")

    def any_of(words: tuple[str, ...]):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.col("t").contains(w)
        return hit

    score, n, subject = F.col("include"), F.col("numbers"), any_of(_OPERATIONAL)
    why = (
        F.when((score >= 15) | ((score >= 8) & (n >= 20)), "HIGH:high_keyword_and_numeric_signal").when(F.col("t").rlike(_ISOLATED), "HIGH:isolated_operational_fact_pattern")
        .when((score >= 8) & subject, "MEDIUM:keyword_signal_without_many_numbers").when((score >= 5) & (n >= 10) & subject, "MEDIUM:borderline_keyword_numeric_signal")
        .when(F.col("beside") & (score >= 3) & (n >= 10) & subject, "LOW:section_boundary_neighbor").when((n >= 50) & any_of(_DENSE), "LOW:numeric_dense_with_operational_terms")
    )
    found = s.select("doc_id", F.split(why, ":").alias("w")).where("w is not null")
    return found.select("doc_id", F.col("w")[0].alias("level"), F.col("w")[1].alias("reason"))


def _register() -> None:
    query("operational_pages", f"WITH {_SIGNAL} SELECT doc_id, CAST(include AS BIGINT) AS include, exclude FROM s WHERE selected")(operational_pages)
    query("review_signals", f"""WITH {_SIGNAL}, b AS (SELECT DISTINCT company_id, fiscal_year, unnest([page - 1, page + 1]) AS page, true AS beside FROM s WHERE selected),
w AS (SELECT s.doc_id, CASE WHEN include >= 15 OR (include >= 8 AND numbers >= 20) THEN 'HIGH:high_keyword_and_numeric_signal' WHEN regexp_matches(t, {_q(_ISOLATED)}) THEN 'HIGH:isolated_operational_fact_pattern'
 WHEN include >= 8 AND {_any('t', _OPERATIONAL)} THEN 'MEDIUM:keyword_signal_without_many_numbers' WHEN include >= 5 AND numbers >= 10 AND {_any('t', _OPERATIONAL)} THEN 'MEDIUM:borderline_keyword_numeric_signal'
 WHEN beside AND include >= 3 AND numbers >= 10 AND {_any('t', _OPERATIONAL)} THEN 'LOW:section_boundary_neighbor' WHEN numbers >= 50 AND {_any('t', _DENSE)} THEN 'LOW:numeric_dense_with_operational_terms' END AS r
 FROM s LEFT JOIN b USING (company_id, fiscal_year, page) WHERE NOT selected)
SELECT doc_id, split_part(r, ':', 1) AS level, split_part(r, ':', 2) AS reason FROM w WHERE r IS NOT NULL""")(review_signals)


@query("accuracy_matches", f"""
SELECT o.obs_id, o.normalised_unit_symbol IS NOT NULL AND list_contains(CASE lower(f.unit) WHEN 'l' THEN ['l', 'litre', 'liter'] WHEN 'kl' THEN ['kl', 'l'] WHEN 'tco2e' THEN ['tco2e', 't co2e'] WHEN '%' THEN ['%'] WHEN 'nos' THEN ['count', ''] ELSE [lower(coalesce(f.unit, ''))] END, lower(o.normalised_unit_symbol)) AS unit_ok,
 o.period_label IS NOT NULL AND f.period IS NOT NULL AND (CASE WHEN f.period = 'FY2024' THEN o.period_label IN ('FY2024', 'FY2023', 'FY2023_15M') ELSE contains(o.period_label, f.period) OR contains(f.period, o.period_label) END) AS period_ok
FROM {OBS} o JOIN {FACTS} f ON o.source_fact_id = f.fact_id""")
def accuracy_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Whether an observation's unit is one of the accepted writings of the fact's, and its period that of the fact or part of it."""
    facts = star.facts(spark, folder).select(F.col("fact_id").alias("source_fact_id"), F.lower(F.coalesce("unit", F.lit(""))).alias("u"), F.col("period").alias("p"))
    accepted = {"l": ("l", "litre", "liter"), "kl": ("kl", "l"), "tco2e": ("tco2e", "t co2e"), "%": ("%",), "nos": ("count", "")}
    sets = F.create_map(*(x for k, v in accepted.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    obs = star.observations(spark, folder).select("obs_id", "source_fact_id", F.lower("normalised_unit_symbol").alias("s"), F.col("period_label").alias("l")).join(facts, "source_fact_id")
    unit_ok = F.col("s").isNotNull() & F.array_contains(F.coalesce(F.try_element_at(sets, F.col("u")), F.array("u")), F.col("s"))
    whole = F.when(F.col("p") == "FY2024", F.col("l").isin("FY2024", "FY2023", "FY2023_15M")).otherwise(F.col("l").contains(F.col("p")) | F.col("p").contains(F.col("l")))
    period_ok = F.col("l").isNotNull() & F.col("p").isNotNull() & whole
    return obs.select("obs_id", F.coalesce(unit_ok, F.lit(False)).alias("unit_ok"), F.coalesce(period_ok, F.lit(False)).alias("period_ok"))


_NEAR_LOADED = f"""l AS (SELECT obs_id, company_id, canonical_id, period, source_doc_id AS d, normalised_value AS v, coalesce(abs(CAST(regexp_extract(period, '([0-9]{{4}})', 1) AS INT) - CAST(regexp_extract(document_period, '([0-9]{{4}})', 1) AS INT)), 1000000) AS far
 FROM {LOADED} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL AND period IS NOT NULL AND source_doc_id IS NOT NULL)"""


@query("cross_document_kept", f"""
WITH {_NEAR_LOADED} SELECT a.obs_id, a.company_id, a.canonical_id, a.period FROM l a WHERE NOT EXISTS (SELECT 1 FROM l b WHERE a.company_id = b.company_id AND a.canonical_id = b.canonical_id AND a.period = b.period AND a.d <> b.d
 AND sign(a.v) = sign(b.v) AND abs(b.v - a.v) <= 0.01 * greatest(abs(a.v), abs(b.v)) AND (b.far < a.far OR (b.far = a.far AND b.d < a.d)))""")
def cross_document_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Observations that no other report states within one percent from a year nearer to the period (of equal years the smaller document)."""
    far = F.coalesce(F.abs(label_year(F.col("period")) - label_year(F.col("document_period"))), F.lit(1_000_000))
    obs = star.loaded(spark, folder, "canonical_id is not null and company_id is not null and source_doc_id is not null").where("period is not null")
    obs = obs.select("obs_id", "company_id", "canonical_id", "period", F.col("source_doc_id").alias("d"), F.col("normalised_value").alias("v"), far.alias("far"))
    a = obs.withColumn("band", F.explode(touching_bands(F.col("v"), 0.01))).alias("a")
    b = obs.withColumn("band", value_band(F.col("v"), 0.01)).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("company_id", "canonical_id", "period", "band")]
    near = F.abs(F.col("b.v") - F.col("a.v")) <= 0.01 * F.greatest(F.abs("a.v"), F.abs("b.v"))
    better = (F.col("b.far") < F.col("a.far")) | ((F.col("b.far") == F.col("a.far")) & (F.col("b.d") < F.col("a.d")))
    beaten = a.join(b, same[0] & same[1] & same[2] & same[3] & (F.col("a.d") != F.col("b.d")) & near & better, "left_semi").select("obs_id").distinct()
    return obs.join(beaten, "obs_id", "left_anti").select("obs_id", "company_id", "canonical_id", "period")


@query("running_parent", f"""
SELECT chunk_id, last_value(nullif(trim(parent_section), '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_start NULLS FIRST, chunk_id ROWS UNBOUNDED PRECEDING) AS parent FROM {CHUNKS} WHERE doc_id IS NOT NULL""")
def running_parent(spark: SparkSession, folder: str) -> DataFrame:
    chunk = read_table(spark, folder, "report_chunk").where("doc_id is not null").select("doc_id", "chunk_id", "page_start", "parent_section").distinct()
    w = Window.partitionBy("doc_id").orderBy("page_start", "chunk_id").rowsBetween(Window.unboundedPreceding, 0)
    return chunk.select("chunk_id", F.last(F.nullif(F.trim("parent_section"), F.lit("")), ignorenulls=True).over(w).alias("parent"))


@query("numbering_after", f"""
WITH e AS (SELECT company_id, count(DISTINCT canonical_id) AS had FROM {OBS} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL GROUP BY ALL),
f AS (SELECT company_id, lower(trim(raw_name)) AS name, min(obs_id) AS first FROM {OBS} WHERE normalization_status = 'new_metric' AND company_id IS NOT NULL GROUP BY ALL)
SELECT f.company_id, name, 'prov_' || f.company_id || '_' || printf('%04d', coalesce(had, 0) + row_number() OVER (PARTITION BY f.company_id ORDER BY first, name)) AS id FROM f LEFT JOIN e USING (company_id)""")
def numbering_after(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of new metrics, numbered on from what a company has already."""
    new = star.observations(spark, folder, "normalization_status = 'new_metric' and company_id is not null").select("company_id", F.lower(F.trim("raw_name")).alias("name"), "obs_id")
    had = star.observations(spark, folder, "canonical_id is not null and company_id is not null").groupBy("company_id").agg(F.count_distinct("canonical_id").alias("had"))
    numbered = star.numbered_first_seen(new, "company_id", "name", "obs_id", F.lit("")).join(had, "company_id", "left")
    n = (F.coalesce("had", F.lit(0)) + F.col("number")).cast("long")
    return numbered.select("company_id", "name", F.concat(F.lit("prov_"), "company_id", F.lit("_"), F.format_string("%04d", n)).alias("id"))


_EXPORT = "raw_name raw_value raw_unit_string normalised_value normalised_unit_symbol normalisation_confidence period_label period_start period_end period_type period_confidence fact_type normalization_status page chunk_id canonical_id source_doc_id company_id".split()


@query("export_rows", f"""
SELECT o.obs_id, {", ".join("o." + c for c in _EXPORT)}, f.section_id, f.entity, f.segment, f.evidence, f.confidence, f.rescue_pass, len(coalesce(f.duplicate_chunk_ids, [])) AS duplicates
FROM {OBS} o LEFT JOIN {FACTS} f ON o.source_fact_id = f.fact_id""")
def export_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The flat export: 26 columns of an observation and the fact it comes from."""
    facts = star.facts(spark, folder).select(F.col("fact_id").alias("source_fact_id"), "section_id", "entity", "segment", "evidence", "confidence", "rescue_pass", F.coalesce(F.size("duplicate_chunk_ids"), F.lit(0)).alias("n"))
    joined = star.observations(spark, folder).join(facts, "source_fact_id", "left")
    n = F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)).cast("long")
    return joined.select("obs_id", *_EXPORT, "section_id", "entity", "segment", "evidence", "confidence", "rescue_pass", n.alias("duplicates"))


_register()
