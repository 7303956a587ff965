"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdant.functions.quantity import SCALES, unit_book
from verdant.functions.unit import COUNTED, MONEY, POINTS, SCALE_WORDS, SHARE, unit_key_sql
from verdant.operators import star, units
from verdant.plans.catalogue import query
from verdant.plans.rules import _PRIMARY, _SCALE
from verdant.plans.star import FACTS
from verdant.sources import read_table


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return units.check_observations(read_table(spark, folder, "observation"), read_table(spark, folder, "extracted_fact"), read_table(spark, folder, "unit_conversion"))


@query("p5_found")
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder).where("verdict in ('fill', 'wrong')").select("obs_id")


@query("p5_observations")
def p5_observations(spark: SparkSession, folder: str) -> DataFrame:
    return _checked(spark, folder)


@query("p5_facts")
def p5_facts(spark: SparkSession, folder: str) -> DataFrame:
    facts = read_table(spark, folder, "extracted_fact")
    conversion = read_table(spark, folder, "unit_conversion")
    read = units.read_quantities(facts, "fact_id", "value", "unit", "metric", "evidence", units.table_symbols(conversion))
    return units.common_quantities(read, conversion, "fact_id")


_SPELT = ", ".join(f"('{name}', '{symbol}')" for name, symbol in unit_book().plain.items())
_TIMES = "CASE {0} " + " ".join(f"WHEN '{w}' THEN {x}" for w, x in SCALES.items()) + " END"
_BEFORE, _BEHIND = f"^({SCALE_WORDS}) (.+)$", f"^(.+) ({SCALE_WORDS})$"
_PER = f"^(.+) per (?:({SCALE_WORDS}) )?(?:{MONEY})(?: ({SCALE_WORDS}))?$"


def _join(tag: str, part: str) -> str:
    return f"LEFT JOIN names {tag} ON replace({part}, ' ', '') = {tag}.name"


@query("unit_normalise", f"""
WITH spelt AS (SELECT replace({unit_key_sql('s')}, ' ', '') AS name, c.from_symbol, c.to_symbol AS symbol, c.factor, c.unit_family AS family FROM (VALUES {_SPELT}) v(s, sym) JOIN unit_conversion c ON c.from_symbol = v.sym),
names AS (SELECT name, arg_min(symbol, from_symbol) AS symbol, arg_min(factor, from_symbol) AS factor, arg_min(family, from_symbol) AS family FROM spelt GROUP BY name),
f AS (SELECT fact_id, unit, coalesce(metric, '') AS n, coalesce(unit, '') || ' ' || coalesce(metric, '') || ' ' || coalesce(evidence, '') AS context, {unit_key_sql('unit')} AS k, ({_PRIMARY}) * ({_SCALE.replace("coalesce(value, '') || ' ' || coalesce(unit, '')", "coalesce(value, '')")}) AS x FROM {FACTS}),
j AS (SELECT f.*, a.symbol AS asym, a.factor AS afac, b.symbol AS bsym, b.factor * {_TIMES.format(f"coalesce(nullif(regexp_extract(k, '{_BEFORE}', 1), ''), regexp_extract(k, '{_BEHIND}', 2))")} AS bfac, c.symbol AS csym,
 d.symbol AS dsym, d.factor * 1e6 / coalesce({_TIMES.format(f"regexp_extract(k, '{_PER}', 2)")}, {_TIMES.format(f"regexp_extract(k, '{_PER}', 3)")}, 1.0) AS dfac, e.factor * 0.001 AS efac, e.family AS efam FROM f
 {_join('a', 'k')} {_join('b', f"CASE WHEN regexp_matches(k, '{_BEFORE}') THEN regexp_extract(k, '{_BEFORE}', 2) WHEN regexp_matches(k, '{_BEHIND}') THEN regexp_extract(k, '{_BEHIND}', 1) END")}
 {_join('c', "regexp_extract(k, '^(.+) per (?:t|ton|tonne|mt|metric ton|metric tonne)$', 1)")} {_join('d', f"regexp_extract(k, '{_PER}', 1)")} {_join('e', "regexp_extract(k, '^(.+?) ?co2 ?(?:e|eq|equivalent)?$', 1)")}),
h AS (SELECT *, CASE WHEN trim(coalesce(unit, '')) IN ('', '-', '–', '—') THEN CASE WHEN regexp_matches(n, '{COUNTED}') THEN ['count', '1', 'inferred'] ELSE [NULL, '1', 'needs_context'] END
 WHEN asym IS NOT NULL THEN [asym, CAST(afac AS VARCHAR), 'exact'] WHEN bsym IS NOT NULL AND bfac IS NOT NULL THEN [bsym, CAST(bfac AS VARCHAR), 'inferred'] WHEN {_TIMES.format('k')} IS NOT NULL THEN ['count', CAST({_TIMES.format('k')} AS VARCHAR), 'inferred']
 WHEN csym IS NOT NULL THEN [csym || '/tonne', '1', 'inferred'] WHEN dsym IS NOT NULL THEN [dsym || '/MINR', CAST(dfac AS VARCHAR), 'inferred'] WHEN efam = 'weight' THEN ['tCO2e', CAST(efac AS VARCHAR), 'inferred']
 WHEN regexp_matches(k, '\\bjoule\\b.*\\bmultiple\\b') THEN ['GJ', '1', 'inferred'] WHEN regexp_matches(context, '{SHARE}') THEN ['%', '1', 'inferred'] WHEN regexp_matches(context, '{POINTS}') THEN ['%', '0.01', 'inferred']
 WHEN regexp_matches(k, '^[a-z ]+$') AND NOT regexp_matches(k, '\\b(per|ratio|index|rate|times)\\b') THEN ['count', '1', 'inferred'] ELSE [NULL, '1', 'failed'] END AS u FROM j)
SELECT fact_id, CASE WHEN u[3] IN ('exact', 'inferred') THEN x * CASE WHEN u[1] = '%' AND CAST(u[2] AS DOUBLE) >= 1 THEN 1.0 ELSE CAST(u[2] AS DOUBLE) END END AS value, u[1] AS symbol, CASE WHEN u[3] IN ('exact', 'inferred') AND x IS NULL THEN 'needs_context' ELSE u[3] END AS confidence FROM h""")
def unit_normalise(spark: SparkSession, folder: str) -> DataFrame:
    facts = star.facts(spark, folder).select("fact_id", "value", "unit", "metric", "evidence")
    return units.normalise_units(facts, read_table(spark, folder, "unit_conversion"), "fact_id", "value", "unit", "metric", "evidence").withColumnRenamed("key", "fact_id")
