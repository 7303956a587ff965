"""Rules on single rows: numbers, units, periods, gates and flags, each beside its statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import facts as say
from verdant.functions import number, period, semantics, text
from verdant.operators import star
from verdant.plans.catalogue import query
from verdant.plans.scalars import _case, _q
from verdant.plans.star import DOCS, FACTS, OBS
from verdant.sources import read_table

_V, _U, _E, _M = "coalesce(value, '')", "coalesce(unit, '')", "coalesce(evidence, '')", "coalesce(metric, '')"
_DIGITS = f"regexp_replace(regexp_replace(trim(value), '^[()]+|[()]+$', '', 'g'), '[^0-9.\\-]', '', 'g')"
_ACCOUNT = f"""CASE WHEN trim(value) IN ('-', '—', '–') THEN NULL ELSE (CASE WHEN starts_with({_DIGITS}, '-') OR (starts_with(trim(value), '(') AND ends_with(trim(value), ')')) THEN -1 ELSE 1 END)
 * try_cast(nullif(CASE WHEN contains(replace({_DIGITS}, '-', ''), '.') THEN split_part(replace({_DIGITS}, '-', ''), '.', 1) || '.' || replace(substr(replace({_DIGITS}, '-', ''), strpos(replace({_DIGITS}, '-', ''), '.') + 1), '.', '')
 ELSE replace({_DIGITS}, '-', '') END, '') AS DOUBLE) END"""


@query("accounting_numbers", f"SELECT fact_id, {_ACCOUNT} AS number FROM {FACTS}")
def accounting_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", number.accounting_number(F.col("value")).alias("number"))


@query("number_flags", f"""
SELECT fact_id, regexp_matches(replace(replace(trim({_V}), ',', ''), ' ', ''), '^(20[0-2][0-9]|2030)$') AS year_like,
 regexp_matches(value, '[0-9]') AND (regexp_matches(lower(value), 'january|february|march|april|may|june|july|august|september|october|november|december') OR regexp_matches(value, '\\b[0-9]{{1,2}}[/-][0-9]{{1,2}}[/-][0-9]{{2,4}}\\b')) IS TRUE AS date_like,
 trim({_V}) NOT IN ('', '-', '—', '–') AND ({_ACCOUNT}) IS NULL AS not_numeric,
 regexp_matches(regexp_replace(lower({_M}), '[^a-z0-9]+', ' ', 'g'), '^ ?[0-9]+ ') AND regexp_matches(lower({_M}), 'dollar|euro|yuan|renminbi|franc|pound|sterling|yen|rupee|peso|real|rand|won|dirham') AS exchange_rate
FROM {FACTS}""")
def number_flags(spark: SparkSession, folder: str) -> DataFrame:
    v = F.col("value")
    return star.facts(spark, folder).select("fact_id", number.year_like(v).alias("year_like"), number.date_like(v).alias("date_like"), number.not_numeric(v).alias("not_numeric"), number.exchange_rate_name(F.col("metric")).alias("exchange_rate"))


_N = f"lower({_M})"


@query("stated_families", f"""
SELECT fact_id, CASE WHEN regexp_matches(lower({_U}), '%|percent') OR regexp_matches({_N}, 'margin|rate|growth|yield|return') THEN 'percentage'
 WHEN regexp_matches({_N}, 'employee|people|headcount|shares|share count|store count') THEN 'count' WHEN contains({_N}, 'per share') THEN 'per_share'
 WHEN contains({_N}, 'days') THEN 'days' WHEN abs({_ACCOUNT}) > 100 THEN 'monetary' END AS family FROM {FACTS}""")
def stated_families(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", number.stated_family(F.col("metric"), F.col("unit"), F.col("value")).alias("family"))


_FAMILY = _case("trim(coalesce(unit, ''))", number.UNIT_FAMILIES, "'unknown'")


@query("fact_families", f"""
SELECT fact_id, CASE WHEN f <> 'unknown' THEN f WHEN regexp_matches({_M}, '(?i)\\b(count|number of|no\\. of|employees?|workers?|stores?|outlets?|sites?|plants?|units?)\\b') THEN 'count'
 WHEN ends_with(trim({_V}), '%') THEN 'percentage' ELSE 'unknown' END AS family FROM (SELECT *, {_FAMILY} AS f FROM {FACTS})""")
def fact_families(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", number.fact_family(F.col("metric"), F.col("unit"), F.col("value")).alias("family"))


_NUMS = f"regexp_extract_all({_V}, '-?[0-9][0-9,]*\\.?[0-9]*')"
_WORDS = f"lower({_V} || ' ' || {_E})"
_MOVE = f"((contains({_WORDS}, 'from') AND contains({_WORDS}, 'to')) OR (contains(lower(trim({_V})), ' to ') AND regexp_matches({_E}, {_q('(?i)' + number.MOVEMENT_PATTERN)}))) AND NOT regexp_matches({_WORDS}, {_q(number.GUIDANCE_PATTERN)})"
_PRIMARY = f"CASE WHEN len({_NUMS}) = 1 THEN try_cast(replace({_NUMS}[1], ',', '') AS DOUBLE) WHEN len({_NUMS}) = 2 AND {_MOVE} THEN try_cast(replace({_NUMS}[2], ',', '') AS DOUBLE) END"
_SCALE = _case(f"{_V} || ' ' || {_U}", [(f, p) for f, p in number.SCALE_PATTERNS], "1")


@query("safe_values", f"""
WITH x AS (SELECT fact_id, lower({_U}) AS u, {_FAMILY} AS unit_family, {_PRIMARY} AS raw_numeric, {_SCALE} AS s FROM {FACTS}),
y AS (SELECT *, unit_family <> 'percentage' AND s > 1 AND unit_family IN ('ratio', 'percentage_points', 'duration', 'time', 'per_area', 'per_unit', 'rate', 'energy', 'volume', 'weight') AS illegal FROM x),
z AS (SELECT *, CASE WHEN raw_numeric IS NULL THEN 1.0 WHEN unit_family = 'percentage' AND regexp_matches(u, '%|percent|pct') THEN 0.01 WHEN unit_family = 'percentage' OR illegal THEN 1.0 ELSE s END::DOUBLE AS applied_scale FROM y)
SELECT fact_id, unit_family, raw_numeric, applied_scale, raw_numeric * applied_scale AS normalized_value, CASE WHEN raw_numeric IS NULL THEN 'no_single_number' WHEN illegal THEN 'illegal_scale_for_family:' || unit_family END AS rejected FROM z""")
def safe_values(spark: SparkSession, folder: str) -> DataFrame:
    v = number.safe_value(F.col("value"), F.col("unit"), F.col("evidence"))
    return star.facts(spark, folder).select("fact_id", v.alias("v")).select("fact_id", "v.*")


def _typed(column: str) -> str:
    return f"{_case(column, semantics.SUBJECTS)} AS subject, {_case(column, semantics.ROLES)} AS said, {_case(column, semantics.DENOMINATORS)} AS denominator, {_case(column, semantics.ENERGY_SOURCES)} AS source"


_ROLE = "CASE WHEN denominator IS NOT NULL AND coalesce(said, '') NOT IN ('intensity', 'generation', 'consumption', 'withdrawal') THEN 'intensity' ELSE said END AS role"
_FLOW = "coalesce(CASE {0} WHEN 'recharge' THEN 'restoration' WHEN 'withdrawal' THEN 'input' WHEN 'consumption' THEN 'consumed' WHEN 'generation' THEN 'output' WHEN 'recycling' THEN 'recovery' WHEN 'disposal' THEN 'output' WHEN 'intensity' THEN 'ratio' END, 'unknown')"


@query("alias_gate", f"""
WITH o AS (SELECT obs_id, canonical_id, {_case("trim(coalesce(raw_unit_string, ''))", number.UNIT_FAMILIES, "'unknown'")} AS fam, {_typed("lower(coalesce(raw_name, ''))")} FROM {OBS} WHERE canonical_id IS NOT NULL),
r AS (SELECT canonical_id, {_case("trim(unit)", number.UNIT_FAMILIES, "'unknown'")} AS fam, {_typed('lower(display_name)')} FROM consumer_master_registry_v1),
a AS (SELECT *, {_ROLE} FROM o), b AS (SELECT *, {_ROLE} FROM r),
x AS (SELECT a.obs_id, a.subject AS s, b.subject AS t, a.role AS p, b.role AS q, a.denominator AS d, b.denominator AS e, a.source AS g, b.source AS h, a.fam AS f, b.fam AS k, {_FLOW.format('a.role')} AS m, {_FLOW.format('b.role')} AS n FROM a JOIN b USING (canonical_id)),
w AS (SELECT *, list_filter([CASE WHEN t IS NULL OR q IS NULL THEN 'canonical_untyped' END, CASE WHEN s IS NULL OR p IS NULL THEN 'fact_untyped' END,
 CASE WHEN NOT (f <> 'unknown' AND k <> 'unknown' AND (f = k OR (f IN ('percentage', 'percentage_points') AND k IN ('percentage', 'percentage_points')))) THEN 'unit_mismatch' END,
 CASE WHEN s <> t THEN 'subject_mismatch' END, CASE WHEN p <> q THEN 'role_mismatch' END, CASE WHEN d IS DISTINCT FROM e THEN 'denominator_mismatch' END,
 CASE WHEN s = t AND p = q AND m <> n THEN 'near_duplicate_risk' END, CASE WHEN s = 'energy' AND t = 'energy' AND p = 'consumption' AND q = 'consumption' AND g IS DISTINCT FROM h THEN 'energy_source_mismatch' END], lambda z: z IS NOT NULL) AS why FROM x)
SELECT obs_id, len(why) = 0 AND m <> 'unknown' AND m = n AS eligible, array_to_string(why, ',') AS reasons FROM w""")
def alias_gate(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder, "canonical_id is not null")
    obs = obs.select("obs_id", "canonical_id", semantics.semantics_of(F.lower(F.coalesce("raw_name", F.lit("")))).alias("a"), number.unit_family(F.col("raw_unit_string")).alias("f"))
    reg = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", semantics.semantics_of(F.lower("display_name")).alias("b"), number.unit_family(F.col("unit")).alias("k"))
    gate = obs.join(reg, "canonical_id").select("obs_id", semantics.alias_gate(F.col("a"), F.col("b"), F.col("f"), F.col("k")).alias("g"))
    return gate.select("obs_id", "g.eligible", F.array_join("g.reasons", ",").alias("reasons"))


@query("numeric_pages", r"""
SELECT doc_id, coalesce(regexp_matches(text, '[0-9]') AND regexp_matches(text, '(?i)[%₹$€£]|(^|[^\p{L}\p{N}_])(?:crore|lakh|million|billion|tonnes?|tons?|kg|kl|litres?|employees?|workers?|sites?|plants?|factories?|facilities?|stores?|outlets?|suppliers?|hours?|days?|women|men|co2|co2e)([^\p{L}\p{N}_]|$)'), false) AS numeric FROM documents""")
def numeric_pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents").select("doc_id", text.states_quantity(F.col("text")).alias("numeric"))


@query("no_number_drops", f"""
SELECT fact_id, CASE WHEN n IS NULL AND NOT regexp_matches({_E}, '-?[0-9]') THEN 'drop' ELSE decision END AS decision, CASE WHEN n IS NULL AND NOT regexp_matches({_E}, '-?[0-9]') THEN 'no quantitative value present in source' END AS note
FROM (SELECT *, {_PRIMARY} AS n FROM {FACTS})""")
def no_number_drops(spark: SparkSession, folder: str) -> DataFrame:
    nothing = number.primary_number(F.col("value"), F.col("evidence")).isNull() & ~F.coalesce("evidence", F.lit("")).rlike(r"-?[0-9]")
    note = F.when(nothing, "no quantitative value present in source")
    return star.facts(spark, folder).select("fact_id", F.when(nothing, "drop").otherwise(F.col("decision")).alias("decision"), note.alias("note"))


@query("small_scope3", f"""
SELECT obs_id, CASE WHEN contains(lower(raw_name), 'scope 3') AND normalised_value < 1000 THEN 'quarantine' ELSE normalization_status END AS status FROM {OBS}""")
def small_scope3(spark: SparkSession, folder: str) -> DataFrame:
    low = F.lower("raw_name").contains("scope 3") & (F.col("normalised_value") < 1000) & ~F.isnan("normalised_value")
    return star.observations(spark, folder).select("obs_id", F.when(low, "quarantine").otherwise(F.col("normalization_status")).alias("status"))


@query("candidate_drops", f"""
SELECT fact_id, CASE WHEN trim({_E}) = '' THEN 'missing_source_sentence' WHEN trim({_V}) = '' THEN 'missing_raw_value_candidate'
 WHEN regexp_matches(trim({_V}), '(?i)^(unknown|n/?a|na|nil|none|percentage|percent|days?|years?|months?|quarters?)$') THEN 'junk_raw_value_candidate'
 WHEN NOT regexp_matches({_V}, '(?i)[0-9]|\\b(one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|hundred|thousand|million|billion|lakh|crore|half|quarter|third|double|triple)\\b') THEN 'non_numeric_raw_value_candidate' END AS reason FROM {FACTS}""")
def candidate_drops(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", say.drop_reason(F.col("evidence"), F.col("value")).alias("reason"))


@query("skipped_tables", """
SELECT DISTINCT chunk_id, chunk_type = 'table' AND regexp_matches(lower(chunk_id), 'exchange_rate|exchange_rates|principal_exchange|companies_of_the|list_of_companies') AS skipped FROM report_chunk WHERE chunk_id IS NOT NULL""")
def skipped_tables(spark: SparkSession, folder: str) -> DataFrame:
    chunk = read_table(spark, folder, "report_chunk").where("chunk_id is not null").select("chunk_id", "chunk_type").distinct()
    return chunk.select("chunk_id", say.skipped_table(F.col("chunk_type"), F.col("chunk_id")).alias("skipped"))


@query("clear_units", f"""
SELECT fact_id, CASE WHEN regexp_matches(trim({_U}), '^[,.;:\\-?()\\[\\]{{}}/\\\\]+$') THEN '' ELSE trim({_U}) END AS unit,
 lower(trim({_U})) NOT IN ('', 'n/a', 'unknown', 'not stated') OR regexp_matches({_M} || ' ' || {_E}, '(?i)\\b(lines?|plants?|facilities?|sites?|factories?|warehouses?|suppliers?|incidents?|injuries?|products?|skus?|outlets?|stores?|hubs?|depots?)\\b') AS clear FROM {FACTS}""")
def clear_units(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", say.sanitised(F.col("unit")).alias("unit"), say.clear_unit(F.col("unit"), F.concat_ws(" ", F.coalesce("metric", F.lit("")), F.coalesce("evidence", F.lit("")))).alias("clear"))


def _token(c: str, kind: str) -> str:
    fy, cy = "\\bFY\\s*([12][90][0-9]{2})\\b", "\\bCY\\s*([12][90][0-9]{2})\\b"
    rng, at = "\\b(?:FY\\s*)?([12][90][0-9]{2})\\s*[-/]\\s*([0-9]{4}|[0-9]{2})\\b", "\\bas of\\b[^.:\\n]{0,40}\\b([12][90][0-9]{2})\\b"
    c = f"coalesce({c}, '')"
    s, e = f"try_cast(regexp_extract({c}, '(?i){rng}', 1) AS INT)", f"regexp_extract({c}, '(?i){rng}', 2)"
    end = f"CASE WHEN length({e}) = 4 THEN CAST({e} AS INT) ELSE ({s} // 100) * 100 + CAST({e} AS INT) + CASE WHEN ({s} // 100) * 100 + CAST({e} AS INT) < {s} THEN 100 ELSE 0 END END"
    return f"""CASE WHEN regexp_matches({c}, '(?i){fy}') THEN 'FY' || regexp_extract({c}, '(?i){fy}', 1) WHEN regexp_matches({c}, '(?i){cy}') THEN 'CY' || regexp_extract({c}, '(?i){cy}', 1)
 WHEN regexp_matches({c}, '(?i){rng}') THEN {kind} || ({end}) WHEN regexp_matches({c}, '(?i){at}') THEN {kind} || regexp_extract({c}, '(?i){at}', 1)
 WHEN regexp_matches({c}, '(19|20)[0-9]{{2}}') THEN (CASE WHEN regexp_matches({c}, '(?i)\\bcalendar\\b') THEN 'CY' ELSE {kind} END) || regexp_extract({c}, '((19|20)[0-9]{{2}})', 1) END"""


_KIND = "CASE WHEN starts_with(upper(coalesce(own, '')), 'FY') THEN 'FY' ELSE 'CY' END"
_CONTEXT = f"x AS (SELECT f.fact_id, f.period AS raw, f.evidence AS s, f.fact_type, lower(trim(coalesce(f.period_type, ''))) AS what, d.fiscal_year AS own, d.filing_year AS filed, d.calendar_type FROM {FACTS} f JOIN {DOCS} d USING (doc_id)), k AS (SELECT *, {_KIND} AS kind FROM x)"


def _in_context(spark: SparkSession, folder: str) -> DataFrame:
    docs = star.report_documents(spark, folder).select("doc_id", F.col("fiscal_year").alias("own"), F.col("filing_year").alias("filed"), "calendar_type")
    return star.facts(spark, folder).select("fact_id", "doc_id", "period", "period_type", "fact_type", "evidence").join(docs, "doc_id")


@query("stated_labels", f"""
WITH {_CONTEXT}, t AS (SELECT *, {_token('raw', 'kind')} AS a, {_token('s', 'kind')} AS b, coalesce({_token('own', 'kind')}, kind || filed, '') AS o, trim(lower(coalesce(raw, '')), '.,;: ') AS bare FROM k),
u AS (SELECT *, bare IN ({", ".join(_q(w) for w in period.NO_YEAR_STRINGS)}) AS fixed FROM t)
SELECT fact_id, CASE WHEN fixed AND lower(trim(coalesce(fact_type, ''))) = 'target' AND bare IN ('open ended', 'open-ended', 'no fixed date', 'indefinite', 'permanent') THEN 'open_ended' WHEN fixed THEN o ELSE coalesce(a, b, o) END AS label,
 CASE WHEN NOT fixed AND coalesce(a, b) IS NOT NULL THEN 'extracted' ELSE 'inferred' END AS confidence FROM u""")
def stated_labels(spark: SparkSession, folder: str) -> DataFrame:
    label, how = period.stated_label(F.col("period"), F.col("evidence"), F.col("fact_type"), F.col("own"), F.col("filed"))
    return _in_context(spark, folder).select("fact_id", label.alias("label"), how.alias("confidence"))


def _bounds(token: str) -> tuple[str, str]:
    y = f"CAST(substr({token}, 3, 4) AS INT)"
    return f"CASE WHEN starts_with({token}, 'FY') AND fye = 3 THEN make_date({y} - 1, 4, 1) ELSE make_date({y}, 1, 1) END", f"CASE WHEN starts_with({token}, 'FY') AND fye = 3 THEN make_date({y}, 3, 31) ELSE make_date({y}, 12, 31) END"


@query("resolved_periods", f"""
WITH {_CONTEXT}, t AS (SELECT *, CASE WHEN calendar_type = 'calendar_year' THEN 12 ELSE 3 END AS fye, {_token('raw', 'kind')} AS a, {_token('s', 'kind')} AS b, {_token('own', 'kind')} AS o, coalesce(raw, '') || ' ' || coalesce(s, '') AS w FROM k),
u AS (SELECT *, coalesce(a, o) AS y, coalesce(a, b) AS p, try_cast(regexp_extract(w, '(?i)\\bby\\s+([12][90][0-9]{{2}})\\b', 1) AS INT) AS tg, try_cast(regexp_extract(w, '(?i)\\bsince\\s+([12][90][0-9]{{2}})\\b', 1) AS INT) AS sc,
 try_cast(coalesce(nullif(regexp_extract(coalesce(raw, ''), '(?i)\\bas of\\b[^.:\\n]{{0,40}}\\b([12][90][0-9]{{2}})\\b', 1), ''), regexp_extract(coalesce(s, ''), '(?i)\\bas of\\b[^.:\\n]{{0,40}}\\b([12][90][0-9]{{2}})\\b', 1)) AS INT) AS ao,
 list_position([{", ".join(_q(m) for m in period.MONTH_NAMES)}], lower(regexp_extract(w, '(?i)\\b(january|february|march|april|may|june|july|august|september|october|november|december)\\b', 1))) AS mo,
 try_cast(regexp_extract(w, '(?i)\\bQ([1-4])\\b', 1) AS INT) AS q, CASE WHEN regexp_matches(w, '(?i)\\bh1\\b|half year') THEN 1 WHEN regexp_matches(w, '(?i)\\bh2\\b') THEN 2 END AS h FROM t),
v AS (SELECT *, {_bounds('y')[0]} AS ys, {_bounds('y')[1]} AS ye, {_bounds('o')[1]} AS oe, {_bounds('p')[0]} AS ps, last_day(make_date(ao, coalesce(mo, 12), 1)) AS pt FROM u),
z AS (SELECT fact_id, what, sc, oe, CASE WHEN what IN ('full_year', 'baseline') THEN ys WHEN what = 'cumulative' THEN make_date(sc, 1, 1) WHEN what = 'point_in_time' THEN pt WHEN what = 'partial' AND q IS NOT NULL THEN ps + to_months(3 * (q - 1)) WHEN what = 'partial' AND starts_with(p, 'FY') THEN ps + to_months(6 * (h - 1)) END AS start,
 CASE WHEN what IN ('full_year', 'baseline') THEN ye WHEN what = 'target' THEN make_date(tg, 12, 31) WHEN what = 'cumulative' THEN oe WHEN what = 'point_in_time' THEN pt WHEN what = 'partial' AND q IS NOT NULL THEN last_day(ps + to_months(3 * q - 1)) WHEN what = 'partial' AND starts_with(p, 'FY') THEN last_day(ps + to_months(6 * h - 1)) END AS e FROM v)
SELECT fact_id, CAST(CAST(start AS DATE) AS VARCHAR) AS start, CAST(CAST(e AS DATE) AS VARCHAR) AS "end", CASE WHEN what = 'cumulative' THEN CASE WHEN sc IS NOT NULL THEN 'resolved' WHEN oe IS NOT NULL THEN 'inferred' ELSE 'unresolvable' END WHEN e IS NOT NULL THEN 'resolved' WHEN what = 'partial' THEN 'inferred' ELSE 'unresolvable' END AS resolution FROM z""")
def resolved_periods(spark: SparkSession, folder: str) -> DataFrame:
    month = F.when(F.col("calendar_type") == "calendar_year", 12).otherwise(3)
    r = period.resolve_period(F.col("period"), F.col("period_type"), F.col("evidence"), F.col("own"), month)
    return _in_context(spark, folder).select("fact_id", r.alias("r")).select("fact_id", F.col("r.start").cast("string").alias("start"), F.col("r.end").cast("string").alias("end"), "r.resolution")


@query("half_years", """
SELECT o_orderkey, CAST(make_date(y, m, 1) AS VARCHAR) AS first_day, CAST(last_day(make_date(y, m, 1) + INTERVAL 5 MONTH) AS VARCHAR) AS last_day FROM (
 SELECT o_orderkey, CASE WHEN month(o_orderdate) < 4 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END AS y, CASE WHEN month(o_orderdate) BETWEEN 4 AND 9 THEN 4 ELSE 10 END AS m FROM orders)""")
def half_years(spark: SparkSession, folder: str) -> DataFrame:
    day = F.add_months(F.col("o_orderdate").cast("date"), 9)
    first, last = period.half_bounds(F.year(day), F.lit(3), F.ceil(F.month(day) / 6).cast("int"))
    return read_table(spark, folder, "orders").select("o_orderkey", first.cast("string").alias("first_day"), last.cast("string").alias("last_day"))


@query("rolling_years", """
SELECT o_orderkey, CAST(CAST(date_trunc('month', q - INTERVAL 11 MONTH) AS DATE) AS VARCHAR) AS first_day, CAST(q AS VARCHAR) AS last_day FROM (
 SELECT o_orderkey, last_day(make_date(year(o_orderdate), 1 + 3 * ((month(o_orderdate) - 1) // 3), 1) + INTERVAL 2 MONTH) AS q FROM orders)""")
def rolling_years(spark: SparkSession, folder: str) -> DataFrame:
    day = F.add_months(F.col("o_orderdate").cast("date"), 9)
    first, last = period.rolling_bounds(F.year(day), F.lit(3), F.quarter(day))
    return read_table(spark, folder, "orders").select("o_orderkey", first.cast("string").alias("first_day"), last.cast("string").alias("last_day"))


@query("scope3_categories", f"""
SELECT fact_id, coalesce(try_cast(nullif(regexp_extract(t, 'category\\s*(1[0-5]|[1-9])\\b', 1), '') AS INT), CASE {" ".join(f"WHEN contains(t, {_q(w)}) THEN {i + 1}" for i, w in enumerate(say.SCOPE3_WORDS))} END) AS category
FROM (SELECT fact_id, lower({_M} || ' ' || {_E}) AS t FROM {FACTS}) WHERE regexp_matches(t, 'scope[ -]*3|value chain emission')""")
def scope3_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact about scope 3; category is null where none of the fifteen is named."""
    both = F.concat_ws(" ", F.coalesce("metric", F.lit("")), F.coalesce("evidence", F.lit("")))
    return star.facts(spark, folder).where(say.about_scope3(both)).select("fact_id", say.scope3_category(both, F.lit("")).alias("category"))
