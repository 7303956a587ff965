"""Queries on page selection, page heads, tables and anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import text
from verdant.functions.facts import heading_key
from verdant.operators import dedup, pages, star
from verdant.plans.catalogue import query
from verdant.plans.resolution import _CL
from verdant.plans.star import FACTS, LOADED, OBS, SECTIONS
from verdant.sources import read_table

_TITLE = r"(water|waste|energy|climate|emission|people|safety|packag)"


@query("section_page_selection", f"""
WITH s AS (SELECT doc_id, page_start, max(page_end) AS last FROM {SECTIONS} GROUP BY ALL),
r AS (SELECT doc_id, page_start, coalesce(lead(page_start) OVER (PARTITION BY doc_id ORDER BY page_start) - 1, greatest(max(last) OVER (PARTITION BY doc_id), page_start)) AS stop FROM s),
w AS (SELECT DISTINCT doc_id, page_start FROM {SECTIONS} WHERE regexp_matches(lower(coalesce(section_title, '')), '{_TITLE}'))
SELECT DISTINCT doc_id, unnest(range(page_start, stop + 1)) AS page FROM r JOIN w USING (doc_id, page_start)""")
def section_page_selection(spark: SparkSession, folder: str) -> DataFrame:
    entries = read_table(spark, folder, "report_section").select("doc_id", "section_title", "page_start", "page_end")
    return pages.pages_of_entries(entries, "doc_id", "section_title", "page_start", "page_end", _TITLE).select("doc_id", F.col("page").cast("long").alias("page"))


_HEAD = "^([^|\\n]+?)\\s*\\|\\s*((?:FY|CY)\\d{4})\\s*\\|\\s*Page\\s+(\\d+)"


@query("page_heads", f"""
SELECT doc_id, trim(regexp_extract(text, '{_HEAD}', 1)) AS company, regexp_extract(text, '{_HEAD}', 2) AS period, CAST(regexp_extract(text, '{_HEAD}', 3) AS INT) AS page
FROM documents WHERE regexp_matches(text, '{_HEAD}')""")
def page_heads(spark: SparkSession, folder: str) -> DataFrame:
    def part(i: int):
        return F.regexp_extract("text", _HEAD, i)

    found = read_table(spark, folder, "documents").where(F.col("text").rlike(_HEAD))
    return found.select("doc_id", F.trim(part(1)).alias("company"), part(2).alias("period"), part(3).cast("int").alias("page"))


@query("head_agreement", f"""
SELECT d.company_id, count(*) AS heads, count(*) FILTER (c.name = trim(regexp_extract(d.text, '{_HEAD}', 1))) AS same_company, count(*) FILTER (CAST(d.fiscal_year AS VARCHAR) = right(regexp_extract(d.text, '{_HEAD}', 2), 4)) AS same_year
FROM documents d LEFT JOIN company c USING (company_id) WHERE regexp_matches(d.text, '{_HEAD}') GROUP BY ALL""")
def head_agreement(spark: SparkSession, folder: str) -> DataFrame:
    found = read_table(spark, folder, "documents").where(F.col("text").rlike(_HEAD))
    found = found.select("company_id", "fiscal_year", F.trim(F.regexp_extract("text", _HEAD, 1)).alias("head"), F.regexp_extract("text", _HEAD, 2).alias("period"))
    named = found.join(read_table(spark, folder, "company").select("company_id", "name"), "company_id", "left")
    return named.groupBy("company_id").agg(F.count(F.lit(1)).alias("heads"), F.count_if(F.col("name") == F.col("head")).alias("same_company"), F.count_if(F.col("fiscal_year").cast("string") == F.right("period", F.lit(4))).alias("same_year"))


_Q = " + ".join("len(regexp_extract_all(text, '(?i)" + p.replace("'", "''") + "'))" for p in text.QUANTITY_PATTERNS)
_NUMS = "len(regexp_extract_all(text, '[0-9]+'))"
_P = f"(SELECT company_id || ':' || fiscal_year AS report, page, CAST(max({_Q}) AS INT) AS score, CAST(max({_NUMS}) AS INT) AS numbers FROM documents WHERE company_id IS NOT NULL AND fiscal_year IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL GROUP BY ALL)"


@query("sparse_expansion", f"""
WITH p AS {_P}, s AS (SELECT report, page FROM p WHERE score >= 3), d AS (SELECT p.report, sum(numbers) FILTER (s.page IS NOT NULL) AS n FROM p LEFT JOIN s USING (report, page) GROUP BY ALL),
x AS (SELECT p.report, p.page, row_number() OVER (PARTITION BY p.report ORDER BY p.score DESC, p.page) AS k FROM p JOIN d USING (report) LEFT JOIN s ON s.report = p.report AND s.page = p.page WHERE s.page IS NULL AND coalesce(d.n, 0) < 50)
SELECT report, page FROM s UNION SELECT report, page FROM x WHERE k <= 5""")
def sparse_expansion(spark: SparkSession, folder: str) -> DataFrame:
    d = read_table(spark, folder, "documents").dropna(subset=["company_id", "fiscal_year", "page", "text"])
    t = F.col("text")
    scored = d.select(F.concat_ws(":", "company_id", F.col("fiscal_year").cast("string")).alias("report"), "page", text.quantity_score(t).alias("s"), F.regexp_count(t, F.lit("[0-9]+")).alias("n"))
    p = scored.groupBy("report", "page").agg(F.max("s").alias("score"), F.max("n").alias("numbers"))
    return pages.expand_sparse(p, p.where("score >= 3"), "report", "page", "score", "numbers")


@query("restated_from", f"""
SELECT section_id, max(CAST(regexp_matches(lower(content), 'restated for') AS INT)) OVER (PARTITION BY doc_id ORDER BY page_start, section_id ROWS UNBOUNDED PRECEDING) = 1 AS restated FROM {SECTIONS}""")
def restated_from(spark: SparkSession, folder: str) -> DataFrame:
    s = read_table(spark, folder, "report_section").select("section_id", "doc_id", "page_start", F.lower("content").rlike("restated for").alias("f")).distinct()
    return pages.sticky(s, "doc_id", ["page_start", "section_id"], F.col("f"), "restated").select("section_id", "restated")


@query("table_parts", f"""
WITH l AS (SELECT section_id, list_filter(string_split(coalesce(content, ''), chr(10)), lambda x: starts_with(trim(x), '|')) AS rows FROM {SECTIONS}), t AS (SELECT section_id, rows[1:2] AS head, rows[3:] AS body FROM l WHERE len(rows) > 2),
p AS (SELECT *, unnest(range(0, len(body), 4)) AS s FROM t)
SELECT section_id, CAST(s // 4 + 1 AS INT) AS part, md5(array_to_string(list_concat(head, body[s + 1:s + 4]), chr(10))) AS digest FROM p""")
def table_parts(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.filter(F.split(F.coalesce("content", F.lit("")), "\n"), lambda x: F.trim(x).startswith("|"))
    s = read_table(spark, folder, "report_section").select("section_id", lines.alias("rows")).dropDuplicates(["section_id"]).where(F.size("rows") > 2)
    s = s.select("section_id", F.slice("rows", 1, 2).alias("head"), F.slice("rows", F.lit(3), F.size("rows")).alias("body"))
    return pages.split_table_rows(s, ["section_id"], "head", "body", 4).select("section_id", "part", F.md5("content").alias("digest"))


@query("contained_evidence", f"""
WITH f AS (SELECT fact_id, doc_id, value, {_CL.format(c='evidence')} AS e FROM {FACTS} WHERE value IS NOT NULL), h AS (
 SELECT a.fact_id AS dropped, b.fact_id AS kept, length(b.e) AS n FROM f a JOIN f b ON a.doc_id = b.doc_id AND a.value = b.value AND length(a.e) < length(b.e) AND length(a.e) > 0 AND contains(b.e, a.e))
SELECT dropped, arg_min(kept, (-n, kept)) AS kept FROM h GROUP BY ALL""")
def contained_evidence(spark: SparkSession, folder: str) -> DataFrame:
    f = star.facts(spark, folder, "value is not null").select("fact_id", "doc_id", "value", dedup.clean(F.col("evidence")).alias("e"))
    return pages.contained_rows(f, ["doc_id", "value"], "fact_id", "e").select("dropped", "kept")


@query("anchored_observations", f"""
SELECT company_id, canonical_id, period, fact_type, obs_id FROM (SELECT *, row_number() OVER (PARTITION BY company_id, canonical_id, period, fact_type
 ORDER BY CAST(length(raw_name) > 20 AS INT) DESC, normalised_value DESC, obs_id) AS n FROM {LOADED} WHERE canonical_id IS NOT NULL AND company_id IS NOT NULL AND period IS NOT NULL AND fact_type IS NOT NULL AND raw_name IS NOT NULL) WHERE n = 1""")
def anchored_observations(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["company_id", "canonical_id", "period", "fact_type"]
    obs = star.loaded(spark, folder).dropna(subset=[*keys, "raw_name"]).select(*keys, "obs_id", "normalised_value", "raw_name")
    return pages.anchored(obs, keys, F.length("raw_name") > 20, "normalised_value", "obs_id").select(*keys, "obs_id")


_HK = "trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g'))"


@query("named_companies", f"""
WITH d AS (SELECT doc_id, ' ' || {_HK.format(c='text')} || ' ' AS t FROM documents WHERE text IS NOT NULL), a AS (SELECT company_id AS member, {_HK.format(c='name')} AS alias FROM company)
SELECT d.doc_id, arg_min(member, (-length(alias), alias)) AS member, arg_min(alias, (-length(alias), alias)) AS alias FROM d JOIN a ON contains(d.t, ' ' || a.alias || ' ') GROUP BY ALL""")
def named_companies(spark: SparkSession, folder: str) -> DataFrame:
    aliases = read_table(spark, folder, "company").select(F.col("company_id").alias("member"), heading_key(F.col("name")).alias("alias"))
    return pages.longest_alias(read_table(spark, folder, "documents").where("text is not null"), "doc_id", F.col("text"), aliases)


@query("final_confidence", f"""
SELECT obs_id, round(CASE normalization_status WHEN 'normalized' THEN 1.0 WHEN 'partial' THEN 0.85 WHEN 'new_metric' THEN 0.5 ELSE 0.0 END * CASE normalisation_confidence WHEN 'exact' THEN 0.95 WHEN 'inferred' THEN 0.75 WHEN 'needs_context' THEN 0.55 ELSE 0 END, 6) AS final_confidence FROM {OBS}""")
def final_confidence(spark: SparkSession, folder: str) -> DataFrame:
    def ladder(column: str, values: dict[str, float]):
        chain = F.lit(0.0)
        for name, value in values.items():
            chain = F.when(F.col(column) == name, value).otherwise(chain)
        return chain

    status = ladder("normalization_status", {"normalized": 1.0, "partial": 0.85, "new_metric": 0.5})
    sure = ladder("normalisation_confidence", {"exact": 0.95, "inferred": 0.75, "needs_context": 0.55})
    return star.observations(spark, folder).select("obs_id", F.round(status * sure, 6).alias("final_confidence"))
