"""Queries over pages, chunks, sections and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdant.functions import text
from verdant.operators import chunks, intervals, star
from verdant.plans.catalogue import query
from verdant.plans.star import CHUNKS, SECTIONS
from verdant.sources import read_table


def _chunks(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return read_table(spark, folder, "report_chunk").select(*columns).dropDuplicates(["chunk_id"])


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '')"


@query("word_chunks", f"""
WITH w AS (SELECT doc_id, coalesce(page, 0) AS page, {_WORDS} AS w FROM documents),
s AS (SELECT *, unnest(range(0, greatest(len(w) - 70 - 1, 0) + 1, 450)) AS s FROM w WHERE len(w) > 0)
SELECT doc_id || '_p' || CASE WHEN page > 999 THEN CAST(page AS VARCHAR) ELSE lpad(CAST(page AS VARCHAR), 3, '0') END || '_' || CAST(s // 450 + 1 AS VARCHAR) AS chunk_id,
 CAST(len(w[s + 1:s + 520]) AS INT) AS words, md5(array_to_string(w[s + 1:s + 520], ' ')) AS digest FROM s""")
def word_chunks(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "documents").select("doc_id", F.coalesce("page", F.lit(0)).alias("page"), "text")
    built = chunks.build_chunks(pages, "doc_id", "page", "text")
    return built.select("chunk_id", F.size(F.split("content", " ")).alias("words"), F.md5("content").alias("digest"))


@query("sentence_chunks")
def sentence_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.sentence_chunks(read_table(spark, folder, "documents"), "doc_id", "text")


@query("chunk_links", f"""
SELECT chunk_id, lag(chunk_id) OVER w AS prev_chunk_id, lead(chunk_id) OVER w AS next_chunk_id FROM (
 SELECT *, CAST(regexp_extract(chunk_id, '_p([0-9]+)_[0-9]+$', 1) AS INT) AS p, CAST(regexp_extract(chunk_id, '_([0-9]+)$', 1) AS INT) AS n FROM {CHUNKS}) WINDOW w AS (PARTITION BY doc_id ORDER BY p, n, chunk_id)""")
def chunk_links(spark: SparkSession, folder: str) -> DataFrame:
    c = _chunks(spark, folder, "chunk_id", "doc_id")
    c = c.withColumns({"p": F.regexp_extract("chunk_id", r"_p(\d+)_\d+$", 1).cast("int"), "n": F.regexp_extract("chunk_id", r"_(\d+)$", 1).cast("int")})
    return chunks.link_chunks(c, "doc_id", ["p", "n", "chunk_id"]).select("chunk_id", "prev_chunk_id", "next_chunk_id")


@query("neighbour_context", f"""
SELECT k.chunk_id, md5(concat_ws(chr(10) || '---' || chr(10), p.content, k.content, n.content)) AS digest FROM {CHUNKS} k
LEFT JOIN {CHUNKS} p ON p.chunk_id = k.prev_chunk_id LEFT JOIN {CHUNKS} n ON n.chunk_id = k.next_chunk_id""")
def neighbour_context(spark: SparkSession, folder: str) -> DataFrame:
    c = _chunks(spark, folder, "chunk_id", "prev_chunk_id", "next_chunk_id", "content")
    return chunks.with_context(c).select("chunk_id", F.md5("context").alias("digest"))


@query("broken_links", f"SELECT k.doc_id, count(*) AS links, count(*) FILTER (n.chunk_id IS NULL OR n.prev_chunk_id IS DISTINCT FROM k.chunk_id) AS broken FROM {CHUNKS} k LEFT JOIN {CHUNKS} n ON n.chunk_id = k.next_chunk_id WHERE k.next_chunk_id IS NOT NULL GROUP BY ALL")
def broken_links(spark: SparkSession, folder: str) -> DataFrame:
    """For each report, its links to a next chunk and those that do not lead back."""
    c = _chunks(spark, folder, "doc_id", "chunk_id", "prev_chunk_id", "next_chunk_id")
    n = c.select(F.col("chunk_id").alias("next_chunk_id"), F.col("prev_chunk_id").alias("back"))
    linked = c.where("next_chunk_id is not null").join(n, "next_chunk_id", "left")
    return linked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("links"), F.count_if(~F.col("back").eqNullSafe(F.col("chunk_id"))).alias("broken"))


@query("table_cells", f"""
WITH l AS (SELECT section_id, unnest(string_split(coalesce(content, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(content, ''), chr(10)), 1) - 1 AS row_no FROM {SECTIONS}),
c AS (SELECT section_id, row_no, list_transform(string_split(regexp_replace(trim(line), '^\\||\\|$', '', 'g'), '|'), lambda x: trim(x)) AS cells FROM l WHERE starts_with(trim(line), '|')),
r AS (SELECT *, len(list_filter(cells, lambda x: NOT regexp_matches(x, '^:?-{{2,}}:?$'))) = 0 AS rule FROM c),
t AS (SELECT *, row_no - row_number() OVER (PARTITION BY section_id ORDER BY row_no) AS tab FROM r),
h AS (SELECT *, CASE WHEN rule THEN lag(cells) OVER w END AS head, coalesce(lead(rule) OVER w, false) AS is_head FROM t WINDOW w AS (PARTITION BY section_id, tab ORDER BY row_no)),
b AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY section_id, tab ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS header FROM h),
x AS (SELECT section_id, row_no, cells[1] AS metric, header, unnest(cells) AS value, generate_subscripts(cells, 1) AS pos FROM b WHERE NOT rule AND NOT is_head AND header IS NOT NULL)
SELECT section_id, CAST(row_no AS INT) AS row_no, metric, header[pos] AS column_name, value FROM x WHERE pos > 1 AND pos <= len(header) AND value NOT IN ('', '-')""")
def table_cells(spark: SparkSession, folder: str) -> DataFrame:
    sections = read_table(spark, folder, "report_section").select("section_id", "content").dropDuplicates(["section_id"])
    return chunks.unpivot_tables(sections, ["section_id"], "content")


@query("section_ranges", f"""
WITH s AS (SELECT doc_id, page_start, max(page_end) AS last FROM {SECTIONS} GROUP BY ALL), m AS (SELECT *, max(last) OVER (PARTITION BY doc_id) AS whole FROM s)
SELECT doc_id, page_start, coalesce(lead(page_start) OVER (PARTITION BY doc_id ORDER BY page_start) - 1, greatest(whole, page_start)) AS "end" FROM m""")
def section_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.ranges_to_next(read_table(spark, folder, "report_section").select("doc_id", "page_start", "page_end"), "doc_id", "page_start", "page_end")


_QUANTITY = " + ".join("len(regexp_extract_all(text, '(?i)" + p.replace("'", "''") + "'))" for p in text.QUANTITY_PATTERNS)
_SCORED = f"(SELECT company_id || ':' || fiscal_year AS report, page, CAST(max({_QUANTITY}) AS INT) AS score FROM documents WHERE company_id IS NOT NULL AND fiscal_year IS NOT NULL AND page IS NOT NULL AND text IS NOT NULL GROUP BY ALL)"


def _scored_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of each company's year; several documents may share a page number."""
    d = read_table(spark, folder, "documents").dropna(subset=["company_id", "fiscal_year", "page", "text"])
    scored = d.select(F.concat_ws(":", "company_id", F.col("fiscal_year").cast("string")).alias("report"), "page", text.quantity_score(F.col("text")).alias("score"))
    return scored.groupBy("report", "page").agg(F.max("score").cast("int").alias("score"))


_SELECTED = f"(SELECT report, page FROM (SELECT *, row_number() OVER (PARTITION BY report ORDER BY score DESC, page) AS n FROM {_SCORED}) WHERE score >= 3 OR n <= 2)"


@query("page_selection", _SELECTED[1:-1])
def page_selection(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.select_by_score(_scored_pages(spark, folder), "report", "page", "score", 3, 2).select("report", "page")


@query("gap_fill", f"""
SELECT report, unnest(range(page, CASE WHEN nxt - page <= 5 THEN nxt ELSE page + 1 END)) AS page FROM (
 SELECT report, page, lead(page) OVER (PARTITION BY report ORDER BY page) AS nxt FROM {_SELECTED})""")
def gap_fill(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.fill_gaps(page_selection(spark, folder), "report", "page", 5).select("report", F.col("page").cast("long").alias("page"))


@query("page_buffer", f"SELECT DISTINCT report, unnest(range(greatest(page - 2, 1), page + 3)) AS page FROM {_SELECTED}")
def page_buffer(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.buffer_pages(page_selection(spark, folder), "report", "page", 2).select("report", F.col("page").cast("long").alias("page"))


@query("page_islands", f"""
SELECT report, min(page) AS first, max(page) AS last FROM (SELECT report, page, page - row_number() OVER (PARTITION BY report ORDER BY page) AS run FROM {_SELECTED}) GROUP BY report, run""")
def page_islands(spark: SparkSession, folder: str) -> DataFrame:
    return intervals.islands(page_selection(spark, folder), "report", "page")


@query("coverage_audit", f"""
SELECT p.report, count(*) AS pages, count(s.page) AS selected, CAST(sum(CASE WHEN s.page IS NULL THEN p.score ELSE 0 END) AS BIGINT) AS missed_score,
CASE WHEN sum(CASE WHEN s.page IS NULL THEN p.score ELSE 0 END) >= 5 THEN 'HIGH' WHEN count(s.page) < count(*) THEN 'MEDIUM' ELSE 'LOW' END AS risk
FROM {_SCORED} p LEFT JOIN {_SELECTED} s ON p.report = s.report AND p.page = s.page GROUP BY ALL""")
def coverage_audit(spark: SparkSession, folder: str) -> DataFrame:
    pages = _scored_pages(spark, folder)
    rank = F.row_number().over(Window.partitionBy("report").orderBy(F.desc("score"), "page"))
    chosen = pages.withColumn("n", rank).withColumn("sel", (F.col("score") >= 3) | (F.col("n") <= 2))
    missed = F.sum(F.when(F.col("sel"), 0).otherwise(F.col("score")))
    risk = F.when(missed >= 5, "HIGH").when(F.count_if("sel") < F.count(F.lit(1)), "MEDIUM").otherwise("LOW")
    return chosen.groupBy("report").agg(F.count(F.lit(1)).alias("pages"), F.count_if("sel").alias("selected"), missed.alias("missed_score"), risk.alias("risk"))


@query("keyword_scores", """
WITH k AS (SELECT DISTINCT lower(a) AS term FROM (SELECT unnest(list_concat(aliases, [display_name])) AS a FROM consumer_master_registry_v1) WHERE length(a) >= 3),
w AS (SELECT term, CASE WHEN regexp_matches(term, '[0-9]|/|%') OR length(term) - length(replace(term, ' ', '')) >= 2 THEN 3 WHEN contains(term, ' ') OR length(term) >= 12 THEN 2 ELSE 1 END AS weight FROM k)
SELECT d.doc_id, CAST(sum(w.weight) AS BIGINT) AS score, count(*) AS terms FROM documents d JOIN w ON contains(lower(d.text), w.term) GROUP BY ALL""")
def keyword_scores(spark: SparkSession, folder: str) -> DataFrame:
    reg = read_table(spark, folder, "consumer_master_registry_v1")
    terms = reg.select(F.explode(F.concat("aliases", F.array("display_name"))).alias("a")).where(F.length("a") >= 3).select(F.lower("a").alias("term")).distinct()
    # The registry is a fixed list; its terms become one value that every page is checked against in a single pass.
    listed = terms.agg(F.array_sort(F.collect_set("term"))).scalar()
    hits = F.filter("_terms", lambda k: F.contains(F.col("_t"), k))
    pages = read_table(spark, folder, "documents").where("text is not null").select("doc_id", F.lower("text").alias("_t"), listed.alias("_terms"))
    pages = pages.select("doc_id", hits.alias("hits")).where(F.size("hits") > 0)
    weight = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, k: acc + text.keyword_weight(k).cast("long"))
    return pages.select("doc_id", weight.alias("score"), F.size("hits").cast("long").alias("terms"))


@query("running_section", f"""
SELECT chunk_id, last_value(nullif(trim(section_title), '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY p, n, chunk_id ROWS UNBOUNDED PRECEDING) AS section FROM (
 SELECT *, CAST(regexp_extract(chunk_id, '_p([0-9]+)_[0-9]+$', 1) AS INT) AS p, CAST(regexp_extract(chunk_id, '_([0-9]+)$', 1) AS INT) AS n FROM {CHUNKS})""")
def running_section(spark: SparkSession, folder: str) -> DataFrame:
    c = _chunks(spark, folder, "chunk_id", "doc_id", "section_title")
    c = c.withColumns({"p": F.regexp_extract("chunk_id", r"_p(\d+)_\d+$", 1).cast("int"), "n": F.regexp_extract("chunk_id", r"_(\d+)$", 1).cast("int")})
    return chunks.running_label(c, "doc_id", ["p", "n", "chunk_id"], F.nullif(F.trim("section_title"), F.lit("")), "section").select("chunk_id", "section")


@query("signal_blocks", f"""
WITH c AS (SELECT chunk_id, doc_id, CAST(regexp_extract(chunk_id, '_p([0-9]+)_[0-9]+$', 1) AS INT) AS p, CAST(regexp_extract(chunk_id, '_([0-9]+)$', 1) AS INT) AS n,
 contains(content, '|') AS f FROM {CHUNKS})
SELECT chunk_id FROM (SELECT chunk_id, max(CAST(f AS INT)) OVER (PARTITION BY doc_id ORDER BY p, n, chunk_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM c) WHERE near = 1""")
def signal_blocks(spark: SparkSession, folder: str) -> DataFrame:
    c = _chunks(spark, folder, "chunk_id", "doc_id", "content").select("chunk_id", "doc_id", F.col("content").contains("|").alias("f"))
    c = c.withColumns({"p": F.regexp_extract("chunk_id", r"_p(\d+)_\d+$", 1).cast("int"), "n": F.regexp_extract("chunk_id", r"_(\d+)$", 1).cast("int")})
    return chunks.keep_with_neighbours(c, "doc_id", ["p", "n", "chunk_id"], F.col("f")).select("chunk_id")


@query("small_chunks", f"SELECT chunk_id FROM {CHUNKS} WHERE (length(content) + 3) // 4 < 100")
def small_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return _chunks(spark, folder, "chunk_id", "content").where(text.token_estimate(F.col("content")) < 100).select("chunk_id")
