"""Queries on metric names: risk, proposed ids, usage, remembered decisions, leader clusters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.functions import facts as say
from verdant.functions.text import STOPWORDS
from verdant.operators import cluster, pages, resolve, star
from verdant.plans.catalogue import query
from verdant.plans.star import FACTS, OBS
from verdant.sources import read_table

_T = "lower(trim(coalesce(metric, '')))"
_W = f"list_filter(regexp_split_to_array({_T}, '[\\s_]+'), lambda w: w <> '')"
_VERBS = ", ".join(f"'{v}'" for v in say.STATEMENT_VERBS)
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)


@query("name_risks", f"""
SELECT fact_id, CASE WHEN {_T} = '' THEN 'high' WHEN coalesce({_W}[1], '') IN ({_VERBS}) OR regexp_matches({_T}, '[0-9]{{2,}}') OR len({_W}) > 6 THEN 'high'
 WHEN length({_T}) > 40 OR list_has_any({_W}, ['the', 'a', 'an', 'our', 'we']) THEN 'medium' ELSE 'low' END AS risk FROM {FACTS}""")
def name_risks(spark: SparkSession, folder: str) -> DataFrame:
    return star.facts(spark, folder).select("fact_id", say.name_risk(F.col("metric")).alias("risk"))


@query("proposed_ids", f"""
SELECT obs_id, nullif(array_to_string(list_filter(regexp_extract_all(lower(coalesce(raw_name, '')), '[a-z0-9]+'), lambda w: w NOT IN ({_STOP}) AND NOT regexp_matches(w, '^[0-9]+$'))[1:5], '_'), '') AS proposed_id
FROM {OBS} WHERE canonical_id IS NULL""")
def proposed_ids(spark: SparkSession, folder: str) -> DataFrame:
    return star.observations(spark, folder, "canonical_id is null").select("obs_id", say.proposed_id(F.col("raw_name")).alias("proposed_id"))


@query("registry_usage", f"""
SELECT r.canonical_id, r.category, count(o.obs_id) AS usage FROM consumer_master_registry_v1 r LEFT JOIN {OBS} o USING (canonical_id) GROUP BY ALL""")
def registry_usage(spark: SparkSession, folder: str) -> DataFrame:
    used = star.observations(spark, folder).groupBy("canonical_id").agg(F.count(F.lit(1)).alias("usage"))
    return read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "category").join(used, "canonical_id", "left").fillna(0, ["usage"])


@query("remembered_decisions", f"""
WITH m AS (SELECT 'name' AS kind, lower(trim(raw_name)) AS lookup, max(canonical_id) AS decision FROM {OBS} WHERE canonical_id IS NOT NULL AND raw_name IS NOT NULL GROUP BY ALL HAVING count(DISTINCT canonical_id) = 1
 UNION ALL SELECT 'company', company_id || '|' || lower(trim(raw_name)), max(canonical_id) FROM {OBS} WHERE canonical_id IS NOT NULL AND raw_name IS NOT NULL AND company_id IS NOT NULL GROUP BY ALL HAVING count(DISTINCT canonical_id) = 1),
o AS (SELECT obs_id, company_id, lower(trim(raw_name)) AS n FROM {OBS} WHERE canonical_id IS NULL)
SELECT o.obs_id, coalesce(c.decision, g.decision) AS decision, CASE WHEN c.decision IS NOT NULL THEN 'company' WHEN g.decision IS NOT NULL THEN 'name' END AS kind FROM o
LEFT JOIN m c ON c.kind = 'company' AND c.lookup = o.company_id || '|' || o.n LEFT JOIN m g ON g.kind = 'name' AND g.lookup = o.n""")
def remembered_decisions(spark: SparkSession, folder: str) -> DataFrame:
    obs = star.observations(spark, folder).select("obs_id", "company_id", "canonical_id", F.lower(F.trim("raw_name")).alias("n"))

    def keys(df):
        both = F.array(F.struct(F.lit(1).alias("priority"), F.lit("company").alias("kind"), F.concat_ws("|", "company_id", "n").alias("lookup")), F.struct(F.lit(2).alias("priority"), F.lit("name").alias("kind"), F.col("n").alias("lookup")))
        return df.where("n is not null and company_id is not null").select("obs_id", "canonical_id", F.inline(both))

    memory = keys(obs.where("canonical_id is not null")).groupBy("kind", "lookup").agg(F.max("canonical_id").alias("decision"), F.count_distinct("canonical_id").alias("c")).where("c = 1").drop("c")
    open_rows = obs.where("canonical_id is null")
    return resolve.first_decision(open_rows, "obs_id", keys(open_rows).drop("canonical_id"), memory)


@query("leader_clusters")
def leader_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Greedy leader clusters of new metric names inside each company, in the order of first sight."""
    new = star.observations(spark, folder, "normalization_status = 'new_metric' and raw_name is not null and company_id is not null")
    first = new.groupBy("company_id", F.lower(F.trim("raw_name")).alias("name")).agg(F.min("obs_id").alias("seq"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(c, n, leader) for c, names in zip(batch["company_id"], batch["names"]) for n, leader, _ in cluster.leader_clusters([(x["name"], c) for x in names], 0.85)]
            yield pd.DataFrame(rows, columns=["company_id", "name", "leader"])

    listed = first.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct("seq", "name"))).alias("names"))  # distinct new names of one company
    return listed.mapInPandas(run, "company_id string, name string, leader string")


@query("selected_pages")
def selected_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of each company's year: titled sections and scored pages, sparse reports widened, gaps filled, neighbours added."""
    from verdant.functions import text
    from verdant.operators import intervals

    d = read_table(spark, folder, "documents").dropna(subset=["company_id", "fiscal_year", "page", "text"])
    t = F.col("text")
    entries = read_table(spark, folder, "consumer_master_registry_v1")
    listed = F.concat(F.array("display_name", "canonical_id"), F.coalesce("aliases", F.array().cast("array<string>")))
    terms = entries.select(F.explode(listed).alias("k")).select(F.regexp_replace(F.lower(F.trim(F.replace("k", F.lit("_"), F.lit(" ")))), r"\s+", " ").alias("k"))
    listed = terms.where("length(k) >= 3").agg(F.array_sort(F.collect_set("k"))).scalar()  # the registry is a fixed dimension table
    d = d.withColumn("keywords", listed)
    scored = d.select(F.concat_ws(":", "company_id", F.col("fiscal_year").cast("string")).alias("report"), "page", text.quantity_score(t).alias("s"), text.phrase_score(t, text.EXCLUDED_PHRASES).alias("x"), text.page_exclusion(t, F.col("keywords")).isNotNull().alias("out"), F.regexp_count(t, F.lit("[0-9]+")).alias("n"))
    p = scored.groupBy("report", "page").agg(F.max("s").alias("score"), F.max("x").alias("exclude"), F.max("out").alias("out"), F.max("n").alias("numbers"))
    last = p.groupBy("report").agg(F.max("page").alias("last"))
    chosen = intervals.select_by_score(p.where("exclude < 5 and not out"), "report", "page", "score", 3, 8)
    wide = pages.expand_sparse(p, chosen, "report", "page", "score", "numbers")
    filled = intervals.fill_gaps(wide, "report", "page", 5)
    return intervals.buffer_pages(filled.join(last, "report"), "report", "page", 2, last="last")
