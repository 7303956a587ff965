"""Ordered de-duplication of facts and candidates.

Each stage keeps the best row of a key and gives it the chunk ids of those it replaces.  The
order of arrival is an explicit column: equal scores keep the first row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions.text import metric_key


def clean(text: Column) -> Column:
    """Lower case, runs of blanks one blank, trimmed; null is blank."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def clean_number(value: Column) -> Column:
    """The first number of a value without commas and trailing zeros; the cleaned text if it has none."""
    text = clean(value)
    number = F.regexp_replace(F.regexp_extract(text, r"(-?\d[\d,]*\.?\d*)", 1), ",", "")
    short = F.regexp_replace(F.regexp_replace(number, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(number == "", text).otherwise(short)


def clean_unit(unit: Column) -> Column:
    text = clean(unit)
    return F.when(text.isin("percentage", "percent", "per cent", "pct"), "%").otherwise(text)


def fact_score(decision: Column, confidence: Column, metric: Column, unit: Column, evidence: Column) -> Column:
    """What makes one of two equal facts the better: decision, confidence, metric and unit stated, shorter evidence."""
    rank = F.when(decision == "keep", 3).when(decision == "rescue", 2).when(decision == "drop", 1).otherwise(0)
    sure = F.when(confidence.isNull() | F.isnan(confidence) | ~confidence.between(0, 1), 0.0).otherwise(confidence)
    words = F.size(F.filter(F.split(metric_key(metric), " "), lambda w: w != ""))
    quality = F.when(F.trim(F.coalesce(metric, F.lit(""))) == "", 0).otherwise(words + F.when(metric.rlike("[A-Za-z]"), 3).otherwise(0))
    stated = F.when(clean_unit(unit).isin("", "-"), 0).otherwise(3)
    return F.struct(rank.alias("a"), sure.alias("b"), quality.alias("c"), stated.alias("d"), (-F.length(F.coalesce(evidence, F.lit("")))).alias("e"))


def running_number(record: Column) -> Column:
    """What orders ids by their digits read as one number of any length: how many without leading zeros, and those."""
    digits = F.ltrim(F.regexp_replace(record, "[^0-9]", ""), F.lit("0"))
    return F.struct(F.length(digits).alias("n"), digits.alias("digits"))


def keep_best(rows: DataFrame, group: str, keys: list[Column], order: str, record: str, chunk: str, merged: str, applies: Column) -> DataFrame:
    """One row per group and keys: the smallest in `order`, then in `record`; `merged` collects the other rows' chunk ids.

    Rows to which the stage does not apply are each their own key and pass through.  `group`
    stays a grouping column, so rows that lie together by it are not shuffled again; the
    collected ids are the group's own output.
    """
    alone = F.when(~F.coalesce(applies, F.lit(False)), F.col(record))
    named = {f"_k{i}": k for i, k in enumerate([*keys, alone])}
    columns = [order, record, *(c for c in rows.columns if c not in (group, order, record))]
    best = rows.withColumns(named).groupBy(group, *named).agg(
        F.min(F.struct(*columns)).alias("_row"),
        F.array_distinct(F.flatten(F.collect_list(F.array_union(F.array(chunk), merged)))).alias("_chunks"),
    )
    return best.select(group, "_row.*", "_chunks").withColumn(merged, F.array_sort(F.array_except("_chunks", F.array(chunk)))).select(*rows.columns)


def dedup_cascade(facts: DataFrame) -> DataFrame:
    """Four stages on (fact_id, doc_id, metric, value, unit, evidence, decision, confidence, chunk_id, seq):

    the same sentence, value, unit and metric; the same sentence, value and unit; the same
    sentence with one number and the same value; the same metric words, value and unit
    (blank metrics exempt), each inside one document.  Returns those columns with `merged`,
    the sorted chunk ids of the rows replaced.  Facts partitioned by doc_id are not shuffled.
    """
    sentence = clean(F.col("evidence"))
    score = fact_score(F.col("decision"), F.col("confidence"), F.col("metric"), F.col("unit"), F.col("evidence"))
    rows = facts.withColumns({"_order": F.struct(*((-score[n]).alias(n) for n in "abcde"), "seq"), "merged": F.array().cast("array<string>")})
    value, unit, metric = clean_number(F.col("value")), clean_unit(F.col("unit")), metric_key(F.col("metric"))
    stages = [
        ([sentence, clean(F.col("value")), clean(F.col("unit")), clean(F.col("metric"))], sentence != ""),
        ([sentence, value, unit], sentence != ""),
        ([sentence, value], (sentence != "") & (F.regexp_count(sentence, F.lit(r"\d[\d,]*\.?\d*")) == 1)),
        ([metric, value, unit], metric != ""),
    ]
    for keys, applies in stages:
        rows = keep_best(rows, "doc_id", keys, "_order", "fact_id", "chunk_id", "merged", applies)
    return rows.drop("_order")


def dedup_by_canonical(facts: DataFrame, order: dict[str, int], chunk: str | None = None) -> DataFrame:
    """One row per (source_doc_id, canonical_id, period_label, raw_value): the better status, then the smaller obs_id; `members` counts the group.

    With `chunk`, `merged` holds the sorted distinct chunk ids of the rows replaced, blank ones left out.
    """
    rank = F.lit(len(order))
    for status, place in order.items():
        rank = F.when(F.col("normalization_status") == status, place).otherwise(rank)
    keys = ["source_doc_id", "canonical_id", "period_label", "raw_value"]
    known = facts.where("canonical_id is not null")
    ranked = known.withColumn("_rank", rank)
    found = [F.min(F.struct("_rank", "obs_id")).alias("b"), F.count(F.lit(1)).alias("members")]
    if chunk is None:
        return ranked.groupBy(*keys).agg(*found).select(F.col("b.obs_id").alias("obs_id"), *keys, "members")
    best = ranked.groupBy(*keys).agg(*found, F.collect_list(F.struct("obs_id", F.col(chunk).alias("chunk"))).alias("_rows"))
    replaced = F.filter("_rows", lambda r: (r["obs_id"] != F.col("b.obs_id")) & (F.trim(F.coalesce(r["chunk"], F.lit(""))) != ""))
    merged = F.array_sort(F.array_distinct(F.transform(replaced, lambda r: r["chunk"])))
    return best.select(F.col("b.obs_id").alias("obs_id"), *keys, "members", merged.alias("merged"))


def renumber_candidates(rows: DataFrame, group: str, keys: list[Column], seq: str) -> DataFrame:
    """The first row of each key in a group, numbered c001, c002 ... in order of arrival."""
    named = {f"_k{i}": k for i, k in enumerate(keys)}
    first = rows.withColumns(named).groupBy(group, *named).agg(F.min(seq).alias(seq))
    number = F.row_number().over(Window.partitionBy(group).orderBy(seq))
    return first.select(group, seq, F.format_string("c%03d", number).alias("candidate"))


def distinct_ids(rows: DataFrame, name: str, parent: str, order: str) -> DataFrame:
    """Ids made unique: one that occurs once stays; others get their parent's slug and a running number."""
    counts = rows.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    ordinal = F.row_number().over(Window.partitionBy(name).orderBy(order))
    slugged = F.concat_ws("_", F.col(name), F.regexp_replace(F.lower(F.coalesce(parent, F.lit(""))), "[^a-z0-9]+", "-"), ordinal.cast("string"))
    joined = rows.join(counts, name)
    return joined.withColumn("unique_id", F.when(F.col("_n") == 1, F.col(name)).otherwise(slugged)).drop("_n")


def anchored(facts: DataFrame, keys: dict[str, Column], specific: list[str], score: Column, seq: str, record: str) -> DataFrame:
    """(record, specific): of the rows of an anchor those bound to something, one for each binding, else the best one.

    keys: what the anchor is made of; specific: columns that bind a row, blank ones bind
    nothing; score: a struct of numbers, larger is better; equal scores keep the first in
    `seq`, then the smaller record.  Two aggregations, no window over a group; what the second
    collects is the best row of each binding.
    """
    bound = {f"_b{i}": clean(F.col(c)) for i, c in enumerate(specific)}
    rows = facts.select(F.col(record).alias("record"), F.col(seq).alias("_seq"), score.alias("_score"), *(k.alias(n) for n, k in keys.items()), *(b.alias(n) for n, b in bound.items()))
    own = F.greatest(*(F.when(F.col(n).isin("", "-"), 0).otherwise(1) for n in bound), F.lit(0))
    rows = rows.withColumn("specific", own)
    order = [(-F.col(f"_score.{n}")).alias(n) for n in rows.schema["_score"].dataType.names]
    best = rows.groupBy(*keys, *bound, "specific").agg(F.min(F.struct(*order, "_seq", "record"))["record"].alias("record"))
    most = best.groupBy(*keys).agg(F.max("specific").alias("_most"), F.collect_list(F.struct("record", "specific")).alias("_rows"))
    kept = most.select(F.explode(F.filter("_rows", lambda r: r["specific"] == F.col("_most"))).alias("r"))
    return kept.select("r.record", (F.col("r.specific") == 1).alias("specific"))
