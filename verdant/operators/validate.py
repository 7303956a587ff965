"""Checks on extracted facts, the decision they lead to, and reports on quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.functions.number import numbers_in


def fact_checks(value: Column, unit: Column, evidence: Column, period: Column, metric: Column) -> dict[str, Column]:
    """The five checks by name: a single number, a unit, a period, an actual value, an unambiguous metric."""
    text = F.coalesce(value, F.lit(""))
    ranged = text.rlike(r"\d\s*(?:-|–|to)\s*\d") & ~F.lower(text).contains("from")
    return {
        "specific_number": (F.size(numbers_in(value)) >= 1) & ~ranged,
        "unit_clear": ~F.trim(F.coalesce(unit, F.lit(""))).isin("", "-"),
        "period_determinable": F.coalesce(period, F.lit("")).rlike(r"(?:19|20)\d{2}") | F.coalesce(evidence, F.lit("")).rlike(r"(?:FY|CY)\s?20\d{2}|20\d{2}[-/]\d{2}"),
        "is_actual": ~F.lower(F.coalesce(evidence, F.lit(""))).rlike(r"\b(target|aim to|plans? to|expected to)\b"),
        "unambiguous": F.size(F.filter(F.split(F.trim(F.coalesce(metric, F.lit(""))), r"\s+"), lambda w: w != "")) > 0,
    }


def failed_checks(checks: dict[str, Column]) -> Column:
    """Names of the checks that do not hold, in their order."""
    return F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())), lambda x: x.isNotNull())


def verdict(failed: Column) -> Column:
    """keep without a failure, rescue with one or two, drop with more."""
    n = F.size(failed)
    return F.when(n == 0, "keep").when(n <= 2, "rescue").otherwise("drop")


def rollup_counts(df: DataFrame, group: str, category: str) -> DataFrame:
    """(group, category, n) with the totals of each category over all groups, whose group is `(all)`."""
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(category).agg(F.sum("n").alias("n")).select(F.lit("(all)").alias(group), category, "n")
    return counts.unionByName(total)


def presence(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, rows, present, filled): present counts non-null values, filled those with other than blanks."""
    one = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(c).alias(f"p_{c}") for c in columns), *(F.count_if(F.trim(F.col(c).cast("string")) != "").alias(f"f_{c}") for c in columns))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("field"), F.col("rows").alias("rows"), F.col(f"p_{c}").alias("present"), F.col(f"f_{c}").alias("filled")) for c in columns))))


def multiset_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: str, right_order: str) -> DataFrame:
    """The n-th left row of a key with the n-th right row of it; extra rows on the left stay with nulls."""
    from pyspark.sql import Window

    a = left.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(left_order)))
    b = right.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(right_order)))
    same = (a["_n"] == b["_n"]) & F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[k])
    return a.join(b, same, "left").select(*(a[c] for c in left.columns), *(b[c] for c in right.columns if c not in keys))


def merge_reviews(reviews: DataFrame, key: str, signature: str, seq: str) -> DataFrame:
    """(key, decision, conflict): the last decision of a key, accepted only where all its signatures agree."""
    g = reviews.groupBy(key).agg(F.count_distinct(signature).alias("_n"), F.max_by(signature, seq).alias("decision"))
    return g.select(key, F.when(F.col("_n") == 1, F.col("decision")).alias("decision"), (F.col("_n") > 1).alias("conflict"))
