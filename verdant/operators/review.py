"""What a reviewer is shown: ties, nearest candidates, contexts, counters, and merges of decisions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def margin_ties(scored: DataFrame, key: str, candidate: str, score: str, margin: float = 0.20, most: int = 3) -> DataFrame:
    """(key, candidate, score, place): candidates within the margin of the best of their key, at most `most`; equal scores by name.

    scored holds a shortlist for each key, so no window is large.
    """
    best = Window.partitionBy(key)
    order = Window.partitionBy(key).orderBy(F.desc(score), candidate)
    tied = scored.withColumns({"_top": F.max(score).over(best), "place": F.row_number().over(order)})
    return tied.where((F.col(score) >= F.round(F.col("_top") - margin, 9)) & (F.col("place") <= most)).select(key, candidate, score, "place")


def in_order(streams: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Streams one after the other, each key once: the row of the first stream that has it; `stream` and `precedence` tell which."""
    parts = [df.withColumns({"stream": F.lit(name), "precedence": F.lit(i)}) for i, (name, df) in enumerate(streams)]
    whole = reduce(DataFrame.unionByName, parts)
    rest = [c for c in whole.columns if c != key]
    return whole.groupBy(key).agg(F.min_by(F.struct(*rest), F.col("precedence")).alias("_row")).select(key, "_row.*")


def value_band(value: Column, share: float) -> Column:
    """Sign and logarithmic band of a value: values within `share` of each other lie in one band or in two that touch."""
    return F.struct(F.signum(value).cast("int").alias("sign"), F.when(value == 0, 0).otherwise(F.floor(F.ln(F.abs(value)) / -math.log1p(-share))).cast("long").alias("band"))


def touching_bands(value: Column, share: float) -> Column:
    """The bands in which a value's partners lie."""
    own = value_band(value, share)
    return F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: F.struct(own["sign"].alias("sign"), (own["band"] + i).alias("band")))


def nearest_values(asked: DataFrame, rows: DataFrame, keys: list[str], asked_id: str, row_id: str, value: str, document: str, share: float = 0.04, most: int = 5) -> DataFrame:
    """(asked_id, row_id, same_document, gap, place): rows of the same keys within `share` of the asked value, own document first, then nearest.

    Values meet in logarithmic bands as wide as the share, so a hot key is not compared with
    itself; zero and negative values have bands of their own.
    """
    left = asked.select(*keys, F.col(asked_id).alias("_a"), F.col(value).alias("_x"), F.col(document).alias("_d"))
    left = left.withColumn("_band", F.explode(touching_bands(F.col("_x"), share)))
    right = rows.select(*keys, F.col(row_id).alias("_b"), F.col(value).alias("_y"), F.col(document).alias("_e")).withColumn("_band", value_band(F.col("_y"), share))
    near = left.join(right, [*keys, "_band"]).where((F.col("_a") != F.col("_b")) & (F.abs(F.col("_y") - F.col("_x")) <= share * F.abs(F.col("_x"))))
    near = near.select(F.col("_a").alias("asked"), F.col("_b").alias("found"), F.coalesce(F.col("_d") == F.col("_e"), F.lit(False)).alias("same_document"), F.abs(F.col("_y") - F.col("_x")).alias("gap"))
    order = F.struct(F.when(F.col("same_document"), 0).otherwise(1).alias("o"), "gap", "found", "same_document")
    # The first few of each asked row, kept as a sorted array while partial results are merged.
    best = near.groupBy("asked").agg(F.slice(F.array_sort(F.collect_set(order)), 1, most).alias("_best"))
    return best.select("asked", F.posexplode("_best").alias("_n", "_b")).select("asked", "_b.found", "_b.same_document", "_b.gap", (F.col("_n") + 1).alias("place"))


def counters(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, category, n) of several columns in one pass."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("category")) for c in columns))
    return df.select(F.inline(pairs)).groupBy("field", "category").agg(F.count(F.lit(1)).alias("n"))


def surrounding(chunks: DataFrame, group: str, order: list[str], text: str) -> DataFrame:
    """chunks with before, after and second_after: the text of the neighbours within the group."""
    w = Window.partitionBy(group).orderBy(*order)
    return chunks.withColumns({"before": F.lag(text).over(w), "after": F.lead(text).over(w), "second_after": F.lead(text, 2).over(w)})


def merge_registry(base: DataFrame, override: DataFrame, key: str, names: str) -> DataFrame:
    """base and override by key: fields of the override where it states them, the names of both together, lower-case duplicates once."""
    fields = [c for c in base.columns if c not in (key, names)]
    joined = base.alias("a").join(override.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(F.col(f"a.{names}"), empty), F.coalesce(F.col(f"b.{names}"), empty))
    first = F.filter(both, lambda x, i: F.array_position(F.transform(both, lambda y: F.lower(F.trim(y))), F.lower(F.trim(x))) == i + 1)
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *(F.coalesce(f"b.{c}", f"a.{c}").alias(c) for c in fields), first.alias(names))


def keep_by_filter(facts: DataFrame, **wanted: str | float | None) -> DataFrame:
    """facts whose columns hold the wanted texts, whatever the case; a number is the least value; None asks nothing."""
    for column, value in wanted.items():
        if isinstance(value, str):
            facts = facts.where(F.lower(F.coalesce(column, F.lit(""))).contains(value.lower()))
        elif value is not None:
            facts = facts.where((F.col(column) >= value) & ~F.isnan(column))
    return facts
