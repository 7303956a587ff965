"""Scoring candidate metrics of a fact: definition, core and alias similarity, gates, margin."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.number import families_compatible, unit_family
from verdant.functions.semantics import gate_reasons, semantics_of
from verdant.functions.similarity import sequence_ratio
from verdant.functions.udf import once
from verdant.operators import resolve

# Weights of definition, core and alias similarity, and the limits of acceptance.
WEIGHTS = (0.70, 0.20, 0.10)
FLOOR, MARGIN, CORROBORATION = 0.65, 0.20, 0.45


@once
@F.pandas_udf(T.DoubleType())
def _best_ratio(name: pd.Series, names: pd.Series) -> pd.Series:
    return pd.Series([max((sequence_ratio(n, x) for x in xs), default=0.0) for n, xs in zip(name, names)], dtype="float64")


def candidates(facts: DataFrame, registry: DataFrame, shortlist: int = 8, unmatched: bool = False) -> DataFrame:
    """(key, canonical_id, definition, core, alias, blocked, score): the shortlist of each fact, scored.

    facts: key, name, unit.  Vectors of words and word pairs, weighted by their rarity in the
    registry, meet on shared slots; the sequence ratios, which no
    built-in expression equals, are computed for the shortlist only.  A candidate of another
    unit family, or whose subject, source or polarity contradicts the fact's, scores 0.
    """
    names = facts.select(F.col("name").alias("text")).where("text is not null").distinct()
    idf = resolve.idf_weights(registry.select("display_name"), resolve.definition_tokens(F.col("display_name")))
    vectors = resolve.hashed_vectors(names, "text", "text", idf, resolve.definition_tokens)
    entries = registry.select("canonical_id", "display_name", "unit", F.concat(F.array("display_name", "canonical_id"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("names"))
    known = resolve.hashed_vectors(entries, "canonical_id", "display_name", idf, resolve.definition_tokens)
    top = resolve.top_matches(vectors, known, "text", "canonical_id", shortlist)
    scored = top.join(entries, "canonical_id").select(
        "text", "canonical_id", "display_name", F.col("score").alias("definition"), F.col("unit").alias("c_unit"),
        _best_ratio("text", F.array("display_name")).alias("core"), _best_ratio("text", "names").alias("alias"),
    )
    joined = facts.join(scored, facts["name"] == scored["text"], "left" if unmatched else "inner")
    joined = joined.fillna(0.0, ["definition", "core", "alias"])
    why = gate_reasons(semantics_of(F.lower("name")), semantics_of(F.lower("display_name")), unit_family(F.col("unit")), unit_family(F.col("c_unit")))
    fits = families_compatible(unit_family(F.col("unit")), unit_family(F.col("c_unit")), F.lit("scalar"))
    blocked = (F.size(F.filter(why, lambda w: w != "role_mismatch")) > 0) | ~fits
    a, b, c = WEIGHTS
    weighted = a * F.col("definition") + b * F.col("core") + c * F.col("alias")
    score = F.round(F.when(blocked | F.col("canonical_id").isNull(), 0.0).otherwise(F.least(F.lit(1.0), weighted)), 6)
    return joined.select("key", "canonical_id", "definition", "core", "alias", blocked.alias("blocked"), score.alias("score"))


def decide(scored: DataFrame) -> DataFrame:
    """(key, canonical_id, score, margin, verdict): the best candidate of each fact.

    accept over floor, margin and corroboration by core or alias; tied inside the margin;
    quarantine over the floor without corroboration; new below it.
    """
    w = Window.partitionBy("key").orderBy(F.desc("score"), "canonical_id")  # at most the shortlist
    best = scored.withColumns({"n": F.row_number().over(w), "next": F.lead("score", 1, 0.0).over(w)}).where("n = 1")
    margin = F.round(F.col("score") - F.col("next"), 6)
    backed = F.greatest("core", "alias") >= CORROBORATION
    verdict = F.when(F.col("score") < FLOOR, "new").when(~backed, "quarantine").when(margin < MARGIN, "tied").otherwise("accept")
    return best.select("key", "canonical_id", "score", margin.alias("margin"), verdict.alias("verdict"))


def calibrate(decided: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: facts, right, mean and largest score of the right ones, their 10th percentile and mean margin."""
    right = F.col("canonical_id") == F.col("expected")
    hit = F.when(right, F.col("score"))
    return decided.join(truth, "key").agg(
        F.count(F.lit(1)).alias("facts"), F.count_if(right).alias("right"), F.round(F.avg(hit), 6).alias("mean_score"), F.max(hit).alias("most"),
        F.round(F.percentile(hit, F.lit(0.1)), 6).alias("p10"), F.round(F.avg(F.when(right, F.col("margin"))), 6).alias("mean_margin"),
    )


def magnitude_guard(rows: DataFrame, group: list[str], large: str, small: str, least_share: float = 0.01) -> DataFrame:
    """rows with `status` quarantine where a value of metric `large` is under a share of the group's largest `small`."""
    top = rows.where(F.col("canonical_id") == small).groupBy(*group).agg(F.max("normalised_value").alias("_top"))
    low = (F.col("canonical_id") == large) & (F.col("normalised_value") < least_share * F.col("_top"))
    return rows.join(top, group, "left").withColumn("status", F.when(F.coalesce(low, F.lit(False)), "quarantine").otherwise(F.col("normalization_status"))).drop("_top")


def blacklisted(name: Column, canonical: Column, listed: dict[str, list[str]]) -> Column:
    """Whether a name holds a phrase that may never be mapped to the canonical; plural s is ignored."""
    plain = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"s\b", "")
    hit = F.lit(False)
    for cid, phrases in listed.items():
        for phrase in phrases:
            hit = hit | ((canonical == cid) & plain.contains(phrase.lower().rstrip("s")))
    return hit


def candidate_valid(name: Column, canonical: Column, fact_unit: Column, canonical_unit: Column, fact_class: Column, listed: dict[str, list[str]]) -> Column:
    """Whether a candidate may be considered: its name not listed against the canonical, the unit families compatible for the class of fact."""
    return ~blacklisted(name, canonical, listed) & families_compatible(unit_family(fact_unit), unit_family(canonical_unit), fact_class)
