"""Resolving metric names against a registry: aliases, hashed vectors, margins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions.similarity import hashed_slot
from verdant.functions.text import word_tokens


def alias_map(registry: DataFrame) -> DataFrame:
    """(key, canonical_id): every lower-case name, alias and id; one written twice goes to the smaller id."""
    names = F.concat(F.array("display_name", "canonical_id"), F.coalesce("aliases", F.array().cast("array<string>")))
    keys = registry.select("canonical_id", F.explode(names).alias("name")).select("canonical_id", F.lower(F.trim("name")).alias("key"))
    return keys.where("key <> ''").groupBy("key").agg(F.min("canonical_id").alias("canonical_id"))


def by_alias(rows: DataFrame, name: str, aliases: DataFrame) -> DataFrame:
    """rows with `canonical_id`, null where the name is no alias."""
    keyed = rows.withColumn("_key", F.lower(F.trim(name)))
    return keyed.join(aliases.withColumnRenamed("key", "_key"), "_key", "left").drop("_key")


# Words left out of definitions besides STOPWORDS.
DEFINITION_STOPWORDS = "as at into during across".split()


def definition_tokens(text: Column) -> Column:
    """Words of a definition and its pairs of neighbouring words, as `a_b`."""
    words = F.filter(word_tokens(text), lambda w: ~w.isin(*DEFINITION_STOPWORDS))
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit("_"), b))
    return F.concat(words, pairs)


def idf_weights(texts: DataFrame, tokens: Column) -> DataFrame:
    """(token, df, idf): ln((1 + N) / (1 + df)) + 1 over all rows."""
    total = texts.agg(F.count(F.lit(1))).scalar()
    df = texts.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return df.select("token", "df", (F.log((total + 1) / (F.col("df") + 1)) + 1.0).alias("idf"))


def hashed_vectors(texts: DataFrame, key: str, text: str, idf: DataFrame | None = None, tokens: Callable[[Column], Column] = word_tokens) -> DataFrame:
    """(key, slot, w): sparse unit vectors over 512 hashed slots of the text's tokens; those `idf` does not know weigh 1."""
    long = texts.select(F.col(key), F.explode(tokens(F.col(text))).alias("token"))
    weighted = long.join(idf.select("token", "idf"), "token", "left").withColumn("x", F.coalesce("idf", F.lit(1.0))) if idf is not None else long.withColumn("x", F.lit(1.0))
    slots = weighted.groupBy(key, hashed_slot(F.col("token")).alias("slot")).agg(F.sum("x").alias("x"))
    length = slots.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("_len"))
    return slots.join(length, key).select(key, "slot", (F.col("x") / F.col("_len")).alias("w"))


def top_matches(queries: DataFrame, entries: DataFrame, key: str, entry: str, k: int, digits: int = 6) -> DataFrame:
    """(key, entry, score, rank, margin): the k entries with the largest inner product; margin is the lead over the next.

    Vectors meet on shared slots only; entries without one do not come out.
    """
    score = queries.join(entries.withColumnRenamed("w", "_w"), "slot").groupBy(key, entry).agg(F.round(F.sum(F.col("w") * F.col("_w")), digits).alias("score"))
    w = Window.partitionBy(key).orderBy(F.desc("score"), entry)
    ranked = score.withColumns({"rank": F.row_number().over(w), "_next": F.lead("score", 1, 0.0).over(w)})
    return ranked.where(F.col("rank") <= k).select(key, entry, "score", "rank", F.round(F.col("score") - F.col("_next"), digits).alias("margin"))


def accept(score: Column, margin: Column, floor: float = 0.65, least_margin: float = 0.2) -> Column:
    """accept over the floor and the margin, review over the floor only, else none."""
    return F.when((score >= floor) & (margin >= least_margin), "accept").when(score >= floor, "review").otherwise("none")


def first_decision(rows: DataFrame, key: str, keyed: DataFrame, memory: DataFrame) -> DataFrame:
    """(key, decision, kind): the decision found under the most specific of a row's keys.

    keyed: key, priority (smaller first), kind, lookup; memory: kind, lookup, decision.
    """
    hits = keyed.join(memory, ["kind", "lookup"]).groupBy(key).agg(F.min_by(F.struct("decision", "kind"), F.struct("priority", "decision")).alias("d"))
    return rows.select(key).join(hits, key, "left").select(key, F.col("d.decision").alias("decision"), F.col("d.kind").alias("kind"))
