"""Queries of the training-data operators, and the DuckDB statements they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import canonical, golden, leak, mixing, neardup, skeleton, split
from verdant.sources import read_table


def _items(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        read_table(spark, folder, f"report_{kind}").select(F.lit(kind).alias("item_kind"), F.col(f"{kind}_id").alias("item_id"), "doc_id", "content")
        for kind in ("section", "chunk")
    ]
    return parts[0].unionByName(parts[1])


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    pieces = split.split_oversized(_items(spark, folder), ["item_kind", "item_id"])
    return pieces.where("n_pieces > 1").select("item_kind", "item_id").distinct()


def p1_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_oversized(_items(spark, folder), ["item_kind", "doc_id", "item_id"])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    facts = read_table(spark, folder, "extracted_fact")
    return golden.best_records(facts, golden.fact_group_key(facts), "fact_id", golden.survivor_fields()).select("fact_id", "evidence_fact_id")


def p2_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return golden.merge_facts(read_table(spark, folder, "extracted_fact"))


def p2_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return golden.duplicate_chunks(read_table(spark, folder, "extracted_fact"))


def _mapped(spark: SparkSession, folder: str) -> DataFrame:
    return canonical.map_values(read_table(spark, folder, "extracted_fact"), ["fact_id"], "metric", read_table(spark, folder, "consumer_master_registry_v1"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return _mapped(spark, folder).select("fact_id", "canonical_id").distinct()


def p3_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    grouped = _mapped(spark, folder).groupBy("value", "canonical_id", "matched_name", "score")
    return grouped.agg(F.count(F.lit(1)).alias("facts"))


def _near_facts(spark: SparkSession, folder: str) -> neardup.NearDuplicates:
    facts = read_table(spark, folder, "extracted_fact")
    text = F.concat(F.coalesce("metric", F.lit("")), F.lit(" "), F.col("evidence"))
    enough = F.regexp_count(F.lower("evidence"), F.lit("[a-z0-9]+")) >= 8
    return neardup.near_duplicates(facts, "fact_id", text, neardup.NearRule(words=3, similarity=0.5), enough)


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _near_facts(spark, folder).pairs()
    return pairs.select(F.col("id_a").alias("fact_id_a"), F.col("id_b").alias("fact_id_b")).distinct()


def p4_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _near_facts(spark, folder).classes().withColumnRenamed("id", "fact_id")


def p4_links(spark: SparkSession, folder: str) -> DataFrame:
    return _near_facts(spark, folder).named_links()


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leak.leaked_passages(read_table(spark, folder, "documents"), read_table(spark, folder, "eval_item"))
    return found.where("words >= 12").select("doc_id", "item_id")


def p6_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leak.leaked_passages(read_table(spark, folder, "documents"), read_table(spark, folder, "eval_item"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    _, report = mixing.mix_sources(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_target"))
    # A source too small for its share is drawn in full: every document max_repeats times.
    return report.where("short and reached = capacity and reached < wanted").select("source")


def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    sampled, _ = mixing.mix_sources(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_target"))
    return sampled


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    _, report = mixing.mix_sources(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_target"))
    return report


def p7_even(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the largest mixture in which every source has its share."""
    _, report = mixing.mix_sources(read_table(spark, folder, "documents"), read_table(spark, folder, "mix_target"), keep_shares=True)
    return report


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = skeleton.look_alike_pairs(read_table(spark, folder, "documents"))
    return pairs.select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


def p8_classes(spark: SparkSession, folder: str) -> DataFrame:
    return skeleton.look_alike_classes(read_table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


def p8_consistent(spark: SparkSession, folder: str) -> DataFrame:
    return skeleton.consistent_texts(read_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_pieces, p2_found, p2_survivors, p2_chunks, p3_found, p3_dictionary, p4_found, p4_classes, p4_links, p6_found, p6_leaks, p7_found, p7_mixture, p7_report, p7_even, p8_found, p8_classes, p8_consistent)}


def oracle_sql() -> dict[str, str]:
    return {}
