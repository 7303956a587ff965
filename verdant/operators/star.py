"""The star schema of observations: deliveries folded, dimensions joined, rows upserted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdant.functions.period import period_key
from verdant.sources import read_table

LOADED = ("normalized", "partial", "new_metric")


def once(df: DataFrame, key: str | list[str], arrival: str, where: Column | str | None = None) -> DataFrame:
    """Rows delivered again fold into one; they differ only in the arrival time, which is dropped.

    As the other columns are equal, `where` on them is applied first: it then reaches the scan,
    and only the rows that pass it are shuffled.
    """
    if where is not None:
        df = df.where(where)
    return df.drop(arrival).dropDuplicates([key] if isinstance(key, str) else key)


def observations(spark: SparkSession, folder: str, where: Column | str | None = None) -> DataFrame:
    return once(read_table(spark, folder, "observation"), "obs_id", "loaded_at", where)


def report_documents(spark: SparkSession, folder: str, where: Column | str | None = None) -> DataFrame:
    return once(read_table(spark, folder, "report_document"), "doc_id", "ingested_at", where)


def facts(spark: SparkSession, folder: str, where: Column | str | None = None) -> DataFrame:
    return once(read_table(spark, folder, "extracted_fact"), "fact_id", "ingested_at", where)


def loaded(spark: SparkSession, folder: str, where: Column | str | None = None) -> DataFrame:
    """Loaded observations with a finite value, and `period`, the year they report on.

    `where` may use the columns of the table; put a condition on `period` behind.
    Observations whose document is unknown keep a period only if their label states one.
    """
    kept = F.col("normalization_status").isin(*LOADED) & F.col("normalised_value").isNotNull() & ~F.isnan("normalised_value")
    if where is not None:
        kept = kept & (F.expr(where) if isinstance(where, str) else where)
    obs = observations(spark, folder, kept)
    docs = report_documents(spark, folder).select(F.col("doc_id").alias("source_doc_id"), F.col("fiscal_year").alias("document_period"))
    return obs.join(docs, "source_doc_id", "left").withColumn("period", period_key(F.col("period_label"), F.col("document_period")))


def argmax_rows(df: DataFrame, keys: list[str], value: str, tie: str) -> DataFrame:
    """The row with the largest value of each key; ties go to the smallest `tie`.

    An aggregation with map-side combination, not a sort of every group: a hot key is
    reduced where it lies.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.col(value)).alias("_most"))
    top = df.join(best, keys).where(F.col(value) == F.col("_most"))
    picked = top.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(tie)).alias("_row"))
    return picked.select(*keys, "_row.*")


def upsert_latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Last write wins: the row of each key that is largest in `order`."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(key, "_row.*")


def merge_into(existing: DataFrame, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Existing rows whose key does not arrive again, and the latest of the incoming rows."""
    latest = upsert_latest(incoming, key, order)
    return existing.join(latest.select(key), key, "left_anti").unionByName(latest)


def edges(left: DataFrame, right: DataFrame, left_key: str, right_key: str, ends: list[str]) -> DataFrame:
    """Distinct edges whose two ends exist; a missing end gives no edge."""
    return left.join(right, left[left_key] == right[right_key]).select(*ends).distinct()


def numbered_first_seen(df: DataFrame, group: str, name: str, order: str, label: Column) -> DataFrame:
    """(group, name, number, id): names numbered per group in the order they are first seen."""
    first = df.groupBy(group, name).agg(F.min(order).alias("_first"))
    number = F.row_number().over(Window.partitionBy(group).orderBy("_first", name))
    return first.withColumn("number", number).select(group, name, "number", label.alias("id"))
