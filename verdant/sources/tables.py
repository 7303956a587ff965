"""Named parquet tables under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdant.session import ship_package

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings company report_document "
    "report_section report_chunk extracted_fact observation consumer_master_registry_v1 unit_conversion eval_item mix_target"
).split()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table `name` of `folder`; only the columns used later are scanned."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; known: {', '.join(TABLES)}")
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
