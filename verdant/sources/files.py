"""File readers and writers of the pipeline's hand-offs: JSON, JSON lines, CSV, parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("fact_id", "company_id", "doc_id", "section_id", "chunk_id", "decision", "metric", "value", "unit", "period", "period_type", "fact_type", "entity", "segment", "evidence", "metric_definition")]
    + [T.StructField("page_start", T.IntegerType()), T.StructField("page_end", T.IntegerType()), T.StructField("confidence", T.DoubleType()), T.StructField("duplicate_chunk_ids", T.ArrayType(T.StringType()))]
)


def read_fact_files(spark: SparkSession, path: str) -> DataFrame:
    """Facts of JSON files that hold either a list or {"facts": [...]}; entries that are no objects are dropped."""
    whole = spark.read.text(path, wholetext=True)
    texts = T.ArrayType(T.StringType())  # each entry as its own JSON text, so that one bad entry spoils no other
    listed = F.coalesce(F.from_json("value", T.StructType([T.StructField("facts", texts)]))["facts"], F.from_json("value", texts))
    return whole.select(F.explode(listed).alias("entry")).select(F.from_json("entry", FACT).alias("f")).where("f.fact_id is not null").select("f.*")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = FACT) -> DataFrame:
    """Checkpointed rows; malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no result yet."""
    return rows.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def definition_gate(facts: DataFrame, most_missing: float = 0.2) -> DataFrame:
    """One row: facts, without_definition, share, passes; an empty input does not pass."""
    blank = F.coalesce(F.trim("metric_definition"), F.lit("")) == ""
    counted = facts.agg(F.count(F.lit(1)).alias("facts"), F.count_if(blank).alias("without_definition"))
    share = F.when(F.col("facts") > 0, F.col("without_definition") / F.col("facts")).otherwise(1.0)
    return counted.withColumn("share", share).withColumn("passes", (F.col("facts") > 0) & (F.col("share") <= most_missing))


def merge_batches(batches: DataFrame, batch: str, items: str) -> DataFrame:
    """(batch, offset): where the items of each page batch begin in the joined document."""
    from pyspark.sql import Window

    sizes = batches.groupBy(batch).agg(F.sum(F.coalesce(F.size(items), F.lit(0))).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1))  # one row a batch of pages
    return sizes.select(batch, F.coalesce(before, F.lit(0)).alias("offset"), F.col("_n").alias("items"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_json_lines(df: DataFrame, path: str, partition: str) -> None:
    """Append rows under a folder for each partition value."""
    df.write.mode("append").partitionBy(partition).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays and structs are written as JSON text."""
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name) for f in df.schema.fields]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


METRIC = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("canonical_id", "display_name", "category", "unit_family", "unit", "fact_type", "notes")]
    + [T.StructField("aliases", T.ArrayType(T.StringType())), T.StructField("valid_period_types", T.ArrayType(T.StringType()))]
)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry or override entries of JSON files: a list, or {"metrics": [...]}; entries without canonical_id are dropped."""
    whole = spark.read.text(path, wholetext=True)
    texts = T.ArrayType(T.StringType())
    listed = F.coalesce(F.from_json("value", T.StructType([T.StructField("metrics", texts)]))["metrics"], F.from_json("value", texts))
    return whole.select(F.explode(listed).alias("entry")).select(F.from_json("entry", METRIC).alias("m")).where("m.canonical_id is not null").select("m.*")


def write_review(df: DataFrame, folder: str) -> None:
    """A review list as CSV (folder/csv) and as rows of a Markdown table (folder/markdown), bars in the texts escaped."""
    write_csv(df, f"{folder}/csv")
    cells = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in df.columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    head = df.sparkSession.createDataFrame([("| " + " | ".join(df.columns) + " |",), ("|" + "---|" * len(df.columns),)], "value string")
    head.coalesce(1).write.mode("overwrite").text(f"{folder}/markdown")
    df.select(F.regexp_replace(line, r"[\r\n]+", " ").alias("value")).write.mode("append").text(f"{folder}/markdown")


def shifted_references(text: Column, collection: str, offset: Column) -> Column:
    """References #/collection/n in a text with n raised by an offset, as joined batches need it."""
    parts = F.split(F.coalesce(text, F.lit("")), rf"(?<=#/{collection}/)(?=\d)|(?<=#/{collection}/\d{{1,18}})(?!\d)")
    moved = F.transform(parts, lambda p, i: F.when((i > 0) & p.rlike(r"^\d+$") & F.element_at(parts, F.greatest(i, F.lit(1))).endswith(f"#/{collection}/"), (p.cast("long") + offset).cast("string")).otherwise(p))
    return F.array_join(moved, "")
