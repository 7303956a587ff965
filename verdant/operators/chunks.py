"""Cutting pages into chunks, linking them, and reading tables out of them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions.text import token_estimate, word_windows


def build_chunks(pages: DataFrame, doc: str, page: str, text: str, most: int = 520, overlap: int = 70) -> DataFrame:
    """(doc, page, part, chunk_id, content, token_estimate): word windows of each page.

    chunk_id is {doc}_p{page:03d}_{part}; pages without words give no chunk.
    """
    parts = pages.select(F.col(doc).cast("string").alias("doc"), F.col(page).cast("int").alias("page"), F.posexplode(word_windows(F.col(text), most, overlap)).alias("at", "content"))
    number = F.lpad(F.col("page").cast("string"), 3, "0")
    number = F.when(F.col("page") > 999, F.col("page").cast("string")).otherwise(number)
    name = F.concat("doc", F.lit("_p"), number, F.lit("_"), (F.col("at") + 1).cast("string"))
    return parts.select("doc", "page", (F.col("at") + 1).alias("part"), name.alias("chunk_id"), "content", token_estimate(F.col("content")).alias("token_estimate"))


def link_chunks(chunks: DataFrame, doc: str, order: list[str]) -> DataFrame:
    """prev_chunk_id and next_chunk_id along each document, in numeric order of page and part."""
    w = Window.partitionBy(doc).orderBy(*order)
    return chunks.withColumns({"prev_chunk_id": F.lag("chunk_id").over(w), "next_chunk_id": F.lead("chunk_id").over(w)})


def with_context(chunks: DataFrame, separator: str = "\n---\n") -> DataFrame:
    """chunk_id and `context`: the contents of the previous chunk, itself and the next; a missing neighbour is left out."""
    body = chunks.select("chunk_id", "content")
    before = body.withColumnsRenamed({"chunk_id": "prev_chunk_id", "content": "before"})
    after = body.withColumnsRenamed({"chunk_id": "next_chunk_id", "content": "after"})
    joined = chunks.select("chunk_id", "prev_chunk_id", "next_chunk_id", "content").join(before, "prev_chunk_id", "left").join(after, "next_chunk_id", "left")
    return joined.select("chunk_id", F.concat_ws(separator, "before", "content", "after").alias("context"))


def unpivot_tables(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys + (row_no, metric, column_name, value): one row per filled body cell of every pipe table in the text.

    A row of dashes makes the row above it the header; blank and "-" cells are skipped; cells
    beyond the header are left out.
    """
    lines = df.select(*keys, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("row_no", "line")).where(F.trim("line").startswith("|"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = lines.select(*keys, "row_no", cells.alias("cells")).withColumn("rule", F.forall("cells", lambda c: c.rlike(r"^:?-{2,}:?$")))
    run = F.col("row_no") - F.row_number().over(Window.partitionBy(*keys).orderBy("row_no"))
    rows = rows.withColumn("table_no", run)  # a table ends at the first line that is none of its rows
    w = Window.partitionBy(*keys, "table_no").orderBy("row_no")
    above = F.lag("cells").over(w)
    rows = rows.withColumns({"head": F.when(F.col("rule"), above), "is_head": F.coalesce(F.lead("rule").over(w), F.lit(False))})
    rows = rows.withColumn("header", F.last("head", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    body = rows.where(~F.col("rule") & ~F.col("is_head") & F.col("header").isNotNull())
    long = body.select(*keys, "row_no", F.col("cells")[0].alias("metric"), "header", F.posexplode("cells").alias("at", "value"))
    long = long.where((F.col("at") > 0) & (F.col("at") < F.size("header")) & ~F.col("value").isin("", "-"))
    return long.select(*keys, "row_no", "metric", F.col("header")[F.col("at")].alias("column_name"), "value")


def pack_sentences(sentences: list[str], most: int = 180, overlap: int = 40) -> list[str]:
    """Greedy packing of sentences into parts of at most `most` words, each repeating whole sentences of at least `overlap` words.

    A sentence over the limit is a part of its own; a last part that repeats the one before is dropped.
    """
    parts: list[list[str]] = []
    now: list[str] = []
    size = 0
    for sentence in sentences:
        n = len(sentence.split())
        if now and size + n > most:
            parts.append(now)
            tail: list[str] = []
            words = 0
            for s in reversed(now):
                if words >= overlap:
                    break
                tail.insert(0, s)
                words += len(s.split())
            now, size = (tail, words) if words + n <= most else ([], 0)
        now = [*now, sentence]
        size += n
    if now and (not parts or now != parts[-1]):
        parts.append(now)
    return [" ".join(p) for p in parts]


def sentence_chunks(df: DataFrame, key: str, text: str, most: int = 180, overlap: int = 40) -> DataFrame:
    """(key, part, content): texts packed sentence by sentence; a fold over an unbounded list, hence Python."""
    split = F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"(?<=[.!?])\s+")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i + 1, part) for k, s in zip(batch["key"], batch["s"]) for i, part in enumerate(pack_sentences([x for x in s if x], most, overlap))]
            yield pd.DataFrame(rows, columns=["key", "part", "content"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), split.alias("s")).mapInPandas(run, f"key {kind}, part int, content string").withColumnRenamed("key", key)


def running_label(df: DataFrame, group: str, order: list[str], label: Column, name: str) -> DataFrame:
    """The last non-null label so far, in order, inside each group."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(label, ignorenulls=True).over(w))


def keep_with_neighbours(df: DataFrame, group: str, order: list[str], flag: Column, reach: int = 1) -> DataFrame:
    """Rows for which the flag holds, and `reach` rows on each side of them."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(-reach, reach)
    return df.withColumn("_near", F.max(F.coalesce(flag, F.lit(False)).cast("int")).over(w)).where("_near = 1").drop("_near")


def grid_to_text(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys + content: pipe tables of cells (row, row_end, col, col_end, text); a cell fills every place it spans, the later writer wins.

    The first row is the header; a pipe inside a cell is escaped; places no cell fills are blank.
    """
    filled = cells.select(*keys, "text", F.struct("row", "col").alias("_order"), F.explode(F.sequence("row", "row_end")).alias("r"), "col", "col_end")
    filled = filled.select(*keys, "text", "_order", "r", F.explode(F.sequence("col", "col_end")).alias("c"))
    places = filled.groupBy(*keys, "r", "c").agg(F.max_by("text", "_order").alias("text"))
    width = cells.groupBy(*keys).agg(F.max("col_end").alias("_w"))
    escaped = F.regexp_replace(F.coalesce("text", F.lit("")), r"\|", r"\\|")
    rows = places.groupBy(*keys, "r").agg(F.map_from_entries(F.collect_list(F.struct("c", escaped.alias("t")))).alias("m")).join(width, keys)
    line = F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), F.col("_w")), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(""))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.col("_w") + 1))
    lines = rows.select(*keys, "r", line.alias("line"), rule.alias("rule"))
    ordered = lines.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("r", "line"))).alias("o"), F.first("rule").alias("rule"))
    body = F.transform("o", lambda x: x["line"])
    return ordered.select(*keys, F.array_join(F.concat(F.slice(body, 1, 1), F.array("rule"), F.slice(body, F.lit(2), F.size("o"))), "\n").alias("content"))
