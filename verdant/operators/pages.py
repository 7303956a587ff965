"""Choosing the pages of a report: contents entries, headings, scores, density."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.functions.facts import heading_key, toc_pairs
from verdant.operators import intervals


def contents_entries(pages: DataFrame, doc: str, page: str, text: str, first_pages: int = 15, least: int = 5) -> DataFrame:
    """(doc, title, listed): lines of contents pages, those among the first pages with at least `least` such lines."""
    found = pages.where(F.col(page) <= first_pages).select(doc, toc_pairs(F.col(text)).alias("_p")).where(F.size("_p") >= least)
    long = found.select(doc, F.inline("_p")).withColumnsRenamed({"title": "title", "page": "listed"})
    return long.groupBy(doc, heading_key(F.col("title")).alias("_key"), "listed").agg(F.min("title").alias("title")).select(doc, "title", "listed")


def heading_offset(entries: DataFrame, pages: DataFrame, doc: str, page: str, text: str, reach: int = 40) -> DataFrame:
    """(doc, offset): upper median of how far the headings stand from their listed pages.

    A heading is looked for in the first 2,500 characters of pages within `reach` of the
    listed one; documents without a hit get no row.
    """
    near = entries.select(doc, "title", "listed", F.explode(F.sequence(F.greatest(F.col("listed") - reach, F.lit(1)), F.col("listed") + reach)).alias(page))
    heads = pages.select(doc, page, heading_key(F.substring(text, 1, 2500)).alias("_head"))
    hits = near.join(heads, [doc, page]).where(F.contains("_head", heading_key(F.col("title"))))
    closest = hits.withColumn("_d", F.col(page) - F.col("listed")).groupBy(doc, "title", "listed").agg(F.min_by("_d", F.struct(F.abs("_d"), "_d")).alias("d"))
    w = Window.partitionBy(doc)
    ranked = closest.withColumns({"_n": F.row_number().over(w.orderBy("d", "title", "listed")), "_m": F.count(F.lit(1)).over(w)})  # one row a heading
    return ranked.where(F.col("_n") == F.floor(F.col("_m") / 2) + 1).select(doc, F.col("d").alias("offset"))


def pages_of_entries(entries: DataFrame, doc: str, title: str, start: str, last: str, pattern: str) -> DataFrame:
    """(doc, page): pages of the entries whose title matches, each to the page before the next entry."""
    ranges = intervals.ranges_to_next(entries, doc, start, last)
    wanted = entries.where(F.lower(F.coalesce(title, F.lit(""))).rlike(pattern)).select(doc, start).distinct()
    ranged = ranges.join(wanted, [doc, start]).where(F.col("end") >= F.col(start))
    return ranged.select(doc, F.explode(F.sequence(F.col(start), F.col("end"))).alias("page")).distinct()


def expand_sparse(pages: DataFrame, selected: DataFrame, doc: str, page: str, score: str, numbers: str, least: int = 50, extra: int = 5) -> DataFrame:
    """Selected pages, and the `extra` best others of documents whose selection holds under `least` numeric tokens."""
    chosen = selected.select(doc, page).distinct()
    dense = pages.join(chosen, [doc, page]).groupBy(doc).agg(F.sum(numbers).alias("_n"))
    sparse = pages.select(doc).distinct().join(dense, doc, "left").where(F.coalesce("_n", F.lit(0)) < least).select(doc)
    rest = pages.join(sparse, doc, "left_semi").join(chosen, [doc, page], "left_anti")
    best = rest.withColumn("_r", F.row_number().over(Window.partitionBy(doc).orderBy(F.desc(score), page))).where(F.col("_r") <= extra)
    return chosen.unionByName(best.select(doc, page)).distinct()


def sticky(rows: DataFrame, group: str, order: list[str], flag: Column, name: str) -> DataFrame:
    """A flag that stays set in its group once it was seen."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.max(F.coalesce(flag, F.lit(False))).over(w))


def split_table_rows(rows: DataFrame, keys: list[str], header: str, body: str, most_rows: int = 20) -> DataFrame:
    """keys + (part, content): a table's rows in parts of at most `most_rows`, the header repeated in each.

    header and body are arrays of lines; a table within the limit is one part.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(body) - 1, F.lit(0)), F.lit(most_rows))
    parts = F.transform(starts, lambda s: F.array_join(F.concat(F.col(header), F.slice(F.col(body), s + 1, F.lit(most_rows))), "\n"))
    return rows.select(*keys, F.posexplode(parts).alias("at", "content")).select(*keys, (F.col("at") + 1).alias("part"), "content")


def contained_rows(rows: DataFrame, keys: list[str], key: str, text: str) -> DataFrame:
    """(kept, dropped): rows whose text is part of a longer text with the same keys.

    The smallest of the longest texts that hold it is kept; equal texts are no containment.
    """
    a, b = rows.alias("a"), rows.alias("b")
    same = F.col(f"a.{keys[0]}") == F.col(f"b.{keys[0]}")
    for k in keys[1:]:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    inside = same & (F.length(f"a.{text}") < F.length(f"b.{text}")) & F.contains(F.col(f"b.{text}"), F.col(f"a.{text}")) & (F.length(f"a.{text}") > 0)
    hits = a.join(b, inside).select(F.col(f"a.{key}").alias("dropped"), F.col(f"b.{key}").alias("kept"), F.length(f"b.{text}").alias("n"))
    return hits.groupBy("dropped").agg(F.min_by("kept", F.struct(-F.col("n"), "kept")).alias("kept")).select("kept", "dropped")


def anchored(rows: DataFrame, keys: list[str], specific: Column, score: str, key: str) -> DataFrame:
    """One row per anchor key: a specific row before a generic one, then the larger score, then the smaller key."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.withColumn("_s", specific.cast("int")).groupBy(*keys).agg(F.max(F.struct("_s", score)).alias("_b"))
    top = rows.withColumn("_s", specific.cast("int")).join(best, keys).where((F.col("_s") == F.col("_b._s")) & F.col(score).eqNullSafe(F.col(f"_b.{score}")))
    return top.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(key)).alias("_r")).select(*keys, "_r.*")


def longest_alias(rows: DataFrame, key: str, text: Column, aliases: DataFrame, first: str = "first_word") -> DataFrame:
    """(key, member, alias): the longest alias that the text holds as whole words, ties by alias; rows meet aliases on a shared word.

    aliases: member, alias (in the form of heading_key).
    """
    long = rows.select(F.col(key), heading_key(text).alias("_t")).withColumn(first, F.explode(F.array_distinct(F.split("_t", " "))))
    listed = aliases.select("member", "alias", F.split("alias", " ")[0].alias(first)).where("alias <> ''")
    padded = F.concat(F.lit(" "), F.col("_t"), F.lit(" "))
    hits = long.join(listed, first).where(F.contains(padded, F.concat(F.lit(" "), F.col("alias"), F.lit(" "))))
    best = hits.groupBy(key).agg(F.min(F.struct(-F.length("alias"), "alias", "member")).alias("b"))
    return best.select(key, F.col("b.member").alias("member"), F.col("b.alias").alias("alias"))
