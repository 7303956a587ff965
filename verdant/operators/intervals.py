"""Sets of page numbers: ranges, gaps and buffers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranges_to_next(starts: DataFrame, group: str, start: str, last: str) -> DataFrame:
    """(group, start, end): from each distinct start to the page before the next one, the last to `last`."""
    distinct = starts.groupBy(group, start).agg(F.max(last).alias("_last"))
    w = Window.partitionBy(group).orderBy(start)
    whole = F.max("_last").over(Window.partitionBy(group))
    end = F.coalesce(F.lead(start).over(w) - 1, F.greatest(whole, F.col(start)))
    return distinct.select(group, start, end.alias("end"))


def fill_gaps(selected: DataFrame, group: str, page: str, most: int = 5) -> DataFrame:
    """Selected pages and those between two that lie at most `most` apart."""
    pages = selected.select(group, page).distinct()
    following = F.lead(page).over(Window.partitionBy(group).orderBy(page))
    end = F.when(following - F.col(page) <= most, following - 1).otherwise(F.col(page))
    return pages.withColumn("_end", end).select(group, F.explode(F.sequence(F.col(page), F.col("_end"))).alias(page))


def buffer_pages(selected: DataFrame, group: str, page: str, reach: int = 2, first: int = 1, last: str | None = None) -> DataFrame:
    """Selected pages and `reach` on each side, not before `first` nor after the group's `last` column."""
    around = F.sequence(F.greatest(F.col(page) - reach, F.lit(first)), F.least(F.col(page) + reach, F.col(last)) if last else F.col(page) + reach)
    return selected.select(group, F.explode(around).alias(page)).distinct()


def islands(selected: DataFrame, group: str, page: str) -> DataFrame:
    """(group, first, last): runs of consecutive pages."""
    pages = selected.select(group, page).distinct()
    run = F.col(page) - F.row_number().over(Window.partitionBy(group).orderBy(page))
    return pages.withColumn("_run", run).groupBy(group, "_run").agg(F.min(page).alias("first"), F.max(page).alias("last")).drop("_run")


def select_by_score(pages: DataFrame, group: str, page: str, score: str, least: int, backfill: int) -> DataFrame:
    """Pages whose score reaches `least`, and the group's `backfill` best ones, ties by page."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), page))
    return pages.withColumn("_rank", rank).where((F.col(score) >= least) | (F.col("_rank") <= backfill)).drop("_rank")
