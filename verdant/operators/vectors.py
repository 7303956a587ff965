"""Exact nearest neighbours of a stated query set, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = 4096, digits: int = 5) -> DataFrame:
    """(query, neighbour, score, rank): the k rows of largest cosine similarity to each query, itself left out.

    The stated queries are taken in blocks of fixed size and each block is compared with all
    rows; a partition hands on its own best k, so the final ranking is small.
    """
    out = None
    found: list[tuple] = []

    def compare(part: list[tuple]):
        ids = np.array([p[0] for p in part])
        q = np.array([p[1] for p in part], dtype=np.float64)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own = batch["id"].to_numpy()
                x = np.array(batch["v"].tolist(), dtype=np.float64)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                s = np.round(q @ x.T, digits) + 0.0
                s[ids[:, None] == own[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(own, s.shape), -s), axis=1)[:, :k]
                flat = np.take_along_axis(s, order, axis=1).ravel()
                rows_ = pd.DataFrame({"query": np.repeat(ids, order.shape[1]), "neighbour": own[order].ravel(), "score": flat})
                yield rows_[np.isfinite(flat)]

        return rows.select(F.col(key).alias("id"), F.col(vector).alias("v")).where("v is not null").mapInPandas(run, "query long, neighbour long, score double")

    for row in queries.select(key, vector).where(F.col(vector).isNotNull()).toLocalIterator():
        found.append((row[0], row[1]))
        if len(found) == block:
            out, found = compare(found) if out is None else out.unionByName(compare(found)), []
    if found or out is None:
        last = compare(found) if found else rows.select(F.col(key).alias("query"), F.col(key).alias("neighbour"), F.lit(0.0).alias("score")).where(F.lit(False))
        out = last if out is None else out.unionByName(last)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "neighbour"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)
