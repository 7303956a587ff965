"""Pairs of similar names across companies, their components, and leader clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.session import cut_lineage


def blocked_pairs(names: DataFrame, key: str, owner: str, block: str, tokens: str, least: float) -> DataFrame:
    """(a, b, jaccard), a < b: names of different owners in one block whose token sets have the Jaccard similarity.

    Rows meet only on a shared (block, token); of the tokens of a name, rarest first, only as
    many are posted as may all be missed, so frequent tokens build no pairs.
    """
    rows = names.select(F.col(key).alias("id"), F.col(owner).alias("owner"), F.col(block).alias("block"), F.array_distinct(tokens).alias("t")).where(F.size("t") > 0)
    long = rows.select("id", "block", F.explode("t").alias("w"))
    df = long.groupBy("block", "w").agg(F.count(F.lit(1)).alias("n"))
    ranked = long.join(df, ["block", "w"]).groupBy("id", "block").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("o"))
    size = F.size("o")
    kept = F.slice("o", F.lit(1), size - F.ceil(F.lit(least) * size - F.lit(1e-9)).cast("int") + 1)
    posted = ranked.select("id", "block", F.explode(kept).alias("p")).select("id", "block", F.col("p.w").alias("w"))
    a, b = posted.alias("a"), posted.alias("b")
    met = a.join(b, (F.col("a.block") == F.col("b.block")) & (F.col("a.w") == F.col("b.w")) & (F.col("a.id") < F.col("b.id")))
    met = met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    left = rows.select(F.col("id").alias("a"), F.col("owner").alias("ao"), F.col("t").alias("at"))
    right = rows.select(F.col("id").alias("b"), F.col("owner").alias("bo"), F.col("t").alias("bt"))
    both = met.join(left, "a").join(right, "b").where("ao <> bo")
    shared = F.size(F.array_intersect("at", "bt"))
    jaccard = shared / (F.size("at") + F.size("bt") - shared)
    return both.select("a", "b", jaccard.alias("jaccard")).where(F.col("jaccard") >= least - 1e-12)


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): component is the smallest id reachable over the edges (columns a, b).

    Every round each node takes the smallest label among its neighbours and then that
    label's own label, which halves long chains; the labels are written to the shared
    checkpoint folder, and only the number of changes comes to the driver.
    """
    both = cut_lineage(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(nodes.select(F.col("id"), F.col("id").alias("component")).distinct())
    while True:  # labels only fall, so it ends; the rounds grow with the logarithm of the longest chain
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        stepped = labels.join(near, "id", "left").select("id", F.least("component", "m").alias("component"), F.col("component").alias("before"))
        jumped = stepped.join(stepped.select(F.col("id").alias("component"), F.col("component").alias("further")), "component", "left")
        after = cut_lineage(jumped.select("id", F.least("component", "further").alias("component"), "before"))
        changed = after.where(F.col("component") != F.col("before")).limit(1).count()
        labels = after.select("id", "component")
        if not changed:
            return labels


def leader_clusters(names: list[tuple[str, str]], least: float) -> list[tuple[str, str, str]]:
    """(name, leader, owner) of a greedy pass in input order: a name joins the first leader it is at least `least` similar to.

    Order-dependent by definition, so it runs over one bounded list.
    """
    from verdant.functions.similarity import sequence_ratio

    leaders: list[str] = []
    out = []
    for name, owner in names:
        leader = next((x for x in leaders if sequence_ratio(name, x) >= least), None)
        if leader is None:
            leaders.append(name)
            leader = name
        out.append((name, leader, owner))
    return out
