"""Problem 7: a mixture of sources with target shares of all tokens.

Method: systematic sampling.  Each document of a source has the same expected number of
copies; the expected copies are prefix-summed over the source's documents, one random
offset is added, and a document is emitted once for every integer boundary its interval
crosses.  Documents are ordered by size inside a source, so the tokens drawn follow the
share closely, and no document exceeds the cap.

The prefix sum is made in two levels (blocks of a source, then the documents of a block),
so no task ever sorts a whole source however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.session import cut_lineage

# The public WordPunct tokenizer, \w+|[^\w\s]+ with Unicode classes, in Java's dialect.
WORD_CLASS = r"\p{L}\p{N}_"
SPACE_CLASS = r"\s\x1c-\x1f\x85\p{Z}"
WORD_PUNCT = rf"[{WORD_CLASS}]+|[^{WORD_CLASS}{SPACE_CLASS}]+"


def token_count(text: Column) -> Column:
    """WordPunct tokens of the whole text; null text has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD_PUNCT)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Source names compare without case and outer spaces."""
    return F.lower(F.trim(source.cast("string")))


def sized_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, n_tokens) of every row; the text is read once and left behind."""
    return documents.select(F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("source"), token_count(F.col(text_col)).alias("n_tokens"))


def mixture_plan(sized: DataFrame, targets: DataFrame, keep_shares: bool = False) -> DataFrame:
    """One row per listed source: what it has, may give at most, should give, and its copies a document.

    `wanted` is target_share of the tokens of all rows used once; rows of null or unlisted
    sources count only there.  A source without documents has zero available tokens.
    With keep_shares the mixture is made smaller instead of letting short sources fall behind:
    each source gives its share of the largest total that all with any tokens can fill (the
    shares of those without stay empty).
    """
    wanted = targets.select(source_key(F.col("source")).alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("long"))
    wanted = wanted.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    held = sized.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("documents"))
    total = held.agg(F.coalesce(F.sum("available"), F.lit(0))).scalar()
    capacity = F.col("available") * F.col("max_repeats")
    plan = wanted.join(held, "source", "left").fillna(0, ["available", "documents"])
    if keep_shares:
        filled = plan.where("target_share > 0 and available > 0").agg(F.min(capacity / F.col("target_share"))).scalar()
        total = F.least(total.cast("double"), F.coalesce(filled, F.lit(0.0)))
    goal = F.col("target_share") * total
    return plan.withColumns({"capacity": capacity, "wanted": goal}).withColumn(
        "copies_each", F.when(F.col("available") > 0, F.least(F.col("wanted") / F.col("available"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    )


def sample_mixture(sized: DataFrame, plan: DataFrame, seed: int = 17, blocks: int = 256) -> DataFrame:
    """(doc_id, source, n_tokens, copies): documents drawn at least once.

    Empty documents are left out; a doc_id repeated in the input is drawn per row.  The
    plan has one row per source and is broadcast.
    """
    rate = plan.select("source", "copies_each")
    docs = sized.where("n_tokens > 0").join(F.broadcast(rate), "source")
    # Blocks in order of size (ten to a factor of two), split by hash so that none is a whole source.
    size = F.floor(F.log2(F.col("n_tokens").cast("double")) * 10).cast("int")
    docs = docs.withColumns({"size": size, "part": F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(blocks)).cast("int")})
    counts = docs.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("source", "size", "part").orderBy("n_tokens", F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id")
    ranked = docs.withColumn("rank", F.row_number().over(inside)).join(offsets, ["source", "size", "part"])
    start = F.pmod(F.xxhash64("source", F.lit(seed + 2)), F.lit(1 << 30)) / float(1 << 30)
    place = F.col("before") + F.col("rank")
    crossed = F.floor(place * F.col("copies_each") + start) - F.floor((place - 1) * F.col("copies_each") + start)
    return ranked.select("doc_id", "source", "n_tokens", crossed.alias("copies")).where("copies > 0")


def mixture_report(sampled: DataFrame, plan: DataFrame) -> DataFrame:
    """Per listed source: target and reached share, tokens reached, most copies of one document."""
    reached = sampled.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("reached"), F.max("copies").alias("most_copies"), F.count(F.lit(1)).alias("used_documents")
    )
    report = plan.join(reached, "source", "left").fillna(0, ["reached", "most_copies", "used_documents"])
    all_tokens = F.sum("reached").over(Window.partitionBy(F.lit(1)))  # one row per source
    share = F.when(all_tokens > 0, F.col("reached") / all_tokens).otherwise(0.0)
    short = F.col("capacity") < F.col("wanted")
    return report.withColumns({"reached_share": share, "short": short}).select(
        "source", "target_share", "max_repeats", "documents", "available", "capacity", "wanted", "copies_each", "used_documents", "most_copies", "reached", "reached_share", "short"
    )


def mix_sources(documents: DataFrame, targets: DataFrame, seed: int = 17, keep_shares: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sampled documents, report) of the mixture.

    Null texts and sources, extra columns, an empty table (a report of zero rows reached)
    and unlisted sources are all allowed; see mixture_plan and sample_mixture.
    """
    sized = cut_lineage(sized_documents(documents))  # texts are tokenised once
    plan = cut_lineage(mixture_plan(sized, targets, keep_shares))
    sampled = sample_mixture(sized, plan, seed)
    return sampled, mixture_report(sampled, plan)
