"""Extra columns whose names the operators use themselves, and nulls in any column, change nothing."""

from pyspark.sql import functions as F

from tests.llm.test_operators import FACT, fact
from verdant.llm import canonical, golden, leak, mixing, neardup, skeleton, split


def clashing(df, *names):
    """df with columns of these names, of other types than the operators give them."""
    return df.withColumns({n: F.array(F.lit(1)) for n in names if n not in df.columns})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two three four", "a"), (2, "one two three four!", "A "), (3, None, None), (None, "x y", "b")], "doc_id long, text string, source string")
    odd = clashing(docs, "id", "look", "exact", "d", "changed", "words", "item_id", "n_tokens", "copies", "size", "part", "rank", "key", "size", "place", "slot", "id_hi", "id_lo", "block", "counts")
    assert rows_of(skeleton.look_alike_pairs(docs)) == rows_of(skeleton.look_alike_pairs(odd))
    assert rows_of(skeleton.consistent_texts(docs)) == rows_of(skeleton.consistent_texts(odd))
    items = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    rule = leak.LeakRule(min_words=4, edits=0, q=4)
    assert rows_of(leak.leaked_passages(docs, items, rule)) == rows_of(leak.leaked_passages(odd, clashing(items, "doc_id", "words"), rule))
    targets = spark.createDataFrame([("a", 0.5, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    for a, b in zip(mixing.mix_sources(docs, targets), mixing.mix_sources(odd, clashing(targets, "available", "wanted", "total"))):
        assert rows_of(a) == rows_of(b)
    near = neardup.NearRule(words=1, similarity=0.5)
    a, b = (neardup.near_duplicates(x, "doc_id", F.col("text"), near) for x in (docs, odd))
    assert rows_of(a.pairs()) == rows_of(b.pairs()) and rows_of(a.classes()) == rows_of(b.classes())
    long = docs.withColumn("text", F.repeat(F.col("text"), 400))
    assert rows_of(split.split_oversized(long, ["doc_id"], "text")) == rows_of(split.split_oversized(clashing(long, "piece_no", "start", "end", "content", "cut", "_cuts"), ["doc_id"], "text"))


def test_clashing_fact_columns(spark):
    rows = [fact("a"), fact("b", conf=None), fact(None), fact("c", doc=None), fact("d", unit=None, value=None, evidence=None), fact("e", chunk=None)]
    facts = spark.createDataFrame(rows, FACT)
    odd = clashing(facts, "members", "member_ids", "chunks", "group_key", "field", "norm", "vote", "rank", "evidence_fact_id", "duplicate_chunk_ids", "form", "name", "score", "canonical_id", "at", "n")
    assert rows_of(golden.merge_facts(facts)) == rows_of(golden.merge_facts(odd))
    registry = spark.createDataFrame([("w", "Water in", None), (None, "Lost", ["x"]), ("n", None, [None, " "])], "canonical_id string, display_name string, aliases array<string>")
    one = canonical.map_values(facts, ["fact_id"], "metric", registry)
    assert rows_of(one) == rows_of(canonical.map_values(odd, ["fact_id"], "metric", clashing(registry, "name", "rotations", "form", "gram")))
    assert {r.canonical_id for r in one.collect()} == {"w"}
