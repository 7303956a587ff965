"""Problem 3: free wordings mapped to the entries of a reference list.

Method: prefix-filter set-similarity join.  A wording is written in a normal form (see
wording.py) and becomes the set of its cyclic character trigrams, which a changed word
order hardly alters.  Trigrams are ordered by their rarity over all wordings and names;
two sets with Jaccard similarity t or more share a trigram among the first
n - ceil(t n) + 1 of each, so only these prefixes are joined.  Length and positional
filters follow, the similarity is verified exactly, and the best entry is kept.

Work is done on distinct wordings; the dictionary they make is then joined to all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.udf import once
from verdant.llm.wording import by_frequency, metric_form, name_forms, vocabulary_of
from verdant.session import cut_lineage

UNMATCHED = "unmatched"
VOCABULARY_WORDS = 1_000_000


@dataclass(frozen=True)
class MatchRule:
    """join: least trigram Jaccard of a candidate; sure: score that needs no further check;
    edit: most edits for each letter of the name, over its rotations by words, below that score."""

    join: float = 0.25
    sure: float = 0.5
    edit: float = 0.34

    def __post_init__(self) -> None:
        if not 0 < self.join <= self.sure <= 1 or not 0 <= self.edit < 1:
            raise ValueError("0 < join <= sure <= 1 and 0 <= edit < 1 are needed")


@lru_cache(maxsize=1 << 14)
def _cyclic(text: str, q: int) -> frozenset[str]:
    wrapped = text + text[: q - 1]
    return frozenset(wrapped[i : i + q] for i in range(len(text)))


def _edits(a: str, b: str, most: float) -> float:
    """Levenshtein distance, with a swap of neighbours as one edit; more than `most` once it exceeds that."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most and min(prev) > most:
            return most + 1
        before, prev = prev, row
    return prev[-1]


def score(form: str, name: str, rule: MatchRule) -> float:
    """Mean of the Jaccard similarities of cyclic bigrams and trigrams; -1 if that of trigrams is under rule.join."""
    x, y = _cyclic(form, 3), _cyclic(name, 3)
    tri = len(x & y) / len(x | y)
    if tri < rule.join:
        return -1.0
    x, y = _cyclic(form, 2), _cyclic(name, 2)
    return (tri + len(x & y) / len(x | y)) / 2


def near_edits(form: str, name: str, rotations: list[str], rule: MatchRule) -> bool:
    """Whether few enough edits make the form of the name or of one of its rotations by words."""
    most = rule.edit * len(name)
    return any(_edits(form, r, most) <= most for r in rotations)


def verify(form: str, name: str, rotations: list[str], rule: MatchRule) -> float:
    """The score of a pair; -1 if it is no match."""
    got = score(form, name, rule)
    return got if got < 0 or got >= rule.sure or near_edits(form, name, rotations, rule) else -1.0


def _edits_udf(rule: MatchRule):
    @F.pandas_udf(T.BooleanType())
    def run(forms: pd.Series, names: pd.Series, rotations: pd.Series) -> pd.Series:
        return pd.Series([near_edits(f, n, list(r), rule) for f, n, r in zip(forms, names, rotations)], dtype="bool")

    return once(run)


def _score_udf(rule: MatchRule):
    @F.pandas_udf(T.DoubleType())
    def run(forms: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([score(f, n, rule) for f, n in zip(forms, names)], dtype="float64")

    return once(run)


def _form_udf(vocabulary: tuple[str, ...]):
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: metric_form(t, vocabulary), na_action="ignore")

    return run


def reference_vocabulary(reference: DataFrame, name_cols: list[str], alias_col: str | None) -> tuple[str, ...]:
    """The words of the reference list's names, from which abbreviations are written out.

    They are the words of one list of names, not of the rows; VOCABULARY_WORDS bounds them,
    and a list of more is refused rather than cut.
    """
    names = F.array(*(F.col(c).cast("string") for c in name_cols))
    if alias_col:
        names = F.concat(names, F.coalesce(F.col(alias_col).cast("array<string>"), F.array().cast("array<string>")))
    words: Counter[str] = Counter()
    for row in reference.select(F.explode(names).alias("name")).where("name is not null").distinct().toLocalIterator():
        words += vocabulary_of([row["name"]])
        if len(words) > VOCABULARY_WORDS:
            raise ValueError(f"the reference list has more than {VOCABULARY_WORDS} different words")
    return by_frequency(words)


def reference_forms(reference: DataFrame, id_col: str, name_cols: list[str], alias_col: str | None, vocabulary: tuple[str, ...] = ()) -> DataFrame:
    """(canonical_id, name, rotations) for every normal form of every name; ids repeated in the list are merged."""
    names = F.array(*(F.col(c).cast("string") for c in name_cols))
    if alias_col:
        names = F.concat(names, F.coalesce(F.col(alias_col).cast("array<string>"), F.array().cast("array<string>")))
    plain = reference.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("canonical_id"), F.explode(names).alias("name"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(c, form, turns) for c, n in zip(batch["canonical_id"], batch["name"]) for form, turns in name_forms(n, vocabulary).items() if form]
            yield pd.DataFrame(rows, columns=["canonical_id", "name", "rotations"])

    forms = plain.where("name is not null and trim(name) <> ''").mapInPandas(run, "canonical_id string, name string, rotations array<string>")
    return forms.groupBy("name").agg(F.min("canonical_id").alias("canonical_id"), F.first("rotations").alias("rotations"))


def _grams(form: Column) -> Column:
    wrapped = F.concat(form, F.substring(form, 1, 2))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.substring(wrapped, i, F.lit(3))))


def _prefixes(sets: DataFrame, counts: DataFrame, key: str, join: float) -> DataFrame:
    """(key, n, at, gram): the rare prefix of each set, rarest first."""
    long = sets.select(key, F.explode("grams").alias("gram")).join(counts, "gram")
    ordered = long.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("count", "gram"))).alias("o"))
    n = F.size("o")
    kept = F.slice("o", F.lit(1), n - F.ceil(F.lit(join) * n).cast("int") + 1)
    return ordered.select(key, n.alias("n"), F.posexplode(kept).alias("at", "g")).select(key, "n", "at", "g.gram")


def match_forms(forms: DataFrame, reference: DataFrame, rule: MatchRule = MatchRule()) -> DataFrame:
    """(form, canonical_id, name, score) of the best entry of each distinct form that matches one.

    Equal scores go to the entry with the smaller name and id.
    """
    left = forms.select("form", _grams(F.col("form")).alias("grams"))
    right = reference.select("name", _grams(F.col("name")).alias("grams"))
    counts = left.select(F.explode("grams").alias("gram")).unionAll(right.select(F.explode("grams").alias("gram"))).groupBy("gram").count()
    counts = cut_lineage(counts)
    a = _prefixes(left, counts, "form", rule.join)
    b = _prefixes(right, counts, "name", rule.join).withColumnsRenamed({"n": "m", "at": "bt"})
    t = rule.join
    near = a.join(b, "gram").where((F.col("m") >= t * F.col("n")) & (F.col("n") >= t * F.col("m")))
    # The first common trigram is the least position on both sides: what may still follow it bounds the overlap.
    firsts = F.first("n").alias("n"), F.first("m").alias("m"), F.min("at").alias("at"), F.min("bt").alias("bt"), F.count(F.lit(1)).alias("shared")
    pairs = near.groupBy("form", "name").agg(*firsts)
    n, m = F.col("n"), F.col("m")
    least = F.ceil(F.lit(t / (1 + t)) * (n + m) - 1e-9)
    # Of the prefixes a pair shares what it must share in all, less what is left out of either.
    spare = least - F.greatest(F.ceil(t * n), F.ceil(t * m)) + 1
    pairs = pairs.where((F.least(n - F.col("at"), m - F.col("bt")) >= least) & (F.col("shared") >= spare)).select("form", "name")
    scored = cut_lineage(pairs.withColumn("score", _score_udf(rule)("form", "name")).where("score >= 0"))
    # Edits are counted only where they can decide: below `sure`, for forms that no name is sure for.
    sure = scored.where(F.col("score") >= rule.sure).join(reference.select("name", "canonical_id"), "name")
    open_ = scored.join(sure.select("form").distinct(), "form", "left_anti").join(reference, "name")
    close = open_.where(_edits_udf(rule)("form", "name", "rotations")).select(*sure.columns)
    scored = sure.unionByName(close)
    best = scored.groupBy("form").agg(F.max("score").alias("best"), F.min_by(F.struct("name", "canonical_id"), F.struct(-F.col("score"), "name", "canonical_id")).alias("w"))
    return best.select("form", "w.canonical_id", "w.name", F.col("best").alias("score"))


def map_values(
    rows: DataFrame, key_cols: list[str], value_col: str, reference: DataFrame, id_col: str = "canonical_id",
    name_cols: tuple[str, ...] = ("display_name", "canonical_id"), alias_col: str | None = "aliases", rule: MatchRule = MatchRule(),
) -> DataFrame:
    """key_cols + (value, canonical_id, matched_name, score): every row with a value, once a key and value.

    canonical_id is `unmatched` where no entry is near enough.  Null and blank values are
    left out; an empty reference list leaves all unmatched; other columns are not read.
    """
    kept = rows.select(*key_cols, F.col(value_col).cast("string").alias("_value")).where(F.length(F.trim("_value")) > 0).distinct()
    context = rows.sparkSession
    parts = max(context.sparkContext.defaultParallelism, int(context.conf.get("spark.sql.shuffle.partitions")))
    words = kept.select("_value").repartition(parts, "_value").distinct()  # a fixed number: the rows are small, the work on each is not
    vocabulary = reference_vocabulary(reference, list(name_cols), alias_col)
    words = cut_lineage(words.withColumn("form", _form_udf(vocabulary)("_value")))
    names = cut_lineage(reference_forms(reference, id_col, list(name_cols), alias_col, vocabulary))
    found = match_forms(words.select("form").distinct(), names, rule)
    dictionary = words.join(found, "form", "left")
    return kept.join(dictionary, "_value", "left").select(
        *key_cols, F.col("_value").alias("value"), F.coalesce("canonical_id", F.lit(UNMATCHED)).alias("canonical_id"), F.col("name").alias("matched_name"), "score"
    )
