"""Problem 1: cutting oversized items at natural boundaries.

Method: lexical-cohesion segmentation.  Paragraph, row and sentence ends divide a text
into units.  At each gap the words of the block before are compared with those of the
block after (cosine of counts); the depth of the similarity valley, measured to the peaks
on both sides, tells how clearly a topic ends there.  Pieces are filled left to right: of
the gaps in the window between half full and full the deepest valley is taken.  Where a
window holds no gap the cut falls on the last word end, and in unbroken text on the limit.
Each piece after the first repeats about `overlap` tokens of the one before.

Only offsets leave Python; the pieces themselves are cut by Spark from the stored text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.udf import once
from verdant.session import cut_lineage, small_join, spread

_GAP = re.compile(r"\n[^\S\n]*\n\s*|\n|(?<=[.!?;])[\"'”»)\]]*[^\S\n]+")
_WORD = re.compile(r"[^\W\d_]{4,}")
PARAGRAPH, ROW, SENTENCE, WORD_END, ANYWHERE = 3, 2, 1, 0, -1
KIND_NAMES = {PARAGRAPH: "paragraph", ROW: "row", SENTENCE: "sentence", WORD_END: "word", ANYWHERE: "limit"}


@dataclass(frozen=True)
class SplitRule:
    """Limits in tokens of floor((characters + 3) / 4); block: units on each side of a gap."""

    limit: int = 480
    overlap: int = 40
    block: int = 3

    def __post_init__(self) -> None:
        if self.limit < 1 or not 0 <= self.overlap < self.limit / 2 or self.block < 1:
            raise ValueError("limit and block must be positive, overlap under half the limit")


def token_estimate(text: Column) -> Column:
    """floor((characters + 3) / 4); null text stays null."""
    return F.floor((F.char_length(text) + 3) / 4).cast("int")


def gaps_of(text: str) -> list[tuple[int, int]]:
    """(offset, kind) of the inner gaps: where the next unit begins."""
    found = []
    for m in _GAP.finditer(text):
        at, sep = m.end(), m.group()
        if 0 < at < len(text):
            found.append((at, PARAGRAPH if sep.count("\n") > 1 else ROW if "\n" in sep else SENTENCE))
    return found


def valley_depths(text: str, offsets: list[int], block: int) -> list[float]:
    """Depth of the cohesion valley at each gap."""
    edges = [0, *offsets, len(text)]
    lowered = text.lower()
    units = [Counter(_WORD.findall(lowered, a, b)) for a, b in zip(edges, edges[1:])]
    left: Counter = Counter(units[0])
    right: Counter = Counter()
    for u in units[1 : 1 + block]:
        right.update(u)
    dot = sum(n * right.get(w, 0) for w, n in left.items())
    sq_l, sq_r = sum(n * n for n in left.values()), sum(n * n for n in right.values())
    scores = []
    for g in range(len(offsets)):
        scores.append(dot / math.sqrt(sq_l * sq_r) if sq_l and sq_r else 0.0)
        # unit g + 1 moves from the right block to the left one; one enters and one leaves
        moves = [(right, left, units[g + 1], -1, False), (left, right, units[g + 1], 1, True)]
        if g + 1 + block < len(units):
            moves.append((right, left, units[g + 1 + block], 1, False))
        if g + 1 - block >= 0:
            moves.append((left, right, units[g + 1 - block], -1, True))
        for own, other, unit, sign, is_left in moves:
            for w, n in unit.items():
                old = own.get(w, 0)
                new = old + sign * n
                own[w] = new
                dot += sign * n * other.get(w, 0)
                if is_left:
                    sq_l += new * new - old * old
                else:
                    sq_r += new * new - old * old
    depths = []
    rise_left = [0.0] * len(scores)
    for g in range(1, len(scores)):
        rise_left[g] = max(scores[g - 1], scores[g - 1] + rise_left[g - 1]) - scores[g] if scores[g - 1] >= scores[g] else 0.0
    rise_right = 0.0
    for g in range(len(scores) - 1, -1, -1):
        if g + 1 < len(scores) and scores[g + 1] >= scores[g]:
            rise_right = scores[g + 1] + rise_right - scores[g]
        else:
            rise_right = 0.0
        depths.append(rise_left[g] + rise_right)
    return depths[::-1]


def cut_points(text: str, rule: SplitRule = SplitRule()) -> list[tuple[int, int, int, int]]:
    """(start, end, overlap characters, kind of the cut that ends it) of each piece, in order.

    A text within the limit, the empty text too, is one piece.
    """
    most, repeat = 4 * rule.limit, 4 * rule.overlap
    size = len(text)
    if size <= most:
        return [(0, size, 0, PARAGRAPH)]
    gaps = gaps_of(text)
    depths = valley_depths(text, [at for at, _ in gaps], rule.block) if gaps else []
    pieces, start, own, g = [], 0, 0, 0
    while size - start > most:
        full = start + most
        half = own + (full - own) // 2
        while g < len(gaps) and gaps[g][0] <= own:
            g += 1
        best, late, i = None, None, g
        while i < len(gaps) and gaps[i][0] <= full:
            late = (gaps[i][0], gaps[i][1])
            if gaps[i][0] > half:
                rank = (round(depths[i], 6), gaps[i][1], gaps[i][0])
                best = max(best, rank) if best else rank
            i += 1
        if best:
            end, kind = best[2], best[1]
        elif late and late[0] - own >= repeat:
            end, kind = late
        else:
            end, kind = full, ANYWHERE
            for at in range(full, own + repeat, -1):
                if text[at - 1].isspace():
                    end, kind = at, WORD_END
                    break
        pieces.append((start, end, own - start, kind))
        own = end
        start = max(start + 1, end - repeat)
        for at in range(start, min(end, start + repeat // 2)):  # the repeated part begins with a whole word
            if text[at - 1].isspace() and not text[at].isspace():
                start = at
                break
    pieces.append((start, size, own - start, PARAGRAPH))
    return pieces


def _cuts(rule: SplitRule):
    @F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [list(x) for x in cut_points(t, rule)])

    return once(run)


def once_each(rows: DataFrame, id_cols: list[str]) -> DataFrame:
    """id_cols + (_text) with rows repeated whole left once.

    Only rows whose digest occurs twice are shuffled; of the others, which are nearly all,
    nothing but the digests is.
    """
    marked = rows.withColumn("_mark", F.xxhash64(*id_cols, "_text"))
    twice = cut_lineage(marked.groupBy("_mark").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark"))
    single = small_join(marked, twice, ["_mark"], "left_anti")
    several = small_join(marked, twice, ["_mark"], "left_semi").dropDuplicates([*id_cols, "_text"])
    return single.unionByName(several).drop("_mark")


def split_oversized(items: DataFrame, id_cols: list[str], content_col: str = "content", rule: SplitRule = SplitRule(), keep_small: bool = False) -> DataFrame:
    """id_cols + (piece_no, n_pieces, start, end, overlap_chars, cut, content, token_estimate).

    Only items over the limit come out unless keep_small; null content gives no piece.
    Offsets count Unicode characters, so the pieces without their overlaps joined in order
    are the stored text.  Repeated rows of an item come out once if their content is equal.
    """
    text = F.col(content_col).cast("string")
    rows = items.select(*id_cols, text.alias("_text")).where(F.col("_text").isNotNull())
    if not keep_small:
        rows = rows.where(F.char_length("_text") > 4 * rule.limit)
    rows = once_each(spread(rows), id_cols)
    names = F.create_map(*(F.lit(x) for pair in KIND_NAMES.items() for x in pair))
    cut = rows.select(*id_cols, "_text", _cuts(rule)(F.col("_text")).alias("_cuts"))
    long = cut.select(*id_cols, "_text", F.size("_cuts").alias("n_pieces"), F.posexplode("_cuts").alias("_at", "_cut"))
    start, end = F.col("_cut")[0], F.col("_cut")[1]
    return long.select(
        *id_cols,
        (F.col("_at") + 1).alias("piece_no"),
        "n_pieces",
        start.alias("start"),
        end.alias("end"),
        F.col("_cut")[2].alias("overlap_chars"),
        names[F.col("_cut")[3]].alias("cut"),
        F.col("_text").substr(start + 1, end - start).alias("content"),
        F.floor((end - start + 3) / 4).cast("int").alias("token_estimate"),
    )
