"""Problem 6: passages of held-out items inside corpus documents.

Method: q-gram lemma filtering.  Items and documents are written as their words (maximal
runs of letters and digits, lower case, consistent form) joined by single blanks.  The
q-grams a document shares with an item are counted in overlapping diagonal bands; by the
q-gram lemma a passage of L characters found with at most k edits shares at least
L + 1 - q * (k + 1) of them inside one band, so bands with fewer are dropped without
loss.  Every run of min_words item words left is verified by a banded alignment.

The items are the stated query set: their index is broadcast after its size is checked
against `max_index_mb`; a larger set is run in blocks of items, each over all documents.
Documents are only mapped over, never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.skeleton import consistent
from verdant.session import spread

WORD = re.compile(r"[^\W_]+")
FOUND_SCHEMA = "doc_id {doc}, item_id {item}, words int, matched_chars int, edits int, item_start int, doc_start int"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BITS = 22


@dataclass(frozen=True)
class LeakRule:
    """min_words: length of the passage that counts; edits: budget k inside it; q: gram length."""

    min_words: int = 12
    edits: int = 2
    q: int = 8

    def __post_init__(self) -> None:
        if self.min_words < 1 or self.edits < 0 or self.q < 1:
            raise ValueError("min_words and q must be positive, edits not negative")
        if 2 * self.min_words - 1 < self.q:
            raise ValueError("q must not exceed the shortest passage, 2 * min_words - 1 characters")


def words_of(text: str | None) -> list[str]:
    """Words compared by this operator; none for null text."""
    return joined_words(text).split(" ") if text else []


_ASCII_WORDS = bytes(b if chr(b).isalnum() and b < 128 else 32 for b in range(256))


def joined_words(text: str) -> str:
    """The words of a text with single blanks between them."""
    if text.isascii():
        return b" ".join(text.lower().encode().translate(_ASCII_WORDS).split()).decode()
    return " ".join(WORD.findall(consistent(text).lower()))


def _gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """One hash for each run of q code points, by doubling the length that is hashed."""
    if len(codes) < q:
        return np.empty(0, np.uint64)
    h, done = None, 0
    power, width = codes, 1  # hashes of runs of `width`
    with np.errstate(over="ignore"):
        factor = _BASE
        rest = q
        while rest:
            if rest & 1:
                if h is None:
                    h, done = power, width
                else:  # a run of `done` followed by one of `width`
                    n = len(h) - width
                    h, done = h[:n] * factor + power[done : done + n], done + width
            rest >>= 1
            if rest:
                power = power[:-width] * factor + power[width:]
                factor, width = factor * factor, width * 2
        h = h[: len(codes) - q + 1].copy()
        h ^= h >> np.uint64(29)
        h *= _MIX
    return h


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class LeakIndex:
    """Inverted q-gram index of the items, and the words of each for verification."""

    def __init__(self, items: list[tuple[int, str | None]], rule: LeakRule):
        self.rule, self.ids, self.words, self.least, self.shortest, self.texts = rule, [], [], [], [], []
        self.begins, self.stops = [], []  # character positions of each run of min_words words
        hashes, owner, place = [], [], []
        for item_id, text in items:
            words = words_of(text)
            if len(words) < rule.min_words:
                continue  # no passage of that length exists
            sizes = np.cumsum([0, *(len(w) + 1 for w in words)])
            begins, stops = sizes[: -rule.min_words], sizes[rule.min_words :] - 1
            shortest = int((stops - begins).min())
            self.begins.append(begins)
            self.stops.append(stops)
            joined = " ".join(words)
            # Short passages get a smaller q-gram threshold, never below one shared gram.
            self.least.append(max(1, shortest + 1 - rule.q * (rule.edits + 1)))
            self.shortest.append(max(shortest, rule.q))
            h = _gram_hashes(_codes(joined), rule.q)
            hashes.append(h)
            owner.append(np.full(len(h), len(self.ids), np.int32))
            place.append(np.arange(len(h), dtype=np.int32))
            self.ids.append(item_id)
            self.words.append(words)
            self.texts.append(joined)
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.owner = np.concatenate(owner)[order] if hashes else np.empty(0, np.int32)
        self.place = np.concatenate(place)[order] if hashes else np.empty(0, np.int32)
        self.keys, self.starts, self.counts = np.unique(h[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.runs = [{tuple(w[i : i + rule.min_words]) for i in range(len(w) - rule.min_words + 1)} for w in self.words]
        self.vocabulary = [set(w) for w in self.words]

    @property
    def bytes(self) -> int:
        return int(sum(x.nbytes for x in (self.owner, self.place, self.keys, self.starts, self.counts, self.seen))) + 200 * sum(map(len, self.words))

    def bands(self, docs: list[str]) -> np.ndarray:
        """Rows of document, item, lowest diagonal, first word: every run of min_words words over its threshold in a band."""
        rule, none = self.rule, np.empty((4, 0), np.int64)
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        if not len(self.keys) or not lengths.sum():
            return none
        codes = _codes("".join(docs))
        h = _gram_hashes(codes, rule.q)
        hit = self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)]
        # A passage holds the threshold of the shortest one within its length, whatever the item: sparse stretches go first.
        span = max(1, min(self.shortest) - rule.q + 1)
        total = np.concatenate([[0], np.cumsum(hit)])
        begins = np.flatnonzero(total[np.minimum(np.arange(len(hit)) + span, len(hit))] - total[:-1] >= min(self.least))
        if not len(begins):
            return none
        dense = np.zeros(len(hit) + 1, np.int32)
        np.add.at(dense, begins, 1)
        np.add.at(dense, np.minimum(begins + span, len(hit)), -1)
        at = np.flatnonzero(hit & (np.cumsum(dense[:-1]) > 0))
        key = np.searchsorted(self.keys, h[at])
        key[key == len(self.keys)] = 0
        good = self.keys[key] == h[at]
        at, key = at[good], key[good]
        ends = np.cumsum(lengths)
        doc = np.searchsorted(ends, at, side="right")
        inside = at + rule.q <= ends[doc]  # grams across two documents are none
        at, key, doc = at[inside], key[inside], doc[inside]
        n = self.counts[key]
        rows = np.repeat(np.arange(len(at)), n)
        post = np.repeat(self.starts[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        local = (at - (ends - lengths)[doc])[rows]
        item, place = self.owner[post], self.place[post]
        frame = pd.DataFrame({"doc": doc[rows], "item": item, "place": place, "diag": local - place})
        # A passage with k edits spans at most k + 1 diagonals: bands of width 2(k + 1) that overlap by half hold it.
        half = rule.edits + 1
        band = np.floor_divide(frame["diag"].to_numpy(), half)
        both = pd.concat([frame.assign(band=band), frame.assign(band=band - 1)])
        group = (both["doc"].to_numpy().astype(np.int64) * len(self.ids) + both["item"].to_numpy()) << 32
        group += both["band"].to_numpy() - both["band"].min()
        where = both["place"].to_numpy()
        order = np.lexsort((where, group))
        group, where = group[order], where[order]
        once = np.ones(len(group), bool)
        once[1:] = (group[1:] != group[:-1]) | (where[1:] != where[:-1])
        group, where, order = group[once], where[once], order[once]
        # A region is one passage long: `least` grams of one band within its `shortest` characters.
        item = both["item"].to_numpy()[order]
        least, shortest = np.asarray(self.least)[item], np.asarray(self.shortest)[item]
        last = np.arange(len(group)) + least - 1
        fits = last < len(group)
        last[~fits] = 0
        fits &= (group[last] == group) & (where[last] - where <= shortest - rule.q)
        # In bands that have one, the lemma is applied to each passage of whole words by itself.
        kept = np.unique(group[fits])
        begin, end = np.searchsorted(group, kept), np.searchsorted(group, kept, side="right")
        of_doc, of_item, low = both["doc"].to_numpy()[order[begin]], item[begin], both["band"].to_numpy()[order[begin]] * half
        found = []
        for n, (b, e) in enumerate(zip(begin, end, strict=True)):
            starts, stops = self.begins[of_item[n]], self.stops[of_item[n]]
            shared = np.searchsorted(where[b:e], stops - rule.q, side="right") - np.searchsorted(where[b:e], starts)
            some = np.flatnonzero(shared >= np.maximum(1, stops - starts + 1 - rule.q * half))
            found.append(np.stack([np.full(len(some), x) for x in (of_doc[n], of_item[n], low[n])] + [some]))
        return np.concatenate(found, axis=1) if found else none

    def edits(self, docs: list[str], doc: np.ndarray, item: np.ndarray, low: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Least edits of each item[start:stop] against its document on diagonals low .. low + 2(k + 1) - 1.

        Both ends of the document stretch are free inside the band; the stretches are taken side by side.
        """
        width = 2 * (self.rule.edits + 1)
        codes, texts = _codes("".join(docs)), _codes("".join(self.texts))
        size = np.fromiter(map(len, docs), np.int64, len(docs))
        offset = np.cumsum(size) - size
        held = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        base = np.cumsum(held) - held
        length = stop - start
        out = np.zeros(len(doc), np.int64)
        by_length = np.argsort(-length, kind="stable")
        for part in np.split(by_length, range(4096, len(by_length), 4096)):
            cost = np.zeros((len(part), width), np.int32)
            first = (start + low)[part][:, None] + np.arange(width)
            for i in range(int(length[part[0]]) if len(part) else 0):
                live = int(np.searchsorted(-length[part], -i))  # the longer ones come first
                rows = part[:live]
                at = first[:live] + i
                inside = (at >= 0) & (at < size[doc[rows]][:, None])
                char = texts[base[item[rows]] + start[rows] + i]
                match = inside & (codes[np.where(inside, at + offset[doc[rows]][:, None], 0)] == char[:, None])
                prev = cost[:live]
                row = prev + ~match
                row[:, :-1] = np.minimum(row[:, :-1], prev[:, 1:] + 1)
                for j in range(1, width):
                    row[:, j] = np.minimum(row[:, j], row[:, j - 1] + 1)
                cost[:live] = row
            out[part] = cost.min(axis=1)
        return out

    def passages(self, docs: list[str]) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """(characters, edits, item position, diagonal) of the longest passage of each (document, item).

        A passage is a stretch of the item's words on one band of which every run of min_words
        words is in the document with at most k edits; of equally long ones that with fewest edits.
        """
        doc, item, low, run = self.bands(docs)
        if not len(doc):
            return {}
        start = np.array([self.begins[i][r] for i, r in zip(item, run, strict=True)])
        stop = np.array([self.stops[i][r] for i, r in zip(item, run, strict=True)])
        good = self.edits(docs, doc, item, low, start, stop) <= self.rule.edits
        doc, item, low, run, start, stop = (x[good] for x in (doc, item, low, run, start, stop))
        if not len(doc):
            return {}
        new = np.ones(len(doc), bool)  # where a stretch begins
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (low[1:] != low[:-1]) | (run[1:] != run[:-1] + 1)
        heads = np.flatnonzero(new)
        doc, item, low, start, stop = doc[heads], item[heads], low[heads], start[heads], stop[np.append(heads[1:], len(doc)) - 1]
        cost = self.edits(docs, doc, item, low, start, stop)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for d, i, w, s, e, c in zip(*(x.tolist() for x in (doc, item, low, start, stop, cost)), strict=True):
            if (d, i) not in best or (e - s, -c) > (best[d, i][0], -best[d, i][1]):
                best[d, i] = (e - s, c, s, w)
        return best

    def longest_run(self, words: list[str], item: int) -> int:
        """Longest run of words that the document and the item share, if it reaches min_words, else 0."""
        k, runs, known = self.rule.min_words, self.runs[item], self.vocabulary[item]
        best = since = 0  # since: where the words last began to be all known
        run = 0
        for i, word in enumerate(words):
            if word not in known:
                since, run = i + 1, 0
            elif i + 1 - since >= k:
                run = run + 1 if tuple(words[i + 1 - k : i + 1]) in runs else 0
                best = max(best, run)
        return best + k - 1 if best else 0


def _scan(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index: LeakIndex = shared.value
        for batch in batches:
            texts = batch["text"].tolist()
            ids = batch["doc_id"].tolist()
            start = 0
            while start < len(texts):  # some million characters at a time, whatever the rows
                size, end = 0, start
                while end < len(texts) and (end == start or size < 1_000_000):
                    size += len(texts[end] or "")
                    end += 1
                joined = [joined_words(t) for t in texts[start:end]]
                rows = []
                for (d, i), (chars, edits, lo, low) in index.passages(joined).items():
                    exact = index.longest_run(joined[d].split(" "), i)
                    rows.append((ids[start + d], index.ids[i], exact, chars, edits, lo, max(0, low + lo)))
                if rows:
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words", "matched_chars", "edits", "item_start", "doc_start"])
                start = end

    return run


def leaked_passages(
    documents: DataFrame,
    items: DataFrame,
    rule: LeakRule = LeakRule(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    max_index_mb: int = 256,
) -> DataFrame:
    """One row per document and item with a passage in common: `min_words` whole words of the item
    in a row, found in the document with at most `rule.edits` edits.

    `words` is the longest run of words both have, if it reaches rule.min_words, else 0
    (an edited passage, for which `edits` over `matched_chars` tell how near it is).  These
    describe the longest stretch of item words of which every run of min_words qualifies.

    Ids keep their type.  Null ids of items and null and empty texts match nothing; items shorter than min_words are no passages;
    repeated rows of a document come out once; an empty table gives no rows; other columns
    are not read.  Texts of any length are scanned whole, some million characters at a time.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = spread(docs.where(F.col("text").isNotNull() & (F.length("text") > 0)))
    wanted = items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    wanted = wanted.where("text is not null and item_id is not null").dropDuplicates(["item_id"])
    schema = FOUND_SCHEMA.format(doc=docs.schema["doc_id"].dataType.simpleString(), item=wanted.schema["item_id"].dataType.simpleString())

    def found(block: list) -> DataFrame:
        return docs.mapInPandas(_scan(spark.sparkContext.broadcast(LeakIndex(block, rule))), schema)

    parts, block, chars = [], [], 0
    for row in wanted.orderBy("item_id").toLocalIterator():  # the stated query set, a block at a time
        block.append((row["item_id"], row["text"]))
        chars += len(row["text"])
        if chars * 80 > max_index_mb * 1_000_000:  # about 80 bytes of index a character
            parts.append(found(block))
            block, chars = [], 0
    if block or not parts:
        parts.append(found(block))
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["doc_id", "item_id"])
