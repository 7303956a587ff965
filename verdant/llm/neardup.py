"""Problem 4: records whose texts are nearly the same.

Method: byte-position inverted index with count filtering.  A text is the set of its word
shingles, written as a sparse row of positional bytes: of the 48-bit hash of a shingle the
first 32 bits name a position and the next 8 are the byte that stands there.  Two texts of n and m
positional bytes with Jaccard similarity t share at least T = ceil(t / (1 + t) * (n + m)).

* Index: the positional bytes of a text are ordered from rare to frequent and only the first
  n - ceil(t n) + 1 are posted, so the longest lists are never read in full.
* Tally: the postings that two texts share are counted for each pair.  Of the first
  n - T + c and m - T + c places at least c must be shared (fewer where less was posted):
  this is the guaranteed minimum, and pairs that do not reach it are dropped.
* Verification: the Jaccard similarity of what is left is computed from the words.

Every posting also carries an 88-bit parity fingerprint of the whole set.  Each positional
byte that is not shared changes at most one of its bits, which bounds what a pair can share
at all; pairs that cannot reach T are not even tallied.  All filters are exact bounds: no
link is lost.  Rarity comes from a counting sketch filled from all rows, with a slot for
every two to four shingles; it only orders the bytes, so its collisions cost time and never
results.  Equal sets form one class: links are made between classes.

The texts are read three times (classes and counts, postings, the candidates for verification);
of texts without a partner only 16-byte class ids and the posted bytes are shuffled.  Copies
are found before anything is posted, so a text copied a billion times is posted once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.udf import once
from verdant.session import cut_and_freed, small_join, spread, stored

LEAST_BITS, MOST_BITS = 16, 26  # 64 KB to 64 MB of sketch
_BLOCK = 1 << 16  # slots of a sketch that travel together
_WORD = re.compile(r"[a-z0-9]+")
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class NearRule:
    """words: shingle length; similarity: least Jaccard; tally: shared postings c that are
    asked for where the prefixes allow it; sketch_bits: log2 of the sketch's slots, by the
    size of the texts if None."""

    words: int = 5
    similarity: float = 0.8
    tally: int = 3
    sketch_bits: int | None = None

    def __post_init__(self) -> None:
        if self.words < 1 or not 0 < self.similarity <= 1 or self.tally < 1:
            raise ValueError("words >= 1, 0 < similarity <= 1 and tally >= 1 are needed")
        if self.sketch_bits is not None and not LEAST_BITS <= self.sketch_bits <= MOST_BITS:
            raise ValueError(f"sketch_bits from {LEAST_BITS} to {MOST_BITS}")


def plain_words(text: str) -> list[str]:
    """Maximal runs of a-z and 0-9 of the lower-case text."""
    return _WORD.findall(text.lower())


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    h = h ^ (h >> np.uint64(29))
    h = h * _M3
    return h ^ (h >> np.uint64(32))


_ALNUM = np.array([chr(b) in "abcdefghijklmnopqrstuvwxyz0123456789" for b in range(256)])
_BREAK = 0xFF  # no byte of UTF-8
_INVERSE = np.uint64(pow(int(_M1), -1, 1 << 64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the words of each text, in order, without a loop over words.

    A word's hash is a difference of prefix sums of bytes weighted by powers of an odd
    number, brought back to power zero; all modulo 2**64.
    """
    data = np.frombuffer(bytes([_BREAK]).join([t.lower().encode("utf-8", "surrogatepass") for t in texts]), np.uint8)
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = _ALNUM[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power = np.full(len(data), _M1)
    power[0] = 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data.astype(np.uint64) * np.cumprod(power, dtype=np.uint64), out=sums[1:])
    power[1:] = _INVERSE
    h = (sums[end] - sums[start]) * np.cumprod(power, dtype=np.uint64)[start]
    owner = np.cumsum(data == _BREAK)[start]
    return owner, _mix(h + (end - start).astype(np.uint64) * _M3)


def shingle_sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 48-bit hash) of the distinct shingles of each of at most 65,536 texts, sorted; texts under k words have none."""
    owner, words = word_hashes(texts)
    if len(words) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h *= _M1
        h += words[i : i + n]
    whole = owner[:n] == owner[k - 1 :]
    both = (owner[:n][whole].astype(np.uint64) << np.uint64(48)) | (_mix(h)[whole] >> np.uint64(16))
    both.sort()
    fresh = np.ones(len(both), bool)
    np.not_equal(both[1:], both[:-1], out=fresh[1:])
    both = both[fresh]
    return (both >> np.uint64(48)).astype(np.int64), both & np.uint64(0xFFFFFFFFFFFF)


@dataclass
class _Sets:
    owner: np.ndarray  # of each shingle, ascending
    hashes: np.ndarray
    start: np.ndarray  # first shingle of each text
    size: np.ndarray
    id_hi: np.ndarray  # 40 bits of a hash of the set, 24 bits of the parity fingerprint
    id_lo: np.ndarray  # 64 bits of the parity fingerprint


def _describe(texts: list[str], k: int) -> _Sets:
    owner, h = shingle_sets(texts, k)
    count = len(texts)
    size = np.bincount(owner, minlength=count).astype(np.int64)
    start = np.cumsum(size) - size
    hi, lo = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    if len(h):
        filled = size > 0
        total = np.zeros(count, np.uint64)
        total[filled] = np.add.reduceat(_mix(h ^ _M2), start[filled])
        bit = (h % np.uint64(88)).astype(np.int64)
        one = np.uint64(1)
        low = np.where(bit < 64, one << np.minimum(bit, 63).astype(np.uint64), np.uint64(0))
        high = np.where(bit >= 64, one << np.maximum(bit - 64, 0).astype(np.uint64), np.uint64(0))
        lo[filled] = np.bitwise_xor.reduceat(low, start[filled])
        hi[filled] = np.bitwise_xor.reduceat(high, start[filled])
        hi |= _mix(total) & np.uint64(0xFFFFFFFFFF000000)
    return _Sets(owner, h, start, size, hi.view(np.int64), lo.view(np.int64))


def _chunks(batches: Iterator[pd.DataFrame], most: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Batches cut to some million characters and to 65,536 rows, whole rows always."""
    for batch in batches:
        ends = np.cumsum(batch["text"].str.len().to_numpy(np.int64) + most // 65_536)
        part = ends // most
        for p in np.unique(part):
            yield batch[part == p]


def _described(rule: NearRule, bits: int) -> Callable:
    """The class of every text, and at the end of the partition its shingles counted by slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots, held = np.zeros(1 << bits, np.uint32), []
        for batch in _chunks(batches):
            s = _describe(batch["text"].tolist(), rule.words)
            held.append((s.hashes >> np.uint64(48 - bits)).astype(np.int32))
            if sum(map(len, held)) > len(slots) // 4:
                slots += np.bincount(np.concatenate(held), minlength=len(slots)).astype(np.uint32)
                held = []
            out = pd.DataFrame({"id": batch["id"].to_numpy(), "mark": batch["mark"].to_numpy(), "id_hi": s.id_hi, "id_lo": s.id_lo, "block": -1, "counts": None})
            yield out[s.size > 0]
        if held:
            slots += np.bincount(np.concatenate(held), minlength=len(slots)).astype(np.uint32)
        yield from _blocks(slots, {"id": None, "mark": 0, "id_hi": 0, "id_lo": 0})

    return run


def _blocks(slots: np.ndarray, rest: dict) -> Iterator[pd.DataFrame]:
    for i in range(0, len(slots), _BLOCK):
        part = slots[i : i + _BLOCK]
        if most := int(part.max()):
            kind = np.min_scalar_type(most)
            yield pd.DataFrame({**rest, "block": [i // _BLOCK], "counts": [kind.char.encode() + zlib.compress(part.astype(kind).tobytes(), 6)]})


def _merged(join: Callable, scale: Callable) -> Callable:
    """Blocks of the same number brought together; a task holds the blocks that hash to it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, counts in zip(batch["block"], batch["counts"]):
                part = np.frombuffer(zlib.decompress(counts[1:]), counts[:1].decode())
                sums[b] = join(sums[b], part) if b in sums else part.astype(np.int64)
        for b, part in sums.items():
            yield pd.DataFrame({"block": [b], "counts": [zlib.compress(scale(part).astype(np.uint8).tobytes(), 1)]})

    return run


def _logarithmic(part: np.ndarray) -> np.ndarray:
    """Counts on a scale of one byte, six steps to a factor of two; 0 and 1 stay exact."""
    return np.where(part < 2, part, np.minimum(255, 2 + np.ceil(6 * np.log2(np.maximum(part, 1)))))


def _collected(blocks: DataFrame, size: int, run: Callable) -> np.ndarray:
    """The blocks merged by block number and put together: size bytes, which is what bounds the driver's share."""
    out = np.zeros(size, np.uint8)
    for row in blocks.repartition("block").mapInPandas(run, "block int, counts binary").toLocalIterator():
        part = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
        out[row["block"] * _BLOCK : row["block"] * _BLOCK + len(part)] = part
    return out


def sketch_bits(rows: DataFrame) -> int:
    """A slot for every 16 to 32 characters, some two or four shingles, within LEAST_BITS and MOST_BITS."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, (chars // 32).bit_length()))


# spot: the positional byte in 40 bits, above it the place in the prefix.  In this order and width a
# posting compresses to four fifths of what it takes with a column for each number.
_POSTING = "id_hi long, id_lo long, spot long, size int"
_SPOT_BITS = 40
_LAST_PLACE = (1 << 23) - 1  # later places count as this one: such a byte is tallied more often than it need be, never less


def prefix_length(size: np.ndarray, similarity: float) -> np.ndarray:
    """How many of a text's positional bytes are posted."""
    return size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1


def _post(rule: NearRule, bits: int, sketch) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.frombuffer(zlib.decompress(sketch.value), np.uint8)
        for batch in _chunks(batches):
            s = _describe(batch["text"].tolist(), rule.words)
            rarity = counts[(s.hashes >> np.uint64(48 - bits)).astype(np.int32)]
            # text, rarity and positional byte in one number: its order is that of the prefix
            order = (s.owner.astype(np.uint64) << np.uint64(48)) | (rarity.astype(np.uint64) << np.uint64(40)) | (s.hashes >> np.uint64(8))
            order.sort()
            place = np.arange(len(order)) - s.start[s.owner]
            rarity = (order >> np.uint64(40)).astype(np.uint8)
            kept = (place < prefix_length(s.size, rule.similarity)[s.owner]) & (rarity > 1)  # what occurs once has no partner
            owner = s.owner[kept]
            key = order[kept] & np.uint64((1 << _SPOT_BITS) - 1)
            spot = key.view(np.int64) | (np.minimum(place[kept], _LAST_PLACE) << _SPOT_BITS)
            yield pd.DataFrame({"id_hi": s.id_hi[owner], "id_lo": s.id_lo[owner], "spot": spot, "size": s.size[owner].astype(np.int32)})

    return run


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (_mix(hashes.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _texts_of(rule: NearRule, bits: int, wanted) -> Callable:
    """The texts whose id is in the filter of wanted ones, with their class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.frombuffer(zlib.decompress(wanted.value), np.uint8)
        for batch in _chunks(batches):
            batch = batch[flags[_slots(batch["slot"].to_numpy(np.int64), bits)] > 0]
            if len(batch):
                s = _describe(batch["text"].tolist(), rule.words)
                yield pd.DataFrame({"id_hi": s.id_hi, "id_lo": s.id_lo, "text": batch["text"].to_numpy()})[s.size > 0]

    return run


def wanted_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2**bits slots, set for the hashes in the column `slot`; its size is fixed, whatever the rows.

    It only keeps texts without a partner out of the shuffle; a slot set by chance costs time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            flags[_slots(batch["slot"].to_numpy(np.int64), bits)] = 1
        yield from _blocks(flags, {})

    blocks = ids.select("slot").mapInPandas(run, "block int, counts binary")
    return _collected(blocks, 1 << bits, _merged(np.bitwise_or, lambda part: part))


def jaccard(a: str, b: str, k: int) -> float:
    """Jaccard similarity of the sets of k-word shingles of two texts."""
    x, y = plain_words(a), plain_words(b)
    p, q = set(zip(*(x[i:] for i in range(k)))), set(zip(*(y[i:] for i in range(k))))
    both = len(p & q)
    return both / (len(p) + len(q) - both) if p or q else 0.0


def _jaccard_udf(k: int):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(x, y, k) for x, y in zip(a, b)], dtype="float64")

    return once(run)


@dataclass(frozen=True)
class NearDuplicates:
    """members: (id, id_hi, id_lo), the class of each record, rows delivered again included;
    copies: those of the classes of two or more ids; linked: those of the classes in links;
    links: (a_hi, a_lo, b_hi, b_lo, similarity) between classes."""

    members: DataFrame
    copies: DataFrame
    linked: DataFrame
    links: DataFrame

    def pairs(self) -> DataFrame:
        """(id_a, id_b, similarity) of all records, copies expanded: as many rows as there are pairs.

        For a text copied very often take classes() and named_links(), which lose nothing and
        grow with the records only.
        """
        left, right = self.copies.alias("x"), self.copies.alias("y")
        inside = left.join(right, (F.col("x.id_hi") == F.col("y.id_hi")) & (F.col("x.id_lo") == F.col("y.id_lo")) & (F.col("x.id") < F.col("y.id")))
        inside = inside.select(F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"), F.lit(1.0).alias("similarity"))
        one, two = self.linked.alias("x"), self.linked.alias("y")
        across = self.links.join(one, (F.col("a_hi") == F.col("x.id_hi")) & (F.col("a_lo") == F.col("x.id_lo")))
        across = across.select("b_hi", "b_lo", "similarity", F.col("x.id").alias("p"))
        across = across.join(two, (F.col("b_hi") == F.col("y.id_hi")) & (F.col("b_lo") == F.col("y.id_lo")))
        ends = F.least("p", "y.id").alias("id_a"), F.greatest("p", "y.id").alias("id_b")
        return inside.unionByName(across.select(*ends, "similarity"))

    def classes(self) -> DataFrame:
        """(id, class_id, copies, links): class_id is the smallest id of the class, links the classes it is linked to."""
        members = self.members.distinct()
        named = members.groupBy("id_hi", "id_lo").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies"))
        ends = self.links.select(F.col("a_hi").alias("id_hi"), F.col("a_lo").alias("id_lo")).unionAll(self.links.select("b_hi", "b_lo"))
        degree = ends.groupBy("id_hi", "id_lo").agg(F.count(F.lit(1)).alias("links"))
        named = named.join(degree, ["id_hi", "id_lo"], "left").fillna(0, ["links"])
        return members.join(named, ["id_hi", "id_lo"]).select("id", "class_id", "copies", "links")

    def named_links(self) -> DataFrame:
        """(class_a, class_b, similarity): links between the smallest ids of the classes."""
        named = self.linked.groupBy("id_hi", "id_lo").agg(F.min("id").alias("class_id"))
        a, b = named.withColumnsRenamed({"id_hi": "a_hi", "id_lo": "a_lo", "class_id": "p"}), named.withColumnsRenamed({"id_hi": "b_hi", "id_lo": "b_lo", "class_id": "q"})
        joined = self.links.join(a, ["a_hi", "a_lo"]).join(b, ["b_hi", "b_lo"])
        return joined.select(F.least("p", "q").alias("class_a"), F.greatest("p", "q").alias("class_b"), "similarity")


_CLASS = ["id_hi", "id_lo"]


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def near_duplicates(records: DataFrame, id_col: str, text: Column, rule: NearRule = NearRule(), takes_part: Column | None = None) -> NearDuplicates:
    """Classes of equal shingle sets and the links between those with the rule's similarity.

    Null texts and texts of fewer words than a shingle take no part, nor do rows for which
    `takes_part` is not true.  Rows repeating an id with the same text count once; an id with
    several texts belongs to the class of each.  An empty table gives no classes and no links;
    other columns are not read.  Texts of any length are taken whole.
    """
    rows = records.where(takes_part) if takes_part is not None else records
    rows = rows.select(F.col(id_col).alias("id"), text.cast("string").alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    spark = records.sparkSession
    rows = spread(rows)
    bits = rule.sketch_bits or sketch_bits(rows)
    id_type = rows.schema["id"].dataType.simpleString()
    tasks = 8 * spark.sparkContext.defaultParallelism  # each task hands on one sketch, so there are not more of them than that
    marked = rows.select("id", "text", F.xxhash64("text").alias("mark"))
    described = marked.coalesce(tasks).mapInPandas(_described(rule, bits), f"id {id_type}, mark long, id_hi long, id_lo long, block int, counts binary")
    described = stored(described)
    counted = described.where("block >= 0").select("block", "counts")
    sketch = spark.sparkContext.broadcast(_packed(_collected(counted, 1 << bits, _merged(np.add, _logarithmic))))
    members = described.where("block < 0").select("id", "id_hi", "id_lo", "mark")

    # One record of each class is posted; the others are its copies.
    several = members.groupBy(_CLASS).agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    copies = cut_and_freed(small_join(members, cut_and_freed(several.select(*_CLASS, "first")), _CLASS, "inner"))
    posted = small_join(marked, copies.where("id <> first").select("id", "mark").distinct(), ["id", "mark"], "left_anti")
    postings = posted.select("text").mapInPandas(_post(rule, bits, sketch), _POSTING)
    pairs = cut_and_freed(tallied_pairs(postings, rule))  # four numbers a pair

    ends = pairs.select(F.col("a_hi").alias("id_hi"), F.col("a_lo").alias("id_lo")).unionAll(pairs.select("b_hi", "b_lo")).distinct()
    linked = cut_and_freed(small_join(members.drop("mark"), cut_and_freed(ends), _CLASS, "left_semi"))
    wanted = linked.groupBy(_CLASS).agg(F.min("id").alias("id")).select(F.xxhash64("id").alias("slot"))
    wanted = spark.sparkContext.broadcast(_packed(wanted_filter(wanted, bits)))
    texts = rows.select("text", F.xxhash64("id").alias("slot")).mapInPandas(_texts_of(rule, bits, wanted), "id_hi long, id_lo long, text string")
    left = texts.withColumnsRenamed({"id_hi": "a_hi", "id_lo": "a_lo", "text": "a_text"})
    right = texts.withColumnsRenamed({"id_hi": "b_hi", "id_lo": "b_lo", "text": "b_text"})
    checked = pairs.join(left, ["a_hi", "a_lo"]).join(right, ["b_hi", "b_lo"])
    checked = checked.withColumn("similarity", _jaccard_udf(rule.words)("a_text", "b_text")).where(F.col("similarity") >= rule.similarity - 1e-12)
    links = cut_and_freed(checked.groupBy("a_hi", "a_lo", "b_hi", "b_lo").agg(F.max("similarity").alias("similarity")))
    return NearDuplicates(members.drop("mark"), copies.select("id", "id_hi", "id_lo"), linked, links)


def tallied_pairs(postings: DataFrame, rule: NearRule) -> DataFrame:
    """(a_hi, a_lo, b_hi, b_lo): pairs of classes whose shared postings reach the guaranteed minimum."""
    t, c = rule.similarity, rule.tally
    a, b = postings.alias("a"), postings.alias("b")
    n, m = F.col("a.size"), F.col("b.size")
    p, q = (F.shiftright(f"{x}.spot", _SPOT_BITS) for x in "ab")
    key, other = (F.col(f"{x}.spot").bitwiseAND(F.lit((1 << _SPOT_BITS) - 1)) for x in "ab")
    least = F.ceil((n + m) * F.lit(t / (1 + t)) - F.lit(1e-9))
    # These rules look at the two sides at once, so the sides stay one plan and one shuffle.
    counted = (p < n - least + c) & (q < m - least + c)
    differ = F.bit_count(F.col("a.id_lo").bitwiseXOR(F.col("b.id_lo"))) + F.bit_count(F.col("a.id_hi").bitwiseXOR(F.col("b.id_hi")).bitwiseAND(F.lit(0xFFFFFF)))
    possible = n + m - differ >= 2 * least
    ordered = (F.col("a.id_hi") < F.col("b.id_hi")) | ((F.col("a.id_hi") == F.col("b.id_hi")) & (F.col("a.id_lo") < F.col("b.id_lo")))
    # What is posted grows with the texts, whatever size Spark takes it to have: it is never broadcast.
    shared = a.hint("merge").join(b, (key == other) & ordered & counted & possible)

    def spare(size: Column) -> Column:
        # what the posted prefix guarantees: T - n + (n - ceil(t n) + 1)
        return least - F.ceil(size * F.lit(t) - F.lit(1e-9)) + 1

    minimum = F.least(F.lit(c), spare(n), spare(m))
    shared = shared.select(F.col("a.id_hi").alias("a_hi"), F.col("a.id_lo").alias("a_lo"), F.col("b.id_hi").alias("b_hi"), F.col("b.id_lo").alias("b_lo"), minimum.alias("minimum"))
    tally = shared.groupBy("a_hi", "a_lo", "b_hi", "b_lo").agg(F.count(F.lit(1)).alias("shared"), F.max("minimum").alias("minimum"))
    return tally.where("shared >= minimum").select("a_hi", "a_lo", "b_hi", "b_lo")
