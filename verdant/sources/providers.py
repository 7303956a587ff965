"""Boundaries that are not computation: page text, extraction, embedding.

Each is a callable over an Arrow batch, handed to mapInPandas; the defaults are
deterministic and need no network, so a plan can be run and tested without a service.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.functions.text import STOPWORDS

PageReader = Callable[[bytes], list[str]]
Extractor = Callable[[str], list[dict]]

_STATED = re.compile(r"([A-Za-z][A-Za-z0-9 ,'/-]{3,80}?)\s+(?:was|were|reached|rose to|fell to|totalled|averaged|came to|stood at|landed at|closed at)\s+(?:[a-z]+ at\s+)?(-?\d[\d,.]*)\s*([^\s,.;]+)?")


def form_feed_pages(content: bytes) -> list[str]:
    """Default text layer: UTF-8 text with a form feed between pages."""
    return content.decode("utf-8", "replace").split("\f")


def pattern_extractor(text: str) -> list[dict]:
    """Default extractor: sentences that state a number for a named metric."""
    found = []
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        if m := _STATED.search(sentence):
            found.append({"metric": m.group(1).strip(), "value": m.group(2).rstrip(".,"), "unit": m.group(3) or "", "evidence": sentence})
    return found


def read_pages(files: DataFrame, reader: PageReader = form_feed_pages) -> DataFrame:
    """(doc, page, text) of files read by spark.read.format("binaryFile"); pages count from 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, i + 1, text) for path, content in zip(batch["path"], batch["content"]) for i, text in enumerate(reader(bytes(content)))]
            yield pd.DataFrame(rows, columns=["doc", "page", "text"])

    return files.select("path", "content").mapInPandas(run, "doc string, page int, text string")


def extract_facts(chunks: DataFrame, extractor: Extractor = pattern_extractor) -> DataFrame:
    """(fact_id, chunk_id, metric, value, unit, evidence): fact_id is {chunk_id}_fact_{n}."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (f"{chunk}_fact_{i + 1}", chunk, f.get("metric"), f.get("value"), f.get("unit"), f.get("evidence"))
                for chunk, text in zip(batch["chunk_id"], batch["content"])
                for i, f in enumerate(extractor(text or ""))
            ]
            yield pd.DataFrame(rows, columns=["fact_id", "chunk_id", "metric", "value", "unit", "evidence"])

    schema = "fact_id string, chunk_id string, metric string, value string, unit string, evidence string"
    return chunks.select(F.col("chunk_id").cast("string").alias("chunk_id"), F.col("content").cast("string").alias("content")).mapInPandas(run, schema)


def salvage_json_array(text: str | None) -> str | None:
    """The longest prefix of a cut-off JSON array of objects that is an array again; None without one."""
    if not text or "[" not in text:
        return None
    body = re.sub(r"^\s*```(?:json)?\s*|\s*```\s*$", "", text)
    start = body.index("[") if "[" in body else 0
    depth, quoted, escaped, last = 0, False, False, None
    for i in range(start, len(body)):
        c = body[i]
        if quoted:
            escaped, quoted = (c == "\\" and not escaped), not (c == '"' and not escaped)
        elif c == '"':
            quoted = True
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if c == "]" and depth == 0:
                return body[start : i + 1]
            if c == "}" and depth == 1:
                last = i
    return body[start : last + 1] + "]" if last is not None else "[]"


Encoder = Callable[[list[str]], list[list[float]]]


def hashing_encoder(texts: list[str]) -> list[list[float]]:
    """Default encoder: unit vectors of 512 slots, words by the hash of their letters; a text without words is zero."""
    out = []
    for text in texts:
        counts = [0.0] * 512
        for word in re.findall("[a-z0-9]+", text.lower()):
            if word not in STOPWORDS:
                counts[int(hashlib.md5(word.encode()).hexdigest()[-3:], 16) % 512] += 1.0
        size = math.sqrt(sum(x * x for x in counts))
        out.append([x / size for x in counts] if size else counts)
    return out


def embed_texts(df: DataFrame, key: str, text: str, encoder: Encoder = hashing_encoder) -> DataFrame:
    """(key, vector) of every distinct (key, text); null texts are empty.  The encoder gets one batch at a time, equal texts of it once."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = list(dict.fromkeys(batch["text"]))
            vectors = dict(zip(own, encoder(own), strict=True))
            yield pd.DataFrame({"key": batch["key"], "vector": [vectors[t] for t in batch["text"]]})

    return rows.mapInPandas(run, f"key {rows.schema['key'].dataType.simpleString()}, vector array<double>")
