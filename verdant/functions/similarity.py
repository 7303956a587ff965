"""String and vector similarities."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.udf import once

SLOTS = 512


def sequence_ratio(a: str, b: str) -> float:
    """2 * matches / total of the longest-block matching, after case and blanks are levelled; 0 for an empty side."""
    x, y = (re.sub(r"\s+", " ", (s or "").lower()).strip() for s in (a, b))
    return difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0


@once
@F.pandas_udf(T.DoubleType())
def sequence_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([sequence_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def hashed_slot(token: Column, slots: int = SLOTS) -> Column:
    """md5 of the token modulo 512: the last three hexadecimal digits decide."""
    return (F.conv(F.right(F.md5(token), F.lit(3)), 16, 10).cast("int")) % slots


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of numbers."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets given as arrays; 0 where both are empty."""
    shared = F.size(F.array_intersect(a, b)).cast("double")
    total = F.size(F.array_union(a, b))
    return F.when(total > 0, shared / total).otherwise(0.0)
