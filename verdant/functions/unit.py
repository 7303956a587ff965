"""Spelling and context of raw units, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verdant.functions.quantity import SCALES

# Nouns that are counted, ways of writing a share, and money that an intensity is stated for.
COUNTED = r"(?i)\b(number of|count of|no\. of|employees|workers|suppliers|farmers|trees|sites|outlets|injuries|fatalities|complaints|beneficiaries|units)\b"
SHARE, POINTS = r"(?i)%|\b(percent|percentage)\b", r"(?i)\b(bps|basis points?)\b"
MONEY = "inr|rs|rupee|revenue|turnover"
SCALE_WORDS = "|".join(sorted(SCALES))
# Order matters: what each step finds is no longer seen by the next. Pattern and replacement are read alike by Spark and by DuckDB.
KEY_STEPS = (
    ("₹", " inr "), ("₂", "2"), ("³", "3"), ("['’`]?\\b000\\b", " thousand "), ("/", " per "), ("[.'’`]", ""), ("[^a-z0-9%+]+", " "), ("\\b(in|of)\\b", " "),
    ("liter", "litre"), ("\\b(cubic) meter", "$1 metre"), ("\\b([a-z0-9]+[^isu ])s\\b", "$1"), (" +", " "),
)


def unit_key(unit: Column) -> Column:
    """Lower-case words of a unit without plural s; a slash is "per", '000 is "thousand"; null becomes empty."""
    key = F.lower(F.coalesce(unit, F.lit("")))
    for pattern, put in KEY_STEPS:
        key = F.regexp_replace(key, pattern, put)
    return F.trim(key)


def unit_key_sql(column: str) -> str:
    """The same for DuckDB."""
    out = f"lower(coalesce({column}, ''))"
    for pattern, put in KEY_STEPS:
        out = f"regexp_replace({out}, '{pattern.replace(chr(39), chr(39) * 2)}', '{put.replace('$1', chr(92) + '1')}', 'g')"
    return f"trim({out})"
