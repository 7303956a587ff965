"""Problem 8: one consistent form for text that looks the same.

Method: confusables skeleton.  A text is decomposed, every character is replaced by its
prototype from a look-alike table, and the result is decomposed again; texts with equal
skeletons look the same.  The table is made by rule from the Unicode character database
(widths, letters in mathematical fonts, joined letters, blanks, hyphens, invisible characters) plus the short fixed
lists of look-alike letters below.

Kept as real differences: case, accents, subscripts and superscripts, visible
punctuation, line breaks and the number of blanks.
"""

from __future__ import annotations

import hashlib
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.session import cut_lineage, spread

# Letters of other alphabets with the shape of a Latin letter, and that letter.
LOOK_ALIKE_LETTERS = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХԌԚԜаеѕіјорсухһԁԛԝӏү", "ABESIJKMHOPCTYXGQWaesijopcyxhdqwly"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονϲ", "ABEZHIKMNOPTYXCjovc"),
    "Armenian": ("ՕՍԼոսօհ", "OULnuoh"),
}
# Hyphen characters that are drawn as the ordinary hyphen.
HYPHENS = "‐‑﹣－"
# Invisible characters outside the Unicode category Cf.
INVISIBLE = "͏ᅟᅠ឴឵ㅤﾠ" + "".join(map(chr, [*range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]))
# Characters of category Cf that are drawn.
VISIBLE_FORMAT = "؀؁؂؃؄؅۝܏࣢"


# Planes 0, 1 and 14; of the others only ideographs with canonical decompositions are assigned.
ASSIGNED = [*range(0x80, 0x2_0000), *range(0xE_0000, 0xE_1000)]


@lru_cache(maxsize=1)
def prototypes() -> dict[int, str]:
    """Code point -> prototype, for every character that has one."""
    table: dict[int, str] = {}
    for code in ASSIGNED:
        char = chr(code)
        kind, _, rest = unicodedata.decomposition(char).rpartition(">")
        category = unicodedata.category(char)
        if category == "Zs":
            table[code] = " "
        elif category == "Cf" and char not in VISIBLE_FORMAT:
            table[code] = ""
        elif kind in ("<wide", "<narrow", "<font"):
            table[code] = unicodedata.normalize("NFKD", char)
        elif kind == "<compat":
            plain = "".join(chr(int(x, 16)) for x in rest.split())
            # joined letters and letter-shaped numerals; not variant letters such as the long s
            if plain.isalpha() and (len(plain) > 1 or 0x2160 <= code <= 0x217F) and "ſ" not in plain:
                table[code] = unicodedata.normalize("NFD", plain)
    table |= {ord(c): "-" for c in HYPHENS} | {ord(c): "" for c in INVISIBLE} | {0xB5: "μ", 0xFB05: "ſt"}
    for odd, plain in LOOK_ALIKE_LETTERS.values():
        table |= {ord(a): b for a, b in zip(odd, plain, strict=True)}
    while again := {code: proto for code, proto in table.items() if any(ord(c) in table for c in proto)}:
        table |= {code: proto.translate(table) for code, proto in again.items()}
    return table


@lru_cache(maxsize=1)
def _by_char() -> dict[str, str]:
    return {chr(code): proto for code, proto in prototypes().items()}


def _replaced(text: str) -> str:
    """text.translate(prototypes()); quicker, as few of the table's characters are in one text."""
    table = _by_char()
    for char in table.keys() & set(text):
        text = text.replace(char, table[char])
    return text


def skeleton(text: str | None) -> str | None:
    """Decomposed form in which look-alike characters are one; None stays None, "" stays ""."""
    if text is None or text.isascii():
        return text
    return unicodedata.normalize("NFD", _replaced(unicodedata.normalize("NFD", text)))


def consistent(text: str | None) -> str | None:
    """The skeleton composed again: the form in which all texts are written and compared."""
    if text is None or text.isascii():
        return text
    return unicodedata.normalize("NFC", skeleton(text))


def _digest(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


@F.pandas_udf(T.StringType())
def consistent_udf(texts: pd.Series) -> pd.Series:
    return texts.map(consistent, na_action="ignore")


@F.pandas_udf(T.StructType([T.StructField("look", T.BinaryType()), T.StructField("exact", T.BinaryType())]))
def _digests_udf(texts: pd.Series) -> pd.DataFrame:
    pairs = [(None, None) if t is None else (_digest(skeleton(t)), _digest(t)) for t in texts]
    return pd.DataFrame(pairs, columns=["look", "exact"])


def consistent_form(text: Column) -> Column:
    """Column of the consistent form of whole texts; null in, null out."""
    return consistent_udf(text.cast("string"))


def consistent_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, changed): every row in the consistent form.

    Null text gives null and changed = false; empty text stays empty; repeated rows stay
    repeated; other columns of df are not read.  One map stage, no shuffle.
    """
    form = consistent_form(F.col(text_col))
    return df.select(F.col(id_col), F.col(text_col).alias("_raw"), form.alias("text")).select(
        id_col, "text", F.coalesce(~F.col("_raw").eqNullSafe(F.col("text")), F.lit(False)).alias("changed")
    )


def look_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, look, exact): digests of the skeleton and of the stored text, for non-empty texts.

    Documents with equal `look` look the same.  Null and empty texts are left out; an id
    repeated with the same text counts once.  Only 16-byte digests leave the map stage.
    """
    text = F.col(text_col)
    return (
        spread(df.select(id_col, text_col).where(text.isNotNull() & (F.length(text) > 0)))
        .select(F.col(id_col).alias("id"), _digests_udf(text).alias("d"))
        .select("id", "d.look", "d.exact")
    )


def look_alike_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_a, id_b), id_a < id_b: same look, different stored text.

    A class whose texts are all equal is dropped by its distinct count before the join, so a
    boilerplate text copied a billion times meets only texts that differ from it.
    """
    classes = cut_lineage(look_classes(df, id_col, text_col))  # read four times below; 40 bytes a document
    mixed = classes.groupBy("look").agg(F.min("exact").alias("lo"), F.max("exact").alias("hi")).where("lo <> hi")
    kept = classes.join(mixed.select("look"), "look", "left_semi")
    a, b = kept.alias("a"), kept.alias("b")
    return (
        a.join(b, (F.col("a.look") == F.col("b.look")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.exact") != F.col("b.exact")))
        .select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))
        .distinct()
    )


def look_alike_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, class_id, variant_id): each document that has a look-alike, once.

    class_id is the smallest id of all that look the same, variant_id the smallest with the
    same stored text; documents with one class_id and different variant_id are the pairs of
    look_alike_pairs.  It grows with the documents, however many copies a text has.
    """
    classes = cut_lineage(look_classes(df, id_col, text_col))
    variants = classes.groupBy("look", "exact").agg(F.min("id").alias("variant_id"))
    mixed = variants.groupBy("look").agg(F.min("variant_id").alias("class_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    named = variants.join(mixed, "look")
    return classes.join(named, ["look", "exact"]).select("id", "class_id", "variant_id").distinct()
