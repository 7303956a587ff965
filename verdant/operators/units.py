"""Quantities in common units (problem 5).

The number and the unit text of each row are read once.  Reference spellings are made by rule
from the symbols of the conversion table.  The distinct unit texts, all of them, are mapped to
these through an inverted index of character bigrams, a count filter and a weighted edit
distance; the alias dictionary that results is joined to all rows, and the table to it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions import unit as unit_text
from verdant.functions.number import primary_number, scale_of
from verdant.functions.quantity import MAX_COST, MISSING, SCALES, SYMBOLS, read_quantity, unit_book, unit_tokens, weighted_distance
from verdant.functions.udf import once
from verdant.session import cut_lineage

_QUANTITY = T.StructType(
    [T.StructField("number", T.DoubleType()), T.StructField("beside", T.DoubleType()), T.StructField("unit_text", T.StringType()), T.StructField("found_in", T.StringType())]
)
_SPELLING = T.StructType([T.StructField("spelling", T.StringType()), T.StructField("scale", T.DoubleType()), T.StructField("symbol", T.StringType())])


def _read_udf(symbols: tuple[str, ...]):
    @F.pandas_udf(_QUANTITY)
    def run(value: pd.Series, unit: pd.Series, metric: pd.Series, evidence: pd.Series) -> pd.DataFrame:
        book, none = unit_book(symbols), (None, None, None, None)
        rows = [read_quantity(*x, book) or none for x in zip(value, unit, metric, evidence)]
        return pd.DataFrame(rows, columns=["number", "beside", "unit_text", "found_in"])

    return once(run)


def _spelling_udf(symbols: tuple[str, ...]):
    @F.pandas_udf(_SPELLING)
    def run(texts: pd.Series) -> pd.DataFrame:
        """The words of a unit text and its scale, and the symbol if it is written in exactly the letters of one that lower case would hide."""
        book, rows = unit_book(symbols), []
        for text in texts:
            mega = re.sub(r"\s", "", text).replace("₂", "2").startswith("MtCO2") and "MtCO2e" in symbols
            rows.append((" ".join(unit_tokens(text)), 1.0, "MtCO2e") if mega else (*book.stem(text), None))
        return pd.DataFrame(rows, columns=["spelling", "scale", "symbol"])

    return once(run)


@once
@F.pandas_udf(T.DoubleType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_distance(x, y, MAX_COST * max(len(x), len(y))) for x, y in zip(a, b)])


def _skeleton(spelling: Column) -> Column:
    """The letters and digits that no cheap edit touches: without blanks, vowels, s, and doubled letters."""
    bare = F.regexp_replace(spelling, "[ aeious]", "")
    return F.when(spelling == "", "").otherwise(F.concat(F.lit("^"), F.regexp_replace(bare, r"(.)\1+", "$1"), F.lit("$")))


def _bigrams(skeleton: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(skeleton) - 1), lambda i: F.substring(skeleton, i, F.lit(2))))


def unit_dictionary(texts: DataFrame, text_col: str = "unit_text", symbols: tuple[str, ...] = SYMBOLS) -> DataFrame:
    """(unit_text, symbol, scale, cost): every distinct unit text that denotes a unit.

    cost is the weighted edit distance to the reference spelling, 0.0 for that spelling
    itself.  Texts that denote none are absent.  Ties go to the shorter and then smaller
    reference spelling.  The reference is made from the symbols of the conversion table, a
    fixed list, and is broadcast.
    """
    spark = texts.sparkSession
    distinct = texts.select(F.col(text_col).alias("unit_text")).where("unit_text is not null and trim(unit_text) <> ''").distinct()
    looked = distinct.withColumn("u", _spelling_udf(symbols)("unit_text")).select("unit_text", "u.*")
    looked = cut_lineage(looked.withColumn("skeleton", _skeleton(F.col("spelling"))).where("spelling <> '' or symbol is not null"))
    sure = looked.where("symbol is not null").select("unit_text", "symbol", "scale", F.lit(0.0).alias("cost"))
    odd = looked.where("symbol is null").select("spelling", "skeleton").distinct()

    known = spark.createDataFrame(list(unit_book(symbols).plain.items()), "name string, known string")
    known = known.withColumn("known_skeleton", _skeleton(F.col("name"))).withColumn("gram", F.explode(_bigrams(F.col("known_skeleton"))))
    most = MAX_COST * F.greatest(F.length("spelling"), F.length("name"))
    a, b = F.length("skeleton"), F.length("known_skeleton")
    # An edit changes the skeleton's length by at most its cost, and spoils at most two bigrams for each 1 it costs.
    grams = odd.withColumn("gram", F.explode(_bigrams(F.col("skeleton")))).join(F.broadcast(known), "gram").where(F.abs(a - b) <= most)
    shared = grams.groupBy("spelling", "skeleton", "name", "known", "known_skeleton").agg(F.count(F.lit(1)).alias("shared"))
    # One more is left for bigrams that occur twice.
    near = shared.where(F.col("shared") >= F.greatest(a, b) - 2 - F.floor(2 * most))
    near = near.withColumn("cost", _distance("spelling", "name")).where(F.col("cost") <= most)
    best = Window.partitionBy("spelling").orderBy("cost", F.length("name"), "name")
    found = near.withColumn("n", F.row_number().over(best)).where("n = 1").select("spelling", F.col("known").alias("symbol"), "cost")
    fuzzy = looked.where("symbol is null").drop("symbol").join(found, "spelling")
    return sure.unionByName(fuzzy.select("unit_text", "symbol", "scale", "cost"))


def table_symbols(conversion: DataFrame) -> tuple[str, ...]:
    """The symbols of a conversion table, a fixed list of some dozens."""
    return tuple(sorted(r[0] for r in conversion.select("from_symbol").where("from_symbol is not null").distinct().collect()))


def read_quantities(
    rows: DataFrame, key: str, value: str, unit: str, metric: str | None = None, evidence: str | None = None, symbols: tuple[str, ...] = SYMBOLS
) -> DataFrame:
    """(key, number, beside, unit_text, found_in) of each distinct key whose value has a number.

    See read_quantity for where the unit is taken from.  The longer texts are handed to
    Python only where the unit column states none, by the same test as read_quantity.
    """
    nothing = F.lit(None).cast("string")
    word = F.lower(F.regexp_replace(F.coalesce(F.col(unit).cast("string"), F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))
    stated = ~word.isin(*sorted(MISSING))
    q = _read_udf(symbols)(
        F.col(value).cast("string"),
        F.col(unit).cast("string"),
        F.when(~stated, F.col(metric)) if metric else nothing,
        F.when(~stated, F.col(evidence)) if evidence else nothing,
    )
    read = rows.where(F.col(key).isNotNull()).select(F.col(key), q.alias("q")).where("q.number is not null")
    return read.select(key, "q.*").dropDuplicates([key])


def common_quantities(read: DataFrame, conversion: DataFrame, key: str) -> DataFrame:
    """(key, number, unit_text, found_in, unit_family, symbol, common_value, common_unit, cost).

    Rows without a recognisable unit keep null in the last five.  A hot unit text is one row
    of the dictionary, which is joined to all rows; the join splits a skewed side under AQE.
    """
    read = cut_lineage(read)  # the texts are read once, for the dictionary and for the rows
    units = unit_dictionary(read, symbols=table_symbols(conversion))
    table = conversion.select("unit_family", F.col("from_symbol").alias("symbol"), F.col("to_symbol").alias("common_unit"), "factor").dropDuplicates(["symbol"])
    known = units.join(table, "symbol", "left")
    joined = read.join(known, "unit_text", "left")
    value = F.col("number") * F.col("beside") * F.col("scale") * F.col("factor")
    return joined.select(key, "number", "unit_text", "found_in", "unit_family", "symbol", value.alias("common_value"), "common_unit", "cost")


def check_observations(observations: DataFrame, facts: DataFrame, conversion: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """(obs_id, source_fact_id, common_value, common_unit, normalised_value, verdict) of each observation.

    The quantity is the one stated by the source fact.  verdict: `fill` where
    normalised_value is null or NaN, `wrong` where it is off by more than the tolerance,
    `right`, or `unknown` where the fact states no quantity.
    """
    read = read_quantities(facts, "fact_id", "value", "unit", "metric", "evidence", table_symbols(conversion))
    common = common_quantities(read, conversion, "fact_id").where("common_value is not null")
    obs = observations.select("obs_id", "source_fact_id", "normalised_value").dropDuplicates(["obs_id"])
    joined = obs.join(common, obs["source_fact_id"] == common["fact_id"], "left")
    own, stated = F.col("normalised_value"), F.col("common_value")
    verdict = (
        F.when(stated.isNull(), "unknown")
        .when(own.isNull() | F.isnan(own), "fill")
        .when(F.abs(own - stated) > tolerance * F.abs(stated), "wrong")
        .otherwise("right")
    )
    return joined.select("obs_id", "source_fact_id", "common_value", "common_unit", "normalised_value", verdict.alias("verdict"))


def unit_names(conversion: DataFrame) -> DataFrame:
    """(name, symbol, factor, family): every reference spelling without blanks, with the common unit it is brought to.

    Made by rule from the symbols of the conversion table; a fixed list, which is broadcast.
    """
    symbols = table_symbols(conversion)
    spark = conversion.sparkSession
    known = spark.createDataFrame(list(unit_book(symbols).plain.items()), "spelling string, from_symbol string")
    table = conversion.select("from_symbol", F.col("to_symbol").alias("symbol"), "factor", F.col("unit_family").alias("family")).dropDuplicates(["from_symbol"])
    keyed = known.join(table, "from_symbol").select(F.replace(unit_text.unit_key(F.col("spelling")), F.lit(" "), F.lit("")).alias("name"), "from_symbol", "symbol", "factor", "family")
    return keyed.groupBy("name").agg(F.min_by(F.struct("symbol", "factor", "family"), "from_symbol").alias("u")).select("name", "u.*")


def normalise_units(rows: DataFrame, conversion: DataFrame, key: str, value: str, raw: str, name: str, sentence: str) -> DataFrame:
    """(key, value, symbol, confidence) of each row: its value in the common unit of its family.

    The unit's words are looked up as they stand (exact), else behind or before a scale word, as
    an intensity for a tonne (kept at its scale) or for money (per million), or as a mass of CO2;
    then name and sentence may say percent or basis points, and a unit of plain words counts
    things (all inferred).  A blank unit or a dash is a count where the name counts things, else
    needs_context; anything else is failed, without value and symbol.  A known unit without a
    single number needs_context.  Four lookups in a broadcast list; no row goes to Python.
    """
    names = F.broadcast(unit_names(conversion))
    k, context = F.col("_k"), F.concat_ws(" ", F.coalesce(F.col(raw), F.lit("")), F.coalesce(F.col(name), F.lit("")), F.coalesce(F.col(sentence), F.lit("")))
    before, behind = rf"^({unit_text.SCALE_WORDS}) (.+)$", rf"^(.+) ({unit_text.SCALE_WORDS})$"
    scales = F.create_map(*(F.lit(x) for pair in SCALES.items() for x in pair))
    per_money = rf"^(.+) per (?:({unit_text.SCALE_WORDS}) )?(?:{unit_text.MONEY})(?: ({unit_text.SCALE_WORDS}))?$"
    parts = {
        "a": (k, F.lit(1.0)),
        "b": (F.when(k.rlike(before), F.regexp_extract(k, before, 2)).when(k.rlike(behind), F.regexp_extract(k, behind, 1)), F.try_element_at(scales, F.coalesce(F.nullif(F.regexp_extract(k, before, 1), F.lit("")), F.regexp_extract(k, behind, 2)))),
        "c": (F.regexp_extract(k, r"^(.+) per (?:t|ton|tonne|mt|metric ton|metric tonne)$", 1), F.lit(1.0)),
        "d": (F.regexp_extract(k, per_money, 1), 1e6 / F.coalesce(F.try_element_at(scales, F.regexp_extract(k, per_money, 2)), F.try_element_at(scales, F.regexp_extract(k, per_money, 3)), F.lit(1.0))),
        "e": (F.regexp_extract(k, r"^(.+?) ?co2 ?(?:e|eq|equivalent)?$", 1), F.lit(0.001)),
    }
    out = rows.withColumn("_k", unit_text.unit_key(F.col(raw)))
    for tag, (part, times) in parts.items():
        known = names.select(F.col("name").alias(f"_{tag}n"), F.struct("symbol", "factor", "family").alias(f"_{tag}"))
        out = out.withColumns({f"_{tag}k": F.replace(part, F.lit(" "), F.lit("")), f"_{tag}t": times}).join(known, F.col(f"_{tag}k") == F.col(f"_{tag}n"), "left")
    blank = F.trim(F.coalesce(F.col(raw), F.lit(""))).isin("", "-", "–", "—")
    plain = k.rlike("^[a-z ]+$") & ~k.rlike(r"\b(per|ratio|index|rate|times)\b")

    def found(symbol: Column | str, factor: Column | float, how: str) -> Column:
        return F.struct((F.lit(symbol) if isinstance(symbol, str) else symbol).alias("symbol"), (F.lit(factor) if isinstance(factor, float) else factor).cast("double").alias("factor"), F.lit(how).alias("how"))

    nothing = F.lit(None).cast("string")
    hit = (
        F.when(blank & F.coalesce(F.col(name), F.lit("")).rlike(unit_text.COUNTED), found("count", 1.0, "inferred"))
        .when(blank, found(nothing, 1.0, "needs_context"))
        .when(F.col("_a").isNotNull(), found(F.col("_a.symbol"), F.col("_a.factor"), "exact"))
        .when(F.col("_b").isNotNull() & F.col("_bt").isNotNull(), found(F.col("_b.symbol"), F.col("_b.factor") * F.col("_bt"), "inferred"))
        .when(k.isin(*SCALES), found("count", F.try_element_at(scales, k), "inferred"))
        .when(F.col("_c").isNotNull(), found(F.concat("_c.symbol", F.lit("/tonne")), 1.0, "inferred"))
        .when(F.col("_d").isNotNull(), found(F.concat("_d.symbol", F.lit("/MINR")), F.col("_d.factor") * F.col("_dt"), "inferred"))
        .when(F.col("_e").isNotNull() & (F.col("_e.family") == "weight"), found("tCO2e", F.col("_e.factor") * F.col("_et"), "inferred"))
        .when(k.rlike(r"\bjoule\b.*\bmultiple\b"), found("GJ", 1.0, "inferred"))
        .when(context.rlike(unit_text.SHARE), found("%", 1.0, "inferred"))
        .when(context.rlike(unit_text.POINTS), found("%", 0.01, "inferred"))
        .when(plain, found("count", 1.0, "inferred"))
        .otherwise(found(nothing, 1.0, "failed"))
    )
    number = primary_number(F.col(value), F.col(sentence)) * scale_of(F.col(value), F.lit(""))
    out = out.withColumns({"_u": hit, "_x": number})
    known = F.col("_u.how").isin("exact", "inferred")
    common = F.when(known, F.when(F.col("_u.symbol") == "%", F.col("_x") * F.when(F.col("_u.factor") < 1, F.col("_u.factor")).otherwise(1.0)).otherwise(F.col("_x") * F.col("_u.factor")))
    how = F.when(known & F.col("_x").isNull(), "needs_context").otherwise(F.col("_u.how"))
    return out.select(F.col(key).alias("key"), common.alias("value"), F.col("_u.symbol").alias("symbol"), how.alias("confidence"))
