"""From a question in words to a prepared query; a guard for free SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.plans import catalogue
from verdant.sources import TABLES, read_table

_WRITES = re.compile(r"\b(insert|update|delete|merge|drop|create|alter|truncate|replace|grant|revoke|set|add|cache|refresh|load)\b", re.I)


def check_read_only(sql: str) -> str:
    """The statement, if it is a single SELECT or WITH that changes nothing; ValueError otherwise."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/", " ", sql, flags=re.S).strip().rstrip(";").strip()
    plain = re.sub(r"'(?:[^']|'')*'", "''", bare)
    if ";" in plain:
        raise ValueError("only one statement is allowed")
    if not re.match(r"(?i)(select|with)\b", plain):
        raise ValueError("only SELECT and WITH are allowed")
    if m := _WRITES.search(plain):
        raise ValueError(f"{m.group(1).upper()} is not allowed")
    return bare


def run_sql(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """A read-only statement over the tables of the folder."""
    statement = check_read_only(sql)
    for name in TABLES:
        if re.search(rf"\b{name}\b", statement):
            read_table(spark, folder, name).createOrReplaceTempView(name)
    return spark.sql(statement)


def route(spark: SparkSession, folder: str, question: str) -> DataFrame:
    """The prepared query a question asks for: over time or across companies, for a metric, year and company it names."""
    text = question.lower()
    over_time = re.search(r"\b(trend|over time|by year|time series|history|since)\b", text)
    out = catalogue.queries()["metric_time_series" if over_time else "cross_company_compare"](spark, folder)
    registry = read_table(spark, folder, "consumer_master_registry_v1").select("canonical_id", "display_name", "aliases")
    names = registry.select("canonical_id", F.explode(F.concat(F.array("display_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    # The longest name that the question holds; only that one row comes here, however long the registry is.
    named = names.where((F.length("name") > 0) & F.contains(F.lit(text), F.lower("name"))).orderBy(F.desc(F.length("name")), "name", "canonical_id").first()
    if named is None:
        raise ValueError("the question names no metric of the registry")
    out = out.where(out["canonical_id"] == named["canonical_id"])
    if m := re.search(r"\b(?:(fy|cy)\s?)?(20\d{2})\b", text):
        out = out.where(out["period"].endswith(m.group(2)))
    if m := re.search(r"\bco_\d+\b", text):
        out = out.where(out["company_id"] == m.group())
    return out
