"""Problem 2: one surviving record for each group of duplicates, chosen field by field.

Method: the fields of a record are unpivoted to long rows (group, field, value); each row
votes for its normalised value with source trust times recency decay; votes are summed per
(group, field, normalised value), the winner of each field is taken by max_by, and the
winners are pivoted back to one row a group.

All steps are aggregations with map-side partial sums; only the rows of groups of two or more
records are unpivoted, and only those leave the place where they were read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.session import cut_lineage, small_join, stored

LEAST = -1.7976931348623157e308


@dataclass(frozen=True)
class Field:
    """One field of the surviving record.

    value: what is kept, null gives no vote; vote: trust of the record for this field, null
    counts as 0; normalised: what counts as the same value, the value itself unless given;
    order: numbers that break ties of the vote, each larger first, null last.
    """

    name: str
    value: Column
    vote: Column
    normalised: Column | None = None
    order: tuple[Column, ...] = ()


def trust_of_confidence(confidence: Column) -> Column:
    """The confidence where it is a number from 0 to 1; anything else is -1, below all others."""
    value = confidence.cast("double")
    return F.when(value.isNotNull() & ~F.isnan(value) & value.between(0.0, 1.0), value).otherwise(-1.0)


def recency_decay(moment: Column, newest: Column, half_life_days: float) -> Column:
    """0.5 ** (age in days / half_life_days); a null moment decays fully to 0."""
    age = (F.unix_micros(newest.cast("timestamp")) - F.unix_micros(moment.cast("timestamp"))) / 86_400_000_000.0
    return F.coalesce(F.pow(F.lit(0.5), F.greatest(age, F.lit(0.0)) / half_life_days), F.lit(0.0))


def plain_number(text: Column) -> Column:
    """Plain decimal text without commas and spaces in one spelling (1,200.50 -> 1200.5), else null."""
    bare = F.regexp_replace(text.cast("string"), "[, ]", "")
    whole = F.regexp_replace(F.regexp_extract(bare, r"^-?(\d+)", 1), r"^0+(?=\d)", "")
    part = F.regexp_replace(F.regexp_extract(bare, r"\.(\d+)$", 1), "0+$", "")
    number = F.concat(whole, F.when(part == "", "").otherwise(F.concat(F.lit("."), part)))
    sign = F.when(bare.startswith("-") & (number != "0"), "-").otherwise("")
    return F.when(bare.rlike(r"^-?\d+(\.\d+)?$"), F.concat(sign, number))


def fact_group_key(facts: DataFrame) -> Column:
    """Digest of what makes facts of one report the same fact; null where the fact takes no part."""
    metric = F.regexp_replace(F.lower("metric"), "[^a-z0-9]", "")
    number = plain_number(F.col("value"))
    unit = F.lower(F.trim(F.coalesce("unit", F.lit(""))))
    parts = F.concat_ws("\x1f", "doc_id", metric, F.coalesce("period", F.lit("")), number, unit)
    return F.when(F.col("doc_id").isNotNull() & (metric != "") & number.isNotNull(), F.unhex(F.md5(parts)))


def best_records(records: DataFrame, group: Column, record_id: str, fields: list[Field], carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per group of two or more distinct record ids: group_key, members, the fields, the carried aggregates.

    Rows repeating a record id count once, with one of their rows.  Rows whose group or id
    is null take no part.  A field that is null in all members stays null.  Equal votes and
    order go to the smallest normalised value and then to the smallest value, so ties have
    one outcome.  An empty table gives no rows; columns not named are not read.
    """
    columns: dict[str, Column] = {"_group": group, "_id": F.col(record_id)}
    for i, f in enumerate(fields):
        same = f.normalised if f.normalised is not None else f.value
        rank = F.array(*(F.coalesce(o.cast("double"), F.lit(LEAST)) for o in f.order)) if f.order else F.array(F.lit(0.0))
        columns |= {f"_v{i}": f.value.cast("string"), f"_n{i}": same.cast("string"), f"_w{i}": F.coalesce(f.vote.cast("double"), F.lit(0.0)), f"_o{i}": rank}
    columns |= {f"_c_{name}": value for name, value in (carry or {}).items()}
    base = records.select(*(c.alias(n) for n, c in columns.items())).where(F.col("_group").isNotNull() & F.col("_id").isNotNull())
    # Groups of one record are most of them: they are told apart by two columns, before any text moves.
    several = base.groupBy("_group").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi")).where("lo <> hi").select("_group")
    base = stored(small_join(base, cut_lineage(several), ["_group"], "left_semi").dropDuplicates(["_id"]))

    unpivoted = F.array(*(F.struct(F.lit(i).alias("field"), F.col(f"_n{i}").alias("norm"), F.col(f"_v{i}").alias("value"), F.col(f"_w{i}").alias("vote"), F.col(f"_o{i}").alias("rank")) for i in range(len(fields))))
    long = base.select("_group", F.inline(unpivoted)).where("value is not null")
    votes = long.groupBy("_group", "field", "norm").agg(
        F.sum("vote").alias("vote"), F.max("rank").alias("rank"), F.max_by("value", F.struct("rank", _reversed(F.col("value")).alias("v"))).alias("value")
    )
    won = votes.groupBy("_group", "field").agg(F.max_by("value", F.struct("vote", "rank", _reversed(F.col("norm")).alias("n"))).alias("value"))
    wide = won.groupBy("_group").agg(*(F.max(F.when(F.col("field") == i, F.col("value"))).alias(f.name) for i, f in enumerate(fields)))
    carried = base.groupBy("_group").agg(F.count(F.lit(1)).alias("members"), *(F.array_sort(F.collect_set(f"_c_{n}")).alias(n) for n in (carry or {})))
    return carried.join(wide, "_group").withColumnRenamed("_group", "group_key")


def _reversed(text: Column) -> Column:
    """Text that sorts by code point in the opposite direction, so that max prefers the smaller original."""
    return F.concat(F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


# Trust of the ways in which a fact got into the table, where no other is given.
SOURCE_TRUST = {"keep": 1.0, "rescue": 0.5, "drop": 0.25}


def merge_facts(facts: DataFrame, half_life_days: float = 365.0, source_col: str = "decision", source_trust: dict[str, float] | None = None) -> DataFrame:
    """The surviving record of each group of extracted facts of one report (see fact_group_key).

    fact_id and chunk_id are those of the record with the best confidence, then the longest
    evidence, the latest extraction and the smallest id; evidence is the longest;
    evidence_fact_id is where it stands.  Each of the descriptive fields is voted on: a record
    gives its value the trust of its source (source_trust of source_col, 1 for a source not
    listed) times 0.5 ** (age / half_life_days), age counted from the newest record of the
    table; votes for values that are equal without case and outer blanks are summed, and the
    value with most wins.  duplicate_chunk_ids lists every other chunk of the group once; its
    rows one by one are duplicate_chunks().
    """
    newest = facts.agg(F.max("extracted_at")).scalar()
    trust = trust_of_confidence(F.col("confidence"))
    size = F.coalesce(F.char_length(F.trim("evidence")), F.lit(0))
    moment = F.unix_micros(F.col("extracted_at").cast("timestamp"))
    listed = SOURCE_TRUST if source_trust is None else source_trust
    source = F.coalesce(*(F.when(F.col(source_col) == k, F.lit(float(v))) for k, v in listed.items()), F.lit(1.0))
    weight = source * recency_decay(F.col("extracted_at"), newest, half_life_days)
    own = F.col("fact_id")
    plain = [Field(c, F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), weight, F.lower(F.trim(F.col(c).cast("string")))) for c in ("company_id", "metric", "value", "unit", "period", "period_type", "fact_type", "entity", "segment", "page_start", "page_end")]
    fields = [
        *survivor_fields(),
        Field("chunk_id", F.col("chunk_id"), trust, own, (size, moment)),
        Field("doc_id", F.col("doc_id"), trust),
        Field("evidence", F.nullif(F.trim("evidence"), F.lit("")), size, own),
        Field("confidence", F.when(trust >= 0, trust), trust, own),
        *plain,
    ]
    merged = best_records(facts, fact_group_key(facts), "fact_id", fields, {"chunks": F.col("chunk_id")})
    return merged.withColumns({"duplicate_chunk_ids": F.array_except("chunks", F.array("chunk_id")), "confidence": F.col("confidence").cast("double")}).drop("chunks", "group_key")


def duplicate_chunks(facts: DataFrame) -> DataFrame:
    """(fact_id, chunk_id): the survivor of each group and every other chunk of it once, one row each.

    The same as duplicate_chunk_ids, for groups too large for one array.
    """
    keyed = facts.select(fact_group_key(facts).alias("group_key"), "chunk_id").where("group_key is not null and chunk_id is not null").distinct()
    size = F.coalesce(F.char_length(F.trim("evidence")), F.lit(0))
    moment = F.unix_micros(F.col("extracted_at").cast("timestamp"))
    own = F.col("fact_id")
    home = Field("home", F.col("chunk_id"), trust_of_confidence(F.col("confidence")), own, (size, moment))
    best = best_records(facts, fact_group_key(facts), "fact_id", [survivor_fields()[0], home]).select("group_key", "fact_id", "home")
    return keyed.join(best, "group_key").where(~F.col("chunk_id").eqNullSafe(F.col("home"))).select("fact_id", "chunk_id")


def survivor_fields() -> list[Field]:
    """The survivor's fact_id and the fact_id that holds the most complete evidence."""
    size = F.coalesce(F.char_length(F.trim("evidence")), F.lit(0))
    moment = F.unix_micros(F.col("extracted_at").cast("timestamp"))
    own = F.col("fact_id")
    return [Field("fact_id", own, trust_of_confidence(F.col("confidence")), own, (size, moment)), Field("evidence_fact_id", own, size, own)]
