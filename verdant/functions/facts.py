"""What a stated fact says beyond its number: movement, baseline, dimension, category, type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUM = r"(-?\d[\d,]*\.?\d*)"


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(text, pattern, group), ",", ""), F.lit("")).try_cast("double")


def interpretation(sentence: Column) -> Column:
    """struct(kind, first, second, direction): transition (from a to b), range (between a and b), change (by a) or scalar."""
    s = F.coalesce(sentence, F.lit(""))
    moved, between = rf"(?i)\bfrom\s+{_NUM}[^.;]*?\bto\s+{_NUM}", rf"(?i)\bbetween\s+{_NUM}[^.;]*?\band\s+{_NUM}"
    read = F.struct(
        _number(s, moved, 1).alias("a1"), _number(s, moved, 2).alias("b1"), _number(s, between, 1).alias("a2"), _number(s, between, 2).alias("b2"),
        _number(s, rf"(?i)\b(?:by|of)\s+{_NUM}\s*(?:%|per\s?cent|percent|bps|basis points)", 1).alias("by"),
        s.rlike(r"(?i)\b(reduc|declin|decreas|fell|fallen|lower|cut|saved)").alias("down"),
        s.rlike(r"(?i)\b(increas|rose|risen|grew|grown|improv|higher|climbed)").alias("up"),
    )

    def told(x: Column) -> Column:
        a1, b1, a2, b2, by = (x[n] for n in ("a1", "b1", "a2", "b2", "by"))
        kind = F.when(a1.isNotNull() & b1.isNotNull(), "transition").when(a2.isNotNull() & b2.isNotNull(), "range").when(by.isNotNull(), "change").otherwise("scalar")
        first = F.when(kind == "transition", a1).when(kind == "range", a2).when(kind == "change", by)
        second = F.when(kind == "transition", b1).when(kind == "range", b2)
        went = F.when((kind == "transition") & (a1 < b1), "up").when((kind == "transition") & (a1 > b1), "down")
        direction = F.coalesce(went, F.when(x["down"] & ~x["up"], "down").when(x["up"] & ~x["down"], "up"))
        return F.struct(kind.alias("kind"), first.alias("first"), second.alias("second"), direction.alias("direction"))

    return F.transform(F.array(read), told)[0]  # the patterns are matched once, however often their finds are used


def baseline_year(sentence: Column) -> Column:
    """The year a figure is compared with: "versus", "compared to", "since" or "base year"; null without one."""
    s = F.coalesce(sentence, F.lit(""))
    patterns = (r"(?i)\b(?:vs\.?|versus|against|compared (?:to|with)|relative to)\s+(?:the\s+)?(?:FY|CY)?\s?((?:19|20)\d{2})", r"(?i)\bsince\s+(?:FY|CY)?\s?((?:19|20)\d{2})", r"(?i)\bbase(?:line)?\s+year\s*(?:of\s+|:\s*|\()?(?:FY|CY)?\s?((?:19|20)\d{2})")
    return F.coalesce(*(F.nullif(F.regexp_extract(s, p, 1), F.lit("")).cast("int") for p in patterns))


def period_type(raw: Column, period: Column, sentence: Column, fact_type: Column) -> Column:
    """A stated type as it is; else target, baseline, cumulative, point_in_time, partial or full_year by what the text says."""
    text = F.lower(F.concat_ws(" ", F.coalesce(period, F.lit("")), F.coalesce(sentence, F.lit(""))))
    known = F.lower(F.trim(raw))
    return (
        F.when(known.isNotNull() & ~known.isin("", "unknown"), known)
        .when((fact_type == "target") | text.rlike(r"\bby (?:19|20)\d{2}\b"), "target")
        .when((fact_type == "baseline") | text.contains("baseline"), "baseline")
        .when(text.rlike(r"\bsince\b|\bcumulative"), "cumulative")
        .when(text.rlike(r"\bas (?:of|at|on)\b"), "point_in_time")
        .when(text.rlike(r"\b(?:q[1-4]|h[12]|quarter|half[- ]year|months ended)\b"), "partial")
        .when(text.rlike(r"(?:fy|cy)\s?20\d{2}|20\d{2}[-/]\d{2}"), "full_year")
        .otherwise("unknown")
    )


def dimension(text: Column) -> Column:
    """struct(type, member): gender, packaging material or country a figure is broken down by; the first named."""
    t = F.lower(F.coalesce(text, F.lit("")))
    female, male = t.rlike(r"\b(women|female|females)\b"), t.rlike(r"\b(men|male|males)\b")
    material = F.regexp_extract(t, r"\b(plastic|paper|glass|metal|cartonboard)\b", 1)
    country = F.regexp_extract(t, r"\bin (india|brazil|france|germany|spain|china|usa|japan)\b", 1)
    kind = F.when(female | male, "gender").when(t.contains("pack") & (material != ""), "packaging").when(country != "", "country")
    member = F.when(female, "female").when(male, "male").when(kind == "packaging", material).when(kind == "country", country)
    return F.struct(kind.alias("type"), member.alias("member"))


# The fifteen scope 3 categories in their standard order, by a word of their names.
SCOPE3_WORDS = ("purchased goods", "capital goods", "fuel", "upstream transport", "waste", "business travel", "commut", "upstream leased", "downstream transport", "processing", "use of sold", "end-of-life", "downstream leased", "franchise", "investment")


def about_scope3(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit(""))).rlike(r"scope[\s-]*3|value chain emission")


def scope3_category(name: Column, context: Column) -> Column:
    """Number of the scope 3 category a name speaks of, where name or context is about scope 3; null otherwise."""
    t = F.lower(F.coalesce(name, F.lit("")))
    about = about_scope3(F.concat_ws(" ", t, F.coalesce(context, F.lit(""))))
    stated = F.nullif(F.regexp_extract(t, r"category\s*(1[0-5]|[1-9])\b", 1), F.lit("")).cast("int")
    by_word = F.coalesce(*(F.when(t.contains(w), F.lit(i + 1)) for i, w in enumerate(SCOPE3_WORDS)))
    return F.when(about, F.coalesce(stated, by_word))


def evidence_line(text: Column, words: list[str], most: int = 200) -> Column:
    """The first line over ten characters that holds one of the words, cut to `most`; null without one."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), r"\n"), lambda x: (F.length(F.trim(x)) > 10) & F.exists(F.array(*(F.lit(w.lower()) for w in words)), lambda w: F.contains(F.lower(x), w)))
    return F.substring(F.trim(F.try_element_at(lines, F.lit(1))), 1, most)


def toc_pairs(page: Column) -> Column:
    """array<struct(title, page)> of table-of-contents lines: a title, dots or blanks, a page number."""
    pattern = r"(?m)^\s*([A-Za-z][^\n]{2,90}?)[ .·…]{2,}(\d{1,3})\s*$"
    titles = F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(pattern), F.lit(1))
    numbers = F.transform(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(pattern), F.lit(2)), lambda n: n.cast("int"))
    return F.arrays_zip(F.transform(titles, lambda t: F.trim(t)).alias("title"), numbers.alias("page"))


def heading_key(text: Column) -> Column:
    """Letters and digits of a heading, lower case, single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


# Verbs that make a metric name a statement rather than a name.
STATEMENT_VERBS = ("improved", "increased", "reduced", "achieved", "decreased", "launched", "expanded")


def name_risk(name: Column) -> Column:
    """How little a text is a metric's name: high for a verb first, digits or over six words; medium for over 40 letters or an article inside."""
    t = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    words = F.filter(F.split(t, r"[\s_]+"), lambda w: w != "")
    high = F.element_at(F.concat(words, F.array(F.lit(""))), 1).isin(*STATEMENT_VERBS) | t.rlike(r"\d{2,}") | (F.size(words) > 6)
    medium = (F.length(t) > 40) | F.exists(words, lambda w: w.isin("the", "a", "an", "our", "we"))
    return F.when(t == "", "high").when(high, "high").when(medium, "medium").otherwise("low")


def proposed_id(name: Column) -> Column:
    """An id for a metric that has none: its first five content words joined by underscores; null if there are none."""
    from verdant.functions.text import word_tokens

    return F.nullif(F.array_join(F.slice(F.filter(word_tokens(name), lambda w: ~w.rlike(r"^\d+$")), 1, 5), "_"), F.lit(""))


def singular(word: Column) -> Column:
    """A word without its plural ending: ies to y, es after s, x, z, ch or sh, else s, unless it ends in ss or us."""
    return (
        F.when(word.rlike(r"[^aeiou]ies$") & (F.length(word) > 4), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike(r"(?:s|x|z|ch|sh)es$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike(r"[^su]s$") & (F.length(word) > 3), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


# Words in place of a value, words that are numbers, ids of tables to skip, and nouns that count themselves.
JUNK_VALUE = r"(?i)^(unknown|n/?a|na|nil|none|percentage|percent|days?|years?|months?|quarters?)$"
NUMBER_WORDS = r"(?i)\b(one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|hundred|thousand|million|billion|lakh|crore|half|quarter|third|double|triple)\b"
SKIPPED_IDS = ("exchange_rate", "exchange_rates", "principal_exchange", "companies_of_the", "list_of_companies")
COUNTED_NOUNS = r"(?i)\b(lines?|plants?|facilities?|sites?|factories?|warehouses?|suppliers?|incidents?|injuries?|products?|skus?|outlets?|stores?|hubs?|depots?)\b"


def drop_reason(sentence: Column, value: Column) -> Column:
    """Why a candidate is dropped, the first that holds: no sentence, no value, a junk word, no number; null if it stays."""
    s, v = F.trim(F.coalesce(sentence, F.lit(""))), F.trim(F.coalesce(value, F.lit("")))
    return (
        F.when(s == "", "missing_source_sentence").when(v == "", "missing_raw_value_candidate").when(v.rlike(JUNK_VALUE), "junk_raw_value_candidate")
        .when(~(v.rlike("[0-9]") | v.rlike(NUMBER_WORDS)), "non_numeric_raw_value_candidate")
    )


def skipped_table(kind: Column, chunk_id: Column) -> Column:
    """Whether a chunk is a table whose id is one of those to skip."""
    hit = F.lit(False)
    for part in SKIPPED_IDS:
        hit = hit | F.lower(chunk_id).contains(part)
    return (kind == "table") & hit


def sanitised(text: Column) -> Column:
    """The trimmed text; punctuation alone and null become empty."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t.rlike(r"^[,.;:\-?()\[\]{}/\\]+$"), "").otherwise(t)


def clear_unit(unit: Column, context: Column) -> Column:
    """Whether a unit is stated, or the context names things that are counted."""
    return ~F.lower(F.trim(F.coalesce(unit, F.lit("")))).isin("", "n/a", "unknown", "not stated") | F.coalesce(context, F.lit("")).rlike(COUNTED_NOUNS)
