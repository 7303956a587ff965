"""Fiscal periods: labels, bounds and resolution, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that state no year.
NO_YEAR = ("", "unknown", "none", "open_ended")


def report_label(year: Column, calendar_type: Column) -> Column:
    """CYyyyy for a calendar-year report, else FYyyyy."""
    return F.concat(F.when(calendar_type == "calendar_year", "CY").otherwise("FY"), year.cast("string"))


def normalise_label(raw: Column, report_year: Column, calendar_type: Column) -> Column:
    """Label of a loaded period: the report's for a label without a year, FY20zz for 20yy-zz, else the last stand-alone year."""
    own = report_label(report_year, calendar_type)
    years = F.regexp_extract_all(raw, F.lit(r"\b(20\d{2})\b"), F.lit(1))
    return (
        F.when(raw.isNull() | F.lower(raw).isin(*NO_YEAR), own)
        .when(raw.rlike(r"20\d{2}[-/]\d{2}"), F.concat(F.lit("FY20"), F.regexp_extract(raw, r"20\d{2}[-/](\d{2})", 1)))
        .when(F.size(years) > 0, report_label(F.element_at(years, -1), calendar_type))
        .otherwise(own)
    )


def period_key(label: Column, document_period: Column) -> Column:
    """FYyyyy or CYyyyy of an observation: its label if it is one, FY20zz for 20yy-zz, else the document's."""
    range_end = F.regexp_extract(label, r"^20\d{2}[-/](\d{2})$", 1)
    return F.when(label.rlike(r"^(FY|CY)20\d{2}$"), label).when(range_end != "", F.concat(F.lit("FY20"), range_end)).otherwise(document_period)


def label_year(label: Column) -> Column:
    """The year of a period label; null without one."""
    return F.nullif(F.regexp_extract(label, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int")


def document_year(document_id: Column) -> Column:
    """Fiscal year in a document id (..._fy2022_...), 0 where there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(document_id, r"fy(\d{4})", 1), F.lit("")).cast("int"), F.lit(0))


def fiscal_bounds(year: Column, end_month: Column) -> tuple[Column, Column]:
    """First and last day of the fiscal year that ends in end_month of `year`."""
    last = F.last_day(F.make_date(year, end_month, F.lit(1)))
    first = F.date_add(F.add_months(F.last_day(F.make_date(year, end_month, F.lit(1))), -12), 1)
    first = F.trunc(first, "month")
    return F.when(end_month == 12, F.make_date(year, F.lit(1), F.lit(1))).otherwise(first), last


def quarter_bounds(year: Column, end_month: Column, quarter: Column) -> tuple[Column, Column]:
    """First and last day of quarter 1-4 of that fiscal year."""
    start, _ = fiscal_bounds(year, end_month)
    first = F.add_months(start, (quarter - 1) * 3)
    return first, F.last_day(F.add_months(first, 2))


def infer_label(raw: Column, sentence: Column, document_period: Column) -> tuple[Column, Column]:
    """(label, extracted or inferred): fiscal label, calendar label, range, bare year, then the document's."""

    def read(text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        fy, cy = F.regexp_extract(text, r"(?i)FY\s?(20\d{2})", 1), F.regexp_extract(text, r"(?i)CY\s?(20\d{2})", 1)
        rng = F.regexp_extract(text, r"20\d{2}[-/](\d{2})(?!\d)", 1)
        bare = F.regexp_extract(text, r"(?<!\d)(20\d{2})(?!\d)", 1)
        prefix = F.substring(document_period, 1, 2)
        return (
            F.when(fy != "", F.concat(F.lit("FY"), fy)).when(cy != "", F.concat(F.lit("CY"), cy)).when(rng != "", F.concat(F.lit("FY20"), rng))
            .when((bare != ""), F.concat(prefix, bare))
        )

    own, stated = read(raw), read(sentence)
    fixed = F.lower(F.trim(F.coalesce(raw, F.lit("")))).isin("current", "ongoing", "current year", "reporting year", "this year")
    open_ended = F.lower(F.coalesce(raw, F.lit(""))).isin("open-ended", "open_ended")
    label = F.when(open_ended, "open_ended").when(fixed, document_period).otherwise(F.coalesce(own, stated, document_period))
    found = ~open_ended & ~fixed & F.coalesce(own, stated).isNotNull()
    return label, F.when(found, "extracted").otherwise("inferred")


def resolve_bounds(label: Column, period_type: Column, end_month: Column) -> Column:
    """struct(start, end, resolution) of a label: full years have both bounds, targets and points only the end."""
    year = label_year(label)
    month = F.when(label.startswith("CY"), 12).otherwise(end_month)
    start, end = fiscal_bounds(year, month)
    kind = F.coalesce(period_type, F.lit("unknown"))
    none = F.lit(None).cast("date")
    dated = year.isNotNull()
    s = F.when(dated & kind.isin("full_year", "baseline"), start).otherwise(none)
    e = F.when(dated & (kind == "target"), F.make_date(year, F.lit(12), F.lit(31))).when(dated & kind.isin("full_year", "baseline", "point_in_time"), end).otherwise(none)
    how = F.when(e.isNull(), "unresolvable").when(kind == "target", "end_only").when(kind == "point_in_time", "point").otherwise("range")
    return F.struct(s.alias("start"), e.alias("end"), how.alias("resolution"))


# How a text states a year, and strings that state none.
FISCAL, CALENDAR = r"(?i)\bFY\s*([12][90]\d{2})\b", r"(?i)\bCY\s*([12][90]\d{2})\b"
YEAR_RANGE = r"(?i)\b(?:FY\s*)?([12][90]\d{2})\s*[-/]\s*(\d{4}|\d{2})\b"
AS_OF = r"(?i)\bas of\b[^.:\n]{0,40}\b([12][90]\d{2})\b"
BARE_YEAR, BY_YEAR, SINCE_YEAR = r"((?:19|20)\d{2})", r"(?i)\bby\s+([12][90]\d{2})\b", r"(?i)\bsince\s+([12][90]\d{2})\b"
QUARTER, MONTH = r"(?i)\bQ([1-4])\b", r"(?i)\b(january|february|march|april|may|june|july|august|september|october|november|december)\b"
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
NO_YEAR_STRINGS = (
    "current", "ongoing", "present", "now", "currently", "current year", "this year", "annual", "yearly", "as of date", "as at", "to date", "cumulative",
    "rolling", "continuous", "permanent", "indefinite", "open ended", "open-ended", "no fixed date", "not applicable", "year", "period", "reporting period",
    "reporting year",
)
OPEN_ENDED_STRINGS = ("open ended", "open-ended", "no fixed date", "indefinite", "permanent")


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), pattern, group), F.lit(""))


def period_kind(document_period: Column) -> Column:
    return F.when(F.upper(F.coalesce(document_period, F.lit(""))).startswith("FY"), "FY").otherwise("CY")


def year_token(text: Column, kind: Column) -> Column:
    """FYyyyy or CYyyyy that a text states: fiscal, calendar, the end of a range, "as of", then any year; null without one."""
    start, end = _found(text, YEAR_RANGE, 1).cast("int"), _found(text, YEAR_RANGE, 2)
    century = F.floor(start / 100).cast("int") * 100 + end.cast("int")
    last = F.when(F.length(end) == 4, end.cast("int")).when(century < start, century + 100).otherwise(century)
    bare = _found(text, BARE_YEAR)
    calendar = F.coalesce(text, F.lit("")).rlike(r"(?i)\bcalendar\b")
    return F.coalesce(
        F.concat(F.lit("FY"), _found(text, FISCAL)), F.concat(F.lit("CY"), _found(text, CALENDAR)), F.concat(kind, last.cast("string")),
        F.concat(kind, _found(text, AS_OF)), F.concat(F.when(calendar, "CY").otherwise(kind), bare),
    )


def stated_label(raw: Column, sentence: Column, fact_type: Column, document_period: Column, filing_year: Column) -> tuple[Column, Column]:
    """(label, extracted or inferred).

    A period that is one of the strings without a year takes the report's, and open_ended
    for an open-ended target; any other takes the year of its own text, then of the
    sentence, then the report's.
    """
    kind = period_kind(document_period)
    own = F.coalesce(year_token(document_period, kind), F.concat(kind, filing_year.cast("string")), F.lit(""))
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(raw, F.lit("")))), r"^[.,;: ]+|[.,;: ]+$", "")
    fixed = bare.isin(*NO_YEAR_STRINGS)
    stated = F.coalesce(year_token(raw, kind), year_token(sentence, kind))
    opened = (F.lower(F.trim(F.coalesce(fact_type, F.lit("")))) == "target") & bare.isin(*OPEN_ENDED_STRINGS)
    label = F.when(fixed & opened, "open_ended").when(fixed, own).otherwise(F.coalesce(stated, own))
    return label, F.when(~fixed & stated.isNotNull(), "extracted").otherwise("inferred")


def half_bounds(year: Column, end_month: Column, half: Column) -> tuple[Column, Column]:
    """First and last day of half 1 or 2 of the fiscal year that ends in end_month of `year`."""
    start, _ = fiscal_bounds(year, end_month)
    first = F.add_months(start, (half - 1) * 6)
    return first, F.last_day(F.add_months(first, 5))


def _token_bounds(token: Column, end_month: Column) -> tuple[Column, Column]:
    year = F.substring(token, 3, 4).try_cast("int")
    return fiscal_bounds(year, F.when(token.startswith("FY"), end_month).otherwise(12))


def resolve_period(label: Column, period_type: Column, sentence: Column, document_period: Column, end_month: Column) -> Column:
    """struct(start, end, resolution) of a fact's period.

    Full years and baselines have both bounds, targets ("by 2030") the end only; cumulative
    figures run from "since" to the end of the report's year; points in time are the last day
    of the month that label or sentence name in an "as of" year; parts are the quarter or
    half that they name.  resolution is resolved, inferred or unresolvable.
    """
    kind, none = period_kind(document_period), F.lit(None).cast("date")
    both = F.concat_ws(" ", F.coalesce(label, F.lit("")), F.coalesce(sentence, F.lit("")))
    months = F.create_map(*(F.lit(x) for pair in ((m, i + 1) for i, m in enumerate(MONTH_NAMES)) for x in pair))
    read = F.struct(
        F.lower(F.trim(F.coalesce(period_type, F.lit("")))).alias("what"), year_token(label, kind).alias("own"), year_token(sentence, kind).alias("spoken"), year_token(document_period, kind).alias("report"),
        _found(both, BY_YEAR).cast("int").alias("target"), _found(both, SINCE_YEAR).cast("int").alias("since"), F.coalesce(_found(label, AS_OF), _found(sentence, AS_OF)).cast("int").alias("as_of"),
        F.coalesce(F.try_element_at(months, F.lower(_found(both, MONTH))), F.lit(12)).alias("month"), _found(both, QUARTER).cast("int").alias("quarter"),
        F.when(both.rlike(r"(?i)\bh1\b|half year"), 1).when(both.rlike(r"(?i)\bh2\b"), 2).alias("half"), end_month.cast("int").alias("end_month"),
    )

    def told(x: Column) -> Column:
        what, quarter, since, token, month = x["what"], x["quarter"], x["since"], F.coalesce(x["own"], x["spoken"]), x["end_month"]
        whole, partial, fiscal = what.isin("full_year", "baseline"), what == "partial", token.startswith("FY")
        year_start, year_end = _token_bounds(F.coalesce(x["own"], x["report"]), month)
        _, report_end = _token_bounds(x["report"], month)
        point = F.last_day(F.make_date(x["as_of"], x["month"], F.lit(1)))
        year = F.substring(token, 3, 4).try_cast("int")
        q_start, q_end = quarter_bounds(year, F.when(fiscal, month).otherwise(12), quarter)
        h_start, h_end = half_bounds(year, month, x["half"])
        start = (
            F.when(whole, year_start).when((what == "cumulative") & since.isNotNull(), F.make_date(since, F.lit(1), F.lit(1))).when(what == "point_in_time", point)
            .when(partial & quarter.isNotNull(), q_start).when(partial & fiscal, h_start).otherwise(none)
        )
        end = (
            F.when(whole, year_end).when(what == "target", F.make_date(x["target"], F.lit(12), F.lit(31))).when(what == "cumulative", report_end).when(what == "point_in_time", point)
            .when(partial & quarter.isNotNull(), q_end).when(partial & fiscal, h_end).otherwise(none)
        )
        how = (
            F.when(what == "cumulative", F.when(since.isNotNull(), "resolved").when(report_end.isNotNull(), "inferred").otherwise("unresolvable"))
            .when(end.isNotNull(), "resolved").when(partial, "inferred").otherwise("unresolvable")
        )
        return F.struct(start.alias("start"), end.alias("end"), how.alias("resolution"))

    return F.transform(F.array(read), told)[0]  # the texts are searched once, however often their finds are used


def rolling_bounds(year: Column, end_month: Column, quarter: Column) -> tuple[Column, Column]:
    """First and last day of the twelve months that end with a quarter, or with the year if it is null."""
    _, year_end = fiscal_bounds(year, end_month)
    _, q_end = quarter_bounds(year, end_month, quarter)
    end = F.coalesce(q_end, year_end)
    return F.trunc(F.add_months(end, -11), "month"), end
