"""Text and page scoring functions, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that speak of quantities on a page.
QUANTITY_PATTERNS = (
    r"\d[\d,\.]+\s*(?:tCO2e|tco2e|kL|kilolitre|MJ|GJ|TJ|kWh|MWh|MT\b)",
    r"(?:metric\s+ton|metric\s+tonne|kilolitre|gigajoule|megajoule)",
    r"\d[\d,\.]+\s*(?:kt\s|Kt\s)",
    r"scope\s+[123]\s+emission",
    r"water\s+withdrawal.*\d",
    r"energy\s+consumption.*\d",
)
# Words one of which each of these patterns needs.
QUANTITY_LITERALS = (
    ("tco2e", "kl", "kilolitre", "mj", "gj", "tj", "kwh", "mwh", "mt"), ("metric", "kilolitre", "gigajoule", "megajoule"), ("kt",),
    ("scope",), ("withdrawal",), ("consumption",),
)
# Phrases of pages to leave out, and their weights.
EXCLUDED_PHRASES = {
    "independent auditor": 7, "financial statements": 7, "consolidated financial": 7, "standalone financial": 7, "notes to accounts": 6,
    "notes to the financial": 6, "balance sheet": 6, "statement of profit and loss": 6, "cash flow statement": 6, "shareholding": 5,
    "notice": 4, "proxy": 4, "secretarial audit": 5, "directors' report": 3, "board's report": 3,
}
# What counts as a numeric token.
NUMERIC_TOKEN = r"\b\d[\d,]*(?:\.\d+)?%?\b|%|\b(?:tonnes?|tons?|tco2e|co2e|kl|kilolitres?|gj|gigajoules?|mw|megawatts?|crore|lakhs?|million|billion)\b"
STOPWORDS = "the a an of and or to for in on by with within from that this is are be".split()


def token_estimate(text: Column) -> Column:
    """0 for empty text, else floor((characters + 3) / 4), at least 1; null stays null."""
    n = F.char_length(text)
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor((n + 3) / 4))).cast("int")


def normalise_space(text: Column) -> Column:
    """No-break blanks become blanks, runs of blanks and tabs one; line breaks stay."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, " ", " "), r"[ \t]+", " "))


def quantity_score(text: Column) -> Column:
    """Matches of all quantity patterns, whatever the case."""
    lower, score = F.lower(text), F.lit(0)
    for pattern, words in zip(QUANTITY_PATTERNS, QUANTITY_LITERALS, strict=True):
        held = F.lit(False)  # a pattern is tried only where the text holds a word that it needs
        for word in words:
            held = held | lower.contains(word)
        score = score + F.when(text.isNotNull() & ~held, 0).otherwise(F.regexp_count(text, F.lit(f"(?i){pattern}")))
    return score


# Signs and words that make a number on a page a quantity.
QUANTITY_WORDS = (
    r"[%₹$€£]|\b(?:crore|lakh|million|billion|tonnes?|tons?|kg|kl|litres?|employees?|workers?|sites?|plants?|factories?|facilities?|"
    r"stores?|outlets?|suppliers?|hours?|days?|women|men|co2|co2e)\b"
)


def states_quantity(text: Column) -> Column:
    """Whether a text holds a digit and a sign or word of quantity; null text holds none."""
    return F.coalesce(text.rlike("[0-9]") & text.rlike(f"(?i){QUANTITY_WORDS}"), F.lit(False))


def phrase_score(text: Column, weights: dict[str, int]) -> Column:
    """Sum of the weights of the phrases that occur, each once."""
    lower = F.lower(text)
    score = F.lit(0)
    for phrase, weight in weights.items():
        score = score + F.when(lower.contains(phrase), weight).otherwise(0)
    return score


def numeric_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"(?i){NUMERIC_TOKEN}"))


def keyword_weight(term: Column) -> Column:
    """3 for a term with a digit, slash, percent sign or two blanks; 2 for one blank or 12 letters; else 1; 0 if blank."""
    t = F.lower(F.trim(term))
    blanks = F.regexp_count(t, F.lit(" "))
    return F.when(t.isNull() | (t == ""), 0).when(t.rlike(r"\d|/|%") | (blanks >= 2), 3).when((blanks == 1) | (F.length(t) >= 12), 2).otherwise(1)


def word_tokens(text: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-case text, stopwords dropped."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(words, lambda w: ~w.isin(*STOPWORDS))


def keyword_hits(text: Column, keywords: Column) -> Column:
    """How often the keywords of an array occur: phrases anywhere, single words between other characters than a-z and 0-9."""
    lower = F.lower(text)

    def hits(word: Column) -> Column:
        quoted = F.concat(F.lit(r"\Q"), word, F.lit(r"\E"))
        whole = F.concat(F.lit("(?<![a-z0-9])"), quoted, F.lit("(?![a-z0-9])"))
        return F.regexp_count(lower, F.when(word.contains(" ") | word.contains("&"), quoted).otherwise(whole))

    return F.aggregate(keywords, F.lit(0), lambda total, word: total + hits(word))


def page_exclusion(text: Column, keywords: Column) -> Column:
    """Why a page is left out, the first that holds: board_bio, auditor, legal_notice, numeric, statement_notes,

    exhibit_index, reference_index or director_certificate; null for a page that stays.
    keywords: an array of the lower-case names of the registry.
    """
    t = F.coalesce(text, F.lit(""))
    lower, count = F.lower(t), keyword_hits(t, keywords)
    spaced = [F.lower(F.regexp_replace(F.substring(t, 1, n), r"(?U)\s+", " ")) for n in (1600, 1800)]
    words = F.filter(F.split(t, r"(?U)\s+"), lambda w: w != "")
    opening = F.array_join(F.slice(words, 1, 100), " ")
    paragraphs = F.filter(F.split(t, r"\n+"), lambda x: x.rlike(r"(?U)\S"))
    dense = F.when(F.size(paragraphs) > 0, F.size(words) / F.size(paragraphs)).otherwise(999.0)
    names = F.regexp_count(opening, F.lit(r"(?U)\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3}\b"))
    din = F.substring(t, 1, 1200).rlike(r"(?U)\bDIN\s*:\s*\d+") & F.lower(F.substring(t, 1, 1200)).rlike(r"(?U)\b(non[-\s]?executive|chairman|director|committee|board)\b")
    bio = din | ((numeric_tokens(opening) == 0) & (names > 3) & (dense < 55))
    auditor = lower.contains("to the members of") | lower.contains("we have audited") | lower.contains("independent auditor")
    meeting = F.substring(lower, 1, 1200).rlike("notice of (the )?annual general meeting")
    legal = lower.contains("notice is hereby given") | lower.contains("pursuant to section") | lower.contains("companies act")
    numeric = F.size(F.filter(words, lambda w: w.rlike(r"(?U)\d"))) > 0.80 * F.size(words)
    notes = r"(?U)\bnotes\s+(?:to\s+(?:the\s+)?(?:consolidated\s+|standalone\s+)?|forming\s+part\s+of\s+(?:the\s+)?)financial\s+statements\b"
    numbered = F.regexp_count(F.substring(lower, 1, 1600), F.lit(r"(?U)\b(?:exhibit\s+)?\d{1,2}\.\d{1,2}\b"))
    exhibit = (F.regexp_count(lower, F.lit("incorporated by reference")) >= 2) | (F.substring(lower, 1, 1600).contains("exhibit") & (numbered >= 5))
    return (
        F.when(bio, "board_bio")
        .when(auditor, "auditor")
        .when(meeting, "legal_notice")
        .when(F.when(legal, count < 5).otherwise(False), "legal_notice")
        .when(F.when(numeric, count < 5).otherwise(False), "numeric")
        .when(F.when(spaced[0].rlike(notes), count < 25).otherwise(False), "statement_notes")
        .when(exhibit, "exhibit_index")
        .when(spaced[1].contains("disclosure reference") & spaced[1].contains("gri"), "reference_index")
        .when(spaced[0].contains("non-disqualification of directors"), "director_certificate")
    )


def metric_key(text: Column) -> Column:
    """Sorted distinct words of a metric without numbers, the plural s of words over four letters dropped."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z% ]+", " ")), r"\s+")
    stem = F.transform(words, lambda w: F.when((F.length(w) > 4) & w.endswith("s"), F.regexp_replace(w, "s$", "")).otherwise(w))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(stem, lambda w: w != ""))), " ")


def slug(text: Column) -> Column:
    """Lower-case letters and digits joined by underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def word_windows(text: Column, most: int, overlap: int) -> Column:
    """Array of windows of at most `most` words, each but the first starting `overlap` words before the last one's end.

    The last window is the first that reaches the end; blank text gives none.
    """
    if not 0 <= overlap < most:
        raise ValueError("0 <= overlap < most is needed")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    n = F.size(words)
    starts = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(most - overlap))
    return F.when(n > 0, F.transform(starts, lambda s: F.array_join(F.slice(words, s + 1, F.lit(most)), " "))).otherwise(F.array().cast("array<string>"))


# How a text says that what follows was printed before, and how a letter to shareholders begins.
REPRINTS = (
    r"\breprinted from\b", r"\boriginally published\b", r"\boriginally written\b", r"\bas published in\b", r"\bthe following\b.*?\bwas\b.*?\bpublished\b",
    r"\bfrom our\s+\d{4}\s+annual report\b", r"\boriginal\s+\d{4}\s+.*?\bletter\s+follows\b",
)
LETTER = r"\b(?:dear shareholders|to our shareholders)\s*:"


def reprint_parts(content: Column, at_letters: bool = False) -> Column:
    """struct(before, after) of a text cut where a reprint begins, the earliest of all signs; null without one or with nothing behind it.

    at_letters: a letter to shareholders begins one too, unless it opens the text.
    """
    found = [F.nullif(F.regexp_instr(content, F.lit(f"(?is){p}")), F.lit(0)) for p in REPRINTS]
    if at_letters:
        letter = F.regexp_instr(content, F.lit(f"(?is)(?<=.){LETTER}"))
        found.append(F.nullif(letter, F.lit(0)))
    at = F.least(*found)
    strip = r"(?U)^\s+|\s+$"
    before, after = F.regexp_replace(F.substring(content, F.lit(1), at - 1), strip, ""), F.regexp_replace(F.substring(content, at, F.length(content)), strip, "")
    return F.when(at.isNotNull() & (after != ""), F.struct(before.alias("before"), after.alias("after")))
