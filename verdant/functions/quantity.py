"""Numbers and units as they are written in reports.

Plain Python on purpose: the same functions make the reference spellings on the driver and
read single strings inside Arrow batches.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

# Scale words and what they multiply by.
SCALES = {
    "thousand": 1e3, "lakh": 1e5, "lac": 1e5, "million": 1e6, "mn": 1e6, "mln": 1e6, "crore": 1e7, "cr": 1e7, "billion": 1e9, "bn": 1e9,
}
# Names of the base units that symbols are made of. Prefixed, compound and scaled
# names follow by rule; plurals, other spellings and misspellings are left to the fuzzy search.
BASE_NAMES = {
    "L": ("l", "litre"), "m3": ("m3", "cubic metre", "cbm", "cu m"), "g": ("g", "gram", "gm"), "tonne": ("t", "tonne", "ton", "mt", "metric tonne", "metric ton"),
    "J": ("j", "joule"), "Wh": ("wh", "watt hour", "whr"), "lb": ("lb", "pound"), "quintal": ("quintal", "qtl"), "gal_us": ("us gallon", "gallon us", "gallon", "gal"),
    "%": ("%", "percent", "percentage", "pct"), "bps": ("bps", "basis point", "bp"), "INR": ("inr", "rs", "rupee"),
    "count": ("count", "number", "no", "unit", "people", "person", "case", "headcount"),
}
PREFIXES = {"k": "kilo", "M": "mega", "G": "giga", "T": "tera"}
# How carbon dioxide equivalent is written after a mass.
CO2_NAMES = ("co2e", "co2eq", "co2 eq", "co2 equivalent")
# The symbols of common report units, for callers that have no conversion table.
SYMBOLS = tuple("L kL m3 ML gal_us kg tonne kt g quintal lb GJ MJ TJ kWh MWh GWh tCO2e kgCO2e ktCO2e MtCO2e tCO2e/tonne kgCO2e/tonne GJ/tonne MJ/tonne kWh/tonne kL/tonne m3/tonne L/kg L/tonne kg/tonne g/kg g/tonne % bps count INR".split())
# What stands for "nothing stated".
MISSING = {"", "-", "–", "—", "n/a", "na", "nil", "none", "null"}

_TOKEN = re.compile(r"[a-z]+\d*[a-z]*|\d+|%")
_NUMBER = r"[-−]?\d+(?:[    ]\d{3})+(?:[.,]\d+)?(?!\d)|[-−]?\d[\d,.]*\d|[-−]?\d"
NUMBER = re.compile(rf"(?<![\w.,])(?:{_NUMBER})")


def parse_number(text: str) -> float | None:
    """The number written as text: 1,234.5 / 1,23,456 / 1 234.5 / 1.234,5 / 718,2; None if it is none.

    A single comma before exactly three last digits groups thousands, any other single comma
    is a decimal comma.
    """
    s = re.sub(r"[\s   ]", "", text).replace("−", "-")
    if not re.fullmatch(r"-?[\d.,]*\d[\d.,]*", s):
        return None
    s = s.rstrip(".,")
    if "," in s and "." in s:
        s = s.replace(",", "") if s.rfind(".") > s.rfind(",") else s.replace(".", "").replace(",", ".")
    elif s.count(",") == 1 and len(s) - s.index(",") != 4:
        s = s.replace(",", ".")
    else:
        s = s.replace(",", "")
    try:
        return float(s)
    except ValueError:
        return None


def unit_tokens(text: str) -> list[str]:
    """Lower-case words of a unit; a slash is "per", '000 is "thousand", "in" and "of" say nothing."""
    s = text.lower().replace("₂", "2").replace("³", "3").replace("₹", " inr ").replace("co₂", "co2").replace("/", " per ")
    s = re.sub(r"['’`]?\b000\b", " thousand ", s).replace(".", "")
    return [t for t in _TOKEN.findall(s) if t not in ("in", "of")]


def unit_key(text: str) -> str:
    """Spelling reduced to its letters and digits in order; equal keys are the same unit."""
    return "".join(unit_tokens(text))


_VOWELS = frozenset("aeiou")
MAX_COST = 0.15  # weighted edit cost a letter of the longer spelling


def weighted_distance(a: str, b: str, most: float) -> float:
    """Cost of writing the reference spelling b as a, or more than `most`.

    A blank costs 0.05, a plural s at a word's end 0.2, a vowel left out 0.25; a vowel for
    another, a vowel too many, a vowel and its neighbour swapped and a letter doubled or
    undoubled cost 0.5; two consonants swapped 1.5; a changed digit 2, as it is another unit;
    all else 1.
    """
    if abs(len(a) - len(b)) * 0.05 > most:
        return most + 1.0
    drop_b = [0.05 if y == " " else 0.25 if y in _VOWELS else 2.0 if y.isdigit() else 0.5 if j and y == b[j - 1] else 1.0 for j, y in enumerate(b)]
    before, prev = None, [0.0] * (len(b) + 1)
    for j in range(1, len(b) + 1):
        prev[j] = prev[j - 1] + drop_b[j - 1]
    for i in range(1, len(a) + 1):
        x = a[i - 1]
        plural = x == "s" and i > 1 and (i == len(a) or a[i] == " ")
        add = 0.05 if x == " " else 0.2 if plural else 2.0 if x.isdigit() else 0.5 if x in _VOWELS or i > 1 and x == a[i - 2] else 1.0
        row = [prev[0] + add]
        for j in range(1, len(b) + 1):
            y = b[j - 1]
            change = 0.0 if x == y else 2.0 if x.isdigit() or y.isdigit() else 0.5 if x in _VOWELS and y in _VOWELS else 1.0
            cost = min(prev[j - 1] + change, prev[j] + add, row[j - 1] + drop_b[j - 1])
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y and not (x.isdigit() or y.isdigit()):
                cost = min(cost, before[j - 2] + (0.5 if x in _VOWELS or y in _VOWELS else 1.5))
            row.append(cost)
        if min(row) > most and min(prev) > most:
            return most + 1.0
        before, prev = prev, row
    return prev[-1]


def _plain_names(symbol: str) -> list[str]:
    """Names of an unscaled symbol of a conversion table, made by rule; of an unknown one its own words."""
    if "/" in symbol:
        over, per = symbol.split("/", 1)
        return [f"{x} per {y}" for x in _plain_names(over) for y in _plain_names(per)]
    if symbol.endswith("CO2e") and symbol != "CO2e":
        mass = _plain_names(symbol[:-4])
        return [f"{x}{y}" if len(x) <= 2 else f"{x} {y}" for x in mass for y in CO2_NAMES]
    if symbol in BASE_NAMES:
        return list(BASE_NAMES[symbol])
    base = "tonne" if symbol[1:] == "t" else symbol[1:]
    if symbol == "t":
        return list(BASE_NAMES["tonne"])
    if symbol[:1] in PREFIXES and base in BASE_NAMES:
        short = [] if symbol == "Mt" else [symbol.lower()]  # mt is the metric tonne unless written Mt
        short += [f"{symbol[0].lower()}{n}" for n in BASE_NAMES[base] if n == "whr"]
        return short + [PREFIXES[symbol[0]] + n for n in BASE_NAMES[base] if (len(n) > 3 or n == "ton") and not n.startswith("metric")]
    return [" ".join(unit_tokens(symbol.replace("_", " ")))]


@dataclass(frozen=True)
class UnitBook:
    """The reference spellings of the units of a conversion table.

    plain: unscaled spelling of words with single blanks -> symbol; squeezed: scaled spellings
    too, without blanks -> (symbol, scale); words: all words of the spellings.
    """

    plain: dict[str, str]
    squeezed: dict[str, tuple[str, float]]
    words: tuple[str, ...]

    def word(self, token: str) -> str | None:
        """The word of a reference spelling that a token stands for, misspelt or not."""
        return _nearest_word(token, self.words)

    def exact(self, text: str) -> tuple[str, float] | None:
        """(symbol, scale) of a text all of whose words stand for those of a reference spelling."""
        if re.search(r"(?<![A-Za-z])Mt\s?CO[2₂]", text) and "MtCO2e" in self.symbols:
            return ("MtCO2e", 1.0)  # megatonnes only in exactly this writing; MT is the metric tonne
        tokens = unit_tokens(text)
        if hit := self.squeezed.get("".join(tokens)):
            return hit
        words = [self.word(t) for t in tokens]
        return None if None in words else self.squeezed.get("".join(words))

    @property
    def symbols(self) -> set[str]:
        return set(self.plain.values())

    def stem(self, text: str) -> tuple[str, float]:
        """The words of a text without a scale word at its beginning or end, misspelt or not, and that scale; a scale alone is one of count."""
        tokens = unit_tokens(text)
        for at in (0, -1) if tokens else ():
            if (scale := self.word(tokens[at])) in SCALES:
                rest = tokens[1:] if at == 0 else tokens[:-1]
                return (" ".join(rest) if rest else "count" if "count" in self.plain else ""), SCALES[scale]
        return " ".join(tokens), 1.0


@lru_cache(maxsize=8)
def unit_book(symbols: tuple[str, ...] = SYMBOLS) -> UnitBook:
    """The spellings of these symbols. Symbols that only scale another one (INR_lakh) follow from that one."""
    scale_words = set(SCALES) | {"thousand"}
    plain: dict[str, tuple[str, float]] = {}
    for symbol in sorted(symbols, key=lambda x: (x in BASE_NAMES, x)):
        if not scale_words & set(symbol.lower().split("_")):
            plain |= {name: (symbol, 1.0) for name in _plain_names(symbol) if name}
    names = {}
    for scale, times in SCALES.items():
        for name, (symbol, _) in plain.items():
            names[f"{scale} {name}"] = (symbol, times)
            if symbol == "INR":
                names[f"{name} {scale}"] = (symbol, times)
        if "count" in symbols:
            names[scale] = ("count", times)
    names |= plain
    squeezed: dict[str, tuple[str, float]] = {}
    for name, hit in names.items():
        squeezed.setdefault(name.replace(" ", ""), hit)
    squeezed |= {name.replace(" ", ""): hit for name, hit in plain.items()}
    parts = {*PREFIXES.values(), *(w for base in BASE_NAMES.values() for n in base for w in n.split())}  # of names written apart
    return UnitBook({name: symbol for name, (symbol, _) in plain.items()}, squeezed, tuple(sorted(parts | {w for n in names for w in n.split()})))


@lru_cache(maxsize=1 << 16)
def _nearest_word(token: str, words: tuple[str, ...]) -> str | None:
    if token in words:
        return token
    near = []
    for word in words:
        longer = max(len(token), len(word))
        if abs(len(token) - len(word)) <= 3 and (cost := weighted_distance(token, word, MAX_COST * longer)) <= MAX_COST * longer:
            near.append((cost, word))
    return min(near)[1] if near else None


def exact_unit(text: str) -> tuple[str, float] | None:
    """(symbol, scale) of a text that is a spelling of a common unit."""
    return unit_book().exact(text)


def unit_phrase_after(text: str, book: UnitBook | None = None) -> tuple[str, float, str] | None:
    """(symbol, scale, phrase) of the longest unit that text begins with: words are taken while they are words of units."""
    book = book or unit_book()
    best = None
    for m in re.finditer(r"\S+", text):
        if any(book.word(t) is None for t in unit_tokens(m.group())):
            break
        phrase = text[: m.end()].strip()
        for form in (phrase, phrase.rstrip(".,;:)")):
            hit = book.exact(form)
            if hit and not (m.start() == 0 and unit_key(form) in ("no", "g", "t", "l") and form.lower() != unit_key(form)):
                best = (*hit, form)
                break
        if re.search(r"[;:)]$", m.group()):
            break
    return best


_LEAD = re.compile(r"^\s*(?:c\.|ca\.|circa|about|around|approx\.?|approximately|nearly|over|~|≈|[<>])?\s*", re.I)
_NOTE = re.compile(r"\s*(?:\(\d{1,2}\)|[*^#†‡]+)\s*$")


def read_value(value: str | None) -> tuple[float, str] | None:
    """(number, what is written after it) of a value text; None without a number."""
    if value is None:
        return None
    s = _LEAD.sub("", value)
    before = ""
    if m := re.match(r"(?:₹|Rs\.?|INR)\s*", s, re.I):
        before, s = "INR ", s[m.end() :]
    m = re.match(_NUMBER, s)
    number = parse_number(m.group()) if m else None
    if number is None or not math.isfinite(number):
        return None
    rest = _NOTE.sub("", s[m.end() :]).strip()
    return number, (before + rest).strip()


_IN_METRIC = (re.compile(r"[(\[]([^()\[\]]*(?:\([^()]*\)[^()\[\]]*)?)[)\]]"), re.compile(r",\s*in\s+(.+?)\s*$", re.I), re.compile(r"\s[-–]\s+(.+?)\s*$"))


def unit_in_metric(metric: str | None, book: UnitBook) -> str | None:
    """A unit written in brackets, after ", in" or after a dash in the metric's name."""
    plain = re.sub(r"\s+/\s+|_", " ", metric or "")
    for pattern in _IN_METRIC:
        for hit in pattern.findall(plain):
            if book.exact(hit):
                return hit
    return None


def unit_in_evidence(number: float, evidence: str | None, book: UnitBook) -> str | None:
    """The unit phrase that follows the same number in the evidence."""
    for m in NUMBER.finditer(evidence or ""):
        other = parse_number(m.group())
        if other is not None and math.isclose(other, number, rel_tol=1e-9, abs_tol=1e-12):
            if hit := unit_phrase_after(evidence[m.end() :].lstrip("  "), book):
                before = re.search(r"(₹|\bRs\.?|\bINR)\s*$", evidence[: m.start()], re.I)
                return f"INR {hit[2]}" if before and hit[0] == "count" else hit[2]
            if re.search(r"(₹|\bRs\.?|\bINR)\s*$", evidence[: m.start()], re.I):
                return "INR"
    return None


def read_quantity(
    value: str | None, unit: str | None, metric: str | None, evidence: str | None, book: UnitBook | None = None
) -> tuple[float, float, str, str] | None:
    """(number, scale beside the number, unit text, where it stands) of a stated quantity.

    The unit is that of the value text, of the unit column, of the metric or of the evidence,
    the first that there is; a bare scale word beside the number multiplies a unit found
    elsewhere.  None without a number; unit text "" where no unit is stated.
    """
    read = read_value(value)
    if read is None:
        return None
    book = book or unit_book()
    number, rest = read
    scale = SCALES.get(book.word(unit_key(rest)) or "") if rest else None
    stated = unit if unit is not None and unit.strip().lower() not in MISSING else None
    if rest and scale is None:
        return number, 1.0, rest, "value"
    if stated is not None:
        return number, scale or 1.0, stated, "unit"
    if found := unit_in_metric(metric, book):
        return number, scale or 1.0, found, "metric"
    if found := unit_in_evidence(number, evidence, book):
        own = book.exact(found)
        return number, 1.0 if own and own[1] != 1.0 else scale or 1.0, found, "evidence"
    if scale is not None:
        return number, 1.0, rest, "value"
    return number, 1.0, "", "nowhere"
