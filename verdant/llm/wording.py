"""Normal form of freely written metric names, for problem 3."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

from verdant.functions.quantity import exact_unit, unit_key
from verdant.llm.skeleton import consistent

# Words that qualify a figure without changing what it is.
QUALIFIERS = "our group annual absolute key indicator figure figures kpi restated consolidated standalone current fy ytd provisional reported year all site sites boundary within level".split()
# Ways of writing a word that no rule leads to.
SYNONYMS = {"h2o": "water", "pct": "share", "percentage": "share"}
_SCOPE = {"1": "one", "2": "two", "3": "three", "i": "one", "ii": "two", "iii": "three", "one": "one", "two": "two", "three": "three"}
STOPWORDS = frozenset("of from to the in on and for per by with at a an".split())


def _clean_units(text: str) -> str:
    """Text without units and notes in brackets, after ", in" or after a dash."""

    def bracket(m: re.Match) -> str:
        inside = m.group(1)
        return " " if exact_unit(inside) or re.fullmatch(r"\s*[\dA-Za-z]\s*", inside) else f" {inside} "

    text = re.sub(r"[(\[]([^()\[\]]*(?:\([^()]*\)[^()\[\]]*)?)[)\]]", bracket, text)
    if (m := re.search(r",\s*in\s+(.+?)\s*$", text, re.I)) and exact_unit(m.group(1)):
        text = text[: m.start()]
    if (m := re.search(r".*\s[-–]\s+(.+?)\s*$", text)) and exact_unit(m.group(1)) and unit_key(m.group(1)) not in ("number", "people"):
        text = text[: m.start(1)]
    return text


@lru_cache(maxsize=1 << 16)
def written_out(word: str, vocabulary: tuple[str, ...]) -> str:
    """An abbreviation as the word of the vocabulary it stands for, any other word as it is.

    A word that is not in the vocabulary abbreviates those that it begins, else the shortest of
    those that begin with its letter and hold its letters in order; of several it is the one
    that stands first, as the vocabulary begins with its commonest words.
    """
    if len(word) < 3 or not word.isalpha() or word in vocabulary or word in STOPWORDS:
        return word
    full = [v for v in vocabulary if v[0] == word[0] and len(v) > len(word) and _in_order(word, v)]
    if not full:
        return word
    begun = [v for v in full if v.startswith(word)]
    return (begun or sorted(full, key=len))[0]


def _in_order(letters: str, word: str) -> bool:
    rest = iter(word)
    return all(c in rest for c in letters)


def vocabulary_of(names: Iterable[str | None]) -> Counter[str]:
    """The words of three letters and more of a reference list's names, and how many names have each."""
    return Counter(w for n in names if n for w in set(re.findall(r"[^\W\d_]{3,}", consistent(n).lower())))


def by_frequency(words: Counter[str]) -> tuple[str, ...]:
    """The commonest word first, of equally common ones the smaller."""
    return tuple(sorted(words, key=lambda w: (-words[w], w)))


def wording_tokens(text: str, vocabulary: tuple[str, ...] = ()) -> list[str]:
    """Words that carry the meaning, in order, lower case, abbreviations of the vocabulary written out."""
    text = consistent(text)
    if not re.search(r"\s", text.strip()) and re.search(r"[a-z][A-Z]", text):
        text = re.sub(r"(?<=[a-z])(?=[A-Z0-9])|(?<=[0-9])(?=[A-Z][a-z])", " ", text)
    text = re.sub(r"\s+/\s+|_", " ", text)
    text = _clean_units(text).lower()
    text = re.sub(r"\bw/(?=[a-z])", "w", text).replace("co₂", "co2")
    text = re.sub(r"^\W*(?:\d+(?:\.\d+)+|[a-z]\))\s*|(?<!\w)\d+\.\d+(?!\w)", " ", text)
    text = re.sub(r"%|\bper cent\b|\bpercent\b", " share ", text)
    text = re.sub(r"(scope|\bsc\.?)[\s-]*([123])(?!\d)", lambda m: f" scope {_SCOPE[m.group(2)]} ", text)
    words: list[str] = []
    for word in re.findall(r"[^\W_]+", text.replace("'", "")):
        if m := re.fullmatch(r"(?:scope|sc|s)([123])", word):
            words += ["scope", _SCOPE[m.group(1)]]
        elif words and words[-1] == "scope" and word in _SCOPE:
            words.append(_SCOPE[word])
        else:
            word = SYNONYMS.get(word, word)
            if word not in ("co2", "h2o") and re.search(r"[a-z]", word):
                word = word.replace("0", "o").replace("1", "l")
            words.append(word)
    numbers = {"one", "two", "three"}
    kept = []
    for word in words:
        if word in _SCOPE and word not in numbers and "scope" in words:
            kept.append(_SCOPE[word])  # the number of a scope that stands apart from it
        elif not word.isdigit() and (word in vocabulary and word not in QUALIFIERS or not _qualifies(word)):
            kept.append(written_out(word, vocabulary))
    while kept[:1] and kept[0] in STOPWORDS:
        kept = kept[1:]
    while kept and kept[-1] in STOPWORDS:
        kept = kept[:-1]
    return kept or words


_SHAPE = str.maketrans("l1", "ii")
_QUALIFIER_SHAPES = frozenset(q.translate(_SHAPE) for q in QUALIFIERS)


def _one_edit(a: str, b: str) -> bool:
    """Whether one letter changed, added, dropped or swapped with its neighbour makes a of b."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y or x == y[1:] or x[1:] == y[1:] or (x[:2] == y[:2][::-1] and x[2:] == y[2:])


def _qualifies(word: str) -> bool:
    shape = word.translate(_SHAPE)
    return shape in _QUALIFIER_SHAPES or len(word) >= 5 and any(len(q) >= 6 and _one_edit(shape, q) for q in _QUALIFIER_SHAPES)


def squeeze(tokens: list[str]) -> str:
    """Letters and digits without blanks; l and 1, which scans confuse with i, are i."""
    return "".join(tokens).translate(_SHAPE)


def metric_form(text: str | None, vocabulary: tuple[str, ...] = ()) -> str | None:
    """The squeezed normal form of a metric's wording; None for null and blank text."""
    if text is None or not text.strip():
        return None
    return squeeze(wording_tokens(text, vocabulary)) or re.sub(r"[\W_]+", "", text.lower()) or "?"


def name_forms(name: str, vocabulary: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """The normal forms of a registry name, each with its rotations by whole words.

    Whole, without stopwords, and as written.
    """
    tokens = wording_tokens(name, vocabulary)
    forms = [tokens, [t for t in tokens if t not in STOPWORDS]]
    if not re.search(r"\d", name):
        forms.append(re.findall(r"[^\W_]+", name.lower()))
    return {squeeze(f): sorted({squeeze(f[i:] + f[:i]) for i in range(len(f))}) for f in forms if f}
