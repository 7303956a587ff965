"""Golden rows and fixtures for the core functions, operators, sources and streams."""

import hashlib
import json
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from verdant.functions import facts as say
from verdant.functions import number, period, quantity, semantics, similarity, text
from verdant.operators import chunks, cluster, dedup, intervals, matching, resolve, review, star, units, validate, vectors
from verdant.plans import resolution, router
from verdant.sources import files, providers
from verdant.streaming import resume


def column(spark, values, expression, schema="v string"):
    frame = spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in values], schema)
    return [r[0] for r in frame.select(expression).collect()]


@pytest.mark.parametrize(
    "value, raw, name, want",
    [
        ("1", "kgCO2e/t", "", (0.001, "tCO2e/tonne", "exact")),
        ("1", "GJ/Crore INR", "", (0.1, "GJ/MINR", "inferred")),
        ("4", "", "water", (None, None, "needs_context")),
        ("12", "blorps/sprockets", "", (None, None, "failed")),
        ("4.69", "kL/tonne", "", (4.69, "kL/tonne", "exact")),
        ("1680843", "Joules or multiples", "", (1680843.0, "GJ", "inferred")),
        ("120000", "tons CO2", "", (120000.0, "tCO2e", "inferred")),
        ("28", None, "Number of sites", (28.0, "count", "inferred")),
        ("3 lakh", "kg", "", (300000.0, "kg", "exact")),
        (None, "kg", "", (None, "kg", "needs_context")),
    ],
)
def test_unit_normaliser(spark, value, raw, name, want):
    rows = spark.createDataFrame([(1, value, raw, name, "")], "k int, v string, u string, n string, s string")
    got = tuple(units.normalise_units(rows, conversions(spark), "k", "v", "u", "n", "s").select("value", "symbol", "confidence").first())
    assert got[1:] == want[1:] and (got[0] == want[0] or got[0] == pytest.approx(want[0]))


def conversions(spark):
    rows = [("weight", "kg", "kg", 1.0), ("weight", "tonne", "kg", 1000.0), ("energy", "GJ", "GJ", 1.0), ("count", "count", "count", 1.0), ("emissions", "tCO2e", "tCO2e", 1.0)]
    rows += [("emission_intensity", "kgCO2e/tonne", "tCO2e/tonne", 0.001), ("water_intensity", "kL/tonne", "kL/tonne", 1.0)]
    return spark.createDataFrame(rows, "unit_family string, from_symbol string, to_symbol string, factor double")


@pytest.mark.parametrize(
    "raw, want",
    [("1,234.5", 1234.5), ("1,23,456", 123456.0), ("1 234.5", 1234.5), ("718,2", 718.2), ("1.234,5", 1234.5), ("−7", -7.0), ("12,345", 12345.0), ("abc", None), ("", None), (".", None)],
)
def test_numbers(raw, want):
    assert quantity.parse_number(raw) == want


@pytest.mark.parametrize(
    "row, want",
    [
        (("c. 774.7", "MJ", None, None), (774.7, 1.0, "MJ", "unit")),
        (("52597 crore", "kilograms", None, None), (52597.0, 1e7, "kilograms", "unit")),
        (("12,375 INR lakh", "-", None, None), (12375.0, 1.0, "INR lakh", "value")),
        (("22 (1)", None, "recycled wtr (k.l.)", None), (22.0, 1.0, "k.l.", "metric")),
        (("76733 crore", "", "e-waste", "landed at 76,733 crore kilograms as"), (76733.0, 1.0, "crore kilograms", "evidence")),
        (("1,606.3 mn", None, None, None), (1606.3, 1.0, "mn", "value")),
        (("nil", "kg", None, None), None),
        (("7", None, None, None), (7.0, 1.0, "", "nowhere")),
    ],
)
def test_quantities(row, want):
    assert quantity.read_quantity(*row) == want


def test_unit_dictionary_is_fuzzy_but_strict(spark):
    texts = ["kilogarms of CO2 equivalnt", "kilolitters", "thousand tonns", "GJ", "blorps", "index points", "level", "rating", "", None, "k" * 5000]
    got = {r.unit_text: (r.symbol, r.scale) for r in units.unit_dictionary(spark.createDataFrame([(t,) for t in texts], "unit_text string")).collect()}
    assert got == {"kilogarms of CO2 equivalnt": ("kgCO2e", 1.0), "kilolitters": ("kL", 1.0), "thousand tonns": ("tonne", 1000.0), "GJ": ("GJ", 1.0)}
    assert quantity.weighted_distance("tonne1", "tonne2", 9.0) == 2.0 and quantity.weighted_distance("tonnne", "tonne", 9.0) == 0.5
    # short keys, misspelt scale words, and a unit that only the conversion table knows
    odd = ["tone", "litr", "kwhh", "milion tonnes CO2e", "INR croer", "Mt CO2e", "MTCO2e", "acres", "acre feet"]
    frame = spark.createDataFrame([(t,) for t in odd], "unit_text string")
    got = {r.unit_text: (r.symbol, r.scale) for r in units.unit_dictionary(frame, symbols=(*quantity.SYMBOLS, "acre")).collect()}
    assert got == {"tone": ("tonne", 1.0), "litr": ("L", 1.0), "kwhh": ("kWh", 1.0), "milion tonnes CO2e": ("tCO2e", 1e6), "INR croer": ("INR", 1e7), "Mt CO2e": ("MtCO2e", 1.0), "MTCO2e": ("tCO2e", 1.0), "acres": ("acre", 1.0)}


def test_bigram_join_loses_no_unit(spark):
    """Every pair within the cost budget is found, against all pairs by brute force; no phrase is cut short."""
    rng = random.Random(4)
    book = quantity.unit_book()
    names = list(book.plain)
    odd = set()
    for _ in range(150):
        w = list(rng.choice(names))
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(2)] = rng.choice("aeisntkml ")
        odd.add(" ".join("".join(w).split()))
    got = {r.unit_text for r in units.unit_dictionary(spark.createDataFrame([(t,) for t in odd], "unit_text string")).collect()}
    most = lambda a, b: quantity.MAX_COST * max(len(a), len(b))
    spelt = {t: book.stem(t)[0] for t in odd}
    want = {t for t, a in spelt.items() if a and any(quantity.weighted_distance(a, n, most(a, n)) <= most(a, n) for n in names)}
    assert got == want and len(want) > 40
    far = "12 " + "million " * 1 + "kilogrammes of " + "CO2 equivalents per metric ton produced"
    assert quantity.unit_phrase_after(far[3:])[:2] == ("kgCO2e/tonne", 1e6)


def test_observation_check(spark):
    conversion = spark.createDataFrame([("volume", "kL", "L", 1000.0), ("count", "count", "count", 1.0)], "unit_family string, from_symbol string, to_symbol string, factor double")
    facts = spark.createDataFrame([("a", "2", "kL", "m", "e"), ("a", "2", "kL", "m", "e"), ("b", "5 lakh", None, "trees", None), ("c", None, "kL", None, None), ("d", "0", "kL", "m", "")], "fact_id string, value string, unit string, metric string, evidence string")
    obs = spark.createDataFrame([("1", "a", 2000.0), ("2", "a", 2.0), ("3", "a", None), ("4", "a", float("nan")), ("5", "b", 500001.0), ("6", "c", 1.0), ("7", None, 1.0), ("8", "d", 0.0), ("9", "a", 2019.0), ("9", "a", 2019.0)], "obs_id string, source_fact_id string, normalised_value double")
    got = {r.obs_id: r.verdict for r in units.check_observations(obs, facts, conversion).collect()}
    assert got == {"1": "right", "2": "wrong", "3": "fill", "4": "fill", "5": "right", "6": "unknown", "7": "unknown", "8": "right", "9": "right"}
    assert units.check_observations(obs.limit(0), facts.limit(0), conversion).count() == 0


def test_numbers_in_fields(spark):
    rows = [("5-10", ""), ("12", ""), ("from 5 to 9", ""), ("5 9", "guidance: from 5 to 9"), (None, None), ("n/a", "")]
    assert column(spark, rows, number.primary_number(F.col("v"), F.col("s")), "v string, s string") == [None, 12.0, 9.0, None, None, None]
    assert column(spark, ["5 crore", "2 bn", "7", None], number.scale_of(F.col("v"), F.lit(None).cast("string"))) == [10_000_000, 1_000_000_000, 1, 1]
    assert column(spark, ["bps", "%", "kWh", "", None, "widgets"], number.unit_family(F.col("v"))) == ["percentage_points", "percentage", "energy", "unknown", "unknown", "unknown"]
    pairs = [("percentage", "percentage_points"), ("weight", "energy"), ("unknown", "energy"), (None, "energy")]
    assert column(spark, pairs, number.families_compatible(F.col("a"), F.col("b"), F.lit("scalar")), "a string, b string") == [True, False, True, True]


@pytest.mark.parametrize(
    "name, want",
    [("EBITDA margin", True), ("revenue growth", True), ("Sales", True), ("capital expenditure", True), ("ROCE", True), ("water intensity", False), ("GHG emissions", False), ("number of employees", False), ("operating cash flow", True), ("CAGR", True), ("EPS", True)],
)
def test_financial_names(spark, name, want):
    assert column(spark, [name], semantics.is_financial(F.col("v"))) == [want]


def test_semantic_gate(spark):
    rows = [("water capacity created", "water withdrawal"), ("renewable energy used", "non-renewable energy used"), ("water used", "water used")]
    why = semantics.gate_reasons(semantics.semantics_of(F.col("a")), semantics.semantics_of(F.col("b")), F.lit("volume"), F.lit("volume"))
    got = column(spark, rows, why, "a string, b string")
    assert "role_mismatch" in got[0] or "polarity_mismatch" in got[0]
    assert "energy_source_mismatch" in got[1] and got[2] == []


def test_periods(spark):
    labels = [("2023-24", 2022, "fiscal_year"), ("", 2022, "fiscal_year"), ("year 2021", 2022, "calendar_year"), ("FY2021", 2024, "fiscal_year"), (None, 2020, "calendar_year")]
    got = column(spark, labels, period.normalise_label(F.col("a"), F.col("b"), F.col("c")), "a string, b int, c string")
    assert got == ["FY2024", "FY2022", "CY2021", "FY2024", "CY2020"]
    bounds = period.resolve_bounds(F.col("a"), F.col("b"), F.col("c"))
    rows = [("FY2022", "full_year", 3), ("FY2019", "baseline", 3), ("CY2022", "full_year", 3), ("FY2030", "target", 3), ("FY2024", "point_in_time", 12), ("none", "full_year", 3)]
    got = [(str(b.start), str(b.end), b.resolution) for b in column(spark, rows, bounds, "a string, b string, c int")]
    assert got == [("2021-04-01", "2022-03-31", "range"), ("2018-04-01", "2019-03-31", "range"), ("2022-01-01", "2022-12-31", "range"), ("None", "2030-12-31", "end_only"), ("None", "2024-12-31", "point"), ("None", "None", "unresolvable")]
    label, how = period.infer_label(F.col("a"), F.col("b"), F.lit("FY2024"))
    rows = [("current", "Rules 2016"), ("ongoing", ""), ("open-ended", ""), ("FY2022", "x"), ("", "For FY2021 we"), ("", "nothing"), (None, "in 2019-20")]
    got = column(spark, rows, F.struct(label.alias("l"), how.alias("h")), "a string, b string")
    assert [tuple(x) for x in got] == [("FY2024", "inferred"), ("FY2024", "inferred"), ("open_ended", "inferred"), ("FY2022", "extracted"), ("FY2021", "extracted"), ("FY2024", "inferred"), ("FY2020", "extracted")]
    first, last = period.quarter_bounds(F.lit(2024), F.lit(3), F.col("v").cast("int"))
    assert [(str(x.f), str(x.l)) for x in column(spark, ["1", "4"], F.struct(first.alias("f"), last.alias("l")))] == [("2023-04-01", "2023-06-30"), ("2024-01-01", "2024-03-31")]


def test_fact_reading(spark):
    rows = ["reduced from 10 to 7 units", "between 3 and 4", "rose by 5%", "stood at 9", None]
    got = [(x.kind, x.first, x.second, x.direction) for x in column(spark, rows, say.interpretation(F.col("v")))]
    assert got == [("transition", 10.0, 7.0, "down"), ("range", 3.0, 4.0, None), ("change", 5.0, None, "up"), ("scalar", None, None, None), ("scalar", None, None, None)]
    assert column(spark, ["compared to FY2019", "since 2015", "base year: 2018", "in 2020", None], say.baseline_year(F.col("v"))) == [2019, 2015, 2018, None, None]
    assert [(d.type, d.member) for d in column(spark, ["Women in men's team", "plastic packaging", "sales in India", "x"], say.dimension(F.col("v")))] == [("gender", "female"), ("packaging", "plastic"), ("country", "india"), (None, None)]
    assert column(spark, ["Scope 3 category 11", "Scope 3 business travel", "business travel"], say.scope3_category(F.col("v"), F.lit(None).cast("string"))) == [11, 6, None]
    assert column(spark, ["short\nWater used was 5 kL here\nwater again and again"], say.evidence_line(F.col("v"), ["water"])) == ["Water used was 5 kL here"]
    toc = "Contents\nWater stewardship ........ 12\nPeople and safety   45\nplain line\n"
    assert [(x.title, x.page) for x in column(spark, [toc], say.toc_pairs(F.col("v")))[0]] == [("Water stewardship", 12), ("People and safety", 45)]


def test_word_windows_equal_a_loop(spark):
    def loop(words, most, overlap):
        out, start = [], 0
        while words:
            out.append(" ".join(words[start : start + most]))
            if start + most >= len(words):
                return out
            start += most - overlap
        return out

    for most, overlap in ((5, 2), (7, 0), (3, 1)):
        texts = [" ".join(f"w{i}" for i in range(n)) for n in range(30)] + [None, "  "]
        got = column(spark, texts, text.word_windows(F.col("v"), most, overlap))
        assert got == [loop((t or "").split(), most, overlap) for t in texts]


def test_sentence_packing():
    s = [" ".join([f"s{i}"] * n) for i, n in enumerate((10, 10, 10, 30, 5, 5))]
    parts = chunks.pack_sentences(s, 25, 8)
    assert parts == [" ".join(s[:2]), " ".join(s[1:3]), s[3], " ".join(s[4:])] and chunks.pack_sentences([], 25, 8) == []


def test_chunk_links_are_numeric(spark):
    pages = spark.createDataFrame([("d", p, "a b c d e f") for p in (2, 10, 1)], "doc string, page int, text string")
    linked = chunks.link_chunks(chunks.build_chunks(pages, "doc", "page", "text", 4, 1), "doc", ["page", "part"])
    order = {r.chunk_id: (r.prev_chunk_id, r.next_chunk_id) for r in linked.collect()}
    assert order["d_p002_1"] == ("d_p001_2", "d_p002_2") and order["d_p010_2"][1] is None and order["d_p001_1"][0] is None
    context = {r.chunk_id: r.context for r in chunks.with_context(linked).collect()}
    assert context["d_p001_1"] == "a b c d\n---\nd e f"


def test_tables_unpivot(spark):
    body = "intro\n| Indicator | FY22 | FY23 |\n|---|---|---|\n| Water | 5 | - |\n| Waste |  | 7 | 9 |\nend\n| lone | row |"
    rows = chunks.unpivot_tables(spark.createDataFrame([("s", body), ("t", None)], "id string, text string"), ["id"], "text").collect()
    assert {(r.metric, r.column_name, r.value) for r in rows} == {("Water", "FY22", "5"), ("Waste", "FY23", "7")}


def test_page_intervals(spark):
    pages = spark.createDataFrame([("d", p) for p in (1, 4, 12, 13)], "doc string, page int")
    assert sorted(r.page for r in intervals.fill_gaps(pages, "doc", "page", 5).collect()) == [1, 2, 3, 4, 12, 13]
    assert sorted(r.page for r in intervals.buffer_pages(pages, "doc", "page", 1).collect()) == [1, 2, 3, 4, 5, 11, 12, 13, 14]
    assert {(r.first, r.last) for r in intervals.islands(pages, "doc", "page").collect()} == {(1, 1), (4, 4), (12, 13)}
    ranged = intervals.ranges_to_next(pages.withColumn("last", F.lit(20)), "doc", "page", "last")
    assert {(r.page, r.end) for r in ranged.collect()} == {(1, 3), (4, 11), (12, 12), (13, 20)}


def test_dedup_cascade_keeps_the_best(spark):
    schema = "fact_id string, doc_id string, metric string, value string, unit string, evidence string, decision string, confidence double, chunk_id string, seq long"
    rows = [
        ("a", "d", "Water use", "1,200", "kL", "Water use was 1,200 kL", "rescue", 0.4, "c1", 1), ("b", "d", "Water use", "1,200", "kL", "water  use was 1,200 kL", "keep", 0.4, "c2", 2),
        ("c", "d", "use waters", "1200.0", "KL", "Another line", "keep", 0.3, "c3", 3), ("e", "d", None, "5", "kg", None, "keep", 0.9, "c4", 4), ("f", "d", None, "5", "kg", None, "keep", 0.9, "c5", 5),
        ("g", "x", "Water use", "1,200", "kL", "Water use was 1,200 kL", "keep", float("nan"), "c6", 6),
    ]
    got = {r.fact_id: r.merged for r in dedup.dedup_cascade(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"b": ["c1", "c3"], "e": [], "f": [], "g": []}


def test_components_and_leaders(spark):
    nodes = spark.createDataFrame([(f"n{i:02d}",) for i in range(40)], "id string")
    edges = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(30) if i != 14], "a string, b string")
    got = {r.id: r.component for r in cluster.connected_components(nodes, edges).collect()}
    assert {got[f"n{i:02d}"] for i in range(15)} == {"n00"} and {got[f"n{i:02d}"] for i in range(15, 31)} == {"n15"} and got["n35"] == "n35"
    assert [x[1] for x in cluster.leader_clusters([("water used", "a"), ("water use", "b"), ("energy", "c")], 0.85)] == ["water used", "water used", "energy"]
    assert similarity.sequence_ratio("abcd", "bcde") == 0.75 and similarity.sequence_ratio("", "a") == 0.0


def test_blocked_pairs(spark):
    rows = [("1", "co1", "w", ["a", "b", "c"]), ("2", "co2", "w", ["a", "b", "d"]), ("3", "co1", "w", ["a", "b", "c"]), ("4", "co2", "x", ["a", "b", "c"]), ("5", "co3", "w", [])]
    frame = spark.createDataFrame(rows, "id string, owner string, block string, t array<string>")
    assert {(r.a, r.b, r.jaccard) for r in cluster.blocked_pairs(frame, "id", "owner", "block", "t", 0.5).collect()} == {("1", "2", 0.5), ("2", "3", 0.5)}


def test_matching(spark):
    registry = spark.createDataFrame([("water_in", "Total water withdrawal", "L", ["water intake"]), ("energy", "Total energy consumption", "GJ", None)], "canonical_id string, display_name string, unit string, aliases array<string>")
    facts = spark.createDataFrame([("1", "total water withdrawal", "L"), ("2", "total water withdrawal", "GJ"), ("3", "chess club", None), ("4", None, "L")], "key string, name string, unit string")
    scored = matching.candidates(facts, registry)
    verdicts = {r.key: (r.canonical_id, r.verdict) for r in matching.decide(scored).collect()}
    assert verdicts["1"] == ("water_in", "accept") and verdicts["2"][1] == "new" and "3" not in verdicts
    listed = {"water_in": ["water bottle"]}
    assert column(spark, [("Water bottles", "water_in"), ("Water", "water_in")], matching.blacklisted(F.col("a"), F.col("b"), listed), "a string, b string") == [True, False]


def test_definition_score_is_weighted_words_and_pairs(spark):
    entries = [("w", "Total water consumption"), ("e", "Total energy consumption"), ("g", "Total emissions during the year"), ("x", "")]
    stop = {*"the a an of and or to for in on by with within from that this is are be as at into during across".split()}

    def tokens(text):
        words = [w for w in re.findall("[a-z0-9]+", text.lower()) if w not in stop]
        return words + [f"{a}_{b}" for a, b in zip(words, words[1:])]

    df = Counter(t for _, text in entries for t in set(tokens(text)))
    idf = {t: math.log((1 + len(entries)) / (1 + n)) + 1 for t, n in df.items()}

    def vector(text):
        v = Counter()
        for t in tokens(text):
            v[int(hashlib.md5(t.encode()).hexdigest(), 16) % 512] += idf.get(t, 1.0)
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {k: x / size for k, x in v.items()}

    def score(a, b):
        x, y = vector(a), vector(b)
        return sum(w * y.get(k, 0.0) for k, w in x.items())

    registry = spark.createDataFrame([(i, t, "L", None) for i, t in entries], "canonical_id string, display_name string, unit string, aliases array<string>")
    names = ["water consumption in total", "emissions across total energy", "water"]
    facts = spark.createDataFrame([(n, n, "L") for n in names], "key string, name string, unit string")
    got = {(r.key, r.canonical_id): r.definition for r in matching.candidates(facts, registry).collect()}
    want = {(n, i): round(score(n, t), 6) for n in names for i, t in entries if score(n, t) > 0}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_canonical_duplicates_keep_their_chunks(spark):
    rows = [("3", "partial", "c9"), ("1", "partial", "c2"), ("2", "normalized", "c5"), ("4", None, "c2"), ("5", "partial", None), ("6", "partial", " "), ("7", "partial", "c5")]
    frame = spark.createDataFrame([("d", "m", "2024", "5", *r) for r in rows], "source_doc_id string, canonical_id string, period_label string, raw_value string, obs_id string, normalization_status string, chunk_id string")
    kept = dedup.dedup_by_canonical(frame, {"normalized": 0, "partial": 1}, "chunk_id").collect()
    assert [(r.obs_id, r.members, r.merged) for r in kept] == [("2", 7, ["c2", "c5", "c9"])]


def test_page_exclusion(spark):
    pages = [
        ("Mr Rao DIN: 00123 is a non-executive director", "board_bio"),
        ("Anil Kumar Rao sits\nMary Ann Jones sits\nPeter Paul Smith sits\nJohn Henry Ford sits", "board_bio"),
        ("to the members of the company", "auditor"),
        ("pursuant to section 12 of the act", "legal_notice"),
        ("pursuant to section 12 water use, water use, water use, water use, water use", None),
        ("12 13 14 15 16 17 18 19 20 total", "numeric"),
        ("8 of 10 words: 1 2 3 4 5 6 water", None),
        ("5 notes to the  consolidated financial statements", "statement_notes"),
        ("exhibit list of 1.1 1.2 1.3 2.1 10.2", "exhibit_index"),
        ("1 disclosure reference GRI 303", "reference_index"),
        ("1 certificate of non-disqualification of directors", "director_certificate"),
        ("Water use fell to 5 kL", None), ("", None), (None, None),
    ]
    why = text.page_exclusion(F.col("a"), F.array(F.lit("water use"), F.lit("waste")))
    assert column(spark, [(t,) for t, _ in pages], why, "a string") == [w for _, w in pages]
    hits = text.keyword_hits(F.col("a"), F.array(F.lit("water use"), F.lit("waste")))
    assert column(spark, [("Waste, wastes, groundwater used waste",)], hits, "a string") == [3]


def test_unit_words_for_nothing_leave_the_unit_to_the_metric(spark):
    given = [None, "", " - ", "—", "n/a", "N/A ", "\tnil", "none", "null", "\u00a0na"]
    rows = spark.createDataFrame([(str(i), "12", u, "Water withdrawal (kL)", None) for i, u in enumerate(given)] + [("t", "12", "GJ", "Water withdrawal (kL)", None)], "k string, v string, u string, m string, e string")
    got = {r.k: (r.unit_text, r.found_in) for r in units.read_quantities(rows, "k", "v", "u", "m", "e").collect()}
    assert {got[str(i)] for i in range(len(given))} == {("kL", "metric")} and got["t"] == ("GJ", "unit")


def test_unmatched_facts_get_a_verdict(spark):
    registry = spark.createDataFrame([("water_in", "Total water withdrawal", "L", ["water intake"])], "canonical_id string, display_name string, unit string, aliases array<string>")
    facts = spark.createDataFrame([("1", "total water withdrawal", "L"), ("3", "chess club", None), ("4", None, "L")], "key string, name string, unit string")
    decided = matching.decide(matching.candidates(facts, registry, unmatched=True))
    assert {r.key: (r.canonical_id, r.score, r.margin, r.verdict) for r in decided.collect()} == {"1": ("water_in", 1.0, 1.0, "accept"), "3": (None, 0.0, 0.0, "new"), "4": (None, 0.0, 0.0, "new")}
    truth = spark.createDataFrame([("1", "water_in"), ("3", "water_in")], "key string, expected string")
    assert [(r.facts, r.right) for r in matching.calibrate(decided, truth).collect()] == [(2, 1)]


def test_nearest_equals_brute_force(spark):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(60, 8)).astype("float32")
    frame = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "id long, e array<float>")
    got = vectors.nearest(frame, frame.where("id % 20 = 0"), "id", "e", 3, block=2).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in (0, 20, 40):
        s = u @ u[q]
        s[q] = -9
        assert [r.neighbour for r in sorted((r for r in got if r.query == q), key=lambda r: r["rank"])] == list(np.argsort(-s)[:3])
    assert vectors.nearest(frame, frame.limit(0), "id", "e", 3).count() == 0


def test_star_upserts(spark):
    held = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, t int")
    new = spark.createDataFrame([("b", 2, 2), ("b", 3, 3), ("c", 4, 1)], "k string, v int, t int")
    assert {(r.k, r.v) for r in star.merge_into(held, new, "k", ["t"]).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    best = star.argmax_rows(spark.createDataFrame([("x", 5.0, "2"), ("x", 5.0, "1"), ("x", 1.0, "0")], "g string, v double, id string"), ["g"], "v", "id")
    assert [(r.g, r.v, r.id) for r in best.collect()] == [("x", 5.0, "1")]


def test_alias_map_and_multiset_join(spark):
    registry = spark.createDataFrame([("b", "Name", ["Shared "]), ("a", "Other", ["shared", ""])], "canonical_id string, display_name string, aliases array<string>")
    assert {(r.key, r.canonical_id) for r in resolve.alias_map(registry).collect()} == {("name", "b"), ("b", "b"), ("shared", "a"), ("other", "a"), ("a", "a")}
    left, right = spark.createDataFrame([("k", 1), ("k", 2), (None, 3)], "k string, l int"), spark.createDataFrame([("k", 7), (None, 8)], "k string, r int")
    assert {(r.l, r.r) for r in validate.multiset_join(left, right, ["k"], "l", "r").collect()} == {(1, 7), (2, None), (3, 8)}


def test_file_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"facts": [{"fact_id": "1", "value": "5"}, "text", None]}))
    (tmp_path / "b.json").write_text(json.dumps([{"fact_id": "2", "metric_definition": "d"}]))
    facts = files.read_fact_files(spark, str(tmp_path / "*.json"))
    assert {r.fact_id for r in facts.collect()} == {"1", "2"}
    gate = files.definition_gate(facts).collect()[0]
    assert (gate.facts, gate.without_definition, gate.passes) == (2, 1, False)
    assert not files.definition_gate(facts.limit(0)).collect()[0].passes
    (tmp_path / "c.jsonl").write_text('{"fact_id": "1"}\n{"fact_id": \n{"fact_id": "3"}\n')
    done = files.read_json_lines(spark, str(tmp_path / "c.jsonl"))
    assert [r.fact_id for r in files.remaining(facts, done, "fact_id").collect()] == ["2"]
    files.write_csv(facts, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), "fact_id string, company_id string")
    assert back.count() == 2
    files.append_json_lines(facts.select("fact_id", "value"), str(tmp_path / "out"), "fact_id")
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_page_and_fact_providers(spark, tmp_path):
    (tmp_path / "doc.txt").write_bytes("Water use was 5 kL. Nothing.\fSecond".encode())
    pages = providers.read_pages(spark.read.format("binaryFile").load(str(tmp_path / "doc.txt")))
    assert [(r.page, r.text) for r in pages.orderBy("page").collect()] == [(1, "Water use was 5 kL. Nothing."), (2, "Second")]
    found = providers.extract_facts(pages.selectExpr("concat('c', page) as chunk_id", "text as content")).collect()
    assert [(r.fact_id, r.metric, r.value, r.unit) for r in found] == [("c1_fact_1", "Water use", "5", "kL")]
    assert json.loads(providers.salvage_json_array('```json\n[{"a": "]"}, {"b": [1]}, {"c": ')) == [{"a": "]"}, {"b": [1]}]
    assert providers.salvage_json_array("none") is None


def test_stream_loads_each_key_once(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "k string, v int, t int")
    source, target, at = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    rows(("a", 1, 1), ("a", 2, 2), ("b", 1, 1)).write.parquet(source)
    schema = rows(("x", 1, 1)).schema
    resume.stream_once(spark, source, schema, "k", ["t"], target, at).awaitTermination()
    rows(("b", 9, 9), ("c", 3, 1)).write.mode("append").parquet(source)
    resume.stream_once(spark, source, schema, "k", ["t"], target, at).awaitTermination()
    assert {(r.k, r.v) for r in spark.read.parquet(target).collect()} == {("a", 2), ("b", 1), ("c", 3)}


@pytest.mark.parametrize("sql", ["drop table x", "select 1; select 2", "with a as (select 1) insert into b select * from a", "", "update x set y = 1"])
def test_guard_refuses(sql):
    with pytest.raises(ValueError):
        router.check_read_only(sql)


def test_guard_allows():
    assert router.check_read_only("SELECT 'drop; it' AS x FROM t -- note\n;") == "SELECT 'drop; it' AS x FROM t"


def test_names(spark):
    assert column(spark, ["Improved water use", "Water use", "use of the water", "a1 in 2024", "", None], say.name_risk(F.col("v"))) == ["high", "low", "medium", "high", "high", "high"]
    assert column(spark, ["The use of water in 3 plants by our own people now", None], say.proposed_id(F.col("v"))) == ["use_water_plants_our_own", None]
    assert column(spark, ["cities", "boxes", "wastes", "glass", "bus", "is"], say.singular(F.col("v"))) == ["city", "box", "waste", "glass", "bus", "is"]


def test_grid_to_text(spark):
    cells = spark.createDataFrame([("t", 0, 0, 0, 1, "a|b"), ("t", 1, 1, 0, 0, "x"), ("t", 1, 1, 1, 1, None), ("t", 2, 2, 1, 1, "y")], "k string, row int, row_end int, col int, col_end int, text string")
    assert [r.content for r in chunks.grid_to_text(cells, ["k"]).collect()] == ["| a\\|b | a\\|b |\n|---|---|\n| x |  |\n|  | y |"]


def test_page_operators(spark):
    from verdant.operators import pages

    toc = "Contents\n" + "\n".join(f"Chapter {w} ........ {i * 4 + 2}" for i, w in enumerate(("alpha", "beta", "gamma", "delta", "omega")))
    body = [("d", 1, toc)] + [("d", i * 4 + 5, f"Chapter {w}\nbody") for i, w in enumerate(("alpha", "beta", "gamma", "delta"))]
    frame = spark.createDataFrame(body, "doc string, page int, text string")
    entries = pages.contents_entries(frame, "doc", "page", "text")
    assert entries.count() == 5
    assert [(r.doc, r.offset) for r in pages.heading_offset(entries, frame, "doc", "page", "text").collect()][0][0] == "d"
    rows = spark.createDataFrame([("1", "d", "water"), ("2", "d", "the water used"), ("3", "e", "water"), ("4", "d", "all the water used")], "id string, k string, t string")
    assert {(r.dropped, r.kept) for r in pages.contained_rows(rows, ["k"], "id", "t").collect()} == {("1", "4"), ("2", "4")}
    table = spark.createDataFrame([("s", ["h", "-"], [str(i) for i in range(5)])], "k string, h array<string>, b array<string>")
    assert [r.content for r in pages.split_table_rows(table, ["k"], "h", "b", 2).orderBy("part").collect()] == ["h\n-\n0\n1", "h\n-\n2\n3", "h\n-\n4"]


def test_registry_files_and_review_sink(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"metrics": [{"canonical_id": "a", "aliases": ["x"]}, {"display_name": "no id"}, 7]}))
    (tmp_path / "o.json").write_text(json.dumps([{"canonical_id": "a", "unit": "kL", "aliases": ["X ", "y"]}, {"canonical_id": "b"}]))
    base, override = files.read_registry(spark, str(tmp_path / "r.json")), files.read_registry(spark, str(tmp_path / "o.json"))
    merged = {r.canonical_id: (r.unit, r.aliases) for r in review.merge_registry(base, override, "canonical_id", "aliases").collect()}
    assert merged == {"a": ("kL", ["x", "y"]), "b": (None, [])}
    files.write_review(spark.createDataFrame([("p|q", 1), (None, 2)], "name string, n int"), str(tmp_path / "out"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out" / "markdown")).collect())
    assert lines == sorted(["| name | n |", "|---|---|", "| p\\|q | 1 |", "|  | 2 |"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "csv")).count() == 2
    rows = spark.createDataFrame([("see #/texts/3 and #/texts/12, #/tables/3", 10), (None, 1)], "t string, o int")
    assert [r[0] for r in rows.select(files.shifted_references(F.col("t"), "texts", F.col("o"))).collect()] == ["see #/texts/13 and #/texts/22, #/tables/3", ""]


def test_long_registries_and_long_chains(spark, tmp_path, monkeypatch):
    registry = spark.range(30_000).select(F.concat(F.lit("m"), "id").alias("canonical_id"), F.concat(F.lit("metric no "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("display_name"), F.array().cast("array<string>").alias("aliases"))
    asked = []
    monkeypatch.setattr(router, "read_table", lambda *a: registry)
    monkeypatch.setattr(router.catalogue, "queries", lambda: {"cross_company_compare": lambda s, f: asked.append(f) or spark.createDataFrame([("m29999", "FY2024"), ("m1", "FY2024")], "canonical_id string, period string")})
    assert [r.canonical_id for r in router.route(spark, "x", "Compare metric no 029999").collect()] == ["m29999"]
    chain = spark.range(300)
    found = cluster.connected_components(chain.select("id"), chain.where("id > 0").select(F.col("id").alias("a"), (F.col("id") - 1).alias("b")))
    assert {r.component for r in found.collect()} == {0}


def test_new_number_and_period_rules(spark):
    values = ["(1,234.5)", "-3.4.5", "-", "abc", "--7", "(-2)", ""]
    assert column(spark, values, number.accounting_number(F.col("v"))) == [-1234.5, -3.45, None, None, -7.0, -2.0, None]
    assert column(spark, ["-"], number.accounting_number(F.col("v"), True)) == [0.0]
    assert column(spark, ["2,024", "1999", "(2020)", "2031"], number.year_like(F.col("v"))) == [True, False, False, False]
    rows = [("12 to 15", "it improved"), ("5 to 7", "it reduced from 5 to 7"), ("5 to 7", "plain"), ("5 to 7", "expects it reached")]
    assert column(spark, rows, number.primary_number(F.col("v"), F.col("s")), "v string, s string") == [None, 7.0, None, None]
    labels = [("current year", "under Rules 2016", "measurement"), ("open-ended", "", "target"), ("2023-24", "", ""), ("as of March 2022", "", ""), ("", "calendar 2021", ""), (None, None, None)]
    label, how = period.stated_label(F.col("a"), F.col("b"), F.col("c"), F.lit("FY2024"), F.lit(2024))
    frame = spark.createDataFrame(labels, "a string, b string, c string").select(label.alias("l"), how.alias("h"))
    assert [tuple(r) for r in frame.collect()] == [("FY2024", "inferred"), ("open_ended", "inferred"), ("FY2024", "extracted"), ("FY2022", "extracted"), ("CY2021", "extracted"), ("FY2024", "inferred")]
    asked = [("FY2023", "full_year", ""), ("", "target", "by 2030"), ("", "cumulative", "since 2018"), ("as of June 2022", "point_in_time", ""), ("Q2 FY2024", "partial", ""), ("H2 FY2024", "partial", ""), ("", "partial", ""), ("x", "other", "")]
    r = period.resolve_period(F.col("a"), F.col("b"), F.col("c"), F.lit("FY2024"), F.lit(3))
    got = [(str(x.r.start), str(x.r.end), x.r.resolution) for x in spark.createDataFrame(asked, "a string, b string, c string").select(r.alias("r")).collect()]
    assert got == [
        ("2022-04-01", "2023-03-31", "resolved"), ("None", "2030-12-31", "resolved"), ("2018-01-01", "2024-03-31", "resolved"), ("2022-06-30", "2022-06-30", "resolved"),
        ("2023-07-01", "2023-09-30", "resolved"), ("2023-10-01", "2024-03-31", "resolved"), ("None", "None", "inferred"), ("None", "None", "unresolvable"),
    ]
    names = ["Category 4 upstream transport in scope 3", "scope 3 business travel", "business travel"]
    assert column(spark, names, say.scope3_category(F.col("v"), F.lit(""))) == [4, 6, None]


def test_checkpoint_folder_is_refused_on_a_cluster(monkeypatch):
    from verdant import session

    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master, getCheckpointDir, getConf = "spark://host:7077", staticmethod(lambda: None), staticmethod(lambda: Conf)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._shared_folder(Session)


def test_reprints_encoder_and_candidates(spark):
    texts = ["News. Reprinted from The Daily. Rest", "plain", "reprinted from ", "Dear shareholders: we", "Intro. To our shareholders : hello", None, "x" * 100_000 + " originally published 1990"]
    got = column(spark, texts, text.reprint_parts(F.col("v")))
    assert got[0] == ("News.", "Reprinted from The Daily. Rest") and got[1] is None and got[3] is None and got[5] is None
    assert got[2] == ("", "reprinted from") and got[6].before == "x" * 100_000
    letters = column(spark, texts, text.reprint_parts(F.col("v"), at_letters=True))
    assert letters[3] is None and letters[4] == ("Intro.", "To our shareholders : hello")
    rows = spark.createDataFrame([(1, "water used"), (2, "Water USED, used"), (3, None), (1, "water used")], "k int, t string")
    vectors = {r.key: r.vector for r in providers.embed_texts(rows, "k", "t").collect()}
    assert len(vectors) == 3 and set(vectors[3]) == {0.0} and math.isclose(sum(x * x for x in vectors[1]), 1.0)
    sparse = {(r.key, r.slot): r.w for r in resolve.hashed_vectors(rows.where("k < 3").distinct(), "k", "t").withColumnRenamed("k", "key").collect()}
    assert all(math.isclose(vectors[k][slot], w, abs_tol=1e-12) for (k, slot), w in sparse.items())
    assert providers.embed_texts(rows.limit(0), "k", "t").count() == 0
    pairs = [("total plastics", "waste_plastic", "kg", "kg"), ("total water", "waste_plastic", "kg", "kg"), ("total water", "waste_plastic", "kg", "GJ")]
    valid = matching.candidate_valid(F.col("a"), F.col("b"), F.col("c"), F.col("d"), F.lit("scalar"), {"waste_plastic": ["plastics"]})
    assert column(spark, pairs, valid, "a string, b string, c string, d string") == [False, True, False]


def test_definitions_bands_and_ties(spark):
    from verdant.plans import outcomes

    assert column(spark, ["", None, "N/A", "too short", "long enough to be one"], outcomes.definition_failed(F.col("v"))) == [True, True, True, True, False]
    made = outcomes.described(F.col("v"), F.lit("steam"))
    assert column(spark, ["volume", "other", None], made) == ["The volume associated with steam.", "A business metric measuring steam.", "A business metric measuring steam."]
    rng = random.Random(6)
    values = [0.0, -0.0, 1e-9, -5.0, -5.04, 100.0, 101.0] + [rng.uniform(-200, 200) for _ in range(80)]
    frame = spark.createDataFrame([(i, v, f"d{i % 3}", "k") for i, v in enumerate(values)], "i int, v double, d string, k string")
    got = {(r.asked, r.found) for r in review.nearest_values(frame, frame, ["k"], "i", "i", "v", "d", most=1000).collect()}
    assert got == {(a, b) for a, x in enumerate(values) for b, y in enumerate(values) if a != b and abs(x - y) <= 0.04 * abs(x)}
    scored = spark.createDataFrame([("m", "a", 0.9), ("m", "b", 0.9), ("m", "c", 0.7), ("m", "d", 0.69), ("n", "a", 0.1)], "m string, c string, s double")
    assert {(r.m, r.c, r.place) for r in review.margin_ties(scored, "m", "c", "s").collect()} == {("m", "a", 1), ("m", "b", 2), ("m", "c", 3), ("n", "a", 1)}
    facts = spark.createDataFrame([("1", "k", "", None, 5), ("2", "k", "plant", None, 1), ("3", "k", "plant", None, 2), ("4", "k", None, "north", 1), ("5", None, "", "-", 1)], "id string, k string, e string, s string, x int")
    kept = {(r.record, r.specific) for r in dedup.anchored(facts, {"k0": F.col("k")}, ["e", "s"], F.struct("x"), "id", "id").collect()}
    assert kept == {("3", True), ("4", True), ("5", False)}


def test_anchored_facts_order_by_numbers_of_any_length(spark, tmp_path):
    made = [("co_7_p1_fact_" + "9" * 24, "k1"), ("co_7_p1_fact_1" + "0" * 24, "k1"), ("co_07_p1_fact_" + "8" * 24, "k1"), ("fact", "k2"), ("co_7_p2_fact_1", "k3"), ("co_7_p1_fact_21", "k4"), ("co_7_p12_fact_1", "k4")]
    rows = [(i, "d", m, "5", "kg", None, None, None, "so it is", "keep", 0.5) for i, m in made]
    schema = "fact_id string, doc_id string, metric string, value string, unit string, period string, entity string, segment string, evidence string, decision string, confidence double"
    facts = spark.createDataFrame([(*r[:2], f"water {'abcd'[int(r[2][1]) - 1] * 3}", *r[3:]) for r in rows], schema)
    facts.unionByName(facts).withColumn("ingested_at", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "extracted_fact.parquet"))
    got = sorted((r.fact_id, r.specific) for r in resolution.anchored_facts(spark, str(tmp_path)).collect())
    assert got == [("co_07_p1_fact_" + "8" * 24, False), ("co_7_p12_fact_1", False), ("co_7_p2_fact_1", False), ("fact", False)]


def test_dedup_cascade_orders_by_numbers_of_any_length(spark, tmp_path):
    made = [("co_7_p1_fact_" + "9" * 24, "water", "c1"), ("co_7_p1_fact_1" + "0" * 24, "water", "c2"), ("co_07_p1_fact_" + "8" * 24, "water", "c3"), ("fact", "waste", "c4"), ("co_7_p1_fact_21", "fuel", "c5"), ("co_7_p12_fact_1", "fuel", "c6")]
    blank = [("x" + "7" * 30, None, "c7"), ("x" + "7" * 31, None, "c8")]  # no stage applies: both stay
    rows = [(i, "d", m, "5", "kg", m and f"{m} was 5 kg", "keep", 0.5, c) for i, m, c in made + blank]
    facts = spark.createDataFrame(rows, "fact_id string, doc_id string, metric string, value string, unit string, evidence string, decision string, confidence double, chunk_id string")
    facts.unionByName(facts).withColumn("ingested_at", F.monotonically_increasing_id()).write.parquet(str(tmp_path / "extracted_fact.parquet"))
    got = {r.fact_id: r.merged for r in resolution.dedup_cascade(spark, str(tmp_path)).collect()}
    assert got == {"co_07_p1_fact_" + "8" * 24: "c1,c2", "fact": "", "co_7_p12_fact_1": "c5", "x" + "7" * 30: "", "x" + "7" * 31: ""}
