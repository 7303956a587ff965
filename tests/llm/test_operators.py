"""Small fixtures for the training-data operators: empty tables, nulls, ties, repeats, clashing columns, brute force."""

import random
import re
import time
import types
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from verdant.llm import canonical, golden, leak, mixing, neardup, skeleton, split, wording

DOC = "doc_id long, text string, lang string, id string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x") for i, t in enumerate(texts)], DOC)


# ---- problem 8


@pytest.mark.parametrize(
    "a, b",
    [("ﬁne", "fine"), ("Ｆｕｌｌ９", "Full9"), ("été", "été"), ("саt", "cat"), ("a​b­", "ab"), ("a b", "a b"), ("co‑op", "co-op"), ("Οο", "Oo")],
)
def test_look_alikes_have_one_form(a, b):
    assert skeleton.consistent(a) == skeleton.consistent(b)


@pytest.mark.parametrize("a, b", [("A", "a"), ("é", "e"), ("m³", "m3"), ("CO₂", "CO2"), ("a b", "a  b"), ("a\nb", "a b"), ("a.", "a"), ("в", "b")])
def test_real_differences_stay(a, b):
    assert skeleton.consistent(a) != skeleton.consistent(b)


@pytest.mark.parametrize("a, b", [("a\U000E0100", "a"), ("a\U000E0041b", "ab"), ("\U0001D400", "A"), ("\U0001D7CF", "1"), ("ℊ", "g")])
def test_characters_past_the_first_plane(a, b):
    assert skeleton.consistent(a) == b


def test_form_is_idempotent_for_every_character():
    for code in range(0x80, 0x3000):
        once = skeleton.consistent(chr(code))
        assert skeleton.consistent(once) == once
        assert unicodedata.is_normalized("NFC", once)


def test_look_alike_pairs(spark):
    df = docs(spark, ["abc", "аbc", "abc", "ABC", None, "", "", "abd"]).unionByName(docs(spark, ["abc"]))
    got = {tuple(r) for r in skeleton.look_alike_pairs(df).collect()}
    assert got == {(0, 1), (1, 2)}
    assert skeleton.look_alike_pairs(df.limit(0)).count() == 0 and skeleton.look_alike_classes(df.limit(0)).count() == 0
    assert {tuple(r) for r in skeleton.look_alike_classes(df).collect()} == {(0, 0, 0), (1, 0, 1), (2, 0, 0)}
    forms = {(r.doc_id, r.text, r.changed) for r in skeleton.consistent_texts(df).collect()}
    assert (1, "abc", True) in forms and (4, None, False) in forms and (5, "", False) in forms


# ---- problem 6


def test_leaks_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"wörd{i}" if i % 7 == 0 else f"word{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(6, 30)))) for i in range(15)] + [(90, None), (91, "")]
    texts = []
    for _ in range(60):
        body = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.6:
            words = rng.choice(items[:15])[1].split()
            start = rng.randrange(len(words))
            body[10:10] = words[start : start + rng.randint(5, 20)]
        texts.append(", ".join(body).upper().replace("O", "О") if rng.random() < 0.3 else " ".join(body))
    texts += [None, "", "x" * 5000]
    want = set()
    for i, t in items:
        w = leak.words_of(t)
        runs = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        for d, text in enumerate(texts):
            v = leak.words_of(text)
            if runs & {tuple(v[k : k + 12]) for k in range(len(v) - 11)}:
                want.add((d, i))
    frame = docs(spark, texts)
    queries = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leak.leaked_passages(frame, queries).where("words >= 12").collect()}
    assert got == want and want
    assert leak.leaked_passages(frame.limit(0), queries).count() == 0
    assert leak.leaked_passages(frame, queries.limit(0)).count() == 0
    named = leak.leaked_passages(frame.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), queries.withColumn("item_id", F.concat(F.lit("i"), "item_id")))
    assert {(int(r.doc_id[1:]), int(r.item_id[1:])) for r in named.where("words >= 12").collect()} == want  # ids of any type
    blocks = leak.leaked_passages(frame, queries, max_index_mb=0)  # one item a block
    assert {(r.doc_id, r.item_id) for r in blocks.where("words >= 12").collect()} == want


def test_edited_passage_is_found(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wizards quietly polish boxes"
    edited = "well " + item.replace("lazy", "lasy").replace("quietly", "quietley") + " indeed"
    rows = leak.leaked_passages(docs(spark, [edited]), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.words, r.edits) for r in rows] == [(0, 2)]


def fewest_edits(text, doc):
    """Plain dynamic programming over the whole document, both ends free."""
    prev = [0] * (len(doc) + 1)
    for i, c in enumerate(text, 1):
        row = [i]
        for p, d in enumerate(doc, 1):
            row.append(min(prev[p - 1] + (c != d), prev[p] + 1, row[-1] + 1))
        prev = row
    return min(prev)


def test_edited_passages_match_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"wind{i}" if i % 3 else f"solar{i}power" for i in range(80)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(12, 45)))) for i in range(8)]
    texts = []
    for n in range(40):
        words = items[n % 8][1].split()
        kept = [w if rng.random() < 0.93 else w[:-1] + rng.choice(["", "z", "zz"]) for w in words]
        cut = rng.randrange(len(kept))
        kept[cut : cut + rng.randint(0, 3)] = [rng.choice(vocabulary) for _ in range(rng.randint(0, 3))]
        first = rng.randint(0, 8)
        texts.append(" ".join(["lead"] * rng.randint(0, 5) + kept[first : first + rng.randint(9, 30)] + ["tail"]))
    want = set()
    for i, t in items:
        w = t.split()
        for d, text in enumerate(texts):
            if any(fewest_edits(" ".join(w[k : k + 12]), text) <= 2 for k in range(len(w) - 11)):
                want.add((d, i))
    rows = leak.leaked_passages(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and 5 < len(want) < 35
    for r in rows:
        text = dict(items)[r.item_id][r.item_start : r.item_start + r.matched_chars]
        assert len(text.split()) >= 12 and r.edits == fewest_edits(text, texts[r.doc_id])


def test_every_region_is_verified_and_must_span_min_words(spark):
    words = [f"{a}{b}" for a in ("alpha", "bravo", "carbon", "delta") for b in ("kilo", "lima", "metric", "nova", "orbit", "papa", "quota", "river", "sigma", "total")]
    item = " ".join(words)
    gap = " ".join("x" * len(w) for w in words[13:27])
    near = lambda run: " ".join(run[:4] + [run[4][:-1] + "q"] + run[5:])
    two = " ".join([near(words[:13]), gap, near(words[27:])])  # same diagonal, other text between
    eleven = " ".join(words[:11])
    rows = leak.leaked_passages(docs(spark, [two, eleven]), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.words, r.edits) for r in rows] == [(0, 0, 1)]


# ---- problem 7


def test_token_count_is_word_punct(spark):
    samples = ["a b, c...", "naïve_1 été!", "éx", "日本 語。", None, "", "\x85a b"]
    got = [r.n for r in docs(spark, samples).orderBy("doc_id").select(mixing.token_count(F.col("text")).alias("n")).collect()]
    assert got == [len(re.findall(r"\w+|[^\w\s]+", s)) if s else 0 for s in samples]


def test_mixture_reaches_shares_and_caps(spark):
    rows = [(i, "w " * (1 + i % 50), "Big " if i % 2 else "big") for i in range(2000)] + [(5000 + i, "w " * 10, "small") for i in range(20)] + [(9000, None, "big"), (9001, "w", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 2), ("small", 0.5, 3), ("none", 0.0, 1)], "source string, target_share double, max_repeats int")
    sampled, report = mixing.mix_sources(frame, targets)
    r = {x.source: x for x in report.collect()}
    assert abs(r["big"].reached / r["big"].wanted - 1) < 0.01
    assert r["small"].short and r["small"].reached == r["small"].capacity == 20 * 10 * 3
    assert r["none"].reached == 0 and not r["none"].short
    assert sampled.where("copies > 3").count() == 0 and sampled.select("doc_id").distinct().count() == sampled.count()
    _, even = mixing.mix_sources(frame, targets.where("target_share > 0"), keep_shares=True)
    assert all(abs(x.reached_share - x.target_share) < 0.01 and not x.short for x in even.collect())
    _, nothing = mixing.mix_sources(frame.limit(0), targets)
    assert {x.reached for x in nothing.collect()} == {0}


# ---- problem 1


def test_pieces_rebuild_the_text(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["word ", "long" * 9 + " ", "end. ", "\n\n", "é", "| a | b |\n"]) for _ in range(rng.randint(0, 1500))) for _ in range(25)]
    texts += ["x" * 9000, " " * 3000, "", None, "ab" * 960, "ab" * 960 + "c"]
    frame = docs(spark, texts).unionByName(docs(spark, texts))
    pieces = split.split_oversized(frame, ["doc_id"], "text").collect()
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == {i for i, t in enumerate(texts) if t and (len(t) + 3) // 4 > 480}
    for i, own in by.items():
        own.sort(key=lambda p: p.piece_no)
        assert [p.piece_no for p in own] == list(range(1, own[0].n_pieces + 1))
        assert "".join(p.content[p.overlap_chars :] for p in own) == texts[i]
        for before, p in zip([None, *own], own):
            assert p.token_estimate == (len(p.content) + 3) // 4 <= 480
            assert p.content == texts[i][p.start : p.end]
            if before:
                assert 30 <= (p.overlap_chars + 3) // 4 <= 40 and before.content.endswith(p.content[: p.overlap_chars])
    assert split.split_oversized(frame.limit(0), ["doc_id"], "text").count() == 0
    assert split.split_oversized(frame, ["doc_id"], "text", keep_small=True).where("n_pieces = 1").count() == sum(t is not None and len(t) <= 1920 for t in texts)


# ---- problem 2

FACT = "fact_id string, doc_id string, company_id string, chunk_id string, metric string, value string, unit string, period string, period_type string, fact_type string, entity string, segment string, page_start int, page_end int, evidence string, confidence double, decision string, extracted_at timestamp"


def fact(i, value="1,200", conf=0.5, evidence="seen", metric="Water In", unit="kL", at="2024-01-01", doc="d", chunk=None):
    import datetime

    return (i, doc, "c", chunk or f"k_{i}", metric, value, unit, None, None, None, "", None, 1, 2, evidence, conf, "keep", datetime.datetime.fromisoformat(at))


def test_survivor_rules(spark):
    rows = [
        fact("a", conf=float("nan")), fact("b", value="1200.0", conf=7.0, evidence="a longer text "), fact("c", value="1 200", conf=0.0, unit=" KL ", evidence=None),
        fact("t2"[::-1] + "x", doc="e"), fact("p", doc="e", at="2024-02-01"), fact("q", doc="e", at="2024-02-01"), fact("n", value="nil", doc="e"), fact("m", metric=None, doc="e"), fact("z", metric="!!", doc="e"),
    ]
    frame = spark.createDataFrame([*rows, rows[0]], FACT)
    found = golden.best_records(frame, golden.fact_group_key(frame), "fact_id", golden.survivor_fields()).collect()
    assert {(r.fact_id, r.evidence_fact_id, r.members) for r in found} == {("c", "b", 3), ("p", "2tx", 3)}
    merged = {r.fact_id: r for r in golden.merge_facts(frame).collect()}
    assert merged["c"].evidence == "a longer text" and merged["c"].duplicate_chunk_ids == ["k_a", "k_b"] and merged["c"].confidence == 0.0
    assert golden.merge_facts(frame.limit(0)).count() == 0


def test_votes_are_summed_and_chunks_listed(spark):
    # two rescued records outvote a kept one for the entity only while each counts for half of it, and age halves a vote
    rows = [
        (*fact("a", conf=0.9, chunk="k1")[:10], "Plant A", *fact("a")[11:]),
        (*fact("b", conf=0.4, chunk="k2")[:10], "plant b ", *fact("b")[11:]),
        (*fact("c", conf=0.3, chunk="k2")[:10], "Plant B", *fact("c")[11:]),
        (*fact("d", conf=0.2, chunk="k3", at="2022-01-01")[:10], "Plant C", *fact("d")[11:]),
    ]
    frame = spark.createDataFrame(rows, FACT).withColumn("decision", F.when(F.col("fact_id").isin("b", "c"), "rescue").otherwise("keep"))
    one = lambda trust: golden.merge_facts(frame, source_trust=trust).collect()[0]
    assert one({"rescue": 0.6, "keep": 1.0}).entity.strip().lower() == "plant b"
    assert one({"rescue": 0.4, "keep": 1.0}).entity == "Plant A"
    survivor = one(None)
    assert survivor.fact_id == "a" and survivor.duplicate_chunk_ids == ["k2", "k3"]
    assert {tuple(r) for r in golden.duplicate_chunks(frame).collect()} == {("a", "k2"), ("a", "k3")}
    assert golden.duplicate_chunks(frame.limit(0)).count() == 0


def test_plain_number(spark):
    samples = {"1,200.50": "1200.5", "0012": "12", "-0.0": "0", "-3": "-3", "1 000": "1000", ".5": None, "5.": None, "1e3": None, "": None, "~4": None}
    frame = spark.createDataFrame([(k,) for k in samples], "v string")
    assert {r.v: r.n for r in frame.select("v", golden.plain_number(F.col("v")).alias("n")).collect()} == samples


# ---- problem 3


def test_canonical_mapping(spark):
    reference = spark.createDataFrame(
        [("water_in", "Total water withdrawal", ["freshwater withdrawn"], "x"), ("ghg_direct", "Scope 1 GHG emissions", None, "y"), ("ghg_chain", "Scope 3 GHG emissions", ["value chain emissions"], "y"),
         ("haz", "Hazardous waste generated", ["haz waste produced"], "z"), ("nonhaz", "Non-hazardous waste generated", ["non-haz waste produced"], "z"), ("steam", "Purchased steam", [], None)],
        "canonical_id string, display_name string, aliases array<string>, value string",
    )
    want = {
        "WATER_IN": "water_in", "withdrawal, total water": "water_in", "Total watr withdrawl (kL)": "water_in", "S1 GHG emsns": "ghg_direct", "Scope3GhgEmissions": "ghg_chain", "Key indicator: Value chain emiss. [KPI]": "ghg_chain",
        "hazwasteproduced": "haz", "Non-haz. waste produced": "nonhaz", "Hazardous waste gen.": "haz", "Chess club membership": "unmatched", "Waste bins purchased": "unmatched", "!!": "unmatched", "long " * 900: "unmatched",
    }
    rows = spark.createDataFrame([(i, m, "clash") for i, m in enumerate([*want, None, "  ", "WATER_IN"])], "fact_id long, metric string, canonical_id string")
    got = {r.value: r.canonical_id for r in canonical.map_values(rows, ["fact_id"], "metric", reference).collect()}
    assert got == want
    assert canonical.map_values(rows, ["fact_id"], "metric", reference).count() == len(want) + 1
    assert {r.canonical_id for r in canonical.map_values(rows, ["fact_id"], "metric", reference.limit(0)).collect()} == {"unmatched"}
    assert canonical.map_values(rows.limit(0), ["fact_id"], "metric", reference).count() == 0


def test_prefix_join_loses_no_pair(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(4, 14))) for _ in range(40)})
    forms = sorted({"".join(c if rng.random() > 0.15 else rng.choice("abcde") for c in rng.choice(names)) for _ in range(150)})
    rule = canonical.MatchRule()
    reference = spark.createDataFrame([(n, n, [n]) for n in names], "name string, canonical_id string, rotations array<string>")
    got = {(r.form, round(r.score, 9)) for r in canonical.match_forms(spark.createDataFrame([(f,) for f in forms], "form string"), reference, rule).collect()}
    want = set()
    for f in forms:
        best = max(canonical.verify(f, n, [n], rule) for n in names)
        if best >= 0:
            want.add((f, round(best, 9)))
    assert got == want


def test_metric_form_of_blank_and_odd_text():
    assert wording.metric_form(None) is None and wording.metric_form("  ") is None and wording.metric_form("??") == "?"


# ---- problem 4


def brute_pairs(texts, k, t):
    sets = {i: set(zip(*(neardup.plain_words(x)[j:] for j in range(k)))) for i, x in enumerate(texts) if x}
    return {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-12}


@pytest.mark.parametrize("k, t", [(3, 0.5), (5, 0.8), (1, 0.3)])
def test_near_duplicates_match_brute_force(spark, k, t):
    rng = random.Random(k)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(3, 40))] for _ in range(12)]
    texts = []
    for _ in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(2)] = [f"w{rng.randrange(60)}"] * rng.randrange(1, 2)
        texts.append("-".join(w) if rng.random() < 0.2 else " ".join(w).upper())
    texts += [None, "", "one two", texts[0], "long text " * 70_000, "long text " * 70_000]
    frame = docs(spark, texts).unionByName(docs(spark, texts[:5]))
    rule = neardup.NearRule(words=k, similarity=t)
    near = neardup.near_duplicates(frame, "doc_id", F.col("text"), rule)
    assert {(r.id_a, r.id_b) for r in near.pairs().distinct().collect()} == brute_pairs(texts, k, t)
    assert near.classes().count() == sum(len(neardup.plain_words(x or "")) >= k for x in texts)
    empty = neardup.near_duplicates(frame.limit(0), "doc_id", F.col("text"), rule)
    assert empty.pairs().count() == 0 and empty.classes().count() == 0 and empty.named_links().count() == 0


def test_one_text_in_many_copies_and_long_texts(spark):
    """Copies in every partition, sets past 65,535 shingles, and a tally of one and of many."""
    rng = random.Random(8)
    long = [f"v{rng.randrange(10**9)}" for _ in range(70_000)]
    nearly = long[:35_000] + ["other"] * 40 + long[35_040:]
    texts = ["hot text of a good many words that is copied over and over"] * 500 + ["hot text of a good many words that is copied over and again", " ".join(long), " ".join(nearly)]
    frame = docs(spark, texts).repartition(7)
    for tally in (1, 3, 50):
        near = neardup.near_duplicates(frame, "doc_id", F.col("text"), neardup.NearRule(words=3, similarity=0.6, tally=tally))
        links = {(r.class_a, r.class_b, round(r.similarity, 6)) for r in near.named_links().collect()}
        sets = [set(zip(*(t.split()[j:] for j in range(3)))) for t in (texts[0], texts[500], texts[501], texts[502])]
        assert links == {(0, 500, round(len(sets[0] & sets[1]) / len(sets[0] | sets[1]), 6)), (501, 502, round(len(sets[2] & sets[3]) / len(sets[2] | sets[3]), 6))}
        assert near.classes().where("class_id = 0").first().copies == 500


def near_texts(n):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(n // 4)]
    return [" ".join([*base[i % len(base)][:-1], f"end{i}"]) for i in range(n)]


def test_posted_bytes_leave_the_disk_with_their_step(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        found = []
        while files.hasNext():
            f = files.next()
            if re.match(r"shuffle_.*\.data$", f.getName()):
                found.append(f.length())
        return sum(found)

    frame = docs(spark, near_texts(2000))
    rule = neardup.NearRule(words=3, similarity=0.5)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled()
        near = neardup.near_duplicates(frame, "doc_id", F.col("text"), rule)
        until = time.time() + 10
        while shuffled() - before > 300_000 and time.time() < until:  # files are removed in the background
            time.sleep(0.2)
        assert shuffled() - before < 300_000  # 1.9 MB where the postings stay
        assert near.pairs().count() == near.named_links().count() == 500 * 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_postings_are_never_broadcast(spark):
    columns = [column.split() for column in neardup._POSTING.split(",")]
    postings = spark.range(9).select(*[F.col("id").cast(kind).alias(name) for name, kind in columns])
    plan = neardup.tallied_pairs(postings, neardup.NearRule())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("last", [0, 2, (1 << 23) - 1])
def test_places_past_the_last_lose_no_pair(spark, monkeypatch, last):
    monkeypatch.setattr(neardup, "_LAST_PLACE", last)
    texts, rule, bits = near_texts(40), neardup.NearRule(words=3, similarity=0.5), neardup.LEAST_BITS
    sketch = types.SimpleNamespace(value=zlib.compress(np.full(1 << bits, 9, np.uint8).tobytes()))
    posted = pd.concat(neardup._post(rule, bits, sketch)(iter([pd.DataFrame({"text": texts})])))
    assert (posted["spot"] >= 0).all() and (posted["spot"] // 2**40).max() <= last
    s = neardup._describe(texts, 3)
    number = {c: i for i, c in enumerate(zip(s.id_hi.tolist(), s.id_lo.tolist()))}
    rows = neardup.tallied_pairs(spark.createDataFrame(posted, neardup._POSTING), rule).collect()
    got = {tuple(sorted((number[r.a_hi, r.a_lo], number[r.b_hi, r.b_lo]))) for r in rows}
    assert got >= brute_pairs(texts, 3, 0.5)
