"""Text problems: invariants, brute force and held-out accuracy."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulselake.llm import abuse, leakage, packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=80), st.integers(1, 6))
def test_open_bins(sizes, most):
    bins, used = packing.OpenBins(50, most), {}
    for n in sizes:
        k = bins.put(n)
        used[k] = used.get(k, 0) + n
        assert used[k] <= 50 and bins.open <= most
    free = dict(bins.closed) | dict(bins.rest())
    assert free == {k: 50 - n for k, n in used.items()}


def test_best_fit_takes_the_tightest():
    bins = packing.OpenBins(10, 5)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [0, 1, 1, 0]


def test_packing(spark):
    rnd = random.Random(3)
    texts = ["", None, "word " * 700, "a", "a"] + [" ".join(["token"] * rnd.randrange(1, 60)) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, tokens int").repartition(3)
    out = packing.pack_texts(df, capacity=200, open_bins=4).collect()
    sizes = {i: packing.count_tokens(t) for i, t in enumerate(texts)}
    per_doc, per_bin = {}, {}
    for r in out:
        per_doc.setdefault(r["doc_id"], []).append(r)
        per_bin[r["container_id"]] = per_bin.get(r["container_id"], 0) + r["tokens"]
    assert {d: sum(r["tokens"] for r in rs) for d, rs in per_doc.items()} == sizes
    assert all(len(rs) == 1 for d, rs in per_doc.items() if sizes[d] <= 200) and len(per_doc[2]) == 4
    assert all(n <= 200 for n in per_bin.values())
    assert all(abs(r["filled"] - per_bin[r["container_id"]] / 200) < 1e-9 for r in out)
    assert packing.pack_texts(df.limit(0)).count() == 0


def brute_longest(doc, item):
    best = 0
    for i in range(len(doc)):
        for j in range(len(item)):
            k = 0
            while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k]:
                k += 1
            best = max(best, k)
    return best


def test_automaton_against_brute_force():
    rnd = random.Random(2)
    for _ in range(40):
        items = [[rnd.choice("abcdef") for _ in range(rnd.randrange(3, 25))] for _ in range(4)]
        a = leakage.ItemAutomaton(list(enumerate(items)))
        doc = [rnd.choice("abcdefg") for _ in range(40)]
        got = [0] * len(items)
        for state, _, n in a.anchors([a.ids.get(w, -1) for w in doc]):
            for k, _ in a.ends[state]:
                got[k] = max(got[k], n)
        want = [brute_longest(doc, it) for it in items]
        assert got == [n if n >= leakage.ANCHOR else 0 for n in want]


ITEM = "Unless our forgotten reafix of Bruwul nearly delayed this walker, our distant glare soon masked our fibox with 199.6 sprinters"


@pytest.mark.parametrize(
    "text",
    [
        ITEM, ITEM.upper(), ITEM.replace(" ", "  \t"), ITEM.replace("o", "о").replace("e", "е"), "**" + ITEM.replace(",", " ,") + "**", "<p>" + ITEM.replace(" ", "&nbsp;") + "</p>", ITEM.replace("forgotten", "forgot-\nten").replace("distant", "dis-\n> tant"),
        ITEM.replace("nearly", "almost"), ITEM.replace("nearly ", ""), ITEM.replace("nearly", "nearly then"), ITEM.replace("soon", "so​on"), "x " * 500 + ITEM[:110] + " y" * 500,
    ],
)
def test_leaks_however_they_look(text):
    a = leakage.ItemAutomaton([(7, leakage.words(ITEM))])
    n, coverage, first, end = a.longest(text)[7]
    assert n >= leakage.MIN_WORDS and coverage <= 1 and end - first >= n - 1
    left = leakage.without_spans("Before it. " + text + " And after it.", [(first + 2, end + 2)])
    assert left.startswith("Before it.") and left.endswith("And after it.") and not a.longest(left)


def test_a_passage_shared_by_two_items_counts_for_both():
    shared = "one two three four five six seven eight nine ten eleven twelve thirteen"
    a = leakage.ItemAutomaton([(1, leakage.words(shared + " alpha beta")), (2, leakage.words("gamma " + shared))])
    assert {k: v[0] for k, v in a.longest("so " + shared + " alpha beta delta").items()} == {1: 15, 2: 13}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["word", "Wörter", "3 .5", "<b>bold</b>", "<a href='x y'>", "[link](http://x)", "bro-\nken", "&amp;", "е", "\n", "a​b", "naïve"]), max_size=30))
def test_located_words(parts):
    text = " ".join(parts)
    ws, begin, end = leakage.located_words(text)
    assert ws == leakage.words(text) and len(begin) == len(end) == len(ws)
    assert begin == sorted(begin) and all(a <= b for a, b in zip(begin, end))


def test_cleaned(spark):
    docs = [(1, "Someone said: " + ITEM + ". Then more."), (2, "Nothing of it."), (3, None), (4, ""), (5, ITEM + "\n\n" + ITEM), (6, "Here: w1 w2 w3 w4 w5 w6 w7 w8.")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(1, ITEM), (2, "w1 w2 w3 w4 w5 w6 w7 w8")], "item_id long, text string")
    for block in (10, 10**6):
        out = {r["doc_id"]: (r["text"], r["spans_removed"]) for r in leakage.cleaned(d, i, block_words=block).collect()}
        assert out[1] == ("Someone said: Then more.", 1) and out[2] == ("Nothing of it.", 0) and out[3] == (None, 0) and out[4] == ("", 0)
        assert out[5] == ("", 2) and out[6] == ("Here:", 1)
    assert leakage.cleaned(d.limit(0), i).count() == 0 and leakage.cleaned(d, i.limit(0)).where("text IS NULL").count() == 1


def test_leaked(spark):
    tail = " Choose the best answer and explain your reasoning in one short sentence of at most ten words."
    items = [(1, ITEM + tail), (2, "too short"), (3, None)] + [(10 + i, f"w{i}a w{i}b w{i}c." + tail) for i in range(5)]
    docs = [(1, "Someone said: " + ITEM), (2, "Someone quoted 'our forgotten reafix of Bruwul nearly'"), (3, tail), (4, None), (5, ""), (6, ITEM)]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (10, 10**6):
        assert sorted((r["doc_id"], r["item_id"]) for r in leakage.leaked(d, i, block_words=block).collect()) == [(1, 1), (6, 1)]
    assert leakage.leaked(d.limit(0), i).count() == 0 and leakage.leaked(d, i.limit(0)).count() == 0


WORDS = {w: 100 for w in "the world would be cleaner without women you are a stupid idiot disgusting clown thrown out of country kissed slid moron sick send nudes".split()}


@pytest.mark.parametrize(
    ("token", "word"),
    [("stupid", "stupid"), ("$tup1d", "stupid"), ("st*pid", "stupid"), ("i****", "idiot"), ("ksised", "kissed"), ("disgustng", "disgusting"), ("cl3@n3r", "cleaner"), ("wom3n", "women"), ("12345", "12345"), ("zzyzx", "zzyzx")],
)
def test_decoding(token, word):
    assert abuse.PrefixModel(WORDS).word(token) == word


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_misspellings_however_large_the_corpus(times):
    seen = WORDS | {"from": 800, "form": 100, "sutpid": 2, "stuuuupid": 3, "idoit": 1, "disgustng": 1, "cloown": 1}
    model = abuse.PrefixModel({w: n * times for w, n in seen.items()})
    ws = [w for p in abuse.passages("a sutpid stuuuupid disgustng idoit and cloown form", model) for w in p]
    assert ws == ["a", "stupid", "stupid", "disgusting", "idiot", "and", "clown", "form"]


@pytest.mark.parametrize("text", ["you are a stuuuupid idiot", "t h r o w n out of the country", "yоu аrе a stuрid idiоt", "YOU ARE A STUPID IDIOT!!", "y.o.u are a stupid idiot"])
def test_restoring(text):
    ws = [w for p in abuse.passages(text, abuse.PrefixModel(WORDS)) for w in p]
    assert ws in ("you are a stupid idiot".split(), "thrown out of the country".split())


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("c.l.e.a.n.e.r w-i-t-h-o-u-t women", "cleaner without women"),
        ("you are a m o r o n", "you are a moron"),
        ("I w-a-n-t nudes", "i want nudes"),
        ("you i. d. i. o. t", "you idiot"),
        ("a 1 d 1 0 t", "a idiot"),
        ("s-t-u-p-1-d clown", "stupid clown"),
        ("y o u a r e s i c k", "you are sick"),
    ],
)
def test_spread_letters_are_several_words(text, words):
    model = abuse.PrefixModel(WORDS | {"i": 100, "want": 100})
    assert [w for p in abuse.passages(text, model) for w in p] == words.split()


def test_scores(spark):
    bad = ["You are a stupid idiot and a clown", "migrants are vermin and filth", "send me nudes, I am so horny", "u r a st*pid 1d1ot, you clown"]
    good = ["The battery is stupid and dies after an hour", "The clinic handed out a leaflet on sexual health", "Refugees slept 10 minutes less", "", None, "x" * 30000]
    rows = [(i, t, "forum", 0.0) for i, t in enumerate(bad + good)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(0, 1, 1), (0, 2, None), (4, 1, 0), (99, 1, 1)], "doc_id long, rater_id long, objectionable int")
    for given in (labels, labels.limit(0)):
        out = {r["doc_id"]: r["score"] for r in abuse.score_documents(docs, given).collect()}
        assert len(out) == len(rows)
        assert all(out[i] >= 1 for i in range(len(bad))), out
        assert all(out[i] < 1 for i in range(len(bad), len(rows))), out
    assert abuse.score_documents(docs.limit(0), labels).count() == 0


def test_labels_teach_what_no_class_holds(spark):
    bad = [f"I will skewer you {x}" for x in ("tonight", "slowly", "soon", "again", "twice", "now")]
    good = [f"The {x} was on time and the coffee was warm" for x in ("bus", "train", "tram", "boat", "plane", "taxi")] * 5
    rows = [(i, t, "forum") for i, t in enumerate([*bad, *good, "Listen well, I will skewer you", "The ferry was on time"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1, int(i < 6)) for i in range(36)], "doc_id long, rater_id long, objectionable int")
    out = {r["doc_id"]: r["score"] for r in abuse.score_documents(docs, labels).collect()}
    assert out[36] >= 1 > out[37]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/content_labels.parquet")
    even, odd = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    got = {r["doc_id"] for r in abuse.score_documents(docs, even).collect() if r["score"] >= 1}
    truth = {r["doc_id"]: r["v"] for r in odd.groupBy("doc_id").agg({"objectionable": "avg"}).withColumnRenamed("avg(objectionable)", "v").collect()}
    right = sum((i in got) == (v > 0.5) for i, v in truth.items() if v != 0.5)
    assert right / max(1, sum(v != 0.5 for v in truth.values())) >= 0.8


@pytest.mark.parametrize(("d", "recall"), [("/root/testdata/sf0.1", 0.75), ("/root/testdata/check_l", 0.95)])
def test_held_out_precision_and_recall(spark, d, recall):
    """Flags of rated documents whose raters agree (one alone may err), none of whose ratings were used; few ratings teach less."""
    if not os.path.isdir(d):
        pytest.skip(f"{d} is not here")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/content_labels.parquet")
    votes = labels.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.avg("objectionable").alias("v")).where("n > 1 AND v IN (0, 1)").persist()
    scores = abuse.score_documents(docs, labels.join(votes, "doc_id", "left_anti")).select("doc_id", "score")
    got = [(r["v"] == 1, r["score"] >= 1) for r in votes.join(scores, "doc_id").collect()]
    hits = sum(b and f for b, f in got)
    assert hits >= 0.95 * sum(f for _, f in got) and hits >= recall * sum(b for b, _ in got), (hits, sum(f for _, f in got), sum(b for b, _ in got))
