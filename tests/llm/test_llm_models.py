"""Toxicity and language identification: held-out accuracy, defined cases, repeatability."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partsmith.llm import language_id as L
from partsmith.llm import toxicity as T
from partsmith.llm.sampling import fit_shards, text_sample
from partsmith.llm.wordhash import WordHasher

BAD = ["grumblefoot", "snotrag", "dungheap"]


def _corpus(n=400):
    rng = random.Random(1)
    voc = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        ws = [rng.choice(voc) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for b in rng.sample(BAD, 2):
                ws.insert(rng.randrange(len(ws)), b.upper() if i % 8 else b + "!")
        rows.append((i, " ".join(ws), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tox(spark):
    rows = _corpus()
    extra = [(None, "dungheap snotrag w1", None), (9001, None, None), (9002, "", None),
             (9003, "w1 " * 40000 + "snotrag grumblefoot", None), (4, rows[4][1], None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows + extra],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(0, 0), (None, 1), (3, None), (77777, 1)],
        "doc_id long, toxic int")
    return rows, docs, labels


def test_toxicity_on_held_out_rows(spark, tox):
    rows, docs, labels = tox
    out = T.toxicity(docs, labels).collect()
    assert len(out) == len(rows) + 5
    truth = {i: y for i, _, y in rows}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} >= {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]
    assert np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    by = {r.doc_id: r for r in out}
    assert by[9003].predicted == 1 and by[None].predicted == 1
    assert by[9001].score == by[9002].score and by[9001].predicted == 0
    assert len({r.score for r in out if r.doc_id == 4}) == 1
    again = {r.doc_id: r.score for r in T.toxicity(docs.repartition(5), labels).collect()}
    assert again == {r.doc_id: r.score for r in out}


def test_toxicity_never_reads_held_out_labels(spark, tox):
    _, docs, labels = tox
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = (sorted((r.doc_id or -1, r.score) for r in T.toxicity(docs, x).collect())
            for x in (labels, flipped))
    assert a == b


def test_toxicity_empty_tables(spark, tox):
    _, docs, labels = tox
    assert T.toxicity(docs.limit(0), labels).collect() == []
    none = T.toxicity(docs.limit(3), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.0] * 3


def test_ftrl_equals_the_update_by_hand():
    sets, y = [np.array([0, 2]), np.array([1]), np.array([0, 1])], np.array([1.0, 0.0, 1.0])
    w = T.ftrl(sets, y, dim=3, epochs=2, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    z, n, order = np.zeros(4), np.zeros(4), np.random.default_rng(7)

    def weight(i):
        if i == 3:
            return -z[i] * 0.5 / (1.0 + n[i] ** 0.5)
        if abs(z[i]) <= 0.1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * 0.1) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.2)

    for _ in range(2):
        for k in order.permutation(3):
            idx = [*sets[k], 3]
            p = 1 / (1 + np.exp(-sum(weight(i) for i in idx)))
            for i, wi in [(i, weight(i)) for i in idx]:
                g = p - y[k]
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5
                z[i] += g - sigma * wi
                n[i] += g * g
    assert np.allclose(w, [weight(i) for i in range(4)])


def test_features_are_words_pairs_and_skips():
    def count(text):
        return len(T.feature_sets(pa.array([text]))[0])

    assert [count(t) for t in ("", "a", "a b", "a b c", "a, B-c! d")] == [0, 1, 3, 6, 9]
    pair = T.feature_sets(pa.array(["a b c", None, "A  b.c"]))
    assert (pair[0] == pair[2]).all() and len(pair[1]) == 0
    rows = list(T.features(pa.array(["a b", "c d"]), WordHasher(T._BLANK)))
    assert sum(len(p) for *_, p in rows) == 6  # nothing reaches over a text's end


LANGS = {"xx": "abrelo", "yy": "kszpyw", "zz": "ñtéuiè"}


@pytest.fixture(scope="module")
def lang(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        name = list(LANGS)[i % 3]
        text = " ".join("".join(rng.choice(LANGS[name]) for _ in range(rng.randint(2, 8)))
                        for _ in range(rng.randint(3, 40)))
        rows.append((i, text.capitalize() + " 12, ok!"[:rng.randint(0, 4)], name))
    extra = [(900, None, "xx"), (901, "", "yy"), (902, "123 ... !", None), (None, rows[0][1], "xx"),
             (903, LANGS["yy"] * 30000, None), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 0.5, True) for r in rows + extra],
                               "doc_id long, text string, lang string, score double, held_out boolean")
    return rows, df


def test_language_on_held_out_rows(spark, lang):
    rows, df = lang
    out = L.identify(df).collect()
    assert len(out) == len(rows) + 6
    truth = {i: v for i, _, v in rows}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (900, 901, 902, 903, None)] == ["und"] * 3 + ["yy", "xx"]
    assert all(0 <= r.score <= 1 for r in out)
    again = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(df.repartition(4)).collect()}
    assert again == {r.doc_id: (r.lang_pred, r.score) for r in out}


def test_language_few_or_no_labels(spark, lang):
    _, df = lang
    one = L.identify(df.where("lang = 'xx' or lang is null")).collect()
    assert {r.lang_pred for r in one} == {"xx", "und"}
    none = L.identify(df.selectExpr("doc_id", "text", "cast(null as string) AS lang")).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert L.identify(df.limit(0)).collect() == []


@pytest.mark.parametrize("k", [2, 3, 4, 9, 70])
def test_codewords_differ(k):
    c = L.codewords(k).astype(int)
    gap = (c.shape[1] - c @ c.T) // 2
    assert gap[~np.eye(k, dtype=bool)].min() >= (2 if k > 2 else 1)
    assert (np.abs(c.sum(0)) < k).all()


def test_features_of_slices_add_up(monkeypatch):
    text = "Abc déf ghi " * 50
    whole = L.features(text)
    monkeypatch.setattr(L, "SLICE", 64)
    parts = L.features(text)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_ambiguous_texts_are_flagged():
    codes = np.array([[1, 1, -1], [-1, 1, 1]])
    m = L.Model(["a", "b"], codes, np.ones((2, 3)) / 3, np.zeros((L.DIM + 1, 3)))
    assert m.decode("some text")[2] and m.decode("some text")[1] == pytest.approx(0.5)


def test_copies_count_once_in_samples_and_shards(spark):
    rows = [(f"text {i}", "ab"[i % 2]) for i in range(80)] * 50 + [("the same", "a")] * 2000
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumn(
        "text_hash", F.xxhash64("text"))
    for got, low, high in ((text_sample(df, 40).collect(), 25, 55),
                           (text_sample(df, 20, "lang").collect(), 25, 55),
                           (text_sample(df, 100).collect(), 81, 81),
                           (text_sample(df, 100, "lang").collect(), 81, 81)):
        assert len(set(got)) == len(got) and low <= len(got) <= high
    sizes = fit_shards(text_sample(df, 100), 4, lambda f: str(len(f)).encode())
    assert sum(map(int, sizes)) == 81 and max(map(int, sizes)) < 40


def test_toxicity_equals_a_plain_version(spark, tox):
    """The whole way from texts to scores with dicts and loops: features, FTRL, averaged shards."""
    import re

    rows, docs, labels = tox
    truth = {i: y for i, _, y in rows}
    train = sorted({(t, truth[i]) for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5})

    def sets(text):
        w = re.findall(r"[0-9a-z]+", (text or "").lower())
        return ({(x,) for x in w} | {(1, *p) for p in zip(w, w[1:], strict=False)}
                | {(2, *p) for p in zip(w, w[2:], strict=False)})

    z, n = {}, {}

    def weight(f):
        if f == "bias":
            return -z.get(f, 0) * T.ALPHA / (T.BETA + n.get(f, 0) ** 0.5)
        x = z.get(f, 0)
        return 0.0 if abs(x) <= T.L1 else (
            -(x - np.sign(x) * T.L1) / ((T.BETA + n.get(f, 0) ** 0.5) / T.ALPHA + T.L2))

    made, order = [(sets(t) | {"bias"}, y) for t, y in train], np.random.default_rng(7)
    for _ in range(T.EPOCHS):
        for k in order.permutation(len(made)):
            own, y = made[k]
            w = {f: weight(f) for f in own}
            g = 1 / (1 + np.exp(-np.clip(sum(w.values()), -30, 30))) - y
            for f in own:
                z[f] = z.get(f, 0) + g - ((n.get(f, 0) + g * g) ** 0.5 - n.get(f, 0) ** 0.5) / T.ALPHA * w[f]
                n[f] = n.get(f, 0) + g * g
    want = {i: 1 / (1 + np.exp(-np.clip(sum(weight(f) for f in sets(t) | {"bias"}), -30, 30)))
            for i, t, _ in rows}
    got = {r.doc_id: r.score for r in T.toxicity(docs, labels).collect()}
    # (hashes may clash and labels of id 0 differ, so a few scores may be off a little)
    off = [abs(got[i] - p) for i, p in want.items()]
    assert np.mean([x < 1e-3 for x in off]) > 0.9 and max(off) < 0.2


def test_decoding_equals_loops():
    rng = np.random.default_rng(4)
    langs, bits = ["a", "b", "c"], 5
    codes = rng.choice([-1, 1], (3, bits))
    trust = rng.random((3, bits))
    w = rng.normal(size=(L.DIM + 1, bits)).astype(np.float32) * 0.05
    model = L.Model(langs, codes, trust, w)
    for text in ("some words here", "éèê", "a", "Mixed 12 Case!"):
        at, x = L.features(text)
        margins = [sum(float(x[k]) * float(w[i, b]) for k, i in enumerate(at)) + 0.1 * float(w[L.DIM, b])
                   for b in range(bits)]
        losses = [sum(trust[k, b] * np.log1p(np.exp(-codes[k, b] * margins[b])) for b in range(bits))
                  for k in range(3)]
        p = np.exp([-(v - min(losses)) * bits for v in losses])
        p /= p.sum()
        lang, score, unsure = model.decode(text)
        best = int(np.argmin(losses))
        assert lang == langs[best] and score == pytest.approx(p[best], abs=1e-4)
        assert unsure == (p[best] - sorted(p)[-2] < L.MARGIN)


def test_ngram_features_equal_loops():
    text = "Ab é, ab!! 12 xyz"
    runs = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    counts = {}
    m = [int(v) for v in L._MULT]
    for size in (1, 2, 3):
        for i in range(len(runs) - size + 1):
            c = [ord(x) for x in runs[i:i + size]]
            g = (c[0] * m[0] if size == 1 else
                 c[0] * m[1] + c[1] * m[0] + 1 if size == 2 else
                 c[0] * m[2] + c[1] * m[1] + c[2] * m[0] + 2) % (1 << 32)
            g = ((g ^ (g >> 15)) * m[2]) % (1 << 32)
            counts[g >> (32 - L.BITS)] = counts.get(g >> (32 - L.BITS), 0) + 1
    at, x = L.features(text)
    length = sum(counts.values()) ** 0.5
    assert dict(zip(at.tolist(), x.tolist(), strict=True)) == pytest.approx(
        {k: v ** 0.5 / length for k, v in counts.items()})


def test_sums_of_shards(spark):
    from partsmith.llm.sampling import sum_shards

    df = spark.createDataFrame([(f"t{i}", i) for i in range(40)], "text string, v long")
    got = sum_shards(df, 5, lambda f: {"n": np.array([len(f)]), "v": np.full(200_000, f["v"].sum())})
    assert got["n"].tolist() == [40] and got["shards"][0] == 5
    assert len(got["v"]) == 200_000 and set(got["v"].tolist()) == {sum(range(40))}
    assert sum_shards(df.limit(0), 5, lambda f: {"n": np.ones(1)}) == {}
