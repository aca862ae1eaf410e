"""Cross-tokenizer alignment, collocations and the quality machine against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partsmith.llm import collocations as P
from partsmith.llm import cross_tokenizer as X
from partsmith.llm import quality_fm as Q
from partsmith.llm import quotient_filter as QF

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


# -- cross-tokenizer alignment --------------------------------------------------------
def brute_align(rows):
    """Per text and over all texts, with plain loops and the library's own encoder for A."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    tables = X.Tokenizers(A, B)
    groups, counts = [], Counter()
    for doc_id, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if (b"".join(tables.a_bytes[i] for i in a) != whole
                or b"".join(tables.b_bytes[i] for i in b) != whole):
            a, b = [], []
        ends_a = list(itertools.accumulate(len(tables.a_bytes[i]) for i in a))
        ends_b = list(itertools.accumulate(len(tables.b_bytes[i]) for i in b))
        own, low = [], 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            own.append(([i for i, e in zip(a, ends_a, strict=True) if low < e <= cut],
                        [i for i, e in zip(b, ends_b, strict=True) if low < e <= cut]))
            low = cut
        groups.append((doc_id, len(a), len(b), own))
        counts.update({(x, y) for g, h in own for x in g for y in h})
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, n_a, n_b, own in groups:
        links = [(x, y) for g, h in own for x in g for y in h]
        name = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in own)
        out.append((doc_id, n_a, n_b, len(own), len(links),
                    sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(name.encode()).hexdigest() if own else ""))
    return sorted(out, key=repr), counts


ODD = ["", None, "a", "日本語テスト🙂🙂👨‍👩‍👧 x", "▁▁ piece blank", "<|endoftext|> <s> hi </s> <0x41>",
       "\x00\x01 \t\n\n   x" * 20, "aba" * 300, " lead", "ﬁ é é", "  ", "\n", "e" * 5000, "नमस्ते ", "the the"]


def _texts(n):
    rng = random.Random(2)
    parts = ["the", "Kettle", "ing", "über", "日本", "42", "\n", "--", "naïve", "xyzzyq", "Ereanaha"]
    return [(k, "".join(rng.choice(parts) + rng.choice([" ", " ", "", ", "])
                        for _ in range(rng.randint(1, 60)))) for k in range(n)]


def test_alignment_equals_brute_force(spark):
    rows = _texts(60) + [(10**17 + i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "the the")]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows],
                               "doc_id long, text string, pairs int, block string").repartition(3)
    want, counts = brute_align(rows)
    got = sorted((tuple(r) for r in X.align(df, A, B, block_bytes=600).collect()), key=repr)
    assert got == want
    table = {(r.a_id, r.b_id): r.docs for r in X.link_counts(df, A, B).collect()}
    assert table == dict(counts)
    assert X.align(df.limit(0), A, B).collect() == []


def test_wide_groups_count_by_distinct_ids(spark, monkeypatch):
    monkeypatch.setattr(X, "WIDE", 1)
    rows = _texts(12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in X.align(df, A, B).collect()), key=repr)
    assert got == brute_align(rows)[0]


def _digests(tok, texts):
    encoder = X.Encoder(tok)
    return X.Block(encoder.texts(texts), encoder.types).digests()


def test_equal_hashes_of_groups_are_noticed(monkeypatch):
    tok = X.Tokenizers(A, B)
    texts = [t for _, t in _texts(5)]
    want = _digests(tok, texts)
    real, calls = X.Side.hashed, []

    def clash(self, seed):
        calls.append(seed)
        return real(self, seed) if seed > 4 else np.zeros(len(self.size), np.uint64)

    monkeypatch.setattr(X.Side, "hashed", clash)
    assert _digests(tok, texts) == want and max(calls) > 4


def test_chunks_give_what_whole_texts_give(monkeypatch):
    """Remembered, forgotten, long and odd chunks, against texts encoded whole."""
    rng = random.Random(6)
    texts = ODD + [t for _, t in _texts(40)] + ["".join(rng.choice(
        ["a", "Zed", "'s", "é", " ", " ", "\n", "\t", "\u00a0", "\x1c", "\u2581", "12", "…", "🙂", "\u3000"])
        for _ in range(rng.randint(1, 40))) for _ in range(400)] + ["x" * 300 + " y", "a " * 2000]
    tok = X.Tokenizers(A, B)
    assert tok.parts
    got = _digests(tok, texts)
    monkeypatch.setattr(X, "MEMO_CHUNKS", 10)
    monkeypatch.setattr(X, "MEMO_CHARS", 3)
    encoder = X.Encoder(tok)
    assert X.Block([k for t in texts for k in encoder.texts([t])], encoder.types).digests() == got
    tok.parts = False
    assert _digests(tok, texts) == got


def test_identity_map_names_equal_bytes():
    tok = X.Tokenizers(A, B)
    hit = np.flatnonzero(tok.identity >= 0)
    assert len(hit) > 5000
    assert all(tok.a_bytes[i] == tok.b_bytes[tok.identity[i]] for i in hit)


# -- quotient filters and collocations ------------------------------------------------
@pytest.mark.parametrize("half", [1, 3, 17, 32])
def test_permutation_is_invertible(half):
    rng = np.random.default_rng(half)
    top = (1 << half) - 1
    a = np.r_[0, top, rng.integers(0, top + 1, 500)]
    b = np.r_[top, 0, rng.integers(0, top + 1, 500)]
    keys = QF.permute(a, b, half)
    assert int(keys.max()) < 1 << (2 * half)
    assert [x.tolist() for x in QF.invert(keys, half)] == [a.tolist(), b.tolist()]


@pytest.mark.parametrize(("bits", "n"), [(2, 3), (9, 40), (34, 3000), (64, 100), (12, 0), (1, 1)])
def test_filters_keep_all_and_merge(bits, n):
    rng = np.random.default_rng(n)
    total, parts = Counter(), []
    for _ in range(4):
        keys = np.unique(rng.integers(0, 1 << min(bits, 62), n).astype(np.uint64))
        counts = rng.integers(1, 1000, len(keys))
        f = QF.QuotientFilter.unpack(QF.QuotientFilter.build(keys, counts, bits).pack())
        assert f.keys().tolist() == keys.tolist() and f.counts().tolist() == counts.tolist()
        total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        parts.append(f)
    keys, counts, entries, place = QF.merge(parts)
    assert list(zip(keys.tolist(), counts.tolist(), strict=True)) == sorted(total.items())
    assert keys[place].tolist() == entries.tolist()


def test_too_many_ids_for_a_pair_are_an_error():
    assert QF.half_bits(1) == 1 and QF.half_bits(1 << 32) == 32
    with pytest.raises(ValueError, match="packed pair"):
        QF.half_bits((1 << 32) + 1)


def brute_collocations(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {q: a for q, a in cand.items() if not any(
            len(p) > len(q) and b >= a and any(p[i:i + len(q)] == q for i in range(len(p)))
            for p, b in cand.items())}
        scored = []
        for p, a in inside.items():
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k)
                    for k in range(1, len(p))]
            s, k = min(cuts)
            scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def _talk(n, seed=1):
    rng = random.Random(seed)
    voc = ["a", "B", "é", "in", "of", "the", "x1", "日本", "o'k", "\x00"]
    fixed = ["the In of a", "x1 日本 é", "a a a", "of the"]
    return [(k, "".join(rng.choice([rng.choice(fixed), rng.choice(voc)])
                        + rng.choice([" ", " ", " ", "\t ", ", ", ". ", "\r\n"])
                        for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "de", None]))
            for k in range(n)]


@pytest.mark.parametrize(("block", "pairs", "least"), [(300, 100, 5), (1 << 23, 10**6, 5), (900, 50, 40)])
def test_collocations_equal_brute_force(spark, block, pairs, least):
    rows = _talk(120) + [(500, None, "en"), (501, "", "fr"), (502, "  .. ", "fr"), (None, "a b", None),
                         (503, "the in " * 400, "und")]
    rows += [rows[3]] * 4
    df = spark.createDataFrame([(*r, 1, "y") for r in rows],
                               "doc_id long, text string, lang string, n int, word string").repartition(3)
    got = P.collocations(df, least, top=30, block_bytes=block, shard_pairs=pairs).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows, least, 30)


def test_collocations_of_nothing(spark):
    df = spark.createDataFrame([(1, "a b c", "en")], "doc_id long, text string, lang string")
    assert P.collocations(df).collect() == []
    assert P.collocations(df.limit(0)).collect() == []


def test_large_numbers_stay_exact(spark):
    """Products beyond 64 bits: the cut's expression on given counts."""
    big = 5 * 10**12
    level = spark.createDataFrame([(0, "en", "a b", "b", big - 1, [big + 7, big - 1], [big + 3, big - 1], 0)],
                                  "id long, lang string, phrase string, last string, f long,"
                                  " heads array<long>, tails array<long>, longer long")
    n = 9 * 10**12 + 5
    got = P.ranked([level.where("false"), level],
                   spark.createDataFrame([("en", n)], "lang string, n long"), 5).first()
    assert got.score == 1000 * (big - 1) * n // ((big + 7) * (big + 3))


# -- quality ---------------------------------------------------------------------------
def _quality_rows(n, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < .7
        w = [rng.choice(["river", "table", "opens", "slowly", "under", "their"]) for _ in range(rng.randint(5, 60))]
        text = " ".join(w).capitalize() + "." if good else " ".join(x.upper() + "!!" for x in w)
        docs.append((k, text, len(text), "x"))
        labels.append((k, int(good), 0))
    return docs, labels


def test_margin_equals_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = Q.Model(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    sets = [(rng.choice(30, k, replace=False), rng.normal(size=k)) for k in (0, 1, 5, 12)]
    row = np.repeat(np.arange(4), [len(a) for a, _ in sets])
    got = m.margins(4, row, np.concatenate([a for a, _ in sets]).astype(int),
                    np.concatenate([x for _, x in sets]))
    for out, (at, x) in zip(got, sets, strict=True):
        want = m.bias + sum(m.w[i] * v for i, v in zip(at, x, strict=True)) + sum(
            (m.v[at[i]] @ m.v[at[j]]) * x[i] * x[j]
            for i in range(len(at)) for j in range(i + 1, len(at)))
        assert math.isclose(out, want, abs_tol=1e-9)


def test_pass_equals_plain_gradient_steps():
    rng = np.random.default_rng(5)
    dim, rank = 8, 3
    start = Q.Model(0.1, rng.normal(size=dim), rng.normal(size=(dim, rank)))
    sets = [(np.sort(rng.choice(dim, 4, replace=False)), rng.normal(size=4)) for _ in range(5)]
    y = np.array([1.0, 0, 1, 1, 0])
    got = Q.one_pass(start, sets, y, seed=2)
    b, w, v = start.bias, list(start.w), [list(r) for r in start.v]
    hb, hw, hv = 1.0, [1.0] * dim, [[1.0] * rank for _ in range(dim)]

    def margin():
        return b + sum(w[i] * x for i, x in own) + sum(
            sum(v[i][f] * v[j][f] for f in range(rank)) * x * z
            for p, (i, x) in enumerate(own) for j, z in own[p + 1:])

    for k in np.random.default_rng(2).permutation(5):
        own = [(int(i), float(x)) for i, x in zip(*sets[k], strict=True)]
        g = 1 / (1 + math.exp(-margin())) - y[k]
        gw = {i: g * x + Q.DECAY * w[i] for i, x in own}
        gv = {(i, f): g * x * sum(v[j][f] * z for j, z in own if j != i) + Q.DECAY * v[i][f]
              for i, x in own for f in range(rank)}
        hb += g * g
        b -= Q.RATE * g / math.sqrt(hb)
        for i, d in gw.items():
            hw[i] += d * d
            w[i] -= Q.RATE * d / math.sqrt(hw[i])
        for (i, f), d in gv.items():
            hv[i][f] += d * d
            v[i][f] -= Q.RATE * d / math.sqrt(hv[i][f])
    assert math.isclose(got.bias, b) and np.allclose(got.w, w) and np.allclose(got.v, v)


def test_features_against_plain_counts():
    texts = ["", None, "Ab ab, c!!\nab ab, c!!", "é" * 9, "$$$ 12"]
    seen = {}
    for first, n, row, place, x in Q.features(pa.array(texts), pa.array([0, None, 21, 3, 6.0])):
        for k in range(n):
            seen[first + k] = (place[row == k], x[row == k])
    assert sorted(seen) == [0, 1, 2, 3, 4]
    words = {k: sorted(x[p < Q.WORDS].tolist()) for k, (p, x) in seen.items()}
    assert words[0] == words[1] == []
    a, c = 1 + math.log(4), 1 + math.log(2)
    assert np.allclose(words[2], [v / math.hypot(a, c) for v in (c, a)])
    stat = {k: {s: sum((q - Q.WORDS) % Q.BINS * v / 0.5 for q, v in zip(p, x, strict=True)
                       if q >= Q.WORDS and (q - Q.WORDS) // Q.BINS == i) / (Q.BINS - 1)
                for i, s in enumerate(Q.STATS)} for k, (p, x) in seen.items()}
    t = texts[2]
    assert math.isclose(stat[2]["different_lines"], 0.5)
    assert math.isclose(stat[2]["upper"], math.sqrt(1 / 10), rel_tol=1e-6)  # A of ten letters
    assert math.isclose(stat[2]["twice"], math.sqrt(2 / len(t)), rel_tol=1e-6)
    assert math.isclose(stat[2]["n_chars_differs"], 0.0, abs_tol=1e-9)
    assert math.isclose(stat[3]["n_chars_differs"], 1.0) and math.isclose(stat[1]["n_chars_missing"], 1.0)
    assert math.isclose(stat[3]["beyond"], 1.0)


def test_quality_on_held_out_rows(spark):
    docs, labels = _quality_rows(600)
    docs += [(700, None, None, "x"), (701, "", 0, "x"), (None, "no id", 5, "x"), (0, docs[0][1], docs[0][2], "x")]
    labels += [(0, 0, 0), (None, 1, 1), (701, None, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_chars long, at string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = Q.quality(df, marks).collect()
    assert len(out) == len(docs)
    good = {k: q for k, q, _ in labels[1:600]}
    held = [r for r in out if r.held_out and r.doc_id in good]
    assert len(held) > 100
    assert sum(r.predicted == good[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= .5) for r in out)
    same = {r.score for r in out if r.doc_id == 0}
    assert len(same) == 1


def test_quality_without_labels_or_metadata(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.quality(df, marks).collect()] == [0.5, 0.5]
    assert Q.quality(df.limit(0), marks).collect() == []
    odd = df.withColumn("n_chars", F.lit("many"))
    assert Q.quality(odd, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).count() == 2
