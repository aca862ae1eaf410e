"""Jaccard join, components and the pipeline's choice against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from partsmith.llm import jaccard_join as J
from partsmith.llm.components import components
from partsmith.llm.wordhash import WordHasher


def brute(rows):
    def grams(t):
        ws = (t or "").encode().lower().split()
        if not ws:
            return frozenset()
        return (frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5
                else frozenset([tuple(ws)]))

    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in lists[g]:
                common[j] += 1
            lists[g].append(i)
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d)
                   for i, (d, _) in enumerate(rows)), key=repr)


def _rows(seed):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(50)]
    rows = []
    for _ in range(70):
        base = [rng.choice(voc) for _ in range(rng.choice([0, 1, 3, 5, 6, 8, 10, 13, 20, 40, 90]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            v = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                if v:
                    op = rng.random()
                    if op < .4:
                        v[rng.randrange(len(v))] = rng.choice(voc)
                    elif op < .6:
                        v.pop(rng.choice([0, -1]))
                    else:
                        v.append(rng.choice(voc).upper())
            rows.append((len(rows) * 3 + 5, "\n ".join(v)))
    same = "a b c d e f g"
    return rows + [(None, same), (None, same), (9999, same), (9998, None), (9998, ""), (9997, " \n "),
                   (100007, "é" * 9000), (100008, "x y " * 5000)]


def _df(spark, rows):
    return spark.createDataFrame([(d, t, 1) for d, t in rows],
                                 "doc_id long, text string, sid int").repartition(3)


@pytest.mark.parametrize("boundary", [None, 1, 24])
def test_join_equals_brute_force(spark, monkeypatch, boundary):
    rows = _rows(3)
    if boundary:
        monkeypatch.setattr(J, "choose_boundary", lambda *a: boundary)
    out = J.jaccard_components(_df(spark, rows))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute(rows)


def test_hot_lists_in_parts_and_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "PART", 10)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        v = list(base)
        for _ in range(3):
            v[rng.randrange(120)] = f"x{rng.randrange(999)}"
        rows.append((k, " ".join(v)))
    out = J.jaccard_components(_df(spark, rows))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("part", [1, 2])
def test_classes_alone_in_their_part_are_linked(spark, monkeypatch, part):
    rows = _rows(3)
    monkeypatch.setattr(J, "PART", part)
    monkeypatch.setattr(J, "choose_boundary", lambda *a: 1)
    out = J.jaccard_components(_df(spark, rows))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("meet", [1, 3])
def test_last_pass_in_small_blocks(spark, monkeypatch, meet):
    """Everything that the stars don't link is left to the last pass, in blocks of few entries."""
    rows = _rows(4)
    monkeypatch.setattr(J, "MEET", meet)
    monkeypatch.setattr(J, "TRIES", 0)
    monkeypatch.setattr(J, "choose_boundary", lambda *a: 1)
    out = J.jaccard_components(_df(spark, rows))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute(rows)


def test_pairs_of_the_last_pass(spark, monkeypatch):
    """Exactly the pairs of different components within the bounds, each once, whatever the blocks."""
    rng = random.Random(7)
    entries = []
    for key in range(6):
        for sid in rng.sample(range(200), 40):
            n = rng.choice([5, 20, 23, 25, 31, 90, 100, 110])
            entries.append((key, sid, n, rng.randrange(J.prefix_length(n)), sid % 7))
    major = {k: max(range(7), key=lambda c: (sum(e[0] == k and e[4] == c for e in entries), c)) for k in range(6)}
    df = spark.createDataFrame([(*e, major[e[0]]) for e in entries],
                               "key long, sid long, n int, pos int, comp long, major long")

    def fits(a, b):
        (_, s, n, p, c), (_, t, m, q, d) = a, b
        return (s != t and c != d and 5 * min(n, m) >= 4 * max(n, m)
                and 4 * (n + m) <= 9 * (1 + min(n - p - 1, m - q - 1)))

    want = {(max(a[1], b[1]), min(a[1], b[1])) for a in entries for b in entries
            if a[0] == b[0] and fits(a, b)}
    assert len(want) > 50
    for meet in (2000, 3):
        monkeypatch.setattr(J, "MEET", meet)
        got = [(r.u, r.v) for r in J._meeting(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def _templated(n):
    common = " ".join(f"c{i}" for i in range(26))
    return [(k, common + "".join(f" own{k}x{i}" for i in range(5))) for k in range(n)]


def test_templated_pages_meet_nobody_in_the_last_pass(spark, monkeypatch):
    """Pages of one template and a few own words share a list that is as long as the table, but
    none can reach the overlap: no pair is made of it."""
    made = []
    real = J._meeting

    def meeting(unsettled):
        pairs = real(unsettled)
        made.append((unsettled.count(), pairs.count()))
        return pairs

    monkeypatch.setattr(J, "_meeting", meeting)
    monkeypatch.setattr(J, "choose_boundary", lambda *a: 1)
    rows = _templated(1500)
    got = {r.doc_id: r.component_id for r in J.jaccard_components(_df(spark, rows)).collect()}
    assert got == {k: k for k, _ in rows}
    assert made and all(pairs == 0 for _, pairs in made) and made[0][0] >= 1500


def test_very_long_texts_and_clashing_columns(spark):
    rng = random.Random(1)
    long = [f"w{rng.randrange(3000)}" for _ in range(60_000)]
    near = list(long)
    for _ in range(300):
        near[rng.randrange(len(near))] = "other"
    rows = [(4, " ".join(long)), (9, " ".join(near)), (2, "w1 w2 w3")]
    df = spark.createDataFrame([(d, t, 1, "a", "b", 2) for d, t in rows],
                               "doc_id long, text string, __n int, __sid string, __Key string, comp int")
    got = {r.doc_id: r.component_id for r in J.jaccard_components(df).collect()}
    assert got == {4: 4, 9: 4, 2: 2}
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]


def test_keep_one_of_each_group(spark):
    rows = _rows(5)
    kept = J.keep_one(_df(spark, rows))
    assert kept.columns == ["doc_id", "text", "sid"]
    want = {r[2] for r in brute(rows) if r[1] and r[2] is not None}
    got = [r.doc_id for r in kept.collect() if (r.text or "").split()]
    assert sorted(got) == sorted(want)
    assert sum(not (r.text or "").split() for r in kept.collect()) == sum(
        not (t or "").split() for _, t in rows)


def test_empty_table(spark):
    assert J.jaccard_components(_df(spark, [(1, "a")]).limit(0)).collect() == []


def test_bounds():
    for n in range(1, 60):
        for m in range(1, 60):
            least = next(c for c in range(n + m + 1) if 100 * c >= 80 * (n + m - c))
            assert J.overlap(n, m) == least
            assert (m in J.partners(n)) == (least <= min(n, m))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_word_hashes_follow_the_words():
    blank = np.zeros(256, bool)
    blank[[32, *range(9, 14)]] = True
    texts = ["Ab cd", "", "ab", " AB  ab\tcd ", None, "é ab", "x" * 10000 + " x"]
    h = WordHasher(blank)
    sets = list(J.Shingler().column(pa.array(texts)))
    assert [len(s) for s in sets] == [1, 0, 1, 1, 0, 1, 1]
    data = np.frombuffer(" ".join(t for t in texts if t).encode(), np.uint8)
    w, counts = h.words(data, np.array([len(data)]))
    names = " ".join(t for t in texts if t).lower().split()
    assert counts[0] == len(names) and len(set(w.tolist())) == len(set(names))
    assert len({(a, b) for a, b in zip(names, w.tolist(), strict=True)}) == len(set(names))
