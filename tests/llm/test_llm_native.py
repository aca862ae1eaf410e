"""Decontamination and license scan against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from partsmith.llm import license_scan as L
from partsmith.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute_hits(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, body in items:
            b = words(body)
            n = min(len(b), 10)
            for s in range(len(b) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == b[s:s + n]:
                        hit.update(range(p, p + n))
                        ids.add("" if item is None else str(item))
        out.append((doc_id, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def _documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1.5) for i, t in rows],
                                 "doc_id long, text string, w string, items double")


def _case(seed):
    rng = random.Random(seed)
    voc = ["a", "b", "C", "dé", "e1", "Fg", "ÉH", "i"]
    items = [(k, " ".join(rng.choice(voc) for _ in range(rng.choice([1, 2, 3, 5, 10, 12, 25]))))
             for k in range(6)]
    items += [(0, items[0][1]), (99, None), (98, " .. "), (None, "b a b a b a b a b a b a")]
    docs = []
    for k in range(40):
        parts = [" ".join(rng.choice(voc) for _ in range(rng.randint(0, 30)))]
        if k % 3 == 0:
            parts.append(rng.choice(items[:6])[1].upper().replace(" ", ", "))
        docs.append((k, " ".join(parts)))
    docs += [(7, docs[7][1]), (7, "other text"), (None, docs[0][1]), (50, None), (51, ""),
             (52, "é" * 5000), (53, "a " * 3000)]
    return docs, items


@pytest.mark.parametrize("seed,broadcast", [(1, True), (2, True), (1, False)])
def test_decontamination_equals_brute_force(spark, seed, broadcast):
    docs, items = _case(seed)
    bench = spark.createDataFrame([(i, t, "x") for i, t in items],
                                  "item_id long, text string, doc_id string")
    out = decontaminate(_documents(spark, docs), bench, broadcast=broadcast)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in out.collect()), key=repr)
    assert got == brute_hits(docs, items)


def test_decontamination_empty_tables(spark):
    docs = _documents(spark, [(1, "some words here")])
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in decontaminate(docs, none).collect()] == [(3, 0)]
    assert decontaminate(docs.limit(0), none).collect() == []


def brute_license(docs):
    out = []
    for doc_id, text in docs:
        w = words(text)
        base, labels, best = [], set(), 0.0
        for phrase, label in L.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            base += [(i, label) for i in at]
        for label, (t, required) in L.TEMPLATES.items():
            t = set(t.split())
            for s in range(len(w)):  # every window, not only those that begin at a template word
                block = w[s:s + L.BLOCK]
                share = len(t & set(block)) / len(t)
                run = " " + " ".join(block) + " "
                if share >= L.THRESHOLD - 1e-9 and all(f" {p} " in run for p in required):
                    labels.add(label)
                    best = max(best, share)
        names = {x for _, x in base}
        starts = [i for i, _ in base]
        out.append((doc_id, len(w), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted(names)), ",".join(sorted(names | labels)),
                    1.0 if base else best))
    return sorted(out, key=repr)


def test_license_scan_equals_brute_force(spark):
    rng = random.Random(4)
    fill = ["the", "of", "license", "mit", "general", "public", "under", "version", "2", "x", "0"]
    docs = [(1, "Released under the MIT License."), (2, None), (3, ""), (None, "mit LICENSE, mit license"),
            (4, "Licensed under the Apache-License, Version 2.0"), (5, "general\npublic -- license"),
            (5, "Licensed under CC BY-NC 4.0."), (6, "License " * 4000)]
    docs += [(10 + k, " ".join(rng.choice(fill) for _ in range(rng.randint(1, 400))))
             for k in range(30)]
    t = [text for text, _ in L.TEMPLATES.values()]
    docs += [(60 + k, " ".join(["pad"] * (k * 13) + t[k % len(t)].split()[:-1] + ["end"]))
             for k in range(16)]
    docs += [(60, docs[-16][1])]
    out = L.license_scan(_documents(spark, docs))
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = brute_license(docs)
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert all(abs(g[7] - w[7]) < 1e-9 for g, w in zip(got, want, strict=True))
    assert L.license_scan(_documents(spark, docs).limit(0)).collect() == []


def _labels(spark, texts):
    rows = L.license_scan(_documents(spark, list(enumerate(texts)))).collect()
    return {texts[r.doc_id]: r.labels for r in rows}


def test_licences_get_exactly_their_own_label(spark):
    base = {"apache-2.0": "apache", "gpl-3.0": "gpl", "mit-notice": "mit"}
    own = {text: ",".join(sorted({label, base.get(label, label)}))
           for label, (text, _) in L.TEMPLATES.items()}
    near = {
        "licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
        "licensed under CC BY-SA 4.0": "cc-by-sa-4.0",
        "licensed under CC BY 4.0": "",
        "licensed under CC BY-NC-SA 4.0": "",
        "licensed under the GNU General Public License version 2": "gpl",
        "licensed under the GNU Lesser General Public License version 3": "gpl",
        "licensed under the Apache License version 1.0": "apache",
        "licensed under the Apache License, version 1.1; see item 2 0": "apache",
        "released under the Apache License": "apache",
        "released under the MIT License": "mit,mit-notice",
        "this source code is subject to the terms of the Mozilla Public License, v. 1.1": "",
        "permission is hereby granted to use copy and distribute this software and associated"
        " documentation files for any purpose": "",
    }
    got = _labels(spark, [*own, *near])
    assert got == own | near


def test_a_notice_is_found_at_any_offset(spark):
    """Words between a notice's own (comment marks, line numbers) and any place in the text."""
    text, _ = L.TEMPLATES["bsd"]
    texts = [" ".join(["pad"] * k) + " " + text + " tail" * (k % 5) for k in range(0, 70, 7)]
    wide = ["pad " * k + "redistribution and use in source and binary " + "x " * 20
            + "with or without modification are permitted provided that the following conditions"
            for k in range(30, 66, 5)]
    got = _labels(spark, [t.strip() for t in texts] + wide)
    assert set(got.values()) == {"bsd"}
    far = "redistribution and use in source and binary forms " + "x " * 60 + "with or without" \
        " modification are permitted provided that the following conditions are met"
    assert _labels(spark, [far]) == {far: ""}


def test_very_long_texts_are_scanned_in_linear_time(spark):
    import time

    long = "the license is under source and 2 0 " * 60_000 + "licensed under cc by sa 4 0"
    begin = time.perf_counter()
    assert _labels(spark, [long]) == {long: "cc-by-sa-4.0"}
    assert time.perf_counter() - begin < 120


def test_digests_of_the_query(spark):
    docs = _documents(spark, [(1, "one two three four")])
    bench = spark.createDataFrame([(5, "two three"), (10, "three")], "item_id long, text string")
    r = decontaminate(docs, bench).select(
        F.sha2(F.array_join("items", ","), 256).alias("h")).first()
    assert r.h == hashlib.sha256(b"10,5").hexdigest()
