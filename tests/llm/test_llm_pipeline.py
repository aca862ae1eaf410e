"""The corpus pipeline over planted cases, against brute force stage by stage."""

import hashlib
import random
import zlib

import pytest

import corpus_pipeline as P
from partsmith.llm import bpe
from partsmith.llm.queries import ORACLE_SQL, QUERIES, vocabulary
from tests.llm.test_llm_jaccard import brute
from tests.llm.test_llm_native import brute_hits

BAD = ["grumblefoot", "snotrag", "dungheap"]
LANGS = {"xx": "abrelo", "yy": "kszpyw"}


def _words(rng, lang, n):
    return ["".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    items = [(k, " ".join(_words(rng, "xx", 30))) for k in range(3)]
    docs, toxic = [], {}
    for i in range(260):
        lang = "xx" if i % 3 else "yy"
        ws = _words(rng, lang, rng.randint(20, 60))
        toxic[i] = int(i % 5 == 0)
        if toxic[i]:
            for b in BAD:
                ws.insert(rng.randrange(len(ws)), b)
        docs.append((i, " ".join(ws), lang, "s", 1))
    clean = [d for d in docs if not toxic[d[0]]]
    docs += [(1000 + k, d[1], d[2], "s", 1) for k, d in enumerate(clean[:20])]          # copies
    docs += [(1100 + k, d[1] + " end", d[2], "s", 1) for k, d in enumerate(clean[20:40])]  # near
    docs += [(1200 + k, items[k][1][20:] + " " + clean[50 + k][1], "xx", "s", 1) for k in range(3)]
    docs += [(1300, None, None, None, None), (1301, "", "xx", "s", 1), (1302, "12 !", "xx", "s", 1),
             (None, clean[60][1] + " nameless text here", "xx", "s", 1)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in toxic.items()], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, docs, toxic, items


def test_stages_one_by_one(spark, corpus):
    d, docs, toxic, items = corpus
    cur = spark.read.parquet(f"{d}/documents.parquet")
    rows = {}
    for name, stage in P.STAGES:
        before = cur
        cur = P.written(stage(spark, cur, d), f"test-{name}")
        rows[name] = sorted((tuple(r) for r in cur.collect()), key=repr)
        if name != "tokens":
            assert cur.columns == before.columns and cur.schema == before.schema
    # language: only the rows without a letter go
    assert rows["language"] == sorted((r for r in docs if r[0] not in (1300, 1301, 1302)), key=repr)
    # toxicity: all toxic ones go, all clean ones stay
    assert rows["toxicity"] == [r for r in rows["language"] if not toxic.get(r[0], 0)]
    # near duplicates: one of each group, the smallest id
    pairs = [(r[0], r[1]) for r in rows["toxicity"]]
    keep = {c for _, _, c in brute(pairs)}
    assert sorted((r[0] for r in rows["near_duplicates"]), key=repr) == sorted(keep, key=repr)
    # decontamination: what holds a window goes
    hit = {(i, n) for i, n, h, _ in brute_hits([(r[0], r[1]) for r in rows["near_duplicates"]], items) if h}
    assert {i for i, _ in hit} == {1200, 1201, 1202}
    assert rows["decontamination"] == [r for r in rows["near_duplicates"] if r[0] not in (1200, 1201, 1202)]
    # tokens
    b = bpe.Bpe(vocabulary())
    want = sorted(((r[0], len(b.encode(r[1])), hashlib.sha256(
        " ".join(map(str, b.encode(r[1]))).encode()).hexdigest()) for r in rows["decontamination"]), key=repr)
    assert [r[:3] for r in rows["tokens"]] == want
    run = sorted((tuple(r) for r in QUERIES["pipeline"](spark, d).collect()), key=repr)
    assert run == rows["tokens"] and P.ORACLE_SQL is None and "pipeline" not in ORACLE_SQL


def test_empty_documents(spark, corpus):
    d = corpus[0]
    cur = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        cur = stage(spark, cur, d)
        assert cur.collect() == []


def test_held_out_rows_exist(corpus):
    assert any(zlib.crc32(str(i).encode()) % 5 == 0 for i in corpus[2])
