"""BPE against the tokenizers library, page extraction, top-k search, revisits, chat repair."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from partsmith.llm import bpe, chat_repair as C, html_extract as H, topk_search as K
from partsmith.llm import warc_revisit as W

P = pytest.importorskip("public_tokenizers")


# -- BPE ---------------------------------------------------------------------------
def _texts():
    rng = random.Random(1)
    al = "aaabbcdeé ΣΑσς İıßǅ'sté́ \t\n\x1c\x85  中文字😀👩‍👩<|startoftext|>12½²Ⅷ  ﬁ'll\x00​"
    out = ["".join(rng.choice(al) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return out + ["", "<|endoftext|>", "x<|startoftext|>y<|endoftext|> z", "aaaaaaa", "ab" * 4000,
                  "ΟΔΟΣ ΟΔΟΣΑ", "The quick brown fox isn't here, they'll say 1999!"]


def test_bpe_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("word_bpe_49k.json")
    lib, own, texts = tokenizers.Tokenizer.from_file(path), bpe.Bpe(path), _texts()
    want = lib.encode_batch(texts, add_special_tokens=False)
    for text, got, w in zip(texts, own.encode_batch(texts), want, strict=True):
        assert got[1] == " ".join(map(str, w.ids)), text
        assert got[0] == len(w.ids)
        assert got[2] == lib.decode(w.ids, skip_special_tokens=False) == own.decode(w.ids)


def test_bpe_memo_is_bounded_and_harmless(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_CHUNKS", 5)
    monkeypatch.setattr(bpe, "MEMO_CHARS", 3)
    path = P.path("word_bpe_49k.json")
    small, texts = bpe.Bpe(path), _texts()[:60]
    parts = [small.encode_batch([t])[0] for t in texts]
    assert parts == bpe.Bpe(path).encode_batch(texts)


def test_encode_documents(spark):
    rows = [(1, "Hello there", 9), (1, "Hello there", 9), (None, "x", 9), (2, None, 9), (3, "", 9),
            (4, "word " * 30000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = bpe.encode_documents(df, P.path("word_bpe_49k.json"), digest=False).collect()
    b = bpe.Bpe(P.path("word_bpe_49k.json"))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == sorted(
        (i or 0, len(b.encode(t))) for i, t, _ in rows)
    assert {tuple(r.ids) for r in out if r.doc_id == 1} == {tuple(b.encode("Hello there"))}
    assert all(r.decoded == b.decode(r.ids) for r in out)
    assert bpe.encode_documents(df.limit(0), P.path("word_bpe_49k.json")).collect() == []


# -- pages -------------------------------------------------------------------------
PAGE = """<html><head><title>t</title><style>p{}</style></head><body>
<header><a href=/>Home</a> <a href=/x>Site header words here</a></header>
<nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept all of them please.</div>
<div id="main"><article><header><h1>Title &amp; more</h1></header>
<p>First   paragraph with <b>bold</b> words and a <a href=x>link</a> inside it.
<p>Second&nbsp;paragraph, which was not closed &lt;here&gt; but goes on for a while.
<div class="ad">Buy now, cheap, this advert is long enough to look like a text.</div>
<ul><li>alpha item<li>beta item</ul>
<table><tr><td>cell one<td>cell two</table>
<p>Last one,<br>over two lines.</p><script>var p = "</p>";</script></article>
<section class="comments"><p>I am a reader and this is my rather long comment, it is.</p></section></div>
<aside><p>Related stories of the week, sorted by hand</p></aside>
<form><p>Your mail</p><input></form><footer>&copy; all rights reserved</footer></body></html>"""


def test_main_text_of_a_page():
    assert H.main_text(PAGE).split("\n") == [
        "Title & more", "First paragraph with bold words and a link inside it.",
        "Second paragraph, which was not closed <here> but goes on for a while.",
        "alpha item", "beta item", "cell one cell two", "Last one, over two lines."]


def test_names_on_the_holder_of_the_article_do_not_count():
    comments = ('<div class="comments"><article class="comment"><p>A reader writes a comment of some'
                ' length here.</p></article></div>')
    html = (f'<body><div class="page with-sidebar"><article><p>Real text one, long enough.</p>'
            f'<p>Real text two, long enough.</p></article>{comments}'
            '<div class="sidebar"><p>Links of the side bar</p></div></div></body>')
    assert H.main_text(html) == "Real text one, long enough.\nReal text two, long enough."


def test_several_sections_are_all_kept():
    parts = [f"<section><h2>Part {k}</h2>" + "".join(
        f"<p>Sentence {j} of part {k} with a number of words in it.</p>" for j in range(3 + 4 * k))
        + "</section>" for k in range(3)]
    html = "<body><nav><a>a</a><a>b</a></nav><div>" + "".join(parts) + "</div></body>"
    got = H.main_text(html)
    assert all(f"Part {k}" in got and f"Sentence 2 of part {k}" in got for k in range(3))


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>one<p>two", "one\ntwo"),
    ("a < b and c > d", "a < b and c > d"), ("<body></body>", ""), ("<div", ""),
    ("<p>x<!-- y --> z</p>", "x z"), ("<p>&#x41;&eacute;&nbsp;b</p>", "Aé b"),
    ("<p title='a>b'>t</p>", "t"), ("<script>never</script>", ""),
    ('<p>shown</p><p hidden>not</p><p style="display: none">nor</p>', "shown")])
def test_odd_pages(html, want):
    assert H.main_text(html) == want


def test_deep_and_long_pages():
    assert H.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    text = "word " * 40000
    assert H.main_text(f"<body><p>{text}</p></body>") == text.strip()


def test_density_formula():
    page = H.Page("<body><p>12345678<a>90</a></p></body>")
    d, sums = H.densities(page)
    p = page.tag.index("p")
    assert sums[page.tag.index("body")] == d[p]
    share, c = 2 / 10, 10
    base = np.log(c / (c - 2) * 2 + share * c + np.e)
    assert d[p] == pytest.approx(c / 1 * np.log(c / 2 * 1 / 1) / np.log(base))


def test_slugs_inside_the_article_are_text():
    long = "This is a sentence of the article that is long enough to count. " * 3
    html = (f'<body><article><h1>Title</h1><p>{long}</p><h2 id="related-work">Related work</h2>'
            f'<p class="share-price">{long}</p><section id="search-algorithms"><h2 id="search">'
            f'Searching</h2><p>{long}</p></section><div id="related-posts"><a>One more</a>'
            f'<a>Another one</a></div><div class="comments-area" id="comment-list"><p>{long}</p>'
            f'</div><p class="cookie-notice">We use them.</p></article></body>')
    s = long.strip()
    assert H.main_text(html).split("\n") == ["Title", s, "Related work", s, "Searching", s]


def test_quotes_open_a_value_only_after_an_equals_sign():
    body = "A paragraph that's long enough to count as the text of a page, isn't it."
    page = ("<body><article><p><img alt=don't src=x>" + body + "</p><p title=\"5\" tall\">" + body
            + "</p><p class='a' data-x=it's>" + body + "</p><p>End.</p></article></body>")
    assert H.main_text(page).split("\n") == [body, body, body, "End."]
    assert H.main_text('<p a="b>c">x</p><p a=\'>\'>y</p>') == "x\ny"


def test_short_last_paragraphs_of_an_article_are_kept():
    long = "Words of the article that are many and stand close together, one after another. " * 8
    page = ("<body><div class=ad>buy</div><article><h1>T</h1><p><b>" + long
            + "<br><p>\u00c9\u00ea.</p></article><footer>f</footer></body>")
    assert H.main_text(page).split("\n") == ["T", long.strip(), "\u00c9\u00ea."]
    plain = ("<body><div id=x><div>" + "".join(f"<p>{long}</p>" for _ in range(3))
             + "</div><div><p>Short.</p></div></div><nav><a>m</a></nav></body>")
    assert H.main_text(plain).split("\n")[:3] == [long.strip()] * 3


@pytest.mark.parametrize("name", ["social-contract", "search-results-analysis", "notice-board-history"])
@pytest.mark.parametrize("tag", ["div", "section"])
def test_classes_that_begin_with_a_noise_word_are_text(tag, name):
    s = "A sentence of the article that is long enough to be counted as text by any measure."
    page = (f"<body><article><p>{s}</p><{tag} class={name}><p>{s}</p></{tag}><p>{s}</p>"
            f"<{tag} class={name}><a href=1>one link</a> <a href=2>another link</a></{tag}>"
            f"<{tag} class='cookie-notice'>{s}</{tag}><{tag} class=comments><p>{s}</p></{tag}>"
            "</article></body>")
    assert H.main_text(page).split("\n") == [s, s, s]


def test_parsing_takes_linear_time():
    import time

    def seconds(make):
        out = []
        for n in (4_000, 16_000):
            html = make(n)
            begin = time.perf_counter()
            H.main_text(html)
            out.append(time.perf_counter() - begin)
        return out

    for make in (lambda n: '<a title="x>' * n, lambda n: "<p class='" * n + ">", lambda n: "<a " * n,
                 lambda n: "<div class=x>" * n + "t", lambda n: "<div>" * n + "</x>" * n,
                 lambda n: "<b a=\"'\">w" * n, lambda n: "<i>" * n + "w <u>" * n):
        small, large = seconds(make)
        assert large < 12 * max(small, 0.02), (make(2), small, large)


def _random_tree(rng, depth=0):
    """(tag, children: trees and texts)."""
    kinds = ["div", "section", "p", "b", "a", "span", "ul"] if depth else ["body"]
    tag = rng.choice(kinds)
    if tag == "p" or depth > 4:  # nothing that would close it
        return tag, [rng.choice([("a", ["link text"]), ("b", ["bold"])]), "plain words here",
                     ("span", ["more"])][:rng.randint(1, 3)]
    inner = []
    for _ in range(rng.randint(1, 4)):
        if rng.random() < .7 or inner and isinstance(inner[-1], str):
            inner.append(_random_tree(rng, depth + 1))
        else:
            inner.append("some text " * rng.randint(1, 9))
    return tag, inner


def _html(tree):
    return tree if isinstance(tree, str) else (
        f"<{tree[0]}>" + "".join(map(_html, tree[1])) + f"</{tree[0]}>")


def _counts(tree):
    """Characters, link characters, tags and link tags below a node (link tags with itself)."""
    c = lc = t = lt = 0
    for x in tree[1]:
        if isinstance(x, str):
            c += len(x.strip())
        else:
            xc, xlc, xt, xlt = _counts(x)
            c, lc, t, lt = c + xc, lc + xlc, t + xt + 1, lt + xlt
    return (c, c, t, lt + 1) if tree[0] == "a" else (c, lc, t, lt)


def test_densities_against_a_recursive_reading():
    rng = random.Random(8)
    for _ in range(60):
        tree = _random_tree(rng)
        page = H.Page(_html(tree))
        density, sums = H.densities(page)
        body = _counts(tree)
        flat = []

        def walk(x, flat=flat, body=body):
            c, lc, t, lt = _counts(x)
            t_ = max(t, 1)
            if not c:
                d = 0.0
            elif not body[1]:
                d = c / t_
            else:
                base = math.log(c / max(c - lc, 1) * lc + body[1] / max(body[0], 1) * c + math.e)
                d = c / t_ * max(math.log(c / max(lc, 1) * t_ / max(lt, 1)), 0) / math.log(base)
            at = len(flat)
            flat.append([x[0], d, 0.0])
            flat[at][2] = sum(walk(y) for y in x[1] if not isinstance(y, str))
            return d

        walk(tree)
        assert page.tag[1:] == [f[0] for f in flat]
        assert all(math.isclose(a, f[1], abs_tol=1e-9) for a, f in zip(density[1:], flat, strict=True))
        assert all(math.isclose(a, f[2], abs_tol=1e-9) for a, f in zip(sums[1:], flat, strict=True))


def test_extract_pages(spark):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (None, None, None, 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = H.extract_pages(df).collect()
    assert sorted((r.page_id or 0, r.n_chars, len(r.text)) for r in out) == [
        (0, 0, 0), *[(1, len(H.main_text(PAGE)),) * 1 + (len(H.main_text(PAGE)),)] * 2]
    assert H.extract_pages(df.limit(0)).collect() == []


# -- top-k -------------------------------------------------------------------------
def brute_topk(rows, k=5):
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v)]
    out, seen = [], set()
    for q, a in ok:
        if q % 50 or (q, tuple(a)) in seen:
            continue
        seen.add((q, tuple(a)))
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, score int")


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 16)
    monkeypatch.setattr(K, "QUERIES", 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in np.round(rng.normal(size=6), 1) * (rng.random(6) < .6)])
            for i in range(230)]
    rows += [(300, None), (301, [float("nan")] * 6), (350, [None, 1.0]), (None, [1.0] * 6),
             (7, rows[7][1]), (50, rows[50][1]), (303, [1.0, 2.0]), (304, []), (305, [float("inf")])]
    got = sorted(tuple(r) for r in K.top_k(_vectors(spark, rows), F.col("vec_id") % 50 == 0).collect())
    assert got == brute_topk(rows)


def test_topk_few_rows_and_large_numbers(spark):
    assert K.top_k(_vectors(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    rows = [(0, [1e10, 1.0]), (1, [1e9, 2.0]), (2, [3e18, 0.0]), (3, [-1.0, 0.0])]
    got = [tuple(r) for r in K.top_k(_vectors(spark, rows), F.col("vec_id") == 0).collect()]
    vals = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows}
    want = {i: min(max(sum(a * b for a, b in zip(vals[0], vals[i])), -2**63), 2**63 - 1) for i in (1, 2, 3)}
    assert {r[2]: r[3] for r in got} == want and [r[2] for r in sorted(got, key=lambda r: r[1])] == [1, 2, 3]


def _topk_rows():
    """Vectors of whole numbers: many ties, zeros, repeated ids, ragged widths."""
    rng = np.random.default_rng(3)
    return [(int(i), [float(x) for x in rng.integers(-2, 3, size=rng.integers(0, 6))])
            for i in rng.integers(-120, 400, size=260)]


def test_topk_never_broadcasts_copies(spark):
    """The planner sees the packed queries, not what shards copies of them would take."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.autoBroadcastJoinThreshold": "10MB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB"}
    before = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        rows = [(i, [float(i % 7), 1.0]) for i in range(300)]
        out = K.top_k(_vectors(spark, rows).repartition(3), F.col("vec_id") % 50 == 0)
        assert sorted(tuple(r) for r in out.collect()) == brute_topk(rows)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "Generate" not in plan
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


@pytest.mark.parametrize("size", [1, 2000])
def test_topk_by_groups_of_queries(spark, monkeypatch, size):
    monkeypatch.setattr(K, "BLOCK", 32)
    monkeypatch.setattr(K, "QUERIES", 2)
    monkeypatch.setattr(K, "GROUP_BYTES", size)
    rows = _topk_rows()
    got = sorted(tuple(r) for r in K.top_k(_vectors(spark, rows).repartition(3),
                                           F.col("vec_id") % 50 == 0).collect())
    # shorter vectors are different queries, though their scores may be equal
    assert got == brute_topk(rows)


def test_topk_queries_of_one_id_stay_apart(spark):
    # -1.0 and -2.0 have one hash in Python
    rows = [(0, [-1.0]), (0, [-2.0]), (1, [1.0]), (2, [3.0])]
    got = sorted(tuple(r) for r in K.top_k(_vectors(spark, rows), F.col("vec_id") == 0).collect())
    assert got == brute_topk(rows) and len(got) == 4


@pytest.mark.parametrize("kind", [np.int32, np.int64, object])
def test_topk_best_so_far_equals_sorting(kind):
    rng = np.random.default_rng(4)
    far = {np.int32: 3, np.int64: 1 << 61, object: 1 << 70}[kind]
    own, k, seen = np.array([5, 7, 900]), 4, [[], [], []]
    best = K._Best(own, k)
    for n in (1, 50, 50, 3, 200, 200):
        ids = np.sort(rng.integers(0, 12 if n == 50 else 300, size=n))
        s = np.array([[int(x) * far for x in row] for row in rng.integers(-3, 4, size=(3, n))], dtype=kind)
        best.add(s, ids)
        for i in range(3):
            seen[i] += [(-min(max(int(x), -2**63), 2**63 - 1), int(v))
                        for x, v in zip(s[i], ids, strict=True) if v != own[i]]
        got = list(zip(best.rows.tolist(), (-x for x in best.scores.tolist()), best.ids.tolist(), strict=True))
        assert got == [(i, *x) for i in range(3) for x in sorted(seen[i])[:k]]


# -- revisits ----------------------------------------------------------------------
def test_canonical_urls(spark):
    urls = ["HTTP://WWW.Ex.com:80/a/?b=2&a=1#f", "https://ex.com/a?a=1&b=2", "ex.com/a/", None, ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(W.canonical_url(F.col("u"))).collect()]
    assert got == ["ex.com/a?a=1&b=2", "ex.com/a?a=1&b=2", "ex.com/a", None, ""]


def brute_revisits(rows):
    out, last = {}, {}
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[0] is not None, r[0] or 0))
    for rid, url, ts, kind, status, headers, digest in order:
        h = headers or {}
        if kind == "response":
            out[rid] = ("response", rid, status, digest, h)
            if url is not None:
                last[url] = (rid, status, h, digest)
            continue
        t = last.get(url) if url is not None else None
        if t is None:
            out[rid] = ("no-url" if url is None else "unresolved", None, status, digest, h)
            continue
        th = t[2]
        strip = lambda e: e.removeprefix("W/") if e else None
        a, b = strip(h.get("etag")), strip(th.get("etag"))
        c, d = h.get("last-modified"), th.get("last-modified")
        ok = a == b if a and b else c == d if c and d else True
        if not ok:
            out[rid] = ("mismatch", None, status, digest, h)
        else:
            more = {k: v for k, v in h.items() if k in W.UPDATABLE and v is not None}
            out[rid] = ("resolved", t[0], t[1], t[3], th | more)
    return out


def test_revisits_equal_brute_force(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        url = rng.choice(["hot.com/x"] * 6 + ["a.com", "b.com/y", None])
        full = rng.random() < .2
        h = {k: v for k, v in {"etag": rng.choice([None, '"1"', 'W/"1"', '"2"']),
                               "last-modified": rng.choice([None, "d1", "d2"]),
                               "vary": rng.choice([None, "x"]), "server": "s"}.items() if v}
        rows.append((i, url, rng.choice([None, *range(60)]), "response" if full else "revisit",
                     200 if full else 304, rng.choice([h, h, None]), f"d{i}" if full else None))
    df = spark.createDataFrame([(*r, "extra") for r in rows],
                               "record_id long, url string, ts long, kind string, status int,"
                               " headers map<string,string>, digest string, outcome string")
    got = {r.record_id: (r.outcome, r.target_id, r.status, r.digest,
                         {e["key"]: e["value"] for e in r["headers"]})
           for r in W.resolve_revisits(df.repartition(3)).collect()}
    assert got == brute_revisits(rows)
    assert W.resolve_revisits(df.limit(0)).collect() == []


# -- chat --------------------------------------------------------------------------
def brute_cost(codes):
    """Least cost over all state sequences."""
    best = None
    for states in itertools.product((1, 2, 3), repeat=len(codes)):
        cost, at = 0, C.START
        for r, s in zip(codes, states, strict=True):
            ways = [c for f, t, c, *_ in C.MOVES[r] if (f, t) == (at, s)]
            if not ways:
                cost = None
                break
            cost, at = cost + min(ways), s
        if cost is not None:
            cost += C.INSERT * len(C.ENDING[at])
            best = cost if best is None else min(best, cost)
    return best


def brute_states(codes):
    """The cheapest state sequence; of equal ones the smallest, read from the last state back."""
    best = None
    for states in itertools.product((1, 2, 3), repeat=len(codes)):
        cost, at = 0, C.START
        for r, s in zip(codes, states, strict=True):
            ways = [c for f, t, c, *_ in C.MOVES[r] if (f, t) == (at, s)]
            if not ways:
                break
            cost, at = cost + min(ways), s
        else:
            best = min(best or (10**9,), (cost + C.INSERT * len(C.ENDING[at]), states[::-1]))
    return list(best[1][::-1])


def test_states_do_not_depend_on_borders():
    rng = random.Random(12)
    cases = [[2, 0, 3, 0], *([rng.randint(0, 3) for _ in range(rng.randint(1, 7))] for _ in range(250))]
    for codes in cases:
        roles, want = np.array(codes), brute_states(codes)
        for block in (1, 2, 3, len(codes)):
            parts = [roles[i:i + block] for i in range(0, len(codes), block)]
            ends = C.border_states([C.cost_matrix(p) for p in parts], [C.tie_ranks(p) for p in parts])
            got = [s for p, a, b in zip(parts, [C.START, *ends], ends, strict=False)
                   for s in C.best_states(p, a, b)]
            assert got == want, (codes, block)


def test_rows_do_not_depend_on_blocks_or_partitions(spark, monkeypatch):
    rng = random.Random(5)
    convs = {k: [rng.choice(["system", "user", "assistant", "tool", None])
                 for _ in range(rng.choice([1, 3, 9, 40]))] for k in range(25)}
    convs |= {90: ["user", None, "assistant", None], 91: ["user"] * 120}
    rows = [(k, i, r, f"t{i}") for k, rs in convs.items() for i, r in enumerate(rs)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    seen = []
    for block, parts in ((2000, 1), (1, 8), (2, 4), (3, 8), (2000, 8)):
        monkeypatch.setattr(C, "BLOCK", block)
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            seen.append(sorted(map(tuple, C.repair(df).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(x == seen[0] for x in seen)
    roles = [r[3] for r in seen[0] if r[0] == 90]
    assert roles == [C.ROLES[s - 1] for s in brute_states([2, 0, 3, 0])]


def _cost(actions):
    price = {"keep": 0, "merge": C.MERGE, "relabel": C.RELABEL, "relabel-merge": C.RELABEL + C.MERGE}
    return sum(price[a] + C.INSERT * n for a, n in actions)


def _legal(text):
    roles = [p.split("|>")[0] for p in text.split("<|")[1:] if not p.startswith("end")]
    if roles and roles[0] == "system":
        roles = roles[1:]
    return roles == ["user", "assistant"] * (len(roles) // 2) and len(roles) >= 2


@pytest.mark.parametrize("block", [2, 2000])
def test_chat_repair_is_cheapest_and_legal(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rng = random.Random(6)
    convs = {k: [rng.choice(["system", "user", " User", "assistant", "gpt", "tool", None])
                 for _ in range(rng.randint(1, 6))] for k in range(40)}
    convs[None] = ["user", "user"]
    rows = [(k, i, r, rng.choice(["hi", "", None, "x" * 50]), 1)
            for k, rs in convs.items() for i, r in enumerate(rs)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, position int")
    out = C.repair(df.repartition(3)).collect()
    assert len(out) == len(rows)
    for k, rs in convs.items():
        mine = sorted((r for r in out if r.conv_id == k), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(rs)))
        assert [r.turn for r in mine] == list(range(len(rs)))
        assert _legal("".join(r.rendered for r in mine)), (rs, mine)
        assert _cost((r.action, r.inserted) for r in mine) == brute_cost([C.role_code(r) for r in rs])
    assert C.repair(df.limit(0)).collect() == []


def test_legal_conversations_are_only_rendered():
    roles = np.array([1, 2, 3, 2, 3])
    got = C.repair_run(roles, ["s", "u", "a", "v", "b"], C.START, 3, True)
    assert [g[0] for g in got] == ["keep"] * 5
    assert "".join(g[3] for g in got) == (
        "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\na<|end|>\n"
        "<|user|>\nv<|end|>\n<|assistant|>\nb<|end|>\n")
