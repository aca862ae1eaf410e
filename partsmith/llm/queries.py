"""One query per operator, ``opN_<name>``, over whole tables, and DuckDB SQL where SQL can
express it (the others are tested against brute force in ``tests/llm``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsmith.llm import (
    bpe,
    chat_repair,
    collocations,
    cross_tokenizer,
    decontaminate,
    html_extract,
    jaccard_join,
    language_id,
    license_scan,
    quality_fm,
    topk_search,
    toxicity,
    warc_revisit,
)
from partsmith.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file (default: that of op5 and the pipeline)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows with crc32(doc_id) divisible by 5 are held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand inside a benchmark window."""
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@_query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and their decoded text, as digests."""
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary())


def captures(pages: DataFrame) -> DataFrame:
    """Stand-in capture records in the schema of ``resolve_revisits``: of each page, a full
    response, a revisit with the same ETag, a revisit with Last-Modified only (of another
    day for every fifth page), and its host's robots.txt (full once in eight, else a
    revisit)."""
    host = F.regexp_extract("url", r"^([a-zA-Z]+://[^/?#]*)", 1)
    etag = F.concat(F.lit("\""), F.substring(F.sha2(F.col("html"), 256), 1, 12), F.lit("\""))
    day = F.concat(F.lit("day "), (F.col("page_id") % 28).cast("string"))
    other = F.concat(F.lit("day "), ((F.col("page_id") + F.when(
        F.col("page_id") % 5 == 0, 1).otherwise(0)) % 28).cast("string"))
    digest = F.sha2(F.col("html"), 256)
    no = F.lit(None).cast("string")

    def row(k, url, kind, status, headers, digest):
        return F.struct((F.col("page_id") * 4 + k).alias("record_id"), url.alias("url"),
                        (F.lit(1_600_000_000) + F.col("page_id") % 977 + 1000 * k).cast("long")
                        .alias("ts"), kind.alias("kind"), status.cast("int").alias("status"),
                        headers.alias("headers"), digest.alias("digest"))

    def pairs(**kw):
        return F.create_map(*[x for k, v in kw.items() for x in (F.lit(k.replace("_", "-")), v)])

    full, seen = F.lit("response"), F.lit("revisit")
    age, kind = F.lit("max-age=60"), F.lit("text/html")
    robots_full = F.col("page_id") % 8 == 0
    rows = F.array(
        row(0, F.col("url"), full, F.lit(200),
            pairs(etag=etag, last_modified=day, content_type=kind), digest),
        row(1, F.concat(F.col("url"), F.lit("#again")), seen, F.lit(304),
            pairs(etag=F.concat(F.lit("W/"), etag), cache_control=age, content_type=no), no),
        row(2, F.col("url"), seen, F.lit(304), pairs(last_modified=other, vary=F.lit("accept")),
            no),
        row(3, F.concat(host, F.lit("/robots.txt")), F.when(robots_full, full).otherwise(seen),
            F.when(robots_full, 200).otherwise(304),
            pairs(date=day, server=F.lit("any")), F.when(robots_full, F.md5(F.col("url")))))
    return pages.select(F.explode(rows).alias("r")).select("r.*")


@_query
def op6_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-modified revisits among captures of all pages, resolved."""
    out = warc_revisit.resolve_revisits(captures(table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda e: F.concat(
        e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))
    return out.select("record_id", "canonical", "outcome", "target_id", "status", "digest",
                      F.array_join(lines, "\n").alias("header_text"))


@_query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best scores of every vector whose id is divisible by 50, against all vectors."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query
def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation with its repaired role and rendered piece (as a
    digest)."""
    out = chat_repair.repair(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "turn", "position", "role", "action", "inserted",
                      F.char_length("rendered").cast("long").alias("n_chars"),
                      F.sha2("rendered", 256).alias("rendered_sha256"))


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with crc32(doc_id) mod 4 = 2 are held out."""
    return language_id.identify(table(spark, sf_dir, "documents"))


@_query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.8."""
    out = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


@_query
def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of a byte-level BPE and a sentencepiece encoding of every document."""
    return cross_tokenizer.align(table(spark, sf_dir, "documents"),
                                 vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@_query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of 2 to 5 words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@_query
def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; rows with crc32(doc_id) mod 3 = 1 are held out."""
    return quality_fm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


# -- DuckDB SQL ---------------------------------------------------------------------
_WORDS = (r"list_filter(string_split_regex(translate(coalesce({t}, ''),"
          r" 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

ORACLE_SQL["op2_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(t='text')} AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, {_WORDS.format(t='text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, w[s:s + least(len(w), 10) - 1] AS win
       FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, s, n, w[s:s + n - 1] AS win FROM (
         SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.s, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (
          SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM m)) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT d.doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


def _license_sql() -> str:
    phrases = ", ".join(f"({p.split()!r}, {v!r})" for p, v in license_scan.PHRASES.items())
    templates = ", ".join(
        f"({list(dict.fromkeys(text.split()))!r}, {[f' {p} ' for p in required]!r}, {v!r})"
        for v, (text, required) in license_scan.TEMPLATES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(t='text')} AS w FROM documents),
p(seq, label) AS (VALUES {phrases}), t(seq, req, label) AS (VALUES {templates}),
pl AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM d),
base AS (SELECT r, s - 1 AS s, label FROM pl, p WHERE w[s] = seq[1] AND w[s:s + len(seq) - 1] = seq),
blocks AS (SELECT r, label, seq, req, w[s:s + {license_scan.BLOCK - 1}] AS blk
           FROM pl, t WHERE list_contains(seq, w[s])),
tm AS (SELECT r, label, c / n AS score FROM (
         SELECT r, label, len(seq) AS n, req, ' ' || array_to_string(blk, ' ') || ' ' AS run,
                len(list_filter(seq, lambda x: list_contains(blk, x)))::DOUBLE AS c FROM blocks)
       WHERE c >= ceil(round(n * {license_scan.THRESHOLD}, 6))
         AND len(list_filter(req, lambda x: contains(run, x))) = len(req)),
a AS (SELECT r, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r),
l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
      FROM (SELECT r, label, score FROM tm UNION ALL SELECT r, label, 1.0 FROM base) GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word,
       last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       cast(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN a USING (r) LEFT JOIN l USING (r)
"""


ORACLE_SQL["op4_license_scan"] = _license_sql()

ORACLE_SQL["op7_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, cast(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

ORACLE_SQL["op12_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
      FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
sizes AS (SELECT lang, cast(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f
      FROM (SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s
                  FROM p, (VALUES (1), (2), (3), (4), (5)) AS ks(k) WHERE len(w) >= k))
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_ AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS s
                 FROM c, (VALUES (2), (3), (4)) AS ms(m) WHERE m < k) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inner_ USING (lang, phrase) WHERE coalesce(100 * longer < 100 * a, true)),
cuts AS (SELECT kept.lang, kept.phrase, a, j, x.f AS l, y.f AS r, n,
                (cast(1000 AS HUGEINT) * a * n) // (cast(x.f AS HUGEINT) * y.f) AS score
         FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) AS kept
         JOIN f x ON x.lang = kept.lang AND x.phrase = array_to_string(w[1:j], ' ')
         JOIN f y ON y.lang = kept.lang AND y.phrase = array_to_string(w[j + 1:kept.k], ' ')
         JOIN sizes ON sizes.lang = kept.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, cast(rank AS BIGINT) AS rank, phrase, cast(a AS BIGINT) AS a, cast(l AS BIGINT) AS l,
       cast(r AS BIGINT) AS r, cast(n AS BIGINT) AS n, cast(score AS BIGINT) AS score
FROM top WHERE rank <= 2000
"""

ORACLE_SQL["op6_warc_revisit"] = r"""
WITH k AS (
  SELECT *, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) AS host,
         '"' || substr(sha256(html), 1, 12) || '"' AS etag,
         'day ' || (page_id % 28) AS day,
         'day ' || ((page_id + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END) % 28) AS other
  FROM pages),
c AS (
  SELECT page_id * 4 AS record_id, url, 1600000000 + page_id % 977 AS ts, 'response' AS kind,
         200 AS status, etag AS etag, day AS lm, sha256(html) AS digest,
         map {'etag': etag, 'last-modified': day, 'content-type': 'text/html'} AS h FROM k
  UNION ALL
  SELECT page_id * 4 + 1, url || '#again', 1600001000 + page_id % 977, 'revisit', 304, etag, NULL,
         NULL, map {'etag': 'W/' || etag, 'cache-control': 'max-age=60', 'content-type': NULL} FROM k
  UNION ALL
  SELECT page_id * 4 + 2, url, 1600002000 + page_id % 977, 'revisit', 304, NULL, other, NULL,
         map {'last-modified': other, 'vary': 'accept'} FROM k
  UNION ALL
  SELECT page_id * 4 + 3, host || '/robots.txt', 1600003000 + page_id % 977,
         CASE WHEN page_id % 8 = 0 THEN 'response' ELSE 'revisit' END,
         CASE WHEN page_id % 8 = 0 THEN 200 ELSE 304 END, NULL, NULL,
         CASE WHEN page_id % 8 = 0 THEN md5(url) END, map {'date': day, 'server': 'any'} FROM k),
u AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM c),
v AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '')
        || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
        || CASE WHEN regexp_extract(bare, '\?(.+)$', 1) <> '' THEN '?' || list_aggregate(list_sort(
             list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> '')), 'string_agg', '&')
           ELSE '' END AS canonical FROM u),
w AS (SELECT *, last_value(CASE WHEN kind = 'response' THEN struct_pack(id := record_id, status := status,
                etag := etag, lm := lm, digest := digest, h := h) END IGNORE NULLS) OVER (
        PARTITION BY canonical ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t FROM v),
o AS (SELECT *, CASE WHEN kind = 'response' THEN 'response' WHEN canonical IS NULL THEN 'no-url'
        WHEN t IS NULL THEN 'unresolved'
        WHEN (CASE WHEN etag IS NOT NULL AND t.etag IS NOT NULL THEN etag = t.etag
                   WHEN lm IS NOT NULL AND t.lm IS NOT NULL THEN lm = t.lm ELSE true END) THEN 'resolved'
        ELSE 'mismatch' END AS outcome FROM w),
e AS (SELECT record_id, unnest(map_entries(h)) AS kv, 1 AS pri FROM o
      WHERE outcome <> 'resolved'
      UNION ALL SELECT record_id, unnest(map_entries(h)), 1 FROM o WHERE outcome = 'resolved'
      UNION ALL SELECT record_id, unnest(map_entries(t.h)), 2 FROM o WHERE outcome = 'resolved'),
f AS (SELECT e.record_id, kv.key AS name, kv.value AS val, pri FROM e JOIN o USING (record_id)
      WHERE outcome <> 'resolved' OR pri = 2 OR (kv.value IS NOT NULL AND kv.key IN ('cache-control',
        'content-location', 'date', 'etag', 'expires', 'last-modified', 'vary'))),
g AS (SELECT record_id, name, val FROM f
      QUALIFY row_number() OVER (PARTITION BY record_id, name ORDER BY pri) = 1),
x AS (SELECT record_id, string_agg(name || ': ' || coalesce(val, ''), chr(10) ORDER BY name) AS header_text
      FROM g GROUP BY record_id)
SELECT o.record_id, canonical, outcome,
       CASE WHEN outcome = 'resolved' THEN t.id WHEN kind = 'response' THEN o.record_id END AS target_id,
       cast(CASE WHEN outcome = 'resolved' THEN t.status ELSE status END AS INT) AS status,
       CASE WHEN outcome = 'resolved' THEN t.digest ELSE digest END AS digest, coalesce(header_text, '') AS header_text
FROM o LEFT JOIN x USING (record_id)
"""
