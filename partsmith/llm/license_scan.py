"""License scan as an exact set-similarity join.

Two kinds of text block are searched, both over the word sequence of a whole text:

* phrases (``PHRASES``): the block is a run of exactly the phrase's words, in order;
* templates (``TEMPLATES``): the block is a window of ``BLOCK`` words that begins at any
  place of a template's word.  It matches when it contains at least ``THRESHOLD`` of the
  template's distinct words and, as runs of words, all of the template's required phrases:
  these tell licences of nearly equal words apart ("by nc 4 0" from "by sa 4 0").  As a
  window can always be moved on to its first template word, no other window can match
  where these don't.

Template words are put in one global order, rarest in the documents first.  To reach
``need`` of ``n`` words a block must hold one of the template's first
``n - need + 1`` words (its prefix), so only the places of these few words are looked at,
each with the words around it; blocks begin up to ``BLOCK - 1`` words before.  The length
filter drops blocks of fewer than ``need`` words, the positional filter those that cannot
reach ``need`` even if every template word from the matched one on is present; survivors
are verified by counting common words.

The texts are read and split once.  What is written are the word counts, and the words of
those documents that hold every required word of some template or phrase.

Main path: DataFrame expressions only.  The joined table is made of the constants
below (some hundred rows), which bounds the broadcast.

Defined cases: null and empty texts have no words, no places and empty labels;
repeated rows get equal results; columns beyond the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import on_key, text_key, words, written

BLOCK = 64
THRESHOLD = 0.8

#: Fixed by the contract: phrase -> label.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Labels of our own: label -> text whose words a block must contain, and the phrases that it
#: must hold as they are.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0",
                   ["apache license", "version 2 0"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification"
            " are permitted provided that the following conditions are met",
            ["redistribution", "source and binary"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    "gpl-3.0": ("licensed under the gnu general public license version 3",
                ["gnu general public license", "version 3"]),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy"
                  " of this software and associated documentation files",
                  ["free of charge", "obtaining a copy"]),
    "mit-notice": ("released under the mit license", ["mit license"]),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0",
                ["mozilla public license", "v 2 0"]),
}


def _rows(phrases: dict[str, str], templates: dict[str, tuple[str, list[str]]],
          threshold: float) -> list[tuple]:
    """(label, phrase?, need, words in order, distinct words, required phrases)."""
    out = []
    for text, label in phrases.items():
        seq = text.split()
        out.append((label, True, len(set(seq)), seq, list(dict.fromkeys(seq)), [text]))
    for label, (text, required) in templates.items():
        seq = text.split()
        distinct = list(dict.fromkeys(seq))
        if len(seq) > BLOCK:
            raise ValueError(f"template {label} has more than {BLOCK} words")
        need = -(-len(distinct) * round(threshold * 1000) // 1000)
        out.append((label, False, need, seq, distinct, list(required)))
    return out


def _candidates(documents: DataFrame, rows: list[tuple]) -> DataFrame:
    """Per document row: ``doc_id, text_hash, n_words``, ``present`` (the template words that
    it holds) and its words ``w``, null unless it holds every required word of some row."""
    vocabulary = sorted({t for r in rows for t in r[4]})
    needed = [sorted({t for p in r[5] for t in p.split()}) for r in rows]
    docs = documents.select(*text_key(F.col("doc_id"), F.col("text")),
                            words(F.col("text")).alias("w"))
    docs = docs.withColumn("present", F.array_intersect(
        "w", F.array(*[F.lit(t) for t in vocabulary])))
    some = F.lit(False)
    for tokens in needed:
        held = F.lit(True)
        for t in tokens:
            held = held & F.array_contains("present", t)
        some = some | held
    return written(docs.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"),
                               "present", F.when(some, F.col("w")).alias("w")), "license")


def prefix_table(candidates: DataFrame, rows: list[tuple]) -> DataFrame:
    """One row per prefix word of each phrase and template, by global frequency (documents
    that hold it; as many numbers as the constants have words): ``token, rank`` (its place in
    that order), ``o`` (its place in the text)."""
    freq = {r["token"]: r["count"] for r in candidates.select(
        F.explode("present").alias("token")).groupBy("token").count().collect()}
    out = []
    for label, phrase, need, seq, distinct, required in rows:
        order = sorted(distinct, key=lambda t: (freq.get(t, 0), t))
        for rank, token in enumerate(order[:len(order) - need + 1]):
            out.append((label, phrase, need, seq, [f" {p} " for p in required], len(order), rank,
                        token, seq.index(token)))
    return candidates.sparkSession.createDataFrame(
        out, "label string, phrase boolean, need int, seq array<string>, required array<string>,"
             " n int, rank int, token string, o int")


def license_blocks(candidates: DataFrame, rows: list[tuple]) -> DataFrame:
    """Every matching block: ``doc_id, text_hash, label, phrase, start, n_block, score``."""
    prefix = prefix_table(candidates, rows)
    tokens = sorted({r["token"] for r in prefix.select("token").distinct().collect()})
    own = ", ".join(f"'{t}'" for t in tokens)
    # the places of prefix words, each with the words of all blocks over it
    places = F.expr(f"""transform(
        filter(transform(w, (t, p) -> struct(p, t)), x -> x.t IN ({own})),
        x -> struct(x.p AS p, x.t AS token, greatest(x.p - {BLOCK - 1}, 0) AS first,
                    slice(w, greatest(x.p - {BLOCK - 1}, 0) + 1,
                          x.p - greatest(x.p - {BLOCK - 1}, 0) + {BLOCK}) AS near))""")
    found = (candidates.where("w is not null")
             .select("doc_id", "text_hash", F.explode(places).alias("x"))
             .select("doc_id", "text_hash", "x.*").join(F.broadcast(prefix), "token"))
    # places in ``near`` where a block begins; the run of a phrase begins at p - o
    starts = F.expr("""if(phrase,
        filter(array(p - first - o), s -> s >= 0 AND slice(near, greatest(s, 0) + 1, size(seq)) = seq),
        filter(sequence(0, p - first), s -> array_contains(seq, near[s])))""")
    blocks = found.withColumn("s", F.explode(starts)).withColumn("block", F.expr(
        f"slice(near, s + 1, if(phrase, size(seq), {BLOCK}))"))
    # length and positional filters, then the exact count and the required phrases
    blocks = (blocks.where("size(block) >= need AND least(n - rank, size(block)) >= need")
              .withColumn("common", F.size(F.array_intersect("block", "seq")))
              .where("common >= need")
              .where("forall(required, r -> contains(concat(' ', array_join(block, ' '), ' '), r))"))
    return blocks.select("doc_id", "text_hash", "label", "phrase",
                         (F.col("first") + F.col("s")).cast("long").alias("start"),
                         F.size("block").alias("n_block"),
                         (F.col("common") / F.col("n")).alias("score")).distinct()


def license_scan(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score`` (the best block's share of template words, 0 if none)."""
    rows = _rows(PHRASES, TEMPLATES, threshold)
    docs = _candidates(documents, rows)
    base = F.col("phrase")
    hits = license_blocks(docs, rows).groupBy("doc_id", "text_hash").agg(
        F.sum(base.cast("long")).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",")
        .alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"))
    docs = docs.select("doc_id", "text_hash", "n_words")
    return (docs.join(hits, on_key(docs, hits, ["doc_id", "text_hash"]), "left")
            .select(docs["doc_id"], "n_words",
                    F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
                    "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
