"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item is cut into windows of ``size`` consecutive words (an item of
fewer words is one window).  A window is the set of its word shingles with their
places; a document contains the window only if it contains *all* its shingles, so
the necessary prefix in any global order is a single shingle.  Shingles are ordered
by how often they occur in the documents, rarest first, and only the rarest shingle
of each window is joined with the documents.  A window with a shingle that never
occurs is dropped before the join.  The place of the shingle fixes where the window
would start: the positional bound (it starts at or after word 0) and the length
bound (it ends within the document) prune before the words are compared exactly.

Everything is DataFrame expressions.  The windows are broadcast only if their
counted rows and bytes are below the bounds in ``common``; otherwise candidates are
made by a shuffle join and verified after joining the words back.

Defined cases: null or empty texts have no words, no hits and no windows; a null
item id counts as the empty string; repeated document rows get equal results;
repeated items count once by id; columns beyond the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import on_key, small_enough, text_key, words, written

WINDOW = 10
SHINGLE = 3


def item_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """Distinct windows: ``win`` (words), ``len``, ``items`` (sorted ids that hold it)."""
    items = (benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                              words(F.col(text_col)).alias("w"))
             .select("item", "w", F.least(F.size("w"), F.lit(size)).alias("len"))
             .where("len > 0"))
    wins = (items.select("item", "w", "len",
                         F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1)).alias("at"))
            .select("item", "len", F.slice("w", F.col("at"), F.col("len")).alias("win")))
    return wins.groupBy("win", "len").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _shingle_hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def _document_shingles(documents: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row per word place: key columns, ``w`` (all words), ``p`` (place), ``sh``."""
    docs = documents.select(*text_key(F.col(id_col), F.col(text_col)),
                            words(F.col(text_col)).alias("w"))
    shifted = [F.col("w")] + [F.slice("w", F.lit(i + 1), F.greatest(F.size("w"), F.lit(1)))
                              for i in range(1, k)]
    if k == 1:
        out = docs.select("doc_id", "text_hash", "w", F.posexplode("w").alias("p", "s"))
        return out.withColumn("sh", _shingle_hash([F.col("s")])).drop("s")
    zipped = F.arrays_zip(*[c.alias(f"w{i}") for i, c in enumerate(shifted)])
    out = docs.select("doc_id", "text_hash", "w", F.posexplode(zipped).alias("p", "s"))
    fields = [f.name for f in out.schema["s"].dataType.fields]
    return out.withColumn("sh", _shingle_hash([F.col("s").getField(f) for f in fields])).drop("s")


def _window_prefixes(documents: DataFrame, windows: DataFrame, k: int, id_col: str,
                     text_col: str) -> DataFrame:
    """The rarest shingle of every window that can occur: ``sh``, ``o`` (its place)."""
    placed = (windows.select("win", "len", "items",
                             F.posexplode(F.expr(
                                 f"transform(sequence(1, len - {k} + 1), i -> slice(win, i, {k}))"))
                             .alias("o", "part"))
              .withColumn("sh", _shingle_hash([F.col("part")[i] for i in range(k)]))
              .drop("part"))
    placed = written(placed, f"shingles{k}")
    vocabulary = placed.select("sh").distinct()
    occurring = _document_shingles(documents, k, id_col, text_col).select("sh")
    if small_enough(vocabulary, F.lit(8)):
        vocabulary = F.broadcast(vocabulary)
    counts = occurring.join(vocabulary, "sh").groupBy("sh").agg(F.count(F.lit(1)).alias("freq"))
    ranked = placed.join(counts, "sh", "left").groupBy("win", "len", "items").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "sh", "o")).alias("rare"))
    return ranked.where("rare.freq > 0").select(
        "win", "len", "items", F.col("rare.sh").alias("sh"), F.col("rare.o").alias("o"))


def window_matches(documents: DataFrame, windows: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", shingle: int = SHINGLE,
                   broadcast: bool | None = None) -> DataFrame:
    """Every occurrence of a window: ``doc_id, text_hash, start, end, items``.
    ``broadcast`` forces one of the two joins (None: by size)."""
    windows = written(windows, "windows")
    sizes = sorted({min(r[0], shingle) for r in windows.select("len").distinct().collect()})
    out = None
    for k in sizes:
        mine = windows.where(F.least(F.col("len"), F.lit(shingle)) == k)
        prefix = written(_window_prefixes(documents, mine, k, id_col, text_col), f"prefix{k}")
        fits = broadcast if broadcast is not None else small_enough(
            prefix, 64 + F.octet_length(F.array_join("win", "  ")) + 16 * F.size("items")
            + F.octet_length(F.array_join("items", "")))
        places = _document_shingles(documents, k, id_col, text_col)
        if fits:
            found = places.alias("d").join(F.broadcast(prefix.alias("x")), F.expr(
                "d.sh = x.sh AND d.p >= x.o AND d.p - x.o + x.len <= size(d.w)"
                " AND slice(d.w, d.p - x.o + 1, x.len) = x.win"))
        else:
            cand = (places.drop("w").alias("d")
                    .join(prefix.alias("x"), F.expr("d.sh = x.sh AND d.p >= x.o")))
            texts = documents.select(*text_key(F.col(id_col), F.col(text_col)),
                                     words(F.col(text_col)).alias("w")).distinct().alias("t")
            found = cand.join(texts, F.expr(
                "d.doc_id <=> t.doc_id AND d.text_hash = t.text_hash"
                " AND d.p - x.o + x.len <= size(t.w)"
                " AND slice(t.w, d.p - x.o + 1, x.len) = x.win"))
        found = found.select(F.col("d.doc_id").alias("doc_id"),
                             F.col("d.text_hash").alias("text_hash"),
                             F.expr("d.p - x.o").alias("start"),
                             F.expr("d.p - x.o + x.len").alias("end"),
                             F.col("x.items").alias("items"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        spark = documents.sparkSession
        id_type = documents.schema[id_col].dataType.simpleString()
        out = spark.createDataFrame(
            [], f"doc_id {id_type}, text_hash long, start int, end int, items array<string>")
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  shingle: int = SHINGLE, broadcast: bool | None = None) -> DataFrame:
    """Per document row: ``doc_id, text_hash, n_words, n_hit, items`` (sorted ids)."""
    found = window_matches(documents, item_windows(benchmark, size), shingle=shingle,
                           broadcast=broadcast)
    hits = found.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.collect_set("items").alias("lists"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda a, x: F.struct(
            (a.hit + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a.reach))).alias("hit"),
            F.greatest(a.reach, x["end"]).alias("reach")),
        lambda a: a.hit)
    hits = hits.select("doc_id", "text_hash", covered.cast("long").alias("n_hit"),
                       F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"))
    docs = documents.select(*text_key(F.col("doc_id"), F.col("text")),
                            F.size(words(F.col("text"))).cast("long").alias("n_words"))
    return (docs.join(hits, on_key(docs, hits, ["doc_id", "text_hash"]), "left")
            .select(docs["doc_id"], docs["text_hash"], "n_words",
                    F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
