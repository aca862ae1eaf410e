"""Trigram postings index for substring search.

``build_postings`` turns text columns into ``(trigram, key..., column)`` rows;
``posting_lists`` gives the same postings as short lists, made from blocks of texts, which
cost a small part of the rows to stage, shuffle and sort.  ``write_postings`` lays either
out as rows, range-partitioned and sorted by trigram, so a
lookup's ``trigram IN (...)`` predicate is pushed into the Parquet scan and
skips row groups by min/max statistics.  ``write_index`` adds a small table of how many
postings every trigram has.

``search_indexed`` looks a term's trigrams up in that table, reads the lists of the rarest
few only, keeps the keys that have all of these in one column, and verifies them with the
scan predicate.  Lists of common trigrams are not read: beside a list of ten keys a list of
a third of all rows removes less than it costs, and verification decides anyway.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith.functions.text import GRAM, fold, literal_trigrams, trigrams, usable_terms
from partsmith.operators.search import search_predicate
from partsmith.session import scratch_path
from partsmith.sources.files import delete, folder_size

FILE_BYTES = 128 << 20
#: Postings in a file at most, about: lists that compress well still make tasks of this size.
FILE_POSTINGS = 32 << 20
ROW_GROUP_BYTES = 16 << 20
#: Lists read for one term, and how much longer than the shortest one they may be.
LISTS, WIDER = 3, 16
#: Characters of the texts whose postings are sorted at once, and the longest list made of
#: them: rows of lists are dealt into files, so the longest is not many times the mean one.
BLOCK_CHARS, PIECE = 4 << 20, 64
#: Postings in one Arrow batch of lists.
BATCH_POSTINGS = 1 << 18


def build_postings(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per distinct trigram of each (row, column) value: ``trigram``,
    the key columns, ``column`` (name of the text column).  A projection +
    generator per column."""
    src = df.select(*keys, *columns)
    parts = []
    for c in columns:
        parts.append(src.select(*keys, F.lit(c).alias("column"),
                               F.explode(trigrams(c)).alias("trigram")))
    posts = reduce(lambda a, b: a.unionByName(b), parts)
    return posts.select("trigram", *keys, "column")


def posting_lists(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The postings of ``build_postings`` as lists: ``trigram``, an array for every key column
    (their n-th elements are one posting) and ``column``.  A list has at most ``PIECE``
    postings of one block of rows, so a trigram has many."""
    schema = T.StructType([T.StructField("trigram", T.StringType())] + [
        T.StructField(k, T.ArrayType(df.schema[k].dataType)) for k in keys])
    parts = []
    for c in columns:
        texts = df.where(F.length(c) > 0).select(*keys, fold(c).alias("__text"))
        parts.append(texts.mapInArrow(_lists_of_batches, schema)
                     .select("*", F.lit(c).alias("column")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _lists_of_batches(batches: Iterator) -> Iterator:
    """Deals rows of (keys, folded text) into blocks of about ``BLOCK_CHARS`` characters."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, chars = [], 0
    for batch in batches:
        start = 0
        for i, n in enumerate(pc.utf8_length(batch.column("__text")).to_pylist()):
            if chars and chars + n > BLOCK_CHARS:
                yield from _lists_of_block(pa.Table.from_batches([*held, batch.slice(start, i - start)]))
                held, chars, start = [], 0, i
            chars += n
        held.append(batch.slice(start))
    if chars:
        yield from _lists_of_block(pa.Table.from_batches(held))


def _lists_of_block(block) -> Iterator:
    """Lists of one block.  A trigram and its row are one number: the places of the three
    characters among those of the block, then the row; sorting brings the lists together."""
    import numpy as np
    import pyarrow as pa

    texts = block.column("__text").to_pylist()
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[chars] = True
    alphabet = np.flatnonzero(seen).astype(np.uint32)
    bits, row_bits = (len(alphabet) - 1).bit_length(), (len(texts) - 1).bit_length()
    if GRAM * bits + row_bits > 63:  # never with one text: a code point has 21 bits
        yield from _lists_of_block(block.slice(0, len(texts) // 2))
        yield from _lists_of_block(block.slice(len(texts) // 2))
        return
    place = np.zeros(0x110000, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    place = place[chars]
    row = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) for t in texts])
    posts = ((place[:-2] << bits | place[1:-1]) << bits | place[2:]) << row_bits | row[:-2]
    posts = posts[row[:-2] == row[2:]]
    posts.sort()
    posts = posts[np.diff(posts, prepend=-1) != 0]
    grams, rows = posts >> row_bits, posts & ((1 << row_bits) - 1)

    first = np.flatnonzero(np.diff(grams, prepend=-1))
    in_list = np.arange(len(grams)) - np.repeat(first, np.diff(first, append=len(grams)))
    ends = np.append(np.flatnonzero(in_list % PIECE == 0), len(grams))
    each = grams[ends[:-1]]
    low = (1 << bits) - 1
    text = alphabet[np.stack([each >> 2 * bits, each >> bits & low, each & low], 1)]
    text = text.tobytes().decode("utf-32-le")
    names = pa.array([text[i:i + GRAM] for i in range(0, len(text), GRAM)], pa.string())

    keys = [n for n in block.column_names if n != "__text"]
    of_row = block.select(keys).combine_chunks()
    a = 0
    while a < len(each):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + BATCH_POSTINGS, "right")) - 1)
        taken = of_row.take(pa.array(rows[ends[a]:ends[b]]))
        offsets = pa.array((ends[a:b + 1] - ends[a]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.concat_arrays(taken.column(k).chunks))
                 for k in keys]
        yield pa.RecordBatch.from_arrays([names.slice(a, b - a), *lists], ["trigram", *keys])
        a = b


def list_postings(lists: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``build_postings`` from ``posting_lists``, in the order of the lists."""
    if len(keys) == 1:
        return lists.select("trigram", F.explode(keys[0]).alias(keys[0]), "column")
    return lists.select("trigram", F.inline(F.arrays_zip(*keys)), "column")


def write_postings(postings: DataFrame, path: str, rows_per_file: int | None = None,
                   compression: str = "zstd", file_bytes: int = FILE_BYTES,
                   lists: Sequence[str] = (), counts: str | None = None) -> None:
    """Write the postings compacted into files of about ``file_bytes`` bytes or
    ``FILE_POSTINGS`` rows (or ``rows_per_file`` rows), at least one per core, range partitioned and sorted by trigram
    and key (one "segment" per range; a trigram with more rows than a file goes on in the
    next; rewriting the folder is the optimise step).

    Rows of ``posting_lists`` (``lists``: their key columns) are partitioned and sorted as
    lists, by trigram and first key, and written as one row per posting.

    The postings are generated once, into a scratch table; sizes, range borders and the table
    ``counts`` (folder, if given: ``trigram, n_postings``) are told from there."""
    spark = postings.sparkSession
    staged = scratch_path(spark, "staged-postings")
    postings.write.option("compression", compression).parquet(staged)
    rows = spark.read.schema(postings.schema).parquet(staged)
    n = F.sum(F.size(lists[0]) if lists else F.lit(1))
    order = ["trigram", *[F.get(c, F.lit(0)) if c in lists else F.col(c)
                          for c in postings.columns if c != "trigram"]]
    n_rows = rows.agg(n).first()[0] or 0
    if rows_per_file is None:
        files = max(spark.sparkContext.defaultParallelism,
                    -(-folder_size(spark, staged) // file_bytes), -(-n_rows // FILE_POSTINGS))
    else:
        files = max(1, -(-n_rows // rows_per_file))
    laid = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ((list_postings(laid, lists) if lists else laid)
     .write.mode("overwrite").option("compression", compression)
     .option("parquet.block.size", ROW_GROUP_BYTES).parquet(path))
    if counts:
        (rows.groupBy("trigram").agg(n.alias("n_postings"))
         .repartitionByRange("trigram").sortWithinPartitions("trigram")
         .write.mode("overwrite").parquet(counts))
    delete(spark, staged)


class Index(NamedTuple):
    """Postings and ``trigram, n_postings``, both sorted by trigram."""

    postings: DataFrame
    trigrams: DataFrame


def write_index(postings: DataFrame, path: str, **layout) -> Index:
    """Write ``path/postings`` (see ``write_postings``) and ``path/trigrams``; the index."""
    spark = postings.sparkSession
    write_postings(postings, f"{path}/postings", counts=f"{path}/trigrams", **layout)
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    return Index(*(spark.read.parquet(f"{path}/{n}") for n in ("postings", "trigrams")))


def rarest_trigrams(trigrams: DataFrame, term: str) -> list[str] | None:
    """The trigrams of ``term`` whose lists are worth reading, rarest first: at most ``LISTS``,
    none more than ``WIDER`` times as long as the rarest one.  None if one of the term's
    trigrams has no list, so that nothing can match."""
    grams = literal_trigrams(term)
    # as many rows as the term has trigrams
    found = {r["trigram"]: r["n_postings"] for r in trigrams.where(
        F.col("trigram").isin(*grams)).collect()}
    if len(found) < len(grams):
        return None
    order = sorted(grams, key=lambda g: (found[g], g))
    return [g for g in order[:LISTS] if found[g] <= WIDER * found[order[0]]]


def _term_candidates(index: Index | DataFrame, keys: Sequence[str], term: str) -> DataFrame:
    """Keys having the trigrams of ``term`` (the rarest ones, where their counts are known) in
    one and the same column."""
    if isinstance(index, DataFrame):
        postings, grams = index, literal_trigrams(term)
    else:
        postings, grams = index.postings, rarest_trigrams(index.trigrams, term)
    if grams is None:
        return postings.select(*keys).where(F.lit(False))
    hit = postings.filter(F.col("trigram").isin(*grams))
    if len(grams) == 1:
        return hit.select(*keys).distinct()
    per_col = hit.groupBy(*keys, "column").agg(F.count_distinct("trigram").alias("__n"))
    return per_col.filter(F.col("__n") == len(grams)).select(*keys).distinct()


def search_indexed(df: DataFrame, postings: Index | DataFrame, keys: Sequence[str],
                   all: Iterable[str] | None = None,  # noqa: A002 - API name
                   any: Iterable[str] | None = None,  # noqa: A002
                   none: Iterable[str] | None = None,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Same result as ``search(df, all, any, none, columns)``, answered through
    the index (or postings alone, of which then all lists are read): candidate keys (semi
    joins on the key), then verification with the scan predicate on the candidates only."""
    keys = list(keys)
    must = usable_terms(all)
    should = usable_terms(any)
    if not must and not should:
        return df.filter(F.lit(False))
    cand = None
    for term in must:
        c = _term_candidates(postings, keys, term)
        cand = c if cand is None else cand.join(c, keys, "left_semi")
    if should:
        anyc = reduce(lambda a, b: a.unionByName(b),
                      [_term_candidates(postings, keys, t) for t in should]).distinct()
        cand = anyc if cand is None else cand.join(anyc, keys, "left_semi")
    rows = df.join(cand, keys, "left_semi")
    return rows.filter(search_predicate(all, any, none, columns))
