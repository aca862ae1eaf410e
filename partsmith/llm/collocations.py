"""Phrase collocations by counting quotient filters.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and the pieces
into words.  A phrase of 2 to ``MAX_WORDS`` words of a language with at least ``MIN_COUNT``
occurrences is a candidate.  Its score is the least of floor(1000 a n / (l r)) over the cuts
into two parts (a, l, r: occurrences of the phrase and its parts, n: words of the language).

Phrases are counted one length after the other.  A phrase can be frequent only if the two
phrases without its last and its first word are, so a candidate of k words is a pair of ids
of frequent phrases of k - 1 words (of word ids, for k = 2).  Blocks of texts are kept as
sequences of such ids.  A block counts its distinct pairs in a counting quotient filter
(``quotient_filter``), cut into shards by the keys' first bits; the sorted filters of a
shard are merged, pairs that are frequent get an id, and every block is told the ids of its
own pairs.  No vocabulary is broadcast, a pair is one entry per block however often it
occurs, and the permuted keys spread evenly over the shards.

A word belongs to its language, so the languages never mix.  Arithmetic is exact
(decimals of 38 digits).

Defined cases: null texts are empty; a null lang is "und"; empty tables give none; phrases
never cross pieces or documents; repeated rows count each; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partsmith.llm.common import written
from partsmith.llm.quotient_filter import QuotientFilter, half_bits, invert, merge, permute

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: Bytes of text in a block, unless one text is longer.
BLOCK_BYTES = 8 << 20
#: Pairs of a shard, about.
SHARD_PAIRS = 2_000_000
UNKNOWN = "und"

#: Every end of a piece becomes a line feed, a tab a space.
_MARKS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
_NOTHING, _END = 0, 1  # ids of the empty word and of a piece's end


def _packed(ids: np.ndarray) -> bytes:
    """Ids (and -1) as bytes: 4 each where they fit, after a byte that names the width."""
    wide = len(ids) and int(ids.max()) >= 1 << 31
    return (b"\x08" if wide else b"\x04") + ids.astype(np.int64 if wide else np.int32).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, f"<i{blob[0]}", offset=1).astype(np.int64)


def _runs(ids: np.ndarray) -> np.ndarray:
    """``ids`` without what has no neighbour: runs of at least two ids, each ended by -1."""
    ok = ids >= 0
    use = ok & (np.r_[False, ok[:-1]] | np.r_[ok[1:], False])
    end = ~use & np.r_[False, use[:-1]]
    return np.where(use, ids, -1)[use | end]


def _pairs(ids: np.ndarray, half: int) -> np.ndarray:
    """Key of the pair that begins at each place; only where ``_paired`` holds."""
    at = np.flatnonzero(_paired(ids))
    return permute(ids[at], ids[at + 1], half)


def _paired(ids: np.ndarray) -> np.ndarray:
    return (ids[:-1] >= 0) & (ids[1:] >= 0)


# -- words --------------------------------------------------------------------------
def _words(documents: DataFrame, block_bytes: int) -> DataFrame:
    """Per block one row ``block, seq`` (local word ids) and one row ``block, lang, word, local,
    n`` for each of its words."""
    names = ["block", "seq", "lang", "word", "local", "n"]
    kinds = [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int64()]

    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        size, seqs, vocabularies, fresh = 0, [], {}, count(2)

        def block():
            seq = np.concatenate(seqs)
            counts = np.bincount(seq)
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + number], kinds[0]), pa.array([seq.tobytes()], kinds[1]),
                 *[pa.nulls(1, k) for k in kinds[2:]]], names)
            for lang, ids in vocabularies.items():
                words = [w for w, i in ids.items() if i > _END]
                local = np.array([i for i in ids.values() if i > _END], np.int32)
                m = len(words)
                if m:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, base + number)), pa.nulls(m, kinds[1]),
                         pa.array([lang] * m, kinds[2]),
                         pa.array(words, pa.binary()).cast(pa.string()),
                         pa.array(local, kinds[4]), pa.array(counts[local], kinds[5])], names)

        for batch in batches:
            langs, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                raw = texts[i].as_py()
                if not raw:
                    continue
                lang = langs[i].as_py()
                if lang not in vocabularies:
                    vocabularies[lang] = defaultdict(
                        fresh.__next__, {b"": _NOTHING, b"\n": _END})
                tokens = raw.lower().translate(_MARKS).replace(b"\n", b" \n ").split(b" ")
                ids = np.fromiter(map(vocabularies[lang].__getitem__, tokens), np.int32,
                                  len(tokens))
                seqs += [ids[ids != _NOTHING], np.array([_END], np.int32)]
                size += len(raw)
                if size >= block_bytes:
                    yield from block()
                    number += 1
                    size, seqs, vocabularies, fresh = 0, [], {}, count(2)
        if seqs:
            yield from block()

    docs = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    return docs.mapInArrow(
        run, "block long, seq binary, lang string, word string, local int, n long")


def _numbered(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written with a dense ``id``, and a number above all ids."""
    low = (1 << 33) - 1
    out = written(df.withColumn("mid", F.monotonically_increasing_id()), name)
    part = F.shiftright("mid", 33)
    parts = (out.agg(F.max(part)).first()[0] or 0) + 1
    out = out.withColumn("id", F.col("mid").bitwiseAND(F.lit(low)) * parts + part).drop("mid")
    return out, (out.agg(F.max("id")).first()[0] or 0) + 1


_STATE = "block long, seq binary, pairs long"


def _state(block: int, ids: np.ndarray) -> pd.DataFrame:
    ids = _runs(ids)
    pairs = int(_paired(ids).sum()) if len(ids) else 0
    if not pairs:
        return pd.DataFrame({"block": [], "seq": [], "pairs": []})
    return pd.DataFrame({"block": [block], "seq": [_packed(ids)], "pairs": [pairs]})


def _word_ids(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """A block's sequence in ids of frequent words; the others are -1."""
    if not len(left):
        return _state(0, np.zeros(0, np.int64))
    seq = np.frombuffer(left["seq"].iloc[0], np.int32)
    own = np.full(int(seq.max(initial=1)) + 1, -1, np.int64)
    own[right["local"].to_numpy(np.int64)] = right["id"].to_numpy(np.int64)
    return _state(int(left["block"].iloc[0]), own[seq])


# -- longer phrases -----------------------------------------------------------------
def _slices(states: DataFrame, half: int, shard_bits: int) -> DataFrame:
    """The quotient filters of every block, one per shard of the keys."""
    bits = 2 * half - shard_bits

    def run(batches):
        for batch in batches:
            for block, blob in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                keys, counts = np.unique(_pairs(_unpacked(blob), half), return_counts=True)
                shard = keys >> np.uint64(bits) if bits < 64 else np.zeros(len(keys), np.uint64)
                shards, cut = np.unique(shard, return_index=True)
                low = keys & np.uint64((1 << bits) - 1)
                made = [QuotientFilter.build(low[a:b], counts[a:b], bits).pack()
                        for a, b in zip(cut, [*cut[1:], len(keys)], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards.astype(np.int32)),
                     pa.array(np.full(len(shards), block)), pa.array(made, pa.binary())],
                    ["shard", "block", "filter"])

    return states.select("block", "seq").mapInArrow(run, "shard int, block long, filter binary")


def _merged(half: int, shard_bits: int, least: int):
    """Merge the filters of a shard: a row of its frequent pairs (block ``_TOTAL``), and for each
    block that has some of them a row of its keys and their ids."""
    bits, shards = 2 * half - shard_bits, 1 << shard_bits

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        frame = frame.sort_values("block", kind="stable")
        filters = [QuotientFilter.unpack(x) for x in frame["filter"]]
        keys, totals, entries, place = merge(filters)
        often = totals >= least
        ids = (np.cumsum(often) - 1) * shards + shard
        rows: list[tuple] = []
        if often.any():
            full = keys[often] | (np.uint64(shard) << np.uint64(bits) if bits < 64 else np.uint64(0))
            first, second = invert(full, half)
            rows.append((_TOTAL, None, None, first, second, ids[often], totals[often]))
            at = 0
            high = np.uint64(shard) << np.uint64(bits) if bits < 64 else np.uint64(0)
            for block, f in zip(frame["block"], filters, strict=True):
                own = place[at:at + len(f)]
                use = often[own]
                if use.any():
                    rows.append((block, (entries[at:at + len(f)][use] | high).tobytes(),
                                 ids[own[use]].astype(np.int64).tobytes(), None, None, None, None))
                at += len(f)
        return pd.DataFrame(rows, columns=["block", "keys", "ids", "first", "second", "id", "f"])

    return run


#: The block of a shard's own row.
_TOTAL = -1
_MERGED = ("block long, keys binary, ids binary, first array<long>, second array<long>,"
           " id array<long>, f array<long>")


def _next_ids(half: int):
    """A block's sequence in ids of frequent phrases of one word more."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _state(0, np.zeros(0, np.int64))
        ids = _unpacked(left["seq"].iloc[0])
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in right["keys"]])
        names = np.concatenate([np.frombuffer(x, np.int64) for x in right["ids"]])
        order = np.argsort(keys)
        keys, names = keys[order], names[order]
        own = _pairs(ids, half)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        out = np.full(len(ids), -1, np.int64)
        out[:-1][_paired(ids)] = np.where(keys[at] == own, names[at], -1)
        return _state(int(left["block"].iloc[0]), out)

    return run


def phrases(documents: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS,
            block_bytes: int = BLOCK_BYTES, shard_pairs: int = SHARD_PAIRS
            ) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of 1, 2, ... words, and ``lang, n`` (its words).  Columns: ``id,
    lang, phrase, last`` (word), ``f``, ``heads`` and ``tails`` (occurrences of its first and
    last 1, 2, ... words), ``longer`` (occurrences of the most frequent one among the phrases
    of one word more that hold it; 0 if none)."""
    spark = documents.sparkSession
    made = written(_words(documents, block_bytes), "words")
    vocabulary = made.where("word is not null")
    totals = written(vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f")), "vocabulary")
    sizes = totals.groupBy("lang").agg(F.sum("f").alias("n"))
    often, top = _numbered(totals.where(F.col("f") >= least), "frequent")
    # all words of a block, -1 for those that aren't frequent: as many rows as words, however
    # many of them have come to be frequent in a larger input
    local = vocabulary.select("block", "lang", "word", "local").join(
        often.select("lang", "word", "id"), ["lang", "word"], "left").select(
        F.col("block").alias("own"), "local", F.coalesce("id", F.lit(-1)).alias("id"))
    states = written(
        made.where("seq is not null").select("block", "seq").groupBy("block").cogroup(
            local.groupBy("own")).applyInPandas(_word_ids, _STATE), "states")
    levels = [often.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
                           "f", F.array("f").alias("heads"), F.array("f").alias("tails"))]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for words in range(2, longest + 1):
        pairs = states.agg(F.sum("pairs")).first()[0] or 0
        if not pairs:
            break
        half = half_bits(top)
        shards = max(2 * partitions, -(-pairs // shard_pairs))
        shard_bits = min(2 * half, (shards - 1).bit_length(), 30)
        got = written(_slices(states, half, shard_bits).groupBy("shard").applyInPandas(
            _merged(half, shard_bits, least), _MERGED), "pairs")
        table = got.where(F.col("block") == _TOTAL).select(
            F.explode(F.arrays_zip("id", "first", "second", "f")).alias("x")).select("x.*")
        top = (table.agg(F.max("id")).first()[0] or 0) + 1
        a, b = levels[-1].alias("a"), levels[-1].alias("b")
        levels.append(table.alias("t").join(a, F.expr("t.first = a.id")).join(
            b, F.expr("t.second = b.id")).select(
            "t.id", "a.lang", F.concat_ws(" ", "a.phrase", "b.last").alias("phrase"),
            "b.last", "t.f", F.concat("a.heads", F.array("t.f")).alias("heads"),
            F.concat("b.tails", F.array("t.f")).alias("tails"), "t.first", "t.second"))
        levels[-1] = written(levels[-1], "phrases")
        if words < longest:
            states = written(states.groupBy("block").cogroup(
                got.where(F.col("block") != _TOTAL).select(
                    F.col("block").alias("own"), "keys", "ids").groupBy("own"))
                .applyInPandas(_next_ids(half), _STATE), "states")
    out = []
    for k, level in enumerate(levels):
        longer = F.lit(0).cast("long").alias("longer")
        if k + 1 < len(levels):
            up = levels[k + 1].select(F.explode(F.array("first", "second")).alias("id"), "f")
            up = up.groupBy("id").agg(F.max("f").alias("longer"))
            level, longer = level.join(up, "id", "left"), F.coalesce("longer", longer).alias("longer")
        out.append(level.select("id", "lang", "phrase", "last", "f", "heads", "tails", longer))
    return out, sizes


def ranked(levels: list[DataFrame], sizes: DataFrame, top: int) -> DataFrame:
    """The first ``top`` candidates of every language among the ``phrases``."""
    found = levels[0].where("false")
    for level in levels[1:]:
        found = found.unionByName(level)
    # a longer phrase never has more occurrences than one inside it, so looking at the phrases
    # of one word more is enough
    kept = found.where("longer < f").join(sizes, "lang")
    number = "decimal(38,0)"
    cuts = F.expr(f"""transform(sequence(1, size(heads) - 1), k -> named_struct(
        'score', (cast(1000 as {number}) * f * n)
                 div (cast(element_at(heads, k) as {number}) * element_at(tails, size(tails) - k)),
        'k', k, 'l', element_at(heads, k), 'r', element_at(tails, size(tails) - k)))""")
    scored = kept.withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(best).cast("long"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def collocations(documents: DataFrame, least: int = MIN_COUNT, top: int = TOP,
                 block_bytes: int = BLOCK_BYTES, shard_pairs: int = SHARD_PAIRS) -> DataFrame:
    """The first ``top`` candidates of every language by score, that no longer candidate with as
    many occurrences holds: ``lang, rank, phrase, a, l, r, n, score``."""
    return ranked(*phrases(documents, least, block_bytes=block_bytes, shard_pairs=shard_pairs), top)
