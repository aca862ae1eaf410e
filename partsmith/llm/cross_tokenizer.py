"""Alignment of two tokenizers' tokens over the same bytes.

A text is encoded by both (A: a byte-level BPE file of the tokenizers library, B: a
sentencepiece model).  Byte offsets where tokens of both end cut the tokens into groups; all
occurrences of an A and a B token in one group are linked.  A pair of ids counts the
documents that hold it linked.

Where both tokenizers encode a text chunk by chunk (checked when they are loaded), the
groups of a chunk are found once per task and remembered.

Most groups are one A token and one B token of the same bytes.  An array from every A id to
the B id of the same bytes (the identity map) tells them; they are counted in one vector as
long as A's vocabulary per task.  Only the pairs of other groups go through a shuffle, and
only once per block of texts: a block keeps its distinct groups ("types"), the distinct
pairs behind them and in how many of its documents each pair is linked.  The summed counts
are joined back to the blocks' pairs, summed per type and then per document.  What
travels to every task is two vectors of A's vocabulary length.

Special token strings inside texts are plain text.  Defined cases: texts that are null or
empty, or whose bytes one of the tokenizers doesn't return, have no tokens (zeros, no
groups); repeated rows count each; a group without inner common ends, however long, is
counted by its distinct ids; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from partsmith.llm.bpe import byte_symbols
from partsmith.llm.common import written
from partsmith.llm.wordhash import mix

#: Bytes of text in a block, unless one text is longer.
BLOCK_BYTES = 4 << 20
#: Texts whose chunks are looked up together, by their characters.
CALL_CHARS = 1 << 18
#: Chunks (and characters of one) that a task remembers; beyond, it begins anew.
MEMO_CHUNKS, MEMO_CHARS = 200_000, 64
#: Groups with more pairs than this are first reduced to their distinct ids.
WIDE = 4096

#: Fixed by the byte-level format: the pattern of its words.
_WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Between two characters that aren't white space, before a single space.
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")
#: A text without these is cut at every space.
_ODD = re.compile(r"^\s| \s|\s | $")


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and the identity map.

    ``parts``: whether both encode a text chunk by chunk, cut before single spaces.  A does if
    its words come from the byte-level pattern, in which a space can only begin a word; B does
    if no piece has a space after another character, so that no merge reaches over the cut."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {s: bytes([i]) for i, s in enumerate(byte_symbols())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = b"".join(byte_of.get(c, c.encode()) for c in token)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        plain = {x: i for i, x in enumerate(self.b_bytes) if self.b.is_byte(i)}
        plain |= {x: i for i, x in enumerate(self.b_bytes)
                  if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        self.identity = np.array([plain.get(x, -1) for x in self.a_bytes], np.int64)
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        words = spec.get("pre_tokenizer") or {}
        self.parts = (spec.get("normalizer") is None and words.get("type") == "ByteLevel"
                      and words.get("use_regex", True) and not words.get("add_prefix_space")
                      and not any(b" " in x.lstrip(b" ") for x in self.b_bytes))
        self.quick = self._ranked(spec) if self.parts else None

    def _ranked(self, spec: dict):
        """A as an encoder by ranks, which is the same thing (and quicker) if the merges make the
        ids after the single bytes' in order; else None."""
        special = {t["content"] for t in spec.get("added_tokens") or []}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        if [vocab.get(m) for m in merges] != list(range(256, 256 + len(merges))):
            return None
        import tiktoken

        ranks = {self.a_bytes[i]: i for i in vocab.values()}
        return tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("\u2581", " ").encode()

    def chunks(self, text: str) -> list[str]:
        """``text`` in chunks that are encoded on their own, each with a space before it."""
        if not self.parts:
            return [text]
        if _ODD.search(text):
            return [c[1:] for c in _BETWEEN.split(" " + text)]
        return text.split(" ")

    def ids(self, text: str, plain: bool = False) -> tuple[list[int], list[int]] | None:
        """A and B ids of a text with a space before it; None where the bytes don't come back.
        ``plain``: it has no long runs of white space."""
        want = (" " + text).encode()
        x = (self.quick.encode_ordinary(" " + text) if plain and self.quick
             else self.a.encode(" " + text, add_special_tokens=False).ids)
        y = self.b.encode(text)  # B puts the space before it
        same = (b"".join(map(self.a_bytes.__getitem__, x)) == want
                == b"".join(map(self.b_bytes.__getitem__, y)))
        return (x, y) if same else None

    def groups(self, x: list[int], y: list[int]) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
        """The groups of A ids ``x`` and B ids ``y`` of the same bytes."""
        a, b = self.a_bytes, self.b_bytes
        i = j = i0 = j0 = at_a = at_b = 0
        while i < len(x) or j < len(y):
            if at_a <= at_b:
                at_a += len(a[x[i]])
                i += 1
            else:
                at_b += len(b[y[j]])
                j += 1
            if at_a == at_b:
                yield tuple(x[i0:i]), tuple(y[j0:j])
                i0, j0 = i, j


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


class Side:
    """The tokens of one tokenizer in a text, and their groups."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, other_ends: np.ndarray):
        at = np.minimum(np.searchsorted(other_ends, ends), max(len(other_ends) - 1, 0))
        common = other_ends[at] == ends if len(other_ends) else np.zeros(len(ends), bool)
        self.ids, self.common_ends = ids, ends[common]
        self.group = np.cumsum(common) - common
        self.size = np.bincount(self.group, minlength=int(common.sum()))
        self.start = _starts(self.size)
        self.place = np.arange(len(ids)) - self.start[self.group]

    def hashed(self, seed: int) -> np.ndarray:
        """A hash of every group's ids in order."""
        if not len(self.ids):
            return np.zeros(0, np.uint64)
        x = mix(self.ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                + self.place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(seed))
        return np.add.reduceat(x, self.start)

    def equal_to(self, first: np.ndarray) -> bool:
        """Whether every group has the ids of the group ``first`` names for it."""
        if not (self.size == self.size[first]).all():
            return False
        return bool((self.ids == self.ids[self.start[first][self.group] + self.place]).all())


def group_types(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """A group of each type, and the type of every group; exact (equal hashes of different
    groups are noticed and hashed anew)."""
    seed = 1
    while True:
        key = mix(a.hashed(seed)) + b.hashed(seed + 1)
        _, first, kind = np.unique(key, return_index=True, return_inverse=True)
        if not len(key) or (a.equal_to(first[kind]) and b.equal_to(first[kind])):
            return first, kind
        seed += 2


def _distinct(row: np.ndarray, value: np.ndarray, rows: int, values: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of pairs of a row and a value (below ``rows`` and ``values``), by row
    and value.  ``row`` is sorted.  Marked in a table of some rows at a time; sorted where such
    tables would be mostly empty."""
    if rows * values > 200 * len(row):
        key = np.unique(row * values + value)
        return key // values, key % values
    out_row, out_value = [row[:0]], [value[:0]]
    step = max(1, (1 << 23) // max(values, 1))
    for low in range(0, rows, step):
        s, e = np.searchsorted(row, (low, low + step))
        marks = np.zeros(min(step, rows - low) * values, bool)
        marks[(row[s:e] - low) * values + value[s:e]] = True
        at = np.flatnonzero(marks)
        out_row.append(at // values + low)
        out_value.append(at % values)
    return np.concatenate(out_row), np.concatenate(out_value)


class Types:
    """The different groups a task has met, numbered, with what counting needs of each."""

    def __init__(self, tok: Tokenizers):
        self.tok, self.n_b = tok, len(tok.b_bytes)
        self.number: dict[tuple, int] = {}
        self.names: list[str] = []
        self.sizes: list[tuple[int, int]] = []
        # distinct pairs (a_id * n_b + b_id) and links of each; an identity pair is -1 - a_id
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def of(self, group: tuple[tuple[int, ...], tuple[int, ...]]) -> int:
        """The number of a group."""
        found = self.number.get(group)
        if found is None:
            found = self.number[group] = len(self.names)
            x, y = group
            self.names.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            self.sizes.append((len(x), len(y)))
            pair, times = self._links(x, y)
            self.pairs.append(pair)
            self.times.append(times)
        return found

    def _links(self, x: tuple[int, ...], y: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        identity = self.tok.identity
        if len(x) == len(y) == 1 and identity[x[0]] == y[0]:  # the fast path
            return np.array([-1 - x[0]], np.int64), np.ones(1, np.int64)
        if len(x) * len(y) <= 64:  # most groups
            few: dict[int, int] = {}
            for i in x:
                same, base = identity[i], i * self.n_b
                for j in y:
                    pair = -1 - i if j == same else base + j
                    few[pair] = few.get(pair, 0) + 1
            return np.array(list(few), np.int64), np.array(list(few.values()), np.int64)
        a, b = np.array(x, np.int64), np.array(y, np.int64)
        if len(a) * len(b) > WIDE:
            a, na = np.unique(a, return_counts=True)
            b, nb = np.unique(b, return_counts=True)
        else:
            na, nb = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        pair = (a[:, None] * self.n_b + b[None, :]).ravel()
        pair, at = np.unique(pair, return_inverse=True)
        times = np.bincount(at, (na[:, None] * nb[None, :]).ravel()).astype(np.int64)
        own = identity[pair // self.n_b] == pair % self.n_b
        return np.where(own, -1 - pair // self.n_b, pair), times


_NONE = (-1,)  # types of a chunk whose bytes a tokenizer doesn't return


class Encoder:
    """Types of the groups of texts; remembers chunks."""

    def __init__(self, tok: Tokenizers):
        self.tok, self.types = tok, Types(tok)
        self.memo: dict[str, tuple[int, ...]] = {}

    def _learn(self, chunks: list[str], into: dict[str, tuple[int, ...]]) -> None:
        """Chunks that begin and end with no white space are encoded as one text, which gives
        the same ids in one call; if the bytes don't come back, each on its own."""
        plain = [c for c in chunks if self.tok.parts and c and not c[0].isspace()
                 and not c[-1].isspace() and "\u2581" not in c]
        if plain:
            got = self._together(plain)
            into.update(zip(plain, got, strict=True) if got else map(self._alone, plain))
        into.update(self._alone(c) for c in chunks if c not in into)

    def _alone(self, chunk: str) -> tuple[str, tuple[int, ...]]:
        got = self.tok.ids(chunk)
        return chunk, tuple(map(self.types.of, self.tok.groups(*got))) if got else _NONE

    def _together(self, chunks: list[str]) -> list[tuple[int, ...]] | None:
        got = self.tok.ids(" ".join(chunks), all(len(c) <= MEMO_CHARS for c in chunks))
        if got is None:
            return None
        x, y = (np.array(i, np.int64) for i in got)
        a_ends, b_ends = np.cumsum(self.tok.a_len[x]), np.cumsum(self.tok.b_len[y])
        a, b = Side(x, a_ends, b_ends), Side(y, b_ends, a_ends)
        first, kind = group_types(a, b)
        number = np.array([
            self.types.of((tuple(got[0][s:s + n]), tuple(got[1][u:u + m])))
            for s, n, u, m in zip(a.start[first].tolist(), a.size[first].tolist(),
                                  b.start[first].tolist(), b.size[first].tolist(), strict=True)])
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        cut = np.searchsorted(a.common_ends, ends)
        if not (a.common_ends[np.minimum(cut, len(a.common_ends) - 1)] == ends).all():
            return None  # not expected: a token reaches over a cut
        types, cut = number[kind].tolist(), [0, *(cut + 1).tolist()]
        return [tuple(types[s:e]) for s, e in zip(cut, cut[1:], strict=False)]

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The types of every text's groups; none where a tokenizer doesn't return the bytes."""
        cut = [self.tok.chunks(t) if t else [] for t in texts]
        if len(self.memo) > MEMO_CHUNKS:
            self.memo.clear()
        fresh = set(chain.from_iterable(cut)).difference(self.memo)
        known, once = self.memo, {}
        self._learn([c for c in fresh if len(c) <= MEMO_CHARS], known)
        self._learn([c for c in fresh if len(c) > MEMO_CHARS], once)
        out = []
        for cs in cut:
            got = list(map(known.get, cs))
            if None in got:
                got = [once[c] if g is None else g for c, g in zip(cs, got, strict=True)]
            whole = np.array(list(chain.from_iterable(got)), np.int32)
            out.append(whole[:0] if len(whole) and whole.min() < 0 else whole)
        return out


class Block:
    """Groups, types and pairs of the texts of a block."""

    def __init__(self, kinds: list[np.ndarray], types: Types):
        self.n_groups = np.array([len(k) for k in kinds], np.int64)
        every = np.concatenate(kinds)
        held = np.bincount(every, minlength=len(types.names)) > 0
        used = np.flatnonzero(held)
        kind = (np.cumsum(held) - 1)[every]
        self.kind, self.types = kind, len(used)
        self.cut = np.r_[0, np.cumsum(self.n_groups)]
        self.names = [types.names[t] for t in used]
        sizes = np.array([types.sizes[t] for t in used], np.int64).reshape(-1, 2)
        doc = np.repeat(np.arange(len(kinds)), self.n_groups)
        self.n_a, self.n_b, self.n_links = (
            np.bincount(doc, x[kind], minlength=len(kinds)).astype(np.int64)
            for x in (sizes[:, 0], sizes[:, 1], sizes[:, 0] * sizes[:, 1]))
        self.entries = np.array([len(types.pairs[t]) for t in used], np.int64)
        none = [np.zeros(0, np.int64)]
        pair = np.concatenate([types.pairs[t] for t in used] or none)
        self.times = np.concatenate([types.times[t] for t in used] or none)
        # entries of types: a pair of this block (from 0), or -1 - the A id of an identity pair
        self.pairs, place = np.unique(pair[pair >= 0], return_inverse=True)
        self.entry = pair.copy()
        self.entry[pair >= 0] = place
        self._count(doc, len(types.tok.a_bytes))

    def _count(self, doc: np.ndarray, n_a: int) -> None:
        """In how many documents each pair is linked: ``held`` of the block's pairs, and
        ``vector`` of the identity pairs by A id."""
        n = len(self.n_groups)
        doc, kind = _distinct(doc, self.kind, n, max(self.types, 1))
        size = self.entries[kind]
        at = np.repeat(_starts(self.entries)[kind], size) + np.arange(size.sum()) - np.repeat(
            _starts(size), size)
        wide = len(self.pairs) + n_a
        entry = self.entry[at]
        entry = np.where(entry < 0, len(self.pairs) - 1 - entry, entry)
        counts = np.bincount(_distinct(np.repeat(doc, size), entry, n, wide)[1], minlength=wide)
        self.held, self.vector = counts[:len(self.pairs)], counts[len(self.pairs):]

    def digests(self) -> list[str]:
        kind, cut, names = self.kind.tolist(), self.cut.tolist(), self.names
        return [hashlib.sha256(";".join([names[t] for t in kind[s:e]]).encode()).hexdigest()
                if e > s else "" for s, e in zip(cut, cut[1:], strict=False)]


def _schema(doc_id) -> StructType:
    out = StructType().add("block", LongType()).add("doc_id", doc_id)
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        out = out.add(name, LongType())
    return (out.add("groups_sha256", StringType()).add("types", BinaryType())
            .add("pairs", ArrayType(LongType())).add("held", ArrayType(IntegerType()))
            .add("entries", BinaryType()).add("entry", BinaryType()).add("times", BinaryType())
            .add("vector", ArrayType(LongType())))


def encode_blocks(documents: DataFrame, a_path: str, b_path: str,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Both encodings of all texts in blocks, written: a row per document (``types`` of its
    groups), a row per block (``pairs`` and in how many documents each is ``held``; ``entry``
    and ``times`` of its types) and a row per task (``vector``)."""
    schema = _schema(documents.schema["doc_id"].dataType)
    names = schema.names

    def run(batches):
        tok = Tokenizers(a_path, b_path)
        encoder = Encoder(tok)
        base, number = TaskContext.get().partitionId() << 32, 0
        total = np.zeros(len(tok.a_bytes), np.int64)
        kinds = None

        def rows(n, given):
            return pa.RecordBatch.from_arrays(
                [given[c] if c in given else pa.nulls(n, k)
                 for c, k in zip(names, kinds, strict=True)], names)

        def block(ids, groups):
            made = Block(groups, encoder.types)
            np.add(total, made.vector, out=total)
            n = len(groups)
            kind = made.kind.astype(np.int32)
            yield rows(n, {
                "block": pa.array(np.full(n, base + number)), "doc_id": pa.array(ids, kinds[1]),
                "n_a": pa.array(made.n_a), "n_b": pa.array(made.n_b),
                "n_groups": pa.array(made.n_groups), "n_links": pa.array(made.n_links),
                "groups_sha256": pa.array(made.digests()),
                "types": pa.array([kind[s:e].tobytes() for s, e in
                                   zip(made.cut, made.cut[1:], strict=False)], pa.binary())})
            if made.types:
                yield rows(1, {
                    "block": pa.array([base + number]),
                    "pairs": pa.array([made.pairs], pa.list_(pa.int64())),
                    "held": pa.array([made.held.astype(np.int32)], pa.list_(pa.int32())),
                    "entries": pa.array([made.entries.astype(np.int32).tobytes()]),
                    "entry": pa.array([made.entry.astype(np.int32).tobytes()]),
                    "times": pa.array([made.times.tobytes()])})

        ids, groups, texts, size, held = [], [], [], 0, 0
        for batch in batches:
            if kinds is None:
                kinds = [pa.int64(), batch.schema.field(0).type, *[pa.int64()] * 4, pa.string(),
                         pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                         *[pa.binary()] * 3, pa.list_(pa.int64())]
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                texts.append(batch.column(1)[i].as_py())
                held += len(texts[-1] or "")
                if held >= CALL_CHARS:
                    groups += encoder.texts(texts)
                    size, held, texts = size + held, 0, []
                if size >= block_bytes:
                    yield from block(ids, groups)
                    number += 1
                    ids, groups, size = [], [], 0
        groups += encoder.texts(texts)
        if ids:
            yield from block(ids, groups)
        if kinds is not None:
            yield rows(1, {"vector": pa.array([total], pa.list_(pa.int64()))})

    return written(documents.select("doc_id", "text").mapInArrow(run, schema), "encoded")


def _vector(rows: DataFrame, n: int) -> np.ndarray:
    """``at, value`` rows (at most ``n``, A's vocabulary) as a vector."""
    out = np.zeros(n, np.int64)
    for r in rows.collect():
        out[r["at"]] = r["value"]
    return out


def identity_counts(encoded: DataFrame, n: int) -> np.ndarray:
    """Documents of every A id's identity pair."""
    cells = encoded.where("vector is not null").select(F.posexplode("vector").alias("at", "n"))
    return _vector(cells.where("n > 0").groupBy("at").agg(F.sum("n").alias("value")), n)


def other_counts(encoded: DataFrame) -> DataFrame:
    """``pair, docs`` of all other pairs."""
    cells = encoded.where("pairs is not null").select(
        F.explode(F.arrays_zip("pairs", "held")).alias("x"))
    return cells.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("docs"))


def link_counts(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The alignment itself: ``a_id, b_id, docs`` of all linked pairs of ids."""
    spark = documents.sparkSession
    tok = Tokenizers(a_path, b_path)
    n_b = len(tok.b_bytes)
    encoded = encode_blocks(documents, a_path, b_path)
    counts = identity_counts(encoded, len(tok.a_bytes))
    same = spark.createDataFrame([(int(i), int(tok.identity[i]), int(counts[i]))
                                  for i in np.flatnonzero(counts)], "a_id long, b_id long, docs long")
    other = other_counts(encoded).select(
        F.expr(f"pair div {n_b}").alias("a_id"), (F.col("pair") % n_b).alias("b_id"), "docs")
    return same.unionByName(other)


def align(documents: DataFrame, a_path: str, b_path: str,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``."""
    tok = Tokenizers(a_path, b_path)
    n_a, n_b = len(tok.a_bytes), len(tok.b_bytes)
    encoded = encode_blocks(documents, a_path, b_path, block_bytes)
    same = identity_counts(encoded, n_a)
    counts = written(other_counts(encoded), "pairs")
    best = np.maximum(same, _vector(counts.groupBy(F.expr(f"pair div {n_b}").alias("at")).agg(
        F.max("docs").alias("value")), n_a))
    used = encoded.where("pairs is not null").select(
        F.col("block").alias("own"), F.posexplode("pairs").alias("at", "pair"))
    told = used.join(counts, "pair").select("own", "at", "docs")
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        whole = pc.is_valid(left["pairs"])
        docs, head = left.filter(pc.invert(whole)), left.filter(whole).to_pylist()
        n_best = count_sum = np.zeros(docs.num_rows, np.int64)
        if head:
            pairs = np.array(head[0]["pairs"], np.int64)
            n = np.zeros(len(pairs), np.int64)
            n[right["at"].to_numpy()] = right["docs"].to_numpy()
            size, entry, times = (np.frombuffer(head[0][c], k).astype(np.int64) for c, k in (
                ("entries", np.int32), ("entry", np.int32), ("times", np.int64)))
            # one row of counts for the block's pairs and the identity pairs
            value = np.r_[n, same]
            top = value == np.r_[best[pairs // n_b], best]
            at = np.where(entry < 0, len(pairs) - 1 - entry, entry)
            cut = _starts(size)
            sums = np.add.reduceat(value[at] * times, cut)
            tops = np.add.reduceat(top[at] * times, cut)
            kinds = [np.frombuffer(x, np.int32) for x in docs["types"].to_pylist()]
            n_best = np.array([tops[k].sum() for k in kinds], np.int64)
            count_sum = np.array([sums[k].sum() for k in kinds], np.int64)
        made = {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
        return pa.table({c: made[c] if c in made else docs[c] for c in names})

    blocks = encoded.where("vector is null").drop("vector", "held")
    return blocks.groupBy("block").cogroup(told.groupBy("own")).applyInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long,"
             " count_sum long, groups_sha256 string")
