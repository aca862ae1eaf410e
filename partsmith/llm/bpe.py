"""BPE encoding and decoding with batched numpy merge rounds.

``Bpe`` loads a vocabulary file (its path is a parameter) with merges and a word-end
suffix.  Texts are normalised (NFC, white space to one space, lower case), cut by
the pretokenizer's pattern and mapped to byte symbols.  The words of a batch that
were not seen before are encoded together: their symbols stand in one flat array, each
round looks up every adjacent pair by binary search over the sorted pair keys, takes
the lowest rank of each word and merges all its occurrences from the left.  A word
leaves the array when none of its pairs can merge.

Spark partitions the rows; each Python worker keeps a memo of chunks between white
space, which is emptied when it has more than ``MEMO_CHUNKS`` entries.

Defined cases: null and empty texts have no tokens and decode to ""; special token
strings inside a text become their special ids, as the tokenizers library does.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MEMO_CHUNKS = 200_000
#: Longest chunk (in characters) that is put into the memo.
MEMO_CHARS = 48
#: Symbols encoded together in one flat array, unless one word is longer.
BATCH_SYMBOLS = 1 << 17

#: Fixed by the vocabulary file's format: white space and word pattern.
_SPACE = regex.compile(r"[\t-\r\x85\p{Z}]+")
_CONTROL = regex.compile(r"[\x1c-\x1f]")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r\x85\p{Z}\p{L}\p{N}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on, in order."""
    printable = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        n = max([*self.vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * n
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.names = [str(i) for i in range(n)]
        self.size = n
        left, right, out = [], [], []
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left.append(self.vocab[a])
            right.append(self.vocab[b])
            out.append(self.vocab[a + b])
        keys = np.array(left, np.int64) * n + np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array(out, np.int64)
        symbols = byte_symbols()
        self.byte_ids = np.array([self.vocab[s] for s in symbols], np.int64)
        self.last_ids = np.array([self.vocab[s + self.suffix] for s in symbols], np.int64)
        self._special = (regex.compile("|".join(regex.escape(s) for s in sorted(
            self.special, key=len, reverse=True))) if self.special else None)
        self.memo: dict[str, tuple[str, str, int]] = {}

    # -- merge rounds --------------------------------------------------------------
    def merge_words(self, batch: list[bytes]) -> tuple[list[int], list[int]]:
        """Token ids of (non-empty) words, all merged in common rounds, one after the other, and
        where each word's ids end."""
        lengths = np.array([len(w) for w in batch], np.int64)
        flat = np.frombuffer(b"".join(batch), np.uint8)
        symbols = self.byte_ids[flat]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.last_ids[flat[ends - 1]]
        owner = np.repeat(np.arange(len(batch)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        never = np.iinfo(np.int64).max
        while len(symbols):
            pair = np.full(len(symbols), never)
            if len(symbols) > 1:
                keys = symbols[:-1] * self.size + symbols[1:]
                at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
                hit = (self.keys[at] == keys) & (owner[:-1] == owner[1:])
                pair[:-1][hit] = self.ranks[at[hit]]
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(owner)])
            lowest = np.minimum.reduceat(pair, first)
            best = np.repeat(lowest, size)
            over = best == never
            if over.any():
                done.append((owner[over], symbols[over]))
            merge = (pair == best) & ~over
            # of overlapping occurrences (a a a) every second one counts, from the left
            idx = np.flatnonzero(merge)
            if len(idx):
                run = np.r_[True, np.diff(idx) != 1]
                start = np.maximum.accumulate(np.where(run, np.arange(len(idx)), 0))
                idx = idx[(np.arange(len(idx)) - start) % 2 == 0]
                symbols[idx] = self.merged[pair[idx]]
            keep = ~over
            keep[idx + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        who = np.concatenate([o for o, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(who, kind="stable")
        return (ids[order].tolist(),
                np.cumsum(np.bincount(who, minlength=len(batch))).tolist())

    def _merge_all(self, words: list[str]) -> dict[str, tuple[str, str, int]]:
        """(ids joined by spaces, tokens joined by spaces, number of ids) of every word."""
        out: dict[str, tuple[str, str, int]] = {}
        group: list[bytes] = []
        begin, symbols = 0, 0
        for k, word in enumerate(words):
            group.append(word.encode())
            symbols += len(group[-1])
            if symbols >= BATCH_SYMBOLS or k + 1 == len(words):
                ids, ends = self.merge_words(group)
                names, tokens = [self.names[i] for i in ids], [self.tokens[i] for i in ids]
                a = 0
                for w, b in zip(words[begin:k + 1], ends, strict=True):
                    out[w] = (" ".join(names[a:b]), " ".join(tokens[a:b]), b - a)
                    a = b
                group, begin, symbols = [], k + 1, 0
        return out

    def _learn(self, chunks: list[str], into: dict[str, tuple[str, str, int]]) -> None:
        """Encode chunks of text without white space; the pattern never reaches over one."""
        cut = [_WORD.findall(c) for c in chunks]
        words = self._merge_all(list({w for ws in cut for w in ws}))
        for c, ws in zip(chunks, cut, strict=True):
            if len(ws) == 1:
                into[c] = words[ws[0]]
            else:
                got = [words[w] for w in ws]
                into[c] = (" ".join([g[0] for g in got]), " ".join([g[1] for g in got]),
                           sum(g[2] for g in got))

    # -- texts ---------------------------------------------------------------------
    def _pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """Special tokens and the texts between them."""
        if self._special is None or not any(s in text for s in self.special):
            yield False, text
            return
        at = 0
        for m in self._special.finditer(text):
            yield False, text[at:m.start()]
            yield True, m[0]
            at = m.end()
        yield False, text[at:]

    def _chunks(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # final sigma has a context rule in str.lower(); the vocabulary's normalizer
        # lower-cases each character on its own
        if "Σ" in text:
            text = text.replace("Σ", "σ")
        text = text.lower()
        if _CONTROL.search(text):  # split() cuts at these, the pattern doesn't
            return _SPACE.sub(" ", text).strip(" ").split(" ")
        return text.split()

    def encode_batch(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """(number of ids, ids joined by spaces, decoded text) of every text."""
        cut = [[(special, [p] if special else self._chunks(p))
                for special, p in self._pieces(t or "")] for t in texts]
        if len(self.memo) > MEMO_CHUNKS:
            self.memo.clear()
        known, once = self.memo, {}
        fresh = list({c for pieces in cut for special, cs in pieces if not special
                      for c in cs if c not in known})
        self._learn([c for c in fresh if len(c) <= MEMO_CHARS], known)
        self._learn([c for c in fresh if len(c) > MEMO_CHARS], once)
        out = []
        for pieces in cut:
            got = []
            for special, cs in pieces:
                if special:
                    got.append((str(self.special[cs[0]]), cs[0], 1))
                else:
                    got += [known[c] if c in known else once[c] for c in cs]
            ids = [g[0] for g in got if g[2]]
            out.append((sum([g[2] for g in got]), " ".join(ids),
                        " ".join([g[1] for g in got if g[2]])))
        return out

    def encode(self, text: str | None) -> list[int]:
        return [int(x) for x in self.encode_batch([text])[0][1].split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, special ones included; unknown ids are skipped."""
        return " ".join(self.tokens[i] for i in ids if 0 <= i < self.size)


#: Texts encoded together, and the characters after which a group ends.
GROUP_TEXTS, GROUP_CHARS = 256, 1_500_000


def _groups(texts: pa.Array) -> Iterator[list[str | None]]:
    group: list[str | None] = []
    chars = 0
    for x in texts:
        t = x.as_py()
        group.append(t)
        chars += len(t or "")
        if len(group) >= GROUP_TEXTS or chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def encode_documents(documents: DataFrame, vocabulary: str, digest: bool = True) -> DataFrame:
    """Encode and decode ``text`` of every row: ``doc_id, n_tokens`` and either the
    sha256 digests ``ids_sha256, decoded_sha256`` or (``digest=False``) the lists
    themselves as ``ids`` (array<int>) and ``decoded`` (string).

    ``vocabulary`` is the file's path on every node (the package that holds it is
    installed there)."""
    docs = documents.select("doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bpe = Bpe(vocabulary)
        for batch in batches:
            ids_of = batch.column(0)
            at = 0
            for group in _groups(batch.column(1)):
                got = bpe.encode_batch(group)
                own = ids_of.slice(at, len(group))
                at += len(group)
                n = pa.array([g[0] for g in got], pa.int64())
                if digest:
                    sha = [pa.array([hashlib.sha256(g[k].encode()).hexdigest() for g in got])
                           for k in (1, 2)]
                    yield pa.RecordBatch.from_arrays(
                        [own, n, *sha], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    lists = pa.array([[int(x) for x in g[1].split()] for g in got],
                                     pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [own, n, lists, pa.array([g[2] for g in got])],
                        ["doc_id", "n_tokens", "ids", "decoded"])

    tail = ("ids_sha256 string, decoded_sha256 string" if digest
            else "ids array<int>, decoded string")
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens long, {tail}")
