"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; one binary classifier per bit tells, from the
character 1- to 3-grams of a text, on which side of that bit its language stands.  All
bits are logistic regressions over the same hashed n-gram weights (root counts, unit
length), fitted together with AdaGrad.  A text is decoded to the language with the least
sum of logistic losses between its codeword and the bits' margins, each bit weighted by
how often it is right for that language in training.  The score is the softmax of the
negative losses; a text whose two best languages are closer than ``MARGIN`` is ambiguous.

The classifiers are fitted on a sample of at most about ``MAX_PER_LANG`` different texts
of each language (a documented bound); every text is predicted whole.

Defined cases: null texts and texts without a letter are "und" with score 0 and not
ambiguous; without any learned language every text is "und"; with one, every other text
gets it; rows with a null or empty text, lang or id are not learned; repeated rows get
equal results; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import written
from partsmith.llm.sampling import sum_shards, text_sample

BITS = 15
DIM = 1 << BITS
MAX_PER_LANG = 3_000
SHARD_ROWS = 1_500
EPOCHS = 3
RATE = 0.5
MARGIN = 0.02
#: Code points counted at a time; the counts of a longer text are added up.
SLICE = 1 << 16

_LETTER = regex.compile(r"\p{L}")
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
UNKNOWN = "und"


def codewords(k: int) -> np.ndarray:
    """Codewords (k x bits of +1, -1) whose least distance is the best of fixed random
    tries; no bit is the same for all languages."""
    if k == 1:
        return np.ones((1, 1), np.int8)
    bits = max(7, 5 * int(np.ceil(np.log2(k))))
    rng, best, far = np.random.default_rng(5), None, -1
    for _ in range(300 if k <= 64 else 10):
        code = rng.integers(0, 2, (k, bits)).astype(np.int8) * 2 - 1
        if (np.abs(code.sum(0, dtype=int)) == k).any():
            continue
        gap = (bits - code.astype(int) @ code.T.astype(int)) // 2
        least = int(gap[~np.eye(k, dtype=bool)].min())
        if least > far:
            best, far = code, least
    if best is None or far == 0:  # the number of each language in binary, and its complement
        binary = (np.arange(k)[:, None] >> np.arange(int(np.ceil(np.log2(k))))) & 1
        best = np.hstack([binary, 1 - binary]).astype(np.int8) * 2 - 1
    return best


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and unit-length weights of a text's character 1- to 3-grams."""
    # every run of other characters is one blank, so punctuation and digits don't count
    clean = " " + " ".join(_RUNS.findall(text.lower())) + " "
    c = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros(DIM, np.int64)
    for at in range(0, max(len(c) - 2, 1), SLICE):
        s = c[at:at + SLICE + 2]
        body = s[:SLICE]
        for g in (body * _MULT[0],
                  s[:-1][:SLICE] * _MULT[1] + s[1:][:SLICE] * _MULT[0] + np.uint32(1),
                  s[:-2] * _MULT[2] + s[1:-1] * _MULT[1] + s[2:] * _MULT[0] + np.uint32(2)):
            g = (g ^ (g >> np.uint32(15))) * _MULT[2]
            counts += np.bincount(g >> np.uint32(32 - BITS), minlength=DIM)
    idx = np.flatnonzero(counts)
    x = np.sqrt(counts[idx])
    return idx, x / np.sqrt((x * x).sum())


_RUNS = regex.compile(r"[\p{L}\p{M}]+")


def train(texts: list[str], codes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Weights (DIM + 1 rows, the last is the bias; one column per bit)."""
    bits = codes.shape[1]
    w, h = np.zeros((DIM + 1, bits)), np.full((DIM + 1, bits), 1e-3)
    made = [features(t) for t in texts]
    rng = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(made)):
            idx, x = made[i]
            idx, x = np.append(idx, DIM), np.append(x, 0.1)
            y = codes[which[i]]
            m = x @ w[idx]
            g = x[:, None] * (-y / (1.0 + np.exp(np.clip(y * m, -30, 30))))
            hi = h[idx] + g * g
            h[idx] = hi
            w[idx] -= RATE * g / np.sqrt(hi)
    return w


def _margins(idx: np.ndarray, x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[idx] + 0.1 * w[DIM]


class Model:
    """Languages, their codewords, bit weights per language and the classifiers."""

    def __init__(self, langs: list[str], codes: np.ndarray, trust: np.ndarray, w: np.ndarray):
        self.langs, self.codes, self.trust = langs, codes.astype(np.float64), trust
        self.w = w.astype(np.float32)

    def decode(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous)."""
        if not self.langs or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        m = _margins(*features(text), self.w)
        loss = (self.trust * np.logaddexp(0.0, -self.codes * m[None, :])).sum(1)
        order = np.argsort(loss, kind="stable")
        p = np.exp(-(loss - loss[order[0]]) * self.codes.shape[1])
        p /= p.sum()
        best, second = order[0], order[1]
        return self.langs[best], float(p[best]), bool(p[best] - p[second] < MARGIN)


def fit(documents: DataFrame, learn: Column, max_per_lang: int = MAX_PER_LANG) -> Model:
    """Fit on the rows of ``documents (text, lang)`` where ``learn`` holds."""
    rows = documents.where(learn & F.col("lang").isNotNull() & (F.col("text") != "")).select(
        "text", F.xxhash64("text").alias("text_hash"), F.col("lang").cast("string").alias("lang"))
    rows = written(text_sample(rows, max_per_lang, "lang"), "labelled")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if len(langs) < 2:
        return Model(langs, np.ones((len(langs), 1)), np.ones((len(langs), 1)), np.zeros((1, 1)))
    codes, place = codewords(len(langs)), {v: i for i, v in enumerate(langs)}

    def one(frame: pd.DataFrame) -> dict[str, np.ndarray]:
        frame = frame[[bool(_LETTER.search(t)) for t in frame["text"]]]
        frame = frame.sort_values(["text", "lang"], kind="stable")
        texts = frame["text"].tolist()
        which = np.array([place[v] for v in frame["lang"]], int)
        w = train(texts, codes, which)
        right, seen = np.ones(codes.shape), np.full((len(langs), 1), 2.0)
        for t, k in zip(texts, which, strict=True):
            right[k] += (_margins(*features(t), w) * codes[k]) > 0
            seen[k] += 1
        return {"w": w.astype(np.float32), "right": right, "seen": seen}

    shards = max(1, -(-sum(sizes.values()) // SHARD_ROWS))
    total = sum_shards(rows, shards, one)
    w = (total["w"] / total["shards"][0]).reshape(DIM + 1, -1)
    trust = total["right"].reshape(codes.shape) / total["seen"][:, None]
    return Model(langs, codes, trust / trust.sum(1, keepdims=True), w)


def identify(documents: DataFrame, folds: int = 4, fold: int = 2,
             max_per_lang: int = MAX_PER_LANG, model: Model | None = None) -> DataFrame:
    """Per document row: ``doc_id, held_out, lang_pred, score, ambiguous``.  Rows whose crc32
    of the id leaves ``fold`` are held out: their lang is not learned."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))
    model = model or fit(documents, F.col("doc_id").isNotNull() & ~held, max_per_lang)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            got = [model.decode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())],
                ["doc_id", "lang_pred", "score", "ambiguous"])

    out = documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")
