"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and
skip-grams.

A text is the set of its words, word pairs and pairs with one word between them, each
hashed to ``DIM`` coordinates and present or not.  FTRL-proximal keeps a learning rate
per coordinate and sets weights of little evidence to zero (L1), so the model is a short
list of coordinates and weights that travels with the scoring job.

It is fitted on a sample of at most about ``MAX_TRAIN`` labelled texts (a documented bound;
copies with one label count once), in shards of a few thousand, whose weights are averaged.
Every text is scored whole.

Defined cases: null and empty texts have no features and get the score of the bias;
repeated label rows of an id count as toxic if one of them is; rows without an id are
scored and never learned; without any labelled row the score is 0; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import written
from partsmith.llm.sampling import sum_shards, text_sample
from partsmith.llm.wordhash import WordHasher, groups, mix

BITS = 20
DIM = 1 << BITS
MAX_TRAIN = 24_000
SHARD_ROWS = 8_000
#: Texts lower-cased together.
SLICE_ROWS = 500
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.0

#: Words are runs of ASCII letters and digits and of all other characters beyond ASCII.
_BLANK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_PAIR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _place(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: pa.Array, hasher: WordHasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each group of texts: first row, number of rows, and the row (from 0 in the group)
    and coordinate of every feature, with repeats."""
    for at in range(0, len(texts), SLICE_ROWS):
        part = pc.utf8_lower(texts.slice(at, SLICE_ROWS).fill_null(""))
        for first, data, ends in groups(part):
            w, counts = hasher.words(data, ends)
            row = np.repeat(np.arange(len(ends)), counts)
            rows, places = [row], [_place(w)]
            for gap, a, b in ((1, 1, 2), (2, 2, 1)):
                same = row[:-gap] == row[gap:]
                rows.append(row[:-gap][same])
                places.append(_place(
                    (w[:-gap] * _PAIR[a] + w[gap:] * _PAIR[b] + np.uint64(gap))[same]))
            yield at + first, len(ends), np.concatenate(rows), np.concatenate(places)


def feature_sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct coordinates of every text."""
    out = []
    for _, n, row, place in features(texts, WordHasher(_BLANK)):
        key = np.unique(row * DIM + place)
        out += np.split((key % DIM).astype(np.int32), np.searchsorted(key // DIM, np.arange(1, n)))
    return out


def ftrl(sets: list[np.ndarray], labels: np.ndarray, dim: int = DIM, epochs: int = EPOCHS,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights (the last one is the bias) of FTRL-proximal over sets of coordinates."""
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)
    sets = [np.append(x, x.dtype.type(dim)) for x in sets]

    def weights(zi, ni, bias_at):
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2)
        w[np.abs(zi) <= l1] = 0.0
        if bias_at is not None:  # the bias has no penalty
            w[bias_at] = -zi[bias_at] * alpha / (beta + np.sqrt(ni[bias_at]))
        return w

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(sets)):
            x = sets[i]
            zi, ni = z[x], n[x]
            w = weights(zi, ni, -1)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -30, 30)))
            g = p - labels[i]
            z[x] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[x] = ni + g * g
    return weights(z, n, -1)


def fit(documents: DataFrame, labels: DataFrame, learn: Column,
        max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights learned from the labelled rows of ``documents`` where ``learn`` holds."""
    marks = (labels.where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__y")))
    rows = (documents.where(learn & F.col("text").isNotNull())
            .select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
            .join(marks, "doc_id").select("text", "text_hash", "__y"))
    rows = written(text_sample(rows, max_train), "labelled")  # counted and fitted from there
    shards = max(1, -(-min(rows.count(), max_train) // SHARD_ROWS))

    def one(frame: pd.DataFrame) -> dict[str, np.ndarray]:
        frame = frame.sort_values(["text", "__y"], kind="stable")
        return {"w": ftrl(feature_sets(pa.array(frame["text"], pa.string())),
                          frame["__y"].to_numpy(float))}

    total = sum_shards(rows, shards, one)
    return total["w"] / total["shards"][0] if total else np.zeros(DIM + 1)


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every row, from the whole text."""
    at = np.flatnonzero(weights).astype(np.int32)
    value = weights[at].astype(np.float32)
    empty = not len(at)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hasher, w = WordHasher(_BLANK), np.zeros(DIM + 1, np.float32)
        w[at] = value
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for first, n, row, place in features(batch.column(1), hasher):
                hit = np.flatnonzero(w[place])
                key = np.unique(row[hit] * DIM + place[hit])
                total[first:first + n] = np.bincount(key // DIM, w[key % DIM], minlength=n)
            p = 1.0 / (1.0 + np.exp(-np.clip(total + w[DIM], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.zeros(len(p)) if empty else p)], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5,
             max_train: int = MAX_TRAIN) -> DataFrame:
    """Per document row: ``doc_id, held_out, score, predicted``.  Rows whose crc32 of the id
    is divisible by ``folds`` are held out: their labels are not learned."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    weights = fit(documents, labels, F.col("doc_id").isNotNull() & ~held, max_train)
    return score(documents, weights).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
