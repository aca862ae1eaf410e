"""Quality scores by a factorisation machine over hashed words, structure statistics and
metadata.

A text is a sparse vector of three fields: its distinct words (hashed to ``WORDS``
coordinates, weights 1 + log(count), unit length), statistics of its structure (shares of
letter cases, digits, marks, repeats and lines, lengths; each spread over the two nearest
of ``BINS`` bins) and the metadata column ``n_chars``.  The margin is

    bias + sum w_i x_i + sum over pairs i < j of <v_i, v_j> x_i x_j,

with vectors of ``RANK`` numbers, so that every pair of words, statistics and metadata
interacts.  The pair sum is computed in linear time as half of the sum over the ranks of
(sum v x)^2 - sum (v x)^2.

It is fitted by AdaGrad on at most about ``MAX_TRAIN`` different labelled rows (a documented
bound, chosen by a hash; copies with one label count once).  The rows are turned to
features where they lie and dealt to shards of a few thousand; in each of ``ROUNDS`` rounds
every shard makes one pass from the common model and the results are averaged.  Every text
is scored whole.

Defined cases: null and empty texts have no words and empty statistics, and are scored by
these; a null, absent or unreadable ``n_chars`` is a feature of its own; an id with several
labels counts as low quality if one of them is low; rows without an id are scored and never
learned; without labelled rows every score is 0.5; repeated rows get equal scores; other
columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import written
from partsmith.llm.wordhash import WordHasher, groups, mix

BITS = 16
WORDS = 1 << BITS
BINS = 12
RANK = 8
MAX_TRAIN = 24_000
SHARD_ROWS = 8_000
ROUNDS = 4
RATE, DECAY, INIT = 0.1, 1e-5, 0.05
_SPACE = 1 << 30

_BLANK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True
#: Kinds of bytes: the statistics count characters of each.
KINDS = ["lower", "upper", "digit", "blank", "line", "point", "sign", "beyond", "tail"]
_KIND = np.full(256, KINDS.index("sign"), np.int64)
for _b in range(256):
    _c = chr(_b)
    if _b >= 0xC0:
        _KIND[_b] = KINDS.index("beyond")
    elif _b >= 0x80:
        _KIND[_b] = KINDS.index("tail")  # continues a character
    elif _c.islower():
        _KIND[_b] = KINDS.index("lower")
    elif _c.isupper():
        _KIND[_b] = KINDS.index("upper")
    elif _c.isdigit():
        _KIND[_b] = KINDS.index("digit")
    elif _c in "\n\r":
        _KIND[_b] = KINDS.index("line")
    elif _c in " \t":
        _KIND[_b] = KINDS.index("blank")
    elif _c in ".,;:?!'\"-()":
        _KIND[_b] = KINDS.index("point")
_MARKS = (_KIND == KINDS.index("point")) | (_KIND == KINDS.index("sign"))
STATS = ["upper", "digit", "point", "sign", "line", "blank", "beyond", "twice", "word_length",
         "different_words", "top_word", "different_lines", "line_words", "words", "chars",
         "n_chars", "n_chars_missing", "n_chars_differs"]
DIM = WORDS + len(STATS) * BINS


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _per_text(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of values sorted by row: how many each row has, and its largest."""
    top = np.zeros(n)
    np.maximum.at(top, row, value)
    return np.bincount(row, minlength=n), top


def statistics(data: np.ndarray, ends: np.ndarray, n_chars: np.ndarray, lines: WordHasher,
               n_words: np.ndarray, different: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Statistics (0 to 1) of every text, one column each, in the order of ``STATS``."""
    n = len(ends)
    row = np.repeat(np.arange(n), np.diff(np.r_[0, ends]))
    k = np.bincount(row * len(KINDS) + _KIND[data], minlength=n * len(KINDS)).reshape(n, -1)
    of = dict(zip(KINDS, k.T.astype(float), strict=True))
    chars = k.sum(1) - of["tail"]
    letters = of["lower"] + of["upper"]
    twice = np.zeros(n)
    if len(data) > 1:
        same = (data[1:] == data[:-1]) & _MARKS[data[1:]] & (row[1:] == row[:-1])
        twice = np.bincount(row[1:][same], minlength=n)
    line, n_lines = lines.words(data, ends)
    line_row = np.repeat(np.arange(n), n_lines)
    order = np.lexsort((line, line_row))
    fresh = np.r_[True, (line[order][1:] != line[order][:-1])
                  | (line_row[order][1:] != line_row[order][:-1])][:len(order)]
    distinct_lines = np.bincount(line_row[order][fresh], minlength=n)
    known = np.isfinite(n_chars)
    given = np.where(known, np.maximum(n_chars, 0), 0)
    root, log = np.sqrt, np.log2
    out = {
        "upper": root(_share(of["upper"], letters)), "digit": root(_share(of["digit"], chars)),
        "point": root(_share(of["point"], chars)), "sign": root(_share(of["sign"], chars)),
        "line": root(_share(of["line"], chars)), "blank": root(_share(of["blank"], chars)),
        "beyond": root(_share(of["beyond"], chars)), "twice": root(_share(twice, chars)),
        "word_length": _share(letters + of["digit"] + of["beyond"], n_words) / 16,
        "different_words": _share(different, n_words), "top_word": root(_share(top, n_words)),
        "different_lines": _share(distinct_lines, n_lines),
        "line_words": log(_share(n_words, n_lines) + 1) / 12, "words": log(n_words + 1) / 20,
        "chars": log(chars + 1) / 24, "n_chars": log(given + 1) / 24,
        "n_chars_missing": (~known).astype(float),
        "n_chars_differs": (known & (given != chars)).astype(float),
    }
    return np.clip(np.stack([out[s] for s in STATS], 1), 0.0, 1.0)


def features(texts: pa.Array, n_chars: pa.Array) -> Iterator[tuple[int, int, np.ndarray,
                                                                   np.ndarray, np.ndarray]]:
    """For each group of texts: first row, number of rows, and the row (from 0 in the group, in
    order), coordinate and value of every feature."""
    words, lines = WordHasher(_BLANK), WordHasher(_LINE)
    given = n_chars.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)
    lower = np.arange(256)
    lower[65:91] += 32
    for first, data, ends in groups(texts):
        n = len(ends)
        w, n_words = words.words(data, ends)  # A-Z count as a-z
        row = np.repeat(np.arange(n), n_words)
        key, count = np.unique(row * WORDS + (mix(w) >> np.uint64(64 - BITS)).astype(np.int64),
                               return_counts=True)
        row, place = key // WORDS, key % WORDS
        x = 1.0 + np.log(count)
        different, top = _per_text(row, count, n)
        length = np.sqrt(np.bincount(row, x * x, minlength=n))
        x = x / length[row]
        s = statistics(data, ends, given[first:first + n], lines, n_words, different, top)
        at = s * (BINS - 1)
        low = np.minimum(at.astype(np.int64), BINS - 2)
        part = at - low
        base = WORDS + np.arange(len(STATS)) * BINS
        stat_row = np.repeat(np.arange(n), 2 * len(STATS))
        stat_place = np.stack([base + low, base + low + 1], 2).ravel()
        stat_x = np.stack([1.0 - part, part], 2).ravel() * 0.5
        keep = stat_x > 0
        rows = np.concatenate([row, stat_row[keep]])
        order = np.argsort(rows, kind="stable")
        yield (first, n, rows[order], np.concatenate([place, stat_place[keep]])[order],
               np.concatenate([x, stat_x[keep]])[order])


class Model:
    """``bias``, ``w`` (DIM) and ``v`` (DIM x RANK)."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = float(bias), w, v

    @classmethod
    def start(cls, dim: int = DIM, rank: int = RANK) -> Model:
        v = np.random.default_rng(13).normal(0.0, INIT, (dim, rank))
        return cls(0.0, np.zeros(dim), v)

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, b=self.bias, w=self.w.astype(np.float32), v=self.v.astype(np.float32))
        return out.getvalue()

    @classmethod
    def unpacked(cls, blob: bytes, kind: type = np.float32) -> Model:
        m = np.load(io.BytesIO(blob))
        return cls(m["b"], m["w"].astype(kind), m["v"].astype(kind))

    def margins(self, n: int, row: np.ndarray, place: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Margins of ``n`` texts by the sum-of-squares identity."""
        out = self.bias + np.bincount(row, x * self.w[place], minlength=n)
        for f in range(self.v.shape[1]):
            vx = self.v[place, f] * x
            out += 0.5 * (np.bincount(row, vx, minlength=n) ** 2
                          - np.bincount(row, vx * vx, minlength=n))
        return out


def one_pass(model: Model, sets: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
             seed: int, rate: float = RATE, decay: float = DECAY) -> Model:
    """One AdaGrad pass of logistic loss over ``sets`` of (coordinates, values)."""
    b, w, v = model.bias, model.w.astype(float), model.v.astype(float)
    hb, hw, hv = 1.0, np.ones(w.shape), np.ones(v.shape)
    for i in np.random.default_rng(seed).permutation(len(sets)):
        at, x = sets[i]
        wi, vi = w[at], v[at]
        s = x @ vi
        m = b + x @ wi + 0.5 * (s @ s - ((x[:, None] * vi) ** 2).sum())
        g = 1.0 / (1.0 + np.exp(-np.clip(m, -30, 30))) - labels[i]
        gw = g * x + decay * wi
        gv = g * (x[:, None] * s - (x * x)[:, None] * vi) + decay * vi
        hb += g * g
        b -= rate * g / np.sqrt(hb)
        hw[at] += gw * gw
        hv[at] += gv * gv
        w[at] = wi - rate * gw / np.sqrt(hw[at])
        v[at] = vi - rate * gv / np.sqrt(hv[at])
    return Model(b, w, v)


def _n_chars(documents: DataFrame) -> Column:
    """The metadata column as a number, null where it is absent or unreadable."""
    if "n_chars" not in documents.columns:
        return F.lit(None).cast("double")
    return F.col("n_chars").cast("string").try_cast("double")


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def _sample(documents: DataFrame, labels: DataFrame, learn: Column, bound: int) -> DataFrame:
    """Features of about ``bound`` different labelled rows: ``key, y, at, x``."""
    marks = (labels.where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("y")))
    rows = documents.where(learn).select(
        "doc_id", "text", _n_chars(documents).alias("n_chars")).withColumn(
        "key", F.xxhash64("text", "n_chars"))
    # counted without texts; then only the texts of the sample are read and moved
    n = rows.select("doc_id", "key").join(marks, "doc_id").select("key", "y").distinct().count()
    if n > bound:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(29), "key"), F.lit(_SPACE))
                          < int(_SPACE * bound / n))

    def run(batches):
        for batch in batches:
            at_, x_ = [], []
            for _, k, row, place, x in features(batch.column(2), batch.column(3)):
                cut = np.searchsorted(row, np.arange(1, k))
                at_ += np.split(place.astype(np.int32), cut)
                x_ += np.split(x.astype(np.float32), cut)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(at_, pa.list_(pa.int32())),
                 pa.array(x_, pa.list_(pa.float32()))], ["key", "y", "at", "x"])

    made = rows.join(marks, "doc_id").select("key", "y", "text", "n_chars").mapInArrow(
        run, "key long, y int, at array<int>, x array<float>")
    return written(made.groupBy("key", "y").agg(F.first("at").alias("at"),
                                                F.first("x").alias("x")), "quality")


def _shard_pass(blob: bytes, turn: int):
    """A pass over the rows of one shard from a packed model."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "y"], kind="stable")
        sets = [(a.astype(np.int64), x.astype(float))
                for a, x in zip(frame["at"], frame["x"], strict=True)]
        m = one_pass(Model.unpacked(blob, float), sets, frame["y"].to_numpy(float), turn)
        return pd.DataFrame({"n": [len(frame)], "model": [m.packed()]})

    return run


def fit(documents: DataFrame, labels: DataFrame, learn: Column,
        max_train: int = MAX_TRAIN) -> Model:
    """Model learned from the labelled rows of ``documents`` where ``learn`` holds."""
    sample = _sample(documents, labels, learn, max_train)
    shards = max(1, -(-min(sample.count(), max_train) // SHARD_ROWS))
    dealt = sample.withColumn("shard", F.pmod(F.xxhash64(F.lit(23), "key"), F.lit(shards)))
    model = Model.start()
    for turn in range(ROUNDS):
        # as many models as shards: at most about MAX_TRAIN / SHARD_ROWS
        got = dealt.groupBy("shard").applyInPandas(_shard_pass(model.packed(), turn),
                                                   "n long, model binary").collect()
        if not got:
            break
        total = sum(r["n"] for r in got)
        parts = [(r["n"] / total, Model.unpacked(r["model"], float)) for r in
                 sorted(got, key=lambda r: bytes(r["model"]))]
        model = Model(sum(p * m.bias for p, m in parts), sum(p * m.w for p, m in parts),
                      sum(p * m.v for p, m in parts))
    else:
        return model
    return Model(0.0, np.zeros(DIM), np.zeros((DIM, RANK)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row, from the whole text."""
    blob = model.packed()
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = Model.unpacked(blob)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, n, row, place, x in features(batch.column(1), batch.column(2)):
                out[first:first + n] = m.margins(n, row, place, x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_probability(out))],
                                             ["doc_id", "score"])

    return documents.select("doc_id", "text", _n_chars(documents).alias("n_chars")).mapInArrow(
        run, f"doc_id {kind}, score double")


def quality(documents: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1,
            max_train: int = MAX_TRAIN) -> DataFrame:
    """Per document row: ``doc_id, held_out, score, predicted``.  Rows whose crc32 of the id
    leaves ``fold`` are held out: their labels are not learned."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))
    model = fit(documents, labels, F.col("doc_id").isNotNull() & ~held, max_train)
    return score(documents, model).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
