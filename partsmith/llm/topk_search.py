"""Exact top-k vector search by exhaustive term-at-a-time accumulation.

A vector is turned into whole-number weights ``floor(scale * x)``; its dimensions are
the terms.  Candidates are dealt into blocks of at most ``BLOCK`` vectors; a block's
posting list of a term holds the places and weights of the vectors that are not zero
there.  Query rows are cut into blocks of ``QUERIES`` as well.  For a pair of blocks
every term of the queries is taken in turn, and the product of the query weights with
its posting list is scattered into a dense array of scores (from a sixteenth of all
places on, as whole rows, zeros included).  The best ``k`` of each query are
then chosen by partition (no full sort) and merged with those of the blocks before in
the task; the tasks' choices are merged per query.

The query set is stated by the caller and meets all rows in blocks.  Packed blocks of
candidates are dealt to shards, packed blocks of queries are written once and dealt to
groups of at most ``GROUP_BYTES``; a task holds one group and takes the blocks of a shard
in turn.  Shards times groups are about ``spark.sql.shuffle.partitions``.  Neither side is
stored in copies or broadcast, whatever the thresholds: the planner's estimates don't see
what packing and copying make of a side.

Defined cases: vectors that are null or hold null or non-finite components take no
part, nor do rows without an id; a vector of fewer components counts as 0 in the rest;
equal scores go to the smaller id; every row that repeats an id is a candidate of its
own, except for queries with that id; repeated equal queries are one query.  Scores
beyond the range of a long are set to its bounds.  Queries without candidates have no
rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsmith.llm.common import written

BLOCK = 4096
QUERIES = 512
#: Packed queries of a group, with the choices that a task holds for them.
GROUP_BYTES = 32 << 20
#: Scores that are accumulated together, to stay in a core's cache.
TILE = 1 << 17
_LONG = (-(1 << 63), (1 << 63) - 1)


def usable(vec: Column) -> Column:
    """Vectors that take part: not null, every component present and finite."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _weights(values: np.ndarray, lengths: np.ndarray, scale: int) -> np.ndarray:
    """Whole-number weights, one row per vector, in the smallest integer type that holds
    them; float64 if they are too large for a long."""
    width = int(lengths.max(initial=0))
    x = np.zeros((len(lengths), width))
    x[np.arange(width) < lengths[:, None]] = values
    with np.errstate(over="ignore"):  # beyond a double: infinite
        x = np.floor(x * float(scale))
    top = np.abs(x).max(initial=0)
    if top >= 2.0 ** 62:
        return x
    return x.astype(next(t for t in ("i1", "i2", "i4", "i8") if top <= np.iinfo(t).max))


def _pack(keys: np.ndarray, weights: np.ndarray) -> tuple[bytes, bytes, str]:
    """A block with ascending ids (the first key): keys row by row, weights term by term."""
    order = np.argsort(keys[:, 0], kind="stable")
    return keys[order].tobytes(), weights[order].T.tobytes(), weights.dtype.str


def _unpack(keys, weights, kind: str, n_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (a row per vector) and weights (a row per term); Python ints if too large."""
    k = np.frombuffer(keys, np.int64).reshape(-1, n_keys)
    w = np.frombuffer(weights, kind).reshape(-1, len(k))
    if w.dtype.kind == "f":
        w = np.array([int(c) if np.isfinite(c) else int(np.sign(c)) << 1024
                      for c in w.ravel().tolist()], dtype=object).reshape(w.shape)
    return k, w


def scores(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Dense scores (queries x block) of weights by term, accumulated term by term."""
    terms = min(len(queries), len(block))
    q, b = queries[:terms], block[:terms]
    kind: type = object
    if q.dtype != object and b.dtype != object:
        top = (int(np.abs(q).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(terms, 1))
        kind = np.int32 if top < 1 << 31 else np.int64 if top < 1 << 62 else object
    q, b = q.astype(kind), b.astype(kind)
    n = b.shape[1]
    out = np.zeros((q.shape[1], n), kind)
    full = []
    for t in range(terms):
        rows, posting = np.flatnonzero(q[t]), np.flatnonzero(b[t])
        if not len(rows) or not len(posting):
            continue
        if len(rows) * len(posting) * 16 >= out.size:
            full.append(t)
        else:
            out[np.ix_(rows, posting)] += q[t, rows, None] * b[None, t, posting]
    step = max(1, TILE // max(n, 1))
    product = np.empty((step, n), kind)
    for at in range(0, len(out), step):
        tile = out[at:at + step]
        for t in full:
            np.multiply(q[t, at:at + step, None], b[None, t], out=product[:len(tile)])
            tile += product[:len(tile)]
    return out


def choose(score: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int,
           least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query rows, ids, scores as longs), unordered, that hold the best ``k`` per row, an
    equal score's smaller id first; ``ids`` ascend.  Scores below the row's ``least`` may be
    left out."""
    if score.dtype == object:
        score = np.array([min(max(int(x), _LONG[0]), _LONG[1]) for x in score.ravel()],
                         dtype=np.int64).reshape(score.shape)
    n, kind = len(ids), np.iinfo(score.dtype)
    if least is None:
        least = np.full(len(score), _LONG[0])
    taken = score >= np.clip(least, kind.min, kind.max).astype(score.dtype)[:, None]
    # so many that k are left without those of the row's own id
    need = k + np.searchsorted(ids, own, "right") - np.searchsorted(ids, own, "left")
    for i in np.flatnonzero(np.count_nonzero(taken, axis=1) > 4 * need):
        s, m = score[i], int(need[i])
        bound = np.partition(s, n - m)[n - m]
        above = np.flatnonzero(s > bound)
        taken[i] = False
        taken[i, above] = True
        taken[i, np.flatnonzero(s == bound)[:m - len(above)]] = True
    rows, places = np.divmod(np.flatnonzero(taken), max(n, 1))
    other = ids[places] != own[rows]
    rows, places = rows[other], places[other]
    return rows, ids[places], score[rows, places].astype(np.int64)


class _Best:
    """The best ``k`` of each query of a block over the candidates so far."""

    def __init__(self, own: np.ndarray, k: int):
        self.own, self.k = own, k
        self.rows = self.ids = self.scores = np.empty(0, np.int64)
        self.least = np.full(len(own), _LONG[0])

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        got = choose(score, ids, self.own, self.k, self.least)
        if not len(got[0]):
            return
        rows, ids, sc = (np.concatenate(x) for x in
                         zip((self.rows, self.ids, self.scores), got, strict=True))
        order = np.lexsort((ids, ~sc, rows))  # ~: descending, and no overflow
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = order[rank < self.k]
        last = rank == self.k - 1
        self.least[rows[last]] = sc[order[last]]
        self.rows, self.ids, self.scores = rows[rank < self.k], ids[kept], sc[kept]


def _blocks(vectors: DataFrame, keys: list[str], size: int, scale: int) -> DataFrame:
    """Packed blocks of at most ``size`` vectors ``v``: ``keys, weights, kind``."""
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                own = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
                lists = batch.column("v")
                lengths = lists.value_lengths().to_numpy().astype(np.int64)
                packed = _pack(own, _weights(lists.flatten().to_numpy(), lengths, scale))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in packed],
                                                 ["keys", "weights", "kind"])

    return vectors.select(*keys, "v").mapInArrow(run, "keys binary, weights binary, kind string")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for every query row of ``vectors``."""
    import pyarrow as pa

    took = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
    rows = took.select(F.col(id_col).cast("long").alias("id"),
                       F.col(vec_col).cast("array<double>").alias("v"))
    asked = (took.where(is_query)
             .select(F.col(id_col).cast("long").alias("id"),
                     F.col(vec_col).cast("array<double>").alias("v")).distinct()
             .withColumn("tag", F.xxhash64("v")))
    c = _blocks(rows, ["id"], BLOCK, scale)
    q = written(_blocks(asked, ["id", "tag"], QUERIES, scale)
                .select([F.col(x).alias(f"q_{x}") for x in ("keys", "weights", "kind")]),
                "topk-queries")

    def run(batches):
        best: dict[bytes, _Best] = {}
        for batch in batches:
            col = {x: batch.column(x) for x in batch.schema.names}
            for i in range(batch.num_rows):
                own, queries = _unpack(col["q_keys"][i].as_buffer(), col["q_weights"][i].as_buffer(),
                                       col["q_kind"][i].as_py(), 2)
                ids, block = _unpack(col["keys"][i].as_buffer(), col["weights"][i].as_buffer(),
                                     col["kind"][i].as_py(), 1)
                name = own.tobytes()
                if name not in best:
                    best[name] = _Best(own[:, 0].copy(), k)
                best[name].add(scores(queries, block), ids[:, 0])
        for name, b in best.items():
            own = np.frombuffer(name, np.int64).reshape(-1, 2)[b.rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (own[:, 0], own[:, 1], b.ids, b.scores)],
                ["query_id", "tag", "vec_id", "score"])

    # every block of rows is in one shard, every block of queries in one group
    # (a task holds 24 bytes for each of a query's k choices; its keys have 16)
    n_blocks, n_bytes = q.agg(F.count(F.lit(1)), F.coalesce(F.sum(
        F.length("q_weights") + F.length("q_keys") * F.lit(1 + 1.5 * k)), F.lit(0.0))).first()
    groups = max(1, min(n_blocks, math.ceil(n_bytes / GROUP_BYTES)))
    shards = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (c.repartition(max(1, -(-shards // groups)))
             .crossJoin(q.repartition(groups).hint("shuffle_replicate_nl")))
    best = pairs.mapInArrow(run, "query_id long, tag long, vec_id long, score long")
    w = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
