"""Similarity join of documents on word shingles, by set size.

A document is the set of its distinct 5-word shingles (64-bit hashes; with fewer words,
the whole sequence is one).  Two documents are linked when their Jaccard similarity is
at least 0.8.  Rows with equal sets are one class, named by the hash of its sorted
shingles, so copies never meet each other.

*Light* sets (at most ``boundary`` shingles) enumerate subsets of fixed size: two sets
of sizes n and m are linked if and only if they share ``overlap(n, m)`` shingles, so
each emits, for every size m it can be linked with, all its subsets of that size.  All
classes of a common subset are linked, through the smallest of them.

*Heavy* sets scan inverted lists.  The shingles have one global order, rarest first,
by a fixed-size count sketch over all documents (any order is correct; this one keeps
frequent passages out of the lists).  Linked sets share one of their first
``n - ceil(0.8 n) + 1`` shingles, so only these are listed.  Light sets that can be
linked with heavy ones are listed too.  A list first proposes its smallest class to
each other one (a star, as many pairs as the list has entries); proposals within the
length and positional bounds are verified on the whole texts and contracted.  Lists whose
classes are then in one component are finished.  In the others, the entries outside the
list's largest component are first compared with about ``TRIES`` members of it, other ones
in each list; of what is still open, every pair from different components within the
bounds is verified.  So all links between different components are found, while a large
group of near copies costs a few pairs per member and list.

For that last pass the bounds are part of the dealing.  From its size and its position in
the list an entry tells the sizes of the partners that could still reach the overlap.  The
entries outside the list's largest component seek partners in the bands of such sizes that
their list has; every entry stands in the band of its own size.  So entries of a long list
of which none can reach the overlap meet nobody.  What is still a large group is cut on both
sides into blocks of about ``MEET`` entries, each pair of blocks a group of its own.

The boundary is the size up to which the subsets are cheaper than listing the set and
verifying the expected partners, from the sketch's estimate of the mean list length.

A list that the sketch takes for long is split into parts by class, each with a star of its
own; the stars' centres meet the smallest class of the whole list, and whether a list has
two classes is decided over all its parts.

Defined cases: null and empty texts have an empty set and are linked with nothing (their
component is their own id); rows with a null id are linked by their text but don't name
a component (null if no row of it has an id); rows that repeat an id are separate rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from partsmith.llm.common import written
from partsmith.llm.components import components
from partsmith.llm.wordhash import WordHasher, groups, mix

SIZE = 5
#: Similarity threshold as a fraction, so that bounds are exact.
NUM, DEN = 4, 5
#: Counters of the frequency sketch (fixed, whatever the input).
SKETCH_BITS = 20
CHUNK = 1 << 14
#: Sets of more shingles are never light.
MAX_LIGHT = 24
#: Cost of verifying one pair, in emitted rows.
VERIFY_COST = 20.0
#: Members of a list's largest component that its other entries are first compared with.
TRIES = 8
#: A list longer than this (by the sketch) proposes in several parts.
PART = 50_000
#: Entries of one side that meet in one group of the last pass.
MEET = 2_000
#: Relative width of a band of sizes in the last pass (small sizes have a band each).
BAND = 1.02


def overlap(n: int, m: int) -> int:
    """Least number of common elements of linked sets of n and m elements."""
    return -(-NUM * (n + m) // (DEN + NUM))


def partners(n: int) -> range:
    """Sizes that a set of n elements can be linked with."""
    return range(-(-n * NUM // DEN), n * DEN // NUM + 1)


def prefix_length(n: int) -> int:
    return n - -(-n * NUM // DEN) + 1


def light_keys(n: int, boundary: int) -> int:
    """Subsets that a light set of n elements emits."""
    return sum(math.comb(n, overlap(n, m)) for m in partners(n) if m <= boundary)


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self):
        self.hasher = WordHasher(_BLANK)

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The shingles of every text of a column, in order."""
        for _, data, ends in groups(texts):
            yield from self._sets(data, ends)

    def text(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        return next(self._sets(data, np.array([len(data)])))

    def _sets(self, data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        w, counts = self.hasher.words(data, ends)
        grams = w * _FACTORS[0]
        for i in range(1, SIZE):
            grams[:-i] += w[i:] * _FACTORS[i]  # those that run over the end aren't used
        grams = mix(grams)
        at = 0
        for n in counts.tolist():
            if n >= SIZE:
                x = np.sort(grams[at:at + n - SIZE + 1])
                yield x[np.r_[True, x[1:] != x[:-1]]]
            elif n:
                yield mix((w[at:at + n] * _FACTORS[:n]).sum(dtype=np.uint64, keepdims=True)
                          + np.uint64(n))
            else:
                yield w[:0]
            at += n


def set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def _texts(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield batch.slice(at, 1000)


def _first_seen(seen: set, sid: int) -> bool:
    if sid in seen:
        return False
    if len(seen) >= 4_000_000:  # a class may then be emitted again, which is harmless
        seen.clear()
    seen.add(sid)
    return True


# -- pass 1: classes and the frequency sketch ---------------------------------------
def _classes(documents: DataFrame) -> DataFrame:
    """Rows ``doc_id, n, sid`` of all documents, and ``chunk, counts`` of the sketch."""
    kind = documents.schema["doc_id"].dataType

    def run(batches):
        make, counts, seen = Shingler(), np.zeros(1 << SKETCH_BITS, np.uint32), set()
        id_type = None
        for batch in _texts(batches):
            sizes, sids = [], []
            id_type = batch.schema.field(0).type
            fresh = []
            for t in make.column(batch.column(1)):
                sid = set_id(t) if len(t) else 0
                sizes.append(len(t))
                sids.append(sid)
                if len(t) and _first_seen(seen, sid):
                    fresh.append(t)
            if fresh:
                buckets = (np.concatenate(fresh) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                counts += np.bincount(buckets, minlength=len(counts)).astype(np.uint32)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()),
                 pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                ["doc_id", "n", "sid", "chunk", "counts"])
        if id_type is not None:
            zip_ = zstandard.ZstdCompressor(level=1)
            parts = counts.reshape(-1, CHUNK)
            full = [i for i in range(len(parts)) if parts[i].any()]
            k = len(full)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, id_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.array(full, pa.int32()),
                 pa.array([zip_.compress(parts[i].tobytes()) for i in full], pa.binary())],
                ["doc_id", "n", "sid", "chunk", "counts"])

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind.simpleString()}, n long, sid long, chunk int, counts binary")


def _sketch(rows: DataFrame) -> np.ndarray:
    """Sum of the tasks' counters (``1 << SKETCH_BITS`` numbers, a fixed size)."""
    import pandas as pd

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, np.int64)
        for blob in frame["counts"]:
            total += np.frombuffer(zstandard.decompress(blob), np.uint32)
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "counts": [total.tobytes()]})

    out = np.zeros(1 << SKETCH_BITS, np.int64)
    # partial sums first, so that no task reads the counters of all tasks
    parts = rows.where("chunk is not null").select("chunk", "counts")
    for r in parts.groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect():
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def choose_boundary(sketch: np.ndarray, histogram: dict[int, int]) -> int:
    """Largest size up to which enumerating subsets costs less than listing."""
    total = float(sketch.sum())
    if not total:
        return MAX_LIGHT
    # mean frequency of a shingle occurrence, without what the buckets share by chance
    length = max(1.0, float((sketch.astype(float) ** 2).sum()) / total - total / len(sketch))
    best = 1
    for b in range(1, MAX_LIGHT + 1):
        light = sum(histogram.get(n, 0) * light_keys(n, b) for n in range(1, b + 1))
        lists = sum(histogram.get(n, 0) * prefix_length(n) * (1 + VERIFY_COST * (length - 1))
                    for n in range(1, b + 1))
        if light <= lists or not lists:
            best = b
    return best


# -- pass 2: subsets and postings ---------------------------------------------------
def subset_keys(tokens: np.ndarray, boundary: int) -> list[tuple[int, int]]:
    """(key, sizes differ) of the fixed-size subsets of a light set, by the pair of sizes."""
    n, out = len(tokens), []
    mixed = [int(x) for x in mix(tokens)]
    total, mask = sum(mixed), (1 << 64) - 1
    for m in partners(n):
        if m > boundary:
            continue
        drop = n - overlap(n, m)
        lo, hi = min(n, m), max(n, m)
        for gone in combinations(mixed, drop):
            rest = (total - sum(gone)) & mask
            key = xxhash.xxh64_intdigest(b"%d %d %d" % (lo, hi, rest)) - (1 << 63)
            out.append((key, int(lo < hi)))
    return out


def _listed(documents: DataFrame, sketch: np.ndarray, boundary: int) -> DataFrame:
    """``light, key, part, sid, n, pos``: subsets of light sets (``pos``: 1 if the key is of
    two sizes), prefix shingles of the sets that heavy ones can be linked with."""
    # a rank of frequency per bucket, in an eighth of an octave: at most 512 values
    order = np.minimum(np.log2(sketch + 1.0) * 8, 511).astype(np.uint16)
    from_size = -(-(boundary + 1) * NUM // DEN)

    def run(batches):
        make, seen = Shingler(), set()
        for batch in _texts(batches):
            cols: list[list] = [[], [], [], [], [], []]
            for t in make.column(batch.column(1)):
                n = len(t)
                if not n:
                    continue
                sid = set_id(t)
                if not _first_seen(seen, sid):
                    continue
                if n <= boundary:
                    keys = np.array(subset_keys(t, boundary), np.int64).reshape(-1, 2)
                    for c, v in zip(cols, (np.ones(len(keys), bool), keys[:, 0],
                                           np.zeros(len(keys), np.int32),
                                           np.full(len(keys), sid),
                                           np.full(len(keys), n, np.int32),
                                           keys[:, 1].astype(np.int32)), strict=True):
                        c.append(v)
                if n >= from_size:
                    k = prefix_length(n)
                    freq = order[t >> np.uint64(64 - SKETCH_BITS)]
                    pick = np.lexsort((t, freq))[:k]  # by frequency, then by hash
                    parts = np.ceil(np.exp2(freq[pick] / 8.0) / PART).astype(np.int64)
                    # 0: the whole list, from 1 on: the parts of a split one
                    part = np.where(parts > 1, 1 + abs(sid) % np.maximum(parts, 1), 0)
                    part = part.astype(np.int32)
                    for c, v in zip(cols, (np.zeros(k, bool), t[pick].view(np.int64), part,
                                           np.full(k, sid), np.full(k, n, np.int32),
                                           np.arange(k, dtype=np.int32)), strict=True):
                        c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in cols],
                    ["light", "key", "part", "sid", "n", "pos"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "light boolean, key long, part int, sid long, n int, pos int")


def _shared(listed: DataFrame) -> DataFrame:
    """Entries of lists with two classes or more, each with the smallest class of its list
    part (``lead, lead_n, lead_pos``).  The lists are dealt by key and part and streamed
    in order, so the length of a list doesn't matter.  Of split lists (``part > 0``) every
    class goes out: one that is alone in its part can meet others of the key (``_joined``)."""
    names = ["light", "key", "part", "sid", "n", "pos"]

    def run(batches):
        held = None  # the first entry of the current list, until a second class comes
        lead = None
        for batch in batches:
            if not batch.num_rows:
                continue
            a = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            light, key, part, sid, n, pos = a
            new = np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])
                        | (light[1:] != light[:-1])]
            if lead is not None and (lead[0], lead[1], lead[2]) == (light[0], key[0], part[0]):
                new[0] = False
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            own = start >= 0
            lead_sid = np.where(own, sid[start], lead[3] if lead else 0)
            lead_n = np.where(own, n[start], lead[4] if lead else 0)
            lead_pos = np.where(own, pos[start], lead[5] if lead else 0)
            other = sid != lead_sid
            # the list's first entry goes out once, with its first other class
            is_lead = np.zeros(len(key), bool)
            group = np.cumsum(new)
            has = np.zeros(group[-1] + 1, bool)
            has[group[other]] = True
            is_lead[new] = has[group[new]] | (part[new] > 0)
            extra = []
            if held is not None:
                if not new[0] and has[group[0]]:
                    extra, held = [held], None
                elif new[0] or new.any():
                    held = None
            keep = other | is_lead
            cols = [x[keep] for x in (*a, lead_sid, lead_n, lead_pos)]
            for x in extra:
                cols = [np.r_[np.array([v], c.dtype), c]
                        for v, c in zip((*x, x[3], x[4], x[5]), cols, strict=True)]
            if new.any():
                at = int(start[-1])
                lead = (light[at], key[at], part[at], sid[at], n[at], pos[at])
                held = None if has[group[at]] or part[at] > 0 else lead
            if len(cols[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                                 [*names, "lead", "lead_n", "lead_pos"])

    dealt = listed.repartition("key", "part").sortWithinPartitions("key", "part", "light", "sid")
    return dealt.mapInArrow(run, "light boolean, key long, part int, sid long, n int, pos int,"
                                 " lead long, lead_n int, lead_pos int")


def _joined(shared: DataFrame) -> DataFrame:
    """The entries of lists of shingles, from the whole lists and the parts of split ones
    with two classes or more in all parts.  The lead of a part has the key's smallest class
    as its lead, so that the parts' stars are connected."""
    lists = shared.where("NOT light")
    split = lists.where("part > 0")
    firsts = split.groupBy("key").agg(
        F.min(F.struct("sid", "n", "pos")).alias("first"), F.max("sid").alias("high")).where(
        "first.sid < high").select("key", "first")
    own = F.col("sid") == F.col("lead")
    kept = split.join(firsts, "key").select(
        *split.columns[:-3], *[F.when(own, F.col(f"first.{a}")).otherwise(F.col(b)).alias(b)
                               for a, b in (("sid", "lead"), ("n", "lead_n"), ("pos", "lead_pos"))])
    return lists.where("part = 0").unionByName(
        written(kept.select(*split.columns), "split"))


def _bounded(a: str, b: str, suffix: tuple[str, str, str, str]) -> str:
    """SQL of the length and positional bounds of a pair."""
    na, pa_, nb, pb = suffix
    return (f"{NUM} * greatest({na}, {nb}) <= {DEN} * least({na}, {nb}) AND "
            f"{NUM} * ({na} + {nb}) <= {NUM + DEN} * "
            f"(1 + least({na} - {pa_} - 1, {nb} - {pb} - 1)) AND {a} != {b}")


def _band(size: str) -> str:
    """SQL of the band of a size; equal for equal sizes and growing with them."""
    return f"cast(floor(ln({size}) / {math.log(BAND)!r}) as int)"


def _meeting(unsettled: DataFrame) -> DataFrame:
    """Pairs ``u, v`` of classes of one list within the bounds and of different components, each
    once."""
    entries = unsettled.select("key", "sid", "n", "pos", "comp", F.expr(_band("n")).alias("band"),
                               (F.col("comp") == F.col("major")).alias("main"))
    # sizes m with NUM (n + m) <= (NUM + DEN) (n - pos), the positional bound, among partners
    least_ = f"((n * {NUM} + {DEN - 1}) div {DEN})"
    most = f"least((({NUM + DEN} * (n - pos)) div {NUM} - n), n * {DEN} div {NUM})"
    # as many numbers per list as there are bands; a table, so that a long list can be split
    bands = written(entries.groupBy("key").agg(F.collect_set("band").alias("bands")), "bands")
    seeking = entries.where(f"NOT main AND {most} >= {least_}").join(bands, "key").withColumn(
        "band", F.explode(F.expr(
            f"filter(bands, b -> b BETWEEN {_band(least_)} AND {_band(most)})"))).drop("bands")
    group = ["key", "band"]
    n_seeking = seeking.groupBy(*group).agg(F.count(F.lit(1)).alias("n_seeking"))
    n_held = entries.groupBy(*group).agg(F.count(F.lit(1)).alias("n_held"))
    large = written(n_seeking.join(n_held, group).where(
        f"n_seeking > {MEET} OR n_held > {MEET}").select(
        *group, F.ceil(F.col("n_seeking") / MEET).cast("int").alias("seeking_blocks"),
        F.ceil(F.col("n_held") / MEET).cast("int").alias("held_blocks")), "large")

    def dealt(side: DataFrame, mine: str, others: str) -> DataFrame:
        at = F.pmod(F.xxhash64("sid"), F.coalesce(f"{mine}_blocks", F.lit(1))).cast("int")
        return side.join(large, group, "left").withColumn(f"{mine}_block", at).withColumn(
            f"{others}_block", F.explode(F.expr(f"sequence(0, coalesce({others}_blocks, 1) - 1)"))
        ).select(*group, "seeking_block", "held_block", "sid", "n", "pos", "comp", "main")

    a, b = dealt(seeking, "seeking", "held").alias("a"), dealt(entries, "held", "seeking").alias("b")
    cond = " AND ".join(f"a.{c} = b.{c}" for c in [*group, "seeking_block", "held_block"])
    pairs = a.join(b, F.expr(f"{cond} AND a.comp != b.comp AND (b.main OR a.sid < b.sid) AND "
                             + _bounded("a.sid", "b.sid", ("a.n", "a.pos", "b.n", "b.pos"))))
    return pairs.select(F.greatest("a.sid", "b.sid").alias("u"),
                        F.least("a.sid", "b.sid").alias("v")).distinct()


# -- verification -------------------------------------------------------------------
def _payloads(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Compressed texts of the classes in ``wanted (sid)``: ``sid, z``."""
    def run(batches):
        make, seen = Shingler(), set()
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in _texts(batches):
            sids, blobs = [], []
            texts = batch.column(1)
            for i, t in enumerate(make.column(texts)):
                if len(t) and _first_seen(seen, sid := set_id(t)):
                    sids.append(sid)
                    blobs.append(zip_.compress(texts[i].as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()),
                                              pa.array(blobs, pa.binary())], ["sid", "z"])

    texts = documents.select("doc_id", "text").mapInArrow(run, "sid long, z binary")
    return texts.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.first("z").alias("z"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The linked ones of ``pairs (u, v)``, checked on the whole texts."""
    def run(batches):
        make = Shingler()
        last: dict[int, np.ndarray] = {}

        def tokens(sid, z):
            if sid not in last:
                if len(last) >= 64:
                    last.clear()
                last[sid] = make.text(zstandard.decompress(z))
            return last[sid]

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                u, v, zu, zv = (c.to_pylist() for c in part.columns)
                ok = []
                for i in range(len(u)):
                    a, b = tokens(u[i], zu[i]), tokens(v[i], zv[i])
                    both = np.concatenate([a, b])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    ok.append(DEN * common >= NUM * (len(both) - common))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(pa.array(ok, pa.bool_())),
                     part.column(1).filter(pa.array(ok, pa.bool_()))], ["u", "v"])

    one = pairs.join(texts.select(F.col("sid").alias("u"), F.col("z").alias("zu")), "u")
    two = one.join(texts.select(F.col("sid").alias("v"), F.col("z").alias("zv")), "v")
    return two.select("u", "v", "zu", "zv").mapInArrow(run, "u long, v long")


# -- the join -----------------------------------------------------------------------
def _labels(entries: DataFrame, comp: DataFrame) -> DataFrame:
    """``entries`` with the component of each class (its own, where it has no link)."""
    c = comp.select(F.col("node").alias("sid"), "comp")
    return (entries.join(c, "sid", "left")
            .withColumn("comp", F.coalesce("comp", "sid")))


def links(documents: DataFrame, classes: DataFrame) -> DataFrame:
    """Components ``node, comp`` of the classes that are linked with another one."""
    sketch = _sketch(classes)
    histogram = {r["n"]: r["count"] for r in classes.where(F.col("n").between(1, MAX_LIGHT))
                 .groupBy("n").count().collect()}
    boundary = choose_boundary(sketch, histogram)
    shared = written(_shared(_listed(documents, sketch, boundary)), "lists")
    # light: a subset key names both sizes; if they differ, sets of both must be there
    sizes = (shared.where("light").groupBy("key")
             .agg(F.min("sid").alias("low"), F.min("n").alias("n0"), F.max("n").alias("n1"),
                  F.max("pos").alias("uneven")).where("uneven = 0 OR n0 < n1"))
    sids = shared.where("light").select("key", "sid", "n").distinct().join(
        sizes, "key").where("sid != low")
    subset_links = sids.select(F.col("sid").alias("u"), F.col("low").alias("v"))
    lists = _joined(shared)
    texts = written(_payloads(documents, lists.select("sid").distinct()), "texts")
    star = (lists.where(_bounded("sid", "lead", ("n", "pos", "lead_n", "lead_pos")))
            .select(F.greatest("sid", "lead").alias("u"), F.least("sid", "lead").alias("v"))
            .distinct())
    comp = written(components(subset_links.unionByName(_verified(star, texts))), "components")
    entries = lists.select("key", "sid", "n", "pos").distinct()
    for last in (False, True):
        # lists with classes of different components, and the largest of these
        entries = written(_labels(entries, comp), "entries")
        groups = entries.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"))
        major = groups.groupBy("key").agg(
            F.count(F.lit(1)).alias("comps"),
            F.max(F.struct("size", "comp")).alias("x")).where("comps > 1").select(
            "key", F.col("x.comp").alias("major"), F.col("x.size").alias("size"))
        unsettled = written(entries.join(major, "key"), "open")
        if unsettled.isEmpty():
            break
        if last:
            pairs = _meeting(unsettled)
        else:
            # first about TRIES members of the largest component per list, other ones in each
            others = unsettled.where("comp != major")
            members = unsettled.where((F.col("comp") == F.col("major")) & (
                F.pmod(F.xxhash64("key", "sid"), F.col("size")) < TRIES))
            pairs = others.alias("a").join(members.alias("b"), F.expr(
                "a.key = b.key AND " + _bounded("a.sid", "b.sid", ("a.n", "a.pos", "b.n", "b.pos"))))
            pairs = pairs.select(F.greatest("a.sid", "b.sid").alias("u"),
                                 F.least("a.sid", "b.sid").alias("v")).distinct()
        more = written(_verified(pairs, texts), "links")
        entries = unsettled.select("key", "sid", "n", "pos")
        if not more.isEmpty():
            stars = comp.select(F.col("node").alias("u"), F.col("comp").alias("v"))
            comp = written(components(stars.unionByName(more)), "components")
    return comp


def jaccard_components(documents: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, n_shingles, sid, comp`` (class and component, numbers of
    this run) and ``component_id`` (the smallest doc_id reachable by links, itself
    included)."""
    classes = written(_classes(documents), "classes")
    docs = classes.where("chunk is null").select("doc_id", "n", "sid")
    comp = links(documents, classes)
    full = written(_labels(docs.where("n > 0"), comp), "labels")
    # both sides are read from tables, so a component of many rows can be split in the join
    low = written(full.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "lowest")
    out = full.join(low, "comp").select(
        "doc_id", F.col("n").alias("n_shingles"), "sid", "comp", "component_id")
    empty = docs.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), "sid",
                                       F.lit(None).cast("long").alias("comp"),
                                       F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)


def _free(documents: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until no column has that name."""
    taken, out = {c.lower() for c in documents.columns}, []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def _tagged(documents: DataFrame, size: str, sid: str) -> DataFrame:
    """``documents`` with the size and class of each row's set, as columns of these names."""
    names = documents.columns

    def run(batches):
        make = Shingler()
        for batch in batches:
            sets = [(len(t), set_id(t) if len(t) else 0)
                    for t in make.column(batch.column(names.index("text")))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in sets], pa.int64()),
                 pa.array([x[1] for x in sets], pa.int64())], [*names, size, sid])

    schema = StructType([*documents.schema.fields, StructField(size, LongType()),
                         StructField(sid, LongType())])
    return documents.mapInArrow(run, schema)


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component: the one with the smallest id (null last),
    then class, then hashes of the text and the row.  Rows without words are all kept."""
    size, sid, key, ident, rep = _free(documents, "__n", "__sid", "__key", "__id", "__rep")
    comp = jaccard_components(documents).where("n_shingles > 0")
    chosen = comp.groupBy("comp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "sid")).alias("r")).select(
        F.col("r.doc_id").alias(ident), F.col("r.sid").alias(rep),
        F.xxhash64("r.doc_id", "r.sid").alias(key))
    rows = _tagged(documents, size, sid).withColumn(key, F.xxhash64("doc_id", sid))
    # joined and grouped by one hash of both, so the texts are shuffled once
    kept = rows.join(chosen, (rows[key] == chosen[key])
                     & rows["doc_id"].eqNullSafe(chosen[ident])
                     & (rows[sid] == chosen[rep]), "left_semi")
    one = kept.groupBy(key, "doc_id", sid).agg(F.min_by(
        F.struct(*documents.columns),
        F.struct(F.xxhash64("text"), F.xxhash64(*documents.columns))).alias(rep)).select(f"{rep}.*")
    return one.unionByName(rows.where(F.col(size) == 0).select(*documents.columns))
