"""Bounded training samples and sharded fits."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = 1 << 30


def text_sample(rows: DataFrame, bound: int, per: str | None = None) -> DataFrame:
    """About ``bound`` different rows at most (for each value of ``per``), chosen by a hash of
    the text, so the choice doesn't depend on order or partitions.  Equal rows count once,
    however many there are; fewer different ones are all kept.  ``text_hash`` of ``rows`` is
    the xxhash64 of ``text``, made before any join, so that counting shuffles no texts; it
    is left out of the sample.  ``per`` must have few values; their counts are collected."""
    place = F.pmod(F.xxhash64(F.lit(11), "text"), F.lit(_SPACE))
    different, rows = rows.drop("text").distinct(), rows.drop("text_hash")
    if per is None:
        n = different.count()
        return (rows if n <= bound else rows.where(place < int(_SPACE * bound / n))).distinct()
    counts = {r[per]: r["count"] for r in different.groupBy(per).count().collect()}
    limit: Column = F.lit(_SPACE)
    for value, n in counts.items():
        if n > bound:
            limit = F.when(F.col(per) == F.lit(value), int(_SPACE * bound / n)).otherwise(limit)
    return rows.where(place < limit).distinct()


def fit_shards(rows: DataFrame, shards: int, fit: Callable[[pd.DataFrame], bytes]) -> list[bytes]:
    """Fit one model per shard (rows are dealt by a hash of their text) and collect the
    models, whose size must not depend on the input."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [fit(frame)]})

    got = _dealt(rows, shards).groupBy("shard").applyInPandas(run, "model binary").collect()
    return sorted(bytes(r["model"]) for r in got)


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(23), "text"), F.lit(shards)))


#: Numbers of a model that are summed together.
_PART = 1 << 16


def sum_shards(rows: DataFrame, shards: int,
               fit: Callable[[pd.DataFrame], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Fit a model (named arrays of numbers) per shard and return the sums over the shards, flat,
    and ``shards``, how many had rows.  They are added up in the cluster, part by part and in
    the order of the shards; one model comes to the driver, however many shards there are."""
    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, values in {"shards": np.ones(1), **fit(frame)}.items():
            flat = np.asarray(values, np.float64).ravel()
            out += [(name, at, key[0], flat[at:at + _PART].tobytes())
                    for at in range(0, len(flat), _PART)]
        return pd.DataFrame(out, columns=["name", "at", "shard", "numbers"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for blob in frame.sort_values("shard")["numbers"]:
            total = total + np.frombuffer(blob, np.float64)
        return pd.DataFrame({"name": frame["name"].iloc[:1], "at": frame["at"].iloc[:1],
                             "numbers": [total.tobytes()]})

    parts = _dealt(rows, shards).groupBy("shard").applyInPandas(
        run, "name string, at long, shard long, numbers binary")
    sums = parts.groupBy("name", "at").applyInPandas(add, "name string, at long, numbers binary")
    out: dict[str, list] = {}
    for r in sorted(sums.collect(), key=lambda r: (r["name"], r["at"])):
        out.setdefault(r["name"], []).append(np.frombuffer(r["numbers"], np.float64))
    return {name: np.concatenate(v) for name, v in out.items()}
