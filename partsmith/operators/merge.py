"""Upsert ("merge") of a batch into a keyed table under per-column rules.

Parquet tables have no MERGE/UPDATE, so a merge is expressed as

    dedupe(source) --FULL OUTER JOIN on key--> target   + one projection

and the caller writes the result as a new table version.  Presence flags
(``_t``/``_s``), not key-null tests, tell inserts from updates.

Plan shape: the source dedupe is an aggregate on the key (sort-based, as its
buffer is a struct), so its output is already hash-partitioned on the key and
the join adds no second exchange on that side — one shuffle per side in
total.  The dedupe pre-aggregates
map-side, so a key that holds a third of the batch is reduced to one row per
task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

T_FLAG = "__in_target"
S_FLAG = "__in_source"
ACTION = "merge_action"


@dataclass(frozen=True)
class Rule:
    """What a column becomes on update (key present on both sides) and on
    insert (key only in the source).

    update: ``source`` (take the batch value, NULL included) | ``keep`` (keep the
    table value) | ``coalesce_target`` (table value unless NULL) | ``const``.
    insert: ``source`` (batch value, NULL when the batch lacks the column) |
    ``const`` | ``null``.
    """

    update: str = "source"
    insert: str = "source"
    value: Any = None


SOURCE = Rule("source", "source")
KEEP = Rule("keep", "source")
COALESCE_TARGET = Rule("coalesce_target", "source")


def const(value) -> Rule:
    """Same literal/expression on insert and update (e.g. the run timestamp)."""
    return Rule("const", "const", value)


def keep_or_insert(value) -> Rule:
    """Keep on update; ``value`` on insert (a column default such as now)."""
    return Rule("keep", "const", value)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def dedupe_last_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last one in ``order_by`` order (last write wins).

    Expressed as ``max_by(row, order)`` grouped on the key: a partial aggregate
    runs before the shuffle, so hot keys are collapsed map-side instead of
    being sent to one task as a window partition would be."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]),
                 F.struct(*[F.col(c) for c in order_by])).alias("__last"))
    return agg.select(*keys, *[F.col("__last").getField(c).alias(c) for c in payload])


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged; the job fails if a key repeats.  Checked in the aggregate that the
    following join needs the rows hash-partitioned for anyway."""
    payload = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.any_value(F.struct(*[F.col(c) for c in payload])).alias("__row"),
        F.count(F.lit(1)).alias("__n"))
    text = F.concat(F.lit("repeated key in a merge source: "),
                    F.to_json(F.struct(*[F.col(k) for k in keys])))
    row = F.when(F.col("__n") == 1, F.col("__row")).otherwise(
        F.raise_error(text).cast(agg.schema["__row"].dataType))
    return agg.select(*keys, row.alias("__row")).select(
        *keys, *[F.col("__row").getField(c).alias(c) for c in payload])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
          rules: dict[str, Rule] | None = None, default: Rule = SOURCE,
          order_by: Sequence[str] | None = None, with_action: bool = False,
          source_is_unique: bool = False) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    * duplicate keys in ``source`` resolve to the last row by ``order_by``; without an
      order the caller states ``source_is_unique``, and a key that repeats all the same
      fails the job instead of giving two rows;
    * rows only in ``target`` pass through unchanged;
    * every other output column follows ``rules`` (``default`` otherwise);
    * the output has ``target``'s columns in ``target``'s order, plus
      ``merge_action`` (insert / update / unchanged) when ``with_action``.

    The per-column projection is written as SQL expressions and handed over
    in one ``selectExpr`` call (building a wide projection column object by
    column object costs thousands of driver round trips)."""
    keys = list(keys)
    rules = rules or {}
    if not order_by and not source_is_unique:
        raise ValueError("merge needs order_by, or source_is_unique=True")
    src = (dedupe_last_wins(source, keys, order_by) if order_by
           else assert_unique(source, keys))
    src_cols = [c for c in src.columns if c not in (order_by or [])]
    tgt_cols = list(target.columns)
    types = {f.name: f.dataType.simpleString() for f in target.schema.fields}

    t = target.selectExpr(*[_q(c) if c in keys else f"{_q(c)} AS {_q('__t_' + c)}"
                            for c in tgt_cols], f"true AS {T_FLAG}")
    s = src.selectExpr(*[_q(c) if c in keys else f"{_q(c)} AS {_q('__s_' + c)}"
                         for c in src_cols], f"true AS {S_FLAG}")
    j = t.join(s, on=keys, how="full_outer")
    consts = {}
    for c in tgt_cols:
        rule = rules.get(c, default)
        if "const" in (rule.update, rule.insert):
            consts[f"__v_{c}"] = _lit(rule.value)
    if consts:
        j = j.withColumns(consts)

    in_t = f"coalesce({T_FLAG}, false)"
    in_s = f"coalesce({S_FLAG}, false)"
    out = []
    for c in tgt_cols:
        if c in keys:
            out.append(_q(c))
            continue
        rule = rules.get(c, default)
        tv = _q(f"__t_{c}")
        sv = _q(f"__s_{c}") if c in src_cols else "NULL"
        cv = _q(f"__v_{c}")
        upd = {"source": sv, "keep": tv, "coalesce_target": f"coalesce({tv}, {sv})",
               "const": cv}.get(rule.update)
        ins = {"source": sv, "const": cv, "null": "NULL"}.get(rule.insert)
        if upd is None:
            raise ValueError(f"unknown update rule {rule.update!r} for {c}")
        if ins is None:
            raise ValueError(f"unknown insert rule {rule.insert!r} for {c}")
        dt = types[c]
        out.append(f"CASE WHEN {in_t} AND NOT {in_s} THEN {tv} "
                   f"WHEN {in_s} AND NOT {in_t} THEN CAST({ins} AS {dt}) "
                   f"ELSE CAST({upd} AS {dt}) END AS {_q(c)}")
    if with_action:
        out.append(f"CASE WHEN {in_t} AND {in_s} THEN 'update' WHEN {in_s} THEN 'insert' "
                   f"ELSE 'unchanged' END AS {ACTION}")
    return j.selectExpr(*out)


def merge_partial(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  columns: Sequence[str], order_by: Sequence[str] | None = None,
                  with_action: bool = False, source_is_unique: bool = False) -> DataFrame:
    """Upsert that only writes ``columns``: updates change just those, inserts
    take them from the batch and leave every other column NULL."""
    rules = {c: SOURCE for c in columns}
    cols = list(keys) + list(columns) + list(order_by or [])
    return merge(target, source.select(*cols), keys, rules,
                 default=Rule("keep", "null"), order_by=order_by, with_action=with_action,
                 source_is_unique=source_is_unique)


def mark_unseen(df: DataFrame, run_start, columns: Sequence[str],
                ts_col: str = "last_updated", value=0, unless: Column | None = None) -> DataFrame:
    """Set ``columns`` to ``value`` on rows not touched since ``run_start``
    (strictly older; a NULL timestamp never counts as stale), except where ``unless``
    holds."""
    stale = stale_predicate(run_start, ts_col)
    if unless is not None:
        stale = stale & ~unless
    return df.select(*[
        (F.when(stale, F.lit(value).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
         if c in columns else F.col(c)) for c in df.columns])


def stale_predicate(run_start, ts_col: str = "last_updated") -> Column:
    return F.coalesce(F.col(ts_col) < _lit(run_start).cast("timestamp_ntz"), F.lit(False))


def merge_stats(merged_with_action: DataFrame, stale: Column | None = None) -> DataFrame:
    """Affected-row counts of a merge in one aggregate: inserts, updates,
    batch rows (inserts + updates), untouched rows, and rows matching
    ``stale`` (the rows a following mark-unseen step changes)."""
    a = F.col(ACTION)
    aggs = [
        F.count_if(a == "insert").alias("inserted"),
        F.count_if(a == "update").alias("updated"),
        F.count_if(a != "unchanged").alias("affected"),
        F.count_if(a == "unchanged").alias("unchanged"),
        F.count(F.lit(1)).alias("total_rows"),
    ]
    if stale is not None:
        aggs.append(F.count_if(stale).alias("marked_stale"))
    return merged_with_action.agg(*aggs)


def refresh_children(children: DataFrame, batch_parents: DataFrame,
                     batch_children: DataFrame, key: str,
                     batch_col: str | None = None) -> DataFrame:
    """Replace the child rows of every parent key in a batch.

    All existing children of a key present in ``batch_parents`` are dropped
    (anti join) and the batch's children are added.  With ``batch_col`` the
    input may hold several batches: a key ends with the children of *its last
    batch only* (possibly none)."""
    new = batch_children
    if batch_col:
        # one aggregate serves both uses (its exchange is reused): each key's
        # last batch, and the set of keys
        last = batch_parents.groupBy(key).agg(F.max(batch_col).alias("__last_batch"))
        parent_keys = last.select(key)
        new = (batch_children.join(last, on=key, how="inner")
               .filter(F.col(batch_col) == F.col("__last_batch"))
               .drop("__last_batch", batch_col))
    else:
        parent_keys = batch_parents.select(key).distinct()
    kept = children.join(parent_keys, on=key, how="left_anti")
    return kept.unionByName(new.select(*children.columns))


def write_keyed_table(df: DataFrame, table: str, keys: Sequence[str], buckets: int,
                      path: str | None = None) -> None:
    """Persist a keyed table bucketed and sorted by its key (a catalog table,
    optionally at an explicit ``path``).

    A later merge or join on the key reads it already hash-partitioned into
    ``buckets`` partitions, so the large side is not shuffled at all; only the
    batch is exchanged to match (choose ``buckets`` equal to the session's
    shuffle partitions, or let AQE coalesce the batch side)."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
