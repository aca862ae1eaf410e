"""The catalog as versioned, bucketed tables under one root.

Keyed tables (products, their parameters, categories) are split by a hash of their key
into a fixed number of buckets; a change rewrites the buckets it touches and no others.
Logs (rejects, bad pages, pages read, product ids seen) only grow.  A commit is one small
immutable file ``_versions/<n>.json`` that names, for each table and bucket, the folder that
holds it; the current version is the highest such file.  Data folders are written before
it, so a crash in between leaves the previous version current.

Every attempt at a version writes to folders of its own, and of several attempts at one
version one gets the version file.  The others fail and have changed nothing that a reader
sees; their folders are removed by ``vacuum``, as are versions no longer kept.

A log is a list of folders.  Whenever the newest ``LOG_MERGE`` of them have the same tier they
are rewritten as one of the next tier, so the list stays short (a few per tier) and a row is
rewritten once per tier.

Only a root without any version file is a new catalog.  An error while looking is
raised, never taken for an empty catalog.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith import schemas as S
from partsmith.sources import files

BUCKET = "__bucket"
#: Keyed tables: schema and key.
KEYED = {"products": (S.PRODUCT_SCHEMA, S.PRODUCT_KEY),
         "product_params": (S.PARAM_SCHEMA, S.PRODUCT_KEY),
         "categories": (S.CATEGORY_SCHEMA, "id")}
#: Folders of one tier of a log that are merged into one.
LOG_MERGE = 16
#: Logs: rejected records; page lines that are no page envelope; pages read, with all their items
#: and those with an id; product ids seen, as bitmaps (32,768 ids each) that can be OR-ed.
_RUN = [("run_ts", T.TimestampNTZType()), ("source_file", T.StringType())]
LOGS = {name: T.StructType([T.StructField(n, t) for n, t in [*_RUN, *more]]) for name, more in {
    "rejects": [("page", T.LongType()), ("pos", T.IntegerType()), ("sku", T.StringType()),
                ("reject_reason", T.StringType()), ("doc", T.StringType())],
    "bad_pages": [("line", T.StringType())],
    "pages": [("batch", T.LongType()), ("page", T.LongType()), ("items", T.LongType()),
              ("known_items", T.LongType()), ("logged_at", T.TimestampNTZType())],
}.items()}
LOGS["seen"] = T.StructType([T.StructField("run_ts", T.TimestampNTZType()),
                             T.StructField("bucket", T.LongType()),
                             T.StructField("ids", T.BinaryType())])


class Catalog:
    """``buckets`` counts only when the catalog is created; size it so that a bucket is
    about as large as a task can rewrite."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self._buckets = spark, root.rstrip("/"), buckets

    # -- versions --------------------------------------------------------------------
    def current_version(self) -> int | None:
        found = files.names(self.spark, f"{self.root}/_versions") or []
        versions = [int(n[:-5]) for n in found if n.endswith(".json")]
        return max(versions, default=None)

    def state(self, version: int | None = None) -> dict:
        """What a version (default: the current one) consists of."""
        v = self.current_version() if version is None else version
        if v is None:
            return {"buckets": self._buckets, "tables": {}, "logs": {}, "run": {}, "stream": {}}
        return json.loads(files.read_text(self.spark, f"{self.root}/_versions/{v:08d}.json"))

    def publish(self, version: int, state: dict) -> None:
        files.write_once(self.spark, f"{self.root}/_versions/{version:08d}.json",
                         json.dumps(state, sort_keys=True))

    def next_version(self) -> int:
        v = self.current_version()
        return 0 if v is None else v + 1

    # -- reading ---------------------------------------------------------------------
    def bucket_of(self, key: str, state: dict) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(state["buckets"])).cast("int")

    def _folder(self, table: str, name: str) -> str:
        return f"{self.root}/{table}/{name}"

    @staticmethod
    def _attempt(version: int) -> str:
        """A folder name that no other attempt has."""
        return f"v{version:08d}/{uuid.uuid4().hex[:12]}"

    def read(self, table: str, version: int | None = None, state: dict | None = None,
             only: list[int] | None = None) -> DataFrame:
        """A keyed table (all buckets or ``only`` some) or a log."""
        state = state or self.state(version)
        if table in LOGS:
            paths = [self._folder(table, name) for name, _ in state["logs"].get(table, [])]
            return self._load(paths, LOGS[table])
        held = state["tables"].get(table, {})
        paths = [f"{self._folder(table, v)}/{BUCKET}={b}" for b, v in held.items()
                 if only is None or int(b) in only]
        return self._load(paths, KEYED[table][0])

    def _load(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*sorted(paths))

    def touched(self, table: str, rows: DataFrame, state: dict) -> list[int]:
        """Buckets that hold the keys of ``rows`` (at most ``buckets`` numbers)."""
        b = self.bucket_of(KEYED[table][1], state)
        return sorted(r[0] for r in rows.select(b.alias("b")).distinct().collect())

    # -- writing ---------------------------------------------------------------------
    def write(self, table: str, rows: DataFrame, version: int, state: dict,
              only: list[int] | None = None) -> dict:
        """Write buckets of a keyed table (``rows`` are all rows of the buckets ``only``; None:
        of all) and return the state with them."""
        schema, key = KEYED[table]
        out = rows.select(*schema.fieldNames(), self.bucket_of(key, state).alias(BUCKET))
        # a rebalance by bucket keeps files few and splits buckets of uneven size
        out = out.hint("rebalance", BUCKET)
        name = self._attempt(version)
        path = self._folder(table, name)
        out.write.partitionBy(BUCKET).parquet(path)
        have = [int(n.split("=")[1]) for n in files.names(self.spark, path) or []
                if n.startswith(f"{BUCKET}=")]
        held = dict(state["tables"].get(table, {})) if only is not None else {}
        for b in only or []:
            held.pop(str(b), None)  # a touched bucket may have become empty
        held |= {str(b): name for b in have}
        return state | {"tables": state["tables"] | {table: held}}

    def append(self, log: str, rows: DataFrame, version: int, state: dict) -> dict:
        """Add a batch of ``rows`` to a log."""
        held = [*state["logs"].get(log, []), [self._add(log, rows, version), 0]]
        while len(held) >= LOG_MERGE and len({t for _, t in held[-LOG_MERGE:]}) == 1:
            last, tier = held[-LOG_MERGE:], held[-1][1]
            merged = self._load([self._folder(log, name) for name, _ in last], LOGS[log])
            # as few files as their size asks for
            held[-LOG_MERGE:] = [[self._add(log, merged.hint("rebalance"), version), tier + 1]]
        return state | {"logs": state["logs"] | {log: held}}

    def _add(self, log: str, rows: DataFrame, version: int) -> str:
        name = self._attempt(version)
        rows.select(*LOGS[log].fieldNames()).write.parquet(self._folder(log, name))
        return name

    def vacuum(self, keep: int = 10) -> list[str]:
        """Remove all but the newest ``keep`` versions and the folders that only removed
        versions or failed attempts at them used; the folders removed.  Folders of attempts at
        versions to come are left alone, as their writer may still commit."""
        versions = sorted(int(n[:-5]) for n in files.names(self.spark, f"{self.root}/_versions")
                          or [] if n.endswith(".json"))
        kept = versions[-max(keep, 1):]
        if not kept:
            return []
        # and what the current version needs to be published without the overlay
        primary = self.state(kept[-1]).get("primary_version")
        kept = sorted({*kept, *({primary} & set(versions))})
        gone = [v for v in versions if v not in kept]
        used = set()
        for v in kept:
            state = self.state(v)
            used |= {(t, name) for t, held in state["tables"].items() for name in held.values()}
            used |= {(t, name) for t, held in state["logs"].items() for name, _ in held}
        # version files first, so that no reader finds one whose folders are gone
        for v in gone:
            files.delete(self.spark, f"{self.root}/_versions/{v:08d}.json")
        removed = []
        for table in [*KEYED, *LOGS]:
            for folder in files.names(self.spark, f"{self.root}/{table}") or []:
                if not re.fullmatch(r"v\d+", folder) or int(folder[1:]) > kept[-1]:
                    continue
                attempts = files.names(self.spark, f"{self.root}/{table}/{folder}") or []
                old = [n for n in attempts if (table, f"{folder}/{n}") not in used]
                for n in [folder] if len(old) == len(attempts) else [f"{folder}/{n}" for n in old]:
                    files.delete(self.spark, self._folder(table, n))
                    removed.append(f"{table}/{n}")
        return removed

    def seed(self, **tables: DataFrame) -> int:
        """A new version with whole tables."""
        version, state = self.next_version(), self.state()
        for name, rows in tables.items():
            state = self.write(name, rows, version, state)
        self.publish(version, state)
        return version
