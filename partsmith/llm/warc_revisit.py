"""Not-modified revisits of a web archive, resolved by an as-of join.

A revisit record says "304 Not Modified": the resource is what an earlier full response
to the same address held.  Captures are compared by canonical URL (scheme, ``www.``,
default port, fragment and trailing slash dropped, host in lower case, query parameters
sorted).  Each revisit is joined with the latest full response before it (by time, then
record id).  Its validators must agree: an ETag counts if both records have one (weak
comparison), else Last-Modified if both have one; with neither there is nothing to
contradict.  On agreement the result has the response's status, payload digest and
headers, over which the revisit's headers are laid where a 304 may update them.

No URL is collected into one task: the captures are dealt by ranges of (URL, time, id),
so the captures of a hot URL stand in many partitions; each partition hands its last full
response on to the following ones through a table of one row per partition.

Defined cases: a null URL matches nothing ("no-url"); a null time sorts first, a null
record id too; a revisit without an earlier full response is "unresolved", one whose
validators differ "mismatch"; null headers are empty; captures that repeat a record are
separate rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsmith.llm.common import written

#: Fixed by the HTTP standard: headers that a 304 response may update.
UPDATABLE = ["cache-control", "content-location", "date", "etag", "expires",
             "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Canonical form of an address; null stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    params = F.array_sort(F.array_remove(F.split(query, "&"), ""))
    return F.concat(host, path, F.when(F.size(params) > 0, F.concat(
        F.lit("?"), F.array_join(params, "&"))).otherwise(F.lit("")))


def _etag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def merged_headers(full: Column, revisit: Column) -> Column:
    """The response's headers with the permitted ones of the revisit laid over them,
    as an array of (name, value) sorted by name."""
    empty = F.expr("cast(map() as map<string,string>)")
    full, revisit = F.coalesce(full, empty), F.coalesce(revisit, empty)
    allowed = F.map_filter(revisit, lambda k, v: k.isin(UPDATABLE) & v.isNotNull())
    kept = F.map_filter(full, lambda k, v: ~F.map_contains_key(allowed, k))
    return F.array_sort(F.map_entries(F.map_concat(kept, allowed)))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Resolve every row of ``captures (record_id, url, ts, kind, status, headers, digest)``,
    ``kind`` being "response" or "revisit" and ``headers`` a map with lower-case names.

    Returns ``record_id, canonical, ts, kind, outcome, target_id, status, digest, headers``
    (entries sorted by name); a response's outcome is "response" and its target itself."""
    rows = captures.select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "ts", "kind", "status",
        "headers", "digest")
    order = ["canonical", "ts", "record_id"]
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id())
             .withColumn("at", F.monotonically_increasing_id()))
    dealt = written(dealt, "captures")
    full = F.when(F.col("kind") == "response", F.struct(
        "at", F.col("record_id").alias("id"), "status", "headers", "digest"))
    # within a partition: the last full response of the URL so far
    here = Window.partitionBy("part", "canonical").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    seen = dealt.withColumn("near", F.last(full, ignorenulls=True).over(here))
    # across partitions: a URL that goes on in the next partition is the last of its own
    # (one row per partition that isn't empty, so these tables are small whatever the input)
    ends = dealt.groupBy("part").agg(F.max_by("canonical", "at").alias("canonical"))
    ends = ends.withColumn("next_part", F.lead("part").over(Window.orderBy("part")))
    lasts = (dealt.join(F.broadcast(ends), ["part", "canonical"])
             .groupBy("part", "canonical", "next_part")
             .agg(F.max_by(full, F.when(F.col("kind") == "response", F.col("at"))).alias("last")))
    carry = lasts.select("next_part", "canonical", F.last("last", ignorenulls=True).over(
        Window.partitionBy("canonical").orderBy("part")).alias("carried"))
    nxt = carry.select(F.col("next_part").alias("part"), "canonical", "carried")
    joined = seen.join(F.broadcast(nxt), ["part", "canonical"], "left")
    full_of = F.coalesce("near", "carried")
    out = joined.withColumn("t", F.when(F.col("kind") == "revisit", full_of))
    headers, target = F.col("headers"), F.col("t")
    a, b = _etag(headers), _etag(target["headers"])
    c, d = headers["last-modified"], target["headers"]["last-modified"]
    agrees = (F.when(a.isNotNull() & b.isNotNull(), a == b)
              .when(c.isNotNull() & d.isNotNull(), c == d).otherwise(F.lit(True)))
    outcome = (F.when(F.col("kind") == "response", "response")
               .when(F.col("canonical").isNull(), "no-url")
               .when(target.isNull(), "unresolved")
               .when(agrees, "resolved").otherwise("mismatch"))
    out = out.withColumn("outcome", outcome)
    ok = F.col("outcome") == "resolved"
    none = F.expr("cast(map() as map<string,string>)")
    return out.select(
        "record_id", "canonical", "ts", "kind", "outcome",
        F.when(ok, target["id"]).when(F.col("kind") == "response", F.col("record_id"))
        .alias("target_id"),
        F.when(ok, target["status"]).otherwise(F.col("status")).alias("status"),
        F.when(ok, target["digest"]).otherwise(F.col("digest")).alias("digest"),
        F.when(ok, merged_headers(target["headers"], headers))
        .otherwise(merged_headers(headers, none)).alias("headers"))
