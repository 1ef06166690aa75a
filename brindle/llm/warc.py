"""Resolution of WARC not-modified revisits by an as-of join.

A revisit record (status 304) carries no body. It refers to the latest complete response of the same canonical URL that was
captured strictly earlier. Complete are the answers that a cache may keep whole (COMPLETE, a parameter); partial content, server
errors and records of unknown status are never referred to and stay as they are (``other``). If their validators agree (entity tags where both have one, else Last-Modified dates), the stored headers
are updated with those that a 304 may change, and the revisit takes the response's payload.

The as-of join never brings a large URL to one task: records are cut into slots, ranges of (URL, time) with PER_SLOT records on average, whatever their number and the
type of their times; a URL's records meet per slot, and the last response before a slot is carried in from a small table of (URL, slot) summaries.

Cases: a null or malformed URL is its own canonical form, as text; null URLs refer to nothing (no_earlier_response) and stay out of
the join. Records without a
time come before all others. Equal times share a slot, however many: a response at the revisit's own time isn't earlier; of several responses at one time, that with the largest
record id counts. Repeated rows stay repeated. An empty table gives an empty result. Extra columns pass through ``resolve``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import configure, shuffle_partitions, stage

#: Headers that a not-modified answer may not change, or that belong to its own connection (fixed names of RFC 9110 and 9111).
KEPT = [
    "content-encoding", "content-length", "content-range", "content-type", "transfer-encoding",
    "connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-connection", "te", "trailer", "upgrade",
]
#: Query parameters that don't choose a document.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid|phpsessid)(=|$)"
#: Statuses of complete responses (fixed values: the final ones that RFC 9110 lets a cache store by default, without partial content).
COMPLETE = (200, 203, 204, 300, 301, 308, 404, 405, 410, 414, 501)
#: Records of a slot, on average.
PER_SLOT = 20_000


def canonical(url: Column) -> Column:
    """Scheme, user, default port, leading "www.", fragment, tracking parameters and a closing slash don't count; parameters are sorted; A-Z of the host are lower-cased."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.translate(F.regexp_extract(rest, r"^([^/?]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&"), lambda x: (x != "") & ~F.lower(x).rlike(TRACKING))
    joined = F.array_join(F.array_sort(query), "&")
    return F.concat(host, path, F.when(joined == "", "").otherwise(F.concat(F.lit("?"), joined)))


def latest_earlier(records: DataFrame, key: str, at: str, full: Column, what: Column, per_slot: int = PER_SLOT) -> DataFrame:
    """Adds ``met``: ``what`` of the latest row with ``full`` of the same key at an earlier time. Rows without key or match get null."""
    keyed, alone = records.where(F.col(key).isNotNull()), records.where(F.col(key).isNull())
    slots = shuffle_partitions(records.sparkSession, keyed.count(), per_slot)
    # Slots are ranges of (key, time): any type that orders can be a time, and equal times share a slot.
    x = keyed.withColumn("_full", full).withColumn("_what", what).repartitionByRange(slots, key, F.col(at).asc_nulls_first())
    x = stage(x.withColumn("_slot", F.spark_partition_id()), "slots")
    last = F.max_by(F.when(F.col("_full"), F.col("_what")), F.when(F.col("_full"), F.struct(F.col(at), F.col("record_id"))))
    # One row per key and slot; each looks up the last response of the slots before it.
    have = x.groupBy(key, "_slot").agg(last.alias("_last"))
    carry = have.withColumn("_in", F.last("_last", ignorenulls=True).over(Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)))
    carry = carry.select(F.col(key).alias("_k"), F.col("_slot").alias("_s"), "_in")
    order = [F.col(at).asc_nulls_first(), F.col("_full"), F.col("record_id")]
    seen = F.last(F.when(F.col("_full"), F.col("_what")), ignorenulls=True).over(Window.partitionBy(key, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_seen", seen).join(carry, (F.col(key) == F.col("_k")) & (F.col("_slot") == F.col("_s")), "left")
    met = x.withColumn("met", F.coalesce("_seen", "_in")).drop("_slot", "_full", "_what", "_seen", "_k", "_s", "_in")
    return met.unionByName(alone.withColumn("met", F.lit(None).cast(met.schema["met"].dataType)))


def merged(stored: Column, update: Column) -> Column:
    may = F.map_filter(update, lambda k, _: ~k.isin(KEPT))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.array_contains(F.map_keys(may), k)), may)


def resolve(records: DataFrame, complete: tuple[int, ...] = COMPLETE, per_slot: int = PER_SLOT) -> DataFrame:
    """records: record_id string, url string, captured_at (any ordered type), status int (304: revisit), headers map of lower-case names, payload_digest string.

    Adds canonical_url, refers_to, resolution (response, other, resolved, validator_mismatch, no_validator or no_earlier_response) and replaces headers and
    payload_digest of resolved revisits.
    """
    configure(records.sparkSession)
    own = [c for c in records.columns if c not in ("canonical_url", "refers_to", "resolution", "met")]
    x = records.select(*own).withColumn("canonical_url", canonical(F.col("url")))
    full, revisit = F.coalesce(F.col("status").isin(*complete), F.lit(False)), F.coalesce(F.col("status") == 304, F.lit(False))
    x = latest_earlier(x, "canonical_url", "captured_at", full, F.struct("record_id", "headers", "payload_digest"), per_slot)
    tag = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    mine, theirs = F.col("headers"), F.col("met.headers")
    date = (mine["last-modified"], theirs["last-modified"])
    verdict = (
        F.when(full, "response").when(~revisit, "other").when(F.col("met").isNull(), "no_earlier_response")
        .when(tag(mine).isNotNull() & tag(theirs).isNotNull(), F.when(tag(mine) == tag(theirs), "resolved").otherwise("validator_mismatch"))
        .when(date[0].isNotNull() & date[1].isNotNull(), F.when(date[0] == date[1], "resolved").otherwise("validator_mismatch"))
        .otherwise("no_validator")
    )
    x = x.withColumn("resolution", verdict)
    done = F.col("resolution") == "resolved"
    x = x.withColumn("refers_to", F.when(done, F.col("met.record_id")))
    x = x.withColumn("payload_digest", F.when(done, F.col("met.payload_digest")).otherwise(F.col("payload_digest"))).withColumn("headers", F.when(done, merged(theirs, mine)).otherwise(mine))
    return x.select(*own, "canonical_url", "refers_to", "resolution")


def with_body(resolved: DataFrame, bodies: DataFrame) -> DataFrame:
    """bodies: (record_id, body) of the records that have one. Gives every record the body that it stands for, or null."""
    at = F.when(F.col("resolution").isin("response", "other"), F.col("record_id")).otherwise(F.col("refers_to"))
    return resolved.withColumn("_of", at).join(bodies.select(F.col("record_id").alias("_id"), "body"), F.col("_of") == F.col("_id"), "left").drop("_of", "_id")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl log made from pages: each page is captured in full at second 4 * page_id and asked for again 401 seconds later with another
    spelling of its URL, when it may have changed (every fifth) or have no validator (every seventh). Between the two, of 22 pages, one
    gives a part (206), one an error (500), one an answer of unknown status and one is gone (410); only the last is a complete response."""
    p = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit(""))).alias("digest"), F.length("html").cast("string").alias("size"))
    has_tag, old = F.col("page_id") % 3 != 1, F.concat(F.lit("day "), (F.col("page_id") % 28 + 1).cast("string"))
    tag = F.concat(F.lit('"'), F.substring("digest", 1, 16), F.lit('"'))
    changed, bare = F.col("page_id") % 5 == 4, F.col("page_id") % 7 == 6
    head = lambda *kv: F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in kv]), F.array(*[v for _, v in kv])), lambda _, v: v.isNotNull())
    full = p.select(
        F.concat(F.lit("r"), F.col("page_id").cast("string")).alias("record_id"), "page_id", "url", (F.col("page_id") * 4).alias("captured_at"), F.lit(200).alias("status"),
        head(("cache-control", F.lit("max-age=60")), ("content-length", F.col("size")), ("content-type", F.lit("text/html")), ("etag", F.when(has_tag, tag)), ("last-modified", old)).alias("headers"),
        F.col("digest").alias("payload_digest"),
    )
    again = p.select(
        F.concat(F.lit("v"), F.col("page_id").cast("string")).alias("record_id"), "page_id", F.concat(F.regexp_replace("url", "^http:", "HTTPS:"), F.lit("#again")).alias("url"),
        (F.col("page_id") * 4 + 401).alias("captured_at"), F.lit(304).alias("status"),
        head(("cache-control", F.lit("max-age=120")), ("connection", F.lit("close")), ("content-length", F.lit("0")), ("etag", F.when(has_tag & ~bare, F.when(changed, F.lit('"new"')).otherwise(F.concat(F.lit("W/"), tag)))), ("last-modified", F.when(~bare, F.when(changed, F.lit("day 0")).otherwise(old)))).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"),
    )
    k = F.col("page_id") % 22
    status = F.when(k == 0, 206).when(k == 5, 500).when(k == 16, 410)
    between = p.where(k.isin(0, 5, 11, 16)).select(
        F.concat(F.lit("b"), F.col("page_id").cast("string")).alias("record_id"), "page_id", "url", (F.col("page_id") * 4 + 203).alias("captured_at"), status.alias("status"),
        head(("content-type", F.lit("text/plain")), ("etag", F.lit('"between"')), ("last-modified", F.lit("day 99"))).alias("headers"),
        F.md5(F.lit("between")).alias("payload_digest"),
    )
    return full.unionByName(again).unionByName(between)


def report(pages: DataFrame) -> DataFrame:
    """The resolved crawl log of pages, headers as sorted lines."""
    # The log is read three times; the bodies are hashed once.
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda x: F.concat(x["key"], F.lit(": "), x["value"]))), "\n")
    out = resolve(stage(captures(pages), "captures"))
    return out.select("record_id", "page_id", "canonical_url", "captured_at", "refers_to", "resolution", lines.alias("headers"), "payload_digest")
