"""Not-modified revisits of a web crawl, resolved to the full response they repeat.

A revisit record holds headers only. It is joined, as of its time, by canonical URL to the latest full response captured
strictly earlier (of several at one time, the one with the largest id). Its validators must agree: where both records
carry a payload digest these must be equal, else an `etag` that both carry (compared weakly), else `last-modified`;
without a common validator the revisit stays unresolved. The headers of a resolved revisit are those of the response, with
the ones a 304 answer may change taken from the revisit.

Each URL's time line is cut at quantiles of all capture times. The latest response of each piece is found with
combining before the shuffle and carried on over the (few) pieces of its URL; rows are put in order within a
piece only. So a URL that holds a third of all records is spread over as many tasks as there are pieces.

Defined results: a null URL, time or type never meets anything; header names are compared in lower case, and of names that
then repeat the last one by name and value counts; records of other types than `response` and `revisit` are left out;
empty tables give an empty result; repeated rows are resolved each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brokerhouse.llm.common import materialize

#: Headers that a not-modified answer may update (RFC 9110, 15.4.5, and stored-response freshness).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "vary")
PIECES = 64


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, user or fragment, `/` for no path, parameters in order."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*", 0), "^.*@", ""))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).otherwise(F.regexp_replace(host, ":443$", ""))
    tail = F.regexp_replace(rest, r"^[^/?]*", "")
    path = F.regexp_extract(tail, r"^[^?]*", 0)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = F.regexp_extract(tail, r"\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.concat(scheme, F.lit("://"), host, path, F.when(ordered == "", F.lit("")).otherwise(F.concat(F.lit("?"), ordered)))


def lower_headers(headers: Column) -> Column:
    """Header names in lower case, each once."""
    entries = F.array_sort(
        F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    )
    last = F.filter(entries, lambda e, i: (i == F.size(entries) - 1) | (F.get(entries, i + 1)["key"] != e["key"]))
    return F.coalesce(F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def merged_headers(original: Column, revisit: Column) -> Column:
    fresh = F.map_filter(revisit, lambda k, v: k.isin(*PERMITTED))
    return F.map_concat(F.map_filter(original, lambda k, v: ~F.map_contains_key(fresh, k)), fresh)


def resolve(records: DataFrame, pieces: int = PIECES) -> DataFrame:
    """Per revisit: `record_id`, canonical `url`, `original_id`, `outcome`, merged `headers`, `payload_digest`.

    `records` has record_id long, url, captured_at timestamp, type, headers map<string,string>, payload_digest.
    Outcomes: resolved, validator_mismatch, no_validator, no_original.
    """
    slim = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("_id"),
        canonical_url(F.col("url")).alias("_url"),
        F.unix_micros("captured_at").alias("_time"),
        (F.col("type") == "response").alias("_full"),
        lower_headers(F.col("headers")).alias("_headers"),
        F.col("payload_digest").alias("_digest"),
    )
    slim = materialize(slim)  # read three times: URLs and headers are put in form once
    cuts = slim.agg(
        F.percentile_approx("_time", [k / pieces for k in range(1, pieces)], 10 * pieces).alias("_cuts")
    ).first()["_cuts"] or []
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<long>")
    slim = slim.withColumn("_piece", F.size(F.filter(edges, lambda c: c <= F.col("_time"))))
    slim = slim.withColumn(
        "_own", F.when(F.col("_full") & F.col("_time").isNotNull(), F.struct("_time", "_id", "_headers", "_digest"))
    )
    order = F.when(F.col("_own").isNotNull(), F.struct("_time", F.coalesce("_id", F.lit(-(2**63)))))
    ends = slim.where("_url is not null").groupBy("_url", "_piece").agg(F.max_by("_own", order).alias("_last"))
    along = Window.partitionBy("_url").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_url").alias("_u"), F.col("_piece").alias("_p"), F.last("_last", ignorenulls=True).over(along).alias("_carried")
    )
    earlier = Window.partitionBy("_url", "_piece").orderBy("_time").rangeBetween(Window.unboundedPreceding, -1)
    within = slim.withColumn("_near", F.max_by("_own", order).over(earlier)).where("not _full")
    both = within.join(carried, (F.col("_url") == F.col("_u")) & (F.col("_piece") == F.col("_p")), "left")
    usable = F.col("_time").isNotNull() & F.col("_url").isNotNull()
    both = both.withColumn("_from", F.when(usable, F.coalesce("_near", "_carried")))
    pairs = [
        (F.col("_digest"), F.col("_from._digest")),
        (_weak(F.col("_headers")["etag"]), _weak(F.col("_from._headers")["etag"])),
        (F.col("_headers")["last-modified"], F.col("_from._headers")["last-modified"]),
    ]
    agrees = F.coalesce(*[F.when(a.isNotNull() & b.isNotNull(), a == b) for a, b in pairs])
    outcome = (
        F.when(F.col("_from").isNull(), "no_original")
        .when(agrees.isNull(), "no_validator")
        .when(agrees, "resolved")
        .otherwise("validator_mismatch")
    )
    both = both.withColumn("outcome", outcome)
    good = F.col("outcome") == "resolved"
    return both.select(
        F.col("_id").alias("record_id"),
        F.col("_url").alias("url"),
        F.when(good, F.col("_from._id")).alias("original_id"),
        "outcome",
        F.when(good, merged_headers(F.col("_from._headers"), F.col("_headers"))).otherwise(F.col("_headers")).alias("headers"),
        F.when(good, F.col("_from._digest")).otherwise(F.col("_digest")).alias("payload_digest"),
    )


#: Seconds between two full captures of a page.
APART = 172_800


def crawl_of(pages: DataFrame) -> DataFrame:
    """A crawl of the pages: each three times in full, its content changing now and then, and four revisits.

    The first revisit comes before any capture, the others each after one more. Revisits spell the URL in another way. By
    turns they carry the payload's digest (beside another etag), a weak etag, a last-modified time, nothing,
    an etag that has changed, a time that has changed; half of the captures carry a digest, a fifth of the pages no etag.
    """
    page = pages.select(
        F.col("page_id").alias("_id"), F.col("url").alias("_url"), F.coalesce("html", F.lit("")).alias("_html")
    ).select("_id", "_url", F.md5("_html").alias("_md5"), F.length("_html").alias("_size"))
    start = F.lit(1_700_000_000)
    text = lambda c: c.cast("string")
    version = lambda turn: F.floor((F.col("_id") + turn + 2) / 2)
    tag = lambda turn: F.concat(F.lit('"'), F.substring("_md5", 1, 12), F.lit("-"), text(version(turn)), F.lit('"'))
    changed = lambda turn: text(start + version(turn) * 1000)
    digest = lambda turn: F.concat("_md5", F.lit("-"), text(version(turn)))
    headers = lambda **values: F.map_filter(
        F.create_map(*[x for n, v in values.items() for x in (F.lit(n.replace("_", "-")), v)]), lambda k, v: v.isNotNull()
    )
    turn = F.col("_turn")
    began = start + F.col("_id") * 60 + turn * APART
    full = page.withColumn("_turn", F.explode(F.array(*map(F.lit, range(3))))).select(
        (F.col("_id") * 16 + turn).alias("record_id"),
        F.col("_url").alias("url"),
        F.timestamp_seconds(began).alias("captured_at"),
        F.lit("response").alias("type"),
        headers(
            Content_Type=F.lit("text/html"), ETag=F.when(F.col("_id") % 5 != 1, tag(turn)), Last_Modified=changed(turn),
            Date=text(began), Cache_Control=F.lit("max-age=60"), Content_Length=text(F.col("_size") + turn),
        ).alias("headers"),
        F.when((F.col("_id") + turn) % 2 == 1, digest(turn)).alias("payload_digest"),
    )
    kind, later = (F.col("_id") + turn) % 6, began - 3600
    etag = F.when(kind == 1, F.concat(F.lit("W/"), tag(turn - 1))).when(kind.isin(0, 4), F.lit('"other"'))
    modified = F.when(kind.isin(2, 4), changed(turn - 1)).when(kind == 5, F.lit("0"))
    again = page.withColumn("_turn", F.explode(F.array(*map(F.lit, range(4))))).select(
        (F.col("_id") * 16 + 8 + turn).alias("record_id"),
        F.concat(F.regexp_replace(F.regexp_replace("_url", "#.*$", ""), "^http", "HTTP"), F.lit("#again")).alias("url"),
        F.timestamp_seconds(later).alias("captured_at"),
        F.lit("revisit").alias("type"),
        headers(
            etag=etag, last_modified=modified, date=text(later), server=F.lit("edge"),
            cache_control=F.concat(F.lit("max-age="), text(F.col("_id") % 100)),
        ).alias("headers"),
        F.when(kind == 0, digest(turn - 1)).alias("payload_digest"),
    )
    return full.unionByName(again)
