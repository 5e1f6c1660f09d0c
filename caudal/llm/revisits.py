"""Not-modified revisit resolution of web captures.

A revisit record says that a page had not changed: it carries headers and no content. It is resolved by an as-of
join to the latest earlier full response of the same canonical URL, whose validators must agree with those of
the revisit; the response's headers are then updated by those headers of the revisit that a not-modified answer may
carry.

The as-of join works on instants: the captures of one URL at one time are first reduced to their last response, with
partial sums before the shuffle. Windows go over the instants of a slice of time, and over the slices' last responses, of
which there is one a slice, so no window grows with the captures of a URL beyond the number of different times. The
revisits then find their instant by an equal join. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query parameters that don't tell pages apart. (fixed values)
TRACKING = ["ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
#: Headers that a 304 answer updates in the stored response. (fixed values)
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Seconds of a time slice.
SLICE = 600


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without a closing slash, query parameters sorted
    and without tracking ones; no scheme, no fragment. A null URL stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "(?i)^https?://", "")
    head, query = F.substring_index(bare, "?", 1), F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(head, "^([^/]*)", 1)), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(head, "^[^/]*(.*)$", 1), "/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.substring_index(p, "=", 1).isin(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _with_header(headers: Column, entry: Column) -> Column:
    """Adds a header under its name in lower case; of names that differ in case only the last counts."""
    name = F.lower(entry["key"])
    return F.map_concat(F.map_filter(headers, lambda k, _: k != name), F.create_map(name, entry["value"]))


def resolved_revisits(captures: DataFrame) -> DataFrame:
    """One row for each revisit of captures (capture_id long, url string, at timestamp, revisit boolean, etag string,
    last_modified string, headers map<string,string>; other columns are not read): capture_id, url_key, at, response_id,
    status, headers.

    response_id is the capture_id of the latest full response of the canonical URL strictly before the revisit; of
    several at that time the one with the largest capture_id. status is "resolved" if the validators agree, "changed" if
    they don't, "orphan" without an earlier response. The ETag decides where both have one, weak or strong alike; else
    Last-Modified where both have one; else nothing contradicts. A resolved revisit has the response's headers,
    updated by the permitted ones it carries itself (names in lower case); others have their own headers.

    Captures without URL or time can't be placed: revisits among them are orphans. A null `revisit` is a full response.
    Null ids and null headers stay null in their place; rows that repeat give rows that repeat.
    """
    validator = F.regexp_replace("etag", '^W/', "")
    none = F.create_map().cast("map<string,string>")
    lower = F.when(F.col("headers").isNotNull(), F.aggregate(F.map_entries("headers"), none, _with_header))
    rows = captures.select(
        F.col("capture_id").cast("long"), canonical_url(F.col("url")).alias("url_key"), "at",
        F.coalesce("revisit", F.lit(False)).alias("revisit"), validator.alias("etag"), "last_modified", lower.alias("headers"),
    )
    placeable = F.col("url_key").isNotNull() & F.col("at").isNotNull()
    response = F.struct(
        F.col("at").alias("r_at"), F.col("capture_id").alias("response_id"), F.col("etag").alias("r_etag"),
        F.col("last_modified").alias("r_last_modified"), F.col("headers").alias("r_headers"),
    )
    placed = rows.filter(placeable).withColumn("slice", F.floor(F.unix_timestamp("at") / SLICE)).withColumn(
        "response", F.when(~F.col("revisit"), response)
    )
    instants = placed.groupBy("url_key", "slice", "at").agg(
        F.max_by("response", F.when(~F.col("revisit"), F.struct("capture_id"))).alias("own"), F.max("revisit").alias("asked")
    )
    # A response at the very time of a revisit comes after it.
    inside = Window.partitionBy("url_key", "slice").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = instants.groupBy("url_key", "slice").agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("at"))).alias("latest"))
    carried = slices.select("url_key", "slice", F.last("latest", ignorenulls=True).over(over).alias("far"))
    located = (
        instants.withColumn("near", F.last("own", ignorenulls=True).over(inside)).filter("asked")
        .join(carried, ["url_key", "slice"], "left").select("url_key", "at", F.coalesce("near", "far").alias("response"))
    )
    joined = placed.filter("revisit").drop("slice", "response").join(located, ["url_key", "at"], "left")
    unplaced = rows.filter(~placeable & F.col("revisit")).withColumn("response", F.lit(None).cast(joined.schema["response"].dataType))
    columns = ["capture_id", "url_key", "at", "etag", "last_modified", "headers", "response"]
    merged = joined.select(*columns).unionByName(unplaced.select(*columns))
    agrees = F.coalesce(F.col("etag") == F.col("response.r_etag"), F.col("last_modified") == F.col("response.r_last_modified"), F.lit(True))
    status = F.when(F.col("response").isNull(), "orphan").when(agrees, "resolved").otherwise("changed")
    own, base = F.coalesce("headers", none), F.coalesce("response.r_headers", none)
    news = F.map_filter(own, lambda k, _: k.isin(PERMITTED))
    updated = F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(news), k)), news)
    return merged.withColumn("status", status).select(
        "capture_id", "url_key", "at", F.col("response.response_id").alias("response_id"), "status",
        F.when(F.col("status") == "resolved", updated).otherwise(F.col("headers")).alias("headers"),
    )
