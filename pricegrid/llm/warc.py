"""Not-modified revisits of a crawl, resolved to the response they stand for.

A ``revisit`` record (304) carries no body; it stands for the latest earlier full
response (status 200) of the same canonical url. That response counts only if the
validators agree: entity tags by weak comparison if both have one, else
Last-Modified if both have one. The resolved record has the response's headers with
those that a 304 may renew (``PERMITTED``) taken from the revisit.

The as-of join holds no url in one task: records, without bodies, are
range-partitioned by (url, time), so a url with a third of all records spans many
partitions; a window inside (partition, url) finds the latest response, and what a
url's earlier partitions end with is carried over by a table of one row per
partition and url.

Status: ``resolved``, ``mismatch`` (validators differ), ``unverified`` (no common
validator; the response is named, the headers are not merged) or ``missing`` (no
earlier response).

Edge cases: a revisit without uri or date is ``missing``; records of one time are
ordered by record_id, a response of the same time with a smaller id counts as
earlier; null headers are empty; header names compare in lower case (of names that
differ in case alone, the one that sorts last counts); repeated records resolve each; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.session import cut_lineage

#: Fixed: headers that a 304 response may renew.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical(uri) -> Column:
    """Host and path as an index key: no scheme, ``www.``, default port, fragment,
    ``utm_`` parameters or closing slash; host in lower case. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(uri, r"#[\s\S]*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/$", "")
    kept = F.filter(F.split(F.regexp_extract(bare, r"^[^?]*[?]([\s\S]*)$", 1), "&"), lambda p: ~p.startswith("utm_") & (p != ""))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower_names(headers) -> Column:
    pairs = F.transform(F.array_sort(F.map_entries(F.coalesce(headers, F.expr("map()").cast("map<string,string>")))),
                        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(pairs, lambda e: e["key"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n.alias("key"), F.element_at(F.filter(pairs, lambda e: e["key"] == n), -1)["value"].alias("value"))))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records`` (record_id, kind, uri, date, status,
    headers map, digest): record_id, uri_key, state, source_id, digest of the
    response, headers (merged, if resolved)."""
    rows = records.where("kind = 'revisit' or (kind = 'response' and status = 200)").select(
        "record_id", canonical(F.col("uri")).alias("uri_key"), "date", (F.col("kind") == "revisit").alias("revisit"),
        _lower_names(F.col("headers")).alias("headers"), "digest")
    placed = rows.where("uri_key is not null and date is not null")
    order = ["uri_key", "date", "record_id"]
    placed = cut_lineage(placed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "records")
    full = F.when(~F.col("revisit"), F.struct(F.col("record_id").alias("source_id"), F.col("headers").alias("of"), F.col("digest").alias("of_digest")))
    before = Window.partitionBy("part", "uri_key").orderBy("date", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = placed.withColumn("full", F.last(full, True).over(before)).where("revisit")
    ends = (placed.where("not revisit").groupBy("part", "uri_key")
            .agg(F.max_by(F.struct(F.col("record_id").alias("source_id"), F.col("headers").alias("of"), F.col("digest").alias("of_digest")),
                          F.struct("date", "record_id")).alias("end")))
    # urls that span partitions only: (part, url) pairs with the end of an earlier part
    parts = placed.groupBy("uri_key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    spans = (placed.select("uri_key", "part").distinct().join(parts.select("uri_key"), "uri_key")
             .join(ends, ["uri_key", "part"], "left"))
    earlier = Window.partitionBy("uri_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("uri_key", "part", F.last("end", True).over(earlier).alias("carried"))
    found = seen.join(carried, ["uri_key", "part"], "left").withColumn("full", F.coalesce("full", "carried"))
    lost = rows.where("revisit and (uri_key is null or date is null)").select("record_id", "uri_key", "headers")
    return _merged(found.select("record_id", "uri_key", "headers", "full.*").unionByName(lost, allowMissingColumns=True))


def _merged(found: DataFrame) -> DataFrame:
    tag = lambda h: F.regexp_replace(F.col(h)["etag"], "^W/", "")
    date = lambda h: F.col(h)["last-modified"]
    agrees = F.coalesce(tag("headers") == tag("of"), date("headers") == date("of"))
    state = (F.when(F.col("source_id").isNull(), "missing").when(agrees, "resolved").when(agrees.isNull(), "unverified").otherwise("mismatch"))
    renewed = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter("of", lambda k, _: ~F.array_contains(F.map_keys(renewed), k))
    return found.withColumn("state", state).select(
        "record_id", "uri_key", "state", "source_id", F.col("of_digest").alias("digest"),
        F.when(F.col("state") == "resolved", F.map_concat(kept, renewed)).alias("headers"))


def header_lines(headers) -> Column:
    """``name: value`` lines by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl's records derived from ``pages`` (page_id, url, html): each page is a
    response, most are revisited later, some before. Which validators a record has
    follows from page_id."""
    p, minute = F.col("page_id"), 60
    tag = F.concat(F.lit('"'), F.substring(F.sha2(F.coalesce("html", F.lit("")), 256), 1, 16), F.lit('"'))
    at = F.lit(1_700_000_000) + p * minute

    def record(kind: str, extra: int, uri, when, headers: dict) -> Column:
        names = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in headers.items()])
        given = F.map_from_entries(F.filter(names, lambda e: e["value"].isNotNull()))
        return F.struct((p * 4 + extra).alias("record_id"), F.lit(kind).alias("kind"), uri.alias("uri"), F.timestamp_seconds(when).alias("date"),
                        F.lit(200 if kind == "response" else 304).alias("status"), given.alias("headers"),
                        F.when(F.lit(kind == "response"), F.sha2(F.coalesce("html", F.lit("")), 256)).alias("digest"))

    changed = F.when(p % 5 != 2, at)
    response = record("response", 0, F.col("url"), at, {
        "Content-Type": F.lit("text/html"), "Date": at, "ETag": F.when(p % 7 != 3, tag), "Last-Modified": changed, "Cache-Control": F.lit("max-age=60")})
    later = at + (p % 11 + 1) * 3600
    sent = F.when(p % 13 == 5, F.lit('"stale"')).when(p % 4 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    revisit = record("revisit", 1, F.concat(F.col("url"), F.lit("#again")), later, {
        "Date": later, "ETag": F.when(p % 7 != 3, sent), "Last-Modified": changed, "Cache-Control": F.lit("max-age=120"), "Content-Length": F.lit("0")})
    early = record("revisit", 2, F.col("url"), at - 86_400, {"Date": at - 86_400, "ETag": tag})
    made = F.array_compact(F.array(response, F.when(p % 3 != 1, revisit), F.when(p % 17 == 4, early)))
    return pages.select(F.inline(made))
