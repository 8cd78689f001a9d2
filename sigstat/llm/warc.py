"""Not-modified revisits of a crawl resolved to the response that they stand for.

``records`` has record_id, url, ts (seconds), status, headers (map, names in lower case) and body. A revisit (status 304)
belongs to the latest full response (status 200) of the same canonical URL that is strictly earlier; of responses in the same
second the largest record_id counts. Its validators decide: an entity tag must equal the response's (weak comparison), else a
Last-Modified must be the same; without validators the answer is "unvalidated". The merged headers are the response's,
overlaid with the revisit's, but for those in ``HELD_BACK``.

The as-of join never sorts a URL as one group: responses and revisits are first reduced to one row for each URL and second,
ordered within (URL, day), which holds at most two rows a second, and each day's last response is carried on to the days
after it. A null URL or time matches nothing; null headers are no headers; a null body has no digest; revisits that repeat
are all answered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = 86_400
#: Fixed by the protocol: what a 304 must not change, with the headers of one connection.
HELD_BACK = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
]
#: Query parameters that only track.
TRACKING = "^(utm_[^=]*|ref|sessionid|sid)(=.*)?$"
HEADERS = "map<string,string>"


def canonical(url: Column) -> Column:
    """Host in lower case without www. and default port, path without closing slash, sorted query without tracking."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    parts = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(""))


def latest_before(responses: DataFrame, times: DataFrame, value: str) -> DataFrame:
    """As-of join of distinct (site, ts) rows: for every row of ``times`` the ``value`` of the latest strictly earlier response."""
    day = F.floor(F.col("ts") / DAY)
    both = responses.select("site", "ts", value, F.lit(1).alias("full")).unionByName(times.select("site", "ts", F.lit(0).alias("full")), allowMissingColumns=True)
    both = both.withColumn("day", day)
    order = W.partitionBy("site", "day").orderBy("ts", "full")
    inside = both.withColumn("found", F.last(value, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    asked = inside.filter("full = 0").select("site", "ts", "day", "found")
    days = responses.withColumn("day", day).groupBy("site", "day").agg(F.max_by(value, "ts").alias("closing"))
    open_ = asked.filter("found IS NULL").select("site", "day").distinct()
    steps = days.select("site", "day", "closing").unionByName(open_, allowMissingColumns=True).groupBy("site", "day").agg(F.first("closing", ignorenulls=True).alias("closing"))
    before = F.last("closing", ignorenulls=True).over(W.partitionBy("site").orderBy("day").rowsBetween(W.unboundedPreceding, -1))
    carried = steps.withColumn("carried", before).select("site", "day", "carried").filter("carried IS NOT NULL")
    return asked.join(carried, ["site", "day"], "left").select("site", "ts", F.coalesce("found", "carried").alias(value))


def _tag(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def verdict(revisit: Column, response: Column, found: Column) -> Column:
    """What the validators of two header maps say."""
    return (
        F.when(~found, "no earlier response")
        .when(revisit["etag"].isNotNull(), F.when(_tag(revisit["etag"]).eqNullSafe(_tag(response["etag"])), "same").otherwise("changed"))
        .when(revisit["last-modified"].isNotNull(), F.when(revisit["last-modified"].eqNullSafe(response["last-modified"]), "same").otherwise("changed"))
        .otherwise("unvalidated")
    )


def resolved(records: DataFrame) -> DataFrame:
    """Every revisit with site, verdict, the response's target_id, target_ts and body digest, and the merged headers.

    Digest and merged headers are null where the verdict is not "same" or "unvalidated".
    """
    none = F.from_json(F.lit("{}"), HEADERS)
    rows = records.select("record_id", canonical(F.col("url")).alias("site"), F.col("ts").cast("long").alias("ts"), "status", F.map_filter(F.coalesce("headers", none), lambda _, v: v.isNotNull()).alias("headers"), "body")
    known = F.col("site").isNotNull() & F.col("ts").isNotNull()
    full = rows.filter((F.col("status") == 200) & known)
    item = F.struct("record_id", "ts", "headers", F.sha2("body", 256).alias("digest"))
    responses = full.groupBy("site", "ts").agg(F.max_by(item, "record_id").alias("response"))
    revisits = rows.filter("status = 304").drop("body", "status")
    times = revisits.filter(known).select("site", "ts").distinct()
    answers = latest_before(responses, times, "response")
    joined = revisits.join(answers, ["site", "ts"], "left")
    response = F.col("response")
    said = verdict(F.col("headers"), response["headers"], response.isNotNull())
    good = said.isin("same", "unvalidated")
    update = F.map_filter("headers", lambda k, _: ~k.isin(HELD_BACK))
    merged = F.map_concat(F.map_filter(response["headers"], lambda k, _: ~F.map_contains_key(update, k)), update)
    return joined.select(
        "record_id", "site", "ts", said.alias("verdict"), response["record_id"].alias("target_id"), response["ts"].alias("target_ts"),
        F.when(good, response["digest"]).alias("digest"), F.when(good, merged).alias("headers"),
    )


def header_lines(headers: Column) -> Column:
    """Headers as sorted lines."""
    return F.array_join(F.sort_array(F.transform(F.map_entries(headers), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "\n")


def crawl(pages: DataFrame) -> DataFrame:
    """A crawl made of ``pages``: a minute apart, each fetched once in full and asked for again some hours later.

    By page_id modulo 5 the second answer repeats the entity tag, repeats it as a weak one, has only the date of the last
    change, has another tag, or comes a second too early.
    """
    n = F.col("page_id")
    first = (F.lit(1_700_000_000) + n * 60).cast("long")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    changed = first.cast("string")
    full = pages.select(
        (n * 2).alias("record_id"), "url", first.alias("ts"), F.lit(200).alias("status"),
        F.create_map(
            F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
            F.lit("etag"), tag, F.lit("last-modified"), changed, F.lit("cache-control"), F.lit("max-age=60"),
        ).alias("headers"),
        F.col("html").alias("body"),
    )
    kind = n % 5
    again = F.map_filter(
        F.create_map(
            F.lit("etag"), F.when(kind == 0, tag).when(kind == 1, F.concat(F.lit("W/"), tag)).when(kind == 3, F.lit('"other"')),
            F.lit("last-modified"), F.when(kind == 2, changed), F.lit("cache-control"), F.concat(F.lit("max-age="), n.cast("string")),
            F.lit("content-length"), F.lit("0"), F.lit("connection"), F.lit("close"),
        ),
        lambda _, v: v.isNotNull(),
    )
    back = pages.select(
        (n * 2 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"),
        F.when(kind == 4, first - 1).otherwise(first + 3600 * (1 + n % 48)).alias("ts"), F.lit(304).alias("status"), again.alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return full.unionByName(back)


def op9_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Every revisit of the crawl of ``pages`` with what it stands for; -1 where there is no earlier response."""
    found = resolved(crawl(spark.read.parquet(f"{folder}/pages.parquet")))
    ids = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("target_id", "target_ts")]
    return found.select("record_id", "site", "ts", "verdict", *ids, "digest", header_lines(F.col("headers")).alias("header_lines"))


SQL = r"""
WITH p AS (
  SELECT page_id AS n, 1700000000 + page_id * 60 AS first, coalesce(html, '') AS body, html, '"' || md5(coalesce(html, '')) || '"' AS tag,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM pages
), c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|sessionid|sid)(=.*)?$'))) AS parts
  FROM p
), s AS (
  SELECT *, place || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END AS site FROM c
), r AS (
  SELECT site, first AS ts, max(n) AS n FROM s GROUP BY ALL
), full_ AS (
  SELECT r.site, r.ts, r.n, s.tag, s.first::VARCHAR AS changed, sha256(s.html) AS digest, strlen(s.body) AS size FROM r JOIN s USING (n)
), v AS (
  SELECT n, site, tag, first, CASE WHEN n % 5 = 4 THEN first - 1 ELSE first + 3600 * (1 + n % 48) END AS ts,
    CASE n % 5 WHEN 0 THEN tag WHEN 1 THEN 'W/' || tag WHEN 3 THEN '"other"' END AS etag, CASE n % 5 WHEN 2 THEN first::VARCHAR END AS changed FROM s
), j AS (
  SELECT v.n, v.site, v.ts, v.etag, v.changed, f.n AS found, f.ts AS target_ts, f.tag AS old_tag, f.changed AS old_changed, f.digest, f.size
  FROM v ASOF LEFT JOIN full_ f ON v.site = f.site AND v.ts > f.ts
), w AS (
  SELECT *, CASE WHEN found IS NULL THEN 'no earlier response'
    WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = old_tag THEN 'same' ELSE 'changed' END
    WHEN changed IS NOT NULL THEN CASE WHEN changed = old_changed THEN 'same' ELSE 'changed' END
    ELSE 'unvalidated' END AS verdict FROM j
)
SELECT n * 2 + 1 AS record_id, site, ts, verdict, coalesce(found * 2, -1) AS target_id, coalesce(target_ts, -1) AS target_ts, CASE WHEN verdict IN ('same', 'unvalidated') THEN digest END AS digest,
  CASE WHEN verdict IN ('same', 'unvalidated') THEN 'cache-control: max-age=' || n || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html'
    || chr(10) || 'etag: ' || coalesce(etag, old_tag) || chr(10) || 'last-modified: ' || coalesce(changed, old_changed) END AS header_lines
FROM w
"""
