"""Not-modified revisits of a web archive resolved against the full responses they confirm.

An as-of join by canonical URL: each revisit meets the latest earlier full response of its URL. If the validators agree, the stored
headers are updated by those of the revisit, save the ones that a not-modified answer must not change. One URL may hold a third of
all records, and these may crowd into an hour: time is cut at quantiles of all records, so no stretch holds many more than another. Rows
are ordered inside (URL, stretch) only, and what a stretch needs from before is one row per stretch. A moment that fills a stretch is
one by itself; no record of it is earlier than another, so its rows are dealt by hash.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

STRETCHES = 1024
# Query parameters that only trace visitors; header fields that a 304 answer does not update, or that belong to one hop.
TRACKING = ("ref", "fbclid", "gclid", "mc_cid", "mc_eid")
UNCHANGED = (
    "content-encoding", "content-length", "content-range", "content-type", "connection", "keep-alive", "proxy-authenticate",
    "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, user, www., standard port, fragment, index page, closing slash and tracking; parameters sorted."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    site = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    site = F.regexp_replace(F.regexp_replace(F.regexp_replace(site, "^.*@", ""), "^www\\.", ""), ":(80|443)$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^?]*", 0), r"/index\.html?$", "/"), "/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    traced = "^(utm_[^=]*|" + "|".join(TRACKING) + ")(=|$)"
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(traced))), "&")
    return F.concat(site, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def _field(headers: Column, name: str) -> Column:
    return F.element_at(headers, name)


def cuts(rows: DataFrame, stretches: int) -> tuple[list[int], list[int]]:
    """Where the stretches of ``ts`` begin, at its quantiles, and the stretches that hold one moment only.

    A quantile that comes twice is a moment with more rows than a stretch should have; it gets a stretch of its own.
    """
    shares = [i / stretches for i in range(1, stretches)]
    found = rows.agg(F.percentile_approx("ts", shares, 10 * stretches)).first()[0] or []
    many = {a for a, b in zip(found, found[1:]) if a == b}
    starts = sorted({*found, *(m + 1 for m in many if m < (1 << 63) - 1)})
    return starts, [i + 1 for i, at in enumerate(starts) if at in many]


def _stretch_of(starts: list[int]) -> Callable[[Column], Column]:
    table = np.array(starts, dtype=np.int64)

    @F.pandas_udf("int")
    def of(ts: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(table, ts.to_numpy(dtype=np.int64), side="right").astype(np.int32))

    return of


def resolve_revisits(records: DataFrame, stretches: int = STRETCHES) -> DataFrame:
    """One row for each revisit: record_id, url_key, ts, response_id, outcome, headers, digest.

    ``records`` has record_id, url, ts (bigint), kind ('response' or 'revisit'), status, headers (map of lower-case names) and digest;
    other columns are ignored. A full response has kind 'response' and status 200. Of responses at one moment the largest record_id
    counts; a response at the moment of the revisit is not earlier. Outcomes: 'resolved'; 'mismatch' if a validator that both have
    differs (etag first, by weak comparison, else last-modified); 'unverified' if no validator is on both sides; 'missing' without
    an earlier response, or if url or ts is null. Only resolved rows have headers and digest of the response, the headers
    merged; other rows have their own headers. Null headers count as empty.
    """
    no_headers = F.create_map().cast("map<string,string>")
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("bigint").alias("ts"), (F.col("kind") == "revisit").alias("revisit"),
        F.col("status").cast("int").alias("status"), F.coalesce("headers", no_headers).alias("headers"), "digest",
    )
    rows = rows.where(F.col("revisit") | (F.col("status") == 200))
    starts, moments = cuts(rows, stretches)
    stretch = F.when(F.col("ts").isNotNull(), _stretch_of(starts)(F.coalesce("ts", F.lit(0))))
    placed = rows.withColumn("stretch", stretch).withColumn(
        "full", F.when(~F.col("revisit") & F.col("ts").isNotNull() & F.col("url_key").isNotNull(), F.struct("ts", "record_id", "headers", "digest"))
    )
    dealt = F.col("stretch").isNull() | F.col("stretch").isin(moments) if moments else F.col("stretch").isNull()
    placed = placed.withColumn("part", F.when(dealt, F.pmod(F.xxhash64("record_id"), F.lit(stretches))))
    # the last response of each stretch, handed on to the next stretches that have rows
    ends = placed.groupBy("url_key", "stretch").agg(F.max_by("full", F.when(F.col("full").isNotNull(), F.struct("ts", "record_id"))).alias("own"))
    before = F.last("own", ignorenulls=True).over(Window.partitionBy("url_key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    handed = ends.select("url_key", "stretch", before.alias("handed"))
    # at one moment revisits come first, so that they do not see its responses
    order = Window.partitionBy("url_key", "stretch", "part").orderBy("ts", F.col("revisit").cast("int").desc(), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = placed.withColumn("inside", F.last("full", ignorenulls=True).over(order)).where("revisit")
    same = seen["url_key"].eqNullSafe(handed["url_key"]) & seen["stretch"].eqNullSafe(handed["stretch"])
    met = seen.join(handed, same, "left").select(
        "record_id", seen["url_key"], "ts", seen["headers"], F.when(F.col("ts").isNotNull() & seen["url_key"].isNotNull(), F.coalesce("inside", "handed")).alias("found")
    )
    stored = F.col("found.headers")
    tag, had_tag = (F.regexp_replace(_field(h, "etag"), "^W/", "") for h in (F.col("headers"), stored))
    date, had_date = (_field(h, "last-modified") for h in (F.col("headers"), stored))
    agrees = F.coalesce(tag == had_tag, date == had_date)
    outcome = F.when(F.col("found").isNull(), "missing").when(agrees.isNull(), "unverified").when(agrees, "resolved").otherwise("mismatch")
    update = F.map_filter("headers", lambda k, v: ~k.isin(*UNCHANGED))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)
    resolved = F.col("outcome") == "resolved"
    return met.withColumn("outcome", outcome).select(
        "record_id", "url_key", "ts", F.col("found.record_id").alias("response_id"), "outcome",
        F.when(resolved, merged).otherwise(F.col("headers")).alias("headers"), F.when(resolved, F.col("found.digest")).alias("digest"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Archive records derived from pages: for each page a full response, and a later not-modified revisit of it.

    Some revisits name the page by another spelling of its URL, some carry only a date or an old tag or neither, some come before
    any response.
    """
    p = F.col("page_id")
    digest = F.md5(F.coalesce("html", F.lit("")))
    date = F.concat(F.lit("day-"), F.floor(p / 100).cast("string"))
    full = F.create_map(
        F.lit("content-type"), F.lit("text/html"), F.lit("etag"), digest, F.lit("last-modified"), date,
        F.lit("content-length"), F.length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("cache-control"), F.lit("max-age=60"),
    )
    answer = F.map_concat(
        F.create_map(F.lit("date"), (p * 10).cast("string"), F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.concat(F.lit("max-age="), (p % 600).cast("string"))),
        F.when(p % 3 == 0, F.create_map(F.lit("etag"), F.when(p % 5 == 0, F.lit("old")).otherwise(F.concat(F.lit("W/"), digest))))
        .when(p % 3 == 1, F.create_map(F.lit("last-modified"), date))
        .otherwise(F.create_map().cast("map<string,string>")),
    )
    spelling = F.when(p % 2 == 0, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))).otherwise(F.col("url"))
    response = pages.select((p * 2).alias("record_id"), "url", (p * 10).alias("ts"), F.lit("response").alias("kind"), F.lit(200).alias("status"), full.alias("headers"), digest.alias("digest"))
    late = F.when(p % 13 == 0, p * 10 - 1).otherwise(p * 10 + 5 + (p % 7) * 20000)
    revisit = pages.select((p * 2 + 1).alias("record_id"), spelling.alias("url"), late.alias("ts"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"), answer.alias("headers"), F.lit(None).cast("string").alias("digest"))
    return response.unionByName(revisit)


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
    told = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "; ")
    return found.select("record_id", "url_key", "ts", "response_id", "outcome", told.alias("headers"), "digest")


SQL = r"""
WITH pages2 AS (SELECT page_id AS p, url, md5(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS n, 'day-' || (page_id // 100) AS date FROM pages),
records AS (
  SELECT 2 * p AS record_id, url, 10 * p AS ts, false AS revisit, digest, n, digest AS etag, date AS modified, 'max-age=60' AS cache, p FROM pages2
  UNION ALL
  SELECT 2 * p + 1, CASE WHEN p % 2 = 0 THEN regexp_replace(url, '#.*$', '') || '#again' ELSE url END,
         CASE WHEN p % 13 = 0 THEN 10 * p - 1 ELSE 10 * p + 5 + (p % 7) * 20000 END, true, NULL, 0,
         CASE WHEN p % 3 = 0 THEN CASE WHEN p % 5 = 0 THEN 'old' ELSE 'W/' || digest END END, CASE WHEN p % 3 = 1 THEN date END, 'max-age=' || (p % 600), p
  FROM pages2),
parts AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS bare FROM records),
split AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^.*@', ''), '^www\.', ''), ':(80|443)$', '') AS site,
          regexp_replace(bare, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest FROM parts),
keyed AS (SELECT *, site || regexp_replace(regexp_replace(regexp_extract(rest, '^[^?]*', 0), '/index\.html?$', '/'), '/+$', '') AS page,
          array_to_string(list_sort([x FOR x IN string_split(regexp_extract(rest, '\?(.*)$', 1), '&')
                                     IF x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)')]), '&') AS query FROM split),
r AS (SELECT *, page || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key FROM keyed),
met AS (SELECT v.record_id, v.url_key, v.ts, v.p, v.etag, v.modified, v.cache, f.record_id AS response_id, f.etag AS f_etag, f.modified AS f_modified, f.digest AS f_digest, f.n AS f_n
        FROM (SELECT * FROM r WHERE revisit) v ASOF LEFT JOIN (SELECT * FROM r WHERE NOT revisit) f ON v.url_key = f.url_key AND v.ts > f.ts),
judged AS (SELECT *, CASE WHEN response_id IS NULL THEN 'missing'
                          WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = f_etag THEN 'resolved' ELSE 'mismatch' END
                          WHEN modified IS NOT NULL THEN CASE WHEN modified = f_modified THEN 'resolved' ELSE 'mismatch' END
                          ELSE 'unverified' END AS outcome FROM met)
SELECT record_id, url_key, ts, response_id, outcome,
       CASE WHEN outcome = 'resolved'
            THEN 'cache-control: ' || cache || '; content-length: ' || f_n || '; content-type: text/html; date: ' || (10 * p)
                 || '; etag: ' || coalesce(etag, f_etag) || '; last-modified: ' || coalesce(modified, f_modified)
            ELSE 'cache-control: ' || cache || '; content-length: 0; date: ' || (10 * p)
                 || CASE WHEN etag IS NOT NULL THEN '; etag: ' || etag ELSE '' END || CASE WHEN modified IS NOT NULL THEN '; last-modified: ' || modified ELSE '' END
       END AS headers,
       CASE WHEN outcome = 'resolved' THEN f_digest END AS digest
FROM judged
"""
