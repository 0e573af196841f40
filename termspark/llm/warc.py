"""Resolution of not-modified revisits in web archives.

A crawl that was answered "304 Not Modified" leaves a revisit record without a body. It stands for the
latest full response of the same canonical URL before it, if that one's validators (entity tag,
modification time) are those that the server confirmed; its headers are then the stored ones, updated
by the permitted headers of the revisit.

The as-of join sorts all records once by (canonical URL, time) into range partitions, so that the
records of a very frequent URL spread over many. A record finds its response inside its own range, or
else through a small table with the last response of each URL in each range. Bodies take no part; they
are joined back by record id where wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termspark.llm.common import read_once

# --- fixed values: headers that a 304 response may update (RFC 9111, section 3.2; RFC 9110, section 15.4.5) ---
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# query parameters that do not name a resource
TRACKING = "utm_[a-z]+|gclid|fbclid|ref|sessionid|phpsessid"
# --- end of fixed values ---

_PARTITION_BIT = 33


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no ``www.``, default port, fragment, tracking parameters or last slash.

    ``http`` and ``https`` are one scheme; parameters are sorted. NULL stays NULL.
    """
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^[A-Za-z]+://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[A-Za-z]+://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(plain, r"[?](.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~F.lower(p).rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _tag(column: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(column, "^W/", "")


def last_response(records: DataFrame) -> DataFrame:
    """``records(canonical, ts, full, record_id, ...)`` with ``found``: the latest full one before, as a struct.

    Before means an earlier ``ts``; of responses at one time the largest record_id counts. Records
    with a NULL canonical URL or time find nothing.
    """
    columns = records.columns
    order = ["canonical", "ts", "full", "record_id"]
    at = F.monotonically_increasing_id()
    placed, _ = read_once(
        records.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_at": at, "_piece": F.shiftright(at, _PARTITION_BIT)}),
        "ranges",
    )
    response = F.when(F.col("full") & F.col("ts").isNotNull(), F.struct(*columns))
    # revisits sort before responses of the same time; a group is one URL's share of one range
    before = Window.partitionBy("canonical", "_piece").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("_own", F.last(response, ignorenulls=True).over(before))
    ends = placed.filter("full and canonical is not null and ts is not null").groupBy("canonical", "_piece")
    ends = ends.agg(F.max_by(F.struct(*columns), "_at").alias("_end"))
    # all (URL, range) pairs of URLs that span ranges: at most two URLs for each range
    pieces = placed.groupBy("canonical", "_piece").agg(F.count("*").alias("_n")).drop("_n")
    earlier = Window.partitionBy("canonical").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.join(ends, ["canonical", "_piece"], "left").withColumn(
        "_carried", F.last("_end", ignorenulls=True).over(earlier)
    )
    carried = carried.filter("_carried is not null").select(
        F.col("canonical").alias("_c"), F.col("_piece").alias("_p"), "_carried"
    )
    joined = inside.join(carried, (F.col("canonical") == F.col("_c")) & (F.col("_piece") == F.col("_p")), "left")
    found = F.when(F.col("canonical").isNotNull() & F.col("ts").isNotNull(), F.coalesce("_own", "_carried"))
    return joined.select(*columns, found.alias("found"))


def resolve_revisits(records: DataFrame, permitted: tuple[str, ...] = PERMITTED) -> DataFrame:
    """One row per revisit of ``records(record_id, url, ts, status, headers)``.

    ``headers`` is a map with lower-case names. Records with status 304 are revisits, those with
    200 full responses; others take no part. Columns: revisit_id, canonical, response_id, outcome and
    headers. ``outcome`` is ``resolved``; ``no-response`` (nothing earlier); or ``changed`` (an entity
    tag or modification time of the revisit differs from the response's; a missing one on either side
    does not count, but one of them must be confirmed). ``headers`` are the response's with the
    permitted ones of the revisit in their place, for resolved revisits only.

    Repeated records stay. A NULL URL or time is ``no-response``, NULL headers are empty.
    """
    empty = F.create_map().cast("map<string,string>")
    slim = records.filter("status in (200, 304)").select(
        canonical_url(F.col("url")).alias("canonical"),
        "ts",
        (F.col("status") == 200).alias("full"),
        "record_id",
        F.coalesce("headers", empty).alias("headers"),
    )
    pairs = last_response(slim).filter(~F.col("full"))
    now, then = F.col("headers"), F.col("found.headers")
    checks = [
        (_tag(now["etag"]), _tag(then["etag"])),
        (now["last-modified"], then["last-modified"]),
    ]
    differs, confirmed = F.lit(False), F.lit(False)
    for a, b in checks:
        differs = differs | F.coalesce(a != b, F.lit(False))
        confirmed = confirmed | F.coalesce(a == b, F.lit(False))
    outcome = F.when(F.col("found").isNull(), "no-response").when(differs | ~confirmed, "changed").otherwise("resolved")
    updates = F.map_filter(now, lambda k, v: k.isin(*permitted))
    merged = F.map_concat(F.map_filter(then, lambda k, v: ~F.map_contains_key(updates, k)), updates)
    return pairs.select(
        F.col("record_id").alias("revisit_id"),
        "canonical",
        F.when(outcome == "resolved", F.col("found.record_id")).alias("response_id"),
        outcome.alias("outcome"),
        F.when(outcome == "resolved", merged).alias("headers"),
    )
