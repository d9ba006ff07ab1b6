"""Not-modified revisits of a crawl, resolved to the response that they confirm.

A revisit record says that a server answered "not modified". It is joined as of
its time with the latest earlier full response of the same canonical URL, its
validators are checked against that response, and the header fields that a
not-modified answer may change are merged into the stored ones.

Records are dealt by ranges of (URL, time), so a URL that holds a third of all
records is spread over many partitions; each partition looks back within
itself, and the last response of each (partition, URL) is carried into the
following ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwatch.llm.frames import materialise

# Fields that a not-modified answer does not change: fixed values.
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """The URL without scheme, ``www.``, default port, fragment, tracking parameters and closing slash.

    The host is lower-cased. Null stays null.
    """
    c = F.regexp_replace(url, "#.*$", "")
    c = F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(c, "^([^/?]*)", 1)), "^www\\.|:(80|443)$", "")
    rest = F.regexp_extract(c, "^[^/?]*(.*)$", 1)
    rest = F.regexp_replace(rest, "([?&])utm_[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "[?&]+$", ""), "([?&])&+", "$1")
    return F.concat(host, F.regexp_replace(rest, "/$", ""))


def _tag(etag: Column) -> Column:
    """The entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def _lowered(headers: Column) -> Column:
    return F.transform(
        F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )


def merged_headers(stored: Column, update: Column) -> Column:
    """Entries of both, sorted by name; permitted ones of ``update`` win."""
    allowed = F.filter(update, lambda e: ~e["key"].isin(*KEPT_FIELDS))
    names = F.transform(allowed, lambda e: e["key"])
    return F.array_sort(F.concat(F.filter(stored, lambda e: ~F.array_contains(names, e["key"])), allowed))


def resolved_revisits(
    records: DataFrame,
    *,
    record_id: str = "record_id",
    kind: str = "kind",
    url: str = "url",
    time: str = "ts",
    etag: str = "etag",
    last_modified: str = "last_modified",
    headers: str = "headers",
    payload: str = "payload_digest",
) -> DataFrame:
    """One row per revisit record: record_id, canonical, ts, status, response_id, headers, payload_digest.

    ``kind`` is ``response`` for a full response or ``revisit``; other kinds are
    left out. Times are longs; the response must be strictly earlier, and of
    several at one time the largest id counts. status is

    * ``resolved``: entity tags agree (weak comparison), or where one of them is
      missing, the modification dates do;
    * ``validator_mismatch``: a validator that both have differs;
    * ``no_validator``: they have none in common;
    * ``no_earlier_response``: nothing earlier, or no URL or time.

    Only resolved rows have headers (entries sorted by name, names in lower
    case) and a payload. Repeated rows stay; an empty table gives no rows.
    """
    rows = records.filter(F.col(kind).isin("response", "revisit")).select(
        F.col(record_id).alias("record_id"),
        (F.col(kind) == "response").alias("full"),
        canonical_url(F.col(url)).alias("canonical"),
        F.col(time).cast("long").alias("ts"),
        F.struct(
            F.col(record_id).alias("id"),
            F.col(etag).alias("etag"),
            F.col(last_modified).alias("last_modified"),
            _lowered(F.col(headers)).alias("headers"),
            F.col(payload).alias("payload"),
        ).alias("r"),
    )
    # Records of one URL and time stay in one range; the number is stored, so it is the same in every later pass.
    dealt = materialise(rows.repartitionByRange("canonical", "ts").withColumn("part", F.spark_partition_id()), "records")
    order = F.struct("ts", F.col("record_id"))
    answer = F.when(F.col("full"), F.struct(F.col("ts").alias("at"), F.col("r").alias("r")))
    usable = F.when(F.col("full"), order)
    before = Window.partitionBy("part", "canonical").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("found", F.max_by(answer, usable).over(before)).filter(~F.col("full"))

    ends = dealt.groupBy("canonical", "part").agg(F.max_by(answer, usable).alias("last"))
    earlier = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
        .filter(F.col("carried").isNotNull())
        .select("canonical", "part", "carried")
    )
    joined = local.join(carried, ["canonical", "part"], "left")
    there = F.when(F.col("canonical").isNotNull() & F.col("ts").isNotNull(), F.coalesce("found", "carried"))
    both = joined.withColumn("s", there["r"])
    tags = F.col("r.etag").isNotNull() & F.col("s.etag").isNotNull()
    dates = F.col("r.last_modified").isNotNull() & F.col("s.last_modified").isNotNull()
    status = (
        F.when(F.col("s").isNull(), "no_earlier_response")
        .when(tags, F.when(_tag(F.col("r.etag")) == _tag(F.col("s.etag")), "resolved").otherwise("validator_mismatch"))
        .when(dates, F.when(F.col("r.last_modified") == F.col("s.last_modified"), "resolved").otherwise("validator_mismatch"))
        .otherwise("no_validator")
    )
    done = both.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return done.select(
        "record_id",
        "canonical",
        "ts",
        "status",
        F.col("s.id").alias("response_id"),
        F.when(ok, merged_headers(F.col("s.headers"), F.col("r.headers"))).alias("headers"),
        F.when(ok, F.col("s.payload")).alias("payload_digest"),
    )
