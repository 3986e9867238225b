"""WARC files and their not-modified revisits.

``write_records`` and ``read_records`` turn records into WARC/1.1 text and back, with Spark's
text source on either side, so files lie wherever Spark can read and may be compressed.

``resolve_revisits`` gives every revisit record the latest earlier full response of the same
canonical address, if its validators agree: an entity tag of both must be equal, else a date
of last change of both must be equal; where the two share neither, nothing vouches for the
revisit and it stays unresolved. Headers that a 304 response may carry replace those of the
full response, all others are kept.

The as-of join is a scan in order, not a join of pairs: records are range-partitioned by
address and time, so that one address with very many records spreads over partitions, the
last full response of each partition is handed on to the next one by a window over one row per
partition, and inside a partition a window carries it forward. Payloads are not moved; the
result refers to the record that holds the payload.

Records without an address or time resolve to nothing. At one time, full responses come
before revisits, and records follow each other by id. Repeated records are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.scratch import materialize, scratch_folder

#: Begins every record.
VERSION = "WARC/1.1\r\n"
#: Headers that a not-modified response may bring up to date.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Parameters of addresses that do not change what is answered.
TRACKING = "utm_[a-z]+|ref|sessionid"


def canonical_url(url: Column) -> Column:
    """The address without scheme, www., m., fragment, tracking parameters and closing slash."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    plain = F.regexp_replace(plain, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    plain = F.regexp_replace(plain, "^(www[.]|m[.])", "")
    plain = F.regexp_replace(plain, f"([?&])(({TRACKING})=[^&]*(&|$))+", "$1")
    plain = F.regexp_replace(plain, "[?&]+$", "")
    plain = F.regexp_replace(plain, "/+$", "")
    return plain


def warc_text(kind: Column, record_id: Column, url: Column, date: Column, headers: Column, body: Column) -> Column:
    """One record as text; ``headers`` are the lines of the HTTP head with the status line first."""
    http = F.concat(headers, F.lit("\r\n\r\n"), F.coalesce(body, F.lit("")))
    return F.concat(
        F.lit("WARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: <urn:record:"), record_id.cast("string"),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Date: "), F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(http).cast("string"),
        F.lit("\r\n\r\n"), http, F.lit("\r\n\r\n"),
    )


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write the column ``record`` (``warc_text``) as WARC files under ``path``."""
    lines = records.select(F.concat(F.lit(VERSION), "record").alias("value"))
    lines.write.option("lineSep", "\n").option("compression", compression).text(path)


def _field(name: str, head: Column) -> Column:
    found = F.regexp_extract(head, f"(?im)^{name}:[ \\t]*([^\\r\\n]*)", 1)
    return F.when(found != "", found)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files: type, id, address, time, status, HTTP head and body.

    Files are cut at the version line. A piece of a payload that looks like one has no
    record id of its own and is left out; the payload it was cut from is then shorter than
    its declared length, which ``complete`` tells.
    """
    rows = spark.read.option("lineSep", VERSION).text(path).where(F.length("value") > 0)
    head = F.substring_index("value", "\r\n\r\n", 1)
    rest = F.expr("substring(value, length(head) + 5)")
    parsed = rows.select("value", head.alias("head")).select("head", rest.alias("rest"))
    http = F.substring_index("rest", "\r\n\r\n", 1)
    parsed = parsed.select("head", "rest", http.alias("http"))
    body = F.regexp_replace(F.expr("substring(rest, length(http) + 5)"), "\\r\\n\\r\\n\\n?$", "")
    length = _field("Content-Length", F.col("head")).cast("long")
    return (
        parsed.select(
            _field("WARC-Type", F.col("head")).alias("warc_type"),
            F.regexp_extract("head", "WARC-Record-ID: <urn:record:([^>]*)>", 1).alias("record_id"),
            _field("WARC-Target-URI", F.col("head")).alias("url"),
            F.to_timestamp(_field("WARC-Date", F.col("head")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
            F.regexp_extract("http", "^HTTP/[0-9.]+ ([0-9]{3})", 1).cast("int").alias("status"),
            F.col("http").alias("http_head"),
            body.alias("body"),
            length.alias("length"),
        )
        .withColumn("complete", F.octet_length("http_head") + 4 + F.octet_length("body") == F.col("length"))
        .where("record_id != ''")
        .drop("length")
    )


def header_map(http_head: Column) -> Column:
    """The headers of an HTTP head by name in small letters; of repeated ones the last."""
    lines = F.filter(F.split(http_head, "\r\n"), lambda line: line.rlike("^[!-9;-~]+:"))
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.substring_index(line, ":", 1)).alias("key"),
            F.trim(F.regexp_replace(line, "^[^:]*:", "")).alias("value"),
        ),
    )
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]),
    )
    return F.map_from_entries(last)


def merged_headers(full: Column, revisit: Column) -> Column:
    """Headers of the full response, brought up to date where the revisit may do so."""
    update = F.map_filter(revisit, lambda name, _: name.isin(*PERMITTED))
    kept = F.map_filter(full, lambda name, _: ~F.array_contains(F.map_keys(update), name))
    return F.map_concat(kept, update)


def header_text(headers: Column) -> Column:
    """Headers as ``name: value``, sorted and joined by line ends."""
    return F.array_join(
        F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n"
    )


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Add to each of ``records(record_id, warc_type, url, captured, status, headers, ...)``:
    ``canonical``, ``outcome`` (full, resolved, mismatch, unverified, missing), ``refers_to``
    and ``merged``, the headers as they hold now (null where a revisit is not resolved)."""
    full = (F.col("warc_type") == "response") & (F.col("status") == 200)
    keyed = records.select(
        "*",
        canonical_url(F.col("url")).alias("canonical"),
        F.coalesce(full, F.lit(False)).alias("is_full"),
    )
    order = ["captured", F.col("is_full").desc(), "record_id"]
    n = max(1, int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = keyed.repartitionByRange(n, "canonical", *order).select("*", F.spark_partition_id().alias("part"))
    stored = materialize(ranged, "warc_records")
    able = F.col("is_full") & F.col("canonical").isNotNull() & F.col("captured").isNotNull()
    latest = F.when(able, F.struct("record_id", "headers"))

    # the last full response of each partition's last address, one row per partition
    place = F.struct("canonical", "captured", F.when(F.col("is_full"), 0).otherwise(1), "record_id")
    ends = stored.groupBy("part").agg(
        F.min("canonical").alias("first_address"),
        F.max(F.when(able, place)).alias("last_place"),
    )
    last_full = stored.where(able).select("part", place.alias("last_place"), latest.alias("handed"))
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "part", "first_address", F.max("last_place").over(over).alias("last_place")
    ).where(F.col("last_place.canonical") == F.col("first_address"))
    handed = materialize(
        carried.join(last_full.drop("part"), "last_place").select(
            F.col("part").alias("to_part"), F.col("first_address").alias("to_address"), "handed"
        ).dropDuplicates(["to_part"]),
        "warc_handed",
    )
    inside = Window.partitionBy("part", "canonical").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    seen = stored.withColumn("inside", F.last(latest, ignorenulls=True).over(inside))
    joined = seen.join(
        handed, (F.col("part") == F.col("to_part")) & (F.col("canonical") == F.col("to_address")), "left"
    )
    before = F.coalesce("inside", "handed")
    known = F.col("captured").isNotNull() & F.col("canonical").isNotNull()
    joined = joined.withColumn("before", F.when(known, before))
    mine, theirs = F.col("headers"), F.col("before.headers")
    tags = mine["etag"], theirs["etag"]
    dates = mine["last-modified"], theirs["last-modified"]
    both = lambda pair: pair[0].isNotNull() & pair[1].isNotNull()
    outcome = (
        F.when(F.coalesce(F.col("warc_type"), F.lit("")) != "revisit", F.lit("full"))
        .when(F.col("before").isNull(), F.lit("missing"))
        .when(both(tags), F.when(tags[0] == tags[1], F.lit("resolved")).otherwise(F.lit("mismatch")))
        .when(both(dates), F.when(dates[0] == dates[1], F.lit("resolved")).otherwise(F.lit("mismatch")))
        .otherwise(F.lit("unverified"))
    )
    judged = joined.withColumn("outcome", outcome)
    resolved = F.col("outcome") == "resolved"
    return judged.select(
        *records.columns,
        "canonical",
        "outcome",
        F.when(resolved, F.col("before.record_id")).alias("refers_to"),
        F.when(resolved, merged_headers(theirs, mine)).when(F.col("outcome") == "full", mine).alias("merged"),
    )


def crawl_of(pages: DataFrame) -> DataFrame:
    """Two captures of every page, as WARC text: the answer itself, and a conditional request
    an hour and a half later that was answered with 304, or for every fifth page in full.

    The entity tag is a digest of the content. By ``page_id`` mod 5 the later request is
    answered with the same tag (0), the date of last change alone (1), another tag (2), no
    validator at all (3) or in full (4). A page's time is its id in seconds.
    """
    kind = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(5))
    html = F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.md5(html.cast("binary")), F.lit('"'))
    base = F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + F.lit(1_600_000_000))
    later = F.timestamp_seconds(F.coalesce("page_id", F.lit(0)) + F.lit(1_600_005_400))
    changed = F.concat(F.lit("Last-Modified: "), F.length(html).cast("string"))
    ok = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nServer: a\r\nETag: "), tag, F.lit("\r\n"), changed)
    not_modified = F.lit("HTTP/1.1 304 Not Modified\r\nServer: b\r\nCache-Control: max-age=60")
    revisit = (
        F.when(kind == 0, F.concat(not_modified, F.lit("\r\nETag: "), tag))
        .when(kind == 1, F.concat(not_modified, F.lit("\r\n"), changed))
        .when(kind == 2, F.concat(not_modified, F.lit('\r\nETag: "other"')))
        .when(kind == 3, not_modified)
        .otherwise(ok)
    )
    number = F.coalesce("page_id", F.lit(0)) * 2
    again = F.when(kind == 4, F.lit("response")).otherwise(F.lit("revisit"))
    first = warc_text(F.lit("response"), number, F.col("url"), base, ok, html)
    second = warc_text(again, number + 1, F.col("url"), later, revisit, F.when(kind == 4, html))
    return pages.select(F.explode(F.array(first, second)).alias("record"))


def revisits(spark: SparkSession, pages: DataFrame, name: str) -> DataFrame:
    """Write the crawl of ``pages`` as WARC files, read them and resolve their revisits."""
    path = f"{scratch_folder(spark)}/tillroll/{spark.sparkContext.applicationId}/{name}"
    write_records(crawl_of(pages), path)
    records = read_records(spark, path).select(
        F.col("record_id").cast("long").alias("record_id"),
        "warc_type",
        "url",
        "captured",
        "status",
        header_map(F.col("http_head")).alias("headers"),
        F.when(F.col("status") == 200, F.md5(F.col("body").cast("binary"))).alias("payload_md5"),
    )
    return resolve_revisits(records).select(
        "record_id",
        "canonical",
        F.unix_timestamp("captured").alias("captured_at"),
        "status",
        "payload_md5",
        "outcome",
        "refers_to",
        header_text(F.col("merged")).alias("merged_headers"),
    )
