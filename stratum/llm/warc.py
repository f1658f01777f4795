r"""WARC records, and resolution of not-modified revisits.

A crawler that gets "304 Not Modified" stores a revisit record without a payload.
What the page was then is the latest earlier full response for the same canonical URL:
an as-of join.  A revisit is resolved if its validators agree with that response's (ETag by weak
comparison, else Last-Modified; none: nothing to check), and takes that response's status
and payload, and its headers with those that a 304 may update replaced by the revisit's.

The as-of join keeps to narrow rows (URL, time, id), one a time of a URL, and splits a URL by hours and
seconds (:func:`with_base`), so a URL that holds a third of all records, or a busy hour of one, is spread.
Payloads meet their revisits last, by record id, in a join
of a stored table that Spark splits where many revisits share one response.

Records are read from and written to WARC/1.1 bytes, one record per row; names of headers are
compared without case.

Defined results: a revisit without an earlier response is ``no-base``, one whose validators
disagree is ``validator-mismatch`` (both without payload), any other is ``resolved``; a response of the same time
is not earlier; of responses at one time the one of the largest id counts; a revisit without URL or date has no base; a
response without URL, date or id is no one's base; repeated revisits each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

#: The headers that a 304 response updates, and parameters that only track.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = "utm_[^=&]*|ref|fbclid|gclid|sessionid"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
HEADERS = "array<struct<name:string,value:string>>"


def canonical_url(url: Column) -> Column:
    """Scheme, 'www.', default port, fragment, tracking parameters, parameter order and a last '/' make no difference;
    nor does the case of the host."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, "\\?(.*)$", 1), "&"),
                                  lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def header(headers: str, name: str) -> Column:
    """The first value of a header; NULL without."""
    return F.get(F.filter(F.col(headers), lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def merged(base: Column, revisit: Column) -> Column:
    """The stored headers, those that the revisit may update replaced by its own, which come last."""
    fresh = F.filter(revisit, lambda h: F.lower(h["name"]).isin(*PERMITTED))
    names = F.transform(fresh, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(base, lambda h: ~F.array_contains(names, F.lower(h["name"]))), fresh)


def write_records(records: DataFrame) -> DataFrame:
    """(record_id, record): WARC/1.1 bytes of rows (record_id, type, url, date, status, headers, payload)."""
    line = "\r\n"
    head = F.array_join(F.transform(F.coalesce("headers", F.array().cast(HEADERS)),
                                    lambda h: F.concat(h["name"], F.lit(": "), h["value"], F.lit(line))), "")
    http = F.concat(F.lit("HTTP/1.1 "), F.col("status").cast("string"), F.lit(line), head, F.lit(line),
                    F.coalesce("payload", F.lit("")))
    profile = F.when(F.col("type") == "revisit", f"WARC-Profile: {REVISIT_PROFILE}{line}").otherwise("")
    warc = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "), F.col("type"),
        F.coalesce(F.concat(F.lit(f"{line}WARC-Target-URI: "), F.col("url")), F.lit("")),
        F.coalesce(F.concat(F.lit(f"{line}WARC-Date: "), F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")), F.lit("")),
        F.lit(line), profile, F.lit("Content-Length: "), F.octet_length(http).cast("string"), F.lit(line + line))
    return records.select("record_id", F.encode(F.concat(warc, http, F.lit(line + line)), "UTF-8").alias("record"))


def read_records(raw: DataFrame) -> DataFrame:
    """Rows (record_id, type, url, date, status, headers, payload) of (record_id, record) bytes; a field that a
    record lacks is NULL.  Bytes that are no UTF-8 are kept as they are."""
    gap = "\r\n\r\n"

    def after(text: str) -> Column:
        return F.expr(f"substr({text}, length(substring_index({text}, '\r\n\r\n', 1)) + 5)")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("warc", f"(?im)^{name}:[ \\t]*(.*?)\\r?$", 1), F.lit(""))

    text = raw.select("record_id", F.col("record").cast("string").alias("t"))
    cut = text.select("record_id", F.substring_index("t", gap, 1).alias("warc"), after("t").alias("block"))
    parts = cut.select(
        "record_id", field("WARC-Type").alias("type"), field("WARC-Target-URI").alias("url"),
        F.try_to_timestamp(field("WARC-Date"), F.lit("yyyy-MM-dd'T'HH:mm:ssX")).alias("date"),
        F.substring_index("block", gap, 1).alias("http"), after("block").alias("rest"))
    lines = F.filter(F.split("http", "\r\n"), lambda x: F.instr(x, ":") > 1)
    headers = F.transform(lines, lambda x: F.struct(
        F.substring_index(x, ":", 1).alias("name"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    return parts.select(
        "record_id", "type", "url", "date",
        F.regexp_extract("http", "^HTTP/\\S+ (\\d{3})", 1).try_cast("int").alias("status"),
        headers.cast(HEADERS).alias("headers"),
        # the empty line that ends a record is not part of its payload
        F.when(F.col("type") == "response", F.expr("substr(rest, 1, greatest(length(rest) - 4, 0))")).alias("payload"))


def with_base(revisits: DataFrame, responses: DataFrame) -> DataFrame:
    """``revisits`` (canonical, at, ...) with ``base_id``: the record_id of the latest response (record_id,
    canonical, at) before each; times in microseconds.

    Only times move: all that a URL has at one time is one row (a partial aggregate), and the latest response is looked for
    inside a second, among an hour's seconds, then among a URL's hours, so that no window holds more than one of
    these, however busy a URL or an hour is.  The revisits themselves are joined to their times once.
    """
    known = responses.where("canonical is not null and at is not null and record_id is not null")
    times = (known.select("canonical", "at", F.col("record_id").alias("full"), F.lit(False).alias("asks"))
             .unionByName(revisits.select("canonical", "at", F.lit(None).cast(known.schema["record_id"].dataType).alias("full"),
                                          F.lit(True).alias("asks")))
             .groupBy("canonical", "at").agg(F.max("full").alias("full"), F.max("asks").alias("asks"))
             .withColumns({"second": F.floor(F.col("at") / 1_000_000), "hour": F.floor(F.col("at") / 3_600_000_000),
                           "here": F.when(F.col("full").isNotNull(), F.struct("at", "full"))}))

    def before(rows: DataFrame, within: list[str], order: str, out: str) -> DataFrame:
        earlier = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.max("here").over(earlier))

    seconds = times.groupBy("canonical", "hour", "second").agg(F.max("here").alias("here"))
    hours = times.groupBy("canonical", "hour").agg(F.max("here").alias("here"))
    # what earlier seconds of the hour, and earlier hours, leave behind
    left = (before(seconds, ["canonical", "hour"], "second", "in_hour").drop("here")
            .join(before(hours, ["canonical"], "hour", "so_far").drop("here"), ["canonical", "hour"]))
    found = (before(times, ["canonical", "second"], "at", "in_second").where("asks").drop("hour", "here", "full")
             .join(left, ["canonical", "second"])
             .select("canonical", "at", F.coalesce("in_second", "in_hour", "so_far")["full"].alias("base_id")))
    return revisits.join(stored(found, "warc-bases"), ["canonical", "at"]).select(*revisits.columns, "base_id")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row per revisit record: record_id, canonical, base_id, outcome, status, headers, payload.

    ``records``: record_id, type, url, date, status, headers, payload, as from :func:`read_records`.
    """
    known = records.select("record_id", "type", canonical_url(F.col("url")).alias("canonical"),
                           F.unix_micros("date").alias("at"), "status", "headers", "payload")
    # records are parsed once for what the as-of join needs, and once for payloads
    light = stored(known.where("type in ('response', 'revisit')").select(
        "record_id", "type", "canonical", "at", "status",
        F.when(F.col("type") == "revisit", F.col("headers")).alias("headers")), "warc-light")
    responds = (F.col("type") == "response") & (F.coalesce("status", F.lit(0)) != 304)
    full = known.where(responds)
    asks = light.where("type = 'revisit'").select("record_id", "canonical", "at", "headers")
    placed = F.col("canonical").isNotNull() & F.col("at").isNotNull()
    told = with_base(asks.where(placed), light.where(responds).select("record_id", "canonical", "at")).unionByName(
        asks.where(~placed).withColumn("base_id", F.lit(None).cast(full.schema["record_id"].dataType)))
    base = full.where("record_id is not null").select(
        F.col("record_id").alias("base_id"), F.col("status").alias("base_status"),
        F.col("headers").alias("base_headers"), "payload")
    joined = stored(told, "warc-told").join(base, "base_id", "left")

    def weak(h: str) -> Column:
        return F.regexp_replace(header(h, "etag"), "^W/", "")

    def dated(h: str) -> Column:
        return header(h, "last-modified")

    same = (F.when(weak("headers").isNotNull(), weak("headers").eqNullSafe(weak("base_headers")))
            .when(dated("headers").isNotNull(), dated("headers").eqNullSafe(dated("base_headers"))).otherwise(F.lit(True)))
    outcome = F.when(F.col("base_id").isNull(), "no-base").when(same, "resolved").otherwise("validator-mismatch")
    good, none = F.col("outcome") == "resolved", F.array().cast(HEADERS)
    return joined.withColumn("outcome", outcome).select(
        "record_id", "canonical", "base_id", "outcome", F.when(good, F.col("base_status")).alias("status"),
        F.when(good, merged(F.coalesce("base_headers", none), F.coalesce("headers", none))).alias("headers"),
        F.when(good, F.col("payload")).alias("payload"))
