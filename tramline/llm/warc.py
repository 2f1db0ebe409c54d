"""WARC records: reading and writing, and resolution of not-modified revisits.

A revisit with the server-not-modified profile has no body: the server answered 304 to a conditional request. It is joined as of its
date to the latest earlier full response of the same canonical URL; the validators (ETag by weak comparison, else Last-Modified) must
agree, and the headers that a 304 may change are merged into the stored ones.

The as-of join has two levels, so that a URL with a third of all captures is not one task: inside a (URL, period) by a window, and across
periods by each period's last full response, of which there is one row per URL and period.

Reading survives damage: a gzip member that can't be read, and a record with a wrong length, give a row with a status of their own, and reading goes on
at the next member or record.

Headers are merged where validators agree, or where the stored response has none that could be checked; a revisit without validators for a response that has
some stays unverified and keeps its own headers.

Defined results: a record without a URL or date resolves to nothing; of responses with equal date the larger record id is the later one;
a response of the same second is not earlier; repeated rows get equal results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import ship

PERIOD_SECONDS = 86_400
#: Header fields that describe the message or connection of the 304 itself and never replace stored ones.
NOT_MERGED = ["connection", "content-encoding", "content-length", "content-range", "keep-alive", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade"]
#: Query parameters that don't change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)"
RECORD = "record_id string, warc_type string, url string, date string, headers map<string,string>, body binary, status string"


def write_record(kind: str, fields: dict[str, str], http: bytes = b"") -> bytes:
    """One WARC/1.1 record, as its own gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in {"WARC-Type": kind, **fields, "Content-Length": str(len(http))}.items())
    return gzip.compress(f"WARC/1.1\r\n{head}\r\n".encode() + http + b"\r\n\r\n", mtime=0)


def _header_lines(f: io.BufferedIOBase) -> dict[str, str]:
    found, last = {}, None
    while (line := f.readline().rstrip(b"\r\n")) != b"":
        if line[:1] in b" \t" and last:
            found[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, _, value = line.decode("utf-8", "replace").partition(":")
        last = name.strip().lower()
        found[last] = f"{found[last]}, {value.strip()}" if last in found else value.strip()
    return found


MEMBER = b"\x1f\x8b\x08"
CHUNK = 1 << 16


def _member(data: bytes, at: int) -> tuple[bytes, int] | None:
    """Content of the gzip member at ``at`` and the place after it; None if it can't be read to its end."""
    reader, out = zlib.decompressobj(31), []
    while at < len(data):
        piece = data[at : at + CHUNK]
        try:
            out.append(reader.decompress(piece))
        except zlib.error:
            return None
        at += len(piece) - len(reader.unused_data)
        if reader.eof:
            return b"".join(out), at
    return None


def _members(data: bytes) -> Iterator[tuple[bytes | None, int]]:
    """(content, place) of all members; (None, place) for a stretch that can't be read."""
    at, lost = 0, False
    while 0 <= at < len(data):
        found = _member(data, at) if data[at : at + 3] == MEMBER else None
        if found and (not lost or found[0][:5] == b"WARC/"):  # after damage, only what looks like a record
            yield found[0], at
            at, lost = found[1], False
            continue
        if not lost:
            yield None, at
        lost = True
        at = data.find(MEMBER, at + 1)


def _records_in(block: bytes) -> Iterator[dict]:
    at = 0
    while 0 <= at < len(block):
        if not block.startswith(b"WARC/", at):
            at = block.find(b"\n", at) + 1 or len(block)
            continue
        f = io.BytesIO(block)
        f.seek(at)
        f.readline()
        own = _header_lines(f)
        row = {"record_id": own.get("warc-record-id"), "warc_type": own.get("warc-type"), "url": own.get("warc-target-uri"), "date": own.get("warc-date"), "headers": [], "body": None, "status": "ok"}
        length = own.get("content-length", "0")
        n = int(length) if length.isascii() and length.isdigit() else -1
        body = block[f.tell() : f.tell() + max(n, 0)]
        if n < 0 or len(body) < n:
            yield row | {"status": "wrong length"}
            at = block.find(b"\nWARC/", f.tell()) + 1 or len(block)
            continue
        at = f.tell() + n
        if "http" in own.get("content-type", ""):
            g = io.BytesIO(body)
            http = {":status": (g.readline().split(b" ") + [b""])[1].decode("ascii", "replace").strip(), **_header_lines(g)}
            row["headers"], body = list(http.items()), g.read()
        yield row | {"body": body}


def read_records(data: bytes | None) -> Iterator[dict]:
    """Records of a WARC file, gzipped or plain. ``status`` is ok, wrong length (the fields are there, the body isn't) or damaged (a member that can't be read)."""
    data = data or b""
    for block, _ in _members(data) if data[:2] == MEMBER[:2] else [(data, 0)]:
        if block is None:
            yield {"record_id": None, "warc_type": None, "url": None, "date": None, "headers": [], "body": None, "status": "damaged"}
        else:
            yield from _records_in(block)


def records(files: DataFrame, content: str = "content") -> DataFrame:
    """Records of WARC files in a binary column (as of Spark's binaryFile source)."""
    ship(files.sparkSession)
    schema = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("url", pa.string()), ("date", pa.string()), ("headers", pa.map_(pa.string(), pa.string())), ("body", pa.binary()), ("status", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                held, size = [], 0
                for r in read_records(data.as_py()):
                    held.append(r)
                    size += len(r["body"] or b"")
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.select(content).mapInArrow(run, RECORD)


def canonical_url(url: Column) -> Column:
    """Scheme and leading www. dropped, host lower-cased, default port, fragment, tracking parameters and trailing slash dropped, parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"(?s)^[^/?]*", 0)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_join(F.sort_array(F.filter(F.split(F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(f"(?i){TRACKING}"))), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve(captures: DataFrame, period_seconds: int = PERIOD_SECONDS) -> DataFrame:
    """Captures (record_id, warc_type, url, date timestamp, headers map of lower-case names) -> one row per revisit.

    (record_id, canonical_url, date, refers_to, verdict, headers): verdict is resolved, unverified (the revisit has no validators), mismatch or
    missing (no earlier full response); headers are merged where the verdict is resolved, or nothing could be checked, else the revisit's own.
    """
    own = captures.select("record_id", F.lower("warc_type").alias("kind"), canonical_url(F.col("url")).alias("canonical_url"), F.col("date").cast("timestamp").alias("date"), "headers")
    own = own.filter(F.col("kind").isin("response", "revisit"))
    own = own.withColumn("period", F.floor(F.unix_timestamp("date") / period_seconds))
    full = F.when((F.col("kind") == "response") & F.col("date").isNotNull() & F.col("canonical_url").isNotNull(), F.struct("date", "record_id", "headers"))
    own = own.withColumn("full", full)
    # a revisit sorts before the responses of its own date: those are not earlier
    order = Window.partitionBy("canonical_url", "period").orderBy("date", (F.col("kind") == "response").cast("int"), "record_id")
    near = own.withColumn("near", F.last("full", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))).filter("kind = 'revisit'")
    last = own.filter("full is not null").groupBy("canonical_url", "period").agg(F.max_by("full", F.struct("date", "record_id")).alias("last"))
    needed = near.filter("near is null and period is not null").select("canonical_url", "period").distinct()
    steps = last.unionByName(needed.withColumn("last", F.lit(None).cast(last.schema["last"].dataType))).groupBy("canonical_url", "period").agg(F.max_by("last", F.col("last").isNotNull()).alias("last"))
    before = F.last("last", ignorenulls=True).over(Window.partitionBy("canonical_url").orderBy("period").rowsBetween(Window.unboundedPreceding, -1))
    far = steps.select(F.col("canonical_url").alias("f_url"), F.col("period").alias("f_period"), before.alias("far")).filter("far is not null")
    out = near.join(far, (F.col("canonical_url") == F.col("f_url")) & (F.col("period") == F.col("f_period")), "left")
    out = out.withColumn("stored", F.when(F.col("canonical_url").isNotNull() & F.col("date").isNotNull(), F.coalesce("near", "far")))
    tag, changed = F.col("headers")["etag"], F.col("headers")["last-modified"]
    same = F.when(tag.isNotNull(), _weak(tag) == _weak(F.col("stored.headers")["etag"])).when(changed.isNotNull(), changed == F.col("stored.headers")["last-modified"])
    verdict = (
        F.when(F.col("stored").isNull(), "missing")
        .when(tag.isNull() & changed.isNull(), "unverified")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    out = out.withColumn("verdict", verdict)
    fresh = F.map_filter("headers", lambda k, _: ~k.isin(*NOT_MERGED, ":status"))
    kept = F.map_filter(F.col("stored.headers"), lambda k, _: ~F.map_contains_key(fresh, k))
    unchecked = (F.col("verdict") == "unverified") & F.col("stored.headers")["etag"].isNull() & F.col("stored.headers")["last-modified"].isNull()
    merged = F.when((F.col("verdict") == "resolved") | unchecked, F.map_concat(kept, fresh)).otherwise(F.col("headers"))
    return out.select("record_id", "canonical_url", "date", F.col("stored.record_id").alias("refers_to"), "verdict", merged.alias("headers"))


def header_text(headers: Column) -> Column:
    """One ``name: value`` a line, sorted by name."""
    return F.array_join(F.transform(F.sort_array(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl made of pages: each was fetched once and asked for again two times.

    The first revisit has the right ETag; the second, days later, one of: a weak form of it, a stale one, only Last-Modified, or no validator.
    Every 7th page was never fetched in full, so its revisits have an earlier response only if another page has the same canonical URL.
    """
    n = F.col("page_id")
    at = lambda minutes: F.timestamp_seconds(F.lit(1_700_000_000) + n * 60 + minutes * 60)
    tag = F.concat(F.lit('"'), F.substring(F.sha1(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    changed = F.concat(F.lit("day "), (n % 97).cast("string"))
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    some = lambda *p: F.map_from_entries(F.filter(F.array(*p), lambda e: e["value"].isNotNull()))
    kind = n % 4
    first = some(pair(":status", F.lit("200")), pair("content-type", F.lit("text/html")), pair("content-length", F.octet_length(F.coalesce("html", F.lit("")))), pair("etag", tag), pair("last-modified", changed), pair("cache-control", F.lit("max-age=60")))
    again = some(pair(":status", F.lit("304")), pair("etag", tag), pair("cache-control", F.concat(F.lit("max-age="), (n % 5 * 100).cast("string"))), pair("content-length", F.lit("0")))
    later = some(
        pair(":status", F.lit("304")), pair("etag", F.when(kind == 0, F.concat(F.lit("W/"), tag)).when(kind == 1, F.lit('"stale"'))),
        pair("last-modified", F.when(kind == 2, changed)), pair("connection", F.lit("close")), pair("x-age", n.cast("string")),
    )
    one = lambda suffix, what, minutes, headers: F.struct(F.concat(n.cast("string"), F.lit(suffix)).alias("record_id"), F.lit(what).alias("warc_type"), at(minutes).alias("date"), headers.alias("headers"))
    rows = F.filter(F.array(one("-a", "response", 0, first), one("-b", "revisit", 30, again), one("-c", "revisit", 6000, later)), lambda r: (r["warc_type"] != "response") | (n % 7 != 3))
    return pages.filter("page_id is not null").select("url", F.explode(rows).alias("r")).select("r.record_id", "r.warc_type", "url", "r.date", "r.headers")


ORACLE_SQL = r"""
WITH b AS (SELECT page_id AS n, html, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^(?i:[a-z][a-z0-9+.-]*)://', '') AS u FROM pages WHERE page_id IS NOT NULL),
c AS (SELECT n, '"' || substr(sha1(coalesce(html, '')), 1, 12) || '"' AS tag, 'day ' || CAST(n % 97 AS VARCHAR) AS changed, strlen(coalesce(html, '')) AS len,
  regexp_replace(regexp_replace(lower(regexp_extract(u, '(?s)^[^/?]*')), ':(80|443)$', ''), '^www\.', '') || regexp_replace(regexp_extract(u, '(?s)^[^/?]*([^?]*)', 1), '/+$', '') AS hp,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '(?s)^[^?]*\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[^=]*|ref|fbclid|gclid|sessionid|phpsessid)(=|$)'))), '&') AS q FROM b),
k AS (SELECT *, hp || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS cu FROM c),
f AS (SELECT n, cu, n * 60 AS t, CAST(n AS VARCHAR) || '-a' AS id, tag, changed, len FROM k WHERE n % 7 <> 3),
r AS (SELECT n, cu, n * 60 + 1800 AS t, CAST(n AS VARCHAR) || '-b' AS id, tag, NULL AS changed, 'cache-control: max-age=' || CAST(n % 5 * 100 AS VARCHAR) AS cc, FALSE AS late FROM k
  UNION ALL SELECT n, cu, n * 60 + 360000, CAST(n AS VARCHAR) || '-c', CASE n % 4 WHEN 0 THEN 'W/' || tag WHEN 1 THEN '"stale"' END, CASE WHEN n % 4 = 2 THEN changed END, NULL, TRUE FROM k),
j AS (SELECT r.*, f.id AS fid, f.tag AS ftag, f.changed AS fchanged, f.len AS flen, row_number() OVER (PARTITION BY r.id ORDER BY f.t DESC, f.id DESC) AS rn FROM r LEFT JOIN f ON f.cu = r.cu AND f.t < r.t),
v AS (SELECT *, CASE WHEN fid IS NULL THEN 'missing' WHEN tag IS NULL AND changed IS NULL THEN 'unverified'
  WHEN CASE WHEN tag IS NOT NULL THEN replace(tag, 'W/', '') = replace(ftag, 'W/', '') ELSE changed = fchanged END THEN 'resolved' ELSE 'mismatch' END AS verdict FROM j WHERE rn = 1)
SELECT id AS record_id, cu AS canonical_url, CAST(1700000000 + t AS BIGINT) AS date_s, fid AS refers_to, verdict,
 CASE WHEN verdict = 'resolved' THEN concat_ws(chr(10), ':status: 200', coalesce(cc, 'cache-control: max-age=60'), 'content-length: ' || CAST(flen AS VARCHAR), 'content-type: text/html', 'etag: ' || coalesce(tag, ftag), 'last-modified: ' || coalesce(changed, fchanged), CASE WHEN late THEN 'x-age: ' || CAST(n AS VARCHAR) END)
  ELSE concat_ws(chr(10), ':status: 304', cc, CASE WHEN late THEN 'connection: close' ELSE 'content-length: 0' END, 'etag: ' || tag, 'last-modified: ' || changed, CASE WHEN late THEN 'x-age: ' || CAST(n AS VARCHAR) END) END AS headers FROM v
"""
