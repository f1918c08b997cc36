"""WARC archives: captures out, transactions assembled back in.

A capture is a request, a response (or a revisit of an equal payload) and a metadata
record; the first and last name the second in ``WARC-Concurrent-To``. Archives are
written by Spark as gzip files of whole captures and read back whole, by the lengths
in their records. A file holds at most ``captures_per_file`` captures.

Of captures with equal payloads of at least ``min_revisit`` bytes, that with the
largest page id is the response and the others refer to it.

Reading joins the three kinds by their concurrent-to identifiers, whichever record
names the other, and gives one nested row per response or revisit. Members are
gathered per identifier before the join, so a record that occurs repeatedly multiplies
nothing.

Edge cases: a null html is an empty payload; a null url is written as ``unknown:``;
repeated rows are captures of their own (with the same identifiers); a null page id
never becomes the target of revisits; other columns are left out; an empty table gives
archives without records.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import materialise

MIN_REVISIT, CAPTURES_PER_FILE = 1_000, 5_000
_LINE = "\r\n"


def _urn(*parts: Column | str) -> Column:
    digest = F.md5(F.concat_ws("|", *parts))
    pieces = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(kind: Column, headers: list[tuple[str, Column]], block: Column, length: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    # Headers that are null are left out.
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines.append(F.concat(F.lit("Content-Length: "), length.cast("string")))
    return F.concat(F.concat_ws(_LINE, *lines), F.lit(_LINE * 2), block)


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   min_revisit: int = MIN_REVISIT, captures_per_file: int = CAPTURES_PER_FILE) -> None:
    """``pages``: page_id, url, html. ``date`` stands for the unknown time of capture."""
    light = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).select(
        "page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("bytes"))
    # Copies of one payload are reduced per task before they meet.
    targets = materialise(light.where(F.col("bytes") >= min_revisit).groupBy("digest").agg(
        F.max("page_id").alias("target"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("target").isNotNull()).select("digest", "target"), "payloads")
    rows = pages.select(
        "page_id", F.coalesce("html", F.lit("")).alias("html"),
        # A line break in a header would end it.
        F.regexp_replace(F.coalesce("url", F.lit("unknown:")), r"[\r\n]+", "%0A").alias("url"))
    rows = rows.select("*", F.sha1("html").alias("digest"), F.octet_length("html").alias("bytes"))
    rows = rows.join(targets, "digest", "left")
    revisit = F.coalesce(F.col("target") != F.col("page_id"), F.col("target").isNotNull())
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = rows.withColumns({
        "revisit": revisit, "id": _urn(F.lit("capture"), name, "digest"),
        "refers": F.when(revisit, _urn(F.lit("capture"), F.col("target").cast("string"), "digest"))})
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(_LINE * 2))
    get = F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{_LINE}{_LINE}"))
    about = F.concat_ws(_LINE, F.concat(F.lit("page-id: "), name), F.when(
        F.col("revisit"), F.concat(F.lit("refers-to-page: "), F.col("target").cast("string"))), F.lit(""))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))]

    def member(kind: str, block: Column, content: str) -> Column:
        return _record(F.lit(kind), [
            ("WARC-Record-ID", _urn(F.lit(kind), name, "digest")), ("WARC-Concurrent-To", F.col("id")),
            *common, ("Content-Type", F.lit(content))], block, F.octet_length(block))
    main = _record(
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        [("WARC-Record-ID", F.col("id")), ("WARC-Refers-To", F.col("refers")), *common,
         ("WARC-Profile", F.when(F.col("revisit"), F.lit(
             "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
         ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))),
        F.octet_length(http) + F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes")))
    # The writer ends each row with the two line breaks that end a record.
    captures = rows.select(F.concat_ws(
        _LINE * 2, member("request", get, "application/http;msgtype=request"), main,
        member("metadata", about, "application/warc-fields")).alias("value"))
    captures.write.option("lineSep", _LINE * 2).option("maxRecordsPerFile", captures_per_file).text(
        path, compression="gzip")


_RECORD = pa.schema([
    ("kind", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())),
    ("refers_to", pa.string()), ("uri", pa.string()), ("digest", pa.string()),
    ("payload_bytes", pa.int64()), ("found_digest", pa.string()), ("payload", pa.binary()),
    ("fields", pa.string())])
_RECORD_DDL = ("kind string, record_id string, concurrent_to array<string>, refers_to string, uri string, "
               "digest string, payload_bytes bigint, found_digest string, payload binary, fields string")


def parse_records(data: bytes):
    """The records of an archive file, one by one."""
    at = 0
    while at < len(data):
        if data[at:at + 2] == b"\r\n":
            at += 2
            continue
        if data[at:at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        head, stop = {}, data.index(b"\r\n\r\n", at)
        for line in data[at:stop].decode("utf-8", "replace").split(_LINE)[1:]:
            name, _, value = line.partition(":")
            head.setdefault(name.strip().lower(), []).append(value.strip())
        start = stop + 4
        at = start + int(head["content-length"][0])
        if at > len(data):
            raise ValueError("an archive ends within a record")
        yield _parsed(head, data[start:at])


def _parsed(head: dict, block: bytes) -> dict:
    one = lambda name: head.get(name, [None])[0]
    kind = one("warc-type")
    row = {"kind": kind, "record_id": one("warc-record-id"), "concurrent_to": head.get("warc-concurrent-to", []),
           "refers_to": one("warc-refers-to"), "uri": one("warc-target-uri"),
           "digest": (one("warc-payload-digest") or "").removeprefix("sha1:") or None,
           "payload_bytes": None, "found_digest": None, "payload": None, "fields": None}
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        for line in http.decode("latin-1").split(_LINE)[1:]:
            name, _, value = line.partition(":")
            if name.strip().lower() == "content-length":
                row["payload_bytes"] = int(value)
        if kind == "response":
            row |= {"payload": payload, "payload_bytes": len(payload),
                    "found_digest": hashlib.sha1(payload).hexdigest()}
    else:
        row["fields"] = block.decode("utf-8", "replace")
    return row


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in a folder."""
    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                data, rows = _unpacked(content.as_buffer()), []
                for row in parse_records(data):
                    rows.append(row)
                    if len(rows) == 1_000:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, _RECORD_DDL)


def _unpacked(data) -> bytes:
    """All members of a gzip file."""
    parts, rest = [], bytes(data)
    while rest:
        member = zlib.decompressobj(31)
        parts += [member.decompress(rest), member.flush()]
        rest = member.unused_data
    return b"".join(parts)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (the response or revisit), ``request`` and
    ``metadata`` (null where the archive has none)."""
    mains = F.col("kind").isin("response", "revisit")
    members = records.where(F.col("kind").isin("request", "metadata")).select(
        "kind", "record_id", "uri", "fields", "concurrent_to")
    named = members.select(F.explode("concurrent_to").alias("to"), "kind", "record_id", "uri", "fields")
    # A response may name its request instead.
    naming = records.where(mains).select(
        F.col("record_id").alias("to"), F.explode("concurrent_to").alias("record_id"))
    named = named.unionByName(naming.join(members.drop("concurrent_to"), "record_id"))
    own = F.struct("record_id", "uri", "fields")
    gathered = named.groupBy("to").agg(
        F.max(F.when(F.col("kind") == "request", own)).alias("request"),
        F.max(F.when(F.col("kind") == "metadata", own)).alias("metadata"))
    return records.where(mains).select(
        F.col("record_id").alias("to"),
        F.struct("kind", "record_id", "refers_to", "uri", "digest", "payload_bytes", "found_digest",
                 "payload").alias("capture")).join(gathered, "to", "left").drop("to")
