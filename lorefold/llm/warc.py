"""WARC archives: writing pages as records, and reading records back with their segments put together.

Contract
* Each page row gives one record. Payload: the html in UTF-8; null html is an empty payload. Null or
  repeated page ids and extra columns pass; an empty table gives empty archives and no rows.
* Of equal payloads of at least MIN_SHARED bytes, the row of the smallest page id is a response and the
  others revisit it (rows that repeat that smallest id are responses too); smaller payloads are responses.
* A message longer than segment_bytes is written as a response and continuation records. Reading groups
  them by origin record, orders them by segment number and checks numbers and total length; records that
  miss a segment or fail a check come back with intact = false and what could be read.

Archives are written by Spark's text writer and read by its text reader, split at the start of a record
as separator. The writer's chunked framing cuts every "WARC/1.1" inside a payload in two, so that no
payload can look like the start of a record, and files can be read in splits by many tasks. In archives
of other writers a payload may hold the separator: a record shorter than its Content-Length is continued
by what follows it in its split.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, shared_dir, table

MIN_SHARED = 100
CHUNK_BYTES = 4096
SEGMENT_BYTES = 8192
#: Time of capture, where pages have none of their own.
DATE = "1970-01-01T00:00:00Z"
#: Groups of equal payloads that are broadcast at most (about 100 bytes each); beyond that the join shuffles.
BROADCAST_GROUPS = 100_000
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PARSED = "page_id string, record_id string, type string, digest string, refers_to string, number int, origin string, total long, intact boolean, block binary"


def encode_chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing. No chunk holds a whole VERSION."""
    out, at = [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        found = payload.find(VERSION, at, end)
        if found >= 0:
            end = found + 2
        out += [b"%x\r\n" % (end - at), payload[at:end], b"\r\n"]
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def decode_chunked(body: bytes) -> tuple[bytes, bool]:
    """The payload, and whether the framing was whole. Chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return b"".join(out), False
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return b"".join(out), False
        if size == 0:
            return b"".join(out), True
        at = end + 2
        out.append(body[at : at + size])
        if body[at + size : at + size + 2] != b"\r\n":
            return b"".join(out), False
        at += size + 2


def _record(kind: bytes, fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    head = [VERSION, b"\r\nWARC-Type: ", kind]
    for name, value in fields:
        head += [b"\r\n", name, b": ", value.replace(b"\r", b"").replace(b"\n", b"")]
    return b"".join([*head, b"\r\nContent-Length: %d\r\n\r\n" % len(block), block])


def _build(segment_bytes: int, date: bytes):
    def build(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                row += 1
                own = b"<urn:page:%d-%d>" % (task, row)
                payload = x["payload"]
                uri = lambda url: (url or "").encode().replace(VERSION, b"WARC%2F1.1")
                fields = [(b"WARC-Record-ID", own), (b"WARC-Date", date), (b"WARC-Target-URI", uri(x["url"])), (b"Content-Type", b"application/http; msgtype=response"), (b"WARC-Payload-Digest", b"sha256:" + x["digest"].encode())]
                if x["page_id"] is not None:
                    fields.append((b"Page-ID", x["page_id"].encode()))
                if x["refers_to"] is not None:
                    origin = [(b"WARC-Profile", PROFILE), (b"WARC-Refers-To-Target-URI", uri(x["refers_to_url"])), (b"WARC-Refers-To-Date", date), (b"Refers-To-Page-ID", x["refers_to"].encode())]
                    out.append(_record(b"revisit", [*fields, *origin], HTTP_HEAD))
                    continue
                block = HTTP_HEAD + encode_chunked(payload)
                if len(block) <= segment_bytes:
                    out.append(_record(b"response", fields, block))
                    continue
                parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
                out.append(_record(b"response", [*fields, (b"WARC-Segment-Number", b"1")], parts[0]))
                for n, part in enumerate(parts[1:], 2):
                    last = [(b"WARC-Segment-Total-Length", b"%d" % len(block))] if n == len(parts) else []
                    out.append(_record(b"continuation", [(b"WARC-Record-ID", own[:-1] + b"-%d>" % n), (b"WARC-Date", date), (b"WARC-Segment-Origin-ID", own), (b"WARC-Segment-Number", b"%d" % n), *last], part))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return build


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", segment_bytes: int = SEGMENT_BYTES, date: str = DATE) -> None:
    """Write a record for every row of pages into archives below path."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= MIN_SHARED)
    first = cut(large.groupBy(F.col("digest").alias("d")).agg(F.min("page_id").alias("first"), F.min_by("url", F.struct("page_id", "url")).alias("first_url"), F.count("*").alias("n")).where("n > 1").drop("n"))
    if first.count() <= BROADCAST_GROUPS:
        first = F.broadcast(first)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    typed = rows.join(first, (F.col("digest") == F.col("d")) & (F.octet_length("payload") >= MIN_SHARED), "left")
    typed = typed.select(F.col("page_id").cast("string"), "url", F.when(refers.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "digest", refers.alias("refers_to"), F.col("first_url").alias("refers_to_url"))
    records = typed.mapInArrow(_build(segment_bytes, date.encode()), "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", RECORD_END).text(path)


def parse_record(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    length = int(fields.get(b"content-length") or -1)
    number, total = fields.get(b"warc-segment-number"), fields.get(b"warc-segment-total-length")
    return {
        "page_id": fields.get(b"page-id"), "record_id": fields.get(b"warc-record-id"), "type": fields.get(b"warc-type"), "digest": (fields.get(b"warc-payload-digest") or "").removeprefix("sha256:") or None,
        "refers_to": fields.get(b"refers-to-page-id"), "number": int(number) if number else None, "origin": fields.get(b"warc-segment-origin-id"), "total": int(total) if total else None,
        "intact": 0 <= length <= len(rest) and rest[length:].strip(b"\r\n") == b"", "block": rest[:length] if length >= 0 else rest,
    }


LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)\s*$")


def settle(pieces: list[bytes], last: bool) -> tuple[list[bytes], list[bytes]]:
    """Whole records of a split's pieces in order, and those that may go on. A record that is too short is put
    together with its followers only if they end where its length says; else it stays as it is."""
    gap, out, at = RECORD_END.encode() + VERSION + b"\r\n", [], 0
    while at < len(pieces):
        head, _, rest = pieces[at].partition(b"\r\n\r\n")
        length = LENGTH.search(head)
        want, size, n = int(length[1]) if length else 0, len(rest), 1
        while size < want and at + n < len(pieces):
            size += len(gap) + len(pieces[at + n])
            n += 1
        if size < want and not last:
            break
        whole = gap.join(pieces[at : at + n])
        if n > 1 and (size < want or whole[len(whole) - size + want :].strip(b"\r\n")):
            n, whole = 1, pieces[at]
        out.append(whole)
        at += n
    return out, pieces[at:]


def _whole(batches):
    segmented = lambda record: b"\r\nwarc-segment-number:" in record.partition(b"\r\n\r\n")[0].lower()
    as_batch = lambda records: pa.RecordBatch.from_arrays([pa.array(records, pa.binary()), pa.array([segmented(r) for r in records], pa.bool_())], ["value", "segmented"])
    kept = []
    for batch in batches:
        records, kept = settle(kept + batch.column(0).to_pylist(), False)
        yield as_batch(records)
    yield as_batch(settle(kept, True)[0])


PARSED_ARROW = pa.schema(
    [("page_id", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()), ("number", pa.int32()), ("origin", pa.string()), ("total", pa.int64()), ("intact", pa.bool_()), ("block", pa.binary())]
)


def _parse(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pylist([parse_record(x) for x in batch.column(0).to_pylist()], PARSED_ARROW)


def _decode(batches):
    for batch in batches:
        payloads, whole = [], []
        for x in batch.to_pylist():
            block = b"".join(x["blocks"])
            head, gap, body = block.partition(b"\r\n\r\n")
            ok = bool(gap) and x["intact"]
            if b"transfer-encoding: chunked" in head.lower() and x["type"] != "revisit":
                body, framed = decode_chunked(body)
                ok = ok and framed
            payloads.append(body)
            whole.append(ok)
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "record_id", "type", "digest", "refers_to", "segments")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(whole), pa.array(payloads, pa.binary())], ["page_id", "record_id", "type", "digest", "refers_to", "segments", "intact", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_id, type, digest, refers_to, segments, intact, payload of each record; segments are put together."""
    lines = spark.read.option("lineSep", RECORD_END + VERSION.decode() + "\r\n").text(path).where("length(value) > 0")
    lines = lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(_whole, "value binary, segmented boolean")
    parsed = lambda df: df.select("value").mapInArrow(_parse, PARSED)
    single = parsed(lines.where("not segmented")).select("page_id", "record_id", "type", "digest", "refers_to", F.lit(1).alias("segments"), "intact", F.array("block").alias("blocks"))
    parts = parsed(lines.where("segmented")).withColumn("first", F.coalesce("origin", "record_id"))
    by_origin = parts.groupBy("first").agg(
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("page_id", "record_id", "type", "digest", "refers_to")],
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"), F.bool_and("intact").alias("intact"),
    )
    size = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.octet_length(p["block"]))
    complete = (F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))) & (size == F.col("total"))
    joined = by_origin.select("page_id", "record_id", "type", "digest", "refers_to", F.size("parts").alias("segments"), (F.col("intact") & F.coalesce(complete, F.lit(False))).alias("intact"), F.transform("parts", lambda p: p["block"]).alias("blocks"))
    return single.unionByName(joined).mapInArrow(_decode, "page_id string, record_id string, type string, digest string, refers_to string, segments int, intact boolean, payload binary")


def op1_warc_segment_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = shared_dir(spark)
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    read = read_archives(spark, path)
    whole = lambda: F.sha2("payload", 256)
    own = read.where("type = 'response'").select(
        F.col("page_id").cast(kind), F.octet_length("payload").cast("bigint").alias("payload_bytes"), whole().alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"), (F.col("intact") & (whole() == F.col("digest"))).alias("intact")
    )
    own = cut(own)
    target = own.where(F.col("payload_bytes") >= MIN_SHARED).groupBy(F.col("page_id").alias("to"), F.col("payload_digest").alias("of")).agg(F.max(F.struct("payload_bytes", "payload_digest", "intact")).alias("r"))
    again = read.where("type = 'revisit'").select(F.col("page_id").cast(kind), F.col("refers_to").cast(kind), "digest", "intact")
    again = again.join(target, (F.col("refers_to") == F.col("to")) & (F.col("digest") == F.col("of")), "left")
    revisits = again.select("page_id", "r.payload_bytes", "r.payload_digest", F.lit("revisit").alias("record_type"), "refers_to", (F.col("intact") & F.coalesce("r.intact", F.lit(False))).alias("intact"))
    return own.unionByName(revisits)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest, CASE WHEN strlen(h) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(h) >= 100 AND page_id <> first THEN first END AS refers_to, true AS intact FROM p
"""
