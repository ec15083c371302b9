"""WARC archives of pages: written with revisits, segments and chunked framing, and put together again.

A page's record holds an HTTP response whose body is in chunks. A block longer than a segment is cut: the first piece
stays in the response record, the others go to continuation records that name it as their origin. Reading groups the
pieces by origin, orders them by segment number, checks them against the total length and undoes the framing.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.session import settle, shared_folder

#: Bytes of a chunk of the body and of a record's block at most; records in one file at most, which is then 64 MB and headers.
CHUNK_BYTES, SEGMENT_BYTES, FILE_RECORDS = 8_192, 65_536, 1_024
DATE = "2024-01-01T00:00:00Z"
RECORD_END = "\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_PARSED = ("record_id string, kind string, page_id long, digest string, refers_to string, origin string, segment int, "
           "total long, block binary, payload_bytes long, payload_digest string")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _cuts(data: bytes, size: int) -> list[bytes]:
    """Pieces of at most `size` bytes that start at characters."""
    out, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end])
        at = end
    return out


def chunked(body: bytes) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(body, CHUNK_BYTES)) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while True:
        line = data.index(b"\r\n", at)
        size = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(out)
        out.append(data[at:at + size])
        if len(out[-1]) != size or data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is not as long as it says")
        at += size + 2


def page_record_id(page_id: int | None, digest: str, copy: str | None = None) -> str:
    """`copy`, the hash of the address and a number, tells rows apart that repeat a page_id and payload."""
    return f"<urn:page:{'none' if page_id is None else page_id}:{digest}{'' if copy is None else f':{copy}'}>"


def _record(kind: str, block: bytes, record_id: str, **more: object) -> str:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}"]
    lines += [f"WARC-{name.replace('_', '-').title()}: {value}" for name, value in more.items() if value is not None]
    if kind != "continuation":
        lines.append("Content-Type: application/http;msgtype=response")
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]) + block.decode()


def page_records(page_id: int | None, url: str | None, payload: bytes, revisits: bool, winner: int | None,
                 copy: str | None = None, winner_copy: str | None = None) -> Iterator[str]:
    digest = base32_sha1(payload)
    record_id = page_record_id(page_id, digest, copy)
    url = None if url is None else re.sub(r"\s", "%20", url)
    about = {"target_uri": url, "payload_digest": f"sha1:{digest}"}
    if revisits:
        yield _record("revisit", _HTTP, record_id, **about, refers_to=page_record_id(winner, digest, winner_copy),
                      profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return
    block = _HTTP + chunked(payload)
    pieces = _cuts(block, SEGMENT_BYTES)
    if len(pieces) == 1:
        yield _record("response", block, record_id, **about)
        return
    yield _record("response", pieces[0], record_id, **about, segment_number=1)
    for k, piece in enumerate(pieces[1:], 2):
        yield _record("continuation", piece, f"{record_id[:-1]}:{k}>", segment_origin_id=record_id, segment_number=k,
                      segment_total_length=len(block) if k == len(pieces) else None)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            yield pa.RecordBatch.from_arrays([pa.array(list(page_records(*row)))], ["value"])


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Write `pages` (page_id, url, html) as gzipped WARC files under `folder`, through Spark's text writer.

    Every row gives a record. Of records with equal payloads of at least `least_bytes`, one with the largest page_id is the
    response, the others revisit it. NULL html is an empty payload; NULL page_ids never win over others. The pages that
    revisit are found on digests alone; only then do payloads meet them, by page, digest and address. Rows that repeat all
    three are counted before they are moved, and numbered.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("sha", F.sha1("payload"))
    light = settle(rows.select("page_id", "sha", "url", F.octet_length("payload").alias("size")).groupBy("page_id", "sha", "url", "size").agg(
        F.count(F.lit(1)).alias("copies")))
    best = F.struct("page_id", F.coalesce("url", F.lit("")).alias("named"), F.col("url").isNotNull().alias("has_url"))
    winners = light.filter(F.col("size") >= least_bytes).groupBy(F.col("sha").alias("of")).agg(
        F.max(best).alias("best"), F.sum("copies").alias("n")).filter("n > 1 AND best.page_id IS NOT NULL").select(
        "of", F.col("best.page_id").alias("winner"), F.when(F.col("best.has_url"), F.col("best.named")).alias("winner_url"))
    wins = F.col("page_id").eqNullSafe(F.col("winner")) & F.col("url").eqNullSafe(F.col("winner_url"))
    about = light.join(winners, F.col("sha") == F.col("of"), "left").withColumn("wins", wins).filter("copies > 1 OR winner IS NOT NULL").select(
        F.col("page_id").alias("at_page"), F.col("sha").alias("at_sha"), F.col("url").alias("at_url"), "copies", "winner", "winner_url", "wins")
    met = rows.join(about, F.col("page_id").eqNullSafe(F.col("at_page")) & (F.col("sha") == F.col("at_sha")) & F.col("url").eqNullSafe(F.col("at_url")), "left")
    told = met.select("page_id", "url", "payload", "sha", "winner", "winner_url", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("wins", F.lit(False)).alias("wins"))
    once = told.filter("copies = 1").withColumn("k", F.lit(1).cast("long")).drop("sha", "copies")
    again = told.filter("copies > 1").groupBy("page_id", "url", "sha", "winner", "winner_url", "wins").agg(
        F.first("payload").alias("payload"), F.first("copies").alias("copies")).withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    copy = lambda url, k: F.concat_ws("-", F.coalesce(F.sha1(F.col(url).cast("binary")), F.lit("none")), k)
    written = once.unionByName(again.select(*once.columns)).select(
        "page_id", "url", "payload", (F.col("winner").isNotNull() & ~(F.col("wins") & (F.col("k") == 1))).alias("revisits"), "winner",
        copy("url", F.col("k")).alias("copy"), F.when(F.col("winner").isNotNull(), copy("winner_url", F.lit(1))).alias("winner_copy"))
    written.mapInArrow(_written, "value string").write.option("lineSep", RECORD_END).option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS).text(folder)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by name in lower case, and block of every record of an archive; compressed or not."""
    if data[:2] == b"\x1f\x8b":
        parts = []
        while data:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(data) + member.flush())
            data = member.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts at byte {at}")
        head = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        at = end + 4
        size = int(head["content-length"])
        block = data[at:at + size]
        if len(block) != size or data[at + size:at + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {at + size} is cut short")
        yield head, block
        at += size + 4


def payload_of(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def _page_of(record_id: str) -> int | None:
    name = record_id.split(":")[2]
    return None if name == "none" else int(name)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PARSED.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    for batch in batches:
        for content in batch["content"]:
            rows = []
            for head, block in records(content.as_py()):
                kind, record_id = head["warc-type"], head["warc-record-id"]
                origin = head.get("warc-segment-origin-id", record_id)
                segment = int(head["warc-segment-number"]) if "warc-segment-number" in head else None
                whole = kind == "response" and segment is None
                payload = payload_of(block) if whole else b""
                rows.append((
                    record_id, kind, _page_of(origin), head.get("warc-payload-digest", "").removeprefix("sha1:"), head.get("warc-refers-to"),
                    origin, segment, int(head["warc-segment-total-length"]) if "warc-segment-total-length" in head else None,
                    block if segment else None, len(payload) if whole else None, base32_sha1(payload) if whole else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names)


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for origin, total, digest, pieces in zip(*(c.to_pylist() for c in batch.columns)):
            block = b"".join(p["block"] for p in pieces)
            if [p["segment"] for p in pieces] != list(range(1, len(pieces) + 1)) or len(block) != total:
                raise ValueError(f"segments of {origin} do not make up its total length")
            payload = payload_of(block)
            rows.append((origin, _page_of(origin), digest, len(payload), base32_sha1(payload)))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds)],
                                         ["record_id", "page_id", "digest", "payload_bytes", "payload_digest"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the archives under `folder`.

    Pieces of one segment number and origin count once. Wrong lengths, missing segments and payloads that do not have
    their digest raise an error. A revisit has the facts of the response it refers to.
    """
    parsed = settle(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content").mapInArrow(_parsed, _PARSED))
    pieces = parsed.filter("segment IS NOT NULL").groupBy("origin", "segment").agg(
        F.first("block").alias("block"), F.max("total").alias("total"), F.max("digest").alias("digest"))
    grouped = pieces.groupBy("origin").agg(
        F.max("total").alias("total"), F.max("digest").alias("digest"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("pieces"))
    facts = "record_id string, page_id long, digest string, payload_bytes long, payload_digest string"
    responses = parsed.filter("kind = 'response' AND segment IS NULL").select(
        "record_id", "page_id", "digest", "payload_bytes", "payload_digest").union(grouped.mapInArrow(_reassembled, facts))
    checked = responses.withColumn("payload_digest", F.when(F.col("digest") == F.col("payload_digest"), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("wrong digest in "), F.col("record_id"))).cast("string")))
    revisits = parsed.filter("kind = 'revisit'").select(
        F.col("page_id").alias("again_id"), "refers_to", F.col("digest").alias("same")).join(
        checked.select("record_id", F.col("page_id").alias("of"), F.col("payload_bytes").alias("bytes")), F.col("refers_to") == F.col("record_id"), "left")
    return checked.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).union(
        revisits.select("again_id", "bytes", "same", F.lit("revisit"), "of"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """The facts of `pages` (page_id, url, html) after writing them to archives and reading those.

    Every row gives one, repeated rows too; of rows that repeat the largest page_id of a payload, one is the response. NULL html is an empty payload, which counts like any other. An
    empty table gives no rows; other columns are ignored.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
