"""WARC archives: writing, reading and resolution of repeated payloads to revisit records.

Archives are gzip text files in the shared store, written and read by Spark: a record is its header, an empty
line and its payload; the line separator of the writer is the two line ends that close a record. Reading
streams through a file between such separators and follows Content-Length, so payloads may hold anything, a file may
have any size, and a task holds one record at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import settle

# Fixed values of the format.
VERSION = "WARC/1.1"
END = "\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100
FILE_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"


def payloads(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes and payload_digest of each row; a null payload is empty."""
    payload = F.coalesce(F.col(payload_column).cast("string"), F.lit(""))
    return pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload")).select(
        "page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"))


def resolve(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id and refers_to of the records whose payload an earlier record has.

    Only headers are shuffled, by digest, after a partial minimum. The record with the smallest page_id
    is the original; rows that repeat it stay originals, rows without an id are last.
    """
    headers = records.where(F.col("payload_bytes") >= least_bytes).select("page_id", "payload_digest")
    first = headers.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return headers.join(first, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).where(
        "refers_to is not null").select("page_id", "payload_digest", "refers_to").distinct()


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", page.cast("string"), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def records_per_file(headers: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """So many records of average size have about file_bytes before compression; files only deal out the work, none is limited."""
    average = headers.agg(F.avg("payload_bytes")).first()[0] or 0
    return max(1, int(file_bytes / (average + 500)))


def write_archive(records: DataFrame, path: str, date: str = DATE, per_file: int = 10_000) -> None:
    """Writes records (page_id, url, payload, payload_bytes, payload_digest, refers_to) under fresh headers.

    A record with refers_to is a revisit without payload, any other a response. Line ends in a URL are
    left out; null ids and URLs leave out their line. Payloads may be of any length.
    """
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(END))
    header = F.concat(
        F.lit(VERSION + END), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(END),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))), F.lit(f"WARC-Date: {date}{END}"),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")), F.lit("")),
        F.coalesce(line("X-Page-Id", F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            F.lit(f"WARC-Profile: {SAME_PAYLOAD}{END}"), line("WARC-Refers-To", _record_id(F.col("refers_to"), F.col("payload_digest"))),
            line("X-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(F.lit(f"Content-Type: text/html; charset=utf-8{END}")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))), F.lit(END))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    records.select(F.concat(header, body)).write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _fields(header: bytes) -> dict[str, str]:
    lines = header.decode().split(END)
    if lines[0] != VERSION:
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    return dict(x.split(": ", 1) for x in lines[1:])


def parse(blocks: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and payload of the records of archives that come in blocks of any length; one record is held at a time.

    Line ends before a header are skipped.
    """
    held, fields, need = bytearray(), None, 0
    for block in blocks:
        held += block
        while True:
            if fields is None:
                at = len(held) - len(held.lstrip(b"\r\n"))
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                fields = _fields(bytes(held[at:end]))
                need = int(fields["Content-Length"])
                del held[:end + 4]
            if len(held) < need + 4:
                break
            if held[need:need + 4] != b"\r\n\r\n":
                raise ValueError("record does not end where its length says")
            yield fields, bytes(held[:need])
            del held[:need + 4]
            fields = None
    if fields is not None or held.strip(b"\r\n"):
        raise ValueError("archive ends within a record")


READ = ("page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
        "payload string")


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the archives in a folder; lengths and digests of responses are taken from what was read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda x: None if x is None else int(x)
        lines = (line.as_buffer().to_pybytes() + b"\r\n\r\n" for batch in batches for line in batch.column(0))
        rows, size = [], 0
        for f, payload in parse(lines):
            digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
            response = f["WARC-Type"] == "response"
            if response and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {f['WARC-Record-ID']} is damaged")
            rows.append((number(f.get("X-Page-Id")), f.get("WARC-Target-URI"), f["WARC-Type"], digest,
                         len(payload) if response else None, number(f.get("X-Refers-To-Page")),
                         payload.decode() if response and with_payload else None))
            size += len(payload)
            if len(rows) == 500 or with_payload and size > 1 << 24:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    return spark.read.option("lineSep", END * 2).text(path).mapInArrow(run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = [x.strip().split(" ")[0] for x in READ.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)


def deduplicated(records: DataFrame, headers: DataFrame | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Records with refers_to set on revisits; payloads move once, by page_id and digest.

    headers (page_id, payload_bytes, payload_digest of the same records) may be given as a written table, so that payloads are not digested twice.
    """
    found = resolve(records if headers is None else headers, least_bytes).select(
        F.col("page_id").alias("of_page"), F.col("payload_digest").alias("of_digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("payload_digest") == F.col("of_digest"))
    return records.join(found, same, "left").select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")


def resolved(archive: DataFrame) -> DataFrame:
    """Headers read from archives, revisits with the length of the response they refer to; the archives are read once.

    An empty archive gives no rows; repeated records give repeated rows.
    """
    headers = settle(archive.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    responses = headers.where("record_type = 'response'")
    originals = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    revisits = headers.where("record_type = 'revisit'").drop("payload_bytes").join(originals, ["refers_to", "payload_digest"], "left")
    return responses.unionByName(revisits.select(*headers.columns))
