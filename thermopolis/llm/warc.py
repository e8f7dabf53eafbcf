"""A content-addressed WARC archive: each payload once, every record's headers, originals by joins."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Records in a file: one task reads a file at once.
FILE_RECORDS = 5000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
ID = "urn:page:"
RECORD = "page_id long, url string, record_type string, refers_to long, sha1 string, sha256 string, headers string"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def write_archive(pages: DataFrame, folder: str) -> None:
    """Write one WARC 1.1 record for each row of ``pages`` (page_id, url, html) into ``folder``.

    Of rows with equal payloads (by SHA-256) the one with the smallest page_id becomes a response
    with the payload, the others become revisits without it. Spark's text writer puts the records
    into gzip files: the WARC record separator is its line separator, and its committer takes care
    of lost executors. Which rows are first is decided on digests alone; texts are shuffled once, by
    page and not by payload, so a payload that a third of all pages share makes no large task.

    Defined results: NULL html is an empty payload; a NULL url has no target header; a row with a
    NULL page_id revisits if its payload has another owner, else it is a response; rows that repeat
    page_id and payload take the same type.
    """
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumn("key", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    narrow = keyed.select("page_id", "key")
    first = narrow.groupBy("key").agg(F.min("page_id").alias("first"))
    again = (
        narrow.join(first, "key")
        .where(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
        .distinct()
        .select(F.col("page_id").alias("again_id"), F.col("key").alias("again_key"), "first")
    )
    same = keyed.page_id.eqNullSafe(again.again_id) & (keyed.key == again.again_key)
    rows = keyed.join(again, same, "left").select("page_id", "url", "html", "first")
    records = rows.mapInArrow(_write, "value string")
    options = {"lineSep": "\r\n\r\n", "compression": "gzip", "maxRecordsPerFile": FILE_RECORDS}
    records.write.mode("errorifexists").options(**options).text(folder)


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([record(**r) for r in rows], pa.string())], ["value"])


def record(page_id: int | None, url: str | None, html: str, first: int | None) -> str:
    """The record as text, without its closing separator."""
    payload = html.encode()
    block = HTTP if first is not None else HTTP + payload
    digest = hashlib.sha1(payload).digest()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32(digest)}",
        f"X-Payload-SHA256: {hashlib.sha256(payload).hexdigest()}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
    ]
    if url is not None:
        plain = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        lines.append(f"WARC-Target-URI: {plain}")
        if plain != url:
            lines.append(f"X-Exact-URI: {json.dumps(url)}")
    if first is not None:
        lines += [f"WARC-Refers-To: <{ID}{first}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    body = HTTP.decode() if first is not None else HTTP.decode() + html
    return "\r\n".join(lines) + "\r\n\r\n" + body


def parse(file) -> Iterator[tuple[dict[str, str], str, bytes]]:
    """Headers, their exact text and the block of each record of an open WARC file."""
    while line := file.readline():
        head = [line]
        while (line := file.readline()) not in (b"\r\n", b""):
            head.append(line)
        exact = b"".join(head).decode()
        fields = dict(x.split(": ", 1) for x in exact.split("\r\n")[1:] if x)
        block = file.read(int(fields["Content-Length"]))
        if file.read(4) != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
            raise ValueError(f"record {fields['WARC-Record-ID']} is cut short")
        if "sha1:" + base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
            raise ValueError(f"record {fields['WARC-Record-ID']} does not match its block digest")
        yield fields, exact, block


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of ``folder``: page_id, url, type, digests, exact headers and ``payload_bytes``;
    with ``payloads`` also the ``payload`` of responses. Revisits have neither here, see ``restore``.

    Every block digest is verified, and both payload digests of each response; a record that does
    not match fails the job.
    """

    def number(uri: str | None) -> int | None:
        return int(uri[len(ID) + 1 : -1]) if uri and uri != f"<{ID}>" else None

    def row(fields: dict[str, str], exact: str, block: bytes) -> dict:
        url = json.loads(fields["X-Exact-URI"]) if "X-Exact-URI" in fields else fields.get("WARC-Target-URI")
        kind, sha1, sha256 = fields["WARC-Type"], fields["WARC-Payload-Digest"][5:], fields["X-Payload-SHA256"]
        payload = block[block.index(b"\r\n\r\n") + 4 :] if kind == "response" else None
        if payload is not None and (base32(hashlib.sha1(payload).digest()), hashlib.sha256(payload).hexdigest()) != (sha1, sha256):
            raise ValueError(f"record {fields['WARC-Record-ID']} does not match its payload digest")
        return {
            "page_id": number(fields["WARC-Record-ID"]),
            "url": url,
            "record_type": kind,
            "refers_to": number(fields.get("WARC-Refers-To")),
            "sha1": sha1,
            "sha256": sha256,
            "headers": exact,
            "payload_bytes": None if payload is None else len(payload),
        } | ({"payload": payload} if payloads else {})

    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "url", "record_type", "refers_to", "sha1", "sha256", "headers", "payload_bytes"]
    schema = pa.schema(list(zip(names, kinds, strict=True)) + [("payload", pa.binary())] * payloads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for record in parse(io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))):
                    rows.append(row(*record))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(run, f"{RECORD}, payload_bytes long" + ", payload binary" * payloads)


def restore(records: DataFrame) -> DataFrame:
    """Every record with the payload columns of its response, joined by SHA-256.

    Revisits are joined to the payload store, one row for each payload, so a payload with many
    revisits is a skewed join that Spark splits and never a group.
    """
    columns = [c for c in ("payload_bytes", "payload") if c in records.columns]
    responses = records.where("record_type = 'response'")
    store = responses.groupBy("sha256").agg(*[F.any_value(c).alias(c) for c in columns])
    revisits = records.where("record_type = 'revisit'").drop(*columns).join(store, "sha256", "left")
    missing = F.raise_error(F.concat(F.lit("no payload in the archive for page "), F.col("page_id").cast("string")))
    revisits = revisits.withColumn("payload_bytes", F.coalesce("payload_bytes", missing.cast("long")))
    return responses.unionByName(revisits.select(responses.columns))
