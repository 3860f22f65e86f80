"""WARC archives: deterministic sharded writing with revisit records, and reading back."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import Query, body, col, stored, table
from plumbline.session import fresh_path

#: Production parameters: payloads from this size on can be revisited, a file is closed once it has so many compressed
#: bytes, a task writes about so many bytes of payload, and the date that all records carry.
LEAST_REVISIT, FILE_BYTES, TASK_BYTES = 1000, 64_000_000, 128_000_000
DATE = "2025-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """``id``, ``url``, ``key``, ``payload`` and ``refers_to``: a line for the record of each row, whose ``refers_to`` is null, and a line
    without payload for each row that revisits another, whose page it names.

    Of equal payloads of at least ``least`` bytes the row with the largest id is the response, the others revisit it. Equal
    means the same SHA-256, which is the key. Rows that repeat the largest id are all responses, and so are rows without id where no
    row of the group has one. A null payload is empty.

    Which rows are revisits is found from the keys alone. The writer, which sorts by id, url and key, meets the line that
    says so right before the record, so that payloads are shuffled once only.
    """
    rows = pages.select(col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("url"), body(html_col).cast("binary").alias("payload"))
    # Small payloads never meet: their key is null.
    rows = rows.withColumn("key", F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256))))
    keys = stored(rows.filter("key is not null").select("id", "url", "key"), "payload-keys")
    largest = keys.groupBy("key").agg(F.max("id").alias("largest"), F.count("*").alias("n")).filter("n > 1 and largest is not null")
    revisits = keys.join(largest.select("key", "largest"), "key").filter(~F.col("id").eqNullSafe(F.col("largest")))
    return rows.select("id", "url", "key", "payload", F.lit(None).cast("long").alias("refers_to")).unionAll(
        revisits.select("id", "url", "key", F.lit(None).cast("binary"), "largest"))


def _record_id(page: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([page, url, digest]))}>"


def record(page: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    """One record. A revisit has the HTTP header only, its digest and length are those of the full payload."""
    sha = hashlib.sha1(payload)
    digest = "sha1:" + base64.b32encode(sha.digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page, url, sha.hexdigest())}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: {digest}", "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # A line break in a url would end the header.
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in url or "\n" in url else "WARC-Target-URI: " + url)
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_MANIFEST = "file string, records long, bytes long, sha256 string"


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Write what ``planned`` gives below ``folder``, which all executors share, and return the manifest.

    Records are sorted by ranges of id and url, then by key. A task writes its range into files that are closed once they hold
    ``file_bytes`` compressed bytes, each under a temporary name that only this attempt of the task uses, and renames it when
    it is whole: an attempt that is lost leaves nothing that counts, one that is repeated writes the same bytes again.
    The manifest of all files is written last; readers use only what it lists.
    """
    spark = records.sparkSession
    total = records.filter("payload is not null").select(F.sum(F.octet_length("payload"))).first()[0] or 0
    ranged = records.repartitionByRange(max(1, ceil(total / task_bytes)), "id", "url").sortWithinPartitions(
        "id", "url", "key", F.col("refers_to").asc_nulls_last(), F.xxhash64("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, root = FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        number, done = 0, []
        out = sha = None
        size = count = 0
        revisit, target = None, None

        def close() -> None:
            nonlocal out, number
            out.close()
            name = f"part-{task.partitionId():05d}-{number:05d}.warc.gz"
            if fs.get_file_info(f"{root}/{name}").type == FileType.NotFound:
                fs.move(temporary, f"{root}/{name}")
            else:  # an earlier attempt has written the same bytes
                fs.delete_file(temporary)
            done.append((name, count, size, sha.hexdigest()))
            out, number = None, number + 1

        for batch in batches:
            for row in zip(*(batch[c] for c in ("id", "url", "key", "payload", "refers_to")), strict=True):
                page, url, key, payload, refers_to = (x.as_py() for x in row)
                if payload is None:
                    revisit, target = (page, url, key), refers_to
                    continue
                is_revisit = key is not None and revisit == (page, url, key)
                if out is None:
                    temporary = f"{root}/_temporary-{task.taskAttemptId()}-{number}"
                    out, sha, size, count = fs.open_output_stream(temporary), hashlib.sha256(), 0, 0
                member = gzip.compress(record(page, url, payload, *(("revisit", target) if is_revisit else ("response", None))), 6, mtime=0)
                out.write(member)
                sha.update(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes", "sha256"), d, strict=True)) for d in done], schema=pa.schema(
            [("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    path = folder.rstrip("/") + "/manifest"
    ranged.mapInArrow(run, _MANIFEST).write.json(path)
    return spark.read.schema(_MANIFEST).json(path)


def _records(stream: io.BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError("a record does not begin with its version")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            head[name] = value
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end with two line breaks")
        yield head, block


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all files of a manifest; digests are checked against the bytes, and file lengths against the manifest.

    ``payload`` is null for revisits, and for all records where ``payloads`` is false.
    """
    shape = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.to_pylist():
                path = f"{root}/{file['file']}"
                if fs.get_file_info(path).size != file["bytes"]:
                    raise ValueError(f"{file['file']} does not have the length that the manifest gives")
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain:
                    for head, block in _records(io.BufferedReader(plain, 1 << 20)):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        own = base64.b32decode(digest).hex()
                        if head["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != own:
                            raise ValueError("a payload does not have the digest that its record gives")
                        length = next(int(x[16:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
                        url = head.get("WARC-Target-URI")
                        rows.append({"page_id": int(head["X-Page-Id"]) if "X-Page-Id" in head else None, "url": url, "payload_bytes": length,
                                     "payload_digest": own, "record_type": head["WARC-Type"],
                                     "refers_to": int(head["X-Refers-To-Page-Id"]) if "X-Refers-To-Page-Id" in head else None,
                                     "payload": payload if payloads and head["WARC-Type"] == "response" else None})
                        held += len(block)
                        if held > 8_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=shape)

    # One task for each file.
    files = manifest.repartition(max(1, manifest.count()), "file")
    return files.mapInArrow(run, _READ)


def op6(spark: SparkSession, folder: str) -> DataFrame:
    place = fresh_path(spark, "warc")
    manifest = write_archives(planned(table(spark, folder, "pages")), place)
    return read_archives(manifest, place, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH bytes AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
grouped AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
         CASE WHEN octet_length(payload) >= {LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS largest
  FROM bytes)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to FROM grouped"""

QUERY = Query("op6_warc", op6, SQL)
