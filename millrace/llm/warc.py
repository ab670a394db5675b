"""WARC archives in Zstandard with a dictionary in a leading skippable frame (``.warc.zst``).

Each archive trains its own dictionary on its first records (or, where they are too few to train on,
takes their bytes as one), puts it into a skippable frame
(magic number 0x184D2A5D, little-endian length) at the start of the file, and compresses every
record as a frame of its own, so a reader can start at any record's offset.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import scratch, worker

#: The skippable frame of a dictionary, and that of a Zstandard frame.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
MANIFEST = "manifest"
_ZERO = "1970-01-01T00:00:00Z"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:record")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, str(page_id))}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = _ZERO) -> bytes:
    """A WARC/1.1 record: a response with its payload, or a revisit of another page's equal payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = " ".join((url or "").split()) or "urn:unknown"  # no line ends in a header
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {digest}",
        "Content-Type: application/http; msgtype=response",
        f"Page-ID: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in (x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)}
    return {"headers": headers, "block": rest[: int(headers["content-length"])]}


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A dictionary from records; too few of them give none."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class Writer:
    """Records to one archive: held until the sample is full, then each compressed alone."""

    def __init__(self, sample_bytes: int = 2 << 20, dictionary_bytes: int = 64 << 10, level: int = 9):
        self.sample_bytes, self.dictionary_bytes, self.level = sample_bytes, dictionary_bytes, level
        self.first, self.held, self.out, self.size, self.compress = [], 0, [], 0, None

    def _start(self) -> None:
        import zstandard

        raw = frame = train_dictionary(self.first, self.dictionary_bytes)
        if not raw and self.first:  # too few records to train on: their own bytes, compressed in the frame
            raw = b"".join(self.first)[: self.dictionary_bytes]
            frame = zstandard.ZstdCompressor(level=self.level).compress(raw)
        given = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
        self.compress = zstandard.ZstdCompressor(level=self.level, **given)
        if raw:
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(frame)) + frame)
        for x in self.first:
            self._put(self.compress.compress(x))
        self.first = []

    def _put(self, data: bytes) -> None:
        self.out.append(data)
        self.size += len(data)

    def add(self, data: bytes) -> None:
        if self.compress:
            self._put(self.compress.compress(data))
            return
        self.first.append(data)
        self.held += len(data)
        if self.held >= self.sample_bytes:
            self._start()

    def close(self) -> bytes:
        if self.compress is None:
            self._start()
        return b"".join(self.out)


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, in order."""
    import zstandard

    at, given, view = 0, {}, memoryview(data)
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if magic == DICTIONARY_MAGIC:
            raw = bytes(view[at + 8 : at + 8 + size])
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):  # a dictionary may itself be compressed
                raw = zstandard.ZstdDecompressor().decompress(raw)
            given = {"dict_data": zstandard.ZstdCompressionDict(raw)}
            at += 8 + size
            continue
        frame, parts, step = zstandard.ZstdDecompressor(**given).decompressobj(), [], 16384
        while not frame.eof:
            chunk = view[at : at + step]
            if not chunk:
                raise ValueError("an archive ends within a record")
            parts.append(frame.decompress(chunk))
            at += len(chunk) - len(frame.unused_data)
        yield b"".join(parts)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri))


def _write(folder: str, roll_bytes: int, sample_bytes: int, dictionary_bytes: int, level: int):
    """Archives of a partition, under names that no other attempt uses."""
    names = ["archive", "page_id", "position"]

    def run(batches):
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        part, attempt, number = context.partitionId(), context.taskAttemptId(), 0
        archive, pages = None, []

        def finish():
            nonlocal archive, number
            name = f"part-{part:05d}-{attempt}-{number:04d}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(archive.close())
            out = pa.RecordBatch.from_arrays([pa.array([name] * len(pages)), pa.array(pages, pa.int64()), pa.array(range(len(pages)), pa.int64())], names)
            archive, number = None, number + 1
            pages.clear()
            return out

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                archive = archive or Writer(sample_bytes, dictionary_bytes, level)
                archive.add(record(page_id, url, (html or "").encode(), refers_to))
                pages.append(page_id)
                if archive.size + archive.held * (archive.compress is None) >= roll_bytes:
                    yield finish()
        if pages:
            yield finish()

    return run


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """``(page_id, url, html, refers_to)``: of equal payloads of at least least_bytes, all but the
    largest id refer to that id.  The ids of a digest meet in a maximum (combined before the
    shuffle); only digests that occur twice are joined to the pages."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= least_bytes, F.sha1(F.encode("html", "UTF-8"))))
    twice = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "last")
    twice = scratch.table(twice, "digests")  # with a shuffle of its own, so that a hot digest can be split
    spread = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))  # small payloads meet nothing, and not each other
    joined = rows.withColumn("digest", F.coalesce("digest", spread)).join(twice, "digest", "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, roll_bytes: int = 32 << 20, sample_bytes: int = 2 << 20, dictionary_bytes: int = 64 << 10, level: int = 9, **columns: str) -> DataFrame:
    """Write a record per row to ``.warc.zst`` archives in folder, a new one under a URI that all executors reach.

    Returns ``(archive, page_id, position)``, which is also written to ``manifest`` in the folder.  A null html is an empty payload.  A page whose
    payload (of at least least_bytes) equals that of a larger page_id is a revisit of the
    largest; rows that repeat that id are responses.  Null ids are kept, and are responses only
    where no page with an id has their payload.  Repeated rows are repeated records.  An empty table
    writes no archive.  Each attempt of a task names its archives apart, and the manifest (which Spark commits
    once a task) names those of the attempt that counted; archives that it does not name are leftovers.
    Other columns are ignored.
    """
    rows = with_revisits(pages, least_bytes=least_bytes, **columns)
    run = _write(folder, roll_bytes, sample_bytes, dictionary_bytes, level)
    kind = "archive string, page_id long, position long"
    rows.mapInArrow(worker.lean(run), kind).write.parquet(f"{folder}/{MANIFEST}")
    return rows.sparkSession.read.schema(kind).parquet(f"{folder}/{MANIFEST}")


def _read(folder: str):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "archive"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def rows(name: str, content: bytes):
        for data in read_archive(content):
            own = parse(data)
            head = own["headers"]
            http, _, payload = own["block"].partition(b"\r\n\r\n")
            size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
            told = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
            if head["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != told):
                raise ValueError(f"{name}: a payload differs from its digest")
            page, refers = head.get("page-id"), head.get("refers-to-page-id")
            yield int(page) if page else None, size, told, head["warc-type"], int(refers) if refers else None, head["warc-target-uri"], name

    def run(batches):
        store, base = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_stream(f"{base}/{name}", compression=None) as f:
                    content = f.read()
                found = rows(name, content)
                while part := list(islice(found, 5000)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], names)

    return run


def read_archives(spark, folder: str, most_tasks: int = 10_000) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url, archive)`` per record.

    Reads the archives that the folder's manifest names, one a task (at most most_tasks tasks), and no others.
    Null ids come back null, empty payloads with 0 bytes, repeated records as often as they were
    written; a folder of an empty table gives no rows.  Digests of responses are checked against their
    payloads; a mismatch raises.
    """
    archives = spark.read.schema("archive string").parquet(f"{folder}/{MANIFEST}").distinct()
    archives = scratch.table(archives, "archives")
    archives = archives.repartition(max(1, min(most_tasks, archives.count())), "archive")
    return archives.mapInArrow(worker.lean(_read(folder)), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string")
