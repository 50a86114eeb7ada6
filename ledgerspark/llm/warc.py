"""Operator 7: a deterministic sharded WARC writer, and a reader.

Records are sorted by page id. Shards are ranges of ids with about ``shard_bytes``
of payload, cut by a histogram, so the same rows give the same files byte for byte:
dates are a parameter, record ids are name-based, gzip members carry no time. Each
record is a gzip member of its own; a shard rolls over to its next file once the
compressed size reaches ``file_bytes``. Headers and SHA-1 digests are regenerated
from the payload. Of records with equal payloads (at least ``least_bytes``) the one
with the largest page id is the response, the others are revisit records that refer
to it and carry no payload.

Commit: a task writes to a temporary name of its own and renames when a file is
complete, so a lost or repeated task only replaces a file by its equal. What exists
is what the manifest lists, a table that is written when all tasks are done; readers
follow it and check every payload against its digest.

Scale: which record is the response is a map-side aggregation of digests; payloads
are shuffled once. A shard is streamed, never held.

Defined cases: null html is an empty payload; null urls are written as an empty
target; a null page id sorts first, is written without id and never is the response
of an id (such rows are dealt to shards of their own by payload); rows that share page id and payload are all written alike; an empty table
gives a manifest without rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import new_path, ship, written
from ledgerspark.llm.sharding import MAX_TASKS, one_per_task, shard_bounds, step_of

NO_PAGE = -(2**63)
MANIFEST = "shard int, part int, file string, records long, bytes long, first_page long, last_page long, sha256 string"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, "
          "file string, position long")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}/{digest}')}>"


def _uri(url: str | None) -> str:
    """A url on one line: white space and control characters are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: header block, empty line, block, two line ends."""
    digest = base32_sha1(payload)
    block = _HTTP if revisit else _HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page, digest)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{base32_sha1(block)}", f"X-Payload-Length: {len(payload)}"]
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Files:
    """The files of one shard, each under a temporary name until it is complete."""

    def __init__(self, folder: str, shard: int):
        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.part, self.out = shard, 0, None

    def add(self, member: bytes, page: int | None) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:08d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.fs.create_dir(f"{self.folder}/_temporary", recursive=True)
            self.out, self.bytes, self.records, self.first, self.sha = self.fs.open_output_stream(self.temporary), 0, 0, page, hashlib.sha256()
        self.out.write(member)
        self.sha.update(member)
        self.bytes, self.records, self.last = self.bytes + len(member), self.records + 1, page

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        self.out.close()
        self.out = None
        try:
            self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        except OSError:  # some stores do not rename over the equal file of an earlier attempt
            self.fs.delete_file(f"{self.folder}/{self.name}")
            self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        row = (self.shard, self.part, self.name, self.records, self.bytes, self.first, self.last, self.sha.hexdigest())
        self.part += 1
        return [row]


def _write(folder: str, file_bytes: int, level: int, date: str):
    names = [c.split()[0] for c in MANIFEST.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, decided = None, None

        def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found:
                cols = [pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(),
                                                                     pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            get = lambda c: b.column(b.schema.get_field_index(c))  # noqa: E731, B023
            for shard, page, kind, refers, digest, url, html in zip(*(get(c).to_pylist() for c in (
                    "shard", "page", "kind", "refers_to", "digest", "url", "html"))):
                if kind == 0:  # a decision stands before the pages of its id
                    if decided is None or decided[0] != (shard, page):
                        decided = ((shard, page), {})
                    decided[1][digest] = refers
                    continue
                if files is None or files.shard != shard:
                    yield from rows(files.close() if files else [])
                    files = _Files(folder, shard)
                payload = (html or "").encode("utf-8")
                refers = None
                if decided and decided[0] == (shard, page):
                    refers = decided[1].get(hashlib.sha1(payload).hexdigest())
                own = None if page == NO_PAGE else page
                files.add(_member(record(own, url, payload, refers, refers is not None, date), level), own)
                if files.bytes >= file_bytes:
                    yield from rows(files.close())
        yield from rows(files.close() if files else [])

    return write


def _to_shard(bounds: np.ndarray, unnamed: int):
    """Shards by page id, after the ``unnamed`` ones of rows without id."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page, hashed = (b.column(b.schema.get_field_index(c)) for c in ("page", "hashed"))
            by_id = pa.array((unnamed + np.searchsorted(bounds, page.to_numpy(), side="right")).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, pc.coalesce(hashed, by_id)], names=[*b.schema.names, "shard"])

    return deal


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, shard_bytes: int = 32 << 20, file_bytes: int = 16 << 20,
                   level: int = 4, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files into ``folder``, a URI that all executors reach.

    Returns the manifest, one row per file, which is also written to ``folder``/_manifest.
    """
    spark = pages.sparkSession
    ship(spark)
    page = F.coalesce(F.col("page_id").cast("long"), F.lit(NO_PAGE)).alias("page")
    html = F.coalesce("html", F.lit(""))
    light = written(pages.select(page, F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("n")), "warc-light")
    latest = light.where(F.col("n") >= least_bytes).groupBy("digest").agg(F.max("page").alias("last"), F.min("page").alias("first"))
    latest = written(latest.where("first < last").select("digest", "last"), "warc-latest")
    revisits = light.join(latest, "digest").where("page < last").select("page", "digest", F.col("last").alias("refers_to")).distinct()
    light = light.withColumn("n", F.col("n") + 512)
    bounds = shard_bounds(light.where(F.col("page") != NO_PAGE), "page", "n", shard_bytes)
    size = light.where(F.col("page") == NO_PAGE).agg(F.sum("n")).first()[0] or 0
    unnamed = -(-int(size) // step_of(int(size), shard_bytes))
    no = lambda kind: F.lit(None).cast(kind)
    decisions = revisits.select("page", F.lit(0).alias("kind"), "refers_to", "digest", no("string").alias("url"), no("string").alias("html"))
    rows = pages.select(page, F.lit(1).alias("kind"), no("long").alias("refers_to"), no("string").alias("digest"), "url", "html")
    # rows without id are dealt by payload, so that they meet their decisions
    payload = F.xxhash64(F.coalesce("digest", F.sha1(F.coalesce("html", F.lit("")))))
    hashed = F.when(F.col("page") == NO_PAGE, F.pmod(payload, F.lit(max(1, unnamed))).cast("int")).alias("hashed")
    schema = "page long, kind int, refers_to long, digest string, url string, html string, hashed int, shard int"
    both = decisions.unionByName(rows).select("*", hashed).mapInArrow(_to_shard(bounds, unnamed), schema)
    dealt = one_per_task(both, unnamed + len(bounds) + 1, "shard").sortWithinPartitions("shard", "page", "kind", "digest", "url", "html")
    manifest = dealt.mapInArrow(_write(folder, file_bytes, level, date), MANIFEST)
    manifest.write.parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _headers(f: io.BufferedIOBase) -> dict[str, str] | None:
    line = f.readline()
    if not line:
        return None
    if line.strip() != b"WARC/1.1":
        raise ValueError(f"not a record: {line[:40]!r}")
    out = {}
    while (line := f.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        out[name.decode().lower()] = value.strip().decode("utf-8")
    return out


def records(f: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an unzipped file."""
    while (head := _headers(f)) is not None:
        block = f.read(int(head["content-length"]))
        if f.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, block


def _read(folder: str, payloads: bool):
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64()]

    def rows(file: str, path: str, store: fs.FileSystem) -> Iterator[tuple]:
        with store.open_input_stream(path, compression="gzip", buffer_size=1 << 20) as f:
            for k, (head, block) in enumerate(records(io.BufferedReader(f, 1 << 20))):
                revisit = head["warc-type"] == "revisit"
                if head["warc-block-digest"] != f"sha1:{base32_sha1(block)}":
                    raise ValueError(f"{file}: record {k} does not match its block digest")
                payload = None if revisit else block[block.index(b"\r\n\r\n") + 4:]
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if payload is not None and (digest != base32_sha1(payload) or len(payload) != int(head["x-payload-length"])):
                    raise ValueError(f"{file}: record {k} does not match its payload digest")
                page, refers = head.get("x-page-id"), head.get("x-refers-to-page-id")
                yield (int(page) if page else None, head["warc-target-uri"], head["warc-type"], int(refers) if refers else None,
                       int(head["x-payload-length"]), digest, payload if payloads else None, file, k)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for file in b.column(0).to_pylist():
                some, size = [], 0
                for row in rows(file, f"{base}/{file}", store):
                    some.append(row)
                    size += len(row[6] or b"") + 200
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=names)
                        some, size = [], 0
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=names)

    return read


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files that the manifest lists, every digest checked. A file is read by one task, and there are at most MAX_TASKS tasks."""
    ship(manifest.sparkSession)
    n = min(max(1, manifest.count()), MAX_TASKS)
    return manifest.select("file").repartition(n, "file").mapInArrow(_read(folder, payloads), RECORD)


def query(spark, sf_dir: str) -> DataFrame:
    """op7: all pages written as WARC files and read back."""
    folder = new_path(spark, "warc")
    manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read_archives(manifest, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::INT >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '') AS payload_digest
  FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM m
"""
