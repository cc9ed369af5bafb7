"""WARC archives with a two-level capture index.

Writing.  Every page becomes a record of a WARC file, compressed as a member of
its own, so that it can be read alone.  Of records with equal payloads of at
least ``MIN_REVISIT`` bytes the one with the largest page id is a response, and the
others are revisits that refer to it and hold no payload.  Which one it is comes
from digests alone; payloads are shuffled once, by a key that no two different
rows share, so copies of a payload don't gather.

Index, level one: captures are sorted by their reversed-host URL key and page id and
cut into compressed blocks of ``BLOCK`` lines, range by range, one file a range.
Level two: each range has a sparse directory, the first key and place of each
block, as an Arrow file that is searched where it lies (memory-mapped if local).
Only the ranges' own first keys, a row for each of Spark's partitions, of at most
``KEY_CHARS`` + 65 characters, pass through the driver.

Lookup.  Wanted keys are sorted as the index is; each is found by binary search over
ranges, over a directory and in one decompressed block, which neighbouring keys
share.  Records are then fetched by range reads in the order of their places.
A revisit's payload is read from the response that it names, found the same way.

Files carry a name that no other attempt has, and only the files of attempts
that counted are in the index: a lost executor's files are never referred to.

Nulls: a null html has no bytes; a null url has the empty key; a null page id is
smaller than any other.  Rows alike in every column used have a record each; if they are the
largest of equal payloads, one of them is the response.  A very long payload is one record;
a very long URL's key ends in its digest.  Empty table: no files, no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm.arrowfile import filesystem

MIN_REVISIT = 1000  # bytes of a payload whose copies are revisits
BLOCK = 3000  # lines of an index block
FILE_BYTES = 1 << 28  # compressed bytes after which a task begins another archive
KEY_CHARS = 512  # of a URL key before its tail is replaced by a digest
DATE = "1970-01-01T00:00:00Z"  # pages have no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://")


def safe(url: str) -> str:
    """The URL with white space and control characters of ASCII percent-encoded."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str | None) -> str:
    """Reversed-host sort key: ``com,example)/path?query`` of ``http://example.com/path?query#part``."""
    rest = safe(url or "").partition("#")[0]
    rest = rest[_SCHEME.match(rest).end():] if _SCHEME.match(rest) else rest
    end = next((i for i, c in enumerate(rest) if c in "/?"), len(rest))
    host, _, port = rest[:end].rpartition("@")[2].lower().partition(":")
    if not re.fullmatch(r"[0-9.]+", host):
        host = ",".join(reversed(host.split(".")))
    key = host + (f":{port}" if port not in ("", "80", "443") else "") + (")" if host else "") + rest[end:]
    return key if len(key) <= KEY_CHARS else f"{key[:KEY_CHARS]}~{hashlib.sha256(key.encode()).hexdigest()}"


# Records

def record_id(key: bytes, copy: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(key + copy.to_bytes(8, 'big')).digest()[:16])}>"


def headers(first: str, fields: Iterable[tuple[str, object]]) -> bytes:
    return "".join([first, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def record(kind: str, own_id: str, url: str | None, page_id: int | None, digest: str, n_bytes: int, payload: bytes | None,
           refers_to: tuple[str, str | None, int | None] | None = None) -> bytes:
    """One record as a gzip member; a revisit holds the HTTP headers without the payload."""
    http = headers("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", n_bytes)])
    block = http + (payload or b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Date", DATE), ("WARC-Target-URI", safe(url) if url else None),
              ("Page-ID", page_id), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if refers_to:
        target, target_url, target_page = refers_to
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", target), ("WARC-Refers-To-Target-URI", safe(target_url) if target_url else None),
                   ("WARC-Refers-To-Date", DATE), ("Refers-To-Page-ID", target_page)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return gzipped(headers("WARC/1.1", fields) + block + b"\r\n\r\n")


def gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's header fields, in lower case, and its block."""
    raw = zlib.decompress(data, 31)
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return fields, raw[end + 4:end + 4 + int(fields["content-length"])]


# Writing

def keyed(pages: DataFrame) -> DataFrame:
    """(k, page_id, url, payload, same): ``same`` is a payload's identity, ``k`` that of a row."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    text = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("~")),
                       F.coalesce(F.concat(F.lit("u"), "url"), F.lit("~")), "same")
    return rows.withColumn("k", F.unhex(F.sha2(text.cast("binary"), 256)))


def roles(rows: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(k, copies, target): equal rows, and the row that the others of an equal payload refer to, if there are others."""
    alike = rows.select("k", "page_id", "url", "same", F.octet_length("payload").alias("n_bytes")).groupBy("k").agg(
        *(F.first(c).alias(c) for c in ("page_id", "url", "same", "n_bytes")), F.count(F.lit(1)).alias("copies"))
    last = alike.where(F.col("n_bytes") >= min_revisit).groupBy("same").agg(
        F.max(F.struct("page_id", "url", "k")).alias("target"), F.sum("copies").alias("rows")).where("rows > 1").drop("rows")
    return alike.join(last, "same", "left").select("k", "copies", "target")


_CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("kind", pa.string()), ("file", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])
_CAPTURE_DDL = "key string, page_id bigint, kind string, file string, offset bigint, length bigint"


class Output:
    """A file under a name of this attempt's own."""

    def __init__(self, folder: str, stem: str, suffix: str):
        self.name, self.size = f"{stem}-{uuid.uuid4().hex}{suffix}", 0
        system, inside = filesystem(f"{folder}/{self.name}")
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        self.sink = system.open_output_stream(inside, compression=None)  # members are compressed one by one

    def add(self, data: bytes) -> tuple[int, int]:
        """Where the data went: offset and length."""
        self.sink.write(data)
        self.size += len(data)
        return self.size - len(data), len(data)


def write_records(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives; returns the captures (key, page_id, kind, file, offset, length), a table in ``folder``."""
    rows = keyed(pages)
    payloads = rows.groupBy("k").agg(*(F.first(c).alias(c) for c in ("page_id", "url", "payload")))
    made = payloads.join(roles(rows, min_revisit), "k").select(
        "k", "page_id", "url", "payload", "copies", F.col("target.k").alias("target_k"), F.col("target.url").alias("target_url"),
        F.col("target.page_id").alias("target_page"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        for batch in batches:
            found = {c: [] for c in _CAPTURE.names}
            for i in range(batch.num_rows):
                k, page_id, url, payload, copies, target_k, target_url, target_page = (c[i].as_py() for c in batch.columns)
                digest = hashlib.sha1(payload).hexdigest()
                for copy in range(copies):
                    if out is not None and out.size >= file_bytes:
                        out.sink.close()
                        out = None
                    if out is None:
                        out = Output(f"{folder}/archive", f"{part:06d}", ".warc.gz")
                        info = b"software: recforge\r\nformat: WARC File Format 1.1\r\n"
                        out.add(gzipped(headers("WARC/1.1", [
                            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(out.name.encode(), 0)), ("WARC-Date", DATE),
                            ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))]) + info + b"\r\n\r\n"))
                    first = target_k is None or (k == target_k and copy == 0)
                    at, n = out.add(record(
                        "response" if first else "revisit", record_id(k, copy), url, page_id, digest, len(payload),
                        payload if first else None, None if first else (record_id(target_k, 0), target_url, target_page)))
                    for c, v in zip(_CAPTURE.names, (url_key(url), page_id, "response" if first else "revisit", out.name, at, n)):
                        found[c].append(v)
            yield pa.RecordBatch.from_pydict(found, schema=_CAPTURE)
        if out is not None:
            out.sink.close()

    made.mapInArrow(write, _CAPTURE_DDL).write.parquet(f"{folder}/captures")
    return pages.sparkSession.read.schema(_CAPTURE_DDL).parquet(f"{folder}/captures")


# The index

Key = tuple[str, bool, int]


def sort_key(key: str, page_id: int | None) -> Key:
    return key, page_id is not None, page_id or 0


_DIRECTORY = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
_SHARD = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("blocks", pa.string()), ("directory", pa.string())])
_SHARD_DDL = "key string, page_id bigint, blocks string, directory string"


def lines_of(rows: Iterable[tuple]) -> bytes:
    return zlib.compress("\n".join("\t".join("-" if x is None else str(x) for x in r) for r in rows).encode())


def rows_of(block: bytes) -> list[tuple]:
    rows = []
    for line in zlib.decompress(block).decode().split("\n"):
        key, page_id, kind, file, offset, length = line.split("\t")
        rows.append((key, None if page_id == "-" else int(page_id), kind, file, int(offset), int(length)))
    return rows


def write_index(captures: DataFrame, folder: str, block: int = BLOCK) -> DataFrame:
    """Write blocks and directories; returns the ranges (first key and page id, the two files), a table in ``folder``."""
    ordered = captures.select(*_CAPTURE.names).repartitionByRange("key", "page_id") \
        .sortWithinPartitions("key", "page_id", "file", "offset")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part, waiting, first = None, TaskContext.get().partitionId(), [], []
        for batch in batches:
            waiting += zip(*(c.to_pylist() for c in batch.columns))
            while len(waiting) >= block:
                out = out or Output(f"{folder}/index", f"{part:06d}", ".cdx")
                first.append((*waiting[0][:2], *out.add(lines_of(waiting[:block]))))
                waiting = waiting[block:]
        if waiting:
            out = out or Output(f"{folder}/index", f"{part:06d}", ".cdx")
            first.append((*waiting[0][:2], *out.add(lines_of(waiting))))
        if out:
            out.sink.close()
            directory = Output(f"{folder}/index", f"{part:06d}", ".dir")
            with pa.ipc.new_file(directory.sink, _DIRECTORY) as file:
                file.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*first), _DIRECTORY)], schema=_DIRECTORY))
            directory.sink.close()
            yield pa.RecordBatch.from_pydict(dict(zip(_SHARD.names, ([x] for x in (*first[0][:2], out.name, directory.name)))), schema=_SHARD)

    ordered.mapInArrow(write, _SHARD_DDL).write.parquet(f"{folder}/ranges")
    return captures.sparkSession.read.schema(_SHARD_DDL).parquet(f"{folder}/ranges")


@lru_cache(64)
def handle(path: str):
    system, inside = filesystem(path)
    return system.open_input_file(inside)


def read_range(path: str, offset: int, length: int) -> bytes:
    file = handle(path)
    file.seek(offset)
    return file.read(length)


class Directory:
    """A range's directory, searched where it lies."""

    def __init__(self, path: str):
        local = C.local_path(path)
        table = pa.ipc.open_file(pa.memory_map(local) if local else handle(path)).read_all()  # views, if mapped
        self.columns = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]

    def __len__(self) -> int:
        return len(self.columns[0])

    def __getitem__(self, i: int) -> Key:
        return sort_key(self.columns[0][i].as_py(), self.columns[1][i].as_py())

    def place(self, i: int) -> tuple[int, int]:
        return self.columns[2][i].as_py(), self.columns[3][i].as_py()


@lru_cache(16)
def directory(path: str) -> Directory:
    return Directory(path)


@lru_cache(4)
def block_rows(path: str, offset: int, length: int) -> tuple[list[Key], list[tuple]]:
    rows = rows_of(read_range(path, offset, length))
    return [sort_key(*r[:2]) for r in rows], rows


@dataclass(frozen=True)
class Index:
    """The ranges in order: their first keys, and the names of their two files in ``folder``."""
    folder: str
    firsts: tuple[Key, ...]
    files: tuple[tuple[str, str], ...]

    def captures(self, key: str, page_id: int | None) -> Iterator[tuple]:
        """The captures (as in ``_CAPTURE``) of a key and page id, by three binary searches."""
        want = sort_key(key, page_id)
        shard = max(0, bisect_left(self.firsts, want) - 1)
        while shard < len(self.firsts) and self.firsts[shard] <= want:
            blocks, names = (f"{self.folder}/index/{x}" for x in self.files[shard])
            sparse = directory(names)
            i = max(0, bisect_left(sparse, want) - 1)
            while i < len(sparse) and sparse[i] <= want:
                keys, rows = block_rows(blocks, *sparse.place(i))
                at = bisect_left(keys, want)
                while at < len(keys) and keys[at] == want:
                    yield rows[at]
                    at += 1
                i += 1
            shard += 1


def opened(spark: SparkSession, folder: str) -> Index:
    """The index of a folder; a row for each of its ranges (Spark partitions) reaches the driver."""
    found = sorted((sort_key(r.key, r.page_id), (r.blocks, r.directory))
                   for r in spark.read.schema(_SHARD_DDL).parquet(f"{folder}/ranges").collect())
    return Index(folder, tuple(k for k, _ in found), tuple(f for _, f in found))


def write(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, block: int = BLOCK, file_bytes: int = FILE_BYTES) -> Index:
    """Write archives and index of (page_id, url, html) under ``folder``."""
    write_index(write_records(pages, folder, min_revisit, file_bytes), folder, block)
    return opened(pages.sparkSession, folder)


# Reading

_WANTED = pa.schema([("key", pa.string()), ("page_id", pa.int64())])


def locate(index: Index, wanted: DataFrame) -> DataFrame:
    """The captures of the (url, page_id) rows of ``wanted``, each once."""
    def to_keys(url, page_id):
        return {"key": [url_key(u) for u in url.to_pylist()], "page_id": page_id}

    def look_up(batches):
        for batch in batches:
            rows = [r for k, p in zip(*(c.to_pylist() for c in batch.columns)) for r in index.captures(k, p)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_CAPTURE)], schema=_CAPTURE)

    keys = wanted.select("url", "page_id").distinct().mapInArrow(
        C.by_batch(to_keys, _WANTED, "url", "page_id"), "key string, page_id bigint").distinct()
    return keys.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id").mapInArrow(look_up, _CAPTURE_DDL)


_RECORD = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("payload", pa.binary()), ("refers_id", pa.string()), ("refers_url", pa.string()),
                     ("refers_to", pa.int64())])
_RECORD_DDL = "record_id string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, " \
              "payload binary, refers_id string, refers_url string, refers_to bigint"


def fetch(index: Index, places: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at the places of captures, by range reads in file order.  A response's size and digest are
    those of the payload as read, which must agree with its header; a revisit's digest is its header's."""
    def number(x):
        return None if x is None else int(x)

    def read(batches):
        for batch in batches:
            out = {c: [] for c in _RECORD.names}
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                fields, block = parsed(read_range(f"{index.folder}/archive/{name}", offset, length))
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                body = size = None
                if fields["warc-type"] == "response":
                    body = block[block.index(b"\r\n\r\n") + 4:]
                    size = len(body)
                    if hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"{name}: payload at {offset} doesn't have its digest")
                for c, v in zip(_RECORD.names, (
                        fields["warc-record-id"], number(fields.get("page-id")), fields["warc-type"], size, digest,
                        body if payloads else None, fields.get("warc-refers-to"), fields.get("warc-refers-to-target-uri"),
                        number(fields.get("refers-to-page-id")))):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=_RECORD)

    return places.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset") \
        .mapInArrow(read, _RECORD_DDL)


def read_pages(index: Index, wanted: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of the (url, page_id) rows
    of ``wanted``; a revisit's size and digest are those of the payload of the response that it names."""
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    records = C.written(fetch(index, locate(index, wanted), payloads=False).drop("payload"), "records")
    revisits = records.where("record_type = 'revisit'")
    named = revisits.select(F.col("refers_url").alias("url"), F.col("refers_to").alias("page_id"))
    responses = fetch(index, locate(index, named).where("kind = 'response'"), payloads=False).select(
        F.col("record_id").alias("refers_id"), F.col("payload_bytes").alias("_size"), F.col("payload_digest").alias("_digest"))
    same = F.when(F.col("_digest") == F.col("payload_digest"), F.col("_digest")) \
        .otherwise(F.raise_error(F.lit("a revisit's digest isn't that of its response")))
    resolved = revisits.join(responses, "refers_id").withColumn("payload_bytes", F.col("_size")).withColumn("payload_digest", same)
    return records.where("record_type != 'revisit'").select(*columns).unionByName(resolved.select(*columns))
