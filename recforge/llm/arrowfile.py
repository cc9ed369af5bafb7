"""Token ids as Arrow files of fixed-size lists, read back by position without copies.

Documents in ascending order of id become one stream of ids, an end id after
each.  Every range of documents is one task, which writes the stream of its
documents to files: record batches of ``SEQUENCES`` sequences of ``length``
ids (FixedSizeList), and a mask of the same shape that is true where an id is
and false in the padding after a file's last one.  Position p of a file's
stream is in batch p // (SEQUENCES * length), and the values of a batch are
one flat buffer, so any stretch is read from a memory map without copying or
looking at what is before it.

Files are written under a name that no other attempt has; the index, an
ordinary Spark table, names those of the attempts that counted.  A lost
executor's files are never referred to.

Order among rows of one id: by hash of the text, then by input partition.
Nulls: a null id sorts first, a null text is empty and has the end id alone.
Empty table: no files, no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm import words

SEQUENCES = 256  # a record batch
FILE_IDS = 1 << 25  # ids after which a task begins another file
_INDEX = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("shard", pa.int32()), ("file_no", pa.int32()),
                    ("at", pa.int64()), ("n_tokens", pa.int64())])
INDEX_DDL = "doc_id bigint, file string, shard int, file_no int, at bigint, n_tokens bigint"


def filesystem(path: str):
    """The Arrow file system of a path or address, and the path in it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class Writer:
    """One file of the stream of ids."""

    def __init__(self, path: str, length: int, dtype: np.dtype):
        self.length, self.dtype, self.left, self.size = length, dtype, [], 0
        self.waiting = 0
        values = pa.field("item", pa.from_numpy_dtype(dtype), nullable=False)
        mask = pa.field("item", pa.bool_(), nullable=False)
        self.schema = pa.schema([("ids", pa.list_(values, length)), ("mask", pa.list_(mask, length))])
        system, inside = filesystem(path)
        system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        self.sink = system.open_output_stream(inside)
        self.file = pa.ipc.new_file(self.sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.left.append(ids)
        self.size += len(ids)
        self.waiting += len(ids)
        if self.waiting >= SEQUENCES * self.length:
            self.flush()

    def flush(self, last: bool = False) -> None:
        ids, step = np.concatenate(self.left) if self.left else np.zeros(0, self.dtype), SEQUENCES * self.length
        full = len(ids) if last else len(ids) // step * step
        for at in range(0, full, step):
            self.batch(ids[at:min(at + step, full)])
        self.left, self.waiting = [ids[full:]], len(ids) - full

    def batch(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        flat, mask = np.zeros(rows * self.length, self.dtype), np.zeros(rows * self.length, bool)
        flat[:len(ids)], mask[:len(ids)] = ids, True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self.flush(last=True)
        self.file.close()
        self.sink.close()


@lru_cache(4)
def opened(path: str):
    """A file's reader, memory-mapped where the path is local."""
    local = C.local_path(path)
    if local:
        return pa.ipc.open_file(pa.memory_map(local))
    system, inside = filesystem(path)
    return pa.ipc.open_file(system.open_input_file(inside))


def stretch(path: str, at: int, n: int) -> list[np.ndarray]:
    """Views of the ids at [at, at + n) of a file, one for each batch that they lie in."""
    file, views = opened(path), []
    step = SEQUENCES * file.schema.field("ids").type.list_size
    while n:
        values = file.get_batch(at // step).column(0).values.to_numpy(zero_copy_only=True)
        views.append(values[at % step:at % step + n])
        at, n = at + len(views[-1]), n - len(views[-1])
    return views


def write_ids(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, length: int = 2048,
              file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of ``docs`` under ``folder``; returns the index as a table read from there.

    The index has a row for each document: doc_id, file, shard and file_no (the
    order of files), at (its place in the file's stream) and n_tokens.  Ids are
    16 bits wide if the vocabulary allows.
    """
    dtype = np.dtype(np.uint16 if max(words.load(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else np.uint32)
    # Texts and not ids are shuffled: they compress, and sampling the ranges then needn't encode anything.
    ordered = C.texts(docs).withColumn("h", F.xxhash64("text")).withColumn("p", F.spark_partition_id()) \
        .repartitionByRange("doc_id", "h", "p").sortWithinPartitions("doc_id", "h", "p") \
        .select("doc_id", "text", F.spark_partition_id().alias("shard"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = words.encoder(tokenizer).ids, np.array([end_id], dtype)
        writer = path = None
        attempt, number = uuid.uuid4().hex, 0
        for batch in batches:
            rows = {name: [] for name in _INDEX.names}
            for doc_id, text, shard in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if writer and writer.size >= file_ids:
                    writer.close()
                    writer, number = None, number + 1
                if not writer:
                    path = f"{folder}/ids/{shard:06d}-{number:04d}-{attempt}.arrow"
                    writer = Writer(path, length, dtype)
                ids = np.append(encode(text).astype(dtype), end)
                for name, x in zip(_INDEX.names, (doc_id, path, shard, number, writer.size, len(ids))):
                    rows[name].append(x)
                writer.add(ids)
            yield pa.RecordBatch.from_pydict(rows, schema=_INDEX)
        if writer:
            writer.close()

    ordered.mapInArrow(write, INDEX_DDL).write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(INDEX_DDL).parquet(f"{folder}/index")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all documents before each one.

    Only the files' totals are summed in order: a row for each file.
    """
    files = index.groupBy("shard", "file_no", "file").agg(F.sum("n_tokens").alias("ids"))
    order = Window.orderBy("shard", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("file", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))
    return index.join(F.broadcast(before), "file").withColumn("start", F.col("before") + F.col("at")) \
        .drop("before")


_CRC = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_digests(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32), the ids read from the files."""
    def digest(doc_id, file, at, n_tokens, start):
        crcs = []
        for path, place, n in zip(file.to_pylist(), at.to_pylist(), n_tokens.to_pylist()):
            crc = 0
            for view in stretch(path, place, n):
                crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
            crcs.append(crc)
        return {"doc_id": doc_id, "start": start, "n_tokens": n_tokens, "ids_crc32": crcs}

    return with_starts(index).mapInArrow(
        C.by_batch(digest, _CRC, "doc_id", "file", "at", "n_tokens", "start"),
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
