"""Arrays in the checkpoint folder, for steps over a large table that change only a row of numbers for each id.

A step that joins would send the table, or a vector for each of its rows, every time.  Here ids are numbered 0 .. n - 1,
the table's rows are laid once, in the order of an id's number, as files of at most ``PART`` rows, and a matrix with a row for each
number is one file.  A step's task reads a part, looks up rows of the last step's matrix through a memory map, and
writes its own ids' rows of the next one, so nothing is exchanged in a step.  Rows of one id may be cut between parts; what
is known of a part's first and last id goes to the driver, which adds it up: two rows for each part.

What a task writes depends on nothing but its input, so an attempt that is repeated writes the same bytes to the same places.
The folder must be one that all executors see as files.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from recforge.operators.prefix import prefix_sum
from recforge.session import ensure_checkpoint_dir

PART = 1 << 17  # rows of a file


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint directory, as a local path."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if "://" in path and not path.startswith("file:"):
        raise ValueError("spark.checkpoint.dir must be a folder that all executors see as files")
    path = "/" + path[5:].lstrip("/") if path.startswith("file:") else os.path.abspath(path)
    os.makedirs(path)
    return path


def stored(df: DataFrame, name: str, into: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: compressed, and read by columns, as a checkpoint isn't.
    ``into``: a ``folder`` whose maker drops the files when they have been read."""
    path = f"file://{into}/{name}" if into else f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """(name, at): the distinct ids, null aside, numbered from 0 in their order, and how many there are."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select(name).where(F.col(name).isNotNull()).distinct().withColumn("_one", F.lit(1))
    ids = stored(prefix_sum(ids, [name], "_one", "_rank", parts).select(name, (F.col("_rank") - 1).alias("at")), "numbers")
    return ids, ids.count()


def drop(into: str, *names: str) -> None:
    """Removes what is read no more: stored tables of a folder, or the folder itself."""
    for path in [f"{into}/{name}" for name in names] or [into]:
        shutil.rmtree(path)


@dataclass(frozen=True)
class Part:
    """A file of rows in the order of their number, and the least and largest number in it."""
    path: str
    lo: int
    hi: int


def lay(rows: DataFrame, n: int, at: str, kinds: dict[str, type], into: str, size: int = PART) -> list[Part]:
    """Writes the columns ``kinds`` of the ``n`` rows, numbers or equally long arrays of them, in the order of ``at``.

    The driver holds a line for each file."""
    parts = max(1, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // size)))
    others = [F.col(c) for c in kinds if c != at]
    dealt = rows.select(*kinds).repartitionByRange(parts, at, F.xxhash64(*others) if others else at).sortWithinPartitions(at)

    def written(table: pa.Table) -> pa.RecordBatch:
        arrays = {}
        for c, kind in kinds.items():
            column = table[c].combine_chunks()
            if pa.types.is_list(column.type):
                arrays[c] = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(kind)
            else:
                arrays[c] = column.to_numpy(zero_copy_only=False).astype(kind)
        path = f"{uuid.uuid4().hex}.npz"
        np.savez(f"{into}/{path}", **arrays)
        return pa.RecordBatch.from_pydict({"path": [path], "lo": [int(arrays[at][0])], "hi": [int(arrays[at][-1])]})

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                some = batch.slice(a, size)
                if n + some.num_rows > size and held:
                    yield written(pa.Table.from_batches(held))
                    held, n = [], 0
                held.append(some)
                n += some.num_rows
        if held:
            yield written(pa.Table.from_batches(held))

    found = dealt.mapInArrow(run, "path string, lo bigint, hi bigint").collect()
    return sorted((Part(f"{into}/{r['path']}", r["lo"], r["hi"]) for r in found), key=lambda p: (p.lo, p.hi, p.path))


def each_part(spark: SparkSession, parts: Sequence, work: Callable[[object], dict], ddl: str) -> list[Row]:
    """What ``work`` makes of each part, a row of ``ddl`` each, with a task for each core that there is at most."""
    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([work(parts[k])], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(ddl))
    return spark.range(0, len(parts), 1, min(len(parts), spark.sparkContext.defaultParallelism)).mapInArrow(run, ddl).collect() if parts else []


class Matrix:
    """n rows of ``width`` doubles as one file."""

    def __init__(self, path: str, n: int, width: int):
        self.path, self.n, self.width = path, n, width

    def made(self) -> Matrix:
        """The file itself, of zeros."""
        with open(self.path, "wb") as f:
            f.truncate(self.n * self.width * 8)
        return self

    def read(self) -> np.ndarray:
        return np.memmap(self.path, np.float64, "r", shape=(self.n, self.width)) if self.n else np.zeros((0, self.width))

    def write(self, first: int, rows: np.ndarray) -> None:
        with open(self.path, "r+b") as f:
            f.seek(first * self.width * 8)
            f.write(np.ascontiguousarray(rows, np.float64).tobytes())

    def drop(self) -> None:
        os.remove(self.path)


def table(ids: DataFrame, name: str, matrix: Matrix, out: str) -> DataFrame:
    """(name, out): each id's row of the matrix."""
    schema = pa.schema([("id", pa.int64()), ("vec", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            rows = matrix.read()[batch.column(1).to_numpy()]
            ends = np.arange(0, rows.size + 1, matrix.width, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, rows.ravel())], schema=schema)

    rows = ids.select(F.col(name).cast("bigint").alias("id"), "at").mapInArrow(run, "id bigint, vec array<double>")
    return rows.select(F.col("id").alias(name), F.col("vec").alias(out))


def ranges(n: int, size: int = 1 << 16) -> list[tuple[int, int]]:
    return [(a, min(n, a + size)) for a in range(0, n, size)]
