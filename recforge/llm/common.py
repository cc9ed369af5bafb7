"""Helpers shared by the operators: null-safe inputs, flat Arrow text, scratch tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recforge.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of ``docs``; a null text becomes the empty string."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def text_digest(text: Column) -> Column:
    """256-bit key of a text: equal keys mean equal texts."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    The lineage ends at the files, so a lost executor costs a re-read and not
    a recomputation, and every later use sees the same rows.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column end to end, and the n + 1 offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def by_batch(make: Callable[..., dict], schema: pa.Schema, *columns: str):
    """A ``mapInArrow`` function: ``make`` turns the named columns of a batch into output columns."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = make(*(batch.column(batch.schema.get_field_index(c)) for c in columns))
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(
                        (out[f.name] for f in schema), schema)], schema=schema)
    return run


def local_path(path: str) -> str | None:
    """The local path of a ``file:`` address or plain path, else None."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return None if "://" in path else os.path.abspath(path)
