"""Token counts of whole texts through a digest cache.

The cache is a Parquet table (content, tokenizer, n_tokens) keyed by the
SHA-256 of the normalised content and of the tokenizer's version.  A run
reduces its texts to distinct contents, encodes only those that the cache
doesn't hold, appends their counts and joins every row to its count.  The
normalisation must not change a count: here, a null text becomes the empty one.

Nulls: a null text counts 0 tokens; a null id is an ordinary value.  Repeated
rows each get their row.  Empty table: no rows, and nothing is appended.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recforge.llm import common as C
from recforge.llm import words

_COUNTS = pa.schema([("content", pa.binary()), ("tokenizer", pa.string()), ("n_tokens", pa.int64())])
CACHE_DDL = "content binary, tokenizer string, n_tokens bigint"


def read_cache(spark, cache: str) -> DataFrame:
    """The cache's rows; an absent folder is an empty cache."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], CACHE_DDL)
    return spark.read.schema(CACHE_DDL).parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row; ``cache`` gains the counts it lacked.

    Two runs that append the same content leave two equal rows, so the cache
    is reduced to one row a key when it is read.
    """
    spark, version = docs.sparkSession, words.version(tokenizer)
    rows = C.texts(docs).withColumn("content", C.text_digest(F.col("text")))
    known = read_cache(spark, cache).where(F.col("tokenizer") == version)
    # One text for each content is kept within the tasks that read it, before the shuffle: a hot text costs a row a task.
    misses = rows.groupBy("content").agg(F.first("text").alias("text")).join(known, "content", "left_anti")

    def encode(content, text):
        ids = words.encoder(tokenizer).ids
        return {"content": content, "tokenizer": [version] * len(text),
                "n_tokens": [len(ids(t)) for t in text.to_pylist()]}

    misses.mapInArrow(C.by_batch(encode, _COUNTS, "content", "text"), CACHE_DDL).write.mode("append").parquet(cache)
    # A table of its own, so that Spark can split a hot content in the join.
    counts = C.written(read_cache(spark, cache).where(F.col("tokenizer") == version)
                       .groupBy("content").agg(F.min("n_tokens").alias("n_tokens")), "counts")
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "content") \
        .join(counts, "content").select("doc_id", "n_bytes", "n_tokens")
