"""File sources and sinks of the reference's jobs.

Writers are distributed: every executor writes its own part files.  A single
CSV part (the reference's ``repartition(1)``) is available as an opt-in for
small exports only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("productId", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
PRODUCTS_SCHEMA = T.StructType([
    T.StructField("productId", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("types", T.StringType()),
])

# Sample CSV as the click models read it (column -> type).
SAMPLE_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("userId", "productId")]
    + [T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType()),
       T.StructField("label", T.IntegerType()), T.StructField("releaseYear", T.IntegerType())]
    + [T.StructField(f"productType{i}", T.StringType()) for i in range(1, 4)]
    + [T.StructField("productRatingCount", T.IntegerType()), T.StructField("productAvgRating", T.DoubleType()),
       T.StructField("productRatingStddev", T.DoubleType())]
    + [T.StructField(f"userRatedproduct{i}", T.LongType()) for i in range(1, 6)]
    + [T.StructField("userRatingCount", T.IntegerType()), T.StructField("userAvgReleaseYear", T.IntegerType()),
       T.StructField("userReleaseYearStddev", T.DoubleType()), T.StructField("userAvgRating", T.DoubleType()),
       T.StructField("userRatingStddev", T.DoubleType())]
    + [T.StructField(f"userType{i}", T.StringType()) for i in range(1, 6)]
)


def read_ratings(spark: SparkSession, path: str, typed: bool = True) -> DataFrame:
    """S1 (+S2): ratings CSV with header; typed columns via try_cast (a bad
    value becomes null instead of failing the job)."""
    df = spark.read.csv(path, header=True, schema=RATINGS_SCHEMA)
    if not typed:
        return df
    return df.select(
        F.col("userId").try_cast("long").alias("userId"),
        F.col("productId").try_cast("long").alias("productId"),
        F.col("rating").try_cast("double").alias("rating"),
        F.col("timestamp").try_cast("long").alias("ts"),
    )


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Products CSV with header."""
    df = spark.read.csv(path, header=True, schema=PRODUCTS_SCHEMA)
    return df.select(F.col("productId").try_cast("long").alias("productId"), "title", "types")


def write_samples(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """S3: overwrite; CSV with header (or parquet).  ``single_file`` funnels
    everything through one task: only for small exports."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def write_embeddings(df: DataFrame, path: str, key: str = "productId", emb: str = "emb") -> None:
    """Text lines ``id:v1 v2 ... vn`` written by the executors."""
    line = F.concat(F.col(key).cast("string"), F.lit(":"),
                    F.array_join(F.transform(emb, lambda x: x.cast("string")), " "))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_embeddings(spark: SparkSession, path: str, key: str = "productId") -> DataFrame:
    """Inverse of S4."""
    raw = spark.read.text(path)
    parts = F.split("value", ":", 2)
    return raw.select(parts[0].alias(key), F.transform(F.split(parts[1], " "), lambda x: x.cast("float")).alias("emb"))


_FIELDS = "_fields"  # how many fields a row has
_QUOTED = r'"(?:[^"\\]|\\.)*"'


def _read_sample_text(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Every column as it is written, since numbers may hold thousands separators, and the row's number of fields.

    Rows are lines.  Spark's CSV reader fills short rows and cuts long ones without a word, so fields are counted
    first: commas outside quotes.  A header is the line of the columns' names.  Each line is parsed once: a filter isn't
    pushed below the generator, where it would parse the line again for each field it looks at."""
    names = [f.name for f in SAMPLE_SCHEMA.fields]
    lines = spark.read.text(path).where("trim(value) != ''")
    if header:
        lines = lines.where(F.col("value") != ",".join(names))
    bare = F.when(F.contains("value", F.lit('"')), F.regexp_replace("value", _QUOTED, "q")).otherwise(F.col("value"))
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    row = F.from_csv("value", ", ".join(f"{n} string" for n in names))
    return lines.select(fields.alias(_FIELDS), F.explode(F.array(row)).alias("r")).select(_FIELDS, "r.*")


def _number(name: str, kind: T.DataType) -> Column:
    plain = F.replace(F.trim(F.col(name)), F.lit(","), F.lit(""))
    return plain.try_cast("double").cast(kind) if isinstance(kind, (T.IntegerType, T.LongType)) else plain.try_cast(kind)


def _unreadable() -> Column:
    """Whether a number's field has text that is none; an empty field is not unreadable."""
    wrong = F.lit(False)
    for f in SAMPLE_SCHEMA.fields:
        if not isinstance(f.dataType, T.StringType):
            wrong = wrong | ((F.coalesce(F.trim(F.col(f.name)), F.lit("")) != "") & _number(f.name, f.dataType).isNull())
    return wrong


def read_samples(spark: SparkSession, path: str, header: bool = True, skip_malformed: bool = True) -> DataFrame:
    """Sample CSV as the click models read it: numbers without their thousands separators, empty ones 0, null text ''.

    Malformed rows (too few or too many fields, or text where a number should be) are skipped, as the models' readers
    do; ``malformed_samples`` counts them.  ``skip_malformed=False`` keeps them, with 0 and '' for what can't be read.
    """
    df = _read_sample_text(spark, path, header)
    if skip_malformed:
        df = df.where((F.col(_FIELDS) == len(SAMPLE_SCHEMA.fields)) & ~_unreadable())
    return df.select(*(
        F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.coalesce(_number(f.name, f.dataType), F.lit(0).cast(f.dataType)).alias(f.name)
        for f in SAMPLE_SCHEMA.fields))


def malformed_samples(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """One row: all ``rows``, those with ``wrong_fields`` in number, those otherwise ``unreadable``, and those ``kept``."""
    short_or_long, wrong = F.col(_FIELDS) != len(SAMPLE_SCHEMA.fields), _unreadable()
    flagged = _read_sample_text(spark, path, header).select(short_or_long.alias("f"), (~short_or_long & wrong).alias("u"))
    return flagged.agg(F.count(F.lit(1)).alias("rows"), F.count_if("f").alias("wrong_fields"), F.count_if("u").alias("unreadable"),
                       F.count_if(~F.col("f") & ~F.col("u")).alias("kept"))


def save_model(model, path: str) -> None:
    """Persist a fitted pyspark.ml model, overwriting."""
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    """Load a model saved by ``save_model`` (``cls`` = its model class)."""
    return cls.load(path)
