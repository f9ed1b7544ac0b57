"""Landed news, a file per ticker, in one scan.

All files are one multi-path read: a line is a JSON object, a row is tagged with the ticker
in its file's path, and columns that differ between files are merged.  A ticker whose file
is absent or empty, cannot be read or holds a malformed line is left out and listed with the
reason; the others are not touched by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_malformed"
# Ticker of a file: its folder ticker=..., else the file's name without its endings.
IN_FOLDER, IN_NAME = r"/ticker=([^/]+)/", r"([^/]+?)\.(?:json|jsonl|txt)[^/]*$"


def _unescaped(path: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def _ticker(path: Column) -> Column:
    """Ticker of a file; names of partition folders are escaped."""
    path = _unescaped(path)
    folder = F.regexp_extract(path, IN_FOLDER, 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, IN_NAME, 1))


def _reader(spark: SparkSession):
    return (spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
            .option("ignoreMissingFiles", True))


def news_schema(spark: SparkSession, path: str) -> T.StructType:
    """Merged schema of all files (a pass over them; give the schema where it is known)."""
    found = _reader(spark).option("columnNameOfCorruptRecord", BAD).json(path).schema
    return T.StructType([f for f in found if f.name != BAD])


def tagged_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """ticker and ``row``, the line as ``schema`` with the malformed text in ``BAD``."""
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    return (_reader(spark).text(path).where(F.trim("value") != "")
            .select(_ticker(_unescaped(F.col("_metadata.file_path"))).alias("ticker"), parsed.alias("row")))


def news_status(spark: SparkSession, path: str, lines: DataFrame, tickers: DataFrame | None = None) -> DataFrame:
    """ticker, n_rows, reason (NULL: its news can be used) of the wanted tickers (default: all that have a file)."""
    # names and sizes only: the content column is not read
    files = (_reader(spark).format("binaryFile").load(path).select(_ticker(F.col("path")).alias("ticker"), "length")
             .groupBy("ticker").agg(F.sum("length").alias("length")))
    counts = lines.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.count(F.col("row").getField(BAD)).alias("n_bad"))
    wanted = files.select("ticker") if tickers is None else tickers.select("ticker").distinct()
    reason = (F.when(F.col("length").isNull(), "absent or empty").when(F.col("n_bad") > 0, "malformed line")
              .when(F.col("n_rows").isNull() & (F.col("length") > 0), "unreadable"))
    return (wanted.join(files, "ticker", "left").join(counts, "ticker", "left")
            .select("ticker", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), reason.alias("reason")))


def usable_news(lines: DataFrame, status: DataFrame) -> DataFrame:
    """All columns of the tickers without a reason against them, and ``ticker``."""
    good = status.where(F.col("reason").isNull()).select("ticker")
    fields = [f.name for f in lines.schema["row"].dataType if f.name not in (BAD, "ticker")]
    return (lines.join(good, "ticker", "left_semi")
            .select(*[F.col("row").getField(f).alias(f) for f in fields], "ticker"))


def read_news(spark: SparkSession, path: str, tickers: DataFrame | None = None,
              schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """News of the wanted tickers, and their status."""
    lines = tagged_lines(spark, path, schema or news_schema(spark, path))
    status = news_status(spark, path, lines, tickers)
    return usable_news(lines, status), status
