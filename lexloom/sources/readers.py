"""Readers with fixed schemas: nothing is inferred, bad rows are kept aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_C1 = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_WINDOWS = "".join(map(chr, _C1)), bytes(_C1).decode("cp1252")


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of saved pages: UTF-8, else windows-1252."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    utf8 = F.try_validate_utf8(F.col("content").cast("string"))
    # Spark decodes Latin-1, which differs from windows-1252 in the bytes from 0x80 to 0x9F alone
    return raw.select("path", F.coalesce(utf8, F.translate(F.decode("content", "ISO-8859-1"), *_WINDOWS)).alias("html"))


def records(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """JSON lines, or one document a file, with a column for what doesn't parse."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("multiLine", str(not lines).lower()).json(path)


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", encoding: str = "UTF-8", null_dates: bool = True) -> DataFrame:
    """CSV or TSV with a header; the sentinel day 1900-01-01 and -8 become null."""
    df = spark.read.schema(schema).csv(path, sep=sep, header=True, encoding=encoding, mode="PERMISSIVE")
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if null_dates and kind == "date":
            df = df.withColumn(f.name, F.nullif(f.name, F.lit("1900-01-01").cast("date")))
        elif kind in ("int", "bigint"):
            df = df.withColumn(f.name, F.nullif(f.name, F.lit(-8)))
    return df


def write_cases(df: DataFrame, path: str) -> None:
    """Cases as Parquet by court and year, so that both prune."""
    df.write.mode("overwrite").partitionBy("court", "year").parquet(path)
