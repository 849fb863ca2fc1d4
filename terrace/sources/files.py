"""Raw file loads that keep bad rows and remember where each row came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FORMATS = ("parquet", "json", "csv", "orc", "xml", "text")
PERMISSIVE = ("json", "csv", "xml")


def _schema_for(fmt: str, schema: T.StructType) -> T.StructType:
    if fmt in PERMISSIVE and CORRUPT not in schema.fieldNames():
        return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return schema


def _configured(reader, fmt: str, schema: T.StructType | None, options: dict | None):
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; one of {', '.join(FORMATS)}")
    if fmt != "text" and schema is None:
        raise ValueError("declare a schema; raw loads never infer one")
    reader = reader.format(fmt)
    if fmt != "text":
        reader = reader.schema(_schema_for(fmt, schema))
    if fmt in PERMISSIVE:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**(options or {}))


def _with_lineage(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_src_file"),
        F.col("_metadata.file_modification_time").alias("_src_mtime"),
        F.current_timestamp().alias("_ingested_at"),
    )


def ingest_files(
    spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType | None = None, options: dict | None = None
) -> DataFrame:
    """Load files under a declared schema; unparsable rows stay, with their text in ``_corrupt_record``."""
    return _with_lineage(_configured(spark.read, fmt, schema, options).load(path))


def ingest_files_stream(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None, options: dict | None = None
) -> DataFrame:
    """The same load as a stream: each file is read once per checkpoint of the query that uses it."""
    return _with_lineage(_configured(spark.readStream, fmt, schema, options).load(path))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined rows)."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.filter(F.col(CORRUPT).isNotNull())
