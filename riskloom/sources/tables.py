"""Reading and writing tables: raw CSV, format-dispatched tables, file inventory, report tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import nan_to_null
from riskloom.schemas import NA_TOKENS, raw_schema
from riskloom.session import materialize

FORMATS = {"csv": {"header": "true"}, "parquet": {}}


def _format_of(path: str) -> str:
    extension = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if extension not in FORMATS:
        raise ValueError(f"Unsupported table format: {path}")
    return extension


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    fmt = _format_of(path)
    reader = spark.read.format(fmt).options(**FORMATS[fmt])
    if schema is not None:
        return reader.schema(schema).load(path)
    return reader.option("inferSchema", "true").load(path) if fmt == "csv" else reader.load(path)


def write_table(
    df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] = (), fmt: str | None = None
) -> str:
    fmt = fmt or _format_of(path)
    df.write.mode(mode).format(fmt).options(**FORMATS[fmt]).partitionBy(*partition_by).save(path)
    return path


def sort_for_write(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Globally sorted output files without a single sorting task."""
    by_range = df.repartitionByRange(partitions, key) if partitions else df.repartitionByRange(key)
    return by_range.sortWithinPartitions(key)


def header_of(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    return spark.read.option("header", True).option("encoding", encoding).csv(path).columns


def tokens_to_null(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.trim(c).isin(*NA_TOKENS), F.col(c)) for c in text}) if text else df


def scan_raw(
    spark: SparkSession, folder: str, table: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8"
) -> DataFrame:
    """Raw CSV with an explicit schema; numbers are read leniently and missing tokens become NULL."""
    path = f"{folder.rstrip('/')}/{table}"
    schema = raw_schema(table, header_of(spark, path, encoding))
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
    raw = spark.read.schema(as_text).option("header", True).option("encoding", encoding).csv(path)
    if columns is not None:
        raw = raw.select(*[c for c in columns if c in schema.names])
    cleaned = tokens_to_null(raw)
    return nan_to_null(cleaned.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in cleaned.columns]))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Remove rows equal in every column (NULL equals NULL); repeated keys stay."""
    return df.dropDuplicates()


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and exact duplicates of a table, from one pre-aggregated shuffle."""
    return _copy_counts(df.groupBy(*df.columns).agg(F.count("*").alias("__copies")))


def _copy_counts(copies: DataFrame) -> DataFrame:
    return copies.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_rows")
    ).withColumn("duplicates_removed", F.col("rows") - F.col("distinct_rows"))


def load_raw(spark: SparkSession, folder: str, table: str) -> tuple[DataFrame, DataFrame]:
    """De-duplicated raw table and its one-row duplicate count, both from one shuffle that is written once."""
    raw = scan_raw(spark, folder, table)
    copies = materialize(raw.groupBy(*raw.columns).agg(F.count("*").alias("__copies")), "distinct-rows")
    return copies.drop("__copies"), _copy_counts(copies)


def file_inventory(spark: SparkSession, glob: str) -> DataFrame:
    """Size in MB per table, a file or a folder of part files; only file metadata is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob).select("path", "length")
    # the outermost part of the path that is named like a table; a file with another name stands for itself
    named = F.regexp_extract("path", r"/([^/]+\.(?:csv|parquet))(?:/|$)", 1)
    table = F.when(named != "", named).otherwise(F.element_at(F.split("path", "/"), -1))
    sizes = files.groupBy(table.alias("table_name")).agg(F.sum("length").alias("bytes"))
    return sizes.select("table_name", F.round(F.col("bytes") / F.lit(1024 * 1024), 2).alias("file_size_mb"))


def write_reports(tables: Mapping[str, DataFrame], folder: str, *, fmt: str = "parquet") -> dict[str, str]:
    """One folder per report table."""
    return {
        name: write_table(df, f"{folder.rstrip('/')}/{name}", fmt=fmt) for name, df in tables.items()
    }


def write_json_lines(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def write_metadata(spark: SparkSession, document: Mapping, path: str) -> str:
    """A small nested document, one JSON text file."""
    text = json.dumps(document, ensure_ascii=False, default=str)
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
    return path
