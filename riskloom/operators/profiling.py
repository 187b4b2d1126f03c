"""Table profiles and data-quality reports.

Per-column statistics that need no value distribution come from one wide aggregate whose single row is
then turned into one row per column. Reports that need distinct values use the long form
(column, value) with a map-side combine, so each column's levels are spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import nan_to_null, safe_corr, share
from riskloom.operators.cleaning import category_columns, numeric_columns
from riskloom.operators.ranking import exact_quantiles
from riskloom.schemas import RAW_TABLE_KEYS, raw_schema
from riskloom.sources.tables import file_inventory, header_of, scan_raw


def per_column(df: DataFrame, columns: Sequence[str], cell: Callable[[str], Sequence[Column]]) -> DataFrame:
    """One wide aggregate, one output row per column; ``cell`` gives that row's named expressions."""
    rows = [F.struct(F.lit(c).alias("column"), *cell(c)) for c in columns]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _as_text(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    value = F.col(column) + F.lit(0.0) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(column)
    return value.cast("string").alias(column)


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): rows per distinct value, NULL included."""
    clean = nan_to_null(df)
    long = clean.unpivot([], [_as_text(clean, c) for c in columns], "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def missingness_report(df: DataFrame, *, with_coverage: bool = False) -> DataFrame:
    """Columns with missing values, most incomplete first."""
    types = dict(df.dtypes)

    def cell(c: str) -> list[Column]:
        absent = F.col(c).isNull()
        ratio = F.avg(absent.cast("double"))
        lead = [(1.0 - ratio).alias("coverage_rate")] if with_coverage else []
        return [*lead, ratio.alias("missing_ratio"), F.count_if(absent).alias("missing_count"),
                F.lit(types[c]).alias("dtype")]

    report = per_column(nan_to_null(df), df.columns, cell)
    return report.filter(F.col("missing_ratio") > 0).orderBy(F.desc("missing_ratio"), "column")


def most_missing(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` most incomplete columns of the missingness report."""
    return missingness_report(df).orderBy(F.desc("missing_ratio"), "column").limit(n)


def schema_summary(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    kinds = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    missing = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    rows = F.sum("n")
    summary = (
        level_counts(df, df.columns)
        .groupBy("column")
        .agg(
            (rows - missing).alias("non_null_count"),
            missing.alias("missing_count"),
            F.round(missing / rows * 100, 2).alias("missing_ratio"),
            F.count("*").alias("nunique"),
        )
        .withColumn("dtype", kinds[F.col("column")])
    )
    ordered = ["column", "dtype", "non_null_count", "missing_count", "missing_ratio", "nunique"]
    return summary.select(*ordered).orderBy(F.desc("missing_ratio"), F.desc("nunique"), "column")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of every numeric column."""
    columns = list(columns or numeric_columns(df))
    clean = nan_to_null(df)
    moments = per_column(
        clean,
        columns,
        lambda c: [
            F.count(c).alias("count"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ],
    )
    long = clean.unpivot([], [F.col(c).cast("double").alias(c) for c in columns], "column", "value")
    quartiles = exact_quantiles(
        long, value="value", keys=["column"], quantiles={"p25": 0.25, "p50": 0.50, "p75": 0.75}
    )
    joined = moments.join(quartiles, "column", "left")
    return joined.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max").orderBy("column")


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or category_columns(df))
    missing = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    # The smallest (count descending, NULL last, value) is the mode; as a plain MIN it combines map-side.
    leader = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").isNull().alias("absent"), "value"))
    return (
        level_counts(df, columns)
        .groupBy("column")
        .agg(
            F.count("*").alias("nunique"),
            F.round(missing / F.sum("n") * 100, 2).alias("missing_ratio"),
            leader["value"].alias("top_value"),
        )
        .orderBy(F.desc("nunique"), "column")
    )


def with_share(counts: DataFrame, name: str, count: str = "count") -> DataFrame:
    """Add each row's share of the total; the total is a scalar, so no row moves to one task."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(name, F.try_divide(F.col(count).cast("double"), total))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    counts = df.groupBy(F.col(target).alias("target")).agg(F.count("*").alias("count"))
    return with_share(counts, "ratio").orderBy(F.desc("count"), "target")


def target_correlations(df: DataFrame, target: str) -> DataFrame:
    """Pearson correlation of every numeric column with the target, the target itself included."""
    columns = numeric_columns(df)
    if target not in columns:
        return df.sparkSession.createDataFrame([], "feature STRING, correlation DOUBLE")
    report = per_column(nan_to_null(df), columns, lambda c: [safe_corr(c, target).alias("correlation")])
    return report.withColumnRenamed("column", "feature").orderBy(F.desc_nulls_last("correlation"), "feature")


def table_profile(
    df: DataFrame, table: str, *, keys: Sequence[str] | None = None, duplicates_removed: int | Column | None = None
) -> DataFrame:
    """One row: size, missing share, column kinds and, per key, distinct values and repetitions."""
    clean = nan_to_null(df)
    keys = [k for k in (RAW_TABLE_KEYS.get(table, []) if keys is None else keys) if k in df.columns]
    rows = F.count("*")
    absent = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    removed = duplicates_removed if isinstance(duplicates_removed, Column) else F.lit(duplicates_removed)
    columns = [
        F.lit(table).alias("table_name"),
        rows.alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        share(absent, rows * len(df.columns)).alias("total_missing_ratio"),
        F.lit(len(numeric_columns(df))).alias("numeric_columns"),
        F.lit(len(category_columns(df))).alias("categorical_columns"),
        removed.cast("long").alias("full_row_duplicates_removed"),
    ]
    for key in keys:
        distinct = F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
        columns += [
            distinct.alias(f"{key.lower()}_nunique"),
            (rows - distinct).alias(f"{key.lower()}_key_repetitions"),
        ]
    return clean.agg(*columns)


def stack_profiles(profiles: Sequence[DataFrame]) -> DataFrame:
    stacked = profiles[0]
    for profile in profiles[1:]:
        stacked = stacked.unionByName(profile, allowMissingColumns=True)
    return stacked


def raw_overview(
    spark: SparkSession, folder: str, tables: Sequence[str], *, encodings: Mapping[str, str] | None = None
) -> DataFrame:
    """Row count, width, file size and key statistics per raw file; only key columns are parsed."""
    rows = []
    for table in sorted(tables):
        path = f"{folder.rstrip('/')}/{table}"
        header = header_of(spark, path, (encodings or {}).get(table, "UTF-8"))
        keys = [k for k in RAW_TABLE_KEYS.get(table, []) if k in header]
        encoding = (encodings or {}).get(table, "UTF-8")
        scanned = scan_raw(spark, folder, table, keys, encoding) if keys else _scan_text(spark, path, header, encodings, table)
        stats = [F.lit(table).alias("table_name"), F.count("*").alias("rows"), F.lit(len(header)).alias("columns")]
        for key in keys:
            distinct = F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
            stats += [
                distinct.alias(f"{key.lower()}_nunique"),
                (F.count("*") - distinct).alias(f"{key.lower()}_duplicate_rows"),
            ]
        profile = scanned.agg(*stats).withColumns(
            {
                "available_key_columns": F.lit(", ".join(keys)),
                "profile_scope": F.lit("key_columns_only" if keys else "full_table"),
            }
        )
        rows.append(profile)
    sizes = file_inventory(spark, f"{folder.rstrip('/')}/*.csv")
    return stack_profiles(rows).join(sizes, "table_name", "left").orderBy("table_name")


def _scan_text(spark, path, header, encodings, table) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in raw_schema(table, header)])
    reader = spark.read.schema(schema).option("header", True)
    return reader.option("encoding", (encodings or {}).get(table, "UTF-8")).csv(path)


def constant_columns(df: DataFrame, *, excluded: Sequence[str] = ()) -> DataFrame:
    """Columns with at most one distinct value, NULL counting as a value."""
    columns = [c for c in df.columns if c not in set(excluded)]

    def cell(c: str) -> list[Column]:
        all_missing = F.count(c) == 0
        one_value = (F.count(c) == F.count("*")) & (F.min(c) == F.max(c))
        return [F.coalesce(all_missing | one_value, F.lit(True)).alias("constant")]

    return per_column(nan_to_null(df), columns, cell).filter("constant").select("column").orderBy("column")


def drop_constant_columns(df: DataFrame, *, excluded: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    dropped = [r["column"] for r in constant_columns(df, excluded=excluded).collect()]
    return df.drop(*dropped), dropped


def dataset_metadata(df: DataFrame, *, target: str, constants: Sequence[str] = ()) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count(target).alias("labelled_rows"),
        F.avg(F.col(target).cast("double")).alias("target_rate"),
        F.lit(len(constants)).alias("constant_columns_removed"),
    )
