"""Production log store: four append-only tables partitioned by day, readable from Parquet or JDBC.

The rows of a batch go to several tables, and are either all readable or not at all: parts are written first, each
batch to folders of its own (``attempt=...``), then one small commit file names the attempt. Readers take committed
attempts only, so what a crash leaves behind is never read, and a batch that is replayed after its commit is not
written again. ``compact_logs`` puts many small attempts into one by a commit that replaces theirs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import reason_phrase, truncate
from riskloom.functions.payload import flatten_json, payload_object, payload_size
from riskloom.operators.oplogs import FIRST_ERROR_STATUS
from riskloom.schemas import LOG_SCHEMAS, RESPONSE_SCHEMA, log_schema
from riskloom.session import discard

LOG_DAY, ATTEMPT = "log_date", "attempt"
COMMITS, COMMIT_SCHEMA = "commits", "attempt STRING, tables ARRAY<STRING>, replaces ARRAY<STRING>"
#: What a table without any file is told by.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
INPUT_METADATA = ["id", "prediction_log_id", "created_at", "feature_count"]
OUTPUT_METADATA = [
    "id", "prediction_log_id", "created_at", "default_probability", "business_threshold",
    "predicted_default", "credit_decision", "latency_ms",
]
PREDICTION_METADATA = ["id", "created_at", "default_probability", "credit_decision", "latency_ms"]


def create_log_tables(spark: SparkSession, database: str = "default") -> list[str]:
    names = []
    for table, columns in LOG_SCHEMAS.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}, {ATTEMPT} STRING, {LOG_DAY} DATE) "
            f"USING parquet PARTITIONED BY ({ATTEMPT}, {LOG_DAY})"
        )
        names.append(f"{database}.{table}")
    return names


def _empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], log_schema(table))


def _table_lookup(url: str, table: str) -> str:
    """A query with a row if the database has the table, from the catalog its kind of database has."""
    if url.startswith("jdbc:sqlite"):
        return f"SELECT name FROM sqlite_master WHERE name = '{table}'"
    return f"SELECT table_name FROM information_schema.tables WHERE lower(table_name) = '{table}'"


def read_log(
    spark: SparkSession,
    root: str,
    table: str,
    *,
    since: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> DataFrame:
    """The committed rows of one log table; an absent table reads as empty, every other failure is raised. ``since``
    (a date) prunes day partitions. A table written by others, without attempts, is read as it is.

    ``jdbc`` holds connection options; add partitionColumn, lowerBound, upperBound and numPartitions to
    read in parallel.
    """
    schema = log_schema(table)
    if jdbc is not None:
        reader = spark.read.format("jdbc").options(**jdbc)
        listed = reader.option("query", _table_lookup(jdbc["url"], table)).load()
        if listed.isEmpty():
            return _empty(spark, table)
        raw = reader.option("dbtable", table).load()
    else:
        try:
            raw = spark.read.parquet(f"{root.rstrip('/')}/{table}")
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            return _empty(spark, table)
        if ATTEMPT in raw.columns:
            raw = raw.join(committed(spark, root).filter(F.array_contains("tables", table)), ATTEMPT, "left_semi")
    if since is not None:
        day = F.col(LOG_DAY) if LOG_DAY in raw.columns else F.to_date("created_at")
        raw = raw.filter(day >= F.lit(since).cast("date"))
    return raw.select(*[_coerced(raw, field) for field in schema])


def _coerced(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    column = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType) and isinstance(df.schema[field.name].dataType, T.StringType):
        return F.try_to_timestamp(column).alias(field.name)
    return column.try_cast(field.dataType).alias(field.name)


def load_prediction_logs(spark: SparkSession, root: str, **options) -> DataFrame:
    logs = read_log(spark, root, "prediction_logs", **options)
    return logs.withColumns({c: payload_object(c) for c in ("request_payload", "response_payload")})


def load_api_call_logs(spark: SparkSession, root: str, **options) -> DataFrame:
    logs = read_log(spark, root, "api_call_logs", **options)
    return logs.withColumn("request_payload", payload_object("request_payload"))


def input_frame(inputs: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Metadata and flattened features of the stored model inputs."""
    return flatten_json(inputs, "input_payload", schema=schema, keep=INPUT_METADATA)


def output_frame(outputs: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """Stored output columns; payload keys only where no stored column has that name."""
    return flatten_json(outputs, "output_payload", schema=schema, keep=OUTPUT_METADATA)


def feature_frame(prediction_logs: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    return flatten_json(prediction_logs, "request_payload", schema=schema)


def prediction_frame(prediction_logs: DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    return flatten_json(prediction_logs, "response_payload", schema=schema, keep=PREDICTION_METADATA)


def load_production_inputs(
    spark: SparkSession, root: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Stored inputs, rebuilt from the prediction log when the snapshot table is empty."""
    inputs = read_log(spark, root, "production_inputs", **options)
    if inputs.isEmpty():
        return feature_frame(load_prediction_logs(spark, root, **options), schema)
    return input_frame(inputs, schema)


def load_production_outputs(
    spark: SparkSession, root: str, schema: T.StructType | str | None = None, **options
) -> DataFrame:
    outputs = read_log(spark, root, "production_outputs", **options)
    if outputs.isEmpty():
        return prediction_frame(load_prediction_logs(spark, root, **options), schema or RESPONSE_SCHEMA)
    return output_frame(outputs, schema or RESPONSE_SCHEMA)


def prediction_log_rows(scored: DataFrame) -> dict[str, DataFrame]:
    """The three log rows of each scored request.

    ``scored`` has request_id, request_payload, the four response columns, latency_ms and created_at.
    The log id is the request id, so a replayed micro-batch produces the same rows.
    """
    response = ["default_probability", "business_threshold", "predicted_default", "credit_decision"]
    logged = scored.withColumns(
        {
            "id": F.col("request_id").cast("string"),
            "response_payload": F.to_json(F.struct(*response)),
            "feature_count": payload_size("request_payload").cast("int"),
        }
    )
    snapshot = logged.withColumn("prediction_log_id", F.col("id"))
    rows = {
        "prediction_logs": logged,
        "production_inputs": snapshot.withColumn("input_payload", F.col("request_payload")),
        "production_outputs": snapshot.withColumn("output_payload", F.col("response_payload")),
    }
    return {table: _typed(df, table) for table, df in rows.items()}


def api_call_rows(calls: DataFrame) -> DataFrame:
    """Call log rows: error fields and the payload are kept for failed calls only."""
    failed = F.col("status_code") >= FIRST_ERROR_STATUS

    def given(name: str) -> Column:
        return F.col(name) if name in calls.columns else F.lit(None).cast("string")

    reason = F.coalesce(given("error_message"), reason_phrase("status_code"))
    return _typed(
        calls.withColumns(
            {
                "id": F.col("request_id").cast("string"),
                "error_type": F.when(failed, F.concat(F.lit("http_"), F.col("status_code").cast("string"))),
                "error_message": F.when(failed, truncate(reason)),
                "request_payload": F.when(failed, given("request_payload")),
                "client_host": given("client_host"),
                "user_agent": given("user_agent"),
            }
        ),
        "api_call_logs",
    )


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in log_schema(table)])


def _entries(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(COMMIT_SCHEMA).json(f"{root.rstrip('/')}/{COMMITS}")
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def committed(spark: SparkSession, root: str) -> DataFrame:
    """(attempt, tables) of every commit that no later one has replaced."""
    entries = _entries(spark, root)
    replaced = entries.select(F.explode("replaces").alias(ATTEMPT))
    return entries.join(replaced, ATTEMPT, "left_anti").select(ATTEMPT, "tables")


def _publish(spark: SparkSession, root: str, name: str, entry: Mapping) -> bool:
    """Make a commit visible by one rename; False if there is one of this name already."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    final = path(f"{root.rstrip('/')}/{COMMITS}/{name}.json")
    draft = path(f"{root.rstrip('/')}/{COMMITS}/.{uuid.uuid4().hex}.draft")  # hidden from readers
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    if not files.exists(final) and files.rename(draft, final):
        return True
    files.delete(draft, False)
    return False


def _is_published(spark: SparkSession, root: str, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{COMMITS}/{name}.json")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _write_attempt(rows: Mapping[str, DataFrame], root: str, name: str, replaces: Sequence[str] = ()) -> bool:
    """Parts of all tables, then their commit."""
    spark = next(iter(rows.values())).sparkSession
    attempt = f"a{uuid.uuid4().hex}"
    for table, df in rows.items():
        dated = df.withColumns({ATTEMPT: F.lit(attempt), LOG_DAY: F.to_date("created_at")})
        dated.write.mode("append").partitionBy(ATTEMPT, LOG_DAY).parquet(f"{root.rstrip('/')}/{table}")
    entry = {"attempt": attempt, "tables": sorted(rows), "replaces": list(replaces)}
    if _publish(spark, root, name or attempt, entry):
        return True
    for table in rows:  # another writer has committed the same batch meanwhile
        discard(spark, f"{root.rstrip('/')}/{table}/{ATTEMPT}={attempt}")
    return False


def append_logs(rows: Mapping[str, DataFrame], root: str, *, batch: int | None = None, writer: str = "main") -> bool:
    """Append rows to several log tables as one commit; False if this batch of this writer has been committed before.

    Without ``batch`` every call is a batch of its own. Batch numbers are counted by ``writer``: streams that log to
    the same folder, or that start anew, need names of their own.
    """
    if not rows:
        return False
    spark = next(iter(rows.values())).sparkSession
    name = "" if batch is None else f"{writer}-{int(batch)}"
    if name and _is_published(spark, root, name):
        return False
    return _write_attempt(rows, root, name)


def append_log(df: DataFrame, root: str, table: str, *, batch: int | None = None, writer: str = "main") -> str:
    """Append rows to one log table, as a commit of its own."""
    append_logs({table: df}, root, batch=batch, writer=f"{writer}-{table}")
    return f"{root.rstrip('/')}/{table}"


def compact_logs(spark: SparkSession, root: str, *, tables: Sequence[str] = tuple(LOG_SCHEMAS)) -> int:
    """Write all committed rows as one attempt that replaces theirs; returns how many attempts it replaced.

    Readers see either the old attempts or the new one. Only one compaction may run at a time.
    """
    old = [r[ATTEMPT] for r in committed(spark, root).select(ATTEMPT).collect()]  # as many as batches since the last time
    if len(old) < 2:
        return 0
    rows = {table: read_log(spark, root, table) for table in tables}
    _write_attempt(rows, root, "", replaces=old)
    return len(old)


def drop_replaced(spark: SparkSession, root: str, *, tables: Sequence[str] = tuple(LOG_SCHEMAS)) -> int:
    """Remove the parts of replaced attempts, once no reader that began before the compaction is left."""
    gone = [r[0] for r in _entries(spark, root).select(F.explode("replaces")).distinct().collect()]
    for attempt in gone:
        for table in tables:
            discard(spark, f"{root.rstrip('/')}/{table}/{ATTEMPT}={attempt}")
    return len(gone)


def export_logs(spark: SparkSession, root: str, target: str, *, tables: Sequence[str] = tuple(LOG_SCHEMAS)) -> list[str]:
    """Every log table as CSV with a header."""
    written = []
    for table in tables:
        path = f"{target.rstrip('/')}/{table}"
        read_log(spark, root, table).write.mode("overwrite").option("header", True).csv(path)
        written.append(path)
    return written
