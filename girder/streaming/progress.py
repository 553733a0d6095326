"""Batches that can be resumed: the key of the last finished batch is saved, and the next run goes on after it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.operators.upsert import PIPELINE_STATE, Table, again

STATE = "pipeline_name string, last_cursor string, last_offset long, status string, last_run_at timestamp"


def state(spark: SparkSession, path: str, name: str) -> dict | None:
    """The saved row of a pipeline; None before its first run."""
    rows = Table(spark, path).read()
    found = [] if rows is None else rows.filter(F.col("pipeline_name") == name).take(1)
    return found[0].asDict() if found else None


def save(
    spark: SparkSession, path: str, name: str, cursor: str | None, offset: int, status: str
) -> None:
    row = spark.createDataFrame([(name, cursor, offset, status, None)], STATE)
    row = row.withColumn("last_run_at", F.current_timestamp())
    again(lambda: Table(spark, path).merge(row, PIPELINE_STATE, buckets=1))


def after(rows: DataFrame, key: str, cursor: str | None, size: int) -> DataFrame:
    """The next ``size`` rows by a unique key; the filter reaches the scan."""
    left = rows if cursor is None else rows.filter(F.col(key) > F.lit(cursor).cast(rows.schema[key].dataType))
    return left.orderBy(key).limit(size)


def resumed(
    rows: DataFrame,
    key: str,
    size: int,
    sink: Callable[[DataFrame, int], None],
    path: str,
    name: str,
) -> int:
    """Hands rows to the sink batch by batch in the order of a unique key; how many batches it took.

    After each batch its last key is saved under ``name`` in the state table at ``path``. A run that follows
    a failed one starts after the last saved key, one that follows a finished one starts anew. A batch whose
    key wasn't saved is handed over again, so sinks should be idempotent, as merges are.
    """
    spark = rows.sparkSession
    known = state(spark, path, name)
    open_ = known is not None and known["status"] != "idle"
    cursor, offset = (known["last_cursor"], known["last_offset"]) if open_ else (None, 0)
    batches = 0
    while True:
        batch = after(rows, key, cursor, size)
        last, n = batch.agg(F.max(key).cast("string"), F.count(F.lit(1))).first()
        if n:
            try:
                sink(batch, batches)
            except Exception:
                save(spark, path, name, cursor, offset, "error")
                raise
            cursor, offset, batches = last, offset + n, batches + 1
            save(spark, path, name, cursor, offset, "running")
        if n < size:
            save(spark, path, name, None, offset, "idle")
            return batches
