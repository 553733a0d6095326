"""JSON landings and exports, license candidates, snapshots."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a stated all-text schema; nothing is inferred."""
    return spark.read.schema(schema).json(path)


def export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON export: a flat array of records, or an array of pages with ``results``."""
    both = T.StructType([*schema.fields, T.StructField("results", T.ArrayType(schema))])
    rows = spark.read.schema(both).json(path, multiLine=True)
    names = schema.fieldNames()
    one = F.array(F.struct(*[F.col(f"`{n}`") for n in names]))
    records = F.when(F.col("results").isNotNull(), F.col("results")).otherwise(one)
    return rows.select(F.inline(records))


def license_candidates(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Licenses in [start, end) as text."""
    return spark.range(start, end).select(F.col("id").cast("string").alias("license"))


def next_range(last: int, size: int, start: int, end: int) -> list[tuple[int, int]]:
    """The next ``size`` candidates after ``last``, wrapping round at the end."""
    at = last if start <= last < end else start
    stop = at + size
    if stop <= end:
        return [(at, stop)]
    return [(at, end), (start, min(at, start + stop - end))]


def fetch_status(pages: DataFrame) -> DataFrame:
    """status, n: how many pages were found, missing or failed. pages: license, html, error."""
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(F.coalesce(F.trim("html"), F.lit("")) == "", "not_found")
        .otherwise("result")
    )
    return pages.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def fetched(
    candidates: DataFrame, fetch: Callable[[str], str | None], delay_seconds: float = 0.8
) -> DataFrame:
    """license, html, error of each candidate: one call after another in a task, with a pause between them.

    ``fetch`` stands for the network; what it raises is the row's error. How many tasks ask at once is the
    number of partitions.
    """

    def run(batches):
        for b in batches:
            licenses, pages, errors = b.column("license").to_pylist(), [], []
            for license in licenses:
                try:
                    pages.append(fetch(license))
                    errors.append(None)
                except Exception as e:  # a page that fails is counted, the others go on
                    pages.append(None)
                    errors.append(str(e) or type(e).__name__)
                time.sleep(delay_seconds)
            columns = [pa.array(x, pa.string()) for x in (licenses, pages, errors)]
            yield pa.RecordBatch.from_arrays(columns, ["license", "html", "error"])

    return candidates.select("license").mapInArrow(run, "license string, html string, error string")


def append_snapshot(snapshot: DataFrame, path: str) -> None:
    """Adds a row of the history; rows are never changed."""
    snapshot.write.mode("append").partitionBy("snapshot_date").parquet(path)


def latest_snapshot(history: DataFrame) -> DataFrame:
    """The last row by date, then by creation."""
    return history.orderBy(F.desc("snapshot_date"), F.desc("created_at")).limit(1)
