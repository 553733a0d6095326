"""Delta cursors, idempotent appends and snapshots over Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from girder.operators.upsert import Policy, Table, again


def since(rows: DataFrame, column: str, cursor: str | None) -> DataFrame:
    """Rows changed after the cursor; all without one."""
    return rows if cursor is None else rows.filter(F.col(column) > F.lit(cursor).cast(rows.schema[column].dataType))


def landed(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet") -> DataFrame:
    """Files of a folder as a stream: each is read once, the checkpoint is the cursor."""
    return spark.readStream.schema(schema).format(kind).load(path)


def append_once(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]
) -> StreamingQuery:
    """Appends rows whose key isn't in the table yet; a batch that is replayed adds nothing.

    Within a batch the first row of a key by ``order`` counts. A batch writes its own rows only; of the table
    it reads the keys.
    """

    def put(batch: DataFrame, number: int) -> None:
        table = Table(batch.sparkSession, path)
        rest = [c for c in batch.columns if c not in keys]
        once = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
        new = once.select(*keys, "r.*").select(*batch.columns)

        def add() -> None:
            version = table.manifest()[0]
            old = table.read()
            fresh = new if old is None else new.join(old.select(*keys), keys, "left_anti")
            table.append(fresh, version)

        again(add)

    return _run(stream, put, checkpoint)


def merge_stream(
    stream: DataFrame, path: str, checkpoint: str, policy: Policy, order: str, buckets: int = 64
) -> StreamingQuery:
    """Merges each batch into the table by its policy; the last of equal keys wins. Only the buckets of keys
    that a batch touches are read and written."""

    def put(batch: DataFrame, number: int) -> None:
        table = Table(batch.sparkSession, path)
        again(lambda: table.merge(batch, policy, order, buckets))

    return _run(stream, put, checkpoint)


def _run(stream: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
