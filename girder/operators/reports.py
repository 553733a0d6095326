"""Coverage, sanity and sensitivity reports as queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def coverage(rows: DataFrame, **shown: Column) -> DataFrame:
    """One row: total, and for each named condition how many rows fulfil it."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(name) for name, c in shown.items()]
    )


def distribution(rows: DataFrame, *keys: str, missing: str = "(null)") -> DataFrame:
    """n of each combination; a missing last key is labelled, and isn't one with an equal text."""
    label = F.coalesce(F.col(keys[-1]).cast("string"), F.lit(missing)).alias("label")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(*keys[:-1], label, "n")


def top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows; the order should be total."""
    return rows.orderBy(*order).limit(n)


def with_shares(rows: DataFrame, n: str = "n", by: str | None = None) -> DataFrame:
    """Adds total and share of n, over all rows or within ``by``.

    Totals are a second aggregate, not a window over everything, so no task sees all rows.
    """
    total = F.sum(n).alias("total")
    if by is None:
        joined = rows.crossJoin(F.broadcast(rows.agg(total)))  # one row
    else:
        joined = rows.join(rows.groupBy(by).agg(total), by)
    return joined.withColumn("share", F.col(n) / F.col("total"))


def cumulative_sensitivity(counted: DataFrame, decided: DataFrame, key: str = "slug") -> DataFrame:
    """What the fail rate would be if nondecisive results counted as fails, largest first.

    counted: key, label, n of the nondecisive results; decided: key, passed, failed.
    """
    down = Window.partitionBy(key).orderBy(F.desc("n"), "label")
    rows = counted.join(decided, key).withColumn(
        "running", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    decisive = F.col("passed") + F.col("failed")
    return rows.select(
        key,
        "label",
        "n",
        "running",
        ((F.col("failed") + F.col("n")) / (decisive + F.col("n"))).alias("marginal_fail_rate"),
        ((F.col("failed") + F.col("running")) / (decisive + F.col("running"))).alias("cumulative_fail_rate"),
    )


def crosscheck(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Differences of two computations of the same rows, by key."""
    other = right.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return left.join(other, key, "left").select(
        key, *[(F.col(c) - F.coalesce(f"_{c}", F.lit(0))).alias(f"{c}_delta") for c in columns]
    )


def timeline(rows: DataFrame, key: list[str], day: str, order: list[str]) -> DataFrame:
    """Adds sequence_position, days_since_previous, retry_count and is_first of each group's rows."""
    by = Window.partitionBy(*key).orderBy(*order)
    place = F.row_number().over(by)
    return rows.withColumns(
        {
            "sequence_position": place,
            "days_since_previous": F.date_diff(F.col(day), F.lag(day).over(by)),
            "retry_count": place - 1,
            "is_first": place == 1,
        }
    )


def average_gap(rows: DataFrame, key: str, day: str, order: list[str]) -> DataFrame:
    """key, avg_days_between_inspections."""
    placed = timeline(rows, [key], day, order)
    return placed.groupBy(key).agg(F.avg("days_since_previous").alias("avg_days_between_inspections"))


#: Queries of one search: with their best so far they are what a task holds.
QUERIES_AT_ONCE = 10_000


def cosine_topk(queries: DataFrame, base: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, similarity, rank: the k nearest vectors of each query by exact cosine, ties by id.

    queries is a chosen small set of at most ``QUERIES_AT_ONCE``; it goes out with the tasks. base is met in
    blocks of a matrix product, each task keeps k rows a query, and only these are shuffled. Vectors that are
    null, hold a null or have no length are left out, and null ids. Similarities are told to twelve decimals.
    """

    def units(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The vectors that have a length, as unit vectors, and their places."""
        lists = [None if v is None or None in v else v for v in rows.to_pylist()]
        at = np.array([i for i, v in enumerate(lists) if v], np.int64)
        if not len(at):
            return np.zeros((0, 1)), at
        vectors = np.array([lists[i] for i in at], np.float64).reshape(len(at), -1)
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        some = lengths > 0
        return vectors[some] / lengths[some, None], at[some]

    queries, base = queries.filter("vec_id IS NOT NULL"), base.filter("vec_id IS NOT NULL")
    chosen = queries.select("vec_id", "embedding").limit(QUERIES_AT_ONCE + 1).toArrow()
    if chosen.num_rows > QUERIES_AT_ONCE:
        raise ValueError(f"search in parts of {QUERIES_AT_ONCE} queries")
    chosen = chosen.combine_chunks()
    asked, at = units(chosen.column("embedding"))
    ids = chosen.column("vec_id").to_numpy()[at]
    shared = queries.sparkSession.sparkContext.broadcast((asked, ids))

    def run(batches):
        asked, ids = shared.value
        near = np.full((len(ids), k), -2.0)
        whose = np.full((len(ids), k), np.iinfo(np.int64).max)
        for b in batches:
            vectors, at = units(b.column("embedding"))
            if not len(at) or not len(ids):
                continue
            names = b.column("vec_id").to_numpy(zero_copy_only=False)[at]
            for i in range(0, len(ids), 512):
                found = np.round(asked[i : i + 512] @ vectors.T, 12)
                found[ids[i : i + 512, None] == names[None, :]] = -2.0
                found = np.concatenate((near[i : i + 512], found), axis=1)
                owner = np.concatenate(
                    (whose[i : i + 512], np.broadcast_to(names, (found.shape[0], len(names)))), axis=1
                )
                order = np.lexsort((owner, -found), axis=1)[:, :k]
                near[i : i + 512] = np.take_along_axis(found, order, 1)
                whose[i : i + 512] = np.take_along_axis(owner, order, 1)
        row, col = np.nonzero(near > -2)
        columns = [pa.array(x) for x in (ids[row], whose[row, col], near[row, col])]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "similarity"])

    scored = base.select("vec_id", "embedding").mapInArrow(
        run, "query_id long, vec_id long, similarity double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
