"""Merges, deltas, streams and health counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.operators import reports, upsert
from girder.session import shared_folder
from girder.streaming import incremental


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("permit_number"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("valuation"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("category"),
    )


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every fifth order and some new ones; the second overwrites with a null status."""
    some = _orders(spark, sf_dir).filter("permit_number % 5 = 0")
    first = some.select("permit_number", F.lit("X").alias("status"), F.lit(1.0).alias("valuation"), F.lit("new").alias("category"), F.lit(1).alias("seq"))
    second = some.select("permit_number", F.lit(None).cast("string").alias("status"), F.lit(2.0).alias("valuation"), F.lit("newer").alias("category"), F.lit(2).alias("seq"))
    fresh = some.select((-F.col("permit_number") - 1).alias("permit_number"), F.lit("N").alias("status"), F.lit(3.0).alias("valuation"), F.lit("fresh").alias("category"), F.lit(1).alias("seq"))
    return first.unionByName(second).unionByName(fresh)


ORDERS_POLICY = upsert.Policy(("permit_number",), ("status", "valuation"), ("category",))


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(_orders(spark, sf_dir), _delta(spark, sf_dir), ORDERS_POLICY, order="seq")


def dedupe_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return upsert.keep_last(events, ("user_id", "event_type"), "event_id").select("user_id", "event_type", "event_id", "value")


def upsert_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """detected_at moves only if the signal is active in the delta."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    rows = supplier.select(
        F.col("s_suppkey").cast("string").alias("contractor_id"), F.lit("adu_active").alias("signal_type"),
        F.col("s_acctbal").alias("signal_value"), F.lit(True).alias("is_active"), F.lit("2024-01-01").alias("detected_at"),
    )
    active = F.col("s_suppkey") % 4 == 0
    delta = supplier.filter("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").cast("string").alias("contractor_id"), F.lit("adu_active").alias("signal_type"),
        F.lit(0.5).alias("signal_value"), active.alias("is_active"), F.when(active, F.lit("2024-06-01")).alias("detected_at"),
    )
    return upsert.upsert(rows, delta, upsert.SIGNALS)


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    new = spark.range(20, 30).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("added").alias("n_name"))
    return upsert.insert_absent(nation, new, ["n_nationkey"])


def overlay_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with orders of the last year get their counts; the others keep their balance."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderdate >= '2001-01-01'")
    counts = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("double").alias("c_acctbal"))
    base = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_acctbal")
    return upsert.overlay(base, counts, "c_custkey", ["c_acctbal"])


def delta_since_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return incremental.since(events, "ts", "2024-01-20 00:00:00").select("event_id", "event_type")


def stream_idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events' stream, appended once for each (user, type), and delivered a second time."""
    path = f"{shared_folder(spark).rstrip('/')}/girder/stream-{uuid.uuid4().hex}"
    source = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(source).schema
    for turn in range(2):
        rows = incremental.landed(spark, f"{sf_dir}/events*.parquet", schema)
        incremental.append_once(
            rows, f"{path}/table", f"{path}/checkpoint-{turn}", ["user_id", "event_type"], ["ts", "event_id"]
        ).awaitTermination()
    return upsert.Table(spark, f"{path}/table").read().select("user_id", "event_type", "event_id")


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("region", "nation", "customer", "supplier", "part", "orders")
    return reports.counts({n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return reports.coverage(
        rows, in_debt=F.col("c_acctbal") < 0, building=F.col("c_mktsegment") == "BUILDING", unnamed=F.col("c_name").isNull()
    )


def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of each of the first vectors, by exact cosine; ranks are checked, not digits."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = reports.cosine_topk(vectors.filter("vec_id % 20 = 0"), vectors, 5)
    return found.select("query_id", "vec_id", "rank")


QUERIES = {
    f.__name__: f
    for f in (
        upsert_merge,
        dedupe_keep_last,
        upsert_signals,
        insert_if_absent,
        overlay_update,
        delta_since_cursor,
        stream_idempotent_append,
        table_counts,
        coverage,
        cosine_topk,
    )
}

ORACLE_SQL = {
    "upsert_merge": """
SELECT o_orderkey AS permit_number, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 5 = 0 THEN 2.0::DOUBLE ELSE o_totalprice END AS valuation,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS category FROM orders
UNION ALL SELECT -o_orderkey - 1, 'N', 3.0::DOUBLE, 'fresh' FROM orders WHERE o_orderkey % 5 = 0
""",
    "dedupe_keep_last": """
SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2
""",
    "upsert_signals": """
SELECT CAST(s_suppkey AS VARCHAR) AS contractor_id, 'adu_active' AS signal_type,
  CASE WHEN s_suppkey % 2 = 0 THEN 0.5::DOUBLE ELSE s_acctbal END AS signal_value,
  s_suppkey % 2 = 1 OR s_suppkey % 4 = 0 AS is_active,
  CASE WHEN s_suppkey % 4 = 0 THEN '2024-06-01' ELSE '2024-01-01' END AS detected_at FROM supplier
""",
    "insert_if_absent": """
SELECT n_nationkey, n_name FROM nation
UNION ALL SELECT CAST(i AS INTEGER), 'added' FROM range(20, 30) t(i) WHERE i NOT IN (SELECT n_nationkey FROM nation)
""",
    "overlay_update": """
SELECT c_custkey, coalesce(n, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (
  SELECT o_custkey AS c_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders WHERE o_orderdate >= '2001-01-01' GROUP BY 1)
  USING (c_custkey)
""",
    "delta_since_cursor": """
SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'
""",
    "stream_idempotent_append": """
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2
""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS n FROM {n}"
        for n in ("region", "nation", "customer", "supplier", "part", "orders")
    ),
    "coverage": """
SELECT count(*) AS total, count(*) FILTER (WHERE c_acctbal < 0) AS in_debt,
  count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, count(*) FILTER (WHERE c_name IS NULL) AS unnamed
FROM customer
""",
    "cosine_topk": """
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT q.vec_id AS query_id, b.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY
    list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) DESC, b.vec_id) AS rank
  FROM embeddings q JOIN embeddings b ON q.vec_id <> b.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 5
""",
}
