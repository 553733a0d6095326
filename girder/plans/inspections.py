"""First-attempt queries on ``lineitem``: an order is a permit, a return flag an inspection type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder import taxonomy
from girder.operators import inspections as op
from girder.operators import reports
from girder.plans.frames import INSPECTIONS, ctes, frame
from girder.session import local_rows
from girder.sources import files

ORDER = ["idate", "l_linenumber", "l_partkey", "l_suppkey"]
START, END = "1998-01-01", "1998-12-31"


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def inspected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as inspections: permit_ref, slug, idate, result; R and A are mapped, N isn't."""
    slugs = local_rows(
        spark, [("R", "final"), ("A", "framing")], "l_returnflag string, slug string"
    )
    rows = lineitem(spark, sf_dir).select(
        F.col("l_orderkey").alias("permit_ref"),
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("idate"),
        F.col("l_linestatus").alias("result"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    return rows.join(F.broadcast(slugs), "l_returnflag")


def classes(spark: SparkSession) -> DataFrame:
    rows = [("*", "O", "pass"), ("*", "F", "fail"), ("final", "F", "pass")]
    return local_rows(spark, rows, "slug string, result string, cls string")


def first_attempt_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = op.first_attempts(inspected(spark, sf_dir), ["permit_ref", "slug"], ORDER)
    inside = first.filter(F.col("idate").between(F.lit(START), F.lit(END)))
    counts = op.class_counts(op.with_class(inside, classes(spark)))
    slugs = local_rows(spark, [("final",), ("framing",), ("footing",)], "slug string")
    return op.published_rates(counts, slugs, 100).select(
        "slug",
        "passed",
        "failed",
        "nondecisive",
        "cohort",
        "sample_size",
        "published",
        "pass_rate",
        "fail_rate",
    )


FIRST = """
first AS (
  SELECT * FROM (
    SELECT l_orderkey AS permit_ref,
           CASE l_returnflag WHEN 'R' THEN 'final' WHEN 'A' THEN 'framing' END AS slug,
           CAST(l_shipdate AS DATE) AS idate, l_linestatus AS result,
           row_number() OVER (PARTITION BY l_orderkey, l_returnflag
             ORDER BY CAST(l_shipdate AS DATE), l_linenumber, l_partkey, l_suppkey) AS rn
    FROM lineitem WHERE l_returnflag IN ('R', 'A')) WHERE rn = 1)
"""



def first_attempt_rollup_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw types are one slug: the first of either counts once a user."""
    slugs = local_rows(
        spark, [("click", "engage"), ("view", "engage"), ("purchase", "buy")], "raw_type string, slug string"
    )
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("event_type", "inspection_type")
    first = op.first_attempts(op.with_slug(rows, slugs), ["user_id", "slug"], ["ts", "event_id"])
    return first.select("user_id", "slug", "inspection_type", "event_id")


def first_last_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, INSPECTIONS)
    order = F.struct("inspection_date", "l_linenumber", "l_partkey", "l_suppkey")
    return rows.groupBy("permit_ref", "inspection_type").agg(
        F.min_by("inspection_result", order).alias("first_result"),
        F.max_by("inspection_result", order).alias("last_result"),
        F.min("inspection_date").cast("string").alias("first_date"),
        F.count(F.lit(1)).alias("n"),
    )


def result_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, INSPECTIONS)
    counted = reports.distribution(rows, "inspection_type", "inspection_result")
    return reports.with_shares(counted, by="inspection_type").select(
        "inspection_type", "label", "n", F.round("share", 9).alias("share")
    )


def sensitivity_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, INSPECTIONS).withColumnRenamed("inspection_type", "slug")
    rows = op.with_class(
        rows, taxonomy.result_classes(spark), "inspection_result"
    )
    loose = rows.filter(F.col("cls") == taxonomy.NONDECISIVE)
    counted = reports.distribution(loose, "slug", "inspection_result")
    found = reports.cumulative_sensitivity(counted, op.class_counts(rows))
    return found.withColumns(
        {c: F.round(c, 9) for c in ("marginal_fail_rate", "cumulative_fail_rate")}
    )


def first_attempt_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window and the aggregate give the same first attempts: all differences are zero."""
    rows, known = inspected(spark, sf_dir), classes(spark)
    found = [
        op.class_counts(op.with_class(f(rows, ["permit_ref", "slug"], ORDER), known))
        for f in (op.first_attempts, op.first_attempts_by_min)
    ]
    return reports.crosscheck(found[0], found[1], "slug", ["passed", "failed", "cohort"])


def timeline_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("day", F.col("ts").cast("date"))
    placed = reports.timeline(events, ["user_id", "event_type"], "day", ["ts", "event_id"])
    return placed.select(
        "event_id", "sequence_position", "days_since_previous", "retry_count", "is_first"
    )


def average_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("day", F.col("ts").cast("date"))
    found = reports.average_gap(events, "user_id", "day", ["ts", "event_id"])
    return found.withColumn("avg_days_between_inspections", F.round("avg_days_between_inspections", 9))


def permit_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inspections of all permits in order, with slug and class, first attempts marked."""
    rows = inspected(spark, sf_dir)
    placed = reports.timeline(op.with_class(rows, classes(spark)), ["permit_ref", "slug"], "idate", ORDER)
    return placed.select(
        "permit_ref", "slug", "sequence_position", F.col("idate").cast("string").alias("day"), "cls", "is_first"
    )


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.groupBy(F.col("ts").cast("date").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("created_at")
    )


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = files.latest_snapshot(_snapshots(spark, sf_dir))
    return last.select(F.col("snapshot_date").cast("string").alias("snapshot_date"), "n")


def artifact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published artifact, and one type picked out of it again."""
    made = op.artifact(first_attempt_pass_rate(spark, sf_dir), START, END, 100)
    one = F.get(F.filter("types", lambda t: t.slug == "final"), F.lit(0))
    return made.select(
        "snapshot_date", "sample_threshold", one.sample_size.alias("sample_size"), one.pass_rate.alias("pass_rate")
    )


QUERIES = {
    f.__name__: f
    for f in (
        first_attempt_pass_rate,
        first_attempt_rollup_types,
        first_last_by_group,
        result_distribution,
        sensitivity_cumulative,
        first_attempt_crosscheck,
        timeline_gaps,
        average_gap,
        permit_trace,
        latest_snapshot,
        artifact_lookup,
    )
}

ORACLE_SQL = {
    "first_attempt_pass_rate": f"""
WITH {FIRST}, counted AS (
  SELECT slug,
         count(*) FILTER (WHERE result = 'O' OR slug = 'final' AND result = 'F') AS passed,
         count(*) FILTER (WHERE result = 'F' AND slug <> 'final') AS failed,
         count(*) FILTER (WHERE result NOT IN ('O', 'F')) AS nondecisive, count(*) AS cohort
  FROM first WHERE idate BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY slug),
dense AS (
  SELECT t.slug, coalesce(passed, 0) AS passed, coalesce(failed, 0) AS failed,
         coalesce(nondecisive, 0) AS nondecisive, coalesce(cohort, 0) AS cohort
  FROM (VALUES ('final'), ('framing'), ('footing')) t(slug) LEFT JOIN counted USING (slug)),
rated AS (
  SELECT *, passed + failed AS sample_size, passed + failed >= 100 AS published,
         CASE WHEN passed + failed >= 100
              THEN floor(passed / (passed + failed) * 10000 + 0.5) / 10000 END AS pass_rate
  FROM dense)
SELECT *, floor((1 - pass_rate) * 10000 + 0.5) / 10000 AS fail_rate FROM rated
""",
    "first_attempt_rollup_types": """
SELECT user_id, slug, inspection_type, event_id FROM (
  SELECT user_id, event_type AS inspection_type, event_id,
         CASE event_type WHEN 'purchase' THEN 'buy' ELSE 'engage' END AS slug,
         row_number() OVER (PARTITION BY user_id, event_type = 'purchase' ORDER BY ts, event_id) AS rn
  FROM events WHERE event_type IN ('click', 'view', 'purchase')) WHERE rn = 1
""",
    "first_last_by_group": f"""{ctes(inspections=INSPECTIONS)}
SELECT permit_ref, inspection_type,
  arg_min_null(inspection_result, (inspection_date, l_linenumber, l_partkey, l_suppkey)) AS first_result,
  arg_max_null(inspection_result, (inspection_date, l_linenumber, l_partkey, l_suppkey)) AS last_result,
  CAST(min(inspection_date) AS VARCHAR) AS first_date, count(*) AS n
FROM inspections GROUP BY ALL
""",
    "result_distribution": f"""{ctes(inspections=INSPECTIONS)}
SELECT inspection_type, coalesce(inspection_result, '(null)') AS label, n,
  round(n / sum(n) OVER (PARTITION BY inspection_type), 9) AS share
FROM (SELECT inspection_type, inspection_result, count(*) AS n FROM inspections GROUP BY ALL)
""",
    "sensitivity_cumulative": f"""{ctes(inspections=INSPECTIONS)}, decided AS (
  SELECT inspection_type AS slug, count(*) FILTER (WHERE inspection_result = 'Approved') AS passed,
    count(*) FILTER (WHERE inspection_result = 'Corrections Issued') AS failed
  FROM inspections GROUP BY 1),
loose AS (
  SELECT inspection_type AS slug, coalesce(inspection_result, '(null)') AS label, count(*) AS n
  FROM inspections WHERE coalesce(inspection_result, '') NOT IN ('Approved', 'Corrections Issued') GROUP BY 1, 2),
summed AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY slug ORDER BY n DESC, label ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
  FROM loose)
SELECT slug, label, n, running, round((failed + n) / (passed + failed + n), 9) AS marginal_fail_rate,
  round((failed + running) / (passed + failed + running), 9) AS cumulative_fail_rate
FROM summed JOIN decided USING (slug)
""",
    "first_attempt_crosscheck": """
SELECT slug, CAST(0 AS BIGINT) AS passed_delta, CAST(0 AS BIGINT) AS failed_delta, CAST(0 AS BIGINT) AS cohort_delta
FROM (SELECT DISTINCT CASE l_returnflag WHEN 'R' THEN 'final' ELSE 'framing' END AS slug
      FROM lineitem WHERE l_returnflag IN ('R', 'A'))
""",
    "timeline_gaps": """
SELECT event_id, CAST(p AS INTEGER) AS sequence_position, CAST(gap AS INTEGER) AS days_since_previous,
  CAST(p - 1 AS INTEGER) AS retry_count, p = 1 AS is_first
FROM (SELECT event_id, row_number() OVER w AS p,
        CAST(ts AS DATE) - lag(CAST(ts AS DATE)) OVER w AS gap
      FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
""",
    "average_gap": """
SELECT user_id, round(avg(gap), 9) AS avg_days_between_inspections
FROM (SELECT user_id, CAST(ts AS DATE) - lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap
      FROM events) GROUP BY 1
""",
    "permit_trace": """
SELECT permit_ref, slug, CAST(p AS INTEGER) AS sequence_position, CAST(idate AS VARCHAR) AS day,
  CASE WHEN result = 'O' OR slug = 'final' AND result = 'F' THEN 'pass' WHEN result = 'F' THEN 'fail'
       ELSE 'nondecisive' END AS cls, p = 1 AS is_first
FROM (SELECT l_orderkey AS permit_ref, CASE l_returnflag WHEN 'R' THEN 'final' ELSE 'framing' END AS slug,
        CAST(l_shipdate AS DATE) AS idate, l_linestatus AS result,
        row_number() OVER (PARTITION BY l_orderkey, l_returnflag
          ORDER BY CAST(l_shipdate AS DATE), l_linenumber, l_partkey, l_suppkey) AS p
      FROM lineitem WHERE l_returnflag IN ('R', 'A'))
""",
    "latest_snapshot": """
SELECT CAST(d AS VARCHAR) AS snapshot_date, n FROM (
  SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) ORDER BY d DESC LIMIT 1
""",
    "artifact_lookup": f"""
WITH {FIRST}, counted AS (SELECT count(*) AS n FROM first
  WHERE slug = 'final' AND result IN ('O', 'F') AND idate BETWEEN DATE '{START}' AND DATE '{END}')
SELECT '{END}' AS snapshot_date, 100 AS sample_threshold, n AS sample_size,
  CASE WHEN n >= 100 THEN CAST(1 AS DOUBLE) END AS pass_rate FROM counted
""",
}
