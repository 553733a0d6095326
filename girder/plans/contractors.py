"""Linking, counters and scores on customers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder import taxonomy
from girder.operators import linking, reports, scoring
from girder.plans.frames import CONTRACTORS, INSPECTIONS, PERMITS, ctes, frame

AS_OF = "1998-09-01"


def contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, CONTRACTORS)


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, PERMITS)


def owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permits that already belong to a contractor."""
    return permits(spark, sf_dir).withColumn("contractor_id", F.col("owner"))


def link_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = linking.link(permits(spark, sf_dir), contractors(spark, sf_dir))
    return linked.select("id", "contractor_id", "match_pass")


def link_unique_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    names = nations.select(F.lower("n_name").alias("needle"))
    return linking.unique_containing(names, "needle", nations, "n_name", "n_nationkey")


def active_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linking.counters(owned(spark, sf_dir)).select(
        "contractor_id", "permit_count_active", "permit_count_total"
    )


def counts_by_city_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linking.counters(owned(spark, sf_dir))
    lines = F.transform(F.map_entries("permit_count_by_city"), lambda e: F.concat_ws("=", e.key, e.value))
    return found.select("contractor_id", F.array_join(F.array_sort(lines), ",").alias("by_city"))


def pass_rate_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linking.two_stage_pass_rate(frame(spark, sf_dir, INSPECTIONS), owned(spark, sf_dir))
    return rows.withColumn("inspection_pass_rate", F.round("inspection_pass_rate", 9))


def permit_rollup_per_contractor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.permit_totals(owned(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contractors(spark, sf_dir).drop("icp_score", "icp_tier")
    cities = linking.counters(owned(spark, sf_dir)).select(
        F.col("contractor_id").alias("id"), "permit_count_by_city"
    )
    corrections = F.create_map(F.lit("framing"), F.col("review_count") / 60.0)
    ready = rows.join(cities, "id", "left").withColumn("correction_rate_by_trade", corrections)
    return scoring.scores(ready, owned(spark, sf_dir), AS_OF)


def icp_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = [f"dim_{name}" for name, _ in scoring.WEIGHTS]
    return _scored(spark, sf_dir).select(
        "id", *[F.round(d, 9).alias(d) for d in dims], "icp_score", "icp_tier",
        "total_valuation_cents", "avg_valuation_cents",
    )


def icp_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoring.signals(_scored(spark, sf_dir), AS_OF)
    return rows.select(
        "contractor_id", "signal_type", F.round("signal_value", 9).alias("signal_value"), "is_active"
    )


def signal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.signal_coverage(scoring.signals(_scored(spark, sf_dir), AS_OF))


def score_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six signals a contractor, scores within 0 and 100, none missing."""
    scored = _scored(spark, sf_dir)
    one = scored.agg(
        F.count(F.lit(1)).alias("contractors"),
        F.count_if(~F.col("icp_score").between(0, 100) | F.col("icp_score").isNull()).alias("bad_scores"),
        F.min("icp_score").cast("decimal(6,2)").cast("double").alias("least"),
        F.max("icp_score").cast("decimal(6,2)").cast("double").alias("most"),
    )
    return one.withColumn("signals", F.col("contractors") * 6)


def tier_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distribution(contractors(spark, sf_dir), "icp_tier").withColumnRenamed("label", "icp_tier")


def drift_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored scores, some of them shifted, against recomputed ones."""
    scored = _scored(spark, sf_dir)
    key = F.col("id").cast("long")
    moved = F.when(key % 10 == 0, 1.0).when(key % 10 == 1, 0.3).otherwise(0.0)
    stored = scored.select("id", (F.col("icp_score") + moved).alias("icp_score"))
    return scoring.drift(stored, scored).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        link_cascade,
        link_unique_substring,
        active_counts,
        counts_by_city_map,
        pass_rate_two_stage,
        permit_rollup_per_contractor,
        icp_score,
        icp_signals,
        signal_coverage,
        score_sanity,
        tier_distribution,
        drift_check,
    )
}

BASE = ctes(contractors=CONTRACTORS, permits=PERMITS, inspections=INSPECTIONS)
SCORED = f"""{BASE},
totals AS (
  SELECT owner AS id, count(*) AS n_permits, CAST(sum(valuation_usd) AS BIGINT) * 100 AS cents,
    CAST(sum(CASE WHEN adu_flag THEN 1 ELSE 0 END) AS BIGINT) AS adu,
    count(DISTINCT city) AS cities
  FROM permits GROUP BY 1),
dated AS (
  SELECT c.*, coalesce(n_permits, 0) AS n, coalesce(t.cents, 0) AS v, coalesce(adu, 0) AS adu,
    coalesce(cities, 0) AS cities,
    coalesce(try_strptime(license_expiry, '%m/%d/%Y'), try_strptime(license_expiry, '%Y-%m-%d')) AS le,
    coalesce(try_strptime(worker_comp_expiry, '%m/%d/%Y'), try_strptime(worker_comp_expiry, '%Y-%m-%d')) AS we
  FROM contractors c LEFT JOIN totals t USING (id)),
dims AS (
  SELECT *,
    CASE WHEN permit_count_active > 0 THEN 40.0::DOUBLE ELSE 0 END + least(n / 50.0::DOUBLE, 1) * 40
      + least(v / 5e8::DOUBLE, 1) * 20 AS dim_permit_activity,
    CASE WHEN inspection_pass_rate IS NULL THEN 50::DOUBLE ELSE (1 - inspection_pass_rate) * 60
      + CASE WHEN review_count / 60.0::DOUBLE > 0.3::DOUBLE THEN 20 ELSE 0 END
      + CASE WHEN avg_days_between_inspections > 14 THEN 20 ELSE 0 END END AS dim_pain,
    CASE WHEN has_active_license THEN 40 + least(coalesce(years_in_business, 0) / 20.0::DOUBLE, 1) * 30
      + CASE WHEN license_expiry IS NULL OR coalesce(le >= DATE '{AS_OF}' + 90, false) THEN 15 ELSE 0 END
      + CASE WHEN worker_comp_expiry IS NULL OR coalesce(we >= DATE '{AS_OF}' + 90, false) THEN 15 ELSE 0 END
      ELSE 0::DOUBLE END AS dim_maturity,
    least(adu / 5.0::DOUBLE, 1) * 100 AS dim_adu_focus,
    CASE WHEN website IS NOT NULL THEN 40::DOUBLE ELSE 0 END
      + CASE WHEN google_rating IS NULL THEN 0::DOUBLE ELSE greatest(0, (google_rating - 1) / 4 * 30) END
      + CASE WHEN review_count >= 20 THEN 20 WHEN review_count >= 5 THEN 10 ELSE 0 END
      + CASE WHEN social_links IS NOT NULL THEN 10 ELSE 0 END AS dim_digital,
    CASE WHEN cities = 0 THEN 0::DOUBLE WHEN cities = 1 THEN 20 WHEN cities <= 3 THEN 50 ELSE 100 END AS dim_reach
  FROM dated),
scored AS (
  SELECT *, dim_permit_activity * 0.25::DOUBLE + dim_pain * 0.25::DOUBLE + dim_maturity * 0.20::DOUBLE
    + dim_adu_focus * 0.15::DOUBLE + dim_digital * 0.10::DOUBLE + dim_reach * 0.05::DOUBLE AS raw
  FROM dims)"""

SIGNALS = f"""{SCORED},
signals AS (
  SELECT id, 'permit_velocity_high' AS signal_type, least(permit_count_active / 10.0::DOUBLE, 1) AS signal_value,
    permit_count_active > 0 AS is_active FROM scored
  UNION ALL SELECT id, 'digital_presence_low', 1 - dim_digital / 100, dim_digital < 50 FROM scored
  UNION ALL SELECT id, 'adu_active', least(adu / 5.0::DOUBLE, 1), adu > 0 FROM scored
  UNION ALL SELECT id, 'multi_city_active', least(cities / 10.0::DOUBLE, 1), cities >= 2 FROM scored
  UNION ALL SELECT id, 'license_expiring_soon', CASE WHEN on_ THEN 1.0::DOUBLE ELSE 0 END, on_ FROM (
    SELECT id, coalesce(le >= DATE '{AS_OF}' AND le < DATE '{AS_OF}' + 90, false) AS on_ FROM scored)
  UNION ALL SELECT id, 'workers_comp_lapsed', CASE WHEN on_ THEN 1.0::DOUBLE ELSE 0 END, on_ FROM (
    SELECT id, coalesce(we < DATE '{AS_OF}', false) AS on_ FROM scored))
"""
ORACLE_SQL = {
    "link_cascade": f"""{BASE},
lic AS (SELECT p.id, c.id AS cid FROM permits p JOIN contractors c
        ON upper(trim(json_extract_string(raw_source, '$.license'))) = c.cslb_license),
adr AS (SELECT p.id, max_by(c.id, (c.cslb_license, c.id)) AS cid FROM permits p JOIN contractors c
        ON lower(trim(contractor_address) || ', ' || json_extract_string(raw_source, '$.contractor_city'))
         = lower(address_street || ', ' || address_city) GROUP BY 1),
nam AS (SELECT p.id, min(c.id) AS cid
        FROM (SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(lower(contractor_name),
                '\\b(llc|l\\.l\\.c\\.?|inc\\.?|corp\\.?|corporation|co\\.?|ltd\\.?|lp|dba|the)\\b', '', 'g'),
                '[.,]', '', 'g'), '\\s+', ' ', 'g')) AS nm FROM permits
              WHERE id NOT IN (SELECT id FROM lic) AND id NOT IN (SELECT id FROM adr)) p
        JOIN contractors c ON contains(lower(c.business_name), p.nm)
        WHERE length(p.nm) >= 4 GROUP BY p.id HAVING count(DISTINCT c.id) = 1)
SELECT p.id, coalesce(lic.cid, adr.cid, nam.cid) AS contractor_id,
  CASE WHEN lic.cid IS NOT NULL THEN 'license' WHEN adr.cid IS NOT NULL THEN 'address'
       WHEN nam.cid IS NOT NULL THEN 'name' END AS match_pass
FROM permits p LEFT JOIN lic USING (id) LEFT JOIN adr USING (id) LEFT JOIN nam USING (id)
""",
    "link_unique_substring": """
SELECT lower(a.n_name) AS needle, min(b.n_nationkey) AS n_nationkey FROM nation a JOIN nation b
  ON contains(lower(b.n_name), lower(a.n_name)) GROUP BY 1 HAVING count(DISTINCT b.n_nationkey) = 1
""",
    "active_counts": f"""{BASE}
SELECT owner AS contractor_id, count(*) FILTER (WHERE status NOT IN ('Permit Finaled')) AS permit_count_active,
  count(*) AS permit_count_total FROM permits GROUP BY 1
""",
    "counts_by_city_map": f"""{BASE}, c AS (
  SELECT owner, city, count(*) AS n FROM permits GROUP BY 1, 2)
SELECT owner AS contractor_id,
  coalesce(string_agg(city || '=' || n, ',' ORDER BY city || '=' || n) FILTER (WHERE city IS NOT NULL), '') AS by_city
FROM c GROUP BY 1
""",
    "pass_rate_two_stage": f"""{BASE}, per AS (
  SELECT permit_ref, count(*) FILTER (WHERE inspection_result = 'Approved') AS ok, count(*) AS n
  FROM inspections GROUP BY 1)
SELECT owner AS contractor_id, round(sum(ok) / sum(n), 9) AS inspection_pass_rate
FROM per JOIN permits ON replace(permit_ref, ' ', '-') = permit_number GROUP BY 1
""",
    "permit_rollup_per_contractor": f"""{BASE}
SELECT owner AS contractor_id, count(*) AS n_permits, CAST(sum(valuation_usd) * 100 AS BIGINT) AS valuation_cents,
  CAST(sum(CASE WHEN adu_flag THEN 1 ELSE 0 END) AS BIGINT) AS adu_count FROM permits GROUP BY 1
""",
    "icp_score": f"""{SCORED}
SELECT id, round(dim_permit_activity, 9) AS dim_permit_activity, round(dim_pain, 9) AS dim_pain,
  round(dim_maturity, 9) AS dim_maturity, round(dim_adu_focus, 9) AS dim_adu_focus,
  round(dim_digital, 9) AS dim_digital, round(dim_reach, 9) AS dim_reach,
  floor(raw * 100 + 0.5) / 100 AS icp_score,
  CASE WHEN raw >= 80 THEN 'A' WHEN raw >= 60 THEN 'B' WHEN raw >= 40 THEN 'C' ELSE 'D' END AS icp_tier,
  least(v, 2000000000) AS total_valuation_cents,
  CASE WHEN n > 0 THEN CAST(least(floor(v / n + 0.5), 2000000000) AS BIGINT) ELSE 0 END AS avg_valuation_cents
FROM scored
""",
    "icp_signals": f"""{SIGNALS}
SELECT id AS contractor_id, signal_type, round(signal_value, 9) AS signal_value, is_active FROM signals
""",
    "signal_coverage": f"""{SIGNALS},
declared AS (SELECT unnest([{", ".join(f"'{t}'" for t in taxonomy.SIGNAL_TYPES)}]) AS signal_type)
SELECT signal_type, true AS declared, count(s.id) AS rows, count(*) FILTER (WHERE is_active) AS active
FROM declared LEFT JOIN signals s USING (signal_type) GROUP BY 1
""",
    "score_sanity": f"""{SCORED}
SELECT count(*) AS contractors, CAST(0 AS BIGINT) AS bad_scores, min(floor(raw * 100 + 0.5) / 100) AS least,
  max(floor(raw * 100 + 0.5) / 100) AS most, count(*) * 6 AS signals FROM scored
""",
    "tier_distribution": f"""{BASE}
SELECT icp_tier, count(*) AS n FROM contractors GROUP BY 1
""",
    "drift_check": f"""{BASE}
SELECT CASE CAST(id AS BIGINT) % 10 WHEN 0 THEN 'drift' WHEN 1 THEN 'close' ELSE 'ok' END AS verdict, count(*) AS n
FROM contractors GROUP BY 1
""",
}
