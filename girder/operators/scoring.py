"""Contractor score over six dimensions, its tier, and the six signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder import taxonomy
from girder.functions import parse
from girder.session import local_rows

VALUATION_CAP = 2_000_000_000
WEIGHTS = (
    ("permit_activity", 0.25),
    ("pain", 0.25),
    ("maturity", 0.20),
    ("adu_focus", 0.15),
    ("digital", 0.10),
    ("reach", 0.05),
)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def permit_activity(active: Column, total: Column, cents: Column) -> Column:
    return (
        F.when(active > 0, 40.0).otherwise(0.0)
        + F.least(total / 50.0, F.lit(1.0)) * 40
        + F.least(cents / 5e8, F.lit(1.0)) * 20
    )


def pain(rate: Column, corrections: Column, gap_days: Column) -> Column:
    known = (
        (1 - rate) * 60
        + F.when(parse.any_over(corrections), 20.0).otherwise(0.0)
        + F.when(F.coalesce(gap_days, F.lit(0)) > 14, 20.0).otherwise(0.0)
    )
    return F.when(rate.isNull(), 50.0).otherwise(known)


def maturity(active: Column, years: Column, license_end: Column, comp_end: Column, as_of: Column) -> Column:
    points = (
        40.0
        + F.least(F.coalesce(years, F.lit(0)) / 20.0, F.lit(1.0)) * 30
        + F.when(parse.not_before(license_end, as_of, 90), 15.0).otherwise(0.0)
        + F.when(parse.not_before(comp_end, as_of, 90), 15.0).otherwise(0.0)
    )
    return F.when(F.coalesce(active, F.lit(False)), points).otherwise(0.0)


def adu_focus(n: Column) -> Column:
    return F.least(n / 5.0, F.lit(1.0)) * 100


def digital(website: Column, rating: Column, reviews: Column, social: Column) -> Column:
    n = F.coalesce(reviews, F.lit(0))
    stars = F.when(rating.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), (rating - 1) / 4 * 30))
    return (
        F.when(website.isNotNull(), 40.0).otherwise(0.0)
        + stars
        + F.when(n >= 20, 20.0).when(n >= 5, 10.0).otherwise(0.0)
        + F.when(social.isNotNull(), 10.0).otherwise(0.0)
    )


def reach(cities: Column) -> Column:
    return F.when(cities == 0, 0.0).when(cities == 1, 20.0).when(cities <= 3, 50.0).otherwise(100.0)


def weighted(dimensions: dict[str, Column]) -> Column:
    """Left to right, so that the doubles come out alike everywhere."""
    total = None
    for name, weight in WEIGHTS:
        term = dimensions[name] * weight
        total = term if total is None else total + term
    return total


def permit_totals(permits: DataFrame) -> DataFrame:
    """contractor_id, n_permits, valuation_cents, adu_count."""
    return (
        permits.filter("contractor_id IS NOT NULL")
        .groupBy("contractor_id")
        .agg(
            F.count(F.lit(1)).alias("n_permits"),
            (F.sum(F.coalesce("valuation_usd", F.lit(0)).cast("long")) * 100).alias("valuation_cents"),
            F.sum(F.when(F.col("adu_flag"), 1).otherwise(0)).alias("adu_count"),
        )
    )


def scores(contractors: DataFrame, permits: DataFrame, as_of: str) -> DataFrame:
    """Contractors with n_permits, capped valuations, six dimensions, icp_score (two decimals), tier."""
    joined = contractors.join(
        permit_totals(permits), contractors["id"] == F.col("contractor_id"), "left"
    ).drop("contractor_id")
    day = F.lit(as_of).cast("date")
    cities = parse.key_count(F.col("permit_count_by_city"))
    dims = {
        "permit_activity": permit_activity(
            _zero("permit_count_active"), _zero("n_permits"), _zero("valuation_cents")
        ),
        "pain": pain(
            F.col("inspection_pass_rate"),
            F.col("correction_rate_by_trade"),
            F.col("avg_days_between_inspections"),
        ),
        "maturity": maturity(
            F.col("has_active_license"),
            F.col("years_in_business"),
            F.col("license_expiry"),
            F.col("worker_comp_expiry"),
            day,
        ),
        "adu_focus": adu_focus(_zero("adu_count")),
        "digital": digital(
            F.col("website"), F.col("google_rating"), F.col("review_count"), F.col("social_links")
        ),
        "reach": reach(cities),
    }
    rows = joined.withColumns({f"dim_{k}": v for k, v in dims.items()}).withColumn("cities", cities)
    raw = weighted({k: F.col(f"dim_{k}") for k in dims})
    cents, n = _zero("valuation_cents"), _zero("n_permits")
    average = F.floor(F.try_divide(cents.cast("double"), n.cast("double")) + 0.5)
    return rows.withColumns(
        {
            "n_permits": n,
            "total_valuation_cents": F.least(cents, F.lit(VALUATION_CAP)),
            "avg_valuation_cents": F.when(n > 0, F.least(average, F.lit(VALUATION_CAP)))
            .otherwise(0)
            .cast("long"),
            "adu_count": _zero("adu_count"),
            "icp_tier": parse.tier(raw),
            "icp_score": parse.round_half_up(raw, 2),
        }
    )


def signals(scored: DataFrame, as_of: str) -> DataFrame:
    """contractor_id, signal_type, signal_value, is_active, detected_at: six rows a contractor."""
    day = F.lit(as_of).cast("date")
    active = _zero("permit_count_active")
    expiring = parse.within_days(F.col("license_expiry"), day, 90)
    lapsed = parse.before_day(F.col("worker_comp_expiry"), day)
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    six = (
        ("permit_velocity_high", F.least(active / 10.0, F.lit(1.0)), active > 0),
        ("digital_presence_low", 1 - F.col("dim_digital") / 100, F.col("dim_digital") < 50),
        ("adu_active", F.least(F.col("adu_count") / 5.0, F.lit(1.0)), F.col("adu_count") > 0),
        ("multi_city_active", F.least(F.col("cities") / 10.0, F.lit(1.0)), F.col("cities") >= 2),
        ("license_expiring_soon", flag(expiring), expiring),
        ("workers_comp_lapsed", flag(lapsed), lapsed),
    )
    now = F.lit(as_of).cast("timestamp")
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("signal_type"),
                value.cast("double").alias("signal_value"),
                on.alias("is_active"),
                F.when(on, now).alias("detected_at"),
            )
            for name, value, on in six
        ]
    )
    return scored.select(F.col("id").alias("contractor_id"), F.inline(rows))


def drift(stored: DataFrame, scored: DataFrame) -> DataFrame:
    """id, stored and recomputed score, and whether they differ: ok below 0.1, flagged over 0.5."""
    new = scored.select("id", F.col("icp_score").alias("recomputed"))
    gap = F.abs(F.col("icp_score") - F.col("recomputed"))
    verdict = F.when(gap < 0.1, "ok").when(gap > 0.5, "drift").otherwise("close")
    return stored.join(new, "id").select("id", "icp_score", "recomputed", verdict.alias("verdict"))


def signal_coverage(rows: DataFrame) -> DataFrame:
    """signal_type, declared, rows and active of every declared type, also of those that nothing computes yet, and of
    types in the rows that aren't declared."""
    types = local_rows(rows.sparkSession, [(t,) for t in taxonomy.SIGNAL_TYPES], "signal_type string")
    counted = rows.groupBy("signal_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_active").alias("active")
    )
    both = types.withColumn("declared", F.lit(True)).join(counted, "signal_type", "full_outer")
    return both.fillna({"declared": False, "rows": 0, "active": 0})
