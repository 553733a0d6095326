"""First-attempt inspection outcomes: who passes at the first try, by inspection type.

An attempt is the first inspection of a type on a permit over the whole history; only then does
the date window choose among first attempts, so a retry inside the window never counts as first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from girder import taxonomy


def first_attempts(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order`` (ascending, nulls last; it should be total)."""
    by = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return rows.withColumn("_rank", F.row_number().over(by)).filter("_rank = 1").drop("_rank")


def first_attempts_by_min(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The same rows by an aggregate instead of a window: an independent check of the above."""
    rest = [c for c in rows.columns if c not in keys]
    ranked = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    packed = F.min_by(F.struct(*rest), ranked).alias("_row")
    return rows.groupBy(*keys).agg(packed).select(*keys, "_row.*")


def with_slug(inspections: DataFrame, type_map: DataFrame) -> DataFrame:
    """Inspections of a known type, with its slug; the map is a fixed list of ten rows."""
    mapped = type_map.select(F.col("raw_type").alias("_raw"), "slug")
    on = F.trim(F.col("inspection_type")) == F.col("_raw")
    return inspections.join(F.broadcast(mapped), on).drop("_raw")


def with_class(rows: DataFrame, classes: DataFrame, result: str = "result") -> DataFrame:
    """Adds ``cls``: that of (slug, result), else that of the result for any type, else nondecisive.

    ``classes`` is a fixed list of some twenty rows.
    """
    cleaned = F.trim(F.col(result))
    own = classes.filter(F.col("slug") != taxonomy.ANY_TYPE).select(
        F.col("slug").alias("_slug"), F.col("result").alias("_own"), F.col("cls").alias("_own_cls")
    )
    common = classes.filter(F.col("slug") == taxonomy.ANY_TYPE).select(
        F.col("result").alias("_any"), F.col("cls").alias("_any_cls")
    )
    joined = rows.join(
        F.broadcast(own), (F.col("slug") == F.col("_slug")) & (cleaned == F.col("_own")), "left"
    ).join(F.broadcast(common), cleaned == F.col("_any"), "left")
    cls = F.coalesce("_own_cls", "_any_cls", F.lit(taxonomy.NONDECISIVE))
    return joined.withColumn("cls", cls).drop("_slug", "_own", "_own_cls", "_any", "_any_cls")


def class_counts(rows: DataFrame, key: str = "slug") -> DataFrame:
    """passed, failed, nondecisive and cohort of each key."""
    return rows.groupBy(key).agg(
        F.count_if(F.col("cls") == "pass").alias("passed"),
        F.count_if(F.col("cls") == "fail").alias("failed"),
        F.count_if(F.col("cls") == taxonomy.NONDECISIVE).alias("nondecisive"),
        F.count(F.lit(1)).alias("cohort"),
    )


def round4(x: Column) -> Column:
    """Half up at four decimals, by the floor form."""
    return F.floor(x * 10000 + 0.5) / 10000


def published_rates(counts: DataFrame, all_types: DataFrame, threshold: int) -> DataFrame:
    """A row for each type, also without inspections; rates only from ``threshold`` decisive ones.

    ``all_types`` (slug, ...) is a fixed list of types.
    """
    dense = F.broadcast(all_types).join(counts, "slug", "left")
    filled = dense.fillna(0, ["passed", "failed", "nondecisive", "cohort"])
    decisive = F.col("passed") + F.col("failed")
    published = decisive >= threshold
    passing = round4(F.col("passed") / decisive)
    return (
        filled.withColumn("sample_size", decisive)
        .withColumn("published", published)
        .withColumn("pass_rate", F.when(published & (decisive > 0), passing))
        .withColumn("fail_rate", round4(1 - F.col("pass_rate")))
    )


def first_time_pass_rate(
    inspections: DataFrame,
    type_map: DataFrame,
    classes: DataFrame,
    all_types: DataFrame,
    period_start: str,
    period_end: str,
    threshold: int = taxonomy.PUBLISH_THRESHOLD,
) -> DataFrame:
    """Pass rate at the first attempt by type, of first attempts in [period_start, period_end].

    ``inspections``: permit_ref, inspection_type, inspection_date (text or date), result and an
    id that breaks ties. Rows without a readable date or permit are left out.
    """
    dated = inspections.withColumn("idate", F.expr("try_cast(inspection_date AS date)")).filter(
        "idate IS NOT NULL AND permit_ref IS NOT NULL"
    )
    first = first_attempts(
        with_slug(dated, type_map), ["permit_ref", "slug"], ["idate", "inspection_type", "id"]
    )
    window = F.col("idate").between(
        F.lit(period_start).cast("date"), F.lit(period_end).cast("date")
    )
    return published_rates(
        class_counts(with_class(first.filter(window), classes)), all_types, threshold
    )


def artifact(rates: DataFrame, start: str, end: str, threshold: int, months: int = 12) -> DataFrame:
    """One row: the published snapshot with its types as an ordered array (one entry for each type)."""
    fields = [c for c in ("slug", "tier", "sample_size", "pass_rate", "fail_rate", "published") if c in rates.columns]
    return rates.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("types")).select(
        F.lit(end).alias("snapshot_date"),
        F.struct(
            F.lit(start).alias("start"),
            F.lit(end).alias("end"),
            F.lit(f"Trailing {months} months").alias("label"),
        ).alias("period"),
        F.lit(threshold).alias("sample_threshold"),
        "types",
    )


def correction_rates(inspections: DataFrame, owners: DataFrame) -> DataFrame:
    """contractor_id, correction_rate_by_trade: the share of failed among decisive inspections, as a map by slug.

    inspections: permit_ref, slug, cls. owners: permit_ref, contractor_id, one row for each permit. Counts are
    made by permit before the join; a trade without decisive inspections isn't in the map.
    """
    decisive = inspections.filter(F.col("cls").isin("pass", "fail"))
    by_permit = decisive.groupBy("permit_ref", "slug").agg(
        F.count_if(F.col("cls") == "fail").alias("failed"), F.count(F.lit(1)).alias("n")
    )
    rates = (
        by_permit.join(owners, "permit_ref")
        .groupBy("contractor_id", "slug")
        .agg((F.sum("failed") / F.sum("n")).alias("rate"))
    )
    # an entry for each inspection type, a fixed list
    entries = F.sort_array(F.collect_list(F.struct("slug", "rate")))
    return rates.groupBy("contractor_id").agg(F.map_from_entries(entries).alias("correction_rate_by_trade"))


def within_box(rows: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """Rows whose lat and lng lie in the box, edges included; rows without coordinates don't."""
    return rows.filter(F.col("lat").between(south, north) & F.col("lng").between(west, east))
