"""Raw records to typed frames: permits, inspections, legacy contractors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from girder.functions import parse, text


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# The fields of the raw records; all are text.
RAW_PERMIT = _strings(
    "pcis_permit", "address_start", "street_direction", "street_name", "street_suffix", "zip_code",
    "work_description", "permit_type", "permit_sub_type", "latest_status", "status_date", "valuation",
    "floor_area_l_a_zoning_code_definition", "of_stories", "issue_date", "contractors_business_name",
    "contractor_address", "contractor_city", "license", "applicant_first_name",
    "applicant_last_name", ":updated_at",
)
RAW_INSPECTION = _strings(
    "permit", "address", "permit_status", "inspection_date", "inspection", "inspection_result", ":updated_at"
).add("lat_lon", _strings("latitude", "longitude"))
LEGACY_CONTRACTOR = _strings(
    "cslb_license_number", "company_name", "owner_name", "phone", "email", "contact_email", "website",
    "address", "city", "zip", "license_class", "license_status", "license_expiration",
    "google_rating", "google_review_count", "social_links", "company_size_ai", "years_in_business",
    "specializations", "permit_count", "permit_total_valuation", "permit_avg_valuation", "icp_score",
    "website_scraped_at", "permits_enriched_at", "first_seen_at", "updated_at",
)


def _t(name: str):
    return F.trim(F.col(f"`{name}`"))


def permits(raw: DataFrame) -> DataFrame:
    """Typed permits; rows without a number are dropped, empty strings stay."""
    number = text.blank_to_null(F.col("pcis_permit"))
    return raw.filter(number.isNotNull()).select(
        number.alias("permit_number"),
        F.lit("LA City").alias("city"),
        text.permit_address(*[F.col(c) for c in ("address_start", "street_direction", "street_name", "street_suffix")]).alias("address"),
        _t("zip_code").alias("address_zip"),
        _t("permit_type").alias("permit_type"),
        _t("permit_sub_type").alias("permit_sub_type"),
        _t("latest_status").alias("status"),
        parse.parse_date(F.col("status_date")).alias("status_date"),
        _t("work_description").alias("work_description"),
        F.lit(None).cast("string").alias("project_category_ai"),
        parse.parse_dollars(F.col("valuation")).alias("valuation_usd"),
        parse.parse_int(F.col("floor_area_l_a_zoning_code_definition")).alias("total_sqft"),
        parse.parse_int(F.col("of_stories")).alias("number_of_stories"),
        _t("permit_sub_type").alias("occupancy_type"),
        parse.parse_date(F.col("issue_date")).alias("issued_date"),
        _t("contractors_business_name").alias("contractor_name"),
        _t("contractor_address").alias("contractor_address"),
        F.lit(None).cast("string").alias("contractor_id"),
        text.joined(F.col("applicant_first_name"), F.col("applicant_last_name")).alias("applicant_name"),
        F.lit(False).alias("adu_flag"),
        _t(":updated_at").alias("source_updated_at"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("raw_source"),
    )


def inspections(raw: DataFrame) -> DataFrame:
    """Typed inspections; permit and date are needed, a missing type is Unknown."""
    ref, day = text.blank_to_null(F.col("permit")), parse.parse_date(F.col("inspection_date"))
    return raw.filter(ref.isNotNull() & day.isNotNull()).select(
        ref.alias("permit_ref"),
        _t("address").alias("address"),
        _t("permit_status").alias("permit_status"),
        day.alias("inspection_date"),
        F.coalesce(text.blank_to_null(F.col("inspection")), F.lit("Unknown")).alias("inspection_type"),
        _t("inspection_result").alias("inspection_result"),
        parse.leading_double(F.col("lat_lon.latitude")).alias("lat"),
        parse.leading_double(F.col("lat_lon.longitude")).alias("lng"),
        _t(":updated_at").alias("source_updated_at"),
    )


def legacy_contractors(raw: DataFrame) -> DataFrame:
    """Contractors of the legacy export; license and name are needed, money is in cents."""
    license, name = text.blank_to_null(F.col("cslb_license_number")), text.blank_to_null(F.col("company_name"))
    number = lambda c: F.col(c).try_cast("double")
    cents = lambda c: (F.floor(F.coalesce(number(c), F.lit(0.0)) * 100 + 0.5)).cast("long")
    stamp = lambda c: F.col(c).try_cast("timestamp")
    active = F.coalesce(F.upper(F.trim("license_status")) == "ACTIVE", F.lit(False))
    return raw.filter(license.isNotNull() & name.isNotNull()).select(
        license.alias("cslb_license"),
        name.alias("business_name"),
        "owner_name",
        F.coalesce(text.normalize_phone(F.col("phone")), F.col("phone")).alias("phone"),
        F.coalesce("email", "contact_email").alias("email"),
        "website",
        text.street_of(F.col("address")).alias("address_street"),
        F.col("city").alias("address_city"),
        F.lit("CA").alias("address_state"),
        F.col("zip").alias("address_zip"),
        "license_class",
        parse.legacy_license_status(F.col("license_status")).alias("license_status"),
        parse.turn_date(F.col("license_expiration")).alias("license_expiry"),
        active.alias("has_active_license"),
        number("google_rating").alias("google_rating"),
        parse.parse_int(F.col("google_review_count")).alias("review_count"),
        parse.json_or_null(F.col("social_links")).alias("social_links"),
        "company_size_ai",
        parse.parse_int(F.col("years_in_business")).alias("years_in_business"),
        F.from_json("specializations", "array<string>").alias("specializations_ai"),
        F.coalesce(parse.parse_int(F.col("permit_count")), F.lit(0)).alias("permit_count_total"),
        cents("permit_total_valuation").alias("total_valuation_cents"),
        cents("permit_avg_valuation").alias("avg_valuation_cents"),
        F.coalesce(number("icp_score"), F.lit(0.0)).alias("icp_score"),
        parse.legacy_tier(number("icp_score")).alias("icp_tier"),
        parse.latest(*[F.col(c) for c in ("website_scraped_at", "permits_enriched_at", "updated_at")]).alias("last_enriched_at"),
        stamp("first_seen_at").alias("created_at"),
        stamp("updated_at").alias("updated_at"),
    )


def split_valid(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows lack a required value."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return rows.filter(ok), rows.filter(~ok)
