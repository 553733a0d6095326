"""Permits to contractors: by license, else by address, else by a name that fits one contractor only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder import taxonomy
from girder.functions.text import address_key, normalize_name

MIN_NAME = 4
GRAM = 3


def by_license(permits: DataFrame, contractors: DataFrame) -> DataFrame:
    """permit id, contractor_id: the license is trimmed and in upper case on the permit's side only. Of
    contractors that share a license the smallest id stands for all, so a permit has one row at most."""
    license = F.upper(F.trim(F.get_json_object("raw_source", "$.license")))
    left = permits.select(F.col("id").alias("permit_id"), license.alias("_license")).filter(
        "_license IS NOT NULL AND _license <> ''"
    )
    right = contractors.groupBy("cslb_license").agg(F.min("id").alias("contractor_id"))
    return left.join(right, left["_license"] == right["cslb_license"]).select(
        "permit_id", "contractor_id"
    )


def address_cache(contractors: DataFrame) -> DataFrame:
    """address, contractor_id: one row for each key, that of the highest license."""
    keyed = contractors.withColumn("address", address_key(F.col("address_street"), F.col("address_city")))
    return (
        keyed.filter("address IS NOT NULL")
        .groupBy("address")
        .agg(F.max_by("id", F.struct("cslb_license", "id")).alias("contractor_id"))
    )


def by_address(permits: DataFrame, cache: DataFrame) -> DataFrame:
    city = F.get_json_object("raw_source", "$.contractor_city")
    left = permits.select(
        F.col("id").alias("permit_id"), address_key(F.col("contractor_address"), city).alias("address")
    ).filter("address IS NOT NULL")
    return left.join(cache.select("address", "contractor_id"), "address").select(
        "permit_id", "contractor_id"
    )


def _grams(x: Column) -> Column:
    """The distinct runs of GRAM characters of a text."""
    at = F.sequence(F.lit(1), F.greatest(F.length(x) - (GRAM - 1), F.lit(1)))
    return F.array_distinct(F.transform(at, lambda i: F.substring(x, i, GRAM)))


def containing(names: DataFrame, needle: str, hay: DataFrame, text: str, key: str) -> DataFrame:
    """needle, key: rows of hay whose lower-cased text contains the needle (GRAM characters at least).

    Without an index each needle would meet each text. So texts are indexed by their runs of three
    characters; a needle asks only its rarest run, and what it finds is checked. The index holds keys, not
    texts, which are fetched for what is found. All are ordinary joins, so no side is broadcast whatever its size.
    """
    texts = hay.select(F.col(key), F.lower(F.col(text)).alias("_text")).filter("_text IS NOT NULL")
    index = texts.select(key, F.explode(_grams(F.col("_text"))).alias("_gram"))
    sizes = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_size"))
    asked = names.select(needle, F.explode(_grams(F.col(needle))).alias("_gram"))
    rarest = (
        asked.join(sizes, "_gram", "left")
        .groupBy(needle)
        .agg(F.min_by("_gram", F.struct(F.coalesce("_size", F.lit(0)), "_gram")).alias("_gram"))
    )
    met = rarest.join(index, "_gram").select(needle, key).join(texts, key)
    return met.filter(F.contains(F.col("_text"), F.col(needle))).select(needle, key)


def unique_containing(names: DataFrame, needle: str, hay: DataFrame, text: str, key: str) -> DataFrame:
    """needle, key where exactly one distinct key contains the needle. names: distinct needles.

    Every distinct text gives its runs of the needles' lengths, and a needle meets those equal to it. So rows are as
    many as characters times lengths, however alike the names are, and a run meets one needle at most.
    """
    texts = hay.groupBy(F.lower(F.col(text)).alias("_text")).agg(
        F.min(key).alias(key), (F.min(key) < F.max(key)).alias("_more")
    )
    lengths = names.agg(F.collect_set(F.length(needle)).alias("_lengths"))
    sized = texts.join(F.broadcast(lengths)).select(key, "_more", "_text", F.explode("_lengths").alias("_n"))
    last = F.length("_text") - F.col("_n") + 1
    at = sized.filter(last > 0).withColumn("_at", F.explode(F.sequence(F.lit(1), last)))
    runs = at.select(F.col("_text").substr(F.col("_at"), F.col("_n")).alias(needle), key, "_more")
    found = runs.join(names.select(needle).hint("shuffle_hash"), needle).groupBy(needle)
    return (
        found.agg(F.min(key).alias(key), F.max(key).alias("_other"), F.bool_or("_more").alias("_more"))
        .filter(F.col(key) == F.col("_other"))
        .filter(~F.col("_more"))
        .select(needle, key)
    )


def by_name(permits: DataFrame, contractors: DataFrame) -> DataFrame:
    """Normalised names of MIN_NAME characters at least, compared once for each distinct name."""
    named = permits.select(
        F.col("id").alias("permit_id"), normalize_name(F.col("contractor_name")).alias("_name")
    ).filter(F.length("_name") >= MIN_NAME)
    distinct = named.select("_name").distinct()
    hay = contractors.select(F.col("id").alias("contractor_id"), "business_name")
    matched = unique_containing(distinct, "_name", hay, "business_name", "contractor_id")
    return named.join(matched, "_name").select("permit_id", "contractor_id")


def link(permits: DataFrame, contractors: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """permits with contractor_id filled where it was null, and ``match_pass``.

    Passes in order: license, address, name; what an earlier one found stands. Each pass looks at all permits
    without a contractor by itself: to leave out what the earlier ones found, each would have to repeat these.
    """
    cache = address_cache(contractors) if cache is None else cache
    open_ = permits.filter("contractor_id IS NULL")
    passes = {
        "license": by_license(open_, contractors),
        "address": _one_of_each(by_address(open_, cache)),
        "name": _one_of_each(by_name(open_, contractors)),
    }
    linked = permits.withColumn("match_pass", F.when(F.col("contractor_id").isNotNull(), "linked"))
    for name, found in passes.items():
        found = found.select(F.col("permit_id").alias("_permit"), F.col("contractor_id").alias("_contractor"))
        linked = linked.join(found, linked["id"] == found["_permit"], "left").withColumns(
            {
                "match_pass": F.coalesce("match_pass", F.when(F.col("_contractor").isNotNull(), name)),
                "contractor_id": F.coalesce("contractor_id", "_contractor"),
            }
        ).drop("_permit", "_contractor")
    return linked


def _one_of_each(found: DataFrame) -> DataFrame:
    """Permits of one id have one contractor."""
    return found.groupBy("permit_id").agg(F.max("contractor_id").alias("contractor_id"))


def counters(permits: DataFrame) -> DataFrame:
    """contractor_id, permit_count_active (null and terminal statuses aren't active), by city."""
    active = ~F.col("status").isin(*taxonomy.TERMINAL_STATUSES)
    by_city = (
        permits.filter("contractor_id IS NOT NULL")
        .groupBy("contractor_id", "city")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(active).alias("active"))
    )
    entries = F.collect_list(F.when(F.col("city").isNotNull(), F.struct("city", "n")))
    return by_city.groupBy("contractor_id").agg(
        F.sum("active").alias("permit_count_active"),
        F.sum("n").alias("permit_count_total"),
        F.map_from_entries(F.sort_array(entries)).alias("permit_count_by_city"),
    )


def two_stage_pass_rate(inspections: DataFrame, permits: DataFrame) -> DataFrame:
    """contractor_id, inspection_pass_rate: exactly Approved among all, added up by permit first."""
    per_permit = inspections.groupBy("permit_ref").agg(
        F.count_if(F.col("inspection_result") == "Approved").alias("approved"),
        F.count(F.lit(1)).alias("total"),
    )
    linked = permits.filter("contractor_id IS NOT NULL").select("permit_number", "contractor_id")
    on = F.replace(F.col("permit_ref"), F.lit(" "), F.lit("-")) == F.col("permit_number")
    return (
        per_permit.join(linked, on)
        .groupBy("contractor_id")
        .agg((F.sum("approved") / F.nullif(F.sum("total"), F.lit(0))).alias("inspection_pass_rate"))
    )


def linked(permits: DataFrame, contractors: DataFrame) -> DataFrame:
    """permit_id, contractor_name, contractor_id, business_name, cslb_license of linked permits."""
    right = contractors.select(F.col("id").alias("contractor_id"), "business_name", "cslb_license")
    left = permits.select(F.col("id").alias("permit_id"), "contractor_name", "contractor_id")
    return left.join(right, "contractor_id").select(
        "permit_id", "contractor_name", "contractor_id", "business_name", "cslb_license"
    )
