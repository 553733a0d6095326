"""Scalar functions over the driver tables' text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.functions import parse, text
from girder.operators import external
from girder.plans.frames import CONTRACTORS, PERMITS, ctes, frame
from girder.sources import pages as license_pages


def normalize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, CONTRACTORS)
    return rows.select("id", text.normalize_name(F.col("business_name")).alias("name"))


def phone_e164(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, CONTRACTORS)
    return rows.select("id", text.normalize_phone(F.col("phone")).alias("digits"), text.to_e164(F.col("phone")).alias("e164"))


def address_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, PERMITS)
    return rows.select("id", text.address_key(F.col("contractor_address"), F.col("city")).alias("address"))


def person_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/part.parquet")
    return rows.select("p_partkey", text.person_uuid(F.col("p_partkey").cast("string")).alias("uuid"))


def parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dollars and cents of formatted prices, followed by text that is ignored."""
    money = F.concat(F.lit("$"), F.format_string("%,.2f", F.col("o_totalprice")), F.lit(" est."))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", money.alias("t"))
    return rows.select("o_orderkey", parse.parse_dollars(F.col("t")).alias("dollars"), parse.parse_cents(F.col("t")).alias("cents"))


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO, turned, glued and other forms by turns."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    raw = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(k == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(k == 2, F.concat(F.date_format(d, "MM/dd/yyyy"), F.lit(" 00:00")))
        .otherwise(F.lit(" n/a "))
    )
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", raw.alias("t"))
    return rows.select("o_orderkey", parse.parse_date(F.col("t")).alias("parsed"), parse.turn_date(F.col("t")).alias("turned"))


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k")
    kept = events.filter(k.isNotNull() & (k != "") & (k != "0"))
    return kept.select("event_id", k.try_cast("int").alias("k"))


def map_any_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether some part of a customer's orders, by priority, is over a third of its money."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    money = orders.groupBy("o_custkey", "o_orderpriority").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v"))
    whole = money.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", F.col("v") / 1e6))).alias("m"))
    return whole.select("o_custkey", parse.any_over(F.col("m")).alias("any_over"), parse.key_count(F.col("m")).alias("keys"))


def html_title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", license_pages.title(F.col("html")).alias("title"))


def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline classifier over the whole texts of documents as descriptions; some have a category already."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    permits = docs.select(
        F.col("doc_id").alias("id"),
        F.col("text").alias("work_description"),
        F.when(F.col("doc_id") % 7 == 0, "Solar").cast("string").alias("project_category_ai"),
        F.lit(False).alias("adu_flag"),
    )
    return external.classify(permits).select("id", "project_category_ai", "adu_flag")


def percent_and_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count(F.lit(1)).alias("n")
    )
    return rows.select("o_orderpriority", "done", "n", F.round(F.col("done") / F.col("n") * 100, 6).alias("share"))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_name, phone_e164, address_key, person_uuid, parse_money, parse_dates, json_extract,
        map_any_value, html_title_extract, classify_documents, percent_and_counts,
    )
}

BASE = ctes(contractors=CONTRACTORS, permits=PERMITS)
ORACLE_SQL = {
    "normalize_name": rf"""{BASE}
SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(lower(business_name),
  '\b(llc|l\.l\.c\.?|inc\.?|corp\.?|corporation|co\.?|ltd\.?|lp|dba|the)\b', '', 'g'), '[.,]', '', 'g'), '\s+', ' ', 'g')) AS name
FROM contractors
""",
    "phone_e164": f"""{BASE}
SELECT id, regexp_replace(phone, '[^0-9]', '', 'g') AS digits, '+1' || regexp_replace(phone, '[^0-9]', '', 'g') AS e164 FROM contractors
""",
    "address_key": f"""{BASE}
SELECT id, CASE WHEN contractor_address IS NOT NULL THEN lower(concat_ws(', ', contractor_address, city)) END AS address FROM permits
""",
    "person_uuid": """
SELECT p_partkey, s[1:8] || '-' || s[9:12] || '-4' || s[14:16] || '-'
  || substr('89ab', CAST(('0x' || s[17:17])::INTEGER % 4 + 1 AS INTEGER), 1) || s[18:20] || '-' || s[21:32] AS uuid
FROM (SELECT p_partkey, sha256('person:' || p_partkey) AS s FROM part)
""",
    "parse_money": """
SELECT o_orderkey, CAST(floor(o_totalprice + 0.5::DOUBLE) AS BIGINT) AS dollars,
  CAST(floor(o_totalprice * 100 + 0.5::DOUBLE) AS BIGINT) AS cents FROM orders
""",
    "parse_dates": """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN 'n/a' WHEN 2 THEN strftime(o_orderdate, '%Y 00:00-%m-%d')
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed,
  CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y 00:00') ELSE ' n/a ' END AS turned FROM orders
""",
    "json_extract": """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
WHERE json_extract_string(props, '$.k') NOT IN ('', '0')
""",
    "map_any_value": """
SELECT o_custkey, bool_or(v / 1e6 > 0.3::DOUBLE) AS any_over, CAST(count(*) AS INTEGER) AS keys FROM (
  SELECT o_custkey, o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2)
GROUP BY 1
""",
    "html_title_extract": """
SELECT page_id, nullif(trim(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1)), '') AS title FROM pages
""",
    "classify_documents": rf"""
WITH named AS (SELECT doc_id, text, lower(coalesce(text, '')) AS t FROM documents),
found AS (SELECT doc_id, text, CASE {" ".join(f"WHEN regexp_matches(t, '{p}') THEN '{name}'" for name, p in external.KEYWORDS)}
  ELSE 'Other' END AS c FROM named)
SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN 'Solar' WHEN text IS NOT NULL THEN c END AS project_category_ai,
  doc_id % 7 <> 0 AND text IS NOT NULL AND c IN ('ADU', 'JADU') AS adu_flag FROM found
""",
    "percent_and_counts": """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) AS n,
  round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) * 100, 6) AS share FROM orders GROUP BY 1
""",
}
