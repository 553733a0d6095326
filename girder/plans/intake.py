"""Raw records, replies, license pages and the merge policies, on texts that are built from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.functions import parse, text
from girder.operators import inspections as op
from girder.operators import linking, outreach, upsert
from girder.plans.frames import CONTRACTORS, HYPOTHESES, PERMITS, ctes, frame
from girder.plans.inspections import classes, inspected
from girder.sources import pages, records

RAW_PERMITS = """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN ' ' ELSE concat(' ', CAST(o_orderkey AS STRING), ' ') END AS pcis_permit,
  CAST(o_orderkey % 900 AS STRING) AS address_start, CASE WHEN o_orderkey % 3 = 0 THEN ' W ' END AS street_direction,
  'MAIN' AS street_name, CASE WHEN o_orderkey % 2 = 0 THEN 'ST' ELSE '' END AS street_suffix,
  concat('$', CAST(o_orderkey % 1000 AS STRING), ',500.49') AS valuation,
  concat(CAST(o_orderkey % 9 AS STRING), ',000 sq') AS floor_area_l_a_zoning_code_definition,
  CASE WHEN o_orderkey % 4 = 0 THEN 'two' ELSE concat(' ', CAST(o_orderkey % 7 AS STRING), ' floors') END AS of_stories,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN '03/07/1999'
       ELSE '1999-03-07T00:00:00.000' END AS status_date,
  CASE WHEN o_orderkey % 6 > 0 THEN 'Ann' END AS applicant_first_name,
  CASE WHEN o_orderkey % 4 > 0 THEN ' Lee ' END AS applicant_last_name, o_orderpriority AS permit_type
FROM [orders]
"""
RAW_INSPECTIONS = """
SELECT CASE WHEN l_linenumber = 7 THEN ' ' ELSE concat('P ', CAST(l_orderkey AS STRING)) END AS permit,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS inspection_date,
  CASE l_returnflag WHEN 'N' THEN ' ' WHEN 'R' THEN 'Final ' ELSE 'Framing' END AS inspection,
  l_linestatus AS inspection_result, concat(' ', CAST(l_linenumber AS STRING), '.5N') AS latitude,
  CASE WHEN l_linenumber = 3 THEN 'west' ELSE CAST(-l_linenumber AS STRING) END AS longitude,
  l_linenumber, l_partkey, l_suppkey
FROM [lineitem]
"""
LEGACY = """
SELECT CAST(c_custkey AS STRING) AS cslb_license_number, c_name AS company_name,
  concat(CAST(c_custkey AS STRING), ' Main St, Springfield, CA') AS address,
  CASE c_custkey % 6 WHEN 0 THEN ' active ' WHEN 1 THEN 'Cancelled' WHEN 2 THEN 'SUSPENDED' WHEN 3 THEN 'expired'
       WHEN 4 THEN '' ELSE 'Not Renewed' END AS license_status,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 101 AS STRING) END AS icp_score,
  CASE c_custkey % 3 WHEN 0 THEN '{"a": 1}' WHEN 1 THEN '{bad' END AS social_links,
  CASE WHEN c_custkey % 2 = 0 THEN '12/31/2020' ELSE 'soon' END AS license_expiration,
  concat(CAST(c_custkey % 50 AS STRING), '.5') AS permit_total_valuation
FROM [customer]
"""
REPLIES = """
SELECT p_partkey, concat('```json
[{"index": ', CAST(p_size AS STRING), ', "category": "', CASE p_partkey % 4 WHEN 0 THEN 'ADU' WHEN 1 THEN 'Kitchen'
  WHEN 2 THEN 'Spaceship' ELSE 'Solar' END, '"}]
```') AS classified,
  concat('Here you are: [{"rank": ', CAST(p_size AS STRING), ', "pain_angle": "', CASE p_partkey % 3 WHEN 0
  THEN 'correction_rate' WHEN 1 THEN 'boredom' ELSE 'inspection_delays' END, '", "hook_line": "', p_name,
  '", "body_text": ', CASE WHEN p_partkey % 5 = 0 THEN 'null' ELSE '"b"' END, ', "grounding_signals": []}] Bye') AS generated
FROM [part]
"""
LICENSE_PAGES = """
SELECT CAST(s_suppkey AS STRING) AS license, concat('<html><h1>License Detail for License # 1</h1><table>',
  '<tr><td id="MainContent_BusInfo">', s_name, '<br/>', CAST(s_suppkey AS STRING), ' OAK AVE<br>',
  CASE WHEN s_suppkey % 3 = 0 THEN 'LOS ANGELES' ELSE 'LOS ANGELES, CA 90001' END,
  '<br>Business Phone Number: (213) 555-0', CAST(100 + s_suppkey % 800 AS STRING), '</td>',
  '<td id="MainContent_ExpDt">', CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE '05/31/2027' END, '</td>',
  '<td id="MainContent_Status">', CASE s_suppkey % 3 WHEN 0 THEN 'This license is current and active.'
  WHEN 1 THEN 'This license is not current.' ELSE 'Suspended for cause' END, '</td>',
  '<td id="MainContent_BondingCellTable"><strong>Bond Amount: </strong>$25,000.50</td></tr></table></html>') AS html
FROM [supplier]
"""


def raw_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, RAW_PERMITS)
    absent = [f.name for f in records.RAW_PERMIT.fields if f.name not in raw.columns]
    made = records.permits(raw.select("*", *[F.lit(None).cast("string").alias(c) for c in absent]))
    return made.select(
        "permit_number", "address", "status_date", "valuation_usd", "total_sqft", "number_of_stories", "applicant_name"
    )


def _inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, RAW_INSPECTIONS).withColumns(
        {
            "lat_lon": F.struct("latitude", "longitude"),
            **{c: F.lit(None).cast("string") for c in ("address", "permit_status", ":updated_at")},
        }
    )
    return records.inspections(raw)


def raw_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inspections(spark, sf_dir).groupBy("inspection_type", "inspection_result", "lat", "lng").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("permit_ref").startswith("P ")).alias("named")
    )


def inspections_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op.within_box(_inspections(spark, sf_dir), 2.0, -5.0, 6.0, -1.0)
    return found.groupBy("permit_ref").agg(F.count(F.lit(1)).alias("n"))


def _legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, LEGACY)
    absent = [f.name for f in records.LEGACY_CONTRACTOR.fields if f.name not in raw.columns]
    return records.legacy_contractors(raw.select("*", *[F.lit(None).cast("string").alias(c) for c in absent]))


def legacy_contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _legacy(spark, sf_dir).select(
        "cslb_license", "address_street", "license_status", "has_active_license", "icp_tier", "social_links",
        "license_expiry", "total_valuation_cents",
    )


def upsert_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other contractor is there already, with an id and a date of creation that stay."""
    delta = _legacy(spark, sf_dir).select("cslb_license", "business_name", "license_status", "icp_tier", F.lit("new").alias("created_at"))
    base = delta.filter("CAST(cslb_license AS INT) % 2 = 0").select(
        F.concat(F.lit("id-"), "cslb_license").alias("id"), "cslb_license", F.lit("old name").alias("business_name"),
        F.lit("active").alias("license_status"), F.lit("A").alias("icp_tier"), F.lit("old").alias("created_at"),
    )
    return upsert.upsert(base, delta, upsert.LEGACY_CONTRACTORS)


def upsert_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later results overwrite, computed columns stay; the key has three columns and the last of a key wins."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").cast("string").alias("permit_ref"),
        F.col("l_shipdate").cast("date").cast("string").alias("inspection_date"),
        F.col("l_returnflag").alias("inspection_type"), F.col("l_linestatus").alias("inspection_result"),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    last = upsert.keep_last(items, upsert.INSPECTIONS.keys, "seq").drop("seq")
    base = last.filter("inspection_type <> 'N'").withColumns(
        {"inspection_result": F.lit("first"), "trade_category_ai": F.lit("kept")}
    )
    delta = items.filter("inspection_type <> 'A'").withColumn("trade_category_ai", F.lit("lost"))
    return upsert.upsert(base, delta, upsert.INSPECTIONS, "seq")


def upsert_contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A license scrape refreshes license, bond and insurance only."""
    rows = frame(spark, sf_dir, CONTRACTORS).select("id", "cslb_license", "business_name", "license_class", "license_expiry", "icp_tier")
    delta = rows.filter("CAST(id AS INT) % 3 = 0").select(
        F.lit("scraped").alias("id"), "cslb_license", F.lit("scraped").alias("business_name"), F.lit("B").alias("license_class"),
        F.lit(None).cast("string").alias("license_expiry"), F.lit("Z").alias("icp_tier"),
    )
    return upsert.upsert(rows, delta, upsert.CONTRACTORS)


def upsert_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, HYPOTHESES).select("id", "contractor_id", "rank", "hook_line", "body_text")
    delta = rows.select(F.lit("other").alias("id"), "contractor_id", (F.col("rank") + 1).alias("rank"), F.lit("new").alias("hook_line"), "body_text")
    return upsert.upsert(rows, delta, upsert.HYPOTHESES).select("id", "contractor_id", "rank", "hook_line")


def classifier_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, REPLIES)
    return rows.select("p_partkey", F.inline(text.classifier_reply(F.col("classified"))))


def generator_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir, REPLIES).select("p_partkey", F.inline(text.generator_reply(F.col("generated"))))
    return rows.select("p_partkey", "rank", "pain_angle", "hook_line")


def license_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pages.parse_license_pages(frame(spark, sf_dir, LICENSE_PAGES))
    return made.select(
        "cslb_license", "business_name", "phone", "address_street", "address_city", "address_zip", "license_status",
        "license_expiry", "bond_amount_cents", "has_active_license",
    )


def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a run: its age at a fixed time, its icon, its stamp, the latest of its dates, what it lacks."""
    day = F.col("o_orderdate")
    status = F.element_at(F.array(*map(F.lit, ("idle", "running", "error", "new"))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", day.cast("timestamp").alias("at"), status.alias("status"),
        F.when(F.col("o_orderkey") % 3 > 0, F.date_format(day, "yyyy-MM-dd")).alias("a"),
        F.when(F.col("o_orderkey") % 2 > 0, F.lit("1998-06-01")).otherwise(F.lit("never")).alias("b"),
    )
    now = F.lit("2002-01-01 00:00:00").cast("timestamp")
    return rows.select(
        "o_orderkey", parse.hours_since(F.col("at"), now).alias("hours"), parse.status_icon(F.col("status")).alias("icon"),
        parse.delta_stamp(F.col("at")).alias("stamp"), parse.latest(F.col("a"), F.col("b")).cast("date").cast("string").alias("latest"),
        F.array_join(text.null_fields("a", "b"), ",").alias("lacks"),
    )


def correction_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer's orders, the share of failed inspections by type."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    owners = orders.select(F.col("o_orderkey").alias("permit_ref"), F.col("o_custkey").alias("contractor_id"))
    made = op.correction_rates(op.with_class(inspected(spark, sf_dir), classes(spark)), owners)
    return made.select("contractor_id", F.explode("correction_rate_by_trade").alias("trade", "rate")).withColumn(
        "rate", F.round("rate", 9)
    )


def note_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = outreach.note_payloads(frame(spark, sf_dir, HYPOTHESES))
    pick = lambda p: F.get_json_object("payload", p)
    return made.select(
        pick("$.id").alias("id"), pick("$.title").alias("title"), pick("$.bodyV2.markdown").alias("markdown"),
        pick("$.bodyV2.blocknote").alias("blocknote"),
    )


def linked_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five linked permits, the first by id: a sample is the feature."""
    permits = frame(spark, sf_dir, PERMITS).drop("contractor_id").withColumnRenamed("owner", "contractor_id")
    found = linking.linked(permits, frame(spark, sf_dir, CONTRACTORS))
    return found.orderBy(F.col("permit_id").cast("long")).limit(5)


QUERIES = {
    f.__name__: f
    for f in (
        raw_permits, raw_inspections, inspections_in_box, legacy_contractors, upsert_legacy, upsert_inspections,
        upsert_contractors, upsert_hypotheses, classifier_replies, generator_replies, license_pages, pipeline_health,
        correction_rates, note_payloads, linked_sample,
    )
}

_LEGACY_STATUS = """CASE c_custkey % 6 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' WHEN 2 THEN 'suspended'
  WHEN 3 THEN 'expired' WHEN 5 THEN 'inactive' END"""
_LEGACY_TIER = """CASE WHEN c_custkey % 5 > 0 THEN CASE WHEN c_custkey % 101 >= 75 THEN 'A' WHEN c_custkey % 101 >= 50 THEN 'B'
  WHEN c_custkey % 101 >= 25 THEN 'C' ELSE 'D' END END"""
_KEYED = """SELECT CAST(l_orderkey AS VARCHAR) AS permit_ref, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS inspection_date,
  l_returnflag AS inspection_type, arg_max(l_linestatus, l_partkey * 100000 + l_suppkey * 10 + l_linenumber) AS result
  FROM lineitem GROUP BY 1, 2, 3"""

ORACLE_SQL = {
    "raw_permits": """
SELECT CAST(o_orderkey AS VARCHAR) AS permit_number, concat_ws(' ', CAST(o_orderkey % 900 AS VARCHAR),
    CASE WHEN o_orderkey % 3 = 0 THEN 'W' END, 'MAIN', CASE WHEN o_orderkey % 2 = 0 THEN 'ST' END) AS address,
  CASE WHEN o_orderkey % 5 > 0 THEN '1999-03-07' END AS status_date,
  CASE WHEN o_orderkey % 1000 = 0 THEN 500 ELSE o_orderkey % 1000 * 1000 + 500 END AS valuation_usd,
  CAST(o_orderkey % 9 * 1000 AS INTEGER) AS total_sqft,
  CAST(CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 7 END AS INTEGER) AS number_of_stories,
  nullif(concat_ws(' ', CASE WHEN o_orderkey % 6 > 0 THEN 'Ann' END, CASE WHEN o_orderkey % 4 > 0 THEN 'Lee' END), '')
    AS applicant_name
FROM orders WHERE o_orderkey % 50 <> 0
""",
    "raw_inspections": """
SELECT CASE l_returnflag WHEN 'N' THEN 'Unknown' WHEN 'R' THEN 'Final' ELSE 'Framing' END AS inspection_type,
  l_linestatus AS inspection_result, l_linenumber + 0.5::DOUBLE AS lat,
  CASE WHEN l_linenumber <> 3 THEN -l_linenumber::DOUBLE END AS lng, count(*) AS n, count(*) AS named
FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1, 2, 3, 4
""",
    "inspections_in_box": """
SELECT concat('P ', CAST(l_orderkey AS VARCHAR)) AS permit_ref, count(*) AS n FROM lineitem
WHERE l_linenumber IN (2, 4, 5) GROUP BY 1
""",
    "legacy_contractors": f"""
SELECT CAST(c_custkey AS VARCHAR) AS cslb_license, CAST(c_custkey AS VARCHAR) || ' Main St' AS address_street,
  {_LEGACY_STATUS} AS license_status, c_custkey % 6 = 0 AS has_active_license, {_LEGACY_TIER} AS icp_tier,
  CASE WHEN c_custkey % 3 = 0 THEN '{{"a": 1}}' END AS social_links,
  CASE WHEN c_custkey % 2 = 0 THEN '2020-12-31' ELSE 'soon' END AS license_expiry,
  c_custkey % 50 * 100 + 50 AS total_valuation_cents FROM customer
""",
    "upsert_legacy": f"""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'id-' || CAST(c_custkey AS VARCHAR) END AS id,
  CAST(c_custkey AS VARCHAR) AS cslb_license, c_name AS business_name, {_LEGACY_STATUS} AS license_status,
  {_LEGACY_TIER} AS icp_tier, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE 'new' END AS created_at FROM customer
""",
    "upsert_inspections": f"""
SELECT permit_ref, inspection_date, inspection_type, CASE inspection_type WHEN 'A' THEN 'first' ELSE result END
  AS inspection_result, CASE inspection_type WHEN 'N' THEN 'lost' ELSE 'kept' END AS trade_category_ai
FROM ({_KEYED})
""",
    "upsert_contractors": f"""{ctes(contractors=CONTRACTORS)}
SELECT id, cslb_license, business_name, CASE WHEN CAST(id AS INTEGER) % 3 = 0 THEN 'B' ELSE license_class END AS license_class,
  CASE WHEN CAST(id AS INTEGER) % 3 <> 0 THEN license_expiry END AS license_expiry, icp_tier FROM contractors
""",
    "upsert_hypotheses": f"""{ctes(h=HYPOTHESES)}
SELECT h.id, h.contractor_id, h.rank, CASE WHEN d.rank IS NULL THEN h.hook_line ELSE 'new' END AS hook_line
FROM h LEFT JOIN h d ON d.contractor_id = h.contractor_id AND d.rank + 1 = h.rank
UNION ALL SELECT 'other', d.contractor_id, d.rank + 1, 'new' FROM h d
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.contractor_id = d.contractor_id AND h.rank = d.rank + 1)
""",
    "classifier_replies": """
SELECT p_partkey, p_size AS index, CASE p_partkey % 4 WHEN 0 THEN 'ADU' WHEN 1 THEN 'Kitchen' WHEN 2 THEN 'Other'
  ELSE 'Solar' END AS category FROM part
""",
    "generator_replies": """
SELECT p_partkey, p_size AS rank, CASE p_partkey % 3 WHEN 0 THEN 'correction_rate' ELSE 'inspection_delays' END AS pain_angle,
  p_name AS hook_line FROM part WHERE p_partkey % 3 <> 1 AND p_partkey % 5 <> 0
""",
    "license_pages": """
SELECT CAST(s_suppkey AS VARCHAR) AS cslb_license, s_name AS business_name,
  '2135550' || CAST(100 + s_suppkey % 800 AS VARCHAR) AS phone, CAST(s_suppkey AS VARCHAR) || ' OAK AVE' AS address_street,
  'LOS ANGELES' AS address_city, CASE WHEN s_suppkey % 3 > 0 THEN '90001' END AS address_zip,
  CASE s_suppkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'suspended' END AS license_status,
  CASE WHEN s_suppkey % 4 > 0 THEN '05/31/2027' END AS license_expiry, 2500050 AS bond_amount_cents,
  s_suppkey % 3 = 0 AS has_active_license FROM supplier
""",
    "pipeline_health": """
SELECT o_orderkey, CAST(floor((epoch(TIMESTAMP '2002-01-01') - epoch(o_orderdate)) / 3600 + 0.5) AS BIGINT) AS hours,
  CASE o_orderkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN '..' WHEN 2 THEN '!!' ELSE '??' END AS icon,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000' AS stamp,
  CAST(greatest(CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderdate AS DATE) END,
    CASE WHEN o_orderkey % 2 > 0 THEN DATE '1998-06-01' END) AS VARCHAR) AS latest,
  CASE WHEN o_orderkey % 3 = 0 THEN 'a' ELSE '' END AS lacks FROM orders
""",
    "correction_rates": """
SELECT o_custkey AS contractor_id, CASE l_returnflag WHEN 'R' THEN 'final' ELSE 'framing' END AS trade,
  round(count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag <> 'R') / count(*), 9) AS rate
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag IN ('R', 'A') AND l_linestatus IN ('O', 'F')
GROUP BY 1, 2
""",
    "note_payloads": f"""{ctes(h=HYPOTHESES)}
SELECT id, hook_line AS title, body_text AS markdown,
  '[{{"type":"paragraph","content":[{{"type":"text","text":"' || body_text || '"}}]}}]' AS blocknote FROM h
""",
    "linked_sample": f"""{ctes(contractors=CONTRACTORS, permits=PERMITS)}
SELECT p.id AS permit_id, contractor_name, owner AS contractor_id, business_name, cslb_license
FROM permits p JOIN contractors c ON p.owner = c.id ORDER BY CAST(p.id AS BIGINT) LIMIT 5
""",
}
