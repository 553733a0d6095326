"""The domain's frames made of the driver tables, by statements that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

CONTRACTORS = """
SELECT CAST(c_custkey AS STRING) AS id, CAST(c_custkey AS STRING) AS cslb_license,
  concat('The ', c_name, ' Builders, Inc.') AS business_name,
  concat('Owner ', c_name) AS owner_name,
  CASE WHEN c_custkey % 7 <> 0
       THEN concat('(213) 555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) END AS phone,
  CASE WHEN c_custkey % 5 <> 0
       THEN concat('site', CAST(c_custkey % 400 AS STRING), '.example') END AS website,
  concat(CAST(c_custkey AS STRING), ' Main St') AS address_street, n_name AS address_city,
  'CA' AS address_state, lpad(CAST(c_custkey % 100000 AS STRING), 5, '9') AS address_zip,
  CASE WHEN c_custkey % 3 = 1 THEN concat(CAST(c_custkey AS STRING), '@mail.example') END AS email,
  c_mktsegment AS license_class, c_acctbal > 0 AS has_active_license,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN '12/31/1998'
       WHEN c_custkey % 11 = 2 THEN 'soon' WHEN c_custkey % 11 < 6 THEN '1998-10-15'
       ELSE '2001-05-01' END AS license_expiry,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN '01/15/1998'
       ELSE '2000-01-01' END AS worker_comp_expiry,
  CASE WHEN c_custkey % 4 <> 0 THEN CAST(1 + c_custkey % 5 AS DOUBLE) END AS google_rating,
  CAST(c_custkey % 30 AS INT) AS review_count,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 40 AS INT) END AS years_in_business,
  CASE WHEN c_custkey % 3 = 0 THEN '{}' END AS social_links,
  CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 101 AS DOUBLE) / 100 END AS inspection_pass_rate,
  CAST(c_custkey % 28 AS DOUBLE) AS avg_days_between_inspections,
  CAST(c_custkey % 6 AS INT) AS permit_count_active,
  CASE WHEN c_acctbal > -500 THEN c_acctbal END AS icp_score,
  CASE WHEN c_acctbal >= 8000 THEN 'A' WHEN c_acctbal >= 6000 THEN 'B'
       WHEN c_acctbal >= 4000 THEN 'C' ELSE 'D' END AS icp_tier
FROM [customer] JOIN [nation] ON c_nationkey = n_nationkey
"""

PERMITS = """
SELECT CAST(o_orderkey AS STRING) AS id, concat('P-', CAST(o_orderkey AS STRING)) AS permit_number,
  CASE WHEN o_orderkey % 17 <> 0 THEN n_name END AS city,
  CASE o_orderstatus WHEN 'F' THEN 'Permit Finaled' WHEN 'O' THEN 'Issued' END AS status,
  CAST(floor(o_totalprice) AS BIGINT) AS valuation_usd, o_orderpriority = '1-URGENT' AS adu_flag,
  CAST(o_orderdate AS DATE) AS issued_date, o_orderpriority AS permit_type,
  concat('{"license":"', CASE WHEN o_orderkey % 3 = 0 THEN concat(' ', CAST(o_custkey AS STRING), ' ')
                              WHEN o_orderkey % 3 = 1 THEN '0' ELSE '' END,
         '","contractor_city":"', n_name, '"}') AS raw_source,
  CASE WHEN o_orderkey % 2 = 0 THEN concat(CAST(o_custkey AS STRING), ' MAIN ST') END
    AS contractor_address,
  CASE WHEN o_orderkey % 5 < 3 THEN concat(c_name, ' Co.') END AS contractor_name,
  CAST(NULL AS STRING) AS contractor_id, CAST(o_custkey AS STRING) AS owner
FROM [orders] JOIN [customer] ON o_custkey = c_custkey JOIN [nation] ON c_nationkey = n_nationkey
"""

INSPECTIONS = """
SELECT concat('P ', CAST(l_orderkey AS STRING)) AS permit_ref, l_returnflag AS inspection_type,
  CAST(l_shipdate AS DATE) AS inspection_date,
  CASE WHEN l_linestatus = 'F' THEN 'Approved' WHEN l_linenumber = 1 THEN 'Partial Approval'
       WHEN l_linenumber = 2 THEN NULL ELSE 'Corrections Issued' END AS inspection_result,
  l_linenumber, l_partkey, l_suppkey
FROM [lineitem]
"""

TOUCHES = """
SELECT CAST(user_id AS STRING) AS contractor_id, CAST(event_id AS STRING) AS external_id,
  CASE event_type WHEN 'view' THEN 'sms_sent' WHEN 'click' THEN 'call_placed'
       WHEN 'error' THEN 'opted_out' ELSE 'reply' END AS touch_type,
  CAST(ts AS TIMESTAMP) AS occurred_at, event_type AS sequence_id,
  CAST(NULL AS STRING) AS hypothesis_id
FROM [events] WHERE event_id % 9 = 0
"""

HYPOTHESES = """
SELECT concat('h', CAST(o_orderkey AS STRING)) AS id, CAST(o_custkey AS STRING) AS contractor_id,
  CAST(rn AS INT) AS rank, o_orderpriority AS hook_line, o_orderstatus AS body_text
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
      FROM [orders] WHERE o_orderkey % 4 = 0) ranked WHERE rn <= 3
"""


def frame(spark: SparkSession, sf_dir: str, statement: str) -> DataFrame:
    """The statement over the tables that it names in brackets."""
    names = set(re.findall(r"\[(\w+)\]", statement))
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    escaped = statement.replace("{", "{{").replace("}", "}}")
    return spark.sql(re.sub(r"\[(\w+)\]", r"{\1}", escaped), **tables)


def ctes(**statements: str) -> str:
    """WITH clauses for DuckDB."""
    plain = {k: re.sub(r"\[(\w+)\]", r"\1", s) for k, s in statements.items()}
    return "WITH " + ", ".join(f"{k} AS ({s})" for k, s in plain.items())
