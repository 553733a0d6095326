"""Audiences, webhooks and contact payloads on customers, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from girder.operators import external, outreach, reports
from girder.plans.contractors import SCORED, _scored
from girder.plans.frames import CONTRACTORS, HYPOTHESES, TOUCHES, ctes, frame


def contractors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, CONTRACTORS)


def hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, HYPOTHESES)


def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, TOUCHES)


def sms_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outreach.audience(
        contractors(spark, sf_dir), hypotheses(spark, sf_dir), touches(spark, sf_dir), ("A", "B"), "sms_sent"
    )
    return found.select("id", "hypothesis_id", "hook_line")


def voice_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opted-out contractors stay, as in the original."""
    found = outreach.audience(
        contractors(spark, sf_dir), hypotheses(spark, sf_dir), touches(spark, sf_dir), ("A",), "call_placed",
        exclude_opted_out=False,
    )
    return found.select("id", "hypothesis_id", "hook_line")


def would_send(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outreach.audience(
        contractors(spark, sf_dir), hypotheses(spark, sf_dir), touches(spark, sf_dir), ("A", "B"), "sms_sent",
        after="1", limit=25,
    )
    return outreach.would_send(found, "sms")


def pending_hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.pending(contractors(spark, sf_dir), hypotheses(spark, sf_dir)).select("id", "icp_tier")


def signals_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    from girder.functions.text import signal_summary
    from girder.operators.scoring import signals
    from girder.plans.contractors import AS_OF

    scored = _scored(spark, sf_dir)
    rows = outreach.with_signals(scored.select("id"), signals(scored, AS_OF))
    return rows.select("id", F.size("signals").alias("n"), signal_summary(F.col("signals")).alias("summary"))


def generated_angles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline generator: how many angles each contractor gets, and the first."""
    from girder.operators.scoring import signals
    from girder.plans.contractors import AS_OF

    scored = _scored(spark, sf_dir)
    rows = outreach.with_signals(scored, signals(scored, AS_OF))
    made = external.angles(rows)
    return made.select("contractor_id", "rank", "pain_angle", "hook_line", F.size("grounding_signals").alias("grounds"))


def missing_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys in the payloads that no nation has; the key column has no nulls."""
    k = F.get_json_object("props", "$.k").alias("license")
    wanted = spark.read.parquet(f"{sf_dir}/events.parquet").select(k).filter(
        "license IS NOT NULL AND license <> '' AND license <> '0'"
    ).distinct()
    have = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").cast("string").alias("license"))
    return wanted.join(have, "license", "left_anti").orderBy("license")


def unknown_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers in the first nation: the bucket that absorbs unknown licenses."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    zero = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_nationkey = 0")
    hit = orders.join(zero, orders["o_custkey"] == zero["c_custkey"], "left_semi")
    return hit.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


def top_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 best; a missing score comes first, as the original's order has it."""
    rows = contractors(spark, sf_dir)
    return reports.top(rows, 100, F.col("icp_score").desc_nulls_first(), F.col("id")).select("id", "icp_score")


def top_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contractors(spark, sf_dir)
    return reports.top(rows, 20, F.col("icp_score").desc_nulls_last(), F.col("id")).select("id", "icp_score")


def top_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    label = F.coalesce(F.nullif("o_orderpriority", F.lit("")), F.lit("(empty)")).alias("status")
    counted = orders.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return reports.top(counted, 20, F.desc("n"), F.col("status"))


def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next 1000 orders after a cursor."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderkey > 100")
    return reports.top(orders, 1000, F.col("o_orderkey"), F.col("o_custkey")).select("o_orderkey", "o_custkey")


def contractor_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outreach.lookup(contractors(spark, sf_dir), phone="+1 (213) 555-0010")
    return found.select("id", "cslbLicense", "businessName", "phone")


def company_first_website(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outreach.company_payloads(contractors(spark, sf_dir))
    return rows.select(
        "id",
        F.get_json_object("payload", "$.name").alias("name"),
        F.get_json_object("payload", "$.domainName.primaryLinkUrl").alias("website"),
        F.get_json_object("payload", "$.idealCustomerProfile").alias("ideal"),
    )


def person_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outreach.person_payloads(contractors(spark, sf_dir))
    pick = lambda path: F.get_json_object("payload", path)
    return rows.select(
        "id",
        pick("$.id").alias("person_id"),
        pick("$.name.firstName").alias("first_name"),
        pick("$.name.lastName").alias("last_name"),
        pick("$.jobTitle").alias("job_title"),
        pick("$.phones.primaryPhoneNumber").alias("phone"),
    )


def note_targets_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pairs = items.select(F.col("l_orderkey").alias("note_id"), F.col("l_suppkey").alias("company_id"))
    return outreach.missing_targets(
        pairs.distinct(), pairs.where(items["l_linestatus"] == "F")
    )


def opt_out_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    number = F.lpad((F.col("user_id") % 10000).cast("string"), 4, "0")
    messages = events.select(
        F.concat(F.lit("1213555"), number).alias("sender"),
        F.when(F.col("event_type") == "error", " stop ").otherwise("hello").alias("body"),
        F.col("ts").alias("occurred_at"),
    )
    found = outreach.opt_outs(messages, contractors(spark, sf_dir), touches(spark, sf_dir))
    return found.select("contractor_id", "touch_type", F.col("occurred_at").cast("date").cast("string").alias("at"))


def call_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is a call report of the event nine before it, delivered twice."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    reports_ = events.select(
        F.when(F.col("event_id") % 2 == 0, "end-of-call-report").otherwise("status-update").alias("type"),
        F.when(F.col("event_id") % 2 == 1, "in-progress").alias("status"),
        F.when(F.col("event_id") % 4 == 0, "voicemail").alias("ended_reason"),
        (F.col("event_id") - F.col("event_id") % 9).cast("string").alias("call_id"),
        F.col("event_id").cast("int").alias("duration_seconds"),
        F.col("ts").alias("occurred_at"),
    )
    twice = reports_.unionByName(reports_)
    return outreach.call_touches(twice, touches(spark, sf_dir)).select(
        "contractor_id", "external_id", "touch_type", "duration_seconds"
    )


def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.funnel(touches(spark, sf_dir)).select("sequence_id", "sms_sent", "call_placed", "opted_out", "contractors")


QUERIES = {
    f.__name__: f
    for f in (
        sms_audience,
        voice_audience,
        would_send,
        pending_hypotheses,
        signals_nested,
        generated_angles,
        missing_licenses,
        unknown_bucket,
        top_by_score,
        top_scored,
        top_statuses,
        keyset_page,
        contractor_lookup,
        company_first_website,
        person_payloads,
        note_targets_missing,
        opt_out_touches,
        call_touches,
        funnel_counts,
    )
}

BASE = ctes(contractors=CONTRACTORS, hypotheses=HYPOTHESES, touches=TOUCHES)


def _audience(tiers: str, kinds: str) -> str:
    return f"""
SELECT c.id, h.id AS hypothesis_id, h.hook_line FROM contractors c
JOIN hypotheses h ON h.contractor_id = c.id AND h.rank = 1
WHERE c.phone IS NOT NULL AND c.icp_tier IN ({tiers}) AND NOT EXISTS (
  SELECT 1 FROM touches t WHERE t.contractor_id = c.id AND t.touch_type IN ({kinds}))"""


SIGNAL_ROWS = f"""{SCORED}, sig AS (
  SELECT id, 'permit_velocity_high' AS t, least(permit_count_active / 10.0::DOUBLE, 1) AS v FROM scored WHERE permit_count_active > 0
  UNION ALL SELECT id, 'digital_presence_low', 1 - dim_digital / 100 FROM scored WHERE dim_digital < 50
  UNION ALL SELECT id, 'adu_active', least(adu / 5.0::DOUBLE, 1) FROM scored WHERE adu > 0
  UNION ALL SELECT id, 'multi_city_active', least(cities / 10.0::DOUBLE, 1) FROM scored WHERE cities >= 2
  UNION ALL SELECT id, 'license_expiring_soon', 1 FROM scored WHERE le >= DATE '1998-09-01' AND le < DATE '1998-09-01' + 90
  UNION ALL SELECT id, 'workers_comp_lapsed', 1 FROM scored WHERE we < DATE '1998-09-01')"""

ORACLE_SQL = {
    "sms_audience": BASE + _audience("'A', 'B'", "'sms_sent', 'opted_out'"),
    "voice_audience": BASE + _audience("'A'", "'call_placed'"),
    "would_send": f"""{BASE}, a AS ({_audience("'A', 'B'", "'sms_sent', 'opted_out'")} AND c.id > '1' ORDER BY c.id LIMIT 25)
SELECT c.id AS contractor_id, a.hypothesis_id, 'sms' AS channel, '+1' || regexp_replace(c.phone, '[^0-9]', '', 'g') AS to,
  h.hook_line || chr(10) || h.body_text AS message
FROM a JOIN contractors c USING (id) JOIN hypotheses h ON h.id = a.hypothesis_id
""",
    "pending_hypotheses": f"""{BASE}
SELECT id, icp_tier FROM contractors c WHERE icp_tier IN ('A', 'B')
  AND NOT EXISTS (SELECT 1 FROM hypotheses h WHERE h.contractor_id = c.id)
""",
    "signals_nested": f"""{SIGNAL_ROWS}
SELECT s.id, CAST(count(t) AS INTEGER) AS n,
  coalesce(string_agg(t || printf(' (value: %.2f)', sig.v), chr(10) ORDER BY t), 'None') AS summary
FROM scored s LEFT JOIN sig USING (id) GROUP BY 1
""",
    "generated_angles": f"""{SIGNAL_ROWS}, named AS (
  SELECT id, v, t, CASE t WHEN 'permit_velocity_high' THEN 'scale_readiness' WHEN 'digital_presence_low' THEN 'digital_presence'
    WHEN 'adu_active' THEN 'trade_coordination' WHEN 'multi_city_active' THEN 'multi_city_complexity'
    ELSE 'license_compliance' END AS angle FROM sig),
best AS (SELECT id, angle, count(*) AS grounds, min((-v, t)) AS k FROM named GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS r FROM best)
SELECT s.id AS contractor_id, CAST(coalesce(r, 1) AS INTEGER) AS rank, coalesce(angle, 'scale_readiness') AS pain_angle,
  left(business_name || ': ' || replace(coalesce(angle, 'scale_readiness'), '_', ' '), 80) AS hook_line,
  CAST(coalesce(grounds, 0) AS INTEGER) AS grounds
FROM scored s LEFT JOIN (SELECT * FROM ranked WHERE r <= 3) USING (id)
""",
    "missing_licenses": """
SELECT DISTINCT json_extract_string(props, '$.k') AS license FROM events
WHERE license NOT IN ('', '0') AND license NOT IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation)
""",
    "unknown_bucket": """
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 0) GROUP BY 1
""",
    "top_by_score": f"""{BASE}
SELECT id, icp_score FROM contractors ORDER BY icp_score DESC NULLS FIRST, id LIMIT 100
""",
    "top_scored": f"""{BASE}
SELECT id, icp_score FROM contractors ORDER BY icp_score DESC NULLS LAST, id LIMIT 20
""",
    "top_statuses": """
SELECT coalesce(nullif(o_orderpriority, ''), '(empty)') AS status, count(*) AS n FROM orders
GROUP BY 1 ORDER BY n DESC, status LIMIT 20
""",
    "keyset_page": """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey, o_custkey LIMIT 1000
""",
    "contractor_lookup": f"""{BASE}
SELECT id, cslb_license AS "cslbLicense", business_name AS "businessName", phone FROM contractors
WHERE regexp_replace(phone, '[^0-9]', '', 'g') = '2135550010' LIMIT 1
""",
    "company_first_website": f"""{BASE}
SELECT id, business_name AS name, CASE WHEN row_number() OVER (PARTITION BY website ORDER BY icp_score DESC NULLS FIRST, id) = 1
  THEN website END AS website, CASE WHEN icp_tier IN ('A', 'B') THEN 'true' ELSE 'false' END AS ideal FROM contractors
""",
    "person_payloads": f"""{BASE}, h AS (SELECT *, sha256('person:' || id) AS s FROM contractors)
SELECT id, s[1:8] || '-' || s[9:12] || '-4' || s[14:16] || '-'
    || CASE WHEN s[17:17] IN ('0', '4', '8', 'c') THEN '8' WHEN s[17:17] IN ('1', '5', '9', 'd') THEN '9'
            WHEN s[17:17] IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
    || s[18:20] || '-' || s[21:32] AS person_id,
  split_part(owner_name, ' ', 1) AS first_name, split_part(owner_name, ' ', 2) AS last_name,
  'CSLB ' || license_class || ' Contractor' AS job_title, phone FROM h
""",
    "note_targets_missing": """
SELECT DISTINCT l_orderkey AS note_id, l_suppkey AS company_id FROM lineitem a
  WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_linestatus = 'F' AND b.l_orderkey = a.l_orderkey AND b.l_suppkey = a.l_suppkey)
""",
    "opt_out_touches": f"""{BASE}
SELECT c.id AS contractor_id, 'opted_out' AS touch_type, CAST(CAST(min(e.ts) AS DATE) AS VARCHAR) AS at
FROM events e JOIN contractors c
  ON regexp_replace(c.phone, '[^0-9]', '', 'g') = '213555' || lpad(CAST(e.user_id % 10000 AS VARCHAR), 4, '0')
WHERE e.event_type = 'error' AND NOT EXISTS (
  SELECT 1 FROM touches t WHERE t.contractor_id = c.id AND t.touch_type = 'opted_out') GROUP BY 1
""",
    "call_touches": f"""{BASE}, r AS (
  SELECT CASE WHEN event_id % 2 = 1 THEN 'call_answered' WHEN event_id % 4 = 0 THEN 'call_voicemail'
    ELSE 'call_completed' END AS touch_type, CAST(event_id - event_id % 9 AS VARCHAR) AS call_id, event_id, ts FROM events),
once AS (SELECT call_id, touch_type, min((ts, event_id)) AS k, arg_min(event_id, (ts, event_id)) AS d FROM r GROUP BY 1, 2)
SELECT t.contractor_id, call_id AS external_id, o.touch_type, CAST(d AS INTEGER) AS duration_seconds
FROM once o JOIN touches t ON t.external_id = o.call_id AND t.touch_type = 'call_placed'
""",
    "funnel_counts": f"""{BASE}
SELECT sequence_id, count(*) FILTER (WHERE touch_type = 'sms_sent') AS sms_sent,
  count(*) FILTER (WHERE touch_type = 'call_placed') AS call_placed,
  count(*) FILTER (WHERE touch_type = 'opted_out') AS opted_out, count(DISTINCT contractor_id) AS contractors
FROM touches GROUP BY 1
""",
}
