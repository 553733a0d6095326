"""Domain frames with the edge cases of each operator."""

import datetime as dt

from pyspark.sql import functions as F

from girder import taxonomy
from girder.operators import external, inspections, linking, outreach, reports, scoring, upsert


def rates(spark, rows, threshold=2):
    df = spark.createDataFrame(
        rows, "permit_ref string, inspection_type string, inspection_date string, result string, id string"
    )
    found = inspections.first_time_pass_rate(
        df, taxonomy.type_map(spark), taxonomy.result_classes(spark), taxonomy.types(spark),
        "2024-01-01", "2024-12-31", threshold,
    )
    return {r.slug: r for r in found.collect()}


def test_first_attempts_and_classes(spark):
    got = rates(
        spark,
        [
            ("1", "Final", "2023-12-31", "Corrections Issued", "a"),  # before the window
            ("1", "Final", "2024-02-01", "Permit Finaled", "b"),
            ("2", "Final", "2024-02-01", "Permit Finaled", "c"),
            ("3", "Final", "2024-02-01", " Approved ", "d"),
            ("4", "Rough", "2024-03-02", "Approved", "e"),
            ("4", "Wood Frame", "2024-03-01", "Permit Finaled", "f"),
            ("4", "BUILDING-Rough-Frame", "2024-03-03", "Approved", "g"),
            ("5", "SGSOV-Seismic Gas S/O Valve", "2024-01-01", "SGSOV Not Ready", "h"),
            ("6", "SGSOV-Seismic Gas S/O Valve", "2024-12-31", "Not Ready for Inspection", "i"),
            ("7", "Final", "2024-05-05", None, "j"),
            ("8", "Final", "bad", "Approved", "k"),
            ("9", "Elevator", "2024-05-05", "Approved", "l"),
        ],
    )
    assert set(got) == {s for s, _, _ in taxonomy.INSPECTION_TYPES}
    final = got["final"]
    assert (final.passed, final.failed, final.nondecisive, final.cohort) == (2, 0, 1, 3)
    assert (final.published, final.pass_rate, final.fail_rate) == (True, 1.0, 0.0)
    assert (got["framing-rough"].cohort, got["framing-rough"].nondecisive) == (1, 1)
    gas = got["gas-shutoff-valve-sgsov"]
    assert (gas.failed, gas.pass_rate, gas.fail_rate) == (2, 0.0, 1.0)
    assert got["stucco-lath"].cohort == 0 and got["stucco-lath"].pass_rate is None


def test_threshold(spark):
    rows = [(str(i), "Final", "2024-02-01", "Approved" if i % 3 else "NOV Issued", str(i)) for i in range(100)]
    assert rates(spark, rows[:99], 100)["final"].pass_rate is None
    full = rates(spark, rows, 100)["final"]
    assert full.published and full.pass_rate == 0.66 and full.fail_rate == 0.34


def test_two_forms_of_first_attempt(spark):
    rows = [(k, d, i) for k in "ab" for d, i in (("2", 1), (None, 0), ("1", 9), ("1", 3))]
    df = spark.createDataFrame(rows, "k string, d string, i int")
    forms = [f(df, ["k"], ["d", "i"]) for f in (inspections.first_attempts, inspections.first_attempts_by_min)]
    assert [sorted((r.k, r.d, r.i) for r in f.collect()) for f in forms] == [[("a", "1", 3), ("b", "1", 3)]] * 2


def contractors(spark):
    return spark.createDataFrame(
        [
            ("c1", "100", "Ace Builders Inc", "1 Main St", "LA"),
            ("c2", "200", "Best Roofing LLC", "2 Oak St", "LA"),
            ("c3", "300", "Best Roofing and More", "2 Oak St", "LA"),
            ("c4", "0", "Unknown", None, None),
        ],
        "id string, cslb_license string, business_name string, address_street string, address_city string",
    )


def test_link_cascade(spark):
    permits = spark.createDataFrame(
        [
            ("p1", '{"license":" 100 ","contractor_city":"LA"}', "2 OAK ST", "Best Roofing", None),
            ("p2", '{"license":"","contractor_city":"LA"}', "2 oak st", "Ace Builders", None),
            ("p3", '{"license":"999"}', None, "ACE Builders, Inc.", None),
            ("p4", "{}", None, "Best Roofing", None),  # two contractors
            ("p5", "{}", None, "Ace", None),  # too short
            ("p6", '{"license":"0"}', None, None, None),
            ("p7", '{"license":"100"}', None, None, "c9"),
            ("p8", None, None, None, None),
        ],
        "id string, raw_source string, contractor_address string, contractor_name string, contractor_id string",
    )
    got = {r.id: (r.contractor_id, r.match_pass) for r in linking.link(permits, contractors(spark)).collect()}
    assert got == {
        "p1": ("c1", "license"),
        "p2": ("c3", "address"),
        "p3": ("c1", "name"),
        "p4": (None, None),
        "p5": (None, None),
        "p6": ("c4", "license"),
        "p7": ("c9", "linked"),
        "p8": (None, None),
    }


def most_rows(plan):
    """Rows of the node of an executed plan that made most."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return most_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return most_rows(plan.plan())
    own = plan.metrics().get("numOutputRows")
    children = plan.children()
    below = [most_rows(children.apply(i)) for i in range(children.size())]
    return max([own.get().value() if own.isDefined() else 0, *below])


def test_names_that_are_alike_meet_only_what_contains_them(spark):
    rows = [(str(i), f"The {i * 7919 % 4096:012b} Builders") for i in range(1500)]
    rows += [("a", rows[0][1]), ("b", "xx " + rows[1][1]), ("c", None)]  # two others that hold a name
    hay = spark.createDataFrame(rows, "k string, t string")
    needles = [t.split()[1] for _, t in rows[:1500]] + ["rs", "no such"]
    names = spark.createDataFrame([(n,) for n in needles], "n string")
    df = linking.unique_containing(names, "n", hay, "t", "k")
    got = {r.n: r.k for r in df.collect()}
    assert got == {n: str(i) for i, n in enumerate(needles[:1500]) if i > 1}
    assert most_rows(df._jdf.queryExecution().executedPlan()) < 100_000


def test_link_of_repeated_permits(spark):
    rows = [("p1", "{}", "2 oak st, LA", "none such", None), ("p2", "{}", None, "ACE Builders", None)]
    permits = spark.createDataFrame(
        rows * 2,
        "id string, raw_source string, contractor_address string, contractor_name string, contractor_id string",
    )
    got = sorted((r.id, r.contractor_id) for r in linking.link(permits, contractors(spark)).collect())
    assert got == [("p1", "c3"), ("p1", "c3"), ("p2", "c1"), ("p2", "c1")]


def test_containing_equals_a_nested_loop(spark):
    texts = ["Ab", "abc", "xabcx", "bca", "", None, "abcabc", "ABCD"]
    hay = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    needles = ("abc", "bcab", "xab", "zzz")
    names = spark.createDataFrame([(n,) for n in needles], "n string")
    got = {(r.n, r.k) for r in linking.containing(names, "n", hay, "t", "k").collect()}
    assert got == {(n, k) for n in needles for k, t in enumerate(texts) if t is not None and n in t.lower()}


def test_counters_and_rates(spark):
    permits = spark.createDataFrame(
        [("P-1", "c1", "LA", "Issued"), ("P-2", "c1", "LA", "Permit Closed"), ("P-3", "c1", None, None), ("P-4", "c2", None, "Issued"), ("P-5", None, "LA", "Issued")],
        "permit_number string, contractor_id string, city string, status string",
    )
    got = {r.contractor_id: r for r in linking.counters(permits).collect()}
    assert (got["c1"].permit_count_active, got["c1"].permit_count_by_city) == (1, {"LA": 2})
    assert (got["c2"].permit_count_active, got["c2"].permit_count_by_city) == (1, {})
    inspected = spark.createDataFrame(
        [("P 1", "Approved"), ("P 1", "Approved "), ("P 2", "Approved"), ("P 9", "Approved")], "permit_ref string, inspection_result string"
    )
    rate = {r.contractor_id: r.inspection_pass_rate for r in linking.two_stage_pass_rate(inspected, permits).collect()}
    assert set(rate) == {"c1"} and abs(rate["c1"] - 2 / 3) < 1e-12


SCORED = "id string, permit_count_active int, inspection_pass_rate double, correction_rate_by_trade map<string,double>, avg_days_between_inspections double, has_active_license boolean, years_in_business int, license_expiry string, worker_comp_expiry string, website string, google_rating double, review_count int, social_links string, permit_count_by_city map<string,int>"  # noqa: E501


def test_scores_and_signals(spark):
    rows = spark.createDataFrame(
        [
            ("full", 3, 0.5, {"roof": 0.4}, 15.0, True, 40, None, "2030-01-01", "w", 5.0, 20, "{}", {"a": 1, "b": 2, "c": 1, "d": 1}),
            ("none", None, None, None, None, None, None, "garbage", "01/01/1990", None, None, None, None, None),
        ],
        SCORED,
    )
    permits = spark.createDataFrame([("full", 30_000_000, True)] * 6, "contractor_id string, valuation_usd long, adu_flag boolean")
    scored = scoring.scores(rows, permits, "2024-01-01")
    got = {r.id: r for r in scored.collect()}
    full, none = got["full"], got["none"]
    assert (full.dim_permit_activity, full.dim_pain, full.dim_maturity) == (40 + 6 / 50 * 40 + 20, 70.0, 100.0)
    assert (full.dim_adu_focus, full.dim_digital, full.dim_reach) == (100.0, 100.0, 100.0)
    assert full.total_valuation_cents == scoring.VALUATION_CAP and full.avg_valuation_cents == scoring.VALUATION_CAP
    assert full.icp_score == 83.7 and full.icp_tier == "A"
    assert (none.dim_pain, none.dim_maturity, none.icp_score, none.icp_tier) == (50.0, 0.0, 12.5, "D")
    assert none.avg_valuation_cents == 0
    sig = {(r.contractor_id, r.signal_type): r for r in scoring.signals(scored, "2024-01-01").collect()}
    assert len(sig) == 12
    assert sig["none", "workers_comp_lapsed"].is_active and not sig["none", "license_expiring_soon"].is_active
    assert sig["full", "multi_city_active"].signal_value == 0.4
    assert sig["full", "digital_presence_low"].detected_at is None
    check = scoring.drift(scored.select("id", (F.col("icp_score") + 0.6).alias("icp_score")), scored)
    assert {r.verdict for r in check.collect()} == {"drift"}


def test_upsert_policies(spark):
    base = spark.createDataFrame(
        [("p1", "old", "Solar", "c1"), ("p2", "old", None, None)],
        "permit_number string, status string, project_category_ai string, contractor_id string",
    )
    delta = spark.createDataFrame(
        [("p1", "x", None, None, 1), ("p1", None, None, None, 2), ("p2", "new", "Pool-Spa", "c2", 1), ("p3", "new", "ADU", None, 1)],
        "permit_number string, status string, project_category_ai string, contractor_id string, seq int",
    )
    once = upsert.upsert(base, delta, upsert.PERMITS, "seq")
    want = {("p1", None, "Solar", "c1"), ("p2", "new", None, None), ("p3", "new", "ADU", None)}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in upsert.upsert(once, delta, upsert.PERMITS, "seq").collect()} == want


def test_inactive_signal_keeps_its_date(spark):
    schema = "contractor_id string, signal_type string, signal_value double, is_active boolean, detected_at string"
    base = spark.createDataFrame([("c", "a", 1.0, True, "old"), ("c", "b", 1.0, True, "old")], schema)
    delta = spark.createDataFrame([("c", "a", 0.0, False, None), ("c", "b", 0.5, True, "new"), ("d", "a", 0.0, False, None)], schema)
    got = {(r.contractor_id, r.signal_type): r.detected_at for r in upsert.upsert(base, delta, upsert.SIGNALS).collect()}
    assert got == {("c", "a"): "old", ("c", "b"): "new", ("d", "a"): None}


def test_table_versions(spark, tmp_path):
    table = upsert.Table(spark, f"file://{tmp_path}/t")
    assert table.read() is None
    table.replace(spark.range(3).toDF("x"))
    table.replace(table.read().filter("x > 0"))
    assert sorted(r.x for r in table.read().collect()) == [1, 2]


def test_opt_outs_and_calls(spark):
    people = spark.createDataFrame([("c1", "(213) 555-0100"), ("c2", "2135550101")], "id string, phone string")
    now = dt.datetime(2024, 1, 1)
    touches = spark.createDataFrame(
        [("c2", None, None, "opted_out", "x"), ("c1", "h", "s", "call_placed", "call"), ("c1", "h", "s", "call_answered", "call")],
        "contractor_id string, hypothesis_id string, sequence_id string, touch_type string, external_id string",
    )
    said = spark.createDataFrame(
        [("+12135550100", "stop", now), ("+12135550100", " STOP ", now), ("+12135550101", "stop", now), ("+12135550199", "stop", now), ("+12135550100", "yes", now)],
        "sender string, body string, occurred_at timestamp",
    )
    assert [r.contractor_id for r in outreach.opt_outs(said, people, touches).collect()] == ["c1"]
    events = spark.createDataFrame(
        [("end-of-call-report", None, "voicemail", "call", 3, now)] * 2
        + [("status-update", "in-progress", None, "call", 1, now), ("end-of-call-report", None, None, "other", 1, now), ("speech", None, None, "call", 1, now)],
        "type string, status string, ended_reason string, call_id string, duration_seconds int, occurred_at timestamp",
    )
    got = outreach.call_touches(events, touches).collect()
    assert [(r.contractor_id, r.touch_type, r.duration_seconds) for r in got] == [("c1", "call_voicemail", 3)]


def test_audience_leaves_out_opted_out(spark):
    people = spark.createDataFrame(
        [("c1", "1", "A"), ("c2", "1", "B"), ("c3", None, "A"), ("c4", "1", "C"), ("c5", "1", "A"), ("c6", "1", "A")], "id string, phone string, icp_tier string"
    )
    angles = spark.createDataFrame(
        [(f"h{k}{r}", f"c{k}", r, "hook", "body") for k in range(1, 6) for r in (1, 2)], "id string, contractor_id string, rank int, hook_line string, body_text string"
    )
    touches = spark.createDataFrame([("c2", "opted_out"), ("c5", "sms_sent")], "contractor_id string, touch_type string")
    got = outreach.audience(people, angles, touches, ("A", "B"), "sms_sent").collect()
    assert [r.id for r in got] == ["c1"]
    voice = outreach.audience(people, angles, touches, ("A", "B"), "call_placed", exclude_opted_out=False)
    assert [r.id for r in voice.collect()] == ["c1", "c2", "c5"]


def test_classifier_callable_and_failures(spark):
    permits = spark.createDataFrame(
        [("p1", "solar roof", None, False), ("p2", "x", "Pool-Spa", True), ("p3", None, None, False)],
        "id string, work_description string, project_category_ai string, adu_flag boolean",
    ).coalesce(1)
    named = lambda f: {r.id: (r.project_category_ai, r.adu_flag) for r in external.classify(permits, f).collect()}
    assert named(None) == {"p1": ("Solar", False), "p2": ("Pool-Spa", True), "p3": (None, False)}
    assert named(lambda xs: ["JADU" for _ in xs])["p1"] == ("JADU", True)
    assert named(lambda xs: ["Zoo" for _ in xs])["p1"] == ("Other", False)
    assert named(lambda xs: 1 / 0)["p1"] == (None, False)


def test_shares_and_sensitivity(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), ("a", "(null)"), ("b", "x")], "slug string, r string")
    counted = reports.distribution(rows, "slug", "r")
    assert sorted((r.slug, r.label, r.n) for r in counted.collect()) == [("a", "(null)", 1), ("a", "(null)", 1), ("a", "x", 1), ("b", "x", 1)]
    assert {r.total for r in reports.with_shares(counted).collect()} == {4}


def test_contractors_that_share_a_license_link_a_permit_once(spark):
    permits = spark.createDataFrame([("p1", '{"license": " 77 "}'), ("p2", '{"license": "8"}')], "id string, raw_source string")
    people = spark.createDataFrame([("b", "77"), ("a", "77"), ("c", "9")], "id string, cslb_license string")
    assert [tuple(r) for r in linking.by_license(permits, people).collect()] == [("p1", "a")]


def test_failing_classifier_is_counted(spark):
    rows = spark.createDataFrame([(1, "adu", None, False), (2, "pool", None, False)], "id int, work_description string, project_category_ai string, adu_flag boolean")
    failures = spark.sparkContext.accumulator(0)

    def broken(texts):
        raise ConnectionError

    got = external.classify(rows.coalesce(1), broken, failures).collect()
    assert [r.project_category_ai for r in got] == [None, None] and failures.value == 2


def test_nearest_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [3.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = reports.cosine_topk(df.filter("vec_id IN (1, 3, 5, 6)"), df, 2).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.similarity) for r in got) == [
        (1, 1, 2, 1.0), (1, 2, 8, 1.0), (3, 1, 1, 0.0), (3, 2, 2, 0.0)
    ]
    assert reports.cosine_topk(df.limit(0), df, 2).collect() == []
