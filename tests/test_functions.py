"""Scalar functions at their edges."""

import pytest
from pyspark.sql import functions as F

from girder.functions import parse, text


def one(spark, expression, *values, types="string"):
    names = [f"x{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, [types] * len(values) if isinstance(types, str) else types))
    row = spark.createDataFrame([values], schema).select(expression(*[F.col(n) for n in names]).alias("y"))
    return row.collect()[0].y


@pytest.mark.parametrize(
    ("raw", "want"),
    [("The ABC Corp. Builders, Inc.", "abc builders"), ("L.L.C.", ""), ("Coast Co", "coast"), (None, None)],
)
def test_normalize_name(spark, raw, want):
    assert one(spark, text.normalize_name, raw) == want


@pytest.mark.parametrize(
    ("raw", "ten", "e164"),
    [
        ("(213) 555-0100", "2135550100", "+12135550100"),
        ("1-213-555-0100", "2135550100", "+12135550100"),
        ("213555010", None, None),
        ("22135550100", None, None),
        (None, None, None),
    ],
)
def test_phones(spark, raw, ten, e164):
    assert one(spark, text.normalize_phone, raw) == ten
    assert one(spark, text.to_e164, raw) == e164


@pytest.mark.parametrize(
    ("raw", "want"), [("$1,234.56", 1235), ("abc", None), ("12abc", 12), ("1.5", 2), ("", None), (None, None)]
)
def test_dollars(spark, raw, want):
    assert one(spark, parse.parse_dollars, raw) == want


def test_cents_ints_flags(spark):
    assert one(spark, parse.parse_cents, "$15,000.5") == 1500050
    assert one(spark, parse.parse_int, "1,200 sf") == 1200
    assert one(spark, parse.parse_int, "none") is None
    assert [one(spark, parse.parse_flag, x) for x in (" Y ", "yes", "no", None)] == [True, True, False, False]
    assert one(spark, parse.leading_double, "-118.25x") == -118.25


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("2024-01-02T00:00:00", "2024-01-02"),
        ("01/02/2024", "2024-01-02"),
        ("01/02/2024 00:00", "2024 00:00-01-02"),
        (" soon ", "soon"),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, raw, want):
    assert one(spark, parse.parse_date, raw) == want


def test_dates_against_a_day(spark):
    day = F.lit("1998-09-01").cast("date")
    ok = lambda x: one(spark, lambda c: parse.not_before(c, day, 90), x)
    assert [ok(x) for x in (None, "1998-11-30", "11/30/1998", "1998-11-29", "garbage")] == [
        True, True, True, False, False,
    ]
    near = lambda x: one(spark, lambda c: parse.within_days(c, day, 90), x)
    assert [near(x) for x in ("1998-09-01", "1998-11-30", "1998-08-31", None)] == [True, False, False, False]
    months = lambda x: str(one(spark, lambda c: parse.months_before(c.cast("date"), 12), x))
    assert months("2024-02-29") == "2023-03-01" and months("2024-03-31") == "2023-03-31"


def test_status_and_tiers(spark):
    assert [one(spark, parse.license_status, x) for x in ("Active", "inactive", "EXPIRED", "suspended", "?", "")] == [
        "active", "inactive", "expired", "suspended", "inactive", None,
    ]
    assert [one(spark, parse.legacy_license_status, x) for x in ("ACTIVE", "not renewed", None)] == ["active", "inactive", None]
    tiers = lambda f: [one(spark, f, x, types="double") for x in (80.0, 79.999, 60.0, 40.0, 25.0, None)]
    assert tiers(parse.legacy_tier) == ["A", "A", "B", "C", "C", None]
    assert tiers(parse.tier)[:5] == ["A", "B", "B", "C", "D"]


def test_rounding(spark):
    assert one(spark, lambda c: parse.round_half_up(c, 2), 1.005, types="double") == 1.0
    assert one(spark, lambda c: parse.round_half_up(c, 0), -0.5, types="double") == 0.0


def test_names_titles_addresses(spark):
    assert one(spark, text.first_name, "") == "" and one(spark, text.last_name, "Ann B  Lee") == "B Lee"
    assert one(spark, text.job_title, "") == "Licensed Contractor"
    assert one(spark, text.job_title, "B") == "CSLB B Contractor"
    assert one(spark, text.address_key, " 1 Main ", " ") == "1 main"
    assert one(spark, text.address_key, "", "LA") is None
    assert one(spark, text.street_of, "1 Main St, LA") == "1 Main St" and one(spark, text.street_of, ", LA") == ", LA"
    assert one(spark, text.permit_address, "12", None, "MAIN", " ") == "12 MAIN"
    assert one(spark, text.percent, 1, 0, types="int") == "n/a"
    assert one(spark, text.percent, 1, 3, types="int") == "33.3%"


def test_uuid(spark):
    import hashlib

    h = bytearray(hashlib.sha256(b"person:42").digest()[:16])
    h[6], h[8] = h[6] & 0x0F | 0x40, h[8] & 0x3F | 0x80
    want = h.hex()
    got = one(spark, text.person_uuid, "42")
    assert got == f"{want[:8]}-{want[8:12]}-{want[12:16]}-{want[16:20]}-{want[20:]}"


def test_replies(spark):
    fenced = '```json\n[{"index": 1, "category": "Solar"}, {"index": 2, "category": "Zoo"}]\n```'
    assert [(r["index"], r.category) for r in one(spark, text.classifier_reply, fenced)] == [(1, "Solar"), (2, "Other")]
    assert one(spark, text.classifier_reply, "sorry") is None
    angles = 'Here: [{"rank": 1, "pain_angle": "scale_readiness", "hook_line": "h", "body_text": "b"}, {"rank": 2, "pain_angle": "x", "hook_line": "h", "body_text": "b"}]'
    assert [r["rank"] for r in one(spark, text.generator_reply, angles)] == [1]


def test_webhooks(spark):
    assert [one(spark, text.is_stop_word, x) for x in (" stop ", "Stopall", "stop it", None)] == [True, True, False, False]
    touch = lambda *x: one(spark, text.call_touch_type, *x)
    assert touch("status-update", "in-progress", None) == "call_answered"
    assert touch("status-update", "ringing", None) is None
    assert touch("end-of-call-report", None, "voicemail") == "call_voicemail"
    assert touch("end-of-call-report", None, "customer-did-not-answer") == "call_no_answer"
    assert touch("end-of-call-report", None, None) == "call_completed"


def test_maps_and_profiles(spark):
    df = spark.createDataFrame(
        [({"a": 0.31}, [], None), ({"a": 0.3}, ["x"], "v"), (None, None, "v")],
        "m map<string,double>, l array<string>, s string",
    )
    rows = df.select(parse.any_over(F.col("m")).alias("o"), parse.key_count(F.col("m")).alias("k"), text.null_fields("m", "l[]", "s").alias("n")).collect()
    assert [(r.o, r.k, r.n) for r in rows] == [(True, 1, ["l", "s"]), (False, 1, []), (False, 0, ["m", "l"])]
    stamp = df.select(parse.delta_stamp(F.lit("2024-01-02 03:04:05.678").cast("timestamp")).alias("t"))
    assert stamp.first().t == "2024-01-02T03:04:05.000"
