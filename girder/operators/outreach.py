"""Audiences, touches from webhooks, and the payloads of the contact system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.functions import text
from girder.operators.upsert import keep_first


def first_angles(hypotheses: DataFrame) -> DataFrame:
    return hypotheses.filter("rank = 1")


def without_touch(rows: DataFrame, touches: DataFrame, kinds: tuple[str, ...], key: str = "id") -> DataFrame:
    """rows whose contractor has no touch of the kinds."""
    had = touches.filter(F.col("touch_type").isin(*kinds)).select(F.col("contractor_id").alias(key))
    return rows.join(had, key, "left_anti")


def audience(
    contractors: DataFrame,
    hypotheses: DataFrame,
    touches: DataFrame,
    tiers: tuple[str, ...],
    done: str,
    exclude_opted_out: bool = True,
    after: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Contractors with a phone and a first angle in the tiers, not touched yet, by id.

    SMS: tiers A and B, done ``sms_sent``. Voice: tier A, done ``call_placed``; the original voice
    audience keeps opted-out contractors (``exclude_opted_out=False``).
    """
    rows = contractors.filter(F.col("phone").isNotNull() & F.col("icp_tier").isin(*tiers))
    if after is not None:
        rows = rows.filter(F.col("id") > F.lit(after))
    out = without_touch(rows, touches, (done, "opted_out") if exclude_opted_out else (done,))
    angles = first_angles(hypotheses).select(
        F.col("contractor_id").alias("id"), F.col("id").alias("hypothesis_id"), "hook_line", "body_text"
    )
    found = out.join(angles, "id").orderBy("id")
    return found if limit is None else found.limit(limit)


def would_send(audience_rows: DataFrame, channel: str) -> DataFrame:
    """The dry run: what would be delivered, to whom."""
    return audience_rows.select(
        F.col("id").alias("contractor_id"),
        "hypothesis_id",
        F.lit(channel).alias("channel"),
        text.to_e164(F.col("phone")).alias("to"),
        text.joined(F.col("hook_line"), F.col("body_text"), by="\n").alias("message"),
    ).filter("to IS NOT NULL")


def pending(contractors: DataFrame, hypotheses: DataFrame, tiers: tuple[str, ...] = ("A", "B")) -> DataFrame:
    """Contractors of the tiers without any angle."""
    have = hypotheses.select(F.col("contractor_id").alias("id"))
    return contractors.filter(F.col("icp_tier").isin(*tiers)).join(have, "id", "left_anti")


def with_signals(contractors: DataFrame, signals: DataFrame) -> DataFrame:
    """Contractors with an array of their active signals, empty if none."""
    lists = (
        signals.filter("is_active")
        .groupBy(F.col("contractor_id").alias("id"))
        .agg(F.sort_array(F.collect_list(F.struct("signal_type", "signal_value"))).alias("signals"))
    )
    none = F.array().cast("array<struct<signal_type:string,signal_value:double>>")
    return contractors.join(lists, "id", "left").withColumn("signals", F.coalesce("signals", none))


def opt_outs(messages: DataFrame, contractors: DataFrame, touches: DataFrame) -> DataFrame:
    """New opted_out touches: stop words from a known phone that hasn't opted out; one a contractor.

    messages: sender, body, occurred_at.
    """
    stops = messages.filter(text.is_stop_word(F.col("body"))).select(
        text.normalize_phone(F.col("sender")).alias("_phone"), "occurred_at"
    )
    known = contractors.select(
        F.col("id").alias("contractor_id"), text.normalize_phone(F.col("phone")).alias("_own")
    )
    hit = stops.join(known, F.col("_phone") == F.col("_own"))
    had = touches.filter("touch_type = 'opted_out'").select("contractor_id")
    new = hit.join(had, "contractor_id", "left_anti")
    return new.groupBy("contractor_id").agg(F.min("occurred_at").alias("occurred_at")).select(
        "contractor_id", F.lit("sms").alias("channel"), F.lit("inbound").alias("direction"),
        F.lit("opted_out").alias("touch_type"), "occurred_at",
    )


def call_touches(events: DataFrame, touches: DataFrame) -> DataFrame:
    """New touches of call events: the call must be known, and each (call, type) counts once.

    events: type, status, ended_reason, call_id, duration_seconds, occurred_at.
    """
    kind = text.call_touch_type(F.col("type"), F.col("status"), F.col("ended_reason"))
    new = events.withColumn("touch_type", kind).filter("touch_type IS NOT NULL AND call_id IS NOT NULL")
    once = new.groupBy("call_id", "touch_type").agg(
        F.min(F.struct("occurred_at", "duration_seconds")).alias("e")
    )
    placed = (
        touches.filter("touch_type = 'call_placed'")
        .groupBy(F.col("external_id").alias("call_id"))
        .agg(F.min(F.struct("contractor_id", "hypothesis_id", "sequence_id")).alias("o"))
    )
    seen = touches.select(F.col("external_id").alias("call_id"), "touch_type")
    return once.join(placed, "call_id").join(seen, ["call_id", "touch_type"], "left_anti").select(
        "o.*", F.lit("voice").alias("channel"), F.lit("inbound").alias("direction"), "touch_type",
        F.col("call_id").alias("external_id"), "e.duration_seconds", "e.occurred_at",
    )


def company_payloads(contractors: DataFrame) -> DataFrame:
    """id, payload (JSON): a website goes to the first of its contractors by score."""
    first = keep_first(contractors, "website", F.col("icp_score").desc_nulls_first(), F.col("id"))
    empty = lambda c, d="": F.coalesce(F.col(c), F.lit(d))
    payload = F.to_json(
        F.struct(
            "id",
            F.col("business_name").alias("name"),
            F.struct(
                empty("address_street").alias("addressStreet1"),
                empty("address_city").alias("addressCity"),
                empty("address_state", "CA").alias("addressState"),
                empty("address_zip").alias("addressPostcode"),
            ).alias("address"),
            F.coalesce(F.col("icp_tier").isin("A", "B"), F.lit(False)).alias("idealCustomerProfile"),
            F.when(
                F.col("is_first"),
                F.struct(
                    F.col("website").alias("primaryLinkUrl"),
                    F.col("business_name").alias("primaryLinkLabel"),
                ),
            ).alias("domainName"),
        )
    )
    return first.select("id", payload.alias("payload"))


def person_payloads(contractors: DataFrame) -> DataFrame:
    present = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    payload = F.to_json(
        F.struct(
            text.person_uuid(F.col("id")).alias("id"),
            F.col("id").alias("companyId"),
            F.struct(
                text.first_name(F.col("owner_name")).alias("firstName"),
                text.last_name(F.col("owner_name")).alias("lastName"),
            ).alias("name"),
            text.job_title(F.col("license_class")).alias("jobTitle"),
            F.when(present("email"), F.struct(F.col("email").alias("primaryEmail"))).alias("emails"),
            F.when(
                present("phone"),
                F.struct(
                    F.col("phone").alias("primaryPhoneNumber"),
                    F.lit("US").alias("primaryPhoneCountryCode"),
                    F.lit("+1").alias("primaryPhoneCallingCode"),
                ),
            ).alias("phones"),
        )
    )
    return contractors.select("id", payload.alias("payload"))


def note_payloads(hypotheses: DataFrame) -> DataFrame:
    """id, payload (JSON): a hypothesis as a note, its body as markdown and as one paragraph block."""
    text_of = F.struct(F.lit("text").alias("type"), F.col("body_text").alias("text"))
    block = F.struct(F.lit("paragraph").alias("type"), F.array(text_of).alias("content"))
    body = F.struct(F.col("body_text").alias("markdown"), F.to_json(F.array(block)).alias("blocknote"))
    payload = F.to_json(F.struct("id", F.col("hook_line").alias("title"), body.alias("bodyV2")))
    return hypotheses.select("id", payload.alias("payload"))


def missing_targets(notes: DataFrame, existing: DataFrame) -> DataFrame:
    """(note_id, company_id) pairs that the remote side lacks."""
    return notes.select("note_id", "company_id").join(existing, ["note_id", "company_id"], "left_anti")


def funnel(touches: DataFrame) -> DataFrame:
    """Touches of each sequence by kind."""
    kinds = ("sms_sent", "opted_out", "call_placed", "call_answered", "call_voicemail", "call_completed")
    return touches.groupBy("sequence_id").agg(
        *[F.count_if(F.col("touch_type") == k).alias(k) for k in kinds],
        F.countDistinct("contractor_id").alias("contractors"),
    )


def lookup(contractors: DataFrame, license: str | None = None, phone: str | None = None) -> DataFrame:
    """One contractor by license or phone, with the names of the API."""
    fields = (
        "id", "cslb_license", "business_name", "owner_name", "phone", "email", "website",
        "address_street", "address_city", "address_state", "address_zip", "license_class",
        "icp_score", "icp_tier", "has_active_license", "permit_count_active", "permit_count_total",
    )
    if (license is None) == (phone is None):
        raise ValueError("give a license or a phone")
    hit: Column = F.col("cslb_license") == license
    if license is None:
        hit = text.normalize_phone(F.col("phone")) == text.normalize_phone(F.lit(phone))
    return api_names(contractors.filter(hit).select(*[c for c in fields if c in contractors.columns]).limit(1))


def api_names(rows: DataFrame) -> DataFrame:
    """snake_case columns in camelCase."""
    camel = lambda c: c.split("_")[0] + "".join(p.title() for p in c.split("_")[1:])
    return rows.withColumnsRenamed({c: camel(c) for c in rows.columns})
