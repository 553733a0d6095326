"""Names, addresses, phones, people and replies as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from girder import taxonomy

# The company words that a name is compared without.
COMPANY_WORDS = r"\b(llc|l\.l\.c\.?|inc\.?|corp\.?|corporation|co\.?|ltd\.?|lp|dba|the)\b"


def blank_to_null(x: Column) -> Column:
    """Trimmed; null if nothing is left."""
    return F.nullif(F.trim(x), F.lit(""))


def joined(*parts: Column, by: str = " ") -> Column:
    """Non-blank trimmed parts, joined; null if there is none."""
    return F.nullif(F.concat_ws(by, *[blank_to_null(p) for p in parts]), F.lit(""))


def normalize_name(x: Column) -> Column:
    """Lower case without company words, dots, commas and doubled spaces."""
    bare = F.regexp_replace(F.lower(x), COMPANY_WORDS, "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "[.,]", ""), r"\s+", " "))


def address_key(street: Column, city: Column) -> Column:
    """``street, city`` in lower case; null without a street, no comma without a city."""
    whole = F.lower(F.concat_ws(", ", blank_to_null(street), blank_to_null(city)))
    return F.when(blank_to_null(street).isNotNull(), whole)


def street_of(address: Column) -> Column:
    """What stands before the first comma, else the whole."""
    head = F.trim(F.split(address, ",").getItem(0))
    return F.when(head == "", address).otherwise(head)


def permit_address(start: Column, direction: Column, name: Column, suffix: Column) -> Column:
    return joined(start, direction, name, suffix)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def normalize_phone(x: Column) -> Column:
    """Ten digits; eleven if the first is 1, which goes; else null."""
    d = digits(x)
    long = (F.length(d) == 11) & d.startswith("1")
    return F.when(long, F.substring(d, 2, 10)).when(F.length(d) == 10, d)


def to_e164(x: Column) -> Column:
    return F.concat(F.lit("+1"), normalize_phone(x))


def first_name(x: Column) -> Column:
    """The first word; empty for an empty or missing name."""
    return F.coalesce(F.split(F.trim(x), r"\s+").getItem(0), F.lit(""))


def last_name(x: Column) -> Column:
    """All words but the first."""
    words = F.split(F.trim(x), r"\s+")
    rest = F.array_join(F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), " ")
    return F.coalesce(rest, F.lit(""))


def person_uuid(x: Column) -> Column:
    """A stable version-4 shaped uuid from SHA-256 of ``person:`` and the id."""
    h = F.sha2(F.concat(F.lit("person:"), x), 256)
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex(nibble.bitwiseAND(3).bitwiseOR(8).cast("long")))
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-4"), F.substring(h, 14, 3),
        F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12),
    )


def job_title(license_class: Column) -> Column:
    """Null and empty classes have the plain title."""
    named = F.concat(F.lit("CSLB "), license_class, F.lit(" Contractor"))
    return F.when(F.coalesce(license_class, F.lit("")) != "", named).otherwise(
        F.lit("Licensed Contractor")
    )


def signal_summary(signals: Column) -> Column:
    """``type (value: 0.00)`` lines of an array of (signal_type, signal_value); ``None`` if empty."""
    lines = F.transform(
        signals, lambda s: F.format_string("%s (value: %.2f)", s.signal_type, s.signal_value)
    )
    return F.when(F.coalesce(F.size(signals), F.lit(0)) > 0, F.array_join(lines, "\n")).otherwise(
        F.lit("None")
    )


def percent(part: Column, whole: Column, places: int = 1) -> Column:
    """A percentage as text; ``n/a`` of nothing."""
    shown = F.format_string(f"%.{places}f%%", part / whole * 100)
    return F.when(whole > 0, shown).otherwise(F.lit("n/a"))


def unfenced(reply: Column) -> Column:
    """A reply without the fences around code."""
    head = F.regexp_replace(reply, r"(?m)^```(?:json)?\s*", "")
    return F.trim(F.regexp_replace(head, r"(?m)```\s*$", ""))


def classifier_reply(reply: Column) -> Column:
    """array of (index, category); unknown categories are Other, bad replies null."""
    parsed = F.from_json(unfenced(reply), "array<struct<index:int,category:string>>")
    known = list(taxonomy.PROJECT_CATEGORIES)
    return F.transform(
        parsed,
        lambda x: F.struct(
            x["index"].alias("index"),
            F.when(x.category.isin(known), x.category).otherwise("Other").alias("category"),
        ),
    )


def generator_reply(reply: Column) -> Column:
    """The valid angles of the first JSON array in a reply."""
    body = F.regexp_extract(reply, r"(?s)\[.*\]", 0)
    shape = "array<struct<rank:int,pain_angle:string,hook_line:string,body_text:string,grounding_signals:array<string>>>"  # noqa: E501
    return F.filter(
        F.from_json(body, shape),
        lambda h: h["rank"].isNotNull()
        & h.pain_angle.isin(*taxonomy.PAIN_ANGLES)
        & h.hook_line.isNotNull()
        & h.body_text.isNotNull(),
    )


def is_stop_word(body: Column) -> Column:
    return F.coalesce(F.upper(F.trim(body)).isin(*taxonomy.STOP_WORDS), F.lit(False))


def call_touch_type(kind: Column, status: Column, reason: Column) -> Column:
    """The touch that a call event means; null for events that mean none."""
    ended = (
        F.when(reason == "voicemail", "call_voicemail")
        .when(reason == "customer-did-not-answer", "call_no_answer")
        .otherwise("call_completed")
    )
    answered = (kind == "status-update") & (status == "in-progress")
    return F.when(answered, "call_answered").when(kind == "end-of-call-report", ended)


def null_fields(*names: str) -> Column:
    """Those of the named columns that are null or an empty array, for array columns ``name[]``."""
    marks = []
    for name in names:
        c = F.col(name.removesuffix("[]"))
        empty = c.isNull() | (F.size(c) == 0) if name.endswith("[]") else c.isNull()
        marks.append(F.when(empty, F.lit(name.removesuffix("[]"))))
    return F.filter(F.array(*marks), lambda x: x.isNotNull())
