"""Numbers, dates and codes out of dirty text, as Column expressions; bad text gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
INTEGER = r"^\s*([+-]?\d+)"


def leading_double(x: Column) -> Column:
    """The number that the text begins with."""
    return F.regexp_extract(x, NUMBER, 1).try_cast("double")


def round_half_up(x: Column, places: int = 0) -> Column:
    """Half towards plus infinity, by the floor form."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / scale


def parse_flag(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x)).isin("y", "yes", "1", "true"), F.lit(False))


def parse_dollars(x: Column) -> Column:
    """Whole dollars without sign and separators."""
    return F.floor(leading_double(F.regexp_replace(x, r"[$,\s]", "")) + 0.5).cast("long")


def parse_cents(x: Column) -> Column:
    return F.floor(leading_double(F.regexp_replace(x, r"[$,\s]", "")) * 100 + 0.5).cast("long")


def parse_int(x: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(x, ",", ""), INTEGER, 1).try_cast("int")


def parse_date(x: Column) -> Column:
    """ISO text loses its time; MM/DD/YYYY is turned and keeps what follows the year glued to it; any
    other text passes through."""
    t = F.trim(x)
    turned = F.regexp_replace(t, r"^(\d{1,2})/(\d{1,2})/(\d{4}.*)$", r"$3-$1-$2")
    padded = F.regexp_replace(turned, r"^(\d{4}[^-]*)-(\d)-", r"$1-0$2-")
    return (
        F.when(t == "", None)
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(t, 1, 10))
        .when(t.rlike(r"^\d{2}/\d{2}/\d{4}"), padded)
        .otherwise(t)
    )


def turn_date(x: Column) -> Column:
    """Exactly MM/DD/YYYY becomes ISO; all else passes through."""
    return F.regexp_replace(x, r"^(\d{2})/(\d{2})/(\d{4})$", r"$3-$1-$2")


def to_date(x: Column) -> Column:
    """A date of ISO or MM/DD/YYYY text, null if it is neither."""
    return turn_date(F.trim(x)).try_cast("date")


def latest(*xs: Column) -> Column:
    """The latest readable timestamp."""
    return F.greatest(*[x.try_cast("timestamp") for x in xs])


def license_status(x: Column) -> Column:
    """Of a page. ``inactive`` is inactive, though it contains ``active``."""
    t = F.lower(F.trim(x))
    return (
        F.when(x.isNull() | (t == ""), None)
        .when(F.contains(t, F.lit("inactive")), "inactive")
        .when(F.contains(t, F.lit("active")), "active")
        .when(F.contains(t, F.lit("suspended")), "suspended")
        .when(F.contains(t, F.lit("expir")), "expired")
        .otherwise("inactive")
    )


def legacy_license_status(x: Column) -> Column:
    t = F.upper(F.trim(x))
    named = F.when(t.isin("ACTIVE", "SUSPENDED", "EXPIRED"), F.lower(t)).otherwise("inactive")
    return F.when(F.coalesce(t, F.lit("")) != "", named)


def legacy_tier(score: Column) -> Column:
    return (
        F.when(score >= 75, "A").when(score >= 50, "B").when(score >= 25, "C").when(score.isNotNull(), "D")
    )


def tier(score: Column) -> Column:
    """Of the unrounded score."""
    return F.when(score >= 80, "A").when(score >= 60, "B").when(score >= 40, "C").otherwise("D")


def not_before(x: Column, as_of: Column, days: int) -> Column:
    """Whether a date text lies ``days`` after as_of or later: null text is fine, bad text isn't."""
    later = F.coalesce(to_date(x) >= F.date_add(as_of, days), F.lit(False))
    return x.isNull() | later


def within_days(x: Column, as_of: Column, days: int) -> Column:
    """Whether a date text lies in [as_of, as_of + days)."""
    d = to_date(x)
    return F.coalesce((d >= as_of) & (d < F.date_add(as_of, days)), F.lit(False))


def before_day(x: Column, as_of: Column) -> Column:
    return F.coalesce(to_date(x) < as_of, F.lit(False))


def months_before(as_of: Column, months: int) -> Column:
    """The same day some months ago; a day that month lacks runs over into the next."""
    back = F.add_months(F.trunc(as_of, "month"), -months)
    return F.date_add(back, F.dayofmonth(as_of) - 1)


def any_over(values: Column, limit: float = 0.3) -> Column:
    """Whether a map has a value over the limit."""
    return F.coalesce(F.exists(F.map_values(values), lambda v: v > limit), F.lit(False))


def key_count(m: Column) -> Column:
    """Keys of a map; null has none."""
    return F.coalesce(F.size(F.map_keys(m)), F.lit(0))


def hours_since(ts: Column, now: Column) -> Column:
    return round_half_up((F.unix_timestamp(now) - F.unix_timestamp(ts)) / 3600.0).cast("long")


def status_icon(status: Column) -> Column:
    return F.when(status == "idle", "ok").when(status == "running", "..").when(status == "error", "!!").otherwise("??")


def delta_stamp(ts: Column) -> Column:
    """The form of a delta cursor: no zone, milliseconds zero."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000"))


def json_or_null(x: Column) -> Column:
    """JSON text as it is; null if it can't be read."""
    return F.when(F.try_parse_json(x).isNotNull(), x)
