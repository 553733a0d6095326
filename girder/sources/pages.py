"""License pages: HTML text to columns by regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.functions import parse, text

TAG = r"<[^>]*>"


def plain(html: Column) -> Column:
    """Text of HTML without tags; the common entities are turned back."""
    bare = F.regexp_replace(html, TAG, "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return bare


def cell(html: Column, *fragments: str) -> Column:
    """Inner HTML of the first table cell or block whose id has a fragment; the next fragment if empty."""
    found = [
        F.nullif(F.trim(F.regexp_extract(html, rf'(?is)<(\w+)[^>]*\bid="[^"]*{f}[^"]*"[^>]*>(.*?)</\1>', 2)), F.lit(""))
        for f in fragments
    ]
    return F.coalesce(*found)


def by_id(html: Column, *fragments: str) -> Column:
    """Trimmed text of such a cell; null if none has any."""
    return F.coalesce(*[text.blank_to_null(plain(cell(html, f))) for f in fragments])


def parse_license_pages(pages: DataFrame) -> DataFrame:
    """Typed license rows of detail pages; search forms and other pages are dropped.

    pages: license, html.
    """
    html = F.col("html")
    body = F.lower(plain(html))
    search = (
        F.contains(html, F.lit('name="ctl00$MainContent$LicNo"'))
        | F.contains(body, F.lit("enter the contractor license number to check"))
        | F.contains(body, F.lit("type only the first 10 to 15 letters"))
    )
    detail = F.contains(body, F.lit("license detail for license")) | html.rlike(
        r'(?is)id="MainContent_Header2Detail"|<h1[^>]*>[^<]*license detail'
    )
    lines = F.filter(
        F.transform(F.split(cell(html, "MainContent_BusInfo"), r"(?i)<br\s*/?>"), lambda x: F.trim(plain(x))),
        lambda x: x != "",
    )
    city_line = F.get("_lines", F.lit(2))
    pattern = r"^(.+),\s*([A-Z]{2})\s*(\d{5}(?:-\d{4})?)"
    phone_line = F.get(
        F.filter("_lines", lambda x: F.contains(F.lower(x), F.lit("business phone number"))), F.lit(0)
    )
    said = F.lower(plain(cell(html, "MainContent_Status")))
    status = (
        F.when(F.contains(said, F.lit("current and active")), "active")
        .when(F.contains(said, F.lit("not current")), "inactive")
        .when(F.contains(said, F.lit("suspended")), "suspended")
        .when(F.contains(said, F.lit("expired")), "expired")
        .when(F.contains(body, F.lit("current and active")), "active")
        .when(F.contains(body, F.lit("not current")), "inactive")
        .when(F.contains(body, F.lit("suspended")), "suspended")
    )
    link = lambda c: text.blank_to_null(plain(F.regexp_extract(c, r"(?is)<a\b[^>]*>(.*?)</a>", 1)))
    bonds, comp = cell(html, "MainContent_BondingCellTable"), cell(html, "MainContent_WCStatus")
    bond = F.regexp_extract(bonds, r"(?is)<strong>\s*Bond Amount:\s*</strong>([^<]*)", 1)
    rows = pages.filter(~search & detail).withColumns({"_lines": lines, "_status": status})
    matched = city_line.rlike(pattern)
    return rows.select(
        F.col("license").alias("cslb_license"),
        F.get("_lines", F.lit(0)).alias("business_name"),
        text.normalize_phone(F.regexp_replace(phone_line, r"(?i)Business Phone Number[:\s]*", "")).alias("phone"),
        F.get("_lines", F.lit(1)).alias("address_street"),
        F.when(matched, F.trim(F.regexp_extract(city_line, pattern, 1))).otherwise(city_line).alias("address_city"),
        F.lit("CA").alias("address_state"),
        F.when(matched, F.regexp_extract(city_line, pattern, 3)).alias("address_zip"),
        by_id(html, "Entity").alias("entity_type"),
        link(cell(html, "MainContent_ClassCellTable")).alias("license_class"),
        parse.license_status(F.col("_status")).alias("license_status"),
        by_id(html, "ExpDt").alias("license_expiry"),
        parse.parse_cents(F.nullif(F.trim(bond), F.lit(""))).alias("bond_amount_cents"),
        link(comp).alias("worker_comp_insurer"),
        F.nullif(F.regexp_extract(comp, r"(?i)<strong>Expire Date:</strong>\s*(\d{2}/\d{2}/\d{4})", 1), F.lit("")).alias("worker_comp_expiry"),
        (F.coalesce(parse.license_status(F.col("_status")), F.lit("")) == "active").alias("has_active_license"),
    )


def title(html: Column) -> Column:
    return text.blank_to_null(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))
