"""Fixed values of the permit domain, and the small lookup frames made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from girder.session import local_rows

# The result classes, inspection types, statuses and categories of the data.
DEFAULT_PASS = (
    "Approved",
    "Approved Pending GreenApproval",
    "Event Approved",
    "Completed",
    "Completed (special insp)",
    "Completed-MF (special insp)",
    "No Violation (special insp)",
    "Conditional Approval",
)
DEFAULT_FAIL = (
    "Corrections Issued",
    "Violation Observed",
    "Order to Comply Issued",
    "OTC Issued",
    "NOV Issued",
    "Not Ready for Inspection",
)
OVERRIDES = {
    "final": {
        "pass": (
            "Permit Finaled",
            "CofO Issued",
            "OK to Issue CofO",
            "OK for CofO",
            "OK for CofC",
            "OK for TCO",
        ),
        "fail": (),
    },
    "gas-shutoff-valve-sgsov": {"pass": ("SGSOV Approved",), "fail": ("SGSOV Not Ready",)},
}
#: slug, tier, raw types
INSPECTION_TYPES = (
    ("final", 1, ("Final",)),
    ("smoke-co-detectors", 1, ("Smoke Detectors",)),
    ("electrical-service", 1, ("Service/Power Release",)),
    ("gas-shutoff-valve-sgsov", 1, ("SGSOV-Seismic Gas S/O Valve",)),
    ("stucco-lath", 2, ("Interior/Exterior Lathing",)),
    ("foundation-footing", 2, ("Footing/Foundation/Slab",)),
    ("shear-wall-seismic", 2, ("Floor/Roof Diaphrgm/Shear Wall",)),
    ("framing-rough", 2, ("Rough", "BUILDING-Rough-Frame", "Wood Frame")),
)
TERMINAL_STATUSES = (
    "Permit Finaled",
    "Permit Expired",
    "Permit Closed",
    "Permit Withdrawn",
    "Permit Revoked",
    "Refund Completed",
    "CofO Issued",
    "CofC Issued",
    "CofO Corrected",
    "CofC Corrected",
)
PROJECT_CATEGORIES = (
    "ADU",
    "JADU",
    "Kitchen",
    "Bathroom",
    "Addition",
    "Ground-Up",
    "Remodel",
    "Tenant-Improvement",
    "Solar",
    "EV-Charger",
    "Pool-Spa",
    "Demolition",
    "Grading",
    "Mechanical",
    "Electrical",
    "Plumbing",
    "Re-Roof",
    "Fire-Sprinkler",
    "Other",
)
SIGNAL_TYPES = (
    "permit_velocity_high",
    "correction_rate_high",
    "license_expiring_soon",
    "adu_active",
    "multi_city_active",
    "digital_presence_low",
    "geographic_concentration",
    "new_permit_issued",
    "inspection_delay_pattern",
    "project_stalled",
    "permit_expiring_soon",
    "high_value_project_started",
    "multiple_corrections_same_trade",
    "inspector_pattern_mismatch",
    "new_city_expansion",
    "seasonal_volume_spike",
    "owner_builder_nearby",
    "serial_developer_relationship",
    "workers_comp_lapsed",
    "bond_amount_changed",
    "new_complaint_filed",
    "violation_on_active_project",
    "final_inspection_approaching",
    "trade_sub_overloaded",
    "new_adu_ordinance_change",
    "competitor_permit_surge",
)
PAIN_ANGLES = (
    "inspection_delays",
    "correction_rate",
    "multi_city_complexity",
    "missed_deadline_risk",
    "trade_coordination",
    "license_compliance",
    "scale_readiness",
    "digital_presence",
)
STOP_WORDS = ("STOP", "STOPALL", "UNSUBSCRIBE", "CANCEL", "END", "QUIT")
PUBLISH_THRESHOLD = 100
WINDOW_MONTHS = 12
# End of the fixed values.

NONDECISIVE = "nondecisive"
ANY_TYPE = "*"


def type_map(spark: SparkSession) -> DataFrame:
    """raw_type, slug, tier: ten rows."""
    rows = [(raw, slug, tier) for slug, tier, raws in INSPECTION_TYPES for raw in raws]
    return local_rows(spark, rows, "raw_type string, slug string, tier int")


def types(spark: SparkSession) -> DataFrame:
    """slug, tier: one row for each type, also those that no inspection has."""
    return local_rows(spark, [(s, t) for s, t, _ in INSPECTION_TYPES], "slug string, tier int")


def result_classes(spark: SparkSession) -> DataFrame:
    """slug (``*``: any), result, cls (pass or fail)."""
    rows = [(ANY_TYPE, r, "pass") for r in DEFAULT_PASS]
    rows += [(ANY_TYPE, r, "fail") for r in DEFAULT_FAIL]
    rows += [(s, r, c) for s, by in OVERRIDES.items() for c, rs in by.items() for r in rs]
    return local_rows(spark, rows, "slug string, result string, cls string")
