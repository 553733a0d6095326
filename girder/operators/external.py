"""Functions that a model would serve, with a deterministic stand-in for each.

A callable for batches may replace either; it runs by Arrow batches. Failures leave rows unclassified, as an
unreachable model would, and are counted in an accumulator, so that a fault doesn't pass for silence.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder import taxonomy
from girder.functions import text

#: The first fitting pattern names the category.
KEYWORDS = (
    ("JADU", r"\b(jadu|junior adu|junior accessory)\b"),
    ("ADU", r"\b(adu|accessory dwelling|granny flat)\b"),
    ("Fire-Sprinkler", r"\b(sprinklers?|fire suppression)\b"),
    ("Solar", r"\b(solar|photovoltaic|pv system)\b"),
    ("EV-Charger", r"\b(ev charg\w*|electric vehicle)\b"),
    ("Pool-Spa", r"\b(pool|spa|jacuzzi)\b"),
    ("Demolition", r"\b(demo|demolish|demolition)\b"),
    ("Grading", r"\b(grading|earthwork|excavation)\b"),
    ("Re-Roof", r"\b(re-?roof\w*|roofing|shingles?)\b"),
    ("Kitchen", r"\bkitchen\b"),
    ("Bathroom", r"\b(bath|bathroom|shower)\b"),
    ("Tenant-Improvement", r"\b(tenant improvement|build-?out|t\.i\.)"),
    ("Ground-Up", r"\b(ground-?up|new (construction|building|dwelling|sfd))\b"),
    ("Addition", r"\b(addition|add \d+|square foot\w*)\b"),
    ("Mechanical", r"\b(hvac|furnace|air condition\w*|duct\w*)\b"),
    ("Electrical", r"\b(electrical|panel|wiring|rewire)\b"),
    ("Plumbing", r"\b(plumbing|water heater|sewer|repipe)\b"),
    ("Remodel", r"\b(remodel|renovat\w*|interior)\b"),
)
ANGLES = {
    "permit_velocity_high": "scale_readiness",
    "digital_presence_low": "digital_presence",
    "adu_active": "trade_coordination",
    "multi_city_active": "multi_city_complexity",
    "license_expiring_soon": "license_compliance",
    "workers_comp_lapsed": "license_compliance",
}


def category(description: Column) -> Column:
    """The category that the keywords tell; Other if none does."""
    low = F.lower(F.coalesce(description, F.lit("")))
    out = None
    for name, pattern in KEYWORDS:
        out = F.when(low.rlike(pattern), name) if out is None else out.when(low.rlike(pattern), name)
    return out.otherwise("Other")


def classify(
    permits: DataFrame,
    classifier: Callable[[list[str]], list[str | None]] | None = None,
    failures: Accumulator | None = None,
) -> DataFrame:
    """permits with a category where one was missing and a description is there, and its ADU flag.

    failures: counts the rows of batches that the classifier failed on (again, if a task is tried again).
    """
    if classifier is None:
        named = permits.withColumn("_category", category(F.col("work_description")))
    else:
        place, categories = permits.columns.index("work_description"), taxonomy.PROJECT_CATEGORIES

        def run(batches):
            for b in batches:
                texts = [x or "" for x in b.column(place).to_pylist()]
                try:
                    names = classifier(texts)
                except Exception:  # a failed batch stays unclassified and is tried at the next run
                    names = [None] * len(texts)
                    if failures is not None:
                        failures.add(len(texts))
                known = [n if n in categories or n is None else "Other" for n in names]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(known, pa.string())], schema.names)

        schema = permits.select("*").schema.add("_category", "string")
        named = permits.mapInArrow(run, schema)
    open_ = F.col("project_category_ai").isNull() & F.col("work_description").isNotNull()
    chosen = F.when(open_ & F.col("_category").isNotNull(), F.col("_category")).otherwise(
        F.col("project_category_ai")
    )
    changed = open_ & F.col("_category").isNotNull()
    flag = F.when(changed, F.col("_category").isin("ADU", "JADU")).otherwise(F.col("adu_flag"))
    return named.withColumns({"project_category_ai": chosen, "adu_flag": flag}).drop("_category")


def angles(contractors: DataFrame, most: int = 3) -> DataFrame:
    """contractor_id, rank, pain_angle, hook_line, body_text, grounding_signals.

    contractors carry ``signals`` (see outreach.with_signals). The strongest signals each give an angle, an
    angle is used once; a contractor without signals gets the one of its size.
    """
    table = F.create_map(*[F.lit(x) for pair in ANGLES.items() for x in pair])
    ranked = F.array_sort(
        "signals",
        lambda a, b: F.when(a.signal_value > b.signal_value, -1)
        .when(a.signal_value < b.signal_value, 1)
        .when(a.signal_type < b.signal_type, -1)
        .otherwise(1),
    )
    plain = F.array(
        F.struct(
            F.lit("scale_readiness").alias("angle"),
            F.array().cast("array<string>").alias("grounds"),
        )
    )
    found = F.transform(
        ranked,
        lambda s: F.struct(table[s.signal_type].alias("angle"), F.array(s.signal_type).alias("grounds")),
    )
    rows = contractors.withColumn("_a", F.when(F.size("signals") > 0, found).otherwise(plain))
    names = F.array_distinct(F.transform("_a", lambda a: a.angle))
    one = rows.withColumn("_names", F.slice(names, 1, most)).select(
        F.col("id").alias("contractor_id"),
        "business_name",
        F.coalesce("address_city", F.lit("your city")).alias("_city"),
        text.signal_summary(F.col("signals")).alias("_summary"),
        F.posexplode("_names").alias("_at", "pain_angle"),
        "_a",
    )
    grounds = F.flatten(
        F.transform(F.filter("_a", lambda a: a.angle == F.col("pain_angle")), lambda a: a.grounds)
    )
    words = F.replace("pain_angle", F.lit("_"), F.lit(" "))
    hook = F.concat("business_name", F.lit(": "), words)
    return one.select(
        "contractor_id",
        (F.col("_at") + 1).alias("rank"),
        "pain_angle",
        F.substring(hook, 1, 80).alias("hook_line"),
        F.concat(F.lit("Permits in "), "_city", F.lit(". Signals: "), "_summary", F.lit(".")).alias("body_text"),
        grounds.alias("grounding_signals"),
    )
