"""Merge into Parquet tables as a pure function of base and delta.

Each table has a policy: the columns that a delta overwrites (also with null), those that a present base
row keeps (also null), and those decided by an expression. The result is written beside the old
version and then pointed to, so a reader never sees half a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    keys: tuple[str, ...]
    update: tuple[str, ...]
    preserve: tuple[str, ...] = ()
    #: column -> expression of (base column, delta column, base present, delta present)
    decide: dict[str, Callable[[Column, Column, Column, Column], Column]] = field(
        default_factory=dict
    )


def keep_last(delta: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """One row for each key: the last by ``order``, which should be total."""
    by = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return delta.withColumn("_n", F.row_number().over(by)).filter("_n = 1").drop("_n")


def keep_first(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """Adds ``is_first``: true on the first row of each non-null key, null keys are never first."""
    by = Window.partitionBy(key).orderBy(*order)
    first = F.col(key).isNotNull() & (F.row_number().over(by) == 1)
    return rows.withColumn("is_first", first)


def upsert(base: DataFrame, delta: DataFrame, policy: Policy, order: str | None = None) -> DataFrame:
    """base after the delta; with ``order`` the last of equal keys in the delta wins."""
    if order is not None:
        delta = keep_last(delta, policy.keys, order)
    b = base.withColumn("_in_b", F.lit(True)).alias("b")
    d = delta.withColumn("_in_d", F.lit(True)).alias("d")
    on = [F.col(f"b.{k}") == F.col(f"d.{k}") for k in policy.keys]
    in_b = F.coalesce(F.col("b._in_b"), F.lit(False))
    in_d = F.coalesce(F.col("d._in_d"), F.lit(False))
    both = b.join(d, on, "full_outer")
    out = [F.coalesce(f"b.{k}", f"d.{k}").alias(k) for k in policy.keys]
    for c in base.columns:
        if c in policy.keys:
            continue
        old = F.col(f"b.{c}")
        if c not in delta.columns:
            out.append(old.alias(c))
            continue
        new = F.col(f"d.{c}")
        if c in policy.decide:
            value = policy.decide[c](old, new, in_b, in_d)
        elif c in policy.update:
            value = F.when(in_d, new).otherwise(old)
        else:  # preserved, and whatever the policy doesn't name
            value = F.when(in_b, old).otherwise(new)
        out.append(value.alias(c))
    return both.select(*out)


def insert_absent(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """base and the rows of new whose key it lacks."""
    return base.unionByName(new.join(base, keys, "left_anti"), allowMissingColumns=True)


def overlay(base: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """base with columns replaced where values has the key, also by null."""
    renamed = values.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    hit = base.join(renamed, key, "left")
    changed = {c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in columns}
    return hit.withColumns(changed).select(*base.columns)


def _detected(old: Column, new: Column, in_b: Column, in_d: Column) -> Column:
    active = F.col("d.is_active")
    return F.when(in_d & in_b, F.when(active, new).otherwise(old)).otherwise(F.coalesce(new, old))


PERMITS = Policy(
    ("permit_number",),
    (
        "city", "address", "address_zip", "permit_type", "permit_sub_type", "status", "status_date",
        "work_description", "valuation_usd", "total_sqft", "number_of_stories", "occupancy_type",
        "issued_date", "contractor_name", "contractor_address", "applicant_name", "adu_flag",
        "raw_source", "source_updated_at", "updated_at",
    ),
    ("id", "project_category_ai", "classified_at", "contractor_id", "created_at"),
)
INSPECTIONS = Policy(
    ("permit_ref", "inspection_date", "inspection_type"),
    ("address", "permit_status", "inspection_result", "lat", "lng", "source_updated_at", "updated_at"),
    ("id", "trade_category_ai", "is_final", "was_first_attempt_pass", "retry_count"),
)
CONTRACTORS = Policy(
    ("cslb_license",),
    (
        "license_class", "license_status", "license_expiry", "has_active_license",
        "bond_amount_cents", "worker_comp_insurer", "worker_comp_expiry", "updated_at",
    ),
    ("id", "business_name", "phone", "website", "icp_score", "icp_tier", "created_at"),
)
LEGACY_CONTRACTORS = Policy(
    ("cslb_license",),
    (
        "business_name", "owner_name", "phone", "email", "website", "address_street", "address_city",
        "address_state", "address_zip", "license_class", "license_status", "license_expiry",
        "has_active_license", "google_rating", "review_count", "social_links", "company_size_ai",
        "years_in_business", "specializations_ai", "permit_count_total", "total_valuation_cents",
        "avg_valuation_cents", "icp_score", "icp_tier", "enrichment_version", "last_enriched_at",
        "updated_at",
    ),
    ("id", "created_at"),
)
SIGNALS = Policy(
    ("contractor_id", "signal_type"),
    ("signal_value", "is_active"),
    decide={"detected_at": _detected},
)
HYPOTHESES = Policy(
    ("contractor_id", "rank"), ("pain_angle", "hook_line", "body_text", "grounding_signals"), ("id",)
)
PIPELINE_STATE = Policy(("pipeline_name",), ("last_offset", "last_cursor", "status", "last_run_at"))


class Conflict(Exception):
    """Another writer was first; the change has to be made again on what it left."""


class Table:
    """A Parquet table of versions: files are written beside the old ones, then a manifest names those that count.

    Manifests are numbered and created exclusively, so of two writers that started from the same version one
    fails with ``Conflict``. A manifest that its writer didn't finish is empty and is passed over. An append
    adds a folder, a merge writes only the buckets of keys that its delta touches.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _pointer(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_current")
        fs = at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        return fs, at

    def manifest(self) -> tuple[int, dict[str, list[str]]]:
        """The number of the next version, and the folders of each bucket (all in "" if there are none)."""
        fs, at = self._pointer()
        if not fs.exists(at):
            return 0, {}
        found = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(at))
        numbers = [(name, size) for name, size in found if name.isdigit()]
        following = int(numbers[-1][0]) + 1 if numbers else 0
        for name, size in reversed(numbers):
            if size:
                stream = fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(at, name))
                try:
                    return following, json.loads(bytes(stream.readAllBytes()).decode())
                finally:
                    stream.close()
        return following, {}

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or what its buckets hold; None before the first version."""
        parts = self.manifest()[1]
        wanted = parts if buckets is None else [str(b) for b in buckets if str(b) in parts]
        folders = [f for b in wanted for f in parts[b]]
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else None

    def _commit(self, number: int, parts: dict[str, list[str]]) -> None:
        fs, at = self._pointer()
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(at, f"{number:08d}")
        try:
            stream = fs.create(mark, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                raise Conflict(f"version {number} of {self.path} is there already") from None
            raise
        stream.write(bytearray(json.dumps(parts).encode()))
        stream.close()

    def _written(self, df: DataFrame, *by: str) -> str:
        folder = f"v-{uuid.uuid4().hex}"
        df.write.partitionBy(*by).parquet(f"{self.path}/{folder}")
        return folder

    def replace(self, df: DataFrame, number: int | None = None) -> str:
        """A whole new version; the old one stays readable until it is cleaned up.

        number: the version that df was made for, as ``manifest`` told it.
        """
        number = self.manifest()[0] if number is None else number
        folder = self._written(df)
        self._commit(number, {"": [folder]})
        return folder

    def append(self, df: DataFrame, number: int | None = None) -> str:
        """Adds rows as files of their own; what is there isn't written again."""
        now, parts = self.manifest()
        if any(parts) and "" not in parts:
            raise ValueError("a table that is merged by buckets takes rows by merges")
        folder = self._written(df)
        self._commit(now if number is None else number, {"": [*parts.get("", []), folder]})
        return folder

    def merge(self, delta: DataFrame, policy: Policy, order: str | None = None, buckets: int = 64) -> list[int]:
        """Merges by the policy; the buckets of keys that were written."""
        number, parts = self.manifest()
        if "" in parts:
            raise ValueError("the table wasn't made by merges")
        bucket = F.pmod(F.xxhash64(*policy.keys), F.lit(buckets)).cast("int")
        touched = sorted(r[0] for r in delta.select(bucket).distinct().collect())
        old = self.read(touched)
        base = delta.limit(0) if old is None else old
        merged = upsert(base, delta, policy, order).withColumn("_bucket", bucket)
        # a bucket's rows in one file each: the merge is partitioned by the keys, its buckets are not
        folder = self._written(merged.repartition("_bucket"), "_bucket")
        new = {str(b): [f"{folder}/_bucket={b}"] for b in touched}
        self._commit(number, parts | new)
        return touched


def again(change: Callable[[], object], tries: int = 5) -> object:
    """change(), made again if another writer was first."""
    for _ in range(tries - 1):
        try:
            return change()
        except Conflict:
            continue
    return change()
