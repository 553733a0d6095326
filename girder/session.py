"""The session that tests, bench and scripts use; a cluster brings its own."""

from __future__ import annotations

import os
import re
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_session(cores: int = 8, memory: str = "8g", app: str = "girder") -> SparkSession:
    """A local session in UTC with adaptive execution and as many shuffle partitions as cores."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a local relation: no job, and Catalyst sees their size."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, one of this machine, but only if driver
    and executors are one process, as in tests; on a cluster its lack is an error."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if re.fullmatch(r"local(\[.*\])?", context.master):
        return "file://" + os.path.join(tempfile.gettempdir(), "girder-shared")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
