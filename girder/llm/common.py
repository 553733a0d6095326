"""Reading, written tables in the shared folder, and texts as byte arrays."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from girder.session import shared_folder

#: Bytes of text that one round of array work takes; a longer text makes a round of its own.
ROUND_BYTES = 1 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
M_MMAP_THRESHOLD = -3


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package; a cluster ships it its own way.

    Batches are bounded by bytes unless the session says otherwise: ten thousand texts at once,
    each held several times on either side, would fill an executor.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":  # Spark's default
        spark.conf.set(BATCH_BYTES, "4m")
    here = str(Path(__file__).resolve().parent.parent.parent)
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if here not in paths:
        env["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder, which is deleted as Python exits."""
    top = f"{shared_folder(spark).rstrip('/')}/girder/{spark.sparkContext.applicationId}"
    if top not in _SCRATCH:
        _SCRATCH.add(top)
        at = spark._jvm.org.apache.hadoop.fs.Path(top)
        atexit.register(_swept, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at)
    return f"{top}/{name}-{uuid.uuid4().hex}"


_SCRATCH: set[str] = set()


def _swept(files, at) -> None:
    try:
        files.delete(at, True)
    except (Py4JError, Py4JNetworkError, OSError):  # the JVM went first: the folder's name tells whose it was
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and outlives any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    _kept_low(df.sparkSession)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def deleted(*tables: DataFrame | None) -> None:
    """Deletes written tables that nothing needs any more, so that disk holds one step's tables."""
    for t in tables:
        if t is not None:
            jvm = t.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(t.written_at)
            at.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(
                at, True
            )


def tidied(spark: SparkSession) -> None:
    """Gives back what the driver holds of finished work: Python's references to plans, then what only these kept in the
    JVM (shuffles and broadcasts are cleaned once nothing refers to them), and the free memory of both.
    """
    gc.collect()
    spark._jvm.System.gc()
    _given_back()
    _trimmed(spark)


def _kept_low(spark: SparkSession) -> None:
    """Tidies if over a third of the JVM's heap is in use, so that the heap needn't grow for finished plans."""
    memory = _runtime(spark)
    if 3 * (memory.totalMemory() - memory.freeMemory()) > memory.maxMemory():
        tidied(spark)


def _runtime(spark: SparkSession):
    return spark._jvm.java.lang.Runtime.getRuntime()


def _trimmed(spark: SparkSession) -> bool:
    """Whether the JVM could return what its own allocations (compiler, symbols, buffers) have freed."""
    jvm = spark._jvm
    try:
        name = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        beans.invoke(name, "systemTrimNativeHeap", None, None)
    except Py4JError:  # a JVM or a C library without that command
        return False
    return True


def _given_back() -> None:
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def renamed(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """docs with columns c0, c1, ..., so that none clashes with a name of ours, and what names are now."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [f"c{docs.columns.index(n)}" for n in names]


#: Bytes of a side that is broadcast, as counted; beyond, the join is a shuffled one.
BROADCAST_BYTES = 2 << 20
#: Bytes that a row without arrays takes there.
ROW_BYTES = 64
#: Fewer keys than this can have more than their share of the rows; each is dealt among SPLITS tasks.
HOT_KEYS = 1000
SPLITS = 64


def fits(side: DataFrame, held: Column | None = None) -> bool:
    """Whether side's bytes are few enough to broadcast. held: the bytes of a row's arrays or strings."""
    row = F.lit(ROW_BYTES) if held is None else held + ROW_BYTES
    return (side.agg(F.sum(row.cast("long"))).collect()[0][0] or 0) <= BROADCAST_BYTES


def small(side: DataFrame, held: Column | None = None) -> DataFrame:
    """side, marked for broadcast if it fits."""
    return F.broadcast(side) if fits(side, held) else side


def hashed(side: DataFrame) -> DataFrame:
    """side, marked for the hashed side of a shuffled join: the texts that it meets are shuffled but not sorted.
    For sides with one row for a text, so that no key is hot."""
    return side.hint("shuffle_hash")


def split_join(
    rows: DataFrame, side: DataFrame, keys: list[str], how: str, total: int, count: str = "count"
) -> DataFrame:
    """rows joined with side, which has one row for a key and in ``count`` how many of the ``total`` rows have
    it. A key that more than one in HOT_KEYS rows have is dealt among SPLITS tasks, its row of
    side being repeated for each; there are fewer than HOT_KEYS such keys, so these are broadcast.
    """
    limit = total // HOT_KEYS
    is_hot = F.col(count) > limit
    hot = side.filter(is_hot).select(*keys, F.lit(True).alias("_hot"))
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(SPLITS)).cast("int")
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), turn).otherwise(F.lit(0))
    )
    last = F.when(is_hot, F.lit(SPLITS - 1)).otherwise(F.lit(0))
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    return dealt.drop("_hot").join(copies, [*keys, "_salt"], how).drop("_salt")


def anti(rows: DataFrame, out: DataFrame) -> DataFrame:
    """rows without the keys (_k1, _k2: 16 bytes) in ``out``."""
    return rows.join(small(out), ["_k1", "_k2"], "left_anti")


def lean(run: Callable) -> Callable:
    """run, after which the worker gives its free memory back: it lives on for other tasks. Arrays of a few
    MB are mapped by themselves, so that they go back as soon as they are free. Workers on this machine
    can import the package from here on, so operators need no preparation by their callers."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        importable(spark)

    def go(batches):
        libc = ctypes.CDLL(None)
        if hasattr(libc, "mallopt"):
            libc.mallopt(M_MMAP_THRESHOLD, 2 << 20)
        yield from run(batches)
        gc.collect()
        _given_back()

    return go


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model here may learn from: crc32 of the id as text, mod 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def first_texts(rows: DataFrame, most: Column, budget: int) -> list[tuple]:
    """(label, text) of the first ``most`` distinct texts of each label by a hash, whose bytes come to the
    budget at most (but one text each). rows: label, text, none null, thinned to some times as many.

    Hashes and sizes are ranked, and only the chosen texts are fetched, each once however often it stands there.
    """
    hashed = rows.withColumn("h", F.xxhash64("text"))
    slim = hashed.groupBy("label", "h").agg(F.max(F.octet_length("text").cast("long")).alias("size"))
    order = Window.partitionBy("label").orderBy("h")
    ranked = slim.select(
        "label", "h", F.row_number().over(order).alias("k"), F.sum("size").over(order).alias("bytes")
    )
    chosen = ranked.filter((F.col("k") <= most) & ((F.col("bytes") <= budget) | (F.col("k") == 1)))
    found = hashed.join(F.broadcast(chosen.select("label", "h", "k")), ["label", "h"])
    texts = found.groupBy("label", "k").agg(F.min("text").alias("text")).collect()
    return [(r["label"], r["text"]) for r in sorted(texts, key=lambda r: (r["label"], r["k"]))]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column in one array, and len + 1 offsets; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, at, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(at, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    size = int(offsets[-1])
    chars = np.frombuffer(data, np.uint8, size) if size else np.zeros(0, np.uint8)
    return chars, offsets


def rounds(offsets: np.ndarray, limit: int = ROUND_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of rows whose texts come to ``limit`` bytes at most, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j
