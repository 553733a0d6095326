"""What the operators share: folders, bounds, splits."""

import time

import pytest
from pyspark.sql import functions as F

from girder import session
from girder.llm import common


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getConf(self):
        return {"spark.checkpoint.dir": self.folder} if self.folder else {}


class Session:
    conf = {}

    def __init__(self, *how):
        self.sparkContext = Context(*how)


def test_shared_folder():
    assert session.shared_folder(Session("local[4]")).startswith("file:///")
    assert session.shared_folder(Session("yarn", "hdfs://x/y")) == "hdfs://x/y"
    for master in ("yarn", "local-cluster[3,2,3000]", "spark://host:7077"):
        with pytest.raises(ValueError):
            session.shared_folder(Session(master))


@pytest.mark.parametrize("hot_keys", [2, 1000])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join(spark, monkeypatch, hot_keys, how):
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    rows = spark.range(300).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    side = rows.groupBy("k").count().filter("k % 2 = 1")
    want = rows.join(side, "k", how)
    got = common.split_join(rows, side, ["k"], how, 300)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_tables_are_deleted(spark):
    from pathlib import Path

    t = common.written(spark.range(3).toDF("x"), "test")
    at = Path(t.written_at.removeprefix("file://"))
    assert spark.sparkContext.applicationId in t.written_at and list(at.iterdir())
    common.deleted(t, None)
    assert not at.exists()


def test_bytes_decide_the_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, [1] * 50) for i in range(20)], "k int, xs array<int>")
    monkeypatch.setattr(common, "BROADCAST_BYTES", 20 * common.ROW_BYTES)
    assert common.fits(df) and not common.fits(df, F.size("xs") * 4)
    assert common.fits(df.limit(0), F.size("xs"))


def test_first_texts(spark):
    rows = spark.createDataFrame([(k, f"text {i}") for k in "ab" for i in range(30) for _ in range(4)], "label string, text string")
    found = common.first_texts(rows, F.lit(10), 1000)
    assert len(found) == len(set(found)) == 20
    assert {sum(len(t) for k, t in common.first_texts(rows, F.lit(10), 30) if k == "a")} <= set(range(22, 31))
    assert len(common.first_texts(rows, F.lit(10), 1)) == 2


def test_tidied_lets_finished_plans_go(spark):
    df = spark.range(3).selectExpr("id + 1 AS a")
    held = spark._jvm.java.lang.ref.WeakReference(df._jdf)
    cycle = [df]
    cycle.append(cycle)  # as plans are held by frames of finished calls
    del df, cycle
    for _ in range(10):  # references are given up by a thread of their own
        common.tidied(spark)
        if held.refersTo(None):
            break
        time.sleep(0.3)
    assert held.refersTo(None)


def test_written_tables_keep_the_heap_low(spark, monkeypatch):
    class Memory:
        used = 0
        totalMemory = lambda self: 900
        maxMemory = lambda self: 900
        freeMemory = lambda self: 900 - self.used

    memory, calls = Memory(), []
    monkeypatch.setattr(common, "tidied", calls.append)
    monkeypatch.setattr(common, "_runtime", lambda s: memory)
    for memory.used in (299, 301):
        common.written(spark.range(2), "low")
    assert len(calls) == 1


def test_native_memory_of_the_jvm_is_trimmed(spark):
    assert common._trimmed(spark) in (True, False)
    assert common.tidied(spark) is None
