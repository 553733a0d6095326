"""SimHash near-duplicates by an inverted index over byte positions with count filtering.

A fingerprint has 64 bits, eight positional bytes. Two fingerprints that differ in at most ``r``
bits share at least ``8 - r`` positional bytes. The index has a posting list for each choice of
two of the four byte pairs: for r <= 2 the differing bytes touch two byte pairs at most, so two
others agree and every linked pair meets in a list. (Lists of one single byte would each hold
1/256 of the corpus, which grows as its square.) For each pair in a list the shared positional bytes
are tallied; pairs with the guaranteed minimum are kept and verified by their bits.

Lists longer than ``list_limit`` are not paired. Their entries agree on four bytes, so a link has all
its differing bits in the other four: every entry emits itself and its one-bit neighbours there,
and two entries are within two bits of each other exactly when they share such a value. Each value
has 33 entries at most, and they are chained to the smallest, so a group of any size costs 33 rows
an entry and loses no link.

Links are then closed by connected components over distinct fingerprints: equal fingerprints are one
node, however many documents have them.

Defined results. Null or empty text, or text of white space only: fingerprint zero, linked like any
other. Fewer than three words: one shingle of all words. Repeated rows and ties: component_id is
the smallest doc_id of the component, null ids are ignored for that. Texts are hashed whole, the votes of a
very long one in pieces. Extra columns are ignored, and come through ``one_of_each`` under any names; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from girder.llm.common import anti, lean, renamed, utf8, written
from girder.llm.components import connected_components
from girder.llm.repeats import _keyed

WORDS = 3
RADIUS = 2
#: Entries of a posting list that are paired with each other; longer lists go the way of neighbours.
LIST_LIMIT = 32
PAIRS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def simhash(text: bytes, words: int = WORDS) -> int:
    """64 majority bits over XXH64 (seed 42) of the word shingles, as a signed integer."""
    found = text.translate(LOWER).split()
    if not found:
        return 0
    if len(found) > words:
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - words + 1].tolist()
        h64 = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (h64(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())),
            np.uint64,
            len(starts),
        )
    else:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(found), 42)], np.uint64)
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):  # bounds the memory of a very long text
        part = hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """id and ``fp`` (long) of every row, over its whole text."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            chars, at = utf8(b.column(1))
            data, at = chars.tobytes(), at.tolist()
            fps = [simhash(data[i:j], words) for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    schema = kept.select("id").schema.add("fp", "long")
    return kept.mapInArrow(lean(run), schema)


def byte(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes agree."""
    diff = a.bitwiseXOR(b)
    same = [F.when(byte(diff, k) == 0, 1).otherwise(0) for k in range(8)]
    return sum(same[1:], same[0])


def _mask(pair: tuple[int, int]) -> int:
    m = sum(0xFFFF << (16 * k) for k in pair)
    return m - (1 << 64) if m >> 63 else m


def postings(fps: DataFrame) -> DataFrame:
    """list (which byte pairs), key (their bytes), fp: six rows for each distinct fingerprint."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i).cast("byte").alias("list"),
                F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("key"),
            )
            for i, p in enumerate(PAIRS)
        ]
    )
    return fps.select("fp", F.inline(entries))


def links(fps: DataFrame, radius: int = RADIUS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """a < b (longs): edges whose closure has the components of all pairs within ``radius`` bits.

    ``fps``: distinct ``fp``. Short lists give all their links; long ones a chain through each
    shared neighbour, whose ends are linked too.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the lists guarantee a meeting for radius 0 to 2 only")
    index = postings(fps)
    sized = index.groupBy("list", "key").agg(
        F.count(F.lit(1)).alias("n"),
        # entries beyond the limit are never gathered: those lists go the other way, whole
        F.min("fp").alias("lo"),
        F.max("fp").alias("hi"),
    )
    met = written(sized.filter("n > 1"), "simhash-lists")
    two = met.filter("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    more = met.filter("n > 2").select("list", "key", "n")
    entries = written(index.join(more, ["list", "key"]), "simhash-entries")
    short = (
        entries.filter(F.col("n") <= list_limit)
        .groupBy("list", "key")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    paired = short.select(F.posexplode("fps").alias("i", "a"), "fps").select(
        "a", F.explode(F.expr("slice(fps, i + 2, size(fps))")).alias("b")
    )
    candidates = two.unionByName(paired)
    # count filtering, then the bits themselves
    near = candidates.filter(shared_bytes(F.col("a"), F.col("b")) >= 8 - radius).filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    )
    long = entries.filter(F.col("n") > list_limit)
    chained = _chained(long, radius)
    return near.unionByName(chained).distinct()


def _chained(long: DataFrame, radius: int) -> DataFrame:
    """Links of long lists through the one-bit neighbours in the bytes that aren't the key's."""
    if radius < 2:  # neighbours at one bit are values themselves; the bits are checked below
        reach = "fp"
    else:
        reach = "min_fp"
    flips = F.expr(
        "CASE list "
        + " ".join(
            f"WHEN {i} THEN array({', '.join(_flips(p))})" for i, p in enumerate(PAIRS)
        )
        + " END"
    )
    spread = long.select("list", "fp", F.explode(flips).alias("bit")).select(
        "list", "fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("m")
    )
    if reach == "fp":  # a value that is itself an entry: a link of one bit
        own = spread.filter("m <> fp").select("list", "fp", "m")
        real = long.select("list", F.col("fp").alias("m")).distinct()
        pairs = own.join(real, ["list", "m"]).filter(
            F.bit_count(F.col("fp").bitwiseXOR(F.col("m"))) <= radius
        )
        return pairs.select(F.least("fp", "m").alias("a"), F.greatest("fp", "m").alias("b"))
    meeting = spread.groupBy("list", "m").agg(F.collect_set("fp").alias("fps"))
    star = meeting.filter(F.size("fps") > 1).select(
        F.array_min("fps").alias("a"), F.explode("fps").alias("b")
    )
    return star.filter("a <> b")


def _flips(pair: tuple[int, int]) -> list[str]:
    bits = [b for k in range(4) if k not in pair for b in range(16 * k, 16 * k + 16)]
    return ["0L", *(f"shiftleft(1L, {b})" for b in bits)]


def classes(fps: DataFrame, radius: int = RADIUS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """fp, component (the smallest fp reachable over links) of distinct fingerprints."""
    named = connected_components(links(fps, radius, list_limit))  # only nodes with a link
    joined = fps.join(named, fps["fp"] == named["node"], "left")
    return joined.select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicates(
    docs: DataFrame, radius: int = RADIUS, words: int = WORDS, list_limit: int = LIST_LIMIT
) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) of every row of docs."""
    rows = written(fingerprints(docs, words=words).withColumnRenamed("id", "doc_id"), "simhash")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    joined = nodes.join(classes(nodes.select("fp"), radius, list_limit), "fp")
    smallest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = joined.join(smallest, "component").select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """docs with one row of each component: the smallest doc_id (null ids last), ties by a hash."""
    plain, (doc, body) = renamed(docs, "doc_id", "text")
    keyed = _keyed(plain, doc, body)
    key = F.struct(F.col(doc).isNull().alias("n"), F.col(doc).alias("doc"), "_k1", "_k2")
    named_text = keyed.select(key.alias("_key"), F.col(body).alias("text"))
    rows = written(fingerprints(named_text, "_key", words=words), "simhash")
    named = connected_components(links(rows.select("fp").distinct(), radius))
    return first_of_each(plain, keyed, rows, named).toDF(*docs.columns)


def first_of_each(docs: DataFrame, keyed: DataFrame, rows: DataFrame, named: DataFrame) -> DataFrame:
    """docs with the smallest id of each component. keyed: docs with keys; rows: id (with the keys)
    and fp of each row; named: node (fp) and component of those that have a link."""
    nodes = rows.groupBy("fp").agg(F.min("id").alias("first"))
    joined = nodes.join(named, nodes["fp"] == named["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    smallest = joined.groupBy("component").agg(F.min("first").alias("best"))
    best = joined.join(smallest, "component").select("fp", "best")
    # what goes: all rows but the best, and of the best's equal rows all but one
    out = rows.join(best, "fp").filter("id <> best").select("id._k1", "id._k2").distinct()
    again = rows.groupBy("id").count().filter("count > 1").select("id._k1", "id._k2")
    kept = anti(keyed, written(out, "near-copies"))
    repeated = written(again, "repeated-rows")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    twins = kept.join(repeated, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return anti(kept, repeated).unionByName(twins).select(*docs.columns)
