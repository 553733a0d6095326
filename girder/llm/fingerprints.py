"""Document fingerprints: SimHash over weighted terms, and a search by permuted block tables.

Only DataFrame functions are used. Tokens are runs of at most ``LONGEST`` characters beyond the space;
those from U+3000 on (kana, ideographs, syllables, emoji), where no spaces are set, are tokens of their own. Terms are the pairs of neighbouring
tokens, the last token being alone, at every length of text. A term's weight is how often it stands in
the text, but a run of one token ("no no no ...") is two tokens long at most: it would outvote all the
rest. Each term votes with its weight for the bits of its hash. Two bits share one sum, in the halves of a
long, so a term costs 32 additions in generated code. A fingerprint bit is one if its votes are over half
of all weights.

Documents and their successors meet in buckets of neighbouring ids: bucket bounds are quantiles of the
ids, cut further by place between them; the first document of a bucket is copied into the bucket
before it, and one shuffle by bucket serves the successor, the edited text and the sums. An id that is a
quantile, and null, have buckets of their own that are cut by a hash of the text, so an id that very many
rows share is no one task's. Buckets are sorted with spill, never gathered.

Search: the bits are cut into ``radius + 2`` blocks. Fingerprints within the radius agree on two
blocks at least, so each pair meets in one of the tables that lead with two blocks; what meets is
verified. Equal fingerprints are one entry. Where over ``LIST_LIMIT`` entries share a block key, as in
a large cluster of near copies, they aren't paired: each side spreads to the values that lie up to half the
radius away, and only what meets there, thus within the radius, becomes a pair.

Defined results. Null text: empty. Texts of white space or none have the fingerprint of one empty term.
A text of one token votes with it. Null ids come after all others, ties of ids are ordered by
a hash of their texts (by their place in the table, if over ``BUCKET_ROWS`` rows are equal); repeated rows
follow each other. A single document is its own successor. An empty table gives an empty result. Texts
are read whole: a very long one is more terms, which are summed as they come. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from girder.llm.common import small, written

BITS = 64
LONGEST = 16
RADIUS = 3
#: Documents of a bucket.
BUCKET_ROWS = 1000
QUANTILES = 255
#: Entries of a block key that are compared pair by pair.
LIST_LIMIT = 512
_LANES = 0x0000000100000001
#: Runs of characters after the space and before U+3000, or any one character from there on.
TOKEN = rf"[!-\x{{2FFF}}]{{1,{LONGEST}}}+|[^\x00-\x20]"
_PART = 1 << 40


def _votes() -> list[Column]:
    lane = [F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_LANES)) for i in range(32)]
    return [F.sum(x).alias(f"v{i}") for i, x in enumerate(lane)]


def _bits() -> Column:
    out = None
    for i in range(32):
        low = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"v{i}", 32)
        for votes, bit in ((low, 1 << i), (high, 1 << (i + 32))):
            value = bit - (1 << 64) if bit >> 63 else bit
            term = F.when(votes * 2 > F.col("total"), F.lit(value).cast("long")).otherwise(F.lit(0))
            out = term if out is None else out.bitwiseOR(term)
    return out


def simhash(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys and ``fp`` of each row of rows; keys must tell the rows apart and should be narrow.

    If rows are already partitioned by some of the keys nothing is shuffled.
    """
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(TOKEN), F.lit(0))
    tokens = rows.select(*keys, found.alias("w")).withColumn(
        "w", F.when(F.size("w") == 0, F.array(F.lit(""))).otherwise(F.col("w"))
    )
    beside = F.arrays_zip(*[F.slice("w", k + 1, F.size("w")).alias(x) for k, x in enumerate("abc")])
    pairs = tokens.select(*keys, F.inline(beside)).filter("NOT (a <=> b AND b <=> c)")
    terms = pairs.select(*keys, F.xxhash64("a", "b").alias("h"))
    summed = terms.groupBy(*keys).agg(*_votes(), F.count(F.lit(1)).alias("total"))
    return summed.select(*keys, _bits().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """The cosine that the differing bits tell, 0 for unrelated or opposed texts, 1 for equal ones."""
    return F.greatest(F.lit(0.0), F.cos(F.lit(pi / BITS) * F.bit_count(a.bitwiseXOR(b))))


def _bucketed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, h (the order among equal ids), and segment and bucket, which don't fall as (id, h) rises."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("h", F.xxhash64("text"))
    alike = rows.groupBy("id", "h").count().agg(F.sum("count"), F.max("count")).collect()[0]
    count = alike[0] or 0
    if (alike[1] or 0) > BUCKET_ROWS:  # so many equal rows: their places tell them apart, once and for all
        rows = written(rows.withColumn("h", F.xxhash64(F.monotonically_increasing_id())), "rows")
    wanted = max(1, count // BUCKET_ROWS)
    cuts = min(QUANTILES, wanted - 1)
    bounds, low, high = [], 0, 0
    if cuts:
        shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
        quantiles = F.percentile_approx("id", shares, 10_000)
        found, low, high = rows.agg(quantiles, F.min("id"), F.max("id")).collect()[0]
        bounds = sorted(set(found or []))
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    of_hash = F.col("h").cast("double") / float(1 << 64) + 0.5
    if bounds:
        below = F.size(F.filter(array(bounds), lambda x: x < F.col("id")))
        equal = F.array_contains(array(bounds), F.col("id"))
        a = F.get(array([low, *bounds]), below).cast("double")
        b = F.get(array([*bounds, high + 1]), below).cast("double")
        inside = (F.col("id").cast("double") - a) / F.greatest(b - a, F.lit(1.0))
        parts = -(-wanted // (len(bounds) + 1))
        segment = below * 2 + F.when(equal, 2).otherwise(1)
        part = F.when(F.col("id").isNull() | equal, of_hash * wanted).otherwise(inside * parts)
    else:
        segment, part = F.lit(1), F.when(F.col("id").isNull(), of_hash * wanted).otherwise(0.0)
    segment = F.when(F.col("id").isNull(), 0).otherwise(segment).cast("long")
    return rows.withColumn("segment", segment).withColumn(
        "bucket", F.col("segment") * F.lit(_PART) + F.greatest(F.floor(part), F.lit(0))
    )


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket, place, lead (false: a copy that only ends its bucket), id, text, next_text.

    The successor is the document with the next smaller id; the last document's is the first.
    The result is partitioned by bucket.
    """
    rows = _bucketed(docs, id_col, text_col)
    firsts = rows.groupBy("segment", "bucket").agg(F.max(F.struct("id", "h")).alias("first"))
    firsts = written(firsts, "firsts")
    # a row for each segment, 2 * QUANTILES + 2 at most
    lows = sorted(tuple(r) for r in firsts.groupBy("segment").agg(F.min("bucket")).collect())
    after = {s: b for (s, _), (_, b) in zip(lows, [*lows[1:], *lows[:1]])}
    pairs = [F.lit(x).cast("long") for s, b in after.items() for x in (s, b)]
    upward = Window.partitionBy("segment").orderBy("bucket")
    nearest = F.lead("bucket").over(upward)
    if pairs:
        nearest = F.coalesce(nearest, F.create_map(*pairs)[F.col("segment")])
    targets = firsts.select(F.col("bucket").alias("from"), "first", nearest.alias("target"))
    on = (
        (F.col("bucket") == F.col("from"))
        & F.col("id").eqNullSafe(F.col("first.id"))
        & (F.col("h") == F.col("first.h"))
    )
    copies = (
        rows.join(small(targets), on)
        .groupBy("target")
        .agg(F.first("id").alias("id"), F.first("text").alias("text"), F.first("h").alias("h"))
    )
    every = rows.select("bucket", F.lit(True).alias("lead"), "id", "text", "h").unionByName(
        copies.select(F.col("target").alias("bucket"), F.lit(False).alias("lead"), "id", "text", "h")
    )
    downward = Window.partitionBy("bucket").orderBy(
        F.desc("lead"), F.desc_nulls_last("id"), F.desc("h")
    )
    return every.select(
        "bucket",
        F.row_number().over(downward).alias("place"),
        "lead",
        "id",
        "text",
        F.lead("text").over(downward).alias("next_text"),
    )


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_chars, edited_sha256, fp, edited_fp, next_fp of every document."""
    rows = with_successor(docs, id_col, text_col)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - cut)"), F.expr("substring(next_text, 1, cut)"))
    made = (
        rows.withColumn("n_chars", n)
        .withColumn("cut", cut)
        .withColumn("edited", F.when(F.col("lead"), edited))
    )
    narrow = ["bucket", "place"]
    told = made.select(
        *narrow, "lead", "id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
    )
    versions = F.array(
        F.struct(F.lit(False).alias("changed"), F.col("text").alias("t")),
        F.struct(F.lit(True).alias("changed"), F.col("edited").alias("t")),
    )
    both = made.select(*narrow, "lead", F.inline(versions)).filter("lead OR NOT changed")
    marked = simhash(both, [*narrow, "changed"], "t")
    paired = marked.groupBy(*narrow).agg(
        F.max(F.when(~F.col("changed"), F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("changed"), F.col("fp"))).alias("edited_fp"),
    )
    order = Window.partitionBy("bucket").orderBy("place")
    return (
        told.join(paired.hint("merge"), narrow)
        .withColumn("next_fp", F.lead("fp").over(order))
        .filter("lead")
        .select("id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _leads(radius: int) -> list[int]:
    """The bits that lead each table: two of the radius + 2 blocks."""
    blocks = radius + 2
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [a | b for a, b in combinations(masks, 2)]


def block_tables(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, tab, key: one row for each table, led by two of the radius + 2 blocks."""
    if not 0 <= radius <= 14:
        raise ValueError("radius 0 to 14")
    entries = []
    for i, mask in enumerate(_leads(radius)):
        entries.append(
            F.struct(
                F.lit(i).cast("short").alias("tab"),
                F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("key"),
            )
        )
    return fps.select("fp", F.inline(F.array(*entries)))


def _spread(entries: DataFrame, name: str, radius: int, far: int) -> DataFrame:
    """tab, name, mid: every value up to ``far`` bits away from an entry, outside the bits that lead its table."""
    every = []
    for lead in _leads(radius):
        free = [1 << k for k in range(BITS) if not lead >> k & 1]
        every.append([sum(c) for n in range(far + 1) for c in combinations(free, n)])
    changes = entries.sparkSession.createDataFrame(
        [(i, [_signed(x) for x in xs]) for i, xs in enumerate(every)], "tab short, flips array<long>"
    )
    spread = entries.join(F.broadcast(changes), "tab").select("tab", name, F.explode("flips").alias("flip"))
    return spread.select("tab", name, F.col(name).bitwiseXOR(F.col("flip")).alias("mid"))


def within(queries: DataFrame, fps: DataFrame, radius: int = RADIUS, limit: int = LIST_LIMIT) -> DataFrame:
    """fp (of queries), other (of fps), distance: all pairs within the radius, equal ones too."""
    left = block_tables(queries.select("fp").distinct(), radius)
    right = block_tables(fps.select("fp").distinct(), radius).withColumnRenamed("fp", "other")
    asked = written(left.groupBy("tab", "key").count(), "block-keys")
    met = written(right.join(small(asked.select("tab", "key")), ["tab", "key"], "left_semi"), "block-entries")
    sizes = met.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).join(asked, ["tab", "key"])
    large = written(sizes.filter(F.col("n") + F.col("count") > limit).select("tab", "key"), "large-lists")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    few = met.join(small(large), ["tab", "key"], "left_anti").join(left, ["tab", "key"])
    pairs = few.filter(distance <= radius).select("fp", "other")
    if not large.isEmpty():
        near = _spread(left.join(small(large), ["tab", "key"], "left_semi"), "fp", radius, radius // 2)
        far = _spread(met.join(small(large), ["tab", "key"], "left_semi"), "other", radius, radius - radius // 2)
        pairs = pairs.unionByName(near.join(far, ["tab", "mid"]).select("fp", "other"))
    return pairs.distinct().withColumn("distance", distance)


def counts_within(rows: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, n_within: how many rows have a fingerprint within the radius of each queried one."""
    sized = rows.groupBy(F.col("fp").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    near = within(queries, rows, radius).join(sized, "other")
    return near.groupBy("fp").agg(F.sum("n").alias("n_within"))
