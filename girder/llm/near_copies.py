"""Near copies by their likeness: the Jaccard index of two texts' sets of five-word shingles.

Texts with the same set are one node. Candidates come in two ways, and what is linked is verified exactly:

* SimHash fingerprints of the sets, met in the byte-position index of ``simhash_links`` with count
  filtering. Its lists guarantee a meeting up to two differing bits only; texts of likeness 0.8 differ in
  some ten of 64 bits, so this way alone finds next to none of them.
* So a node also has ``BANDS`` keys, each of the smallest hashes of its set under ``ROWS`` permutations; nodes
  that share a key are candidates. Two nodes of likeness 0.8 share no key with probability
  (1 - 0.8**4)**24, some 3 in a million, less if they are more alike. Pairs whose sizes rule the
  likeness out are left out before they are verified.

Groups of over ``GROUP_LIMIT`` nodes with a key are first compared with ``HUBS`` of their nodes, others in each
band: links among near copies of one text are closed by components, so the group's pairs need not be
made. What that leaves open is settled exactly: in groups whose nodes are not all in one component, two nodes
can only be alike if the rarest fifth of their shingles meet, at places early enough for the rest
to make up the likeness. Nodes of different components that meet so are verified, first with the node of each list that
has the shingle earliest (a text that others are edits of), then all that are still apart, in blocks of a list.

Defined results. Words are what ASCII white space separates, ASCII letters in lower case. Fewer than
five words: one shingle of all words; no words: one empty shingle. Null text: empty, so empty texts are
copies of each other. Of a group the smallest id stays, a null id last; of equal rows any one. Very long texts
are hashed in pieces, whole. An empty table gives an empty result. Extra columns pass through under any names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from girder.llm.common import deleted, hashed, lean, renamed, split_join, tidied, utf8, written
from girder.llm.components import connected_components
from girder.llm.repeats import _BASES, _Hashes, _keyed, _mix
from girder.llm.simhash_links import LOWER, first_of_each, links

WORDS = 5
#: Likeness of near copies, as a fraction.
LIKE, OF = 4, 5
BANDS, ROWS = 24, 4
GROUP_LIMIT = 32
HUBS = 2
#: Shingles in a block of a list of nodes that are compared pair by pair, a node counting as MEMBER more, and
#: columns of their matrix at once.
BLOCK, MEMBER = 1 << 16, 64
COLUMNS = 1 << 11
#: Places of the counts of shingles (four bytes each in every worker), and how many of them are handed on in a row.
COUNTS, PLACES = 1 << 20, 1 << 10
#: Words of a text that are hashed at once.
PIECE = 1 << 16
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, (2, BANDS * ROWS), np.uint64)
_XOR, _ODD = _SEEDS[0], _SEEDS[1] * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the text's shingles, ascending."""
    joined = b" ".join(text.translate(LOWER).split())
    data = np.frombuffer(joined, np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(ends) - words + 1)
    a, b = starts[:n], ends[min(words, len(ends)) - 1 :]
    out = []
    for i in range(0, n, PIECE):
        lo, hi = a[i], b[min(i + PIECE, n) - 1]
        hashes = _Hashes(data[lo:hi], _BASES[0])
        out.append(hashes.of(a[i : i + PIECE] - lo, b[i : i + PIECE] - lo))
    return np.unique(np.concatenate(out))


def band_keys(found: np.ndarray) -> np.ndarray:
    """BANDS keys of a set of shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 2048):  # bounds the memory of a very long text
        part = (found[i : i + 2048, None] ^ _XOR) * _ODD
        np.minimum(least, part.min(axis=0), out=least)
    keys = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = _mix(keys * np.uint64(_BASES[1]) + column)
    return keys.view(np.int64)


def node(found: np.ndarray) -> int:
    """A hash of the set."""
    return int(_Hashes(found.view(np.uint8), _BASES[1]).of(np.array([0]), np.array([8 * len(found)])).view(np.int64)[0])


def vote(found: np.ndarray) -> int:
    """The SimHash of the set: a bit is set if it is in over half of the hashes."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(found), 1 << 14):
        part = _mix(found[i : i + (1 << 14)]).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(found), bitorder="little").view(np.int64)[0])


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    at = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def _texts(batch: pa.RecordBatch):
    chars, at = utf8(batch.column("text"))
    for i, j in zip(at.tolist(), at[1:].tolist()):
        yield chars[i:j].tobytes()


def signed(docs: DataFrame) -> DataFrame:
    """id, fp (the node), n (shingles), vote (SimHash) and keys of every row; docs: id, text."""

    def run(batches):
        for b in batches:
            fps, sizes, votes, keys = [], [], [], []
            for text in _texts(b):
                found = shingles(text)
                fps.append(node(found))
                sizes.append(len(found))
                votes.append(vote(found))
                keys.append(band_keys(found))
            longs = [pa.array(x, pa.int64()) for x in (fps, votes)]
            columns = [b.column("id"), longs[0], pa.array(sizes, pa.int32()), longs[1], _lists(keys)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "fp", "n", "vote", "keys"])

    rows = docs.select("id", "text")
    schema = rows.select("id").schema.add("fp", "long").add("n", "integer").add("vote", "long")
    schema = schema.add("keys", T.ArrayType(T.LongType()))
    return rows.mapInArrow(lean(run), schema)


def _sets(docs: DataFrame) -> DataFrame:
    """fp and its set of every row; docs: fp, text."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                found = _lists([shingles(text).view(np.int64) for text in _texts(b)])
                yield pa.RecordBatch.from_arrays([b.column("fp"), found], ["fp", "shingles"])

    return docs.select("fp", "text").mapInArrow(lean(run), "fp long, shingles array<long>")


def candidates(nodes: DataFrame, limit: int = GROUP_LIMIT) -> tuple[DataFrame, DataFrame]:
    """a < b: pairs of nodes (fp, n, keys) that share a key and whose sizes allow the likeness; and band, key, fp of
    groups over the limit, of which only the pairs with hubs are there."""
    index = nodes.select(
        F.struct("fp", "n").alias("x"), F.posexplode("keys").alias("band", "key")
    )
    groups = index.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("size"), F.min("x").alias("a"), F.max("x").alias("b")
    )
    met = written(groups.filter("size > 1"), "bands")
    more = met.filter("size > 2").select("band", "key", "size")
    entries = written(index.join(more, ["band", "key"]), "band-entries")
    few = (
        entries.filter(F.col("size") <= limit)
        .groupBy("band", "key")
        .agg(F.sort_array(F.collect_list("x")).alias("xs"))
    )
    paired = few.select(F.posexplode("xs").alias("i", "a"), "xs").select(
        "a", F.explode(F.expr("slice(xs, i + 2, size(xs))")).alias("b")
    )
    many = entries.filter(F.col("size") > limit)
    rank = lambda k: F.xxhash64("x.fp", "band", "key", F.lit(k))
    hubs = many.groupBy("band", "key").agg(
        F.array(*[F.min_by("x", rank(k)) for k in range(HUBS)]).alias("hubs")
    )
    hubs = written(hubs, "hubs")
    starred = many.join(hubs, ["band", "key"]).select(F.explode("hubs").alias("h"), "x")
    starred = starred.select(F.least("h", "x").alias("a"), F.greatest("h", "x").alias("b"))
    pairs = met.filter("size = 2").select("a", "b").unionByName(paired).unionByName(starred)
    low, high = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    likely = (
        pairs.filter("a.fp <> b.fp")
        .filter(OF * low >= LIKE * high)
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
        .distinct()
    )
    return likely, many.select("band", "key", F.col("x.fp").alias("fp"))


def voted(nodes: DataFrame) -> DataFrame:
    """a, b: pairs of nodes (fp, n, vote) whose SimHash values are equal or linked in the byte-position index.

    One node stands for all with its value: pairs are one for each node and one for each link.
    """
    stands = written(nodes.groupBy("vote").agg(F.min(F.struct("fp", "n")).alias("x")), "votes")
    near = links(stands.select(F.col("vote").alias("fp")))
    low = stands.select(F.col("vote").alias("a"), F.col("x").alias("xa"))
    high = stands.select(F.col("vote").alias("b"), F.col("x").alias("xb"))
    across = near.join(low, "a").join(high, "b").select("xa", "xb")
    same = nodes.join(stands, "vote").select(F.col("x").alias("xa"), F.struct("fp", "n").alias("xb"))
    least, most = F.least("xa.n", "xb.n"), F.greatest("xa.n", "xb.n")
    return (
        across.unionByName(same)
        .filter("xa.fp <> xb.fp")
        .filter(OF * least >= LIKE * most)
        .select(F.col("xa.fp").alias("a"), F.col("xb.fp").alias("b"))
    )


def _alike(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return OF * both >= LIKE * (F.size(a) + F.size(b) - both)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: the pairs (written) whose sets are alike."""
    # a node that stands for a large group is in very many pairs
    total = pairs.count()
    left = pairs.groupBy("a").count().join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa")), "a")
    right = pairs.groupBy("b").count().join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("sb")), "b")
    beside = split_join(pairs, left, ["a"], "inner", total).drop("count")
    beside = split_join(beside, right, ["b"], "inner", total)
    links = beside.filter(_alike(F.col("sa"), F.col("sb")))
    return written(links.select("a", "b"), "likeness")


def _placed(rows: DataFrame, named: DataFrame) -> DataFrame:
    """rows with the component of fp, which is fp itself if it has no link."""
    known = named.select(F.col("node").alias("fp"), "component")
    return rows.join(known, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def _mixed(placed: DataFrame, *keys: str, **more: Column) -> DataFrame:
    """keys, count, hub (the first in the order of ``at``) and its component, of groups with more than one component."""
    sized = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"), F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.min("at").alias("hub"), F.min_by("component", "at").alias("hub_component"),
        *[column.alias(name) for name, column in more.items()],
    )
    return written(sized.filter("_low < _high").drop("_low", "_high"), "mixed-groups")


def _place(found: np.ndarray, places: int) -> np.ndarray:
    return (_mix(found.view(np.uint64)) % np.uint64(places)).astype(np.int64)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of all sets of a batch, and offsets."""
    lists = batch.column("shingles")
    return lists.values.to_numpy(), lists.offsets.to_numpy()


def tally(sets: DataFrame, places: int = COUNTS) -> np.ndarray:
    """How many sets have a shingle, by its place; shingles that share a place are counted together.

    A task counts its sets by itself and hands on what it has, PLACES at once, and each part of the places is added up
    in one task: there is no row for a shingle, and what comes to the driver is bounded by the number of places.
    """
    ends = np.arange(0, places + PLACES, PLACES)

    def count(batches):
        counts = np.zeros(places, np.int64)
        for b in batches:
            flat, at = _flat(b)
            counts += np.bincount(_place(flat[at[0] : at[-1]], places), minlength=places)
        held = np.flatnonzero(counts)
        cut = np.searchsorted(held, ends)
        some = np.flatnonzero(np.diff(cut))
        rows = [held[cut[k] : cut[k + 1]] for k in some]
        columns = [pa.array(some, pa.int64()), _lists(rows), _lists([counts[x] for x in rows])]
        yield pa.RecordBatch.from_arrays(columns, ["part", "place", "count"])

    def add(batches):
        counts = np.zeros(places, np.int64)
        for b in batches:
            at, more = (b.column(x).flatten().to_numpy() for x in ("place", "count"))
            np.add.at(counts, at, more)
        held = np.split(counts, ends[1:-1])
        some = [k for k, x in enumerate(held) if x.any()]
        columns = [pa.array(some, pa.int64()), pa.array([held[k].tobytes() for k in some], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "counts"])

    own = sets.select("shingles").mapInArrow(lean(count), "part long, place array<long>, count array<long>")
    found = own.repartition("part").mapInArrow(lean(add), "part long, counts binary").toArrow()
    counts = np.zeros(places, np.uint32)
    for part, held in zip(found.column("part").to_pylist(), found.column("counts").to_pylist()):
        of_part = np.frombuffer(held, np.int64)
        counts[part * PLACES :][: len(of_part)] = np.minimum(of_part, np.iinfo(np.uint32).max)
    return counts


def rarest(sets: DataFrame, places: int = COUNTS) -> DataFrame:
    """token, fp, at (share, i, n, fp): the shingles at place i of each set, the rarest first, as far as one
    can be the first that the set has in common with another that is alike; those that no other set can have are left out.

    How rare a shingle is tells the tally. Which order it is doesn't matter to what is found if it is the same for
    all sets, so shingles that share a place only make lists longer.
    """
    counts = sets.sparkSession.sparkContext.broadcast(tally(sets, places))

    def run(batches):
        for b in batches:
            flat, at = _flat(b)
            out = []
            for fp, lo, hi in zip(b.column("fp").to_pylist(), at, at[1:]):
                found, n = flat[lo:hi], int(hi - lo)
                count = counts.value[_place(found, places)]
                order = np.lexsort((found, count))[: n // OF + 1]
                i = np.flatnonzero(count[order] > 1)
                out.append((found[order[i]], np.full(len(i), fp), i / n, i, np.full(len(i), n)))
            if out:
                token, fps, share, i, n = (np.concatenate(x) for x in zip(*out))
                ints = [pa.array(x, pa.int32()) for x in (i, n)]
                place = pa.StructArray.from_arrays([pa.array(share), *ints, pa.array(fps)], ["share", "i", "n", "fp"])
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(fps), place], ["token", "fp", "at"])

    schema = "token long, fp long, at struct<share: double, i: int, n: int, fp: long>"
    found = written(sets.select("fp", "shingles").mapInArrow(lean(run), schema), "rarest-shingles")
    counts.destroy()
    return found


def _can_be_alike(x: Column, y: Column) -> Column:
    """If a shingle at these places is the first that two sets have in common, whether they can be alike."""
    first = lambda p, q: (OF - LIKE) * p["n"] >= OF * p["i"] + LIKE * q["i"]
    sizes = OF * F.least(x["n"], y["n"]) >= LIKE * F.greatest(x["n"], y["n"])
    return first(x, y) & first(y, x) & sizes


def _ordered(pairs: DataFrame) -> DataFrame:
    """a < b of x, y."""
    pair = pairs.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"))
    return written(pair.distinct(), "apart-pairs")


def _with_hubs(early: DataFrame, named: DataFrame) -> DataFrame:
    """Pairs across components of each list's hub with its other nodes."""
    placed = written(_placed(early, named), "apart")
    hubs = _mixed(placed, "token")
    met = split_join(placed, hubs, ["token"], "inner", placed.count())
    far = met.filter("component <> hub_component")
    pairs = _ordered(far.select(F.col("at").alias("x"), F.col("hub").alias("y")).filter(_can_be_alike(F.col("x"), F.col("y"))))
    deleted(placed, hubs)
    return pairs


def _in_block(xs: list[dict], inner: bool) -> Iterator[pa.RecordBatch]:
    """Links a < b among the members of a list: across its two blocks, or all of one block (inner)."""
    i, n, part = (np.array([x[k] for x in xs], np.int64) for k in ("i", "n", "part"))
    component = np.array([x["component"] for x in xs], np.int64)
    first = (OF - LIKE) * n[:, None] >= OF * i[:, None] + LIKE * i
    sizes = OF * np.minimum(n[:, None], n) >= LIKE * np.maximum(n[:, None], n)
    may = first & first.T & sizes & (component[:, None] != component)
    may = np.triu(may, 1) if inner else may & (part[:, None] < part)
    rows, columns = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
    if not len(rows):
        return
    sides = [np.concatenate([xs[k]["shingles"] for k in side]) for side in (rows, columns)]
    held = np.intersect1d(*sides)
    places = [_places(xs, side, flat, held) for side, flat in zip((rows, columns), sides)]
    both = np.zeros((len(rows), len(columns)), np.float32)  # counts, exact below 2 ** 24
    for at in range(0, len(held), COLUMNS):
        low, high = (_matrix(at, *place) for place in places)
        both += low @ high.T
    union = n[rows][:, None] + n[columns] - both
    fps = np.array([x["fp"] for x in xs], np.int64)
    r, c = np.nonzero(may[np.ix_(rows, columns)] & (OF * both >= LIKE * union))
    found = fps[rows[r]], fps[columns[c]]
    yield pa.RecordBatch.from_arrays([pa.array(f(*found)) for f in (np.minimum, np.maximum)], ["a", "b"])


def _places(xs: list[dict], side: np.ndarray, flat: np.ndarray, held: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """How many members there are, and member and place in held of each shingle that is there."""
    owner = np.repeat(np.arange(len(side)), [len(xs[k]["shingles"]) for k in side])
    at = np.searchsorted(held, flat)
    there = at < len(held)
    there[there] = held[at[there]] == flat[there]
    return len(side), owner[there], at[there]


def _matrix(start: int, count: int, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    part = (at >= start) & (at < start + COLUMNS)
    out = np.zeros((count, COLUMNS), np.float32)
    out[owner[part], at[part] - start] = 1
    return out


def _block_links(blocks: DataFrame) -> DataFrame:
    """a, b: links within blocks (token, inner, xs)."""

    def run(batches):
        for whole in batches:
            for k in range(whole.num_rows):
                xs = whole.column("xs")[k].values
                shingles = xs.field("shingles")
                flat, ends = shingles.values.to_numpy(), shingles.offsets.to_numpy()
                slim = [xs.field(x).to_pylist() for x in ("fp", "i", "n", "component", "part")]
                members = [
                    dict(zip(("fp", "i", "n", "component", "part"), row), shingles=flat[lo:hi])
                    for row, lo, hi in zip(zip(*slim), ends, ends[1:])
                ]
                yield from _in_block(members, whole.column("inner")[k].as_py())

    return blocks.select("inner", "xs").mapInArrow(lean(run), "a long, b long")


def _all_apart(early: DataFrame, named: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: all links across components of nodes that meet in a list.

    Lists are dealt in blocks of some BLOCK shingles by a hash of the node, and any two blocks of a list meet in a
    task of their own. Pairs are compared there and only links leave it, so there is no row for a
    pair; a set is sent once for each block of a list.
    """
    placed = written(_placed(early, named), "apart")
    parts = F.ceil(F.sum(F.col("at.n").cast("long") + MEMBER) / BLOCK).cast("int")
    mixed = _mixed(placed, "token", parts=parts)
    rows = split_join(placed, mixed.drop("hub", "hub_component"), ["token"], "inner", placed.count())
    dealt = rows.select("token", "fp", "at.i", "at.n", "component", "parts")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    held = dealt.join(hashed(sets.select("fp", "shingles")), "fp")
    low, high = F.least("part", "beside").alias("low"), F.greatest("part", "beside").alias("high")
    blocks = held.groupBy("token", low, high).agg(
        F.collect_list(F.struct("fp", "i", "n", "component", "part", "shingles")).alias("xs")
    )
    links = written(_block_links(blocks.select((F.col("low") == F.col("high")).alias("inner"), "xs")).distinct(), "apart-links")
    deleted(placed, mixed)
    return links


def _joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """named, with the components that the links join made one."""
    ends = links.toDF("fp", "_b")
    ends = _placed(ends, named).select(F.col("_b").alias("fp"), F.col("component").alias("a"))
    across = _placed(ends, named).select("a", F.col("component").alias("b"))
    up = connected_components(across).select(F.col("node").alias("component"), F.col("component").alias("_up"))
    return written(
        named.join(up, "component", "left").select("node", F.coalesce("_up", "component").alias("component")),
        "near-components",
    )


def settled(many: DataFrame, named: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """node, component: named, with all links within the large groups (band, key, fp).

    sets_of: fp and shingles of the given fp.
    """
    if many.isEmpty():
        return named
    named = written(named, "near-components")
    placed = written(_placed(many, named).withColumn("at", F.col("fp")), "large-groups")
    mixed = _mixed(placed, "band", "key")
    if mixed.isEmpty():
        return named
    apart = split_join(placed, mixed, ["band", "key"], "left_semi", placed.count())
    apart = written(apart.select(F.col("fp").alias("node"), "component").distinct(), "nodes-apart")
    named = written(named.unionByName(apart).distinct(), "near-components")
    sets = sets_of(apart.select(F.col("node").alias("fp")))
    early = rarest(sets)
    tidied(many.sparkSession)
    pairs = _with_hubs(early, named)
    links = _linked(pairs, sets)
    deleted(pairs)
    for found in (lambda: links, lambda: _all_apart(early, named, sets)):
        now = found()
        if not now.isEmpty():
            named = _joined(named, now)
        deleted(now)
    deleted(placed, mixed, apart, sets, early)
    return named


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near copies: the smallest doc_id (null ids last)."""
    plain, (doc, body) = renamed(docs, "doc_id", "text")
    keyed = _keyed(plain, doc, body)
    key = F.struct(F.col(doc).isNull().alias("n"), F.col(doc).alias("doc"), "_k1", "_k2")
    rows = written(signed(keyed.select(key.alias("id"), F.col(body).alias("text"))), "shingled")
    nodes = rows.groupBy("fp").agg(
        F.min("id").alias("first"), F.first("n").alias("n"),
        F.first("vote").alias("vote"), F.first("keys").alias("keys"),
    )
    likely, many = candidates(nodes.select("fp", "n", "keys"))
    met = likely.unionByName(voted(nodes.select("fp", "n", "vote")))
    pairs = written(met.distinct(), "likely-pairs")

    def sets_of(fps: DataFrame) -> DataFrame:
        wanted = nodes.select("fp", "first").join(fps, "fp").select("fp", "first._k1", "first._k2")
        wanted = written(wanted, "likely")
        texts = keyed.select("_k1", "_k2", F.col(body).alias("text")).join(hashed(wanted), ["_k1", "_k2"])
        sets = written(_sets(texts).dropDuplicates(["fp"]), "shingle-sets")
        deleted(wanted)
        return sets

    sets = sets_of(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct())
    links = _linked(pairs, sets)
    deleted(pairs, sets)
    tidied(docs.sparkSession)
    named = settled(many, connected_components(links), sets_of)
    deleted(links)
    return first_of_each(plain, keyed, rows.select("id", "fp"), named).toDF(*docs.columns)
