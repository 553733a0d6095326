"""Token files: ids of each document in a zstandard frame of its own, under one shared dictionary.

Short documents compress badly alone, so a dictionary is trained on the serialised ids of a bounded
sample and shared by all frames. A file has

    magic, width of an id, SHA-256 of the dictionary, frames..., index, index offset, n, magic

and the index tells of each document its id, the offset and length of its frame and its ids, so one document
is read by two small reads. Ids are little-endian, two bytes wide if the vocabulary allows. Files hold runs
of ascending document ids, dealt by one range partitioning, so no file depends on another.
Files are written under a name of their attempt and then renamed, and only the files that the writing
tasks report are read: lost executors leave no half file behind.

A text is cut at ASCII white space, which no token crosses; the library encodes each distinct chunk once and
a bounded cache serves the rest.

Defined results. Null text: no ids but the end id. Null document ids come first; repeated rows each have
their frame, ties are ordered by a hash of the text, then the place in the table. An empty table: no files, an
empty result. Extra columns are ignored. Texts are encoded whole, a very long one in a round of its own.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from girder.llm.common import deleted, lean, rounds, scratch, utf8, written

MAGIC = b"GTOKENS1"
#: Bounds of the dictionary's sample, and its size in bytes.
SAMPLE_DOCUMENTS = 1500
MAX_SAMPLE_BYTES = 20_000
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
CACHE_CHUNKS = 400_000
#: Bounds of a file, by the average: documents, and bytes of frames.
FILE_DOCUMENTS = 20_000
FILE_BYTES = 64 << 20
ROUND = 1 << 18
_INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("length", "<u8"), ("n", "<u8")])
#: 1: ASCII letters and digits, 2: stops, 3: white space.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1
_KINDS[list(b".,;:!?")] = 2
_KINDS[[32, *range(9, 14)]] = 3
BAR = b"|"
_CODERS: dict[str, Coder] = {}


class Coder:
    """Texts to serialised ids by the library, through a cache of chunks."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(definition)
        self.kind = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        lowers = '"Lowercase"' in definition
        self.fold = bytes.lower if lowers else bytes
        bar = self.library.encode("|", add_special_tokens=False).ids
        self.bar = bar[0] if len(bar) == 1 else None
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def chunks(self, texts: list[bytes]) -> list[list[bytes]]:
        """The texts between white space, in lower case if the tokenizer has only that; a stop after an
        ASCII letter or digit and before white space is a token of its own anyhow, so it is cut off."""
        joined = b"\n".join(texts) + b"\n"
        # a combining mark could compose with a capital and not with its small letter
        if b"\xcc" not in joined and b"\xcd" not in joined:
            joined = self.fold(joined)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        kinds = _KINDS[data]
        stops = np.flatnonzero((kinds[1:-1] == 2) & (kinds[:-2] == 1) & (kinds[2:] == 3)) + 1
        spaced = np.insert(data, stops, 32).tobytes()
        ends = (ends + np.searchsorted(stops, ends)).tolist()
        return [spaced[a:b].split() for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        cut = self.chunks(texts)
        new = set().union(*cut).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_CHUNKS:
            self.older, self.cache = self.cache, {}
            new = set().union(*cut)
        known = [c for c in new if c in self.older]
        self.cache.update(zip(known, map(self.older.__getitem__, known)))
        missing = new.difference(known)
        plain = [m for m in missing if BAR not in m]
        self.cache.update(self.together(plain) if self.bar is not None else self.apart(plain))
        self.cache.update(self.apart([m for m in missing if BAR in m]))
        get = self.cache.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def apart(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return {c: np.array(x.ids, self.kind).tobytes() for c, x in zip(chunks, found)}

    def together(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """One call of the library for all chunks, with bars between them: a chunk without a bar has
        no token that is a bar alone."""
        text = b" | ".join(chunks).decode("utf-8", "replace")
        ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        bars = np.flatnonzero(ids == self.bar)
        if len(bars) != len(chunks) - 1:
            return self.apart(chunks)
        width, data = ids.itemsize, ids.tobytes()
        starts = [0, *((bars + 1) * width).tolist()]
        ends = [*(bars * width).tolist(), len(data)]
        return {c: data[a:b] for c, a, b in zip(chunks, starts, ends)}


def _coder(definition: str) -> Coder:
    """One for each worker process: its cache serves task after task."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(definition)
    return _CODERS[key]


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; with too few of them, their own bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"\0" * 8


def _sampled(docs: DataFrame, definition, end_id: int) -> list[bytes]:
    """Serialised ids of a bounded number of documents, by the order of a hash."""
    texts = docs.filter(F.octet_length("text") <= MAX_SAMPLE_BYTES)
    hashed = texts.select("text", F.xxhash64("text").alias("h"))
    # an even part of the hashes first, so that only few texts are sorted
    every = max(1, docs.count() // (4 * SAMPLE_DOCUMENTS))
    few = hashed.filter(F.pmod("h", F.lit(every)) == 0).dropDuplicates(["h"]).orderBy("h", "text")
    few = few.limit(SAMPLE_DOCUMENTS).select("text")

    def run(batches):
        coder = _coder(definition.value)
        for b in batches:
            chars, at = utf8(b.column(0))
            data, at = chars.tobytes(), at.tolist()
            end = np.array([end_id], coder.kind).tobytes()
            ids = [x + end for x in coder.encode([data[i:j] for i, j in zip(at, at[1:])])]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    return [r["ids"] for r in few.mapInArrow(lean(run), "ids binary").collect()]


class _File:
    """A file being written under the name of its attempt."""

    def __init__(self, folder: str, part: int, width: int, digest: bytes) -> None:
        self.fs, base = _filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"{base}/run-{part:07d}-{uuid.uuid4().hex}.tokens"
        self.stream = self.fs.open_output_stream(self.name + ".part")
        self.at = 0
        self.index: list[np.ndarray] = []
        self.put(MAGIC + struct.pack("<I", width) + digest)

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, batch: pa.RecordBatch) -> None:
        """The documents of a batch: id, n and frame."""
        rows = np.zeros(batch.num_rows, _INDEX)
        frames = batch.column("frame").to_pylist()
        ids = batch.column("id")
        rows["id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
        rows["null"] = ids.is_null().to_numpy(zero_copy_only=False)
        rows["n"] = batch.column("n").to_numpy(zero_copy_only=False)
        rows["length"] = np.fromiter(map(len, frames), np.int64, len(frames))
        rows["offset"] = self.at + np.cumsum(rows["length"]) - rows["length"]
        self.index.append(rows)
        self.put(b"".join(frames))

    def close(self) -> tuple[str, int, int]:
        index = np.concatenate(self.index)
        at = self.at
        self.put(index.tobytes())
        self.put(struct.pack("<QQ", at, len(index)) + MAGIC)
        self.stream.close()
        self.fs.move(self.name + ".part", self.name)
        return self.name, len(index), int(index["n"].sum())


def write(
    docs: DataFrame,
    definition: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[str, DataFrame]:
    """Writes the files; their folder, and part, path, n_docs, n_tokens of each file.

    The frames are written once and then dealt by ranges of (id, hash of the text, place in the table): any
    number of rows can share an id, or be equal, and still go to many files.

    definition: the text of a tokenizer file, which goes out with the tasks.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    shared = spark.sparkContext.broadcast(definition)
    dictionary = train_dictionary(_sampled(texts, shared, end_id))
    digest = hashlib.sha256(dictionary).digest()
    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/dictionary") as f:
        f.write(dictionary)
    words = spark.sparkContext.broadcast(dictionary)

    def encode(batches):
        coder = _coder(shared.value)
        press = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words.value)
        )
        end = np.array([end_id], coder.kind).tobytes()
        for b in batches:
            chars, at = utf8(b.column("text"))
            data = chars.tobytes()
            for i, j in rounds(at, ROUND):
                part = at[i : j + 1].tolist()
                ids = [x + end for x in coder.encode([data[x:y] for x, y in zip(part, part[1:])])]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("id").slice(i, j - i),
                        b.column("tie").slice(i, j - i),
                        b.column("row").slice(i, j - i),
                        pa.array([len(x) // len(end) for x in ids], pa.int64()),
                        pa.array([press.compress(x) for x in ids], pa.binary()),
                    ],
                    ["id", "tie", "row", "n", "frame"],
                )

    keyed = texts.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    frames = written(
        keyed.mapInArrow(lean(encode), "id long, tie long, row long, n long, frame binary"), "frames"
    )
    count, size = frames.agg(F.count(F.lit(1)), F.sum(F.octet_length("frame").cast("long"))).collect()[0]
    files = max(1, -(-count // FILE_DOCUMENTS), -(-(size or 0) // FILE_BYTES))
    order = [F.asc_nulls_first("id"), F.asc("tie"), F.asc("row")]
    dealt = frames.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def put(batches):
        part, file = TaskContext.get().partitionId(), None
        for b in batches:
            if file is None and b.num_rows:
                width = np.dtype(_coder(shared.value).kind).itemsize
                file = _File(folder, part, width, digest)
            if b.num_rows:
                file.add(b)
        if file is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((part, *file.close()), [pa.int32(), pa.string(), pa.int64(), pa.int64()])],
                ["part", "path", "n_docs", "n_tokens"],
            )

    schema = "part int, path string, n_docs long, n_tokens long"
    # a row for each task: the manifest that readers go by
    made = dealt.select("id", "n", "frame").mapInArrow(lean(put), schema).collect()
    deleted(frames)
    return folder, spark.createDataFrame([tuple(r) for r in sorted(made)], schema)


class Reader:
    """One token file: its index, and any document by its place in it."""

    def __init__(self, folder: str, path: str, dictionary: bytes) -> None:
        fs, _ = _filesystem(folder)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(len(MAGIC) + 36, 0)
        tail = self.file.read_at(16 + len(MAGIC), size - 16 - len(MAGIC))
        if head[: len(MAGIC)] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"{path} is no whole token file")
        (width,) = struct.unpack("<I", head[len(MAGIC) : len(MAGIC) + 4])
        if head[len(MAGIC) + 4 :] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written under another dictionary")
        self.kind = f"<u{width}"
        at, n = struct.unpack("<QQ", tail[:16])
        self.index = np.frombuffer(self.file.read_at(n * _INDEX.itemsize, at), _INDEX)
        self.open = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        row = self.index[k]
        frame = self.file.read_at(int(row["length"]), int(row["offset"]))
        return np.frombuffer(self.open.decompress(frame), self.kind)


def read(folder: str, files: DataFrame, with_ids: bool = False) -> DataFrame:
    """id, start (ids of all documents before), n_tokens, crc (of four-byte ids), optionally ids."""
    spark = files.sparkSession
    fs, base = _filesystem(folder)
    with fs.open_input_stream(f"{base}/dictionary") as f:
        dictionary = spark.sparkContext.broadcast(f.read())
    before, jobs = 0, []
    for r in sorted(files.collect()):  # a row for each file
        jobs.append((r["path"], before))
        before += r["n_tokens"]
    if not jobs:
        listed = spark.createDataFrame([], "path string, before long")
    else:
        listed = spark.createDataFrame(jobs, "path string, before long").repartition(len(jobs), "path")
    names = ["id", "start", "n_tokens", "crc", "ids"][: 4 + with_ids]

    def run(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("before").to_pylist()):
                file = Reader(folder, path, dictionary.value)
                sizes = file.index["n"].astype(np.int64)
                starts = start + np.cumsum(sizes) - sizes
                for a in range(0, len(sizes), 2000):
                    part = file.index[a : a + 2000]
                    ids = [file.ids(a + k).astype("<u4") for k in range(len(part))]
                    columns = [
                        pa.array(part["id"].astype(np.int64), mask=part["null"].astype(bool)),
                        pa.array(starts[a : a + 2000]),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = "id long, start long, n_tokens long, crc long" + ", ids array<bigint>" * with_ids
    return listed.mapInArrow(lean(run), schema)
