"""Token ids in entropy-coded blocks: a static range asymmetric numeral system.

One table of frequencies, counted over all ids, is shared by all blocks.  A
block holds whole documents in ascending doc_id order and is decoded without
any other block.  Inside it, id number i belongs to lane i mod LANES; the lanes
share one stream of 32-bit words, and a checkpoint (lane states and place in
the stream) every STRIDE steps lets several readers start inside a block.
Numbers in a frame are little-endian:

    magic "RNS1", lanes, stride, documents, ids, checkpoints, words (u32 each),
    start (u64: ids of all documents before the block),
    doc_ids (i64 each), a null flag for each (u8), lengths (u32 each),
    checkpoint places (u32 each), checkpoint states (lanes x u64 each),
    words (u32 each), crc32 of the ids (u32), crc32 of all before this (u32)

Spark's writers carry the frames as the binary column of a Parquet table, so
that commit, retry and storage are Spark's.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work
from .tokens import encoder, in_runs, with_end

LANES = 1024
STRIDE = 256
#: Bits of the sum of frequencies; an id set of up to half of that fits.
BITS = 20
_LOW = np.uint64(1 << 32)
_HEAD = struct.Struct("<4s6IQ")
#: Ids of a block; a longer document has a block of its own.
BLOCK_IDS = 1 << 20


class FrequencyTable:
    """Counts made to sum to 2**BITS, each at least 1."""

    def __init__(self, counts: dict[int, int]):
        self.symbols = np.array(sorted(counts), "<u4")
        if len(self.symbols) > 1 << (BITS - 1):
            raise ValueError(f"{len(self.symbols)} distinct ids; at most {1 << (BITS - 1)} fit")
        raw = np.array([counts[int(x)] for x in self.symbols], np.float64)
        freq = np.maximum(1, np.floor(raw * ((1 << BITS) / raw.sum() if len(raw) else 0))).astype(np.int64)
        over = int(freq.sum()) - (1 << BITS)
        order = np.argsort(-freq, kind="stable")
        while over and len(freq):  # from or to the most frequent ones, none below 1
            for i in order:
                step = min(over, int(freq[i]) // 2) if over > 0 else over
                freq[i] -= step
                over -= step
                if not over:
                    break
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else freq.astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode_frame(table: FrequencyTable, start: int, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block's frame; ids: of all its documents, one after another."""
    n, lanes = len(ids), LANES
    symbols = np.searchsorted(table.symbols, ids)
    state = np.full(lanes, _LOW, np.uint64)
    steps = -(-n // lanes)
    places, states, words, written = [], [], [], 0
    shift, low32 = np.uint64(64 - BITS), np.uint64(0xFFFFFFFF)
    bits, half = np.uint64(BITS), np.uint64(32)
    freq, first = table.freq[symbols], table.first[symbols]
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        f, x = freq[at], state[: at.stop - at.start]
        # a state of 64 bits holds one more id while it is under f << (64 - BITS); f = 2**BITS never overflows
        full = np.flatnonzero((x >> shift) >= f)
        if len(full):
            words.append((x[full] & low32).astype("<u4"))
            written += len(full)
            x[full] >>= half
        q = x // f
        x[:] = (q << bits) + (x - q * f) + first[at]
        if step % STRIDE == 0:
            places.append(written)
            states.append(state.astype("<u8").tobytes())
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    places = [len(stream) - x for x in places[::-1]]  # words that stand before the step
    body = b"".join(
        [
            _HEAD.pack(b"RNS1", lanes, STRIDE, len(doc_ids), n, len(places), len(stream), start),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is None for x in doc_ids], "u1").tobytes(),
            np.asarray(lengths, "<u4").tobytes(),
            np.array(places, "<u4").tobytes(),
            *states[::-1],
            stream.tobytes(),
            struct.pack("<I", zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


class Frame:
    """A frame's parts; decode() gives its ids or those of one checkpoint's stretch."""

    def __init__(self, frame: bytes):
        if zlib.crc32(frame[:-4]) != struct.unpack_from("<I", frame, len(frame) - 4)[0]:
            raise ValueError("the frame's checksum doesn't match")
        magic, self.lanes, self.stride, docs, self.n, marks, words, self.start = _HEAD.unpack_from(frame)
        if magic != b"RNS1":
            raise ValueError("no frame of this format")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(frame, kind, count, at)
            at += out.nbytes
            return out

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, null, strict=True)]
        self.lengths = take("<u4", docs)
        self.places = take("<u4", marks)
        self.states = take("<u8", marks * self.lanes).reshape(marks, self.lanes)
        self.words = take("<u4", words)
        self.crc = int(take("<u4", 1)[0])

    def stretch(self, table: FrequencyTable, mark: int) -> np.ndarray:
        """The ids from one checkpoint to the next."""
        lanes, begin = self.lanes, mark * self.stride * self.lanes
        n = min(self.n, begin + self.stride * lanes) - begin
        out = np.empty(n, np.uint32)
        state, words, place = self.states[mark].astype(np.uint64), self.words, int(self.places[mark])
        mask, bits, half = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
        for low in range(0, n, lanes):
            x = state[: min(lanes, n - low)]
            slot = x & mask
            symbol = table.slot[slot]
            out[low : low + len(x)] = symbol
            x[:] = table.freq[symbol] * (x >> bits) + slot - table.first[symbol]
            short = np.flatnonzero(x < _LOW)
            if len(short):
                x[short] = (x[short] << half) | words[place : place + len(short)]
                place += len(short)
        return table.symbols[out]

    def _whole(self, table: FrequencyTable, marks: int) -> np.ndarray:
        """The ids of the first stretches, all of full length, side by side: each checkpoint has its own states and place."""
        out = np.empty((marks, self.stride, self.lanes), np.uint32)
        x, place = self.states[:marks].astype(np.uint64), self.places[:marks].astype(np.int64)
        mask, bits, half = np.uint64((1 << BITS) - 1), np.uint64(BITS), np.uint64(32)
        for step in range(self.stride):
            slot = x & mask
            symbol = table.slot[slot]
            out[:, step] = symbol
            x = table.freq[symbol] * (x >> bits) + slot - table.first[symbol]
            short = x < _LOW
            rank = np.cumsum(short, axis=1)
            x[short] = (x[short] << half) | self.words[(place[:, None] + rank - 1)[short]]
            place += rank[:, -1]
        return table.symbols[out.ravel()]

    def decode(self, table: FrequencyTable) -> np.ndarray:
        """All ids, those of full stretches in parallel."""
        marks = self.n // (self.stride * self.lanes)
        parts = [self._whole(table, marks)] if marks else []
        parts += [self.stretch(table, k) for k in range(marks, len(self.places))]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != self.crc:
            raise ValueError("the decoded ids' checksum doesn't match")
        return ids


_BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())])


def _narrow(ids: np.ndarray) -> bytes:
    """In two bytes each, where they fit."""
    return ids.astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4").tobytes()


def _widen(buffer, n: int) -> np.ndarray:
    return np.frombuffer(buffer, "<u2" if len(buffer) == 2 * n else "<u4")


def _tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, start = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        lengths: list[int] = []
        ids: list[np.ndarray] = []
        size = 0

        def flush():
            nonlocal block, start, docs, lengths, ids, size
            row = [part, block, start, size, docs, lengths, _narrow(np.concatenate(ids))]
            block, start = block + 1, start + size
            docs, lengths, ids, size = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOCKS.types, strict=True)], schema=_BLOCKS)

        for batch in batches:
            for a, b in in_runs(batch.column(1)):
                found, sizes = with_end(*encoder(path).encode(batch.column(1).slice(a, b - a)), end_id)
                at = 0
                for key, n in zip(batch.column(0).slice(a, b - a).to_pylist(), sizes.tolist(), strict=True):
                    if size and size + n > BLOCK_IDS:
                        yield flush()
                    docs.append(key)
                    lengths.append(n)
                    ids.append(found[at : at + n])
                    size, at = size + n, at + n
        if docs:
            yield flush()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for x, n in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = np.bincount(_widen(x.as_buffer(), n))
            if len(found) > len(counts):
                counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
            counts[: len(found)] += found
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["id", "n"])


def write_ids(spark: SparkSession, docs: DataFrame, tokenizer: str, path: str, *, end_id: int = 2) -> None:
    """Writes ``path/table`` (id, n) and ``path/blocks`` (part, block, frame) for docs (doc_id, text).

    Ids stand in ascending doc_id order: frames by (part, block), documents in
    a frame as listed.  A null or empty text has only its end id; null doc_ids
    come first; rows that share a doc_id stand one after another, ordered by a hash
    of their texts and then by text, over several partitions if they are many.
    An empty table gives no frame.  Other columns of docs are not looked at.
    """
    work = Work(spark, "rans")
    rows = docs.select("doc_id", "text")
    # sorted by whole texts on ties, so that a task that runs again makes the same block
    order = [F.col("doc_id").asc_nulls_first(), "hash"]
    rows = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text").drop("hash")
    blocks = work.save(rows.mapInArrow(_tokenize(tokenizer, end_id), "part int, block int, start_in_part long, n_ids long, doc_ids array<long>, lengths array<long>, ids binary"), "ids")
    counts = blocks.select("ids", "n_ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts.coalesce(1).write.parquet(f"{path}/table")
    table = _read_table(spark, path)
    # one row for each partition
    totals = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    bases, at = {}, 0
    for part in sorted(totals):
        bases[part] = at
        at += totals[part]
    shared = spark.sparkContext.broadcast((table, bases))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bases = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                part, block, start = (one.column(k)[0].as_py() for k in range(3))
                ids = _widen(one.column(5)[0].as_buffer(), one.column(6)[0].as_py())
                frame = encode_frame(table, bases[part] + start, one.column(3)[0].as_py(), np.array(one.column(4)[0].as_py(), np.int64), ids)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([frame], pa.binary())], names=["part", "block", "frame"])

    frames = blocks.select("part", "block", "start_in_part", "doc_ids", "lengths", "ids", "n_ids").mapInArrow(encode, "part int, block int, frame binary")
    frames.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    work.drop(blocks)


def _read_table(spark: SparkSession, path: str) -> FrequencyTable:
    """At most one row for each id of the vocabulary."""
    return FrequencyTable({r.id: r.n for r in spark.read.parquet(f"{path}/table").collect()})


def read_ids(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids."""
    shared = spark.sparkContext.broadcast(_read_table(spark, path))
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                frame = Frame(x.as_buffer().to_pybytes())
                ids = frame.decode(shared.value)
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(frame.lengths.astype(np.int64))
                begins = ends - frame.lengths
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                cols: list = [frame.doc_ids, frame.start + begins, frame.lengths, crc]
                if with_ids:
                    cols.append([ids[a:b] for a, b in zip(begins, ends, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return spark.read.parquet(f"{path}/blocks").select("frame").mapInArrow(decode, schema)
