"""Phrases of two to four words that occur together more often than apart.

Texts are encoded once, in blocks of one language, as numbers of the block's
own words.  Only words that occur often enough to be in a candidate get a
number of the whole corpus; they are joined to the blocks' words, so no task
holds the dictionary.  A pair of numbers is packed into one integer: of words
for phrases of two, of phrases of two for those of three (which overlap) and
four.

Each block counts its pairs in a counting quotient filter: the integer is
permuted invertibly, its leading bits are the quotient, which is only marked in
unary, and the remainder is stored in full beside a counter, so nothing is lost
or estimated.  As the permutation spreads pairs evenly, a range of quotients is
a fair share of the work, and a frequent pair is one counter in each block.  A
task merges the sorted filters of one range over all blocks, and tells each
block which of its pairs are candidates; so longer phrases are counted only
where all their pairs are.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work

#: Least occurrences of a candidate, and how many phrases of a language are returned.
LEAST, TOP = 30, 2000
#: Words of one language that a block has, but for those of its last text.
BLOCK_WORDS = 1 << 21
#: Words of a range of quotients, over all blocks.
RANGE_WORDS = 1 << 20
#: Characters of a text that are split into words together.
CHUNK = 1 << 20
#: Fixed value: what ends a piece, [.,;:!?\x0A-\x0D]; tabs part words as spaces do.
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
#: Stands for the end of a piece; no byte of UTF-8.
BREAK = b"\xff"
#: Odd factors of the permutation's rounds.
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
#: Groups of a language's phrases that are ranked before all are.
SLICES = 16

BLOCKS = "lang string, words array<string>, counts array<long>, ids binary"
FILTERS = "size int, range long, block long, filter binary"
MERGED = "size int, range long, block long, keys binary, counts binary"


# The filter ---------------------------------------------------------------


def _mixed(half: np.ndarray, factor: int, width: int) -> np.ndarray:
    x = half * np.uint64(factor)
    return (x ^ (x >> np.uint64(29))) & np.uint64((1 << width) - 1)


def permute(keys: np.ndarray, width: int) -> np.ndarray:
    """Integers of twice width bits to integers of as many bits, one to one."""
    left, right = keys >> np.uint64(width), keys & np.uint64((1 << width) - 1)
    for factor in ROUNDS:
        left, right = right, left ^ _mixed(right, factor, width)
    return left << np.uint64(width) | right


def restore(keys: np.ndarray, width: int) -> np.ndarray:
    """What permute was given."""
    left, right = keys >> np.uint64(width), keys & np.uint64((1 << width) - 1)
    for factor in reversed(ROUNDS):
        left, right = right ^ _mixed(left, factor, width), left
    return left << np.uint64(width) | right


def pack(keys: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of ascending, different integers of so many bits, with their counts.

    The header holds how many there are and the quotient's bits; then come the
    quotients in unary (a one for each integer, a zero for each next quotient),
    the remainders in whole bytes, and counters of one byte, or of eight at the
    end for those of 255 or more.
    """
    n = len(keys)
    quotient = min(bits, max(n - 1, 0).bit_length())
    rest = bits - quotient
    marks = np.zeros(n + (1 << quotient), np.uint8)
    high = keys >> np.uint64(rest) if quotient else np.zeros(n, np.uint64)
    marks[high.astype(np.int64) + np.arange(n)] = 1
    low = keys & np.uint64((1 << rest) - 1)
    remainders = low.astype("<u8").view(np.uint8).reshape(n, 8)[:, : (rest + 7) // 8]
    return b"".join((struct.pack("<QB", n, quotient), np.packbits(marks).tobytes(), remainders.tobytes(), np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype("<i8").tobytes()))


def unpack(filter_: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The integers and counts of a filter."""
    n, quotient = struct.unpack_from("<QB", filter_)
    rest, at = bits - quotient, 9
    wide, length = (rest + 7) // 8, n + (1 << quotient)
    marks = np.unpackbits(np.frombuffer(filter_, np.uint8, (length + 7) // 8, at), count=length)
    at += (length + 7) // 8
    high = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    low = np.zeros((n, 8), np.uint8)
    low[:, :wide] = np.frombuffer(filter_, np.uint8, n * wide, at).reshape(n, wide)
    at += n * wide
    counts = np.frombuffer(filter_, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(filter_, "<i8", -1, at + n)
    keys = low.view("<u8").reshape(n)
    return (keys | high << np.uint64(rest) if quotient else keys), counts


def merged(filters: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ascending integers of all filters and their summed counts; the integers of each."""
    found = [unpack(x, bits) for x in filters]
    keys, counts = np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first), [k for k, _ in found]


# Blocks -------------------------------------------------------------------


class _Ids(dict):
    """Words to numbers, in the order of their first use; the break has 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Block:
    def __init__(self) -> None:
        self.ids, self.runs, self.n = _Ids({BREAK: 0}), [], 0

    def add(self, words: list[bytes]) -> None:
        self.runs.append(np.fromiter(map(self.ids.__getitem__, words), np.uint32, len(words)))
        self.n += len(words)

    def batch(self, lang: str) -> pa.RecordBatch:
        ids = np.concatenate(self.runs)
        words = pa.array([w for w in self.ids if w != BREAK], pa.binary()).cast(pa.string())
        counts = np.bincount(ids, minlength=len(self.ids))[1:]
        ends = pa.array([0, len(words)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, x) for x in (words, pa.array(counts, pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array([lang]), *lists, pa.array([ids.tobytes()], pa.binary())], ["lang", "words", "counts", "ids"])


def _chunks(text: bytes) -> Iterator[bytes]:
    """A text's stretches, cut where a word ends."""
    at = 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            ends = [k for k in (text.find(b" ", end), text.find(b"\n", end)) if k >= 0]
            end = min(ends, default=len(text))
        yield text[at:end]
        at = end


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    blocks: dict[str, _Block] = {}
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            block = blocks.setdefault(lang, _Block())
            # bytes.lower() changes A to Z alone
            for chunk in _chunks(text.as_py().translate(PIECES)):
                block.add(chunk.lower().replace(b"\n", b" \xff ").split())
            block.add([BREAK])
            if block.n >= BLOCK_WORDS:
                yield blocks.pop(lang).batch(lang)
            elif len(blocks) > 1 and sum(x.n for x in blocks.values()) >= 4 * BLOCK_WORDS:
                yield from (x.batch(k) for k, x in blocks.items())
                blocks = {}
    yield from (x.batch(k) for k, x in blocks.items())


def blocks_of(docs: DataFrame) -> DataFrame:
    """block, lang, words, counts, ids: the texts in numbers of each block's words, 0 where a piece ends."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encode, BLOCKS).withColumn("block", F.monotonically_increasing_id())


def numbered(work: Work, rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The rows, written, with numbers from 1 without a gap; how many there are."""
    rows = work.save(rows.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    sizes = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row a partition
    starts, total = [], 0
    for k, n in sizes:
        starts.append((k, total))
        total += n
    before = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumn("_part", part).join(F.broadcast(before), "_part")
    return rows.withColumn("id", F.col("_before") + within + 1).drop("_part", "_before", "_at"), total


def _width(n: int) -> int:
    if n >= 1 << 32:
        raise ValueError(f"{n} numbers; pairs of 32 bits hold less than {1 << 32}")
    return max(1, n.bit_length())


# Pairs --------------------------------------------------------------------


def _filters(size: int, block: int, x: np.ndarray, y: np.ndarray, width: int, ranges: int) -> Iterator[tuple[int, int, int, bytes]]:
    """A block's filters of pairs without a zero, one for each range of quotients that has any; ranges in bits."""
    held = (x > 0) & (y > 0)
    keys, counts = np.unique(permute(x[held].astype(np.uint64) << np.uint64(width) | y[held].astype(np.uint64), width), return_counts=True)
    if not len(keys):
        return
    rest = 2 * width - ranges
    of = keys >> np.uint64(rest) if ranges else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
        low = keys[a:b] & np.uint64((1 << rest) - 1)
        yield size, int(of[a]), block, pack(low, counts[a:b], rest)


def _batches(rows: Iterator[tuple], names: str) -> Iterator[pa.RecordBatch]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in names.split(", ")]
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size > 1 << 24 or len(held) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*held, strict=True), fields, strict=True)], [n for n, _ in fields])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*held, strict=True), fields, strict=True)], [n for n, _ in fields])


def _ids(row: dict) -> np.ndarray:
    return np.frombuffer(row["ids"], np.uint32)


def translated(blocks: DataFrame, numbers: DataFrame) -> DataFrame:
    """block, ids: the texts in numbers of the whole corpus, 0 where a word has none or a piece ends."""
    words = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"))
    known = words.join(numbers.select("lang", "word", "id"), ["lang", "word"]).groupBy("block").agg(F.collect_list("at").alias("at"), F.collect_list("id").alias("id"))

    def translate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for k in range(batch.num_rows):
                    ids = np.frombuffer(batch.column("ids")[k].as_py(), np.uint32)
                    table = np.zeros(int(ids.max()) + 1, np.uint32)
                    table[batch.column("at")[k].values.to_numpy() + 1] = batch.column("id")[k].values.to_numpy()
                    yield batch.column("block")[k].as_py(), table[ids].tobytes()

        yield from _batches(rows(), "block long, ids binary")

    return blocks.select("block", "ids").join(known, "block").mapInArrow(translate, "block long, ids binary")


def pair_filters(tokens: DataFrame, width: int, ranges: int) -> DataFrame:
    """The blocks' filters of neighbouring words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids = _ids(row)
                    yield from _filters(2, row["block"], ids[:-1], ids[1:], width, ranges)

        yield from _batches(rows(), FILTERS)

    return tokens.mapInArrow(count, FILTERS)


def longer_filters(tokens: DataFrame, kept: DataFrame, starts: dict[int, int], width: int, pair_width: int, ranges: int) -> DataFrame:
    """The blocks' filters of three and four words, all of whose pairs are candidates.

    kept: block, range, keys, counts: a block's candidates and their places in
    their range, starts the ranges' first numbers.
    """
    mine = kept.groupBy("block").agg(F.collect_list(F.struct("range", "keys", "counts")).alias("kept"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row in batch.to_pylist():
                    keys = np.concatenate([np.frombuffer(x["keys"], np.uint64) for x in row["kept"]])
                    numbers = np.concatenate([np.frombuffer(x["counts"], np.int64) + starts[x["range"]] for x in row["kept"]])
                    order = np.argsort(keys)
                    keys, numbers = keys[order], numbers[order]
                    ids = _ids(row).astype(np.uint64)
                    here = ids[:-1] << np.uint64(width) | ids[1:]
                    at = np.minimum(np.searchsorted(keys, here), len(keys) - 1)
                    pairs = np.where(keys[at] == here, numbers[at], 0)
                    yield from _filters(3, row["block"], pairs[:-1], pairs[1:], pair_width, ranges)
                    yield from _filters(4, row["block"], np.where(pairs[1:-1] > 0, pairs[:-2], 0), pairs[2:], pair_width, ranges)

        yield from _batches(rows(), FILTERS)

    return tokens.join(mine, "block").mapInArrow(count, FILTERS)


def merged_ranges(filters: DataFrame, width: int, ranges: int, least: int, answer: bool) -> DataFrame:
    """Candidates of each range, with their counts; with answer also, by block, which of its pairs they are.

    Rows without a block hold a range's candidates and counts, others a block's
    candidates and their places in the range.
    """
    rest = 2 * width - ranges

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        size, of = key
        keys, counts, each = merged(list(rows["filter"]), rest)
        often = counts >= least
        keys, counts = keys[often], counts[often]
        whole = lambda low: restore(low | np.uint64(of) << np.uint64(rest) if ranges else low, width).tobytes()
        found = [(size, of, None, whole(keys), counts.astype(np.int64).tobytes())]
        for block, own in zip(rows["block"], each, strict=True) if answer and len(keys) else ():
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            at = at[keys[at] == own]
            if len(at):
                found.append((size, of, block, whole(keys[at]), at.astype(np.int64).tobytes()))
        return pd.DataFrame(found, columns=["size", "range", "block", "keys", "counts"]).astype({"block": "Int64"})

    return filters.groupBy("size", "range").applyInPandas(merge, MERGED)


def candidates(totals: DataFrame, starts: dict[int, int], width: int) -> DataFrame:
    """size, id, x, y, a: the ranges' candidates as rows."""
    schema = "size int, id long, x long, y long, a long"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
                columns = [np.full(len(keys), row["size"], np.int32), np.arange(len(keys)) + starts.get(row["range"], 1), (keys >> np.uint64(width)).astype(np.int64), (keys & np.uint64((1 << width) - 1)).astype(np.int64), counts]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in schema.split(", ")])

    return totals.mapInArrow(spread, schema)


# Phrases ------------------------------------------------------------------


def counted(spark: SparkSession, docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, f, id), phrases (ids, a) that occur least times or more, and word totals (lang, n).

    ids are those of a phrase's words.  docs: lang and text; other columns are
    not looked at.  Null texts are empty, null languages ``und``.
    """
    work = Work(spark, "phrases")
    blocks = work.save(blocks_of(docs), "blocks")
    every = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("f"))
    every = work.save(every, "words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words, n_words = numbered(work, every.filter(F.col("f") >= least), "numbers")
    width = _width(n_words)
    n = every.agg(F.sum("f")).first()[0] or 0
    ranges = min(2 * width, (n // RANGE_WORDS).bit_length())
    tokens = work.save(translated(blocks, words), "tokens")
    pairs = work.save(merged_ranges(pair_filters(tokens, width, ranges), width, ranges, least, answer=True), "pairs")
    starts, n_pairs = {}, 0
    for of, size in sorted((r.range, r.n) for r in pairs.filter("block IS NULL").select("range", (F.octet_length("keys") / 8).cast("long").alias("n")).collect()):  # a row a range
        starts[of] = n_pairs + 1
        n_pairs += size
    pair_width = _width(n_pairs)
    pair_ranges = min(2 * pair_width, ranges)
    filters = longer_filters(tokens, pairs.filter("block IS NOT NULL").select("block", "range", "keys", "counts"), starts, width, pair_width, pair_ranges)
    longer = candidates(merged_ranges(filters, pair_width, pair_ranges, least, answer=False), {}, pair_width)
    two = work.save(candidates(pairs.filter("block IS NULL"), starts, width).select("id", "x", "y", "a"), "two")
    longer = work.save(longer.drop("id"), "longer")
    first, last = two.select(F.col("id").alias("x"), F.array("x", "y").alias("first")), two.select(F.col("id").alias("y"), F.array("x", "y").alias("last"))
    longer = longer.join(first, "x").join(last, "y")
    ids = F.when(F.col("size") == 3, F.concat("first", F.slice("last", 2, 1))).otherwise(F.concat("first", "last"))
    phrases = two.select(F.array("x", "y").alias("ids"), "a").unionByName(longer.select(ids.alias("ids"), "a"))
    return words, work.save(phrases, "phrases"), totals


def scored(words: DataFrame, phrases: DataFrame, wanted: DataFrame) -> DataFrame:
    """ids, a, k, l, r, score: the lowest-scoring cut of every wanted phrase, of equal ones the first.

    A cut after k words scores floor(2000000 * a / (l + r)), in decimals of 38
    digits.
    """
    known = phrases.select("ids", F.col("a").alias("f")).unionByName(words.select(F.array("id").alias("ids"), "f"))
    cuts = wanted.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, F.size("ids")).alias("tail"))
    cuts = cuts.join(known.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head").join(known.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    score = F.expr("(CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    best = cuts.withColumn("score", score).groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), F.min("a").alias("a"))
    return best.select("ids", "a", "best.k", "best.l", "best.r", "best.score")


def unexplained(phrases: DataFrame, percent: int = 80) -> DataFrame:
    """The phrases without those that lie inside a longer one of at least so many percent of their occurrences."""
    n = F.size("ids")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: F.slice("ids", i, m))))
    within = phrases.filter(n > 2).select(F.explode(spans).alias("ids"), F.col("a").alias("longer")).groupBy("ids").agg(F.max("longer").alias("longer"))
    rows = phrases.join(within, "ids", "left")
    return rows.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def mine(spark: SparkSession, docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """A language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
    into words at spaces and tabs; counts are of all occurrences within pieces,
    overlapping ones too.  Ranked by score, then a, both descending, then
    phrase in byte order; so there are no ties.  Texts without a word and empty
    tables give nothing.
    """
    words, phrases, totals = counted(spark, docs, least)
    best = scored(words, phrases, unexplained(phrases))
    spelled = best.select("*", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids", "a", "l", "r", "score").agg(F.min("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = spelled.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).withColumn("rank", rank("lang", "slice")).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", rank("lang")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
