"""Packing documents into sequences: a configuration linear program.

Pieces of one length are alike, so the program is over the histogram of
lengths, at most ``capacity`` numbers however large the corpus.  A
configuration says how many pieces of each length share a sequence.
Multiplicative weights hold a price for each length, a knapsack by dynamic
programming finds the configuration of most value under these prices, over and
over; the shares are rounded to whole sequences, the program is solved again for
what is left, and best fit takes the few pieces that no share holds.  Pieces
then find their places by their rank within their length, by arithmetic on the
plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work, free_name
from .tokens import encoder, in_runs, with_end

#: Rows that share a length are ranked in groups of about this size.
RANK_GROUP = 50_000


class Knapsack:
    """The most value that fits each room up to capacity, each length any number of times: dynamic programming."""

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, capacity: int):
        self.lengths, self.prices, self.capacity = lengths, prices, capacity
        self.best, self.chosen = best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
        back, priced = np.ascontiguousarray(lengths), np.ascontiguousarray(prices)
        for room in range(1, capacity + 1):
            best[room] = best[room - 1]
            if k := fits[room]:
                value = best[room - back[:k]]
                value += priced[:k]
                top = int(value.argmax())
                if value[top] > best[room]:
                    best[room], chosen[room] = value[top], top

    def copies(self, room: int) -> dict[int, int]:
        """How often each length, by its index, stands in the best filling of a room."""
        out: dict[int, int] = {}
        while room:
            if (i := int(self.chosen[room])) < 0:
                room -= 1
            else:
                out[i] = out.get(i, 0) + 1
                room -= int(self.lengths[i])
        return out

    def with_length(self, i: int) -> tuple[float, dict[int, int]]:
        """The best filling that holds length i: value and copies."""
        room = self.capacity - int(self.lengths[i])
        out = self.copies(room)
        out[i] = out.get(i, 0) + 1
        return float(self.prices[i] + self.best[room]), out


def program(lengths: np.ndarray, need: np.ndarray, capacity: int, *, rounds: int, rate: float = 0.5, columns: int = 48, near: float = 0.002) -> tuple[list[tuple[dict[int, int], float]], float]:
    """The configuration program by multiplicative weights: configurations by index with their shares, and the best dual bound.

    A length's weight falls by rate with each time that it has been covered
    whole; its first price is the length itself, which no perfect filling
    betters.  A round prices the knapsack once and covers the lengths that are
    behind, at most columns of them, each by the best filling that holds it if
    that is worth the best of all but a share near; a step covers the filling's
    scarcest length once.  The bound is that of the prices, as dual values.  At
    last the shares are scaled so that they hold as much as there is.
    """
    covered, bound = np.zeros(len(lengths)), 0.0
    shares: dict[tuple, float] = {}
    for _ in range(rounds):
        sack = Knapsack(lengths, lengths * np.exp(-rate * (covered - covered.min())), capacity)
        most = float(sack.best[capacity])
        bound = max(bound, float((sack.prices * need).sum()) / most)
        for k, i in enumerate(np.argsort(covered, kind="stable")[:columns].tolist()):
            value, copies = sack.with_length(i) if k else (most, sack.copies(capacity))
            if value < (1 - near) * most:
                continue
            step = min(need[j] / n for j, n in copies.items())
            for j, n in copies.items():
                covered[j] += n * step / need[j]
            key = tuple(sorted(copies.items()))
            shares[key] = shares.get(key, 0.0) + step
    scale = float((lengths * need).sum() / (lengths * need * covered).sum())
    return [(dict(c), x * scale) for c, x in shares.items()], bound


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences: Martello and Toth's bound.

    Pieces over half of the capacity never share a sequence; what is at least
    as long as a threshold and doesn't fit beside them needs room of its own.
    """
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[int(x)] for x in lengths], np.int64)
    best = 0
    for least in (0, *lengths[lengths <= capacity // 2].tolist()):
        alone = need[lengths > capacity - least].sum()
        big = (lengths <= capacity - least) & (2 * lengths > capacity)
        small = (2 * lengths <= capacity) & (lengths >= least)
        beside = need[big].sum() * capacity - (lengths[big] * need[big]).sum()
        rest = (lengths[small] * need[small]).sum() - beside
        best = max(best, int(alone + need[big].sum()) + max(0, -(-int(rest) // capacity)))
    return best


def _complete(left: np.ndarray, lengths: np.ndarray, copies: dict[int, int], capacity: int) -> dict[int, int]:
    """Adds to a configuration what fits best, longest first, within what is left."""
    room = capacity - sum(int(lengths[i]) * n for i, n in copies.items())
    i = int(np.searchsorted(lengths, room, side="right")) - 1
    while i >= 0 and room >= lengths[0]:
        i = min(i, int(np.searchsorted(lengths, room, side="right")) - 1)
        if n := min(room // int(lengths[i]), int(left[i]) - copies.get(i, 0)):
            copies[i] = copies.get(i, 0) + n
            room -= n * int(lengths[i])
        i -= 1
    return copies


@dataclass
class Plan:
    """rows: configurations (length to copies) with the number of sequences of each; no packing has fewer than bound.

    shared: sequences that are the program's configurations; the others come
    from best fit.
    """

    rows: list[tuple[dict[int, int], int]]
    bound: float
    shared: int

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.rows)


def solve(histogram: dict[int, int], capacity: int, *, rounds: int | None = None, passes: int = 24) -> Plan:
    """The plan for pieces by length, 1 to capacity; it holds each piece exactly once.

    The program is solved over all lengths and its shares are rounded: each
    configuration is taken as often as its share's whole part says, or, where
    no share reaches one, once if what is left holds it, by falling shares.
    The program is then solved again for what is left, and so on, at most
    passes times.  What the last rounding leaves is packed by best fit, longest
    first.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if len(lengths) and not 1 <= lengths[0] <= lengths[-1] <= capacity:
        raise ValueError("a length lies outside 1 to capacity")
    rounds = rounds or min(3000, max(200, 400_000_000 // (capacity * (300 + len(lengths)))))
    left = np.array([histogram[int(x)] for x in lengths], np.int64)
    rows: list[tuple[dict[int, int], int]] = []
    bound, shared = float(lower_bound(histogram, capacity)), 0

    def use(copies: dict[int, int], most: int) -> int:
        times = min(most, min(int(left[i]) // n for i, n in copies.items()))
        if times > 0:
            for i, n in copies.items():
                left[i] -= n * times
            rows.append(({int(lengths[i]): n for i, n in sorted(copies.items())}, times))
        return max(times, 0)

    for turn in range(passes):
        live = np.flatnonzero(left)
        if len(live) < 2:
            break
        shares, dual = program(lengths[live], left[live], capacity, rounds=rounds if turn == 0 else rounds // 5)
        if turn == 0:
            bound = max(bound, dual)
        taken = 0
        shares.sort(key=lambda x: -x[1])
        for by, share in shares:
            if share < 1:
                break
            taken += use({int(live[i]): n for i, n in by.items()}, int(share))
        if taken < len(shares) // 10:
            # few whole parts: the largest shares once each, up to a third of what the program asks for
            most = max(1.0, sum(x for _, x in shares) / 3)
            for by, _ in shares:
                if taken >= most:
                    break
                taken += use({int(live[i]): n for i, n in by.items()}, 1)
        shared += taken
        if not taken:
            break
    while left.any():
        i = int(np.flatnonzero(left)[-1])
        use(_complete(left, lengths, {i: 1}, capacity), int(left[i]))
    return Plan(rows, bound, shared)


class Places:
    """Where the piece of a rank within its length goes."""

    def __init__(self, plan: list[tuple[dict[int, int], int]]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for copies, times in plan:
            offset = 0
            for length, n in copies.items():
                first = used.get(length, 0)
                rows.append((length << 48 | first, first, n, sequence, offset))
                used[length] = first + n * times
                offset += n * length
            sequence += times
        self.sequences = sequence
        self.key, self.first, self.copies, self.sequence, self.offset = (np.array(x, np.int64) for x in (zip(*sorted(rows), strict=True) if rows else [()] * 5))

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset."""
        at = np.searchsorted(self.key, length << 48 | rank, side="right") - 1
        into = rank - self.first[at]
        return self.sequence[at] + into // self.copies[at], self.offset[at] + into % self.copies[at] * length


def cut_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of docs (doc_id, text): its ids and then end_id.

    Only a document of more than capacity ids is cut, into pieces of capacity;
    the first piece takes what doesn't divide.  Null and empty texts are one
    piece with the end id.  Null doc_ids and repeated rows are kept as they are.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in in_runs(batch.column(1)):
                ids, sizes = with_end(*encoder(tokenizer).encode(batch.column(1).slice(a, b - a)), end_id)
                pieces = -(-sizes // capacity)
                of = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = (sizes - 1) % capacity + 1
                length = np.where(piece, capacity, first[of])
                start = np.where(piece, first[of] + (piece - 1) * capacity, 0)
                raw, ends = memoryview(ids).cast("B"), 4 * np.cumsum(length)
                crc = [zlib.crc32(raw[x:y]) for x, y in zip((ends - 4 * length).tolist(), ends.tolist(), strict=True)]
                cols = [batch.column(0).slice(a, b - a).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(spark: SparkSession, pieces: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """pieces (doc_id, piece, length and any others) with sequence_id and offset.

    Every row gets a place of its own, repeated rows too; sequences are
    gapless from 0.  The driver sees one row for each length.  An empty table
    gives none.  Columns named sequence_id or offset are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    # helpers have names of their own; the rows' numbers are written with them, so that they stay the same however often they are read
    row, group, n, base, rank, at = (free_name(pieces, x) for x in ("_row", "_group", "_n", "_base", "_rank", "_place"))
    rows = Work(spark, "pack").save(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(Places(solve(histogram, capacity).rows))

    # ranks within a length, in groups small enough for one task however many pieces share it
    most = max(histogram.values(), default=0)
    groups = max(1, -(-most // RANK_GROUP), spark.sparkContext.defaultParallelism * 4 if most > 1000 else 1)
    rows = rows.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
    before = Window.partitionBy("length").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("length", group).agg(F.count("*").alias(n)).select("length", group, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy("length", group).orderBy(row)
    ranked = rows.withColumn(rank, F.row_number().over(inside) - 1).join(bases, ["length", group]).withColumn(rank, F.col(rank) + F.col(base))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.of(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn(at, place("length", rank))
    return placed.select(*[F.col(f"`{c}`") for c in pieces.columns], f"{at}.sequence_id", f"{at}.offset")


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of docs (doc_id, text); see cut_documents and pack."""
    return pack(spark, cut_documents(docs, tokenizer, capacity=capacity, end_id=end_id), capacity=capacity)
