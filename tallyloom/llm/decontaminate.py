"""Benchmark decontamination: pieces, then edit distance.

An item of a test set counts as found where a stretch of a document lies within
an edit budget of k = floor(rate * length) of it.  Cut into k + 1 pieces, at
least one piece then stands in the stretch unchanged.  One automaton finds all
pieces of all items in one pass over a text; around each hit the distance is
verified by Myers' bit-parallel recurrence, on Python's integers, which hold an
item of any length in one word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Work, free_name, per_worker

#: Characters of items that are broadcast at once; a larger test set takes several passes.
BLOCK_CHARS = 8_000_000


def normalized(text: str | None) -> str:
    """In lower case, with a space for any ASCII white space; one character stays one."""
    low = text.lower() if text else ""
    if text and len(low) != len(text):  # a few letters grow
        low = "".join(x if len(x) == 1 else y for x, y in ((c.lower(), c) for c in text))
    return low.replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ")


def budget(length: int, rate: float) -> int:
    return int(length * rate + 1e-9)


@dataclass
class Item:
    item_id: int
    text: str
    most: int

    def __post_init__(self):
        n, self.mask, self.top = len(self.text), (1 << len(self.text)) - 1, 1 << (len(self.text) - 1)
        self.at: dict[str, int] = {}
        for i, c in enumerate(self.text):
            self.at[c] = self.at.get(c, 0) | 1 << i
        k = self.most + 1
        cuts = [n * i // k for i in range(k + 1)]
        self.pieces = [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def best_end(self, text: str, begin: int, end: int) -> tuple[int, int] | None:
        """Least distance of the item to a stretch of text[begin:end], and where the first such stretch ends; None over budget."""
        plus, minus, score, mask, top, at = self.mask, 0, len(self.text), self.mask, self.top, self.at
        best, where = self.most + 1, -1
        for i in range(begin, end):
            eq = at.get(text[i], 0)
            cross = (((eq & plus) + plus) ^ plus) | eq | minus
            down = minus | (mask & ~(cross | plus))
            up = plus & cross
            if down & top:
                score += 1
            elif up & top:
                score -= 1
            down, up = (down << 1) & mask, (up << 1) & mask  # a stretch may begin anywhere
            vert = eq | minus
            plus = up | (mask & ~(vert | down))
            minus = down & vert
            if score < best:
                best, where = score, i + 1
                if not score:
                    break
        return None if where < 0 else (best, where)


class Finder:
    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [Item(i, x, budget(len(x), rate)) for i, x in items if x]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(self.items):
            for at, piece in item.pieces:
                pieces.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, distance, end) of each item within its budget: its nearest stretch, the first of equal ones."""
        if not self.items or not text:
            return []
        text = normalized(text)
        # each item's stretches, joined as hits arrive: those of one piece come in order, those of several nearly so
        spans: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            for k, at in uses:
                item = self.items[k]
                begin = end + 1 - size - at  # where the item would begin without an edit in front
                a, b = begin - item.most, begin + len(item.text) + item.most
                own = spans.setdefault(k, [])
                if own and own[-1][0] <= a <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], b)
                elif own and a <= own[-1][0] <= b:
                    own[-1][0], own[-1][1] = a, max(own[-1][1], b)
                else:
                    own.append([a, b])
        out = []
        for k, found in spans.items():
            item, best = self.items[k], None
            windows: list[list[int]] = []
            for a, b in sorted(found):
                if windows and a <= windows[-1][1]:
                    windows[-1][1] = max(windows[-1][1], b)
                else:
                    windows.append([a, b])
            for a, b in windows:
                new = item.best_end(text, max(0, a), min(len(text), b))
                if new and (best is None or new < best):
                    best = new
            if best:
                out.append((item.item_id, *best))
        return sorted(out)


RESULT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.LongType()), T.StructField("end", T.LongType())]))

def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Distinct items in runs of BLOCK_CHARS, as they come from the cluster."""
    block, size = [], 0
    for r in items.select("item_id", "text").filter("text IS NOT NULL").distinct().orderBy("item_id", "text").toLocalIterator():
        text = normalized(r.text)
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r.item_id, text))
        size += len(text)
    if block:
        yield block


def _matcher(shared, rate: float):
    """A function of texts that finds a broadcast block's items."""
    run = uuid.uuid4().hex

    @F.pandas_udf(RESULT)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = per_worker(("finder", run), lambda: Finder(shared.value, rate))
        for texts in batches:
            yield pd.Series([[{"item_id": i, "distance": d, "end": e} for i, d, e in finder.find(x if isinstance(x, str) else None)] for x in texts])

    return match


def with_matches(spark: SparkSession, docs: DataFrame, items: DataFrame, *, rate: float = 0.08, name: str = "matches") -> DataFrame:
    """docs, all columns, with an array of (item_id, distance, end): the items (item_id, text) found in text.

    Case and the kind of white space make no difference.  Null or empty items
    are found nowhere, null or empty texts hold none; an item as short as
    1 / rate has to stand there unchanged.  An item_id that stands for several
    texts is found where any of them is.  A column of that name is replaced.  Blocks
    of BLOCK_CHARS take a pass each, whose rows are written.
    """
    work, shared = Work(spark, "decontaminate"), None
    docs = docs.drop(name)
    for block in _blocks(items):
        if shared is not None:  # the pass before is written, so that tasks hold one block at a time
            docs = work.save(docs, "pass")
            shared.unpersist()
        again, shared = shared is not None, spark.sparkContext.broadcast(block)
        new = _matcher(shared, rate)("text")
        docs = docs.withColumn(name, F.concat(name, new) if again else new)
    return docs if shared is not None else docs.withColumn(name, F.array().cast(RESULT))


def found(spark: SparkSession, docs: DataFrame, items: DataFrame, *, rate: float = 0.08) -> DataFrame:
    """One row for each document and item found in it: doc_id, item_id, distance, end (in characters)."""
    rows = with_matches(spark, docs.select("doc_id", "text"), items, rate=rate)
    return rows.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.distance", "m.end")


def without_leaks(spark: SparkSession, docs: DataFrame, items: DataFrame, *, rate: float = 0.08) -> DataFrame:
    """docs, all columns, without the documents that hold an item."""
    name = free_name(docs, "_matches")
    return with_matches(spark, docs, items, rate=rate, name=name).filter(F.size(name) == 0).drop(name)
