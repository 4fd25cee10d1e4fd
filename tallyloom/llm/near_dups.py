"""Near-duplicate documents: MinHash bands, odd sketches, full sets.

A document's set is that of its word shingles.  MinHash samples of the set make
bands; documents that share a band are candidates.  The same samples, each
folded into one bit of a parity bitmap, make its odd sketch: the population
count of two sketches' XOR tells how many samples differ, most precisely where
few do, and drops candidates that are far from similar.  Every link is then
confirmed on the full sets.

No step makes all pairs of a group.  Documents of one set are one node.  In a
band's bucket each node is compared with one pivot, and where components stay
apart, those outside the largest with a few more.  The nodes that are then still
outside their bucket's largest component are compared with its nodes of such
buckets, in blocks, and with each other, in squares of two parts of a bucket, so
no link that would join two components is missed among the candidates, however
many a bucket holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work, free_name, per_worker

#: Words whose hashes a worker keeps.
KEPT_WORDS = 300_000
SKETCH_BITS = 512
#: Ids of candidates that are broadcast, 8 bytes each; more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Times that the nodes of a bucket meet another pivot.
TURNS = 3
#: Sets that meet a component's nodes at once, and nodes of a component that meet them in one task.
BLOCK, INSIDE = 32, 2000
#: Pairs of one node that are compared in one task; with more, its set goes to several.
HOT_PAIRS = 1000
#: Leftovers of a bucket in one part; each two parts of a bucket meet in a task of their own.
PART = 1000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Similarity:
    """What counts as near: Jaccard similarity of ``percent`` or more, on shingles of ``width`` words.

    A pair at exactly the threshold shares no band with a chance of
    (1 - s**rows)**bands, 1.3e-7 by default; its sketches differ beyond
    ``slack`` with about the same chance.
    """

    width: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    slack: float = 0.2

    @property
    def most_bits(self) -> int:
        """Of the sketches' XOR."""
        differing = 2 * self.bands * self.rows * (1 - self.percent / 100 + self.slack)
        return int(SKETCH_BITS / 2 * (1 - exp(-2 * differing / SKETCH_BITS))) + 1


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS and len(word) <= 40:
            self[word] = found
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits without visible structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles.

    Words are runs of characters other than ASCII white space, A-Z in lower
    case.  With fewer words than width the whole sequence is one shingle; with
    none, or a null text, the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(per_worker("word-hashes", _WordHashes).__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)])
    return np.unique(out)


@lru_cache(maxsize=4)
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_229)
    return rng.integers(1 << 31, size=n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(1 << 32, size=n, dtype=np.uint32)


def min_hashes(shingles: np.ndarray, n: int) -> np.ndarray:
    """n samples of a set that isn't empty."""
    a, b = _multipliers(n)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(out, (short[at : at + 1024, None] * a + b).min(axis=0), out=out)
    return out


def band_hashes(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands): 64 bits of each band's samples and its number."""
    cut = samples.reshape(len(samples), bands, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(samples), bands))
    for k in range(rows):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, k])
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """(documents, SKETCH_BITS / 64): parities of where the samples fall."""
    docs, n = samples.shape
    at = (_mixed(samples.astype(np.uint64) + (np.arange(1, n + 1, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)).astype(np.int64)
    counts = np.bincount((np.arange(docs)[:, None] * SKETCH_BITS + at).ravel(), minlength=docs * SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8).reshape(docs, SKETCH_BITS), axis=1).view("<u8")


def _features(like: Similarity):
    names = ["doc_id", "n_shingles", "digest", "bands", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                sets = [shingle_set(x, like.width) for x in batch.column(1).to_pylist()]
                full = [i for i, x in enumerate(sets) if len(x)]
                bands: list = [None] * len(sets)
                sketches: list = [None] * len(sets)
                if full:
                    samples = np.stack([min_hashes(sets[i], like.bands * like.rows) for i in full])
                    for i, b, s in zip(full, band_hashes(samples, like.bands, like.rows).view(np.int64), odd_sketches(samples).view(np.int64), strict=True):
                        bands[i], sketches[i] = b, s
                digests = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
                cols = [batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 500):
                batch = big.slice(at, 500)
                sets = [shingle_set(x, width) for x in batch.column(1).to_pylist()]
                digests = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["node", "digest", "shingles"])

    return run


def _first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row of each key: a limit by group, which Spark applies before the shuffle too."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("_nth = 1").drop("_nth")


def components(work: Work, edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes of edges (a, b): alternating large and small stars.

    Each round is written out.  Nodes without an edge don't appear.
    """
    edges = work.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        new = work.save(small, "stars")
        work.drop(edges)
        edges, now = new, mark(new)
        if now == seen:
            break
        seen = now
    # by now every node points to its component's smallest
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _close(like: Similarity, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Of n and sketch of both: by the sets' sizes, which is exact, and the sketches."""
    bits = sum((F.bit_count(a("sketch")[i].bitwiseXOR(b("sketch")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return (F.least(a("n"), b("n")) * 100 >= F.greatest(a("n"), b("n")) * like.percent) & (bits <= like.most_bits)


def _of(alias: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{alias}.{name}")


def _linked(like: Similarity, p: Column, q: Column) -> Column:
    """On full sets, in whole numbers."""
    common = F.size(F.array_intersect(p, q))
    return common * 100 >= (F.size(p) + F.size(q) - common) * like.percent


def near_duplicates(spark: SparkSession, docs: DataFrame, like: Similarity | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text).

    component_id is the smallest doc_id reachable by links; kept says that it
    is the row's own.  Null and empty texts have no shingle and are linked with
    nothing.  Rows that share a doc_id are one document, linked where any of
    their texts is.  A null doc_id is linked with nothing, its component_id
    null, and kept.  Other columns are not looked at.
    """
    like = like or Similarity()
    work = Work(spark, "near-dups")
    docs = docs.select("doc_id", "text")
    features = work.save(docs.mapInArrow(_features(like), "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"), "features")
    usable = features.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = work.save(_first(usable, ["digest"], "doc_id").select("digest", F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), "bands", "sketch"), "classes")
    reps = classes.select("digest", "node")
    nodes = classes.select("node", "n", "sketch")

    # candidates: each member of a bucket with its smallest node
    rows = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("_last"), F.count("*").alias("size")).filter("pivot < _last").drop("_last")
    members = work.save(rows.join(buckets, "bucket"), "members")

    # documents with several texts tie these together
    many = usable.groupBy("doc_id").agg(F.min("digest").alias("_d"), F.max("digest").alias("_e")).filter("_d <> _e").select("doc_id")
    several = usable.select("doc_id", "digest").join(many, "doc_id", "left_semi").join(reps, "digest").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("_last"), F.collect_set("node").alias("all"))
    several = work.save(several.filter("a < _last").select("a", F.explode("all").alias("b")).filter("a <> b"), "several")

    candidates = work.save(members.select("node").distinct(), "candidates")
    wanted = candidates.withColumnRenamed("node", "doc_id")
    if candidates.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "doc_id", "left_semi")
    sets = work.save(_first(texts.mapInArrow(_sets(like.width), "node long, digest binary, shingles array<long>"), ["node", "digest"], "node").drop("digest"), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of pairs (a, b) that the sketches don't rule out and whose full sets are near; the pairs of a hot a go to several tasks."""
        pairs = work.save(pairs.distinct(), "pairs")
        hot = pairs.groupBy("a").agg(F.ceil(F.count("*") / HOT_PAIRS).alias("_parts")).filter("_parts > 1")
        n = hot.count()
        hot = F.broadcast(hot) if n <= BROADCAST_IDS else hot

        def parts(df: DataFrame) -> DataFrame:
            return df.join(hot, "a", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("long"))) if n else df.withColumn("_parts", F.lit(1).cast("long"))

        def each_part(df: DataFrame) -> DataFrame:
            return parts(df.withColumnRenamed("node", "a")).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")

        pairs = parts(pairs).withColumn("_salt", F.pmod(F.xxhash64("b"), F.col("_parts"))).drop("_parts")
        x, y = each_part(nodes).alias("x"), nodes.alias("y")
        near = pairs.join(y, F.col("b") == F.col("y.node")).select(pairs["*"], F.struct("y.*").alias("y")).alias("p")
        near = near.join(x, (F.col("p.a") == F.col("x.a")) & (F.col("p._salt") == F.col("x._salt")) & _close(like, _of("x"), lambda name: F.col("p.y")[name])).select("p.a", "p.b", "p._salt")
        near = near.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("q")), "b").join(each_part(sets), ["a", "_salt"])
        return work.save(near.filter(_linked(like, F.col("shingles"), F.col("q"))).select("a", "b"), "links")

    edges = linked(members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))).union(several)
    known = candidates.union(several.select("a")).union(several.select("b")).distinct()
    labels = work.save(known.join(components(work, edges), "node", "left").select("node", F.coalesce("component", "node").alias("component")), "labels")

    def merged(found: DataFrame) -> DataFrame:
        """old, new of components that links (a, b) join."""
        a, b = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        joined = components(work, found.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        return work.save(joined.select(F.col("node").alias("old"), F.col("component").alias("new")), "merged")

    def renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
        return rows.join(names, rows["component"] == names["old"], "left").withColumn("component", F.coalesce("new", "component")).drop("old", "new")

    def mains_of(rows: DataFrame, turn: int) -> DataFrame:
        """Of each bucket of several components: the largest, and one of its nodes, another each turn."""
        by = rows.groupBy("bucket", "component").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("node", "bucket", F.lit(turn)).alias("h"), "node")).alias("p"))
        found = by.groupBy("bucket").agg(F.max(F.struct("k", "component", "p")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
        return work.save(found.select("bucket", F.col("main.component").alias("main"), F.col("main.p.node").alias("pivot")), "mains")

    # a bucket of two is its pivot's pair; components are looked up by node, and buckets of one component leave
    rows = members.filter("size > 2").select("bucket", "node")
    for turn in range(TURNS + 1):
        named = rows.join(labels, "node")
        mains = mains_of(named, turn)
        if turn == TURNS:
            break
        others = named.join(mains, "bucket").filter("component <> main").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
        found = linked(others)
        rows = work.save(rows.join(mains.select("bucket"), "bucket", "left_semi"), "open")
        if not found.isEmpty():
            labels = work.save(renamed(labels, merged(found)), "labels")

    # nodes outside their bucket's largest component against its nodes of open buckets: blocks of sets against nodes
    rest = work.save(named.join(mains.select("bucket", "main"), "bucket").filter("component <> main"), "rest")
    if rest.isEmpty():
        work.keep(features, classes, labels)
        return _result(features, reps, labels)
    full = nodes.join(sets, "node")
    asked = rest.select("main", "node").distinct()
    asked = asked.join(asked.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks")), "main").withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks"))).drop("_blocks").join(full, "node")
    blocks = asked.groupBy("main", "block").agg(F.collect_list(F.struct("node", "n", "sketch", "shingles")).alias("block_sets"))
    whole = work.save(named.join(mains.select("bucket", "main"), "bucket").join(asked.select("main").distinct(), "main", "left_semi").filter("component = main").select("main", "node").distinct(), "whole")
    parts = whole.groupBy("main").agg(F.ceil(F.count("*") / INSIDE).alias("_parts"))
    whole = whole.join(parts, "main").withColumn("part", F.pmod(F.xxhash64("node"), F.col("_parts"))).drop("_parts").join(full, "node")
    blocks = blocks.join(parts, "main").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    hits = whole.join(blocks, ["main", "part"]).select(F.col("node").alias("a"), F.filter("block_sets", lambda e: _close(like, lambda name: e[name], F.col) & _linked(like, e["shingles"], F.col("shingles"))).alias("hits"))
    found = work.save(hits.select("a", F.explode("hits.node").alias("b")).distinct(), "links")
    names = merged(found)
    labels, rest = work.save(renamed(labels, names), "labels"), work.save(renamed(rest, names), "rest")

    # and against each other, where they share a bucket: each two of its parts are a key of their own
    sizes = rest.groupBy("bucket").agg(F.ceil(F.count("*") / PART).alias("_parts"), F.min("component").alias("_one"), F.max("component").alias("_other")).filter("_one <> _other").select("bucket", "_parts")
    rows = rest.join(sizes, "bucket").select("bucket", "node", "component", "_parts").join(classes.select("node", "n", "sketch", "bands"), "node")
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("node"), F.col("_parts"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    rows = rows.withColumns({"low": F.least("_part", "_other"), "high": F.greatest("_part", "_other")})
    x, y = rows.alias("x"), rows.alias("y")
    # a pair that no main held is left over in all buckets that it shares, so it is taken in the first of them, once
    first = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.bucket")
    # two of one part would meet in each of its squares; they are taken in the part's own
    own = (F.col("x._part") != F.col("y._part")) | (F.col("x.low") == F.col("x.high"))
    same = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    pairs = x.join(y, same & (F.col("x.node") < F.col("y.node")) & own & (F.col("x.component") != F.col("y.component")) & _close(like, _of("x"), _of("y")) & first)
    found = linked(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    if not found.isEmpty():
        labels = work.save(renamed(labels, merged(found)), "labels")
    work.keep(features, classes, labels)
    return _result(features, reps, labels)


def _result(features: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    known = reps.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    out = features.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    # a hot set's rows meet one row of the other side, which skewed joins split
    out = out.join(known, "digest", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicate(spark: SparkSession, docs: DataFrame, like: Similarity | None = None) -> DataFrame:
    """docs, all columns, with one document of each group: that of the smallest doc_id.

    Here every row is a document of its own: of rows that share a doc_id those
    stay whose text no other row of their group stands for.  Rows with a null
    doc_id, and texts without a word, all stay.  Other columns may have any names.
    """
    row, first = free_name(docs, "_row"), free_name(docs, "_kept")
    # rows are numbered as they are written, so that their numbers stay the same however often they are read
    rows = Work(spark, "dedup").save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    named = rows.filter("doc_id IS NOT NULL")
    groups = near_duplicates(spark, named.select(F.col(row).alias("doc_id"), "text"), like).select(F.col("doc_id").alias(row), "component_id")
    kept = named.select(row, "doc_id").join(groups, row).groupBy("component_id").agg(F.min(F.struct("doc_id", row)).alias(first)).select(F.col(f"{first}.{row}").alias(row))
    return named.join(kept, row, "left_semi").unionByName(rows.filter("doc_id IS NULL")).drop(row)
