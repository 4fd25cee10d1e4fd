"""Masked pseudo-likelihood: a bidirectional window network scores documents.

Every word is predicted from the words on both sides, never from itself; the
sum of these conditional log-probabilities is the document's score.  The network
has a table of vectors for each place of the window, their sum through tanh,
and two softmaxes: over groups of words, and over the words of the group.

The vocabulary is every word of the corpus.  The network tells the most frequent
ones apart and the buckets that the others share; the rest of a bucketed word's
probability, its share of the bucket, comes from the counts of the whole corpus
by a join, so that nothing that is gathered grows with the input.

Training passes over the whole corpus in steps.  A text belongs to a shard by its
hash; a step sums up the gradient of all words of a shard over the cluster, each
word masked from its own prediction, and the driver follows it.  So what is
learned doesn't depend on the number of tasks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Work
from .tokens import in_runs

#: Words that the network tells apart, by frequency; the rest share BUCKETS ids by hash.
GROUPS = 32
SIZE = GROUPS * GROUPS
BUCKETS = 64
SIDE = 2
DIM = 16
#: Words that pass through the network at once.
BATCH = 20_000
#: Into how many groups the tasks' sums are added up, level after level.
FANS = (1024, 32, 1)


@dataclass
class Words:
    """The words of a run of texts: distinct ones, the place of each word among them, and how many each text has."""

    distinct: list[str]
    at: np.ndarray
    lengths: np.ndarray


def split_words(texts: pa.Array) -> Words:
    """In lower case, cut at Unicode white space; a null text has none."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    begins = np.asarray(lists.offsets)
    flat = lists.values.slice(begins[0], begins[-1] - begins[0]).dictionary_encode()
    distinct, at = flat.dictionary.to_pylist(), np.asarray(flat.indices)
    full = np.array([bool(x) for x in distinct], bool)[at]  # white space at an end leaves an empty word
    upto = np.concatenate([[0], np.cumsum(full)])[begins - begins[0]]
    return Words(distinct, at[full], np.diff(upto))


def words_of(text: str | None) -> list[str]:
    found = split_words(pa.array([text], pa.string()))
    return [found.distinct[i] for i in found.at]


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


@dataclass
class Vocabulary:
    ids: dict[str, int]

    def of(self, words: Words) -> np.ndarray:
        """Ids; words that the network doesn't tell apart share the last BUCKETS ids."""
        known, low = self.ids.get, SIZE - BUCKETS
        each = np.fromiter((low + _bucket(x) if (i := known(x)) is None else i for x in words.distinct), np.int64, len(words.distinct))
        return each[words.at]

    def encode(self, text: str | None) -> np.ndarray:
        return self.of(split_words(pa.array([text], pa.string())))


@dataclass
class Network:
    """Parameters in one vector, with views."""

    flat: np.ndarray

    SHAPES = (("around", (2 * SIDE, SIZE + 1, DIM)), ("bias", (DIM,)), ("group", (DIM, GROUPS)), ("group_bias", (GROUPS,)), ("word", (GROUPS, DIM, GROUPS)), ("word_bias", (GROUPS, GROUPS)))

    def __post_init__(self):
        at = 0
        for name, shape in self.SHAPES:
            n = math.prod(shape)
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def size(cls) -> int:
        return sum(math.prod(shape) for _, shape in cls.SHAPES)

    @classmethod
    def initial(cls, counts: np.ndarray, seed: int = 11) -> Network:
        """Small random vectors; biases that give the words' own frequencies."""
        rng = np.random.default_rng(seed)
        net = cls((rng.standard_normal(cls.size()) * 0.1).astype(np.float32))
        net.bias[:] = 0
        by = counts.reshape(GROUPS, GROUPS) + 1.0
        net.group_bias[:] = np.log(by.sum(axis=1) / by.sum())
        net.word_bias[:] = np.log(by / by.sum(axis=1, keepdims=True))
        return net


def windows(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(words, 2 * SIDE) ids around each word of texts laid end to end; SIZE stands for no word."""
    # texts with room for no word between them
    at = np.arange(len(ids)) + SIDE * (1 + np.repeat(np.arange(len(lengths)), lengths))
    padded = np.full(len(ids) + SIDE * (len(lengths) + 1), SIZE, np.int64)
    padded[at] = ids
    out = np.empty((len(ids), 2 * SIDE), np.int64)
    for k, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, k] = padded[at + step]
    return out


def _soft(x: np.ndarray, shares: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
    """Softmax by rows, if asked for, and the rows' log-sums."""
    top = x.max(axis=1, keepdims=True)
    e = np.exp(x - top)
    total = e.sum(axis=1, keepdims=True)
    return e / total if shares else None, np.log(total[:, 0]) + top[:, 0]


def log_probs(net: Network, around: np.ndarray, ids: np.ndarray, gradient: Network | None = None) -> np.ndarray:
    """Of each word given its window; adds the gradient of their sum, if asked for."""
    hidden = np.tanh(sum(net.around[k][around[:, k]] for k in range(2 * SIDE)) + net.bias)
    group, word = ids // GROUPS, ids % GROUPS
    p, log_sum = _soft(hidden @ net.group + net.group_bias, gradient is not None)
    n = np.arange(len(ids))
    out = (hidden * net.group.T[group]).sum(axis=1) + net.group_bias[group] - log_sum
    back = None
    if gradient is not None:
        p *= -1
        p[n, group] += 1
        gradient.group += hidden.T @ p
        gradient.group_bias += p.sum(axis=0)
        back = p @ net.group.T
    small = group.astype(np.uint8)  # short numbers are sorted by radix
    order = np.argsort(small, kind="stable")
    ends = np.searchsorted(small[order], np.arange(GROUPS + 1))
    for g in range(GROUPS):
        rows = order[ends[g] : ends[g + 1]]
        if not len(rows):
            continue
        h, w = hidden[rows], word[rows]
        x = h @ net.word[g] + net.word_bias[g]
        p, log_sum = _soft(x, gradient is not None)
        m = np.arange(len(rows))
        out[rows] += x[m, w] - log_sum
        if gradient is not None:
            p *= -1
            p[m, w] += 1
            gradient.word[g] += h.T @ p
            gradient.word_bias[g] += p.sum(axis=0)
            back[rows] += p @ net.word[g].T
    if gradient is not None:
        back *= 1 - hidden * hidden
        gradient.bias += back.sum(axis=0)
        for k in range(2 * SIDE):
            # sums by id: sorted, then in runs
            keys = around[:, k].astype(np.uint16)
            by = np.argsort(keys, kind="stable")
            keys = keys[by]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
            if len(first):
                gradient.around[k][keys[first]] += np.add.reduceat(back[by], first)
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for a, b in in_runs(batch.column(0)):
            words = split_words(batch.column(0).slice(a, b - a))
            n = np.bincount(words.at, minlength=len(words.distinct))
            counts.update({x: k for x, k in zip(words.distinct, n.tolist(), strict=True) if k})
            if len(counts) > 300_000:
                yield out()
                counts.clear()
    yield out()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: every word of all texts, and how often it occurs."""
    return docs.select("text").mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, counted: DataFrame | None = None) -> tuple[Vocabulary, np.ndarray]:
    """The most frequent words of all texts, and how often each id, word or bucket, occurs; counted is count_words(docs), if at hand."""
    counted = count_words(docs) if counted is None else counted
    top = counted.orderBy(F.desc("n"), "word").limit(SIZE - BUCKETS).collect()
    counts = np.zeros(SIZE)
    counts[: len(top)] = [r.n for r in top]
    for r in counted.groupBy((F.crc32(F.col("word").cast("binary")) % BUCKETS).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        counts[SIZE - BUCKETS + r.bucket] = r.n
    for r in top:
        counts[SIZE - BUCKETS + _bucket(r.word)] -= r.n
    return Vocabulary({r.word: i for i, r in enumerate(top)}), counts


def _parts(lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Rows and words (first and behind the last of each) of stretches of some BATCH words; a longer text comes alone."""
    ends = np.cumsum(lengths)
    row, word = 0, 0
    while row < len(lengths):
        to = max(row + 1, int(np.searchsorted(ends, word + BATCH, side="right")))
        yield row, to, word, int(ends[to - 1])
        row, word = to, int(ends[to - 1])


def sharded(docs: DataFrame, vocab: Vocabulary, shards: int) -> DataFrame:
    """shard, lengths, ids: the texts in the network's numbers; a text's shard is by its hash, however the table is dealt."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            for a, b in in_runs(batch.column(0)):
                words, of = split_words(batch.column(0).slice(a, b - a)), np.asarray(batch.column(1).slice(a, b - a))
                ids, shard = vocab.of(words).astype(np.uint16), np.repeat(of, words.lengths)
                here = np.unique(of[words.lengths > 0])
                lengths = [words.lengths[(of == k) & (words.lengths > 0)].astype(np.int32).tobytes() for k in here]
                yield pa.RecordBatch.from_arrays([pa.array(here, pa.int32()), pa.array(lengths, pa.binary()), pa.array([ids[shard == k].tobytes() for k in here], pa.binary())], names=["shard", "lengths", "ids"])

    rows = docs.select("text", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard")).filter("text IS NOT NULL")
    return rows.mapInArrow(encode, "shard int, lengths binary, ids binary")


def gradient(rows: DataFrame, net: Network) -> tuple[np.ndarray, float] | None:
    """The sum over all words of rows (lengths, ids) of the gradient, and how many words there are; None without any.

    Tasks' sums are added up in levels, so that no step gathers those of all
    tasks; the driver sees one vector of a fixed size.
    """
    parts = 16
    width = -(-Network.size() // parts)
    shared = rows.sparkSession.sparkContext.broadcast(net.flat)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, grad, seen = Network(shared.value), Network(np.zeros(Network.size(), np.float32)), 0
        total = np.zeros(Network.size())
        for batch in batches:
            for lengths, ids in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                lengths, ids = np.frombuffer(lengths, np.int32), np.frombuffer(ids, np.uint16).astype(np.int64)
                for row, to, first, last in _parts(lengths):
                    around = windows(ids[first:last], lengths[row:to])
                    for k in range(first, last, BATCH):
                        log_probs(own, around[k - first : k - first + BATCH], ids[k : min(last, k + BATCH)], grad)
                    seen += last - first
                    total += grad.flat
                    grad.flat[:] = 0
        if seen:
            part = TaskContext.get().partitionId()
            blocks = [total[k * width : (k + 1) * width].tolist() for k in range(parts)]
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([part] * parts, pa.int32()), pa.array([float(seen)] * parts), pa.array(blocks, pa.list_(pa.float64()))], names=["block", "part", "words", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.asarray(v.values) for v in table.column("sums"))
        first = [table.column(k)[0].as_py() for k in ("block", "part")]
        return pa.table([pa.array([first[0]], pa.int32()), pa.array([first[1]], pa.int32()), pa.array([float(sum(table.column("words").to_pylist()))]), pa.array([total], pa.list_(pa.float64()))], names=["block", "part", "words", "sums"])

    schema = "block int, part int, words double, sums array<double>"
    tasks = rows.rdd.getNumPartitions()
    results = rows.select("lengths", "ids").mapInArrow(learn, schema)
    for fan in [x for x in FANS if x == 1 or x < tasks]:
        results = results.withColumn("part", F.pmod("part", F.lit(fan))).groupBy("block", "part").applyInArrow(added, schema)
    found = {r.block: r for r in results.collect()}
    shared.unpersist()
    if len(found) < parts:
        return None
    return np.concatenate([np.array(found[k].sums) for k in range(parts)]), found[0].words


def train(spark: SparkSession, docs: DataFrame, vocab: Vocabulary, counts: np.ndarray, *, shards: int = 16, rounds: int = 1, step: float = 0.1) -> Network:
    """The network after some rounds over all texts, a step a shard.

    Every word of every text is a target once a round.  A step follows the mean
    gradient of a shard of the whole corpus (with momentum, divided by its mean
    size, smaller towards the end), so the network doesn't depend on how many
    tasks there are.
    """
    work = Work(spark, "training")
    path = work.path("shards")
    sharded(docs, vocab, shards).write.partitionBy("shard").parquet(path)
    table = spark.read.schema("lengths binary, ids binary, shard int").parquet(path)
    net = Network.initial(counts)
    mean, square, n, steps = np.zeros(Network.size()), np.zeros(Network.size()), 0, shards * rounds
    for k in range(steps):
        found = gradient(table.filter(F.col("shard") == k % shards), net)
        if found is None:
            continue
        total, words = found
        n += 1
        grad = total / words
        mean, square = 0.8 * mean + 0.2 * grad, 0.95 * square + 0.05 * grad * grad
        rate = step * (1 - 0.9 * k / steps)
        net.flat[:] += (rate * (mean / (1 - 0.8**n)) / (np.sqrt(square / (1 - 0.95**n)) + 1e-7)).astype(np.float32)
    table._work_path = path
    work.drop(table)
    return net


def score(spark: SparkSession, docs: DataFrame, vocab: Vocabulary, net: Network, counts: np.ndarray | None = None, counted: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, log_prob (the sum over all words), mean_log_prob for each row of docs (doc_id, text).

    With counts (of vocabulary) and counted (word, n) a bucketed word's
    log-probability is its bucket's plus log n / the bucket's count, where a word
    that counted lacks is taken as seen once; without them it is its bucket's.

    Null texts and texts without a word have 0 words, log_prob 0 and no mean.
    Null doc_ids and repeated rows are kept as they are; other columns are not
    looked at.
    """
    whole = counted is not None
    low = SIZE - BUCKETS
    shared = spark.sparkContext.broadcast((vocab, net.flat, np.log(np.maximum(counts[low:], 1)) if whole else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab, flat, logs = shared.value
        net = Network(flat)
        # a block is a run of rows; its first row carries the block's distinct bucketed words, the rows their numbers
        block = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            for a, b in in_runs(batch.column(1)):
                block += 1
                doc_ids, words = batch.column(0).slice(a, b - a), split_words(batch.column(1).slice(a, b - a))
                ids, total = vocab.of(words), np.zeros(b - a)
                for row, to, first, last in _parts(words.lengths):
                    if first == last:
                        continue
                    own, lengths = ids[first:last], words.lengths[row:to]
                    around = windows(own, lengths)
                    found = np.concatenate([log_probs(net, around[k : k + BATCH], own[k : k + BATCH]) for k in range(0, len(own), BATCH)]).astype(np.float64)
                    if whole:
                        found[own >= low] -= logs[own[own >= low] - low]
                    full = np.flatnonzero(lengths > 0)
                    total[row + full] = np.add.reduceat(found, (np.cumsum(lengths) - lengths)[full])
                if not whole:
                    yield _scores(doc_ids, words.lengths, total)
                    continue
                rare = ids >= low
                used, numbers = np.unique(words.at[rare], return_inverse=True)
                ends = np.concatenate([[0], np.cumsum(rare)])[np.concatenate([[0], np.cumsum(words.lengths)])]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32()))
                fresh = [[words.distinct[i] for i in used]] + [None] * (b - a - 1)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.array(words.lengths, pa.int64()), pa.array(total), pa.array([block] * (b - a), pa.int64()), pa.array(fresh, pa.list_(pa.string())), lists], names=["doc_id", "n_words", "log_prob", "block", "fresh", "rare"])

    schema = "doc_id long, n_words long, log_prob double"
    docs = docs.select("doc_id", "text")
    if not whole:
        return docs.mapInArrow(run, schema + ", mean_log_prob double")
    rows = Work(spark, "pseudo-likelihood").save(docs.mapInArrow(run, schema + ", block long, fresh array<string>, rare array<int>"), "rows")
    words = rows.select(F.col("block").alias("of"), F.posexplode("fresh").alias("number", "word"))
    # a word seen once has log n = 0
    found = words.join(counted.filter("n > 1").hint("merge"), "word").select("of", "number", F.log("n").alias("log_n"))

    def add(rows: pa.Table, found: pa.Table) -> pa.Table:
        rare = rows.column("rare").combine_chunks()
        numbers = np.asarray(rare.flatten())
        logs = np.zeros(int(numbers.max(initial=-1)) + 1)
        logs[np.asarray(found.column("number"))] = np.asarray(found.column("log_n"))
        lengths = np.asarray(rare.value_lengths())
        total = np.asarray(rows.column("log_prob")) + np.bincount(np.repeat(np.arange(len(lengths)), lengths), logs[numbers], len(lengths))
        return pa.Table.from_batches([_scores(rows.column("doc_id").combine_chunks(), np.asarray(rows.column("n_words")), total)])

    return rows.select("doc_id", "n_words", "log_prob", "block", "rare").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(add, schema + ", mean_log_prob double")


def _scores(doc_ids: pa.Array, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    mean = [t / k if k else None for t, k in zip(total.tolist(), n.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(n), pa.array(total), pa.array(mean, pa.float64())], names=["doc_id", "n_words", "log_prob", "mean_log_prob"])


def score_corpus(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Counts, trains and scores; see count_words, vocabulary, train and score."""
    counted = Work(spark, "word-counts").save(count_words(docs), "words")
    vocab, counts = vocabulary(docs, counted)
    return score(spark, docs, vocab, train(spark, docs, vocab, counts), counts, counted)
