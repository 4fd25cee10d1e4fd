"""Language of the words of code-switched text: a linear-chain conditional random field.

A word's score for a language is the sum of the weights of its features (the
word itself as a lexicon entry, affixes, letter n-grams); learned transitions
join neighbouring words, and forward-backward gives each word's posterior.  A
document's language is the one with the highest mean posterior.

Posteriors add up to 1 over the learned languages, whatever the text.  Whether it
is in any of them is told by its fit: how likely its words' letters are, each
word in the language that suits it best, against held-out rows.

Learning takes a bounded sample of labelled rows and cuts it into spans that it
strings together across languages, so that switches occur; labelling takes
every word of every text.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, per_worker

BUCKETS = 1 << 16
#: Words whose scores a worker keeps.
KEPT_WORDS = 300_000
#: Words that are labelled together.
BATCH_WORDS = 1_000_000
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case; a run without any letter (as of superscript digits) is none."""
    found = _WORD.findall((text or "").lower())
    return found if all(x.isalpha() for x in found) else [x for x in found if any(map(str.isalpha, x))]


def features(word: str) -> list[int]:
    """Hashed: the word, its prefixes and suffixes of 1 to 3 letters, its n-grams of 2 and 3 with its ends marked."""
    ends = f"^{word[:40]}$"
    names = ["=" + word, *("<" + word[:k] for k in (1, 2, 3)), *(">" + word[-k:] for k in (1, 2, 3))]
    names += [ends[i : i + 2] for i in range(len(ends) - 1)]
    names += [ends[i : i + 3] for i in range(len(ends) - 2)]
    return [zlib.crc32(x.encode()) % BUCKETS for x in names]


@dataclass
class Packed:
    """Sequences of different lengths laid out step by step, the longest first."""

    lengths: np.ndarray
    order: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)
    begin: np.ndarray = field(init=False)

    def __post_init__(self):
        n = len(self.lengths)
        self.order = np.argsort(-self.lengths, kind="stable")
        ordered = self.lengths[self.order]
        longest = int(ordered[0]) if n else 0
        alive = np.searchsorted(-ordered, -np.arange(longest), side="left")
        self.begin = np.concatenate([[0], np.cumsum(alive)]).astype(np.int64)
        rank = np.empty(n, np.int64)
        rank[self.order] = np.arange(n)
        first = np.cumsum(self.lengths) - self.lengths
        step = np.arange(int(self.lengths.sum())) - np.repeat(first, self.lengths)
        #: Of each word, sequence after sequence.
        self.place = self.begin[step] + np.repeat(rank, self.lengths)


def posteriors(scores: np.ndarray, transition: np.ndarray, packed: Packed) -> np.ndarray:
    """Forward-backward over packed words; scores (words, labels), scaled at each step."""
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    move = np.exp(transition - transition.max())
    begin = packed.begin
    ahead = np.empty_like(emit)
    for t in range(len(begin) - 1):
        a, b = begin[t], begin[t + 1]
        x = emit[a:b] if t == 0 else (ahead[begin[t - 1] : begin[t - 1] + b - a] @ move) * emit[a:b]
        ahead[a:b] = x / x.sum(axis=1, keepdims=True)
    back = np.ones_like(emit)
    for t in range(len(begin) - 3, -1, -1):
        c, d = begin[t + 1], begin[t + 2]
        x = (emit[c:d] * back[c:d]) @ move.T
        back[begin[t] : begin[t] + d - c] = x / x.sum(axis=1, keepdims=True)
    both = ahead * back
    return both / both.sum(axis=1, keepdims=True)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray
    transition: np.ndarray
    #: Log-probabilities of hashed letter trigrams by label.
    trigrams: np.ndarray | None = None
    #: Median of held-out rows' means, variance of these, and of words within rows; None: too few rows to tell.
    usual: tuple[float, float, float] | None = None


def familiarity(trigrams: np.ndarray, each: list[list[int]], words: list[str]) -> np.ndarray:
    """Mean log-probability of each word's trigrams in the label that suits it best; each are its features."""
    threes = [x[-min(len(w), 40) :] for x, w in zip(each, words, strict=True)]
    sizes = np.array([len(x) for x in threes])
    sums = np.add.reduceat(trigrams[np.array([y for x in threes for y in x], np.int64)], np.cumsum(sizes) - sizes)
    return (sums / sizes[:, None]).max(axis=1)


def fit_trigrams(samples: list[tuple[str, str]], labels: list[str], least_rows: int = 20) -> tuple[np.ndarray, tuple[float, float, float] | None]:
    """Trigrams of three rows in four of each label, and what is usual in the fourth."""
    counts, held, seen = np.full((BUCKETS, len(labels)), 0.5), [], dict.fromkeys(labels, 0)
    for text, label in samples:
        words = words_of(text)
        seen[label] += 1
        if not words:
            continue
        if seen[label] % 4 == 0:
            held.append(words)
        else:
            flat = [y for w in words for y in features(w)[-min(len(w), 40) :]]
            counts[:, labels.index(label)] += np.bincount(np.array(flat, np.int64), minlength=BUCKETS)
    trigrams = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    if len(held) < least_rows:
        return trigrams, None
    rows = [familiarity(trigrams, [features(w) for w in words], words).astype(np.float64) for words in held]
    means = np.array([x.mean() for x in rows])
    usual = float(np.median(means))
    between = (1.4826 * float(np.median(np.abs(means - usual)))) ** 2
    within = float(np.median([x.var() for x in rows if len(x) > 1] or [0.0]))
    return trigrams, (usual, between, within)


def gradient(weights: np.ndarray, transition: np.ndarray, flat: np.ndarray, first: np.ndarray, ids: np.ndarray, gold: np.ndarray, packed: Packed) -> tuple[np.ndarray, np.ndarray]:
    """Of the conditional log-likelihood: observed minus expected counts.

    flat, first: the features of each distinct word; ids, gold: distinct word
    and label of each packed word.
    """
    labels = weights.shape[1]
    table = np.add.reduceat(weights[flat], first) if len(first) else np.zeros((0, labels))
    scores = table[ids]
    expected = posteriors(scores, transition, packed)
    off = -expected
    off[np.arange(len(gold)), gold] += 1
    by_word = np.stack([np.bincount(ids, off[:, k], len(first)) for k in range(labels)], axis=1)
    each = np.repeat(by_word, np.diff(np.append(first, len(flat))), axis=0)
    for_weights = np.stack([np.bincount(flat, each[:, k], len(weights)) for k in range(labels)], axis=1)
    # transitions: pairs of neighbours
    begin, move = packed.begin, np.exp(transition - transition.max())
    for_moves = np.zeros_like(transition)
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    # expected pairs from the forward and backward messages that posteriors implies: p(i, j) = f_i m_ij e_j b_j
    ahead = np.empty_like(emit)
    for t in range(len(begin) - 1):
        a, b = begin[t], begin[t + 1]
        x = emit[a:b] if t == 0 else (ahead[begin[t - 1] : begin[t - 1] + b - a] @ move) * emit[a:b]
        ahead[a:b] = x / x.sum(axis=1, keepdims=True)
    for t in range(1, len(begin) - 1):
        a, b = begin[t], begin[t + 1]
        p = begin[t - 1]
        before = ahead[p : p + b - a]
        # given the word's own posterior, its neighbour in front is independent of what follows
        reach = before @ move
        share = expected[a:b] / np.maximum(reach, 1e-30)
        for_moves -= move * (before.T @ share)
        np.add.at(for_moves, (gold[p : p + b - a], gold[a:b]), 1)
    return for_weights, for_moves


def fit(samples: list[tuple[str, str]], *, rounds: int = 30, sequence: int = 120, seed: int = 7) -> Model:
    """Learns from (text, label) pairs; their order doesn't matter."""
    rng = np.random.default_rng(seed)
    samples = sorted(samples)
    labels = sorted({label for _, label in samples})
    trigrams, usual = fit_trigrams(samples, labels)
    if len(labels) < 2:
        return Model(labels, np.zeros((BUCKETS, len(labels)), np.float32), np.zeros((len(labels), len(labels)), np.float32), trigrams, usual)
    known: dict[str, int] = {}
    spans: list[tuple[int, list[int]]] = []
    for text, label in samples:
        words = [known.setdefault(x, len(known)) for x in words_of(text)]
        at = 0
        while at < len(words):
            size = int(rng.integers(4, 40))
            spans.append((labels.index(label), words[at : at + size]))
            at += size
    rng.shuffle(spans)
    ids, gold, lengths, size = [], [], [], 0
    for label, words in spans:
        ids += words
        gold += [label] * len(words)
        size += len(words)
        if size >= sequence:
            lengths.append(size)
            size = 0
    if size:
        lengths.append(size)
    packed = Packed(np.array(lengths, np.int64))
    by_place = np.empty((2, len(ids)), np.int64)
    by_place[0, packed.place], by_place[1, packed.place] = ids, gold
    each = [features(x) for x in known]
    flat = np.array([y for x in each for y in x], np.int64)
    first = np.concatenate([[0], np.cumsum([len(x) for x in each])[:-1]]).astype(np.int64)
    weights, moves = np.zeros((BUCKETS, len(labels))), np.zeros((len(labels), len(labels)))
    sums = [np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)]
    for _ in range(rounds):
        for x, g, total, decay in zip((weights, moves), gradient(weights, moves, flat, first, by_place[0], by_place[1], packed), sums, (1e-3, 0), strict=True):
            g -= decay * x
            total += g * g
            x += 0.3 * g / np.sqrt(total)
    return Model(labels, weights.astype(np.float32), moves.astype(np.float32), trigrams, usual)


class _Words(dict):
    """Numbers of words in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.names: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        return n

    def forget(self, keep: int) -> None:
        for word in self.names[keep:]:
            del self[word]
        del self.names[keep:]


class Labeller:
    def __init__(self, model: Model):
        self.model = model
        self.words = _Words()
        #: Scores by number.
        self.table = np.zeros((0, len(model.labels)), np.float32)
        self.known = np.zeros(0, np.float32)

    def _score_new(self) -> None:
        parts, known = [self.table], [self.known]
        for at in range(len(self.table), len(self.words.names), 10_000):
            names = self.words.names[at : min(at + 10_000, len(self.words.names))]
            each = [features(x) for x in names]
            first = np.concatenate([[0], np.cumsum([len(x) for x in each])[:-1]]).astype(np.int64)
            parts.append(np.add.reduceat(self.model.weights[np.array([y for x in each for y in x], np.int64)], first))
            known.append(familiarity(self.model.trigrams, each, names))
        if len(parts) > 1:
            self.table, self.known = np.concatenate(parts), np.concatenate(known)

    def word_posteriors(self, texts: list[list[str] | np.ndarray]) -> tuple[np.ndarray, Packed]:
        """Of all words, text after text; a text is its words or their numbers."""
        found, packed, _ = self._words(texts)
        return found, packed

    def _words(self, texts: list[list[str] | np.ndarray]) -> tuple[np.ndarray, Packed, np.ndarray]:
        """Posteriors and familiarity of all words."""
        numbers = [x if isinstance(x, np.ndarray) else self.numbers(x) for x in texts]
        self._score_new()
        packed = Packed(np.array([len(x) for x in numbers], np.int64))
        scores = np.empty((int(packed.lengths.sum()), self.table.shape[1]), np.float32)
        flat = np.concatenate(numbers)
        scores[packed.place], known = self.table[flat], self.known[flat]
        found = posteriors(scores, self.model.transition, packed)[packed.place]
        if len(self.words) > KEPT_WORDS:
            self.words.forget(KEPT_WORDS)
            self.table, self.known = self.table[:KEPT_WORDS].copy(), self.known[:KEPT_WORDS].copy()
        return found, packed, known

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, mean posterior and fit of each text.

        The fit is how many standard deviations of held-out rows the mean
        familiarity of its words lies above theirs; 0 if nothing tells.
        """
        names, scores, fits = [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        if not self.model.labels:
            return names, scores, fits
        run: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, text in enumerate([*texts, None]):
            if i == len(texts) or size >= BATCH_WORDS:
                if run:
                    found, packed, known = self._words([x for _, x in run])
                    first = np.cumsum(packed.lengths) - packed.lengths
                    means = np.add.reduceat(found, first) / packed.lengths[:, None]
                    if self.model.usual:
                        usual, between, within = self.model.usual
                        own = np.add.reduceat(known.astype(np.float64), first) / packed.lengths
                        for (j, _), z in zip(run, (own - usual) / np.sqrt(between + within / packed.lengths + 1e-9), strict=True):
                            fits[j] = float(z)
                    for (j, _), mean in zip(run, means, strict=True):
                        top = int(mean.argmax())
                        names[j], scores[j] = self.model.labels[top], min(1.0, max(0.0, float(mean[top])))
                run, size = [], 0
            if i < len(texts) and (words := words_of(text)):
                run.append((i, self.numbers(words)))
                size += len(words)
        return names, scores, fits


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from; a null doc_id is none of them, and isn't learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, *, per_label: int = 300, most_chars: int = 4000) -> Model:
    """Learns from docs (doc_id, text, lang).

    The sample is up to per_label rows of every lang, however many there are,
    the first by a hash of the doc_id; of a text longer than most_chars it is a
    stretch of that length, at a place by the hash.  Rows that repeat doc_id, lang
    and text count once.  Only rows with doc_id, text and lang whose
    crc32(doc_id) mod 4 is not 2 are looked at.
    """
    usable = docs.select("doc_id", "text", "lang").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text <> ''").filter(~held_out())
    usable = usable.withColumns({"h": F.xxhash64("doc_id"), "t": F.xxhash64("text")})
    # distinct ids, so that a doc_id with many rows takes no other's place; one row for each language, as the model has
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    if not sizes:
        return fit([])
    known = F.create_map(*[F.lit(x) for pair in sorted(sizes.items()) for x in pair])
    near = usable.filter(F.pmod("h", F.lit(1_000_000)) * F.element_at(known, F.col("lang")) < 1.5e6 * per_label)
    keys = near.select("lang", "h", "doc_id", "t").distinct()
    keys = keys.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "t"))).filter(F.col("_n") <= per_label).drop("_n")
    begin = F.pmod("h", F.greatest(F.char_length("text") - most_chars + 1, F.lit(1))).cast("int") + 1
    rows = near.join(F.broadcast(keys), ["lang", "h", "doc_id", "t"]).groupBy("lang", "h", "doc_id", "t").agg(F.min(F.substr("text", begin, F.lit(most_chars))).alias("text")).collect()
    return fit([(r.text, r.lang) for r in rows])


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType())])


def labelled(spark: SparkSession, docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """docs, all columns, with a struct (lang_pred, score, fit) made of the text alone.

    A null text, or one without a letter, is ``und`` with score and fit 0.  A column of
    that name is replaced.
    """
    shared, run = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = per_worker(("labeller", run), lambda: Labeller(shared.value))
        for texts in batches:
            names, scores, fits = labeller.label([x if isinstance(x, str) else None for x in texts])
            yield pd.DataFrame({"lang_pred": names, "score": scores, "fit": fits})

    return docs.drop(name).withColumn(name, predict("text"))


def keep_written(spark: SparkSession, docs: DataFrame, *, least_fit: float = -8.0) -> DataFrame:
    """docs without those that no learned language fits: undetermined, or of a lower fit.

    The fit takes each word in the language that suits it best, so it doesn't
    depend on their number, and a text that switches between languages stays.
    Where no language is learned, nothing tells, and every row stays.
    """
    model = learn(docs)
    if not model.labels:
        return docs
    name = free_name(docs, "_language")
    kept = labelled(spark, docs, model, name).filter((F.col(f"{name}.lang_pred") != UNDETERMINED) & (F.col(f"{name}.fit") >= least_fit))
    return kept.drop(name)
