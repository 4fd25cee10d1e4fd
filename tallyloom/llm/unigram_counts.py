"""Token counts of a unigram tokenizer without its tokens: a count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary's matches in a word; for
each place the best score and the number of pieces of the best path are
carried, not the path.  Ties go as in the ``tokenizers`` library: a later
candidate has to be better, and candidates come by where they begin, so of
equal ones the longest piece stays.  A character that no piece covers alone
costs ``UNKNOWN_PENALTY`` below the lowest score and, with byte fallback, counts
as its UTF-8 bytes.  Words repeat, so a worker keeps the results of those it has
seen, up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_worker

#: Fixed values of the tokenizer's rules.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0

KEPT_WORDS = 300_000


class UnigramCounter(dict):
    """Word to (pieces, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and piece not in self.automaton:
                self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.viterbi(word)
        if len(self) < KEPT_WORDS and len(word) <= 40:
            self[word] = found
        return found

    def viterbi(self, word: str) -> tuple[int, float]:
        """Pieces and score of a word's best segmentation."""
        best: list[float] = [0.0]
        count = [0]
        matches: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, match in self.automaton.iter(word):
            matches[end].append(match)
        for end, found in enumerate(matches):
            top, pieces, alone = None, 0, False
            for size, score in found:  # the longest first: it begins first
                alone = alone or size == 1
                candidate = score + best[end + 1 - size]
                if top is None or candidate > top:
                    top, pieces = candidate, count[end + 1 - size] + 1
            if not alone:
                candidate = self.unknown + best[end]
                if top is None or candidate > top:
                    top, pieces = candidate, count[end] + len(word[end].encode("utf-8", "surrogatepass"))
            best.append(top)
            count.append(pieces)
        return count[-1], best[-1]

    def count(self, text: str | None) -> tuple[int, float]:
        """Of a text: its words each begin with a space mark, the first too."""
        if not text:
            return 0, 0.0
        marked = text.replace(" ", SPACE)
        words = marked[1:].split(SPACE) if marked[0] == SPACE else marked.split(SPACE)
        pieces, total = 0, 0.0
        for n, score in map(self.__getitem__, [SPACE + x for x in words]):
            pieces += n
            total += score
        return pieces, total


def counter(model_file: str) -> UnigramCounter:
    """One for each worker process: the pieces and scores as the model file lists them."""
    return per_worker(("unigram", model_file), lambda: UnigramCounter(pieces_of(model_file)))


def pieces_of(model_file: str) -> list[tuple[str, float]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, score for each row of docs (doc_id, text).

    Null and empty texts have 0 tokens and score 0.  Null doc_ids and repeated
    rows are kept as they are; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_file).count
        for batch in batches:
            found = [count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, score double")
