"""Whole texts to token ids with a file of the ``tokenizers`` library.

A byte-level BPE cuts a text into pre-tokens before it merges bytes.  So a text
can be cut where pre-tokens end whatever stands around them (in front of a space
behind anything but white space, say), and each piece encoded by itself, with
the same ids.  Pieces repeat: those of a run of texts are made distinct first,
and the library gets only those that the worker hasn't seen.

Ids are those that the library gives by default: the string of an added token
inside a text is that token.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import per_worker

#: Pieces that a worker keeps, about 200 bytes each; then it begins anew.
KEPT_PIECES = 700_000
#: Longer pieces are not kept.
KEPT_LENGTH = 40
#: Characters of texts that are encoded together.
RUN_CHARS = 8_000_000

_CUT = re.compile("(?<=[^\\s\u180e])(?= )")
#: Texts with these are cut by _CUT alone: white space in front of a space, and the separator.
_ODD = r"[\s\v\x{1c}-\x{1f}\x{85}\x{180e}\p{Z}] |\x00"
#: Letters and digits of any Unicode version.
_WORD = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SEPARATE = (("([" + _WORD + "])([.,;:!?)])", "\\1\x00\\2"), ("(\\S)\n([" + _WORD + "])", "\\1\x00\n\x00\\2"))


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level BPE names each byte: printable bytes by themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class TextEncoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = t = Tokenizer.from_file(path)
        added = t.get_added_tokens_decoder().values()
        if t.normalizer or not isinstance(t.pre_tokenizer, pre_tokenizers.ByteLevel) or not isinstance(t.model, models.BPE) or t.pre_tokenizer.add_prefix_space:
            raise ValueError(f"{path}: a byte-level BPE without normalizer and prefix space is asked for")
        if any(x.lstrip or x.rstrip or x.single_word or not re.search(r"\W", x.content) or re.search(r"[\s.,;:!?)\x00]", x.content) for x in added):
            raise ValueError(f"{path}: an added token could stand across pieces")
        self.model, self.letters = t.model, _byte_letters()
        self.known: dict[str, bytes] = {}

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Of pieces that aren't known: a word is one pre-token, the rest goes through the whole library."""
        found: list[list[int] | None] = []
        for x in pieces:
            if (x[1:] if x[:1] == " " else x).isalpha() and max(x) < "\u0250":
                found.append([y.id for y in self.model.tokenize(x.encode().decode("latin1").translate(self.letters) if not x.isascii() else x.replace(" ", "\u0120"))])
            else:
                found.append(None)
        rest = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            found[i] = x.ids
        ends = np.cumsum([len(x) for x in found]) * 4
        raw = np.fromiter((i for x in found for i in x), "<u4", int(ends[-1]) // 4 if len(ends) else 0).tobytes()
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if found else []

    def _of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        found = list(map(self.known.get, pieces))
        missing = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(missing, self._new([pieces[i] for i in missing]), strict=True):
            found[i] = ids
            if len(pieces[i]) <= KEPT_LENGTH:
                self.known[pieces[i]] = ids
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and how many each has; a null has none."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.asarray(pc.match_substring_regex(texts, _ODD))
        cut = pc.replace_substring(texts.filter(pa.array(~odd)), " ", "\x00 ")
        for pattern, separated in _SEPARATE:
            cut = pc.replace_substring_regex(cut, pattern, separated)
        lists = pc.split_pattern(cut, "\x00")
        if odd.any():
            rows = np.empty(len(odd), np.int64)
            rows[~odd], rows[odd] = np.arange((~odd).sum()), (~odd).sum() + np.arange(odd.sum())
            lists = pa.concat_arrays([lists, pa.array([_CUT.split(x) for x in texts.filter(pa.array(odd)).to_pylist()], lists.type)]).take(pa.array(rows))
        begins = np.asarray(lists.offsets)
        distinct = lists.values.slice(begins[0], begins[-1] - begins[0]).dictionary_encode()
        found, at = self._of(distinct.dictionary.to_pylist()), np.asarray(distinct.indices)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        n = sizes[at]
        upto = np.concatenate([[0], np.cumsum(n)])
        # where each id lies in the pieces' ids
        source = np.repeat((np.cumsum(sizes) - sizes)[at] - upto[:-1], n)
        source += np.arange(len(source))
        return np.frombuffer(b"".join(found), "<u4")[source], np.diff(upto[begins - begins[0]])


def encoder(path: str) -> TextEncoder:
    """One for each worker process."""
    return per_worker(("encoder", path), lambda: TextEncoder(path))


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and lengths with end_id behind each text."""
    longer = lengths + 1
    out = np.empty(int(longer.sum()), "<u4")
    last = np.cumsum(longer) - 1
    inside = np.ones(len(out), bool)
    inside[last] = False
    out[inside], out[last] = ids, end_id
    return out, longer


def in_runs(texts: pa.Array, most_chars: int | None = None) -> Iterator[tuple[int, int]]:
    """Index ranges of texts that together are no longer than most_chars, or one text."""
    most_chars = most_chars or RUN_CHARS
    sizes = np.asarray(pc.fill_null(pc.utf8_length(texts), 0), np.int64)
    start, chars = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and chars + size > most_chars:
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(sizes):
        yield start, len(sizes)
