"""License scans: how much a license's wording helps to compress a block.

Runs of neighbouring lines around those that could speak of a license, joined
across line breaks, are cut into overlapping blocks of a few times a template's
length.  A block is compressed by itself and with each template as raw
dictionary; templates are ranked by what they save, and only those that save a
good part of what they save on themselves are held against the block's words:
the exact differences in wording confirm a winner and tell where it stands.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_BSD_2 = f"{_BSD}: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
#: Whole texts, opening passages and short notices of public licenses; ``#`` stands for a version or a year.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version #."),
    ("apache", "under the Apache License #"),
    ("apache-notice", "Licensed under the Apache License, Version # (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Released under the MIT License."),
    ("mit", "under the MIT License"),
    ("mit-notice", _MIT),
    ("mit-text", f"{_MIT}, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("gpl", "This work is licensed under the GNU General Public License, version #."),
    ("gpl", "under the GNU General Public License"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version # of the License, or (at your option) any later version."),
    ("bsd", "under the BSD License"),
    ("bsd-notice", _BSD),
    ("bsd-2-text", f"{_BSD_2} {_BSD_END}"),
    ("bsd-3-text", f"{_BSD_2} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. #."),
    ("mpl", "under the Mozilla Public License"),
    ("isc", "under the ISC License"),
    ("isc-notice", _ISC),
    ("isc-text", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("cc-by", "Licensed under CC BY #."),
    ("cc-by-sa", "Licensed under CC BY-SA #."),
    ("cc-by-nc", "Licensed under CC BY-NC #."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA #."),
    ("cc-by-nd", "Licensed under CC BY-ND #."),
    ("all-rights-reserved", "Copyright # All rights reserved."),
)
#: Fixed value: a line with none of these is no candidate.
CANDIDATE = r"(?i)licen[sc]e|copyright|permission|redistribut|public domain|rights reserved|free software|creative commons|\bCC BY"

_KEY = re.compile(CANDIDATE)
#: Marks of a comment at a line's beginning.
_MARK = re.compile(r"^\s*(?:#+|//+|/?\*+/?|--+|;+|%+|dnl\b|rem\b)(?:\s+|$)", re.IGNORECASE)
#: Words that may stand between those of a template, at most, and at most as many as it has; lines further off are another block.
SLACK = 64
#: The share of what a template saves on itself that it has to save on a block.
LEAST_SAVING = 0.3
#: Templates are asked about blocks after their lengths: up to so many words, or more.
CLASSES = (5, 8, 16, 48)
#: Level of all compressions: below 0 letters stay as they are, so that a saving is what matches save and no byte of chance.
COMPRESSION = -1
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)*|#")
_VERSION = re.compile(r"\d+(?:[.\-]\d+)*")
_NUMBER = re.compile(f"#|{_VERSION.pattern}")


def wording(text: str) -> str:
    """In lower case, numbers as ``#``, single spaces."""
    return " ".join(_VERSION.sub("#", text.lower().replace("(c)", "copyright")).split())


@dataclass(frozen=True)
class Template:
    number: int
    name: str
    words: list[str]
    compressor: object
    #: Bytes that a block has to save with it.
    least: float
    slack: int


def _compressor(kept=None):
    import zstandard

    return zstandard.ZstdCompressor(level=COMPRESSION, write_content_size=False, dict_data=kept)


def _size(compressor, text: str) -> int:
    return len(compressor.compress(text.encode()))


@lru_cache(maxsize=1)
def _prepared() -> tuple[object, list[tuple[int, list[Template]]]]:
    """A compressor without dictionary, and the templates by the words that their blocks have."""
    import zstandard

    plain, found = _compressor(), []
    for k, (name, template) in enumerate(TEMPLATES):
        words = _WORD.findall(wording(template))
        text = " ".join(words)
        kept = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        kept.precompute_compress(level=COMPRESSION)
        own = _compressor(kept)
        found.append(Template(k, name, words, own, LEAST_SAVING * (_size(plain, text) - _size(own, text)), min(SLACK, len(words))))
    classes = [[t for t in found if bisect_left(CLASSES, len(t.words)) == k] for k in range(len(CLASSES) + 1)]
    # half a block holds any wording that a template fits, so one of two overlapping blocks has it whole
    return plain, [(2 * max(len(t.words) + t.slack for t in ts), ts) for ts in classes if ts]


def _may_fit(template: list[str], words: list[str], least_cover: float) -> bool:
    own = set(template)
    return len(own.difference(words)) <= (1 - least_cover) * len(template) + 1e-9


def _places(template: Template, words: list[str], least_cover: float) -> Iterator[tuple[list[int], list[str], list[str]]]:
    """(places of its words, missing words, added words) of each place of a block that a template fits.

    Its words stand there in order up to the share least_cover, and nothing that
    they are about is denied: no other license's letters (as the -sa of cc
    by-sa) stand where they end.
    """
    own = template.words
    matcher = difflib.SequenceMatcher(None, [], own, autojunk=False)
    open_ = [(0, len(words))]
    while open_:
        low, high = open_.pop()
        # template is the second sequence, so that its index is made once
        if not _may_fit(own, words[low:high], least_cover):
            continue
        matcher.set_seq1(words[low:high])
        at, in_template, size = matcher.find_longest_match()
        if not size:
            continue
        begin = max(low, low + at - in_template - template.slack)
        end = min(high, low + at + len(own) - in_template + template.slack)
        codes = difflib.SequenceMatcher(None, own, words[begin:end], autojunk=False).get_opcodes()
        same = [begin + k for op, _, _, c, d in codes if op == "equal" for k in range(c, d)]
        missing = [w for op, a, b, _, _ in codes if op in ("replace", "delete") for w in own[a:b]]
        first, last = (same[0], same[-1] + 1) if same else (0, 0)
        fits = len(same) >= least_cover * len(own) and not (len(own) < 12 and any(len(x) <= 8 and x not in ("the", "a", "an") for x in missing))
        if fits:
            added = [w for op, _, _, c, d in codes if op in ("replace", "insert") for w in words[max(begin + c, first) : min(begin + d, last)]]
            yield same, missing, added
            open_ += [(low, first), (last, high)]
        else:
            # nothing fits around the longest common run
            open_ += [(low, low + at), (low + at + size, high)]


@lru_cache(maxsize=4096)
def _confirmed(kind: int, block: tuple[str, ...], least_cover: float) -> list[tuple[Template, list[int], list[str], list[str]]]:
    """The places in a block of the templates that save enough on it, those that save most first; equal blocks are asked once."""
    plain, classes = _prepared()
    text = " ".join(block)
    own = _size(plain, text)
    ranked = sorted(((own - _size(t.compressor, text), t) for t in classes[kind][1]), key=lambda x: (-x[0], x[1].number))
    return [(t, *place) for saved, t in ranked if saved > 0 and saved >= t.least for place in _places(t, list(block), least_cover)]


def _found(lines: list[str], least_cover: float) -> list[tuple]:
    """(first line, *fields) of every confirmed template of a run of lines, in the order of the lines."""
    words, line_of, numbers, begins = [], [], [], [0]
    for k, line in enumerate(lines):
        bare = _MARK.sub("", line)
        own = _WORD.findall(wording(bare))
        words += own
        begins.append(len(words))
        found = iter(_NUMBER.findall(bare))
        numbers += [next(found) if x == "#" else None for x in own]
        line_of += [k] * len(own)
    plain, classes = _prepared()
    sizes: dict[tuple[int, str], tuple[int, int]] = {}
    fits = {}
    for kind, (span, _) in enumerate(classes):
        for low in range(0, max(1, len(words) - span // 2), span // 2):
            for template, same, missing, added in _confirmed(kind, tuple(words[low : low + span]), least_cover):
                same = [low + x for x in same]
                if (template.number, *same) in fits:
                    continue
                a, b = line_of[same[0]], line_of[same[-1]]
                text = " ".join(words[begins[a] : begins[b + 1]])
                if (template.number, text) not in sizes:
                    sizes[template.number, text] = _size(plain, text), _size(template.compressor, text)
                own, kept = sizes[template.number, text]
                if own > kept:
                    version = next((numbers[x] for x in same if words[x] == "#" and numbers[x] != "#"), None)
                    fits[template.number, *same] = (own - kept, len(template.words), -template.number, same, (a, template.name, version, own, own - kept, len(same) / len(template.words), missing, added))
    out, taken = [], set()
    for _, _, _, same, fields in sorted(fits.values(), key=lambda x: (-x[0], -x[1], -x[2], x[3])):
        # a wording within a confirmed one tells nothing more
        if not taken.issuperset(same):
            taken.update(same)
            out.append((same[0], fields))
    return [fields for _, fields in sorted(out, key=lambda x: x[0])]


def scan_block(block: str, least_cover: float = 0.9) -> tuple | None:
    """(license, version, plain size, saved, cover, missing words, added words) of the winner of a block, or None.

    Winners are those that save most, then those of more words, then the list's
    first.
    """
    found = _found(block.split("\n"), least_cover)
    return max(found, key=lambda x: x[4])[1:] if found else None


def scan_text(text: str, least_cover: float = 0.9) -> list[tuple]:
    """(line, license, version, ...) of every confirmed template of a text's blocks; its line from 0 is the first of the wording."""
    lines = text.split("\n")
    keys = [k for k, line in enumerate(lines) if _KEY.search(line)]
    if not keys:
        return []
    reach = max(span for span, _ in _prepared()[1]) // 2
    sizes = [len(line.split()) for line in lines]
    runs: list[list[int]] = []
    for k in keys:
        low, n = k, 0
        while low > 0 and n < reach:
            low -= 1
            n += sizes[low]
        high, n = k + 1, 0
        while high < len(lines) and n < reach:
            n += sizes[high]
            high += 1
        if runs and low <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], high)
        else:
            runs.append([low, high])
    return [(low + line, *rest) for low, high in runs for line, *rest in _found(lines[low:high], least_cover)]


FIELDS = [("doc_id", pa.int64()), ("block", pa.int32()), ("license", pa.string()), ("version", pa.string()), ("plain_bytes", pa.int64()), ("saved_bytes", pa.int64()), ("cover", pa.float64()), ("missing", pa.list_(pa.string())), ("added", pa.list_(pa.string()))]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each confirmed wording of docs (doc_id, text): doc_id, block (its first line from 0), license, version, plain_bytes, saved_bytes, cover, missing, added.

    Null and empty texts give none.  Null doc_ids and repeated rows are kept as
    they are; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                rows += [(doc_id, *found) for found in scan_text(text)]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in FIELDS]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, FIELDS, strict=True)], names=[n for n, _ in FIELDS])

    candidates = docs.select("doc_id", "text").filter(F.col("text").rlike(CANDIDATE))
    return candidates.mapInArrow(run, "doc_id long, block int, license string, version string, plain_bytes long, saved_bytes long, cover double, missing array<string>, added array<string>")
