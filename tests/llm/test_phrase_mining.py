import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import phrase_mining as pm

SCHEMA = "doc_id long, text string, lang string, n string, score string"


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for k in range(len(words) - m + 1):
                    f[lang, tuple(words[k : k + m])] += 1
    longer = {}
    found = {(lang, g): a for (lang, g), a in f.items() if len(g) > 1 and a >= least}
    for (lang, g), a in found.items():
        for m in range(2, len(g)):
            for k in range(len(g) - m + 1):
                longer[lang, g[k : k + m]] = max(a, longer.get((lang, g[k : k + m]), 0))
    out = []
    for (lang, g), a in found.items():
        if 100 * longer.get((lang, g), -1) >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    ranked = []
    for lang in {x[0] for x in out}:
        rows = sorted(x[1:] for x in out if x[0] == lang)[:top]
        ranked += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(rows, 1)]
    return sorted(ranked)


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "a\x00b", "猫", "on", "x" * 50, "New", "York", "city", "É"]
    rows = []
    for lang in ("en", "de", None, "und", "fr"):
        for _ in range(25):
            out = []
            for _ in range(rng.randrange(0, 120)):
                out.append(rng.choice(["new york city", "New York", "once upon a time", rng.choice(words), rng.choice(words), f"w{rng.randrange(99)}"]))
                out.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " \x0b", "\xa0"]))
            rows.append(("".join(out), lang))
    rows += [(None, "en"), ("", None), (" \n.,", "de"), ("again " * 400, "en"), ("one two, " * 90, "xx"), ("alone", "yy")]
    return rows + rows[:5]


@pytest.mark.parametrize(("block", "ranged", "chunk"), [(1 << 21, 1 << 20, 1 << 20), (60, 50, 7)])
def test_against_brute_force(spark, monkeypatch, block, ranged, chunk):
    monkeypatch.setattr(pm, "RANGE_WORDS", ranged)
    rows = corpus(5)
    docs = spark.createDataFrame([(k, t, lang, "n", "s") for k, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)

    # workers have their own module
    real = pm._encode

    def small(batches):
        from tallyloom.llm import phrase_mining

        phrase_mining.BLOCK_WORDS, phrase_mining.CHUNK = block, chunk
        yield from real(batches)

    monkeypatch.setattr(pm, "_encode", small)
    for least, top in ((3, 10_000), (30, 2000), (5, 7)):
        assert sorted(map(tuple, pm.mine(spark, docs, least, top).collect())) == brute(rows, least, top)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pm.mine(spark, docs).collect() == []
    assert pm.mine(spark, spark.createDataFrame([(1, None, None, "n", "s")], SCHEMA)).collect() == []


@pytest.mark.parametrize("width", [1, 2, 5, 17, 31, 32])
def test_permutation_is_one_to_one(width):
    rng = np.random.default_rng(width)
    keys = np.arange(1 << (2 * width), dtype=np.uint64) if width <= 5 else rng.integers(0, 1 << (2 * width), 10_000, np.uint64, endpoint=False) if width < 32 else rng.integers(0, (1 << 64) - 1, 10_000, np.uint64, endpoint=True)
    found = pm.permute(keys, width)
    assert (pm.restore(found, width) == keys).all()
    if width <= 5:
        assert sorted(found) == sorted(keys)
    else:  # the leading bits spread neighbouring pairs
        near = pm.permute(np.arange(4096, dtype=np.uint64), width) >> np.uint64(2 * width - 4)
        assert np.bincount(near.astype(int), minlength=16).max() < 400


def test_filters_lose_nothing():
    rng = np.random.default_rng(1)
    for bits in (2, 9, 34, 63, 64):
        for n in (0, 1, 2, 3, 300):
            keys = np.unique(rng.integers(0, (1 << bits) - 1, n, np.uint64, endpoint=True))
            counts = rng.integers(1, 600, len(keys))
            counts[: len(keys) // 3] = 255
            got, many = pm.unpack(pm.pack(keys, counts, bits), bits)
            assert (got == keys).all() and (many == counts).all()


def test_filters_merge_as_sums():
    rng = np.random.default_rng(2)
    want, filters = Counter(), []
    for _ in range(9):
        keys, counts = np.unique(rng.integers(0, 500, 400, np.uint64), return_counts=True)
        want.update(dict(zip(keys.tolist(), (counts * 200).tolist(), strict=True)))
        filters.append(pm.pack(keys, counts * 200, 40))
    keys, counts, _ = pm.merged(filters, 40)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want and (np.diff(keys.astype(np.int64)) > 0).all()


def test_scores_past_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 9 * 10**18, 1), ("en", "b", 8 * 10**18, 2)], "lang string, word string, f long, id long")
    phrases = spark.createDataFrame([([1, 2], 7 * 10**18 + 3)], "ids array<long>, a long")
    assert pm.scored(words, phrases, phrases).first().score == 2_000_000 * (7 * 10**18 + 3) // (17 * 10**18)
