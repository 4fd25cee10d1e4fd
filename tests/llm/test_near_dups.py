import random

import pytest

from tallyloom.llm import near_dups
from tallyloom.llm.near_dups import Similarity, near_duplicates

SCHEMA = "doc_id long, text string, lang string, node string"


def shingles(text, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    """{(doc_id, set): (size, component)}, all pairs."""
    sets = [(d, shingles(t, width)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            e, b = sets[j]
            linked = a and b and 100 * len(a & b) >= percent * len(a | b)
            if d is not None and e is not None and (linked or d == e):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((d is None, d or 0, len(s), -1 if d is None else least[root(i)]) for i, (d, s) in enumerate(sets))


def check(spark, rows, width=2, percent=80):
    df = spark.createDataFrame([(d, t, None, "x") for d, t in rows], SCHEMA)
    found = near_duplicates(spark, df, Similarity(width=width, percent=percent)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.doc_id is None else r.component_id) for r in found) == brute(rows, width, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one  two"), (7, "ONE\ntwo"), (8, "a b c d e f"), (8, "a b c d e f"), (9, "a b c d e f"), (None, "a b c d e f"), (10, long), (11, long + " z"), (12, "é É"), (13, "É é"), (14, "one two three"), (14, "p q r s t")]
    check(spark, rows)


def test_empty(spark):
    check(spark, [])
    check(spark, [(1, None), (2, "")])


@pytest.mark.parametrize("width,turns,part", [(2, 3, 1000), (5, 0, 1000), (5, 0, 7)])
def test_groups_at_the_threshold(spark, monkeypatch, width, turns, part):
    monkeypatch.setattr(near_dups, "TURNS", turns)
    monkeypatch.setattr(near_dups, "PART", part)
    monkeypatch.setattr(near_dups, "HOT_PAIRS", 20)
    monkeypatch.setattr(near_dups, "INSIDE", 25)
    rng = random.Random(width)
    rows = []
    for g in range(3):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(130)]
        for _ in range(90):
            words = list(base)
            for _ in range(rng.randrange(0, 14 if width == 2 else 6)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((rng.randrange(10**6), " ".join(words)))
    rows += [(10**6 + i, f"alone {i} of all the others {i * 7} here {i * 3}") for i in range(40)]
    check(spark, rows, width)


@pytest.mark.parametrize("groups,part", [(50, 1000), (500, 20)])
def test_many_leftovers_of_one_bucket_lose_no_link(spark, monkeypatch, groups, part):
    """Pairs that share a long passage with all others and are near each other alone."""
    monkeypatch.setattr(near_dups, "TURNS", 0)
    monkeypatch.setattr(near_dups, "PART", part)
    rng = random.Random(groups)
    common = [f"c{i}" for i in range(90)]
    rows = []
    for g in range(groups):
        own = [f"g{g}w{i}" for i in range(60)]
        for k in range(2):
            words = common + own
            for _ in range(rng.randrange(3)):
                words[90 + rng.randrange(60)] = f"x{rng.randrange(10**6)}"
            rows.append((g * 2 + k, " ".join(words)))
    rng.shuffle(rows)
    check(spark, rows, 5)


def test_a_run_keeps_only_what_its_result_reads(spark):
    import os

    from tallyloom.llm.common import shared_dir

    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    rows = [(i, " ".join(f"w{j}" for j in range(20 + i % 3))) for i in range(30)]
    check(spark, rows)
    (run,) = (d for d in set(os.listdir(root)) - before if d.startswith("near-dups-"))
    assert sorted(d.split("-", 1)[1] for d in os.listdir(f"{root}/{run}")) == ["classes", "features", "labels"]


def test_sketches_tell_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    for share in (1.0, 0.9, 0.8, 0.5):
        whole = rng.integers(1 << 63, size=2000, dtype=np.uint64)
        n = 1000
        common = int(round(n * 2 * share / (1 + share)))
        a, b = whole[:n], np.concatenate([whole[:common], whole[n : 2 * n - common]])
        samples = np.stack([near_dups.min_hashes(x, 200) for x in (a, b)])
        bits = int(np.bitwise_count(np.bitwise_xor(*near_dups.odd_sketches(samples))).sum())
        assert (bits <= Similarity().most_bits) == (share >= 0.8)
        if share == 1:
            assert bits == 0


def test_deduplicate_keeps_columns_and_one_each(spark):
    text = "the quick brown fox jumps over the lazy dog again and again today"
    rows = [(5, text, "en", "n"), (3, text, "fr", "m"), (3, text, "fr", "m"), (7, None, "en", "k"), (None, text, "en", "z"), (None, text, "en", "y"), (9, "quite another text of its own", None, "w")]
    out = near_dups.deduplicate(spark, spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "lang", "node"]
    assert sorted((r.doc_id or 0, r.node) for r in out.collect()) == [(0, "y"), (0, "z"), (3, "m"), (7, "k"), (9, "w")]


def test_deduplicate_loses_no_text_of_a_repeated_id(spark):
    """Of a doc_id with several texts only the copies go."""
    one, two, three = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine", "red green blue white black brown pink grey")
    rows = [(1, one, "en", "a"), (4, one, "en", "b"), (4, two, "en", "c"), (4, three, "en", "d"), (6, three, "en", "e"), (6, "", "en", "f"), (2, one, "en", "g")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "_row").withColumnRenamed("node", "component_id")
    out = near_dups.deduplicate(spark, df)
    assert out.columns == df.columns
    assert sorted(r.component_id for r in out.collect()) == ["a", "c", "d", "f"]
