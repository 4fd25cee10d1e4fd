import random

import pytest

from tallyloom.llm import decontaminate, hamming_topk

WORDS = "the of tion ing ver ein oui eau que ment one day house river green over again many water light".split()


def least_distance(item, text):
    """Of an item to any stretch of a text: by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (x != c)))
        row = new
        best = min(best, row[-1])
    return best


def brute(docs, items, rate):
    out = []
    for d, text in docs:
        best = {}
        for i, item in items:
            if item and text:
                a, b = decontaminate.normalized(item), decontaminate.normalized(text)
                n = least_distance(a, b)
                if n <= int(len(a) * rate + 1e-9):
                    best[i] = min(n, best.get(i, n))
        out += [(d, i, n) for i, n in best.items()]
    return sorted(out, key=str)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, text, n):
    for _ in range(n):
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1 :], text[:k] + rng.choice("abcxyz ") + text[k + 1 :], text[:k] + rng.choice("abcxyz ") + text[k:]])
    return text


@pytest.mark.parametrize("rate", [0.08, 0.0])
def test_against_all_distances(spark, rate):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.randrange(4, 20))) for i in range(12)] + [(50, None), (51, ""), (52, "Ab"), (53, "İstanbul is far away from here")]
    docs = [(i, sentence(rng, 40)) for i in range(10)]
    for k in range(30):
        item = rng.choice(items[:12])[1]
        docs.append((100 + k, sentence(rng, 9) + " " + edited(rng, item, rng.randrange(0, 14)).upper().replace(" ", "\n") + " " + sentence(rng, 6)))
    docs += [(200, None), (200, ""), (201, items[0][1]), (202, items[0][1][:-3]), (None, items[1][1]), (203, "xABx and i̇stanbul is far İstanbul is far away from here"), (204, items[2][1] + " "), (204, items[2][1] + " ")]
    df = spark.createDataFrame([(d, t, "m", 1) for d, t in docs], "doc_id long, text string, matches string, item_id int")
    found = decontaminate.found(spark, df, spark.createDataFrame(items, "item_id long, text string"), rate=rate).collect()
    assert sorted([(r.doc_id, r.item_id, r.distance) for r in found], key=str) == brute(docs, items, rate)
    kept = decontaminate.without_leaks(spark, df, spark.createDataFrame(items, "item_id long, text string"), rate=rate)
    assert kept.columns == df.columns
    leaking = {d for d, _, _ in brute(docs, items, rate)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in leaking)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    rng = random.Random(4)
    items = [(i, sentence(rng, 8)) for i in range(9)]
    docs = [(i, sentence(rng, 5) + items[i][1]) for i in range(9)]
    found = decontaminate.found(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == brute(docs, items, 0.08)


def test_no_items_or_documents(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, None)], "item_id long, text string")
    assert decontaminate.found(spark, docs, items).count() == 0
    assert decontaminate.without_leaks(spark, docs, items).count() == 1
    assert decontaminate.found(spark, docs.limit(0), docs.selectExpr("doc_id AS item_id", "text")).count() == 0


def nearest(index, queries, k):
    out = []
    for q, code in sorted(set(queries)):
        rows = sorted({(bin((code ^ c) & (2**64 - 1)).count("1"), i, c) for i, c in set(index) if i != q})
        out += [(q, r + 1, i, d) for r, (d, i, _) in enumerate(rows[:k])]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "alike", "few", "empty"])
def test_top_k(spark, case):
    rng = random.Random(6)

    def code():
        return rng.getrandbits(64) - 2**63

    if case == "random":
        rows = [(i, code()) for i in range(400)]
    elif case == "alike":
        base = [code() for _ in range(3)]
        rows = [(i, base[i % 3] if i % 2 else base[0] ^ sum(1 << rng.randrange(60) for _ in range(rng.randrange(4)))) for i in range(300)] + [(0, base[1]), (7, base[2])]
    else:
        rows = [(1, 5), (2, 7), (2, 7), (3, -1)] if case == "few" else []
    index = spark.createDataFrame([(i, c, i, "x") for i, c in [*rows, (None, 3), (99_999, None)]], "id long, code long, n long, query string")
    queries = index.filter("id % 50 = 0 OR id < 4").withColumnRenamed("id", "query_id").withColumnRenamed("n", "distance")
    found = sorted((r.query_id, r.rank, r.id, r.distance) for r in hamming_topk.top_k(spark, index, queries, k=5).collect())
    want = nearest(rows, [(i, c) for i, c in rows if i % 50 == 0 or i < 4], 5)
    if case == "alike":  # an id with several codes stands once for each, and gives k rows for each of its own codes
        assert [x for x in found if x[0] not in (0, 7)] == [x for x in want if x[0] not in (0, 7)]
        assert {(q, r, d) for q, r, _, d in found} == {(q, r, d) for q, r, _, d in want}
    else:
        assert found == want


@pytest.mark.parametrize("entries", [1, 2, 3, 500, 2000, 1 << 20, 1 << 40])
def test_segments(entries):
    cuts = hamming_topk._cuts(entries)
    assert [a for a, _ in cuts] == [0, *[a + w for a, w in cuts][:-1]] and sum(w for _, w in cuts) == 64
    assert max(w for _, w in cuts) - min(w for _, w in cuts) <= 1 and (entries < 4 or 2 ** min(w for _, w in cuts) <= entries**1.5)


def test_each_distance_is_covered_when_it_is_said_to_be():
    """After radius r and segment s every code within m * r + s differs by at most r somewhere up to s, or by less anywhere."""
    rng = random.Random(2)
    cuts = hamming_topk._cuts(3000)
    m = len(cuts)
    for radius in range(3):
        for s in range(m):
            for _ in range(200):
                code = sum(1 << b for b in rng.sample(range(64), min(64, m * radius + s)))
                differ = [bin(code >> a & ((1 << w) - 1)).count("1") for a, w in cuts]
                assert min(differ[: s + 1]) <= radius or min(differ) < radius


def test_sign_codes(spark):
    rows = [(1, [1.0, -1.0, 0.0, float("nan"), None] + [2.0] * 59), (2, [1.0] * 63), (3, None), (4, [-1.0] * 70)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    got = {r.id: r.c for r in df.select("id", hamming_topk.sign_code("v").alias("c")).collect()}
    assert got == {1: ((2**64 - 1) & ~0b11110) - 2**64, 2: None, 3: None, 4: 0}


def test_a_long_text_of_one_letter():
    """Stretches are joined as hits arrive, so a repeated piece takes no memory for each hit."""
    import tracemalloc

    finder = decontaminate.Finder([(1, "a" * 300), (2, "ab" * 50)], 0.08)
    tracemalloc.start()
    found = finder.find("a" * 20_000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(1, 0, 300)] and most < 10_000_000
