import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from tallyloom.llm import license_scan, unigram_counts
from tallyloom.llm import pseudo_likelihood as pl

# --- token counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECES = unigram_counts.pieces_of(MODEL)
LIBRARY = Tokenizer(models.Unigram(PIECES, unk_id=0, byte_fallback=True))
LIBRARY.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
LIBRARY.encode_special_tokens = True
COUNTER = unigram_counts.UnigramCounter(PIECES)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("  abcde ingthé▁\n猫🙂0<x>A"), max_size=25) | st.text(max_size=20))
def test_counts_are_the_library_s(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert COUNTER.count(text)[0] == len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_ties_go_to_the_longest():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁a", -2.0), ("aba", -3.0)]
    library = Tokenizer(models.Unigram(pieces, unk_id=0))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = unigram_counts.UnigramCounter(pieces)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab ") for _ in range(rng.randrange(1, 12))).strip()
        if text:
            assert counter.count(text)[0] == len(library.encode(text).ids), text


def test_token_counts_table(spark, monkeypatch):
    rows = [(1, "one two", 5), (1, "one two", 5), (2, None, 5), (3, "", 5), (None, "x", 5), (4, "wort " * 30_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = unigram_counts.token_counts(df, MODEL).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted((str(d), len(LIBRARY.encode(t).ids) if t else 0) for d, t, _ in rows)
    assert unigram_counts.token_counts(df.limit(0), MODEL).count() == 0


# --- license scans


@pytest.mark.parametrize(
    "line,want",
    [
        ("Licensed under the Apache License, Version 2.0.", ("apache", "2.0")),
        ("This work is licensed under the GNU General Public License, version 3.", ("gpl", "3")),
        ("Released under the MIT License.", ("mit", None)),
        ("Licensed under CC BY-NC 4.0.", ("cc-by-nc", "4.0")),
        ("Licensed under CC BY-NC-SA 4.0.", ("cc-by-nc-sa", "4.0")),
        ("Licensed under CC BY 4.0.", ("cc-by", "4.0")),
        ("The driver's license was lost on the way.", None),
        ("Not licensed at all, said the owner of the copyright.", None),
        ("", None),
    ],
)
def test_lines(line, want):
    found = license_scan.scan_block(line)
    assert (found and found[:2]) == want


def test_scan_table(spark):
    rows = [(1, "a\nLicensed under CC BY-NC 4.0.\nb", "x"), (1, "a\nLicensed under CC BY-NC 4.0.\nb", "x"), (2, None, "x"), (3, "", "x"), (None, "Released under the MIT License.", "x"), (4, ("word " * 50_000) + "\nReleased under the MIT License.", "x"), (5, "no permission to speak", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = sorted((str(r.doc_id), r.block, r.license) for r in license_scan.scan_licenses(df).collect())
    assert found == [("1", 1, "cc-by-nc"), ("1", 1, "cc-by-nc"), ("4", 1, "mit"), ("None", 0, "mit")]
    # the search for candidates misses no line that the scan confirms
    lines = [line for _, text, _ in rows for line in (text or "").split("\n")]
    assert sum(bool(license_scan.scan_block(x)) for x in lines) == len(found)
    assert license_scan.scan_licenses(df.limit(0)).count() == 0


def test_wrapped_notices_and_every_license(spark):
    wrapped = """Copyright (c) 2019 Someone
 * Permission is hereby granted, free of charge, to any person
 * obtaining a copy of this software and associated documentation
 * files (the "Software"), to deal in the Software without
 * restriction, as long as it lasts."""
    rows = [
        (1, "before\n" + wrapped + "\nafter"),
        (2, "This project is licensed under the MIT License."),
        (3, "Licensed under CC BY 4.0, or at your choice licensed under the Apache License, Version 2.0."),
        (4, "Released under the MIT License.\nReleased under the MIT License."),
        (5, "This work is licensed under the GNU General\nPublic License, version 3."),
        (6, "Released under the MIT License. Some words. Released under the MIT License."),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.block, r.license, r.version) for r in license_scan.scan_licenses(df).collect())
    assert found == [(1, 2, "mit-notice", None), (2, 0, "mit", None), (3, 0, "apache", "2.0"), (3, 0, "cc-by", "4.0"), (4, 0, "mit", None), (4, 1, "mit", None), (5, 0, "gpl", "3"), (6, 0, "mit", None), (6, 0, "mit", None)]
    whole = dict(license_scan.TEMPLATES)["mit-text"].split()
    text = "\n".join(" ".join(whole[k : k + 9]) for k in range(0, len(whole), 9))
    assert [x[:2] for x in license_scan.scan_text("Some title\n\n" + text)] == [(2, "mit-text")]


def longest_common(a, b):
    """Length of the longest common subsequence, word by word."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_planted_wordings_against_all_templates_without_gate_and_compression():
    """Wrapped anywhere, with a few words of long ones lost: the longest template whose words stand in the text in order."""
    rng = random.Random(21)
    names = [(n, license_scan._WORD.findall(license_scan.wording(t))) for n, t in license_scan.TEMPLATES]
    filler = ["zorva", "plim", "quatto", "brensh", "ulda", "kwimp", "sorrel", "dantu"]
    for k, (_, template) in enumerate(license_scan.TEMPLATES):
        words = template.replace("#", "2.0").split()
        if len(words) > 40:
            words = [w for w in words if rng.random() > 0.03]
        words = [rng.choice(filler) for _ in range(rng.randrange(30))] + words + [rng.choice(filler) for _ in range(rng.randrange(30))]
        text = "".join(w + ("\n# " if k % 2 and rng.random() < 0.15 else "\n" if rng.random() < 0.1 else " ") for w in words)
        own = license_scan._WORD.findall(license_scan.wording(text))
        fits = [(len(t), n) for n, t in names if longest_common(t, own) >= (0.9 if len(t) >= 12 else 1) * len(t)]
        found = license_scan.scan_text(text)
        assert found and max(found, key=lambda x: x[4])[1] == max(fits)[1], (template[:40], found, fits)
    assert license_scan.scan_text(" ".join(rng.choice(filler) for _ in range(400))) == []
    # no template is behind the gate
    assert all(license_scan._KEY.search(t) for _, t in license_scan.TEMPLATES)


def test_savings_decide(monkeypatch):
    """With compressors that save alike nothing is found, and of two templates the one that saves more wins."""
    text = "Released under the MIT License."
    assert [x[1] for x in license_scan.scan_text(text)] == ["mit"]
    license_scan._confirmed.cache_clear()
    with monkeypatch.context() as patch:
        patch.setattr(license_scan, "_size", lambda compressor, text: 50)
        assert license_scan.scan_text(text) == []
    license_scan._confirmed.cache_clear()


def test_long_texts_of_notices_take_linear_time():
    import time

    began = time.perf_counter()
    found = license_scan.scan_text("\n".join(["Released under the MIT License."] * 20_000))
    assert [x[0] for x in found] == list(range(20_000)) and time.perf_counter() - began < 10
    seconds = []
    for n in (500, 2000):
        began = time.perf_counter()
        assert len(license_scan.scan_text("\n".join(f"Released under the MIT License. word{'abc'[k % 3] * (1 + k % 97)}" for k in range(n)))) == n
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 10 * seconds[0]


def test_no_wording_is_lost_to_the_savings():
    """Every place that the words confirm without compression, in texts of several licenses, is found with it."""
    rng = random.Random(4)
    _, classes = license_scan._prepared()
    every = [t for _, ts in classes for t in ts]
    for _ in range(150):
        words = []
        for _ in range(rng.randrange(1, 5)):
            t = rng.choice(every)
            words += ["".join(rng.choice("bdfhklmopqrtuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(25))]
            words += [w for w in t.words if len(t.words) < 12 or rng.random() > 0.05]
        for kind, (span, ts) in enumerate(classes):
            for low in range(0, max(1, len(words) - span // 2), span // 2):
                block = words[low : low + span]
                plain = {(t.number, *same) for t in ts for same, _, _ in license_scan._places(t, block, 0.9)}
                got = {(t.number, *same) for t, same, _, _ in license_scan._confirmed(kind, tuple(block), 0.9)}
                assert plain == got


# --- scoring


def plain_log_prob(net, ids):
    """One word after another, with a full softmax over groups and the group's words."""
    total = 0.0
    for i, x in enumerate(ids):
        h = net.bias.astype(float).copy()
        for k, step in enumerate((-2, -1, 1, 2)):
            j = i + step
            h += net.around[k][ids[j] if 0 <= j < len(ids) else pl.SIZE]
        h = np.tanh(h)
        g, w = divmod(int(x), pl.GROUPS)
        a, b = h @ net.group + net.group_bias, h @ net.word[g] + net.word_bias[g]
        total += a[g] - np.log(np.exp(a).sum()) + b[w] - np.log(np.exp(b).sum())
    return total


def network(seed):
    rng = np.random.default_rng(seed)
    return pl.Network((rng.standard_normal(pl.Network.size()) * 0.3).astype(np.float32))


def corpus(n, rng):
    """Words that their neighbours tell: a, b, c in turn, or p, q, r."""
    out = []
    for i in range(n):
        cycle = ["alpha", "beta", "gamma"] if i % 2 else ["pi", "rho", "sigma"]
        k = rng.randrange(3)
        out.append((i, " ".join(cycle[(k + j) % 3] for j in range(rng.randrange(5, 40)))))
    return out


def test_scores_against_one_word_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(pl, "BATCH", 30)
    vocab, net = pl.Vocabulary({f"w{i}": i for i in range(200)}), network(1)
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(260)}" for _ in range(rng.randrange(0, 70)))) for i in range(20)]
    rows += [(50, None), (51, ""), (52, " \n"), (None, "w1 w2"), (3, "w3"), (3, "w3"), (60, "w5 W6\n" * 3000)]
    df = spark.createDataFrame([(d, t, 1.0) for d, t in rows], "doc_id long, text string, log_prob double")
    found = pl.score(spark, df, vocab, net).collect()
    want = sorted((str(d), len(pl.words_of(t)), plain_log_prob(net, vocab.encode(t))) for d, t in rows)
    got = sorted((str(r.doc_id), r.n_words, r.log_prob) for r in found)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want], rtol=1e-4)
    assert all((r.mean_log_prob is None) == (r.n_words == 0) for r in found)


def test_gradient_against_differences():
    net = network(3)
    net = pl.Network(net.flat.astype(np.float64))
    rng = np.random.default_rng(4)
    ids = rng.integers(pl.SIZE, size=12)
    around = pl.windows(ids, np.array([7, 5]))
    grad = pl.Network(np.zeros(len(net.flat)))
    pl.log_probs(net, around, ids, grad)
    for i in [*np.flatnonzero(grad.flat)[:: max(1, np.count_nonzero(grad.flat) // 60)], *rng.integers(len(net.flat), size=10)]:
        keep = net.flat[i]
        net.flat[i] = keep + 1e-5
        up = pl.log_probs(net, around, ids).sum()
        net.flat[i] = keep - 1e-5
        down = pl.log_probs(net, around, ids).sum()
        net.flat[i] = keep
        assert abs((up - down) / 2e-5 - grad.flat[i]) < 1e-5


def test_training_learns_both_sides(spark):
    rng = random.Random(8)
    docs = spark.createDataFrame([*corpus(600, rng), (10_000, None)], "doc_id long, text string").repartition(3)
    vocab, counts = pl.vocabulary(docs)
    assert set(vocab.ids) == {"alpha", "beta", "gamma", "pi", "rho", "sigma"}
    net = pl.train(spark, docs, vocab, counts, shards=4, rounds=4, step=0.2)
    tests = spark.createDataFrame([(1, "alpha beta gamma alpha beta gamma alpha"), (2, "alpha gamma pi beta rho beta gamma")], "doc_id long, text string")
    by = {r.doc_id: r.mean_log_prob for r in pl.score(spark, tests, vocab, net).collect()}
    flat = {r.doc_id: r.mean_log_prob for r in pl.score(spark, tests, vocab, pl.Network.initial(counts)).collect()}
    assert by[1] > flat[1] + 0.5 and by[1] > by[2] + 0.5


def test_split_words():
    texts = pa.array(["  A b\n\tb ", None, "", " ", "É é x", "one"])
    words = pl.split_words(texts)
    assert words.lengths.tolist() == [3, 0, 0, 0, 3, 1]
    assert [words.distinct[i] for i in words.at] == ["a", "b", "b", "é", "é", "x", "one"]
    assert pl.words_of(" A  b ") == ["a", "b"] and pl.words_of(None) == []
    assert list(pl._parts(np.array([0, 0]))) and [r for a, b, _, _ in pl._parts(np.array([3, pl.BATCH, 2, 0, 5])) for r in range(a, b)] == list(range(5))


def test_every_word_is_scored_itself(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(f"w{min(rng.randrange(3000), rng.randrange(3000))}" for _ in range(rng.randrange(0, 90)))) for i in range(120)]
    rows += [(500, "w1 onlyhere w2"), (501, "w1 thrice w2"), (501, "w1 thrice w2"), (None, "thrice ünïcode"), (502, None), (503, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    n = Counter(w for _, t in rows for w in pl.words_of(t))
    counted = pl.count_words(docs)
    vocab, counts = pl.vocabulary(docs, counted)
    low = pl.SIZE - pl.BUCKETS
    totals = Counter()
    for w, k in n.items():
        totals[int(vocab.encode(w)[0])] += k
    assert len(n) > low and counts.tolist() == [totals[i] for i in range(pl.SIZE)]
    net = network(5)
    found = pl.score(spark, docs, vocab, net, counts, counted).collect()

    def want(text):
        ids = vocab.encode(text)
        return plain_log_prob(net, ids) + sum(np.log(n[w] / totals[i]) for w, i in zip(pl.words_of(text), ids.tolist(), strict=True) if i >= low)

    got = sorted((str(r.doc_id), r.n_words, r.log_prob) for r in found)
    expected = sorted((str(d), len(pl.words_of(t)), want(t)) for d, t in rows)
    assert [x[:2] for x in got] == [x[:2] for x in expected]
    assert np.allclose([x[2] for x in got], [x[2] for x in expected], rtol=1e-4)


def test_every_word_is_a_target_however_the_table_is_dealt(spark):
    """On 1 and 20 partitions the same shards, the same network and scores, better than the words' frequencies on texts left out."""
    rng = random.Random(14)
    rows = [*corpus(900, rng), (5000, None), (5001, ""), (5002, "alpha " * 30_000)]
    train, held = rows[:700] + rows[-3:], rows[700:-3]
    docs = spark.createDataFrame(train, "doc_id long, text string")
    vocab, counts = pl.vocabulary(docs)
    nets = []
    for n in (1, 20):
        shards = pl.sharded(docs.repartition(n), vocab, 4).groupBy("shard").agg({"shard": "count"}).count()
        assert shards == 4
        words = sum(len(np.frombuffer(r.ids, np.uint16)) for r in pl.sharded(docs.repartition(n), vocab, 4).collect())
        assert words == sum(len(pl.words_of(t)) for _, t in train)
        nets.append(pl.train(spark, docs.repartition(n), vocab, counts, shards=4))
    tests = spark.createDataFrame(held, "doc_id long, text string")
    means = [np.mean([r.mean_log_prob for r in pl.score(spark, tests, vocab, x).collect()]) for x in (*nets, pl.Network.initial(counts))]
    assert abs(means[0] - means[1]) < 0.02 and min(means[:2]) > means[2] + 0.1


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pl.score_corpus(spark, docs).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert pl.score_corpus(spark, none).first().log_prob == 0
