import itertools
import random

import numpy as np

from tallyloom.llm import language_crf as crf


def brute(scores, transition):
    n, k = scores.shape
    out = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(sum(scores[i, p] for i, p in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:], strict=False)))
        for i, p in enumerate(path):
            out[i, p] += w
    return out / out.sum(axis=1, keepdims=True)


def likelihood(weights, transition, flat, first, seqs, golds):
    table = np.add.reduceat(weights[flat], first)
    total = 0.0
    for seq, gold in zip(seqs, golds, strict=True):
        scores = table[seq]
        score = sum(scores[i, g] for i, g in enumerate(gold)) + sum(transition[a, b] for a, b in zip(gold, gold[1:], strict=False))
        z = np.log(sum(np.exp(sum(scores[i, p] for i, p in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:], strict=False))) for path in itertools.product(range(3), repeat=len(seq))))
        total += score - z
    return total


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 5, 3, 2])
    packed = crf.Packed(lengths)
    assert sorted(packed.place) == list(range(14))
    scores, transition = rng.normal(size=(14, 3)), rng.normal(size=(3, 3))
    by_place = np.empty_like(scores)
    by_place[packed.place] = scores
    found = crf.posteriors(by_place, transition, packed)[packed.place]
    at = 0
    for n in lengths:
        assert np.allclose(found[at : at + n], brute(scores[at : at + n], transition))
        at += n


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    flat, first = np.array([0, 1, 1, 2, 3, 0]), np.array([0, 2, 5])
    seqs, golds = [[0, 1, 2, 1], [2, 0]], [[0, 1, 2, 2], [1, 1]]
    packed = crf.Packed(np.array([4, 2]))
    ids, gold = np.empty(6, int), np.empty(6, int)
    ids[packed.place], gold[packed.place] = sum(seqs, []), sum(golds, [])
    w, t = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    gw, gt = crf.gradient(w, t, flat, first, ids, gold, packed)
    for x, g in ((w, gw), (t, gt)):
        for i in np.ndindex(x.shape):
            x[i] += 1e-5
            up = likelihood(w, t, flat, first, seqs, golds)
            x[i] -= 2e-5
            down = likelihood(w, t, flat, first, seqs, golds)
            x[i] += 1e-5
            assert abs((up - down) / 2e-5 - g[i]) < 1e-4


SYLLABLES = {"aa": ["ko", "ru", "mi", "ta"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["eau", "oui", "tre", "que"]}


def words(lang, n, rng):
    return ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def samples(n, rng):
    return [(" ".join(words(lang, rng.randrange(5, 60), rng)), lang) for lang in SYLLABLES for _ in range(n)]


def test_words_of_switched_text():
    rng = random.Random(3)
    labeller = crf.Labeller(crf.fit(samples(60, rng)))
    spans = [(lang, words(lang, 12, rng)) for lang in ("aa", "bb", "aa", "cc")]
    found, _ = labeller.word_posteriors([[w for _, ws in spans for w in ws]])
    want = [sorted(SYLLABLES).index(lang) for lang, ws in spans for _ in ws]
    assert (found.argmax(axis=1) == want).mean() > 0.95


def test_documents(spark):
    rng = random.Random(5)
    rows = [(i, text, lang, "s") for i, (text, lang) in enumerate(samples(120, rng))]
    odd = [(10_000, None, "aa", "s"), (10_001, "", "bb", "s"), (10_002, "12 ²³ --", None, "s"), (None, "ko ru mi", "aa", None), (10_003, "ko " * 60_000, None, "s"), (5, "ko ru", "aa", "s"), (5, "ko ru", "aa", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, language string")
    model = crf.learn(docs, per_label=80)
    out = crf.labelled(spark, docs, model).select("doc_id", "text", "lang", crf.held_out().alias("held_out"), "language.lang_pred", "language.score").collect()
    assert len(out) == len(rows) + len(odd)
    import zlib

    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
    held = [r for r in out if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(held) > 50 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    kept = crf.keep_written(spark, docs)
    assert kept.columns == docs.columns and kept.filter("text IS NULL OR doc_id = 10002").count() == 0
    assert kept.count() >= len(rows) + 3


def test_unlearned_language_and_gibberish_go(spark):
    rng = random.Random(11)
    rows = [(i, text, lang) for i, (text, lang) in enumerate(samples(120, rng))]
    other = [(1000 + i, " ".join("".join(rng.choice(["zsw", "pły", "gdź", "hob"]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), None) for i in range(20)]
    junk = [(2000 + i, " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(30)), None) for i in range(20)]
    switched = [(3000 + i, " ".join(w for _ in range(3) for lang in SYLLABLES for w in words(lang, 4, rng)), None) for i in range(20)]
    for learned in (set(SYLLABLES), {"aa", "bb"}):
        own = [r for r in rows if r[2] in learned]
        docs = spark.createDataFrame(own + other + junk + (switched if len(learned) == 3 else []), "doc_id long, text string, lang string")
        assert sorted(r.doc_id for r in crf.keep_written(spark, docs).collect()) == [r[0] for r in own] + ([r[0] for r in switched] if len(learned) == 3 else [])


def test_few_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "only one", "aa"), (3, "kind of label", "aa")], "doc_id long, text string, lang string")
    assert {r.language.lang_pred for r in crf.labelled(spark, docs, crf.learn(docs)).collect()} == {"aa"}
    none = docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")
    assert {r.language.lang_pred for r in crf.labelled(spark, none, crf.learn(none)).collect()} == {"und"}
    assert crf.labelled(spark, docs.limit(0), crf.learn(docs.limit(0))).count() == 0


def test_full_cache_changes_nothing(monkeypatch):
    rng = random.Random(7)
    model = crf.fit(samples(20, rng))
    texts = [" ".join(words("aa", 30, rng) + words("bb", 9, rng)) for _ in range(30)]
    plain = crf.Labeller(model).label(texts)
    monkeypatch.setattr(crf, "KEPT_WORDS", 7)
    monkeypatch.setattr(crf, "BATCH_WORDS", 50)
    small = crf.Labeller(model).label(texts)
    assert plain[0] == small[0] and np.allclose(plain[1], small[1], atol=1e-5)
