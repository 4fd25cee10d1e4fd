import random

import public_tokenizers

import corpus_pipeline
from tallyloom.llm import decontaminate, language_crf

from .test_decontaminate_and_search import brute as brute_matches
from .test_near_dups import brute as brute_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
WORDS = {"en": "the of and house river green tion ing over again", "de": "der und ein ung schein fluss haus über noch mal"}


def tables(spark, path):
    rng = random.Random(9)

    def text(lang, n):
        return " ".join("".join(rng.sample(WORDS[lang].split(), 2)) for _ in range(n))

    items = [(i, text("en", 14)) for i in range(6)] + [(99, None)]
    rows = [(i, text(lang, rng.randrange(8, 60)), lang) for i, lang in enumerate(["en", "de"] * 40)]
    rows += [(200 + k, rows[k][1], rows[k][2]) for k in range(8)]  # exact copies
    for k in range(10, 18):  # near copies
        words = rows[k][1].split()
        words[-1] = "other"
        rows.append((300 + k, " ".join(words), None))
    rows += [(400 + k, text("en", 5) + " " + items[k][1] + "s " + text("en", 5), "en") for k in range(6)]
    rows += [(500, None, "en"), (501, "123 !!", "en"), (502, "", None), (7, rows[7][1], rows[7][2]), (503, text("de", 9000), "de")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs, items


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs, items = tables(spark, tmp_path)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)

    def kept(name, df):
        out = stages[name](spark, df, str(tmp_path))
        assert out.columns == COLUMNS
        rows = out.collect()
        assert {tuple(r) for r in rows} <= {tuple(r) for r in df.collect()}
        return spark.createDataFrame(rows, docs.schema)

    first = kept("language_id", docs)
    ids = sorted(r.doc_id for r in first.collect())
    assert ids == sorted(r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or "")))
    labels = language_crf.labelled(spark, first, language_crf.learn(docs)).filter("lang IS NOT NULL")
    assert labels.filter("lang <> language.lang_pred").count() <= 2

    second = kept("near_dedup", first)
    groups = brute_groups([(r.doc_id, r.text) for r in first.collect()], 5, 80)
    assert sorted(r.doc_id for r in second.collect()) == sorted({d for _, d, _, component in groups if d == component})

    third = kept("decontamination", second)
    leaking = {d for d, _, _ in brute_matches([(r.doc_id, r.text) for r in second.collect()], items, 0.08)}
    assert {400 + k for k in range(6)} <= leaking | ({r.doc_id for r in first.collect()} - {r.doc_id for r in second.collect()})
    assert sorted(r.doc_id for r in third.collect()) == sorted(r.doc_id for r in second.collect() if r.doc_id not in leaking)

    packed = stages["best_fit_packing"](spark, third, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in third.collect()}

    whole = corpus_pipeline.run(spark, str(tmp_path))
    strip = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in strip) for r in whole.collect()) == sorted(tuple(r[c] for c in strip) for r in packed)


def test_empty_and_null_documents(spark, tmp_path):
    for name, rows in (("none", []), ("nulls", [(None, None, None, None, None), (1, None, None, None, None)])):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        # without a learned language every row stays; a null text is packed as its end id
        assert sorted((str(r.doc_id), r.length) for r in corpus_pipeline.run(spark, path).collect()) == sorted((str(r[0]), 1) for r in rows)
    assert public_tokenizers.path("byte_bpe_50k.json")
    assert decontaminate.budget(100, 0.08) == 8


def test_rows_without_labels_and_ids_that_repeat(spark, tmp_path):
    """No label: nothing is rejected as unwritten.  A doc_id with several texts keeps those that no other row stands for."""
    rng = random.Random(3)

    def text(n):
        return " ".join("".join(rng.sample(WORDS["en"].split(), 2)) for _ in range(n))

    one, two = text(30), text(30)
    rows = [(1, one), (1, two), (2, one), (3, text(30)), (3, text(30)), (3, None), (None, "no id")]
    docs = spark.createDataFrame([(d, t, None, "s", 1, d, "x") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _row long, component_id string")
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, docs, str(tmp_path))
    assert first.columns == docs.columns and first.count() == len(rows)
    second = stages["near_dedup"](spark, first, str(tmp_path))
    assert second.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in second.collect()) == sorted((str(d), t or "") for d, t in rows if (d, t) != (2, one))


def test_columns_of_any_name_come_through(spark, tmp_path):
    """Helper columns take names that the caller's don't have, in any case of letters."""
    from tallyloom.llm import packing
    from tallyloom.llm.registry import vocabulary

    docs, _ = tables(spark, tmp_path)
    names = ["_language", "_MATCHES", "_row", "_kept", "_group", "_place", "component_id", "matches"]
    rich = docs
    for k, x in enumerate(names):
        rich = rich.withColumn(x, docs["n_chars"] + k)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rich, str(tmp_path))
        assert out.columns == rich.columns
        kept = out.collect()
        assert kept and all(r[x] == r.n_chars + k for r in kept for k, x in enumerate(names))
        assert len(kept) == stage(spark, docs, str(tmp_path)).count()
    pieces = packing.cut_documents(docs, vocabulary("byte_bpe_50k.json"))
    extra = ["_row", "_Group", "_rank", "_place", "_n", "_base"]
    for k, x in enumerate(extra):
        pieces = pieces.withColumn(x, pieces["length"] + k)
    placed = packing.pack(spark, pieces).collect()
    assert len(placed) == pieces.count() and all(r[x] == r.length + k for r in placed for k, x in enumerate(extra))
