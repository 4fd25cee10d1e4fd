import hashlib
import re

import pytest

from tallyloom.llm import content_sort

SCHEMA = "doc_id long, text string, size long, run string, content string"
TEXTS = ["", None, " \t\n", "a b", "ab", "a  b ", "a b", "é\r\n x", "éx", "w " * 60_000, "w" * 60_000, "w" * 59_999 + "v", "lead of many texts 1", "lead of many texts 2", "AB"]


def brute(rows):
    groups = {}
    for k, (doc, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc is None, doc or 0, k, doc))
    found = []
    for content, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(content.encode()).hexdigest()
        ranks = sorted(m[:3] for m in members)
        for m in members:
            # of repeated rows any one stays
            found.append((m[4], best[4], len(members), (m[:3] == ranks[0], ranks.count(ranks[0])), sha))
    return found


def held_against(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "s", "t") for d, t in rows], SCHEMA).repartition(3)
    got = content_sort.duplicates(spark, docs).collect()
    want = brute(rows)
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got))) == sorted(map(str, ((d, k, n, s) for d, k, n, _, s in want)))
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(any((r.doc_id, r.text_sha256) == (d, s) and first for d, _, _, (first, _), s in want) for r in kept)


def test_against_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS * 3)] + [(None, "ab"), (None, "a   b   "), (5, "ab"), (5, "ab"), (-3, "ab"), (77, "AB ")]
    held_against(spark, rows)


@pytest.mark.parametrize("rows", [3, 40])
def test_a_text_of_many_rows_is_split(spark, monkeypatch, rows):
    monkeypatch.setattr(content_sort, "RUN_ROWS", rows)
    many = [(k, "hot text" + " " * (k % 3)) for k in range(300)] + [(None, "hot text  ")] * 9 + [(k, None) for k in range(400, 500)]
    held_against(spark, many + [(k, t) for k, t in enumerate(TEXTS, 1000)])


def test_only_the_most_frequent_are_split(spark, monkeypatch):
    monkeypatch.setattr(content_sort, "RUN_ROWS", 2)
    monkeypatch.setattr(content_sort, "SPLIT_TEXTS", 2)
    held_against(spark, [(k, f"text {k % 7}" + " " * (k % 5)) for k in range(200)])


def test_empty(spark):
    assert content_sort.duplicates(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_is_native_and_sorts_once(spark):
    plan = content_sort.sorted_runs(content_sort.normalised(spark.createDataFrame([(1, "a", 1, "s", "t")], SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))
    # of the exchanges only the one by ranges has whole texts
    assert plan.count("Exchange rangepartitioning(lead") == 1 and "hashpartitioning(lead" not in plan
