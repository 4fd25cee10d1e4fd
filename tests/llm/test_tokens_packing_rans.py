import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm import packing, rans_files, tokens
from tallyloom.llm.tokens import TextEncoder, in_runs

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = TextEncoder(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encoded(texts, encoder=ENCODER):
    ids, lengths = encoder.encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] if texts else []


PARTS = [*" \n\t\x1c\x00  ab'sé1.,!ñ猫᠎", "  ", "\r\n", "<|endoftext|>", "<|endof", "word", "Wort,", ".\nThe", "'s", "３"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join) | st.text(st.characters(codec="utf-8"), max_size=30), max_size=6))
def test_pieces_give_the_library_s_ids(texts):
    assert encoded(texts) == [plain(x) for x in texts]


def test_control_strings_are_what_the_library_makes_of_them():
    assert encoded(["a <|endoftext|> b"]) == [[64, 220, 50256, 275]]


def test_pieces_are_forgotten_and_made_again(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    small = TextEncoder(PATH)
    texts = [None, "", "one two three. four, five\nSix", "one  two <|endoftext|>", "x" * 5000, *[f"w{chr(97 + k)} one" for k in range(20)]]
    for _ in range(3):
        assert encoded(texts, small) == [plain(x) for x in texts]
    assert len(encoded([None])[0]) == 0 and encoded([]) == []


def test_runs_cover_all():
    texts = pa.array(["a" * n for n in (3, 0, 9, 1, 1, 20, 2)] + [None])
    runs = list(in_runs(texts, 10))
    assert [i for a, b in runs for i in range(a, b)] == list(range(8))
    assert list(in_runs(pa.array([], pa.string()))) == []


ROWS = [(5, "one two  three"), (2, None), (2, ""), (None, "null id"), (9, "word " * 9000), (1, "\n\n x <|endoftext|> y"), (3, "same"), (3, "same"), (-4, "minus")]


def test_rans_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rans_files, "BLOCK_IDS", 50)
    docs = spark.createDataFrame([(d, t, 1) for d, t in ROWS], "doc_id long, text string, part int")
    rans_files.write_ids(spark, docs, PATH, str(tmp_path / "f"))
    found = rans_files.read_ids(spark, str(tmp_path / "f"), with_ids=True).collect()
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found[:-1]]]).tolist()
    # rows that share a doc_id stand in any fixed order
    assert [r.doc_id for r in found] == sorted((d for d, _ in ROWS), key=lambda d: (d is not None, d or 0))
    want = [(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids) for d, ids in ((d, [*plain(t), 2]) for d, t in ROWS)]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32, r.ids) for r in found), key=str) == sorted(want, key=str)


def test_rans_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    rans_files.write_ids(spark, docs, PATH, str(tmp_path / "f"))
    assert rans_files.read_ids(spark, str(tmp_path / "f")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 300_000])
def test_frames(n):
    ids = (np.random.default_rng(n).zipf(1.2, n) % 50_000).astype(np.uint32)
    table = rans_files.FrequencyTable(dict(zip(*[x.tolist() for x in np.unique(ids, return_counts=True)], strict=True)))
    frame = rans_files.Frame(rans_files.encode_frame(table, 7, [1, None], np.array([n, 0]), ids))
    assert frame.start == 7 and frame.doc_ids == [1, None]
    assert (frame.decode(table) == ids).all()
    # any stretch by itself
    for k in range(len(frame.places)):
        begin = k * frame.stride * frame.lanes
        part = frame.stretch(table, k)
        assert (part == ids[begin : begin + len(part)]).all()


def test_damaged_frame_is_noticed():
    ids = np.arange(3000, dtype=np.uint32) % 7
    table = rans_files.FrequencyTable({i: 1 for i in range(7)})
    frame = bytearray(rans_files.encode_frame(table, 0, [1], np.array([3000]), ids))
    frame[len(frame) // 2] ^= 1
    with pytest.raises(ValueError):
        rans_files.Frame(bytes(frame))


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        assert 1 <= r.length <= capacity
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pack_documents(spark):
    docs = spark.createDataFrame([(d, t, 1) for d, t in ROWS], "doc_id long, text string, length int")
    rows = packing.pack_documents(spark, docs, PATH).collect()
    want = []
    for d, t in ROWS:
        ids = [*plain(t), 0]
        cut = (len(ids) - 1) % 2048 + 1
        for k, (a, b) in enumerate(zip([0, *range(cut, len(ids), 2048)], [*range(cut, len(ids), 2048), len(ids)], strict=True)):
            want.append((d or 0, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    check_packing(rows, 2048)
    assert packing.pack_documents(spark, docs.limit(0), PATH).count() == 0


def test_pack_many_alike(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_GROUP", 100)
    pieces = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 11 + 1 END AS length", "'x' AS offset")
    rows = packing.pack(spark, pieces, capacity=20).collect()
    assert len(rows) == 3000
    # the optimum isn't known; no packing has fewer sequences than the tokens fill
    assert check_packing(rows, 20) <= 1.01 * sum(r.length for r in rows) / 20


def test_pack_repeated_rows(spark, monkeypatch):
    """Rows without anything to tell them apart are spread over groups too."""
    monkeypatch.setattr(packing, "RANK_GROUP", 50)
    pieces = spark.range(2500).selectExpr("CAST(null AS long) AS doc_id", "0 AS piece", "3L AS length")
    rows = packing.pack(spark, pieces, capacity=10).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 2500
    assert check_packing(rows, 10) == 834


def whole(plan, histogram, capacity):
    used = {}
    for copies, times in plan.rows:
        assert sum(k * n for k, n in copies.items()) <= capacity
        for k, n in copies.items():
            used[k] = used.get(k, 0) + n * times
    assert used == histogram


@pytest.mark.parametrize("seed", range(3))
def test_plan_is_whole_and_near_the_bound(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randrange(1, 40) for n in rng.sample(range(1, 101), 60)}
    plan = packing.solve(histogram, 100)
    whole(plan, histogram, 100)
    assert plan.bound <= plan.sequences <= 1.02 * plan.bound + 2


def test_sequences_come_from_the_program():
    """With 1,500 distinct lengths, all of them rows of the program, nearly every sequence is one of its configurations."""
    rng = np.random.default_rng(3)
    lengths, n = np.unique(np.minimum(2048, rng.lognormal(6, 1, 12_000).astype(int) + 1), return_counts=True)
    histogram = dict(zip(lengths.tolist(), n.tolist(), strict=True))
    assert len(histogram) > 1000
    plan = packing.solve(histogram, 2048, rounds=100)
    whole(plan, histogram, 2048)
    assert plan.shared >= 0.97 * plan.sequences
    assert plan.sequences <= 1.002 * plan.bound + 1
    # the bound is no greater than the optimum: no plan is under what the tokens fill
    assert plan.bound <= plan.sequences and plan.bound >= (lengths * n).sum() / 2048 - 1e-6


def test_knapsack_against_all_subsets():
    rng = random.Random(1)
    for _ in range(20):
        lengths = np.array(sorted(rng.sample(range(2, 12), 4)))
        prices = np.array([rng.random() for _ in lengths])
        best = 0.0

        def walk(i, room, value):
            nonlocal best
            best = max(best, value)
            for k in range(i, 4):
                if lengths[k] <= room:
                    walk(k, room - lengths[k], value + prices[k])

        walk(0, 25, 0.0)
        sack = packing.Knapsack(lengths, prices, 25)
        copies = sack.copies(25)
        assert abs(sack.best[25] - best) < 1e-9
        assert abs(sum(prices[i] * n for i, n in copies.items()) - best) < 1e-9
        value, copies = sack.with_length(2)
        assert copies[2] >= 1 and sum(lengths[i] * n for i, n in copies.items()) <= 25 and value <= best + 1e-9
