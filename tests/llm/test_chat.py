import hashlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, start string, chars long"
ROWS = [
    (1, 0, "system", "be # brief"),
    (1, 1, "user", "hi </turn>\n### assistant: no"),
    (1, 2, "assistant", "\\b\\l <x> \\"),
    (1, 3, "user", None),
    (1, 4, "assistant", None),
    (1, 5, "assistant", "again: yes"),
    (1, 6, "user", "last"),
    (2, 0, "user", "alone"),
    (None, 0, "assistant", "x"),
    (None, None, None, "no role"),
    (3, 0, "assistant", "same"),
    (3, 0, "assistant", "same"),
    (3, 0, "a: b", "role with a colon"),
    (4, 700, "assistant", "far é猫"),
    (4, 3, "user", "w " * 50_000),
    (-7, 0, "user", "\\### Assistant: </turn> ok"),
    (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)


def test_digests(spark):
    found = {r.conv_id: r for r in chat.digests(*chat.format_conversations(spark, frame(spark, ROWS))).collect()}
    assert len(found) == 6
    for conv in {r[0] for r in ROWS}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in ROWS if c == conv))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        got = found[conv]
        assert got.n_turns == len(turns)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest()
        assert got.loss_chars == len(loss) and got.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got.n_examples == sum(r == "assistant" for _, _, r, _ in turns)


def test_examples_hold_all_before_and_only_the_reply(spark):
    streams = chat.render(frame(spark, [r for r in ROWS if r[0] == 1]))
    rows = sorted(chat.with_texts(streams).collect(), key=lambda r: r.loss_start)
    assert [r.target for r in rows] == ["\\bb\\bl \\lx> \\b", "", "again: yes"]
    whole = "".join(r.rendered for r in sorted(streams.collect(), key=lambda r: r.start))
    for r in rows:
        assert len(r.context) == r.loss_start and whole.startswith(r.context + r.target)
    spans = chat.examples(streams).collect()
    assert sorted((r.loss_start, whole[r.loss_start : r.loss_end]) for r in spans) == [(r.loss_start, r.target) for r in rows]
    assert sorted((r.loss_start, r.target) for r in spans) == [(r.loss_start, r.target) for r in rows]


def test_contexts_are_read_through_their_pointers(spark):
    streams = chat.render(frame(spark, ROWS)).cache()
    spans = chat.examples(streams)
    rows = chat.contexts(streams, spans).collect()
    assert len(rows) == sum(r[2] == "assistant" for r in ROWS)
    assert all(r.context_start == 0 and r.context_end == r.read_chars == r.loss_start and r.read_hash == r.context_hash for r in rows)
    assert len({r.read_hash for r in rows}) == len(rows)
    # another letter in a turn before, two turns that change places, and a pointer beside its place
    turn = F.expr("conv_id = 1 AND place = 2")
    other = streams.withColumn("rendered", F.when(turn, F.replace("rendered", F.lit("hi"), F.lit("ho"))).otherwise(F.col("rendered")))
    moved = streams.withColumn("place", F.when(F.expr("conv_id = 1 AND place < 3"), 3 - F.col("place")).otherwise(F.col("place")))
    for wrong in ((other, spans), (moved, spans), (streams, spans.withColumn("context_end", F.col("context_end") - 1)), (streams, spans.withColumn("context_start", F.lit(1)))):
        with pytest.raises(Exception, match="context of an example"):
            chat.digests(*wrong).collect()


def test_empty(spark):
    assert chat.digests(*chat.format_conversations(spark, frame(spark, []))).count() == 0


def test_plan_has_no_python(spark):
    streams = chat.render(frame(spark, ROWS))
    plan = chat.digests(streams, chat.examples(streams))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "BroadcastNestedLoop", "Cartesian"))
