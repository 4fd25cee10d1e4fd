import hashlib
import itertools
import random
import re
import zlib

import pytest

from tallyloom.llm import turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, stretch string, cost string"
SPACE = " \t\n\x0b\x0c\r"


def edits(symbols):
    """Every sequence of edits with up to two insertions in a row: cost, audit, initials."""
    gaps = [(0, "", ""), (5, "I", "u"), (5, "I", "a"), (10, "II", "ua"), (10, "II", "au")]
    choices = []
    for x in symbols:
        more = 5 if x.isupper() and x != "D" else 0
        rows = [(2, "D", "")]
        if x != "D":
            rows += [(more, "K", x.lower()), (1 + more, "R", "u"), (1 + more, "R", "a")]
        choices += [rows, gaps]
    for one in itertools.product(gaps, *choices):
        cost, audit, initials = sum(e[0] for e in one), "".join(e[1] for e in one), "".join(e[2] for e in one)
        if re.fullmatch("(s?(ua)+)?", initials):
            yield cost, audit, initials


@pytest.mark.parametrize("symbols", ["", *"suaxD", *"SUAX", *map("".join, itertools.product("suxAD", repeat=2)), "uau", "aDs", "sAu", "SSu", "xUa", "DuA", "ssa", "aau"])
def test_cells_against_every_edit_sequence(symbols):
    cost, spans = turn_repair.parse([turn_repair.span_cell(symbols)])
    (state, audit), *_ = spans
    best = min(edits(symbols))
    assert (cost, audit) == best[:2]
    rows, roles = turn_repair.replay(symbols, state, audit)
    assert "".join(symbols[k].lower() if r is None else r[0] for k, r in zip(rows, roles, strict=True)) == best[2]


def forward(symbols):
    """Least (cost, audit) to each state, row by row."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    def inserted(at):
        for _ in range(4):
            for (p, x), q in step.items():
                if x != "s" and p in at:
                    at[q] = min(at.get(q, (9**9, "")), (at[p][0] + 5, at[p][1] + "I"))
        return at

    at = inserted({0: (0, "")})
    for x in symbols:
        more, new = (5 if x.isupper() and x != "D" else 0), {}
        for p, (cost, audit) in at.items():
            options = [(p, 2, "D")]
            if x != "D":
                options += [(step.get((p, x.lower())), more, "K")] + [(step.get((p, r)), 1 + more, "R") for r in "ua"]
            for q, c, letter in options:
                if q is not None:
                    new[q] = min(new.get(q, (9**9, "")), (cost + c, audit + letter))
        at = inserted(new)
    return min(at[q] for q in (0, 3) if q in at)


def test_spans_put_together_anywhere_against_a_forward_search():
    rng = random.Random(3)
    for n in [*range(30), 200, 700]:
        symbols = "".join(rng.choice("suaxuauaDSUAX") for _ in range(n))
        want = forward(symbols)
        for size in (1, 3, 64, 1000):
            cost, spans = turn_repair.parse([turn_repair.span_cell(symbols[k : k + size]) for k in range(0, n, size)])
            assert (cost, "".join(x for _, x in spans)) == want


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(conv, rows):
    rows = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        said = "".join(c for c in text if c not in SPACE)
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    symbols = "".join("D" if f in ("blank", "duplicate") else (i if i in ("s", "u", "a") else "x").upper() if f else (i if i in ("s", "u", "a") else "x") for f, i in zip(faults, initials, strict=True))
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit = forward(symbols)
    out, k, last = [], 0, ""
    for letter in audit:
        if letter == "K":
            out.append(f"{rows[k][1]}:{rows[k][2]}")
            last = rows[k][1][:1]
        elif letter != "D":
            last = "a" if last == "u" else "u"
            out.append(f"{'assistant' if last == 'a' else 'user'}:{rows[k][2] if letter == 'R' else ''}")
        k += letter != "I"
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    return conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(40), None, -7]:
        turns = rng.randrange(1, 12)
        for turn in range(turns):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            role = rng.choice([None, "", "tool", "User", "system"]) if rng.random() < 0.1 or (turn == 0 and rng.random() < 0.3) else role
            text = rng.choice([None, "", " \n", "Cut off", "Yes.", "Yes.", "No! ", "What?\n", "Café été.", " "])
            rows.append((conv, rng.choice([turn, turn, turn + 600, None, 3]) if conv != 1 else turn, role, text))
    rows += [(50, k, ["user", "assistant"][k % 2], f"Said {k}.") for k in range(1500)] + [(51, 0, "user", "w " * 100_000 + ".")]
    rows += [(52, k, "user", "same.") for k in range(40)] + [(53, None, None, None)]
    gone = next(k for k in range(100, 400) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "Gone.")]


@pytest.mark.parametrize("part", [512, 3])
def test_repair_of_damaged_conversations(spark, monkeypatch, part):
    monkeypatch.setattr(turn_repair, "PART", part)
    rows = conversations(part)
    turns = spark.createDataFrame([(*r, "s", "c") for r in rows], SCHEMA).repartition(3)
    found = turn_repair.repaired_digests(turns, *turn_repair.repair(spark, turn_repair.damage(turns))).collect()
    after = damaged(rows)
    want = [brute(conv, after) for conv in {r[0] for r in rows}]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_empty(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repaired_digests(turns, *turn_repair.repair(spark, turns)).collect() == []
