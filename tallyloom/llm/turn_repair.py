"""Repair of conversations whose turns are out of order, by weighted interval parsing.

A sound conversation's role initials are ``(s?(ua)+)?``.  The grammar is in
Chomsky normal form: its nonterminals A(p, q) lead from state p to state q, a
single row is read by an edit, and A(p, q) is A(p, r) A(r, q).  A cell of the
chart belongs to a span of rows and holds, for every nonterminal, the least
(cost, audit); insertions are closed over around every row.  As A(p, q) can be
cut anywhere, a span is put together from two spans half as long, bottom-up by
span length, and equal spans share a cell.

The least audit of a span is made of least audits: among equal costs none is
the beginning of another, since an edit more costs more.

Rows are parsed in stretches of PART, in parallel; the cells of a conversation's
stretches are put together the same way and give each stretch its states.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work

#: Costs of the edits; an undeleted truncated row costs so much besides.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing said, after a system, a user, an assistant turn; what a role's initial leads to.
STATES = 4
STEPS = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
#: A conversation may end before it began and after an assistant.
ENDS = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Fixed value: characters that make no difference between blank and empty, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
#: Turns of one conversation that are put in order together, and rows that are parsed together.
PART = 512

Cell = dict[tuple[int, int], tuple[int, str]]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans: A(p, q) from A(p, r) A(r, q)."""
    found: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(STATES):
            if (r, q) in right:
                more, rest = right[r, q]
                if (p, q) not in found or (cost + more, audit + rest) < found[p, q]:
                    found[p, q] = cost + more, audit + rest
    return found


@lru_cache(1)
def insertions() -> Cell:
    """The closure of insertions: any number of inserted turns, none included."""
    one: Cell = {step: (INSERT, "I") for role in NAMES for step in STEPS[role]}
    found: Cell = one | {(p, p): (0, "") for p in range(STATES)}
    for _ in range(STATES):  # no longer run of insertions can be the cheapest
        found = joined(found, found)
    return found


@lru_cache(64)
def row_cell(symbol: str) -> Cell:
    """The cell of one row: its role's initial, x for any other, in upper case if truncated; D if it has to go."""
    found: Cell = {(p, p): (DELETE, "D") for p in range(STATES)}
    if symbol != "D":
        more = TRUNCATED if symbol.isupper() else 0
        edits = [(KEEP + more, "K", step) for step in STEPS.get(symbol.lower(), ())]
        edits += [(REROLE + more, "R", step) for role in NAMES for step in STEPS[role]]
        for cost, letter, step in edits:
            found[step] = min(found.get(step, (cost, letter)), (cost, letter))
    return joined(joined(insertions(), found), insertions())


@lru_cache(1 << 14)
def span_cell(symbols: str) -> Cell:
    """The cell of a span of rows; its left part's length is a power of two."""
    if len(symbols) < 2:
        return row_cell(symbols) if symbols else insertions()
    half = 1 << ((len(symbols) - 1).bit_length() - 1)
    return joined(span_cell(symbols[:half]), span_cell(symbols[half:]))


def parse(cells: list[Cell]) -> tuple[int, list[tuple[int, str]]]:
    """The least cost of neighbouring spans from beginning to end, and each one's first state and audit."""
    levels = [cells or [insertions()]]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([joined(*below[k : k + 2]) if k + 1 < len(below) else below[k] for k in range(0, len(below), 2)])
    top = levels[-1][0]
    end = min((top[0, q], q) for q in ENDS if (0, q) in top)[1]
    chosen = [(0, end)]
    for below, above in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
        spread = []
        for k, (p, q) in enumerate(chosen):
            if 2 * k + 1 == len(below):
                spread.append((p, q))
                continue
            a, b = below[2 * k], below[2 * k + 1]
            want = above[k][p, q]
            r = next(r for r in range(STATES) if (p, r) in a and (r, q) in b and (a[p, r][0] + b[r, q][0], a[p, r][1] + b[r, q][1]) == want)
            spread += [(p, r), (r, q)]
        chosen = spread
    return top[0, end][0], [(p, cell[p, q][1]) for cell, (p, q) in zip(levels[0], chosen, strict=True)]


def replay(symbols: str, state: int, audit: str) -> tuple[list[int], list[str | None]]:
    """What an audit leaves of a span: rows by number, -1 if inserted, and their roles, null if kept."""
    rows, roles, k = [], [], 0
    for letter in audit:
        if letter != "D":
            initial = symbols[k].lower() if letter == "K" else "a" if state == 2 else "u"
            state = dict(STEPS[initial])[state]
            rows.append(-1 if letter == "I" else k)
            roles.append(None if letter == "K" else NAMES[initial])
        k += letter != "I"
    return rows, roles


def ordered(turns: DataFrame) -> DataFrame:
    """The rows in order: conv_id, stretch, place, turn, first_of_turn, role, text, fault, initial, symbol."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.floor(F.col("turn") / PART).alias("stretch"))
    turn = F.col("turn").asc_nulls_first()
    rows = rows.withColumn("again", F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(turn)) > 1)
    inside = Window.partitionBy("conv_id", "stretch").orderBy(turn, "role", "text", "again")
    said = F.translate("text", SPACES, "")
    fault = F.when(said == "", "blank").when(F.col("again"), "duplicate").when(~F.substring(said, -1, 1).isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    rows = rows.withColumns({"place": F.row_number().over(inside) - 1, "first_of_turn": ~F.lag("turn").over(inside).eqNullSafe(F.col("turn")), "fault": fault, "initial": F.when(initial.isin(*STEPS), initial).otherwise("x")})
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "D").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return rows.withColumn("symbol", symbol).drop("again")


def _cells(symbols: pd.Series) -> pd.DataFrame:
    found = [span_cell(x) for x in symbols]
    every = [(p, q) for p in range(STATES) for q in range(STATES)]
    return pd.DataFrame({"costs": [[c.get(x, (-1, ""))[0] for x in every] for c in found], "audits": [[c.get(x, (-1, ""))[1] for x in every] for c in found]})


def _parsed(costs: pd.Series, audits: pd.Series, initials: pd.Series) -> pd.DataFrame:
    found = []
    for c, a, marks in zip(costs, audits, initials, strict=True):
        cells = [{divmod(k, STATES): (int(n), s) for k, (n, s) in enumerate(zip(x, y, strict=True)) if n >= 0} for x, y in zip(c, a, strict=True)]
        cost, spans = parse(cells)
        illegal = sum(marks[k : k + 2] not in LEGAL for k in range(len(marks) - 1))
        found.append((cost, "".join(x for _, x in spans), illegal, [p for p, _ in spans], [x for _, x in spans]))
    return pd.DataFrame(found, columns=["cost", "audit", "illegal", "states", "audits"])


def _replayed(symbols: pd.Series, states: pd.Series, audits: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([replay(*x) for x in zip(symbols, states, audits, strict=True)], columns=["rows", "roles"])


def repair(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report per conversation, and the repaired rows.

    Reports: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    Repaired: conv_id, stretch, part, step, role, text; in the order of the
    three numbers a conversation's rows, a null stretch first.

    turns: conv_id, turn, role, text in any order; other columns are not looked
    at.  Null roles and texts are one space.  Rows stand by turn, null first,
    those of one turn by role and text; rows with a null conv_id make one
    conversation.  Every row counts its first fault: blank, duplicate (role and
    text seen earlier), truncated (not ended by ``.``, ``!`` or ``?``).  An
    empty table gives none.  A conversation's audit is one value, a letter for
    each row and insertion, and so is gathered in one place; texts are not.
    """
    work = Work(spark, "turn-repair")
    rows = work.save(ordered(turns), "rows")
    joined_by = lambda x: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", x))), lambda y: y[x]), "")
    counted = {x: F.count(F.when(F.col("fault") == x, 1)) for x in ("blank", "duplicate", "truncated")}
    turn = {"low": F.min("turn"), "high": F.max("turn"), "turns": F.count(F.when(F.col("first_of_turn") & F.col("turn").isNotNull(), 1))}
    parts = rows.groupBy("conv_id", "stretch", F.floor(F.col("place") / PART).alias("part")).agg(joined_by("symbol").alias("symbols"), joined_by("initial").alias("initials"), *[c.alias(n) for n, c in (counted | turn).items()])
    parts = parts.withColumn("cell", F.pandas_udf(_cells, "costs array<long>, audits array<string>")("symbols")).select("*", "cell.costs", "cell.audits")
    one = F.sort_array(F.collect_list(F.struct("stretch", "part", "symbols", "initials", "costs", "audits"))).alias("parts")
    whole = parts.groupBy("conv_id").agg(one, *[F.sum(x).alias(x) for x in (*counted, "turns")], F.min("low").alias("low"), F.max("high").alias("high"))
    whole = whole.withColumn("parsed", F.pandas_udf(_parsed, "cost long, audit string, illegal long, states array<int>, audits array<string>")("parts.costs", "parts.audits", F.array_join("parts.initials", "")))
    spans = F.arrays_zip(*[F.col(x).alias(n) for x, n in (("parts.stretch", "stretch"), ("parts.part", "part"), ("parts.symbols", "symbols"), ("parsed.states", "state"), ("parsed.audits", "audit"))])
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    parsed = work.save(whole.select("conv_id", gaps.alias("gaps"), *counted, "parsed.illegal", "parsed.cost", "parsed.audit", spans.alias("spans")), "parsed")

    steps = parsed.select("conv_id", F.explode("spans").alias("span")).select("conv_id", "span.*").withColumn("said", F.pandas_udf(_replayed, "rows array<int>, roles array<string>")("symbols", "state", "audit"))
    steps = steps.select("conv_id", "stretch", "part", F.posexplode(F.arrays_zip(F.col("said.rows").alias("row"), F.col("said.roles").alias("role"))).alias("step", "edit"))
    steps = steps.select("conv_id", "stretch", "part", "step", F.when(F.col("edit.row") >= 0, F.col("edit.row") + F.col("part") * PART).alias("place"), F.col("edit.role").alias("new_role"))
    a, b = steps.alias("a"), rows.select("conv_id", "stretch", "place", "role", "text").alias("b")
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & F.col("a.stretch").eqNullSafe(F.col("b.stretch")) & (F.col("a.place") == F.col("b.place"))
    repaired = a.join(b, same, "left").select("a.conv_id", "a.stretch", "part", "step", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return parsed.drop("spans"), repaired


def damage(turns: DataFrame) -> DataFrame:
    """Conversations to repair: by crc32(``conv_id:turn``) % 20 rows go (0), are emptied (1), lose their ends (2), are said twice (3) or become a user's (4).

    Nulls are one space, in the key too.
    """
    space = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(space("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    rows = turns.select("conv_id", "turn", "role", "text", kind.alias("kind")).filter("kind <> 0")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def repaired_digests(turns: DataFrame, reports: DataFrame, repaired: DataFrame) -> DataFrame:
    """The reports of all conversations of turns, zeros where no row is left, with repaired_sha256.

    That is the digest of ``role:text`` of the repaired rows, joined by line
    feeds, and needs a whole conversation in one place.
    """
    said = F.concat("role", F.lit(":"), "text")
    line = lambda at: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*at, "said"))), lambda x: x["said"]), "\n")
    texts = repaired.withColumn("said", said).groupBy("conv_id", "stretch", "part").agg(line(["step"]).alias("said")).groupBy("conv_id").agg(line(["stretch", "part"]).alias("said"))
    ids = turns.select("conv_id").distinct().alias("i")
    a, b = reports.alias("a"), texts.alias("b")
    rows = ids.join(a, F.col("i.conv_id").eqNullSafe(F.col("a.conv_id")), "left").join(b, F.col("i.conv_id").eqNullSafe(F.col("b.conv_id")), "left")
    numbers = [F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("i.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce("said", F.lit("")), 256).alias("repaired_sha256"))
