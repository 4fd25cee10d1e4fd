"""Exact top-k by Hamming distance: incremental multi-index hashing.

A code of 64 bits is cut into m segments of about log2(entries) bits.  Radii grow
one after another: at radius r the values that differ from the query's in exactly
r bits are looked up, segment by segment, and what smaller radii found stays.  A
code that no look-up has found after segment s (from 0) differs in more than r
bits in s + 1 segments and in more than r - 1 in the others, so every code within
distance m * r + s has been seen: once a query's kth verified neighbour lies
there, the query is done.

Equal codes are one entry of the index, which carries as many of the smallest
ids as a result can show, so a code that a third of all rows share costs no more
than another.  Equal queries are one query.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import combinations
from math import comb, log2

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Work

BITS = 64
#: Look-ups of one query up to which a radius takes all segments in one step.
FEW = 4096
#: Look-ups that one task spells out.
SPELLED = 500_000


def sign_code(vector: str | Column) -> Column:
    """64 bits: which of a vector's first 64 numbers are positive; null for a null or shorter vector.

    A null or NaN number counts as not positive.
    """
    v = F.col(vector) if isinstance(vector, str) else vector

    def positive(i: int) -> Column:
        x = v[i]
        return F.when((x > 0) & ~F.isnan(x), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))

    code = F.lit(0).cast("long")
    for i in range(BITS):
        code = code.bitwiseOR(F.shiftleft(positive(i), i))
    return F.when(F.size(v) >= BITS, code)


def _cuts(entries: int) -> list[tuple[int, int]]:
    """First bit and width of each segment: about log2(entries) bits, so that a value has about one entry."""
    m = max(2, min(BITS, round(BITS / log2(max(entries, 2)))))
    ends = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _segment(code: Column, cut: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(code, cut[0]).bitwiseAND(F.lit((1 << cut[1]) - 1).cast("long"))


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def top_k(spark: SparkSession, index: DataFrame, queries: DataFrame, *, k: int = 10) -> DataFrame:
    """query_id, rank, id, distance: for each query its k nearest rows of the index by (distance, id).

    index: id, code; queries: query_id, code (64 bits).  A row whose id is the
    query's own is not its neighbour.  Rows with a null id or code are left
    out, queries with a null id or code too.  Rows that repeat an id with one code
    count once; an id with several codes counts with each, a query_id too and
    gives k rows for each code.  With fewer than k rows all are given.  Other
    columns are not looked at.
    """
    work = Work(spark, "hamming")
    rows = index.select("id", "code").dropna().distinct()
    smallest = Window.partitionBy("code").orderBy("id")
    # k + 1 ids of a code are enough: one may be the query's own
    kept = rows.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= k + 1)
    entries = work.save(kept.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    asked = work.save(queries.select("query_id", "code").dropna().distinct(), "asked")
    # bound: the distance of a query's last verified entry, beyond which nothing can be shown
    pending = work.save(asked.select(F.col("code").alias("query"), F.lit(BITS).alias("bound")).distinct(), "pending")
    cuts = _cuts(entries.count())
    m, parallel = len(cuts), spark.sparkContext.defaultParallelism
    cut = work.save(entries.select("code", F.size("ids").alias("n"), F.col("ids")[0].alias("first"), F.posexplode(F.array(*[_segment(F.col("code"), c) for c in cuts])).alias("segment", "value")), "segments")
    own = Window.partitionBy("query")
    found, done = None, []
    for radius, segments in _steps(cuts):
        if not (left := pending.count()):
            break
        covered = BITS if radius == max(w for _, w in cuts) and segments[-1] == m - 1 else m * radius + segments[-1]
        new = _looked_up(pending, cut, cuts, radius, segments, left, parallel)
        both = new if found is None else new.unionByName(found)
        # the k + 1 entries of the smallest ids: none beyond them can be shown
        best = both.withColumn("_n", F.row_number().over(own.orderBy("distance", "first"))).filter(F.col("_n") <= k + 1).drop("_n")
        seen, near = F.sum("n").over(own), F.coalesce(F.sum(F.when(F.col("distance") <= covered, F.col("n"))).over(own), F.lit(0))
        best = work.save(best.withColumns({"bound": F.when(seen >= k + 1, F.max("distance").over(own)).otherwise(BITS), "ready": (near >= k + 1) | F.lit(covered >= BITS)}), "best")
        done.append(best.filter("ready").select("query", "code", "distance"))
        if covered >= BITS:
            break
        found = best.filter("NOT ready").drop("bound", "ready")
        each = best.groupBy("query").agg(F.max("bound").alias("_bound"), F.bool_or("ready").alias("ready"))
        pending = work.save(pending.join(each, "query", "left").filter(~F.coalesce("ready", F.lit(False))).select("query", F.coalesce("_bound", "bound").alias("bound")), "pending")
    none = pending.select("query", F.col("query").alias("code"), F.lit(0).alias("distance")).filter(F.lit(False))
    hits = reduce(DataFrame.unionByName, done, none)
    ids = hits.select("query", "code", "distance").join(entries, "code").select("query", "distance", F.explode("ids").alias("id"))
    # equal queries share their list of k + 1
    lists = ids.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy("distance", "id"))).filter(F.col("_n") <= k + 1).drop("_n")
    given = asked.select("query_id", F.col("code").alias("query")).join(lists, "query").filter(F.col("id") != F.col("query_id"))
    ranked = given.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query").orderBy("distance", "id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", F.col("distance").cast("int").alias("distance"))


def _steps(cuts: list[tuple[int, int]]):
    """radius and the segments that are searched together: one, or all where a radius has few values."""
    m = len(cuts)
    for radius in range(max(width for _, width in cuts) + 1):
        together = m * comb(cuts[-1][1], radius) <= FEW
        for s in [range(m)] if together else [range(s, s + 1) for s in range(m)]:
            yield radius, s


def _looked_up(pending: DataFrame, cut: DataFrame, cuts: list[tuple[int, int]], radius: int, segments: range, left: int, parallel: int) -> DataFrame:
    """query, code, n, first, distance of the entries that this step finds and none before."""
    values = [[sum(1 << b for b in bits) for bits in combinations(range(cuts[s][1]), radius)] for s in segments]
    spelled = pending.repartition(max(parallel, left * sum(map(len, values)) // SPELLED), "query")
    flips = F.from_json(F.lit(json.dumps(values)), "array<array<bigint>>")
    own = F.array(*[_segment(F.col("query"), cuts[s]) for s in segments])
    probes = spelled.select("query", "bound", own.alias("own"), F.posexplode(flips).alias("at", "flips")).select("query", "bound", (F.col("at") + segments[0]).alias("segment"), F.explode(F.transform("flips", lambda x: x.bitwiseXOR(F.get("own", F.col("at"))))).alias("value"))
    differ = [F.bit_count(_segment(F.col("p.query").bitwiseXOR(F.col("c.code")), c)) for c in cuts]
    before = reduce(Column.__or__, [(d < radius) | ((F.col("p.segment") > s) & (d == radius)) for s, d in enumerate(differ)])
    distance = _distance(F.col("p.query"), F.col("c.code"))
    # merged: Spark would take the spelled-out values for as few as the queries, and broadcast them
    pairs = probes.alias("p").join(cut.hint("merge").alias("c"), (F.col("p.segment") == F.col("c.segment")) & (F.col("p.value") == F.col("c.value")) & (distance <= F.col("p.bound")) & ~before)
    return pairs.select("query", "code", "n", "first", distance.alias("distance"))
