"""Joins that Spark has no operator for, as equi-joins that Catalyst can plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.lineage import checkpointed


#: Rows of one side that a bin may have before it is split, and the bins that are split at most; any other has at most one row in so many.
BIN_ROWS = 20_000
SPLIT_BINS = 10_000
#: A level's bins are so many times as wide as those of the one below, and the most bins that an interval is dealt to on its own level.
LEVEL, MOST_BINS = 32, 16


def range_join(left: DataFrame, right: DataFrame, keys: list[str], width: int, *, pad: int = 0, how: str = "overlap", adaptive: bool = True, alike: list[str] | None = None, with_bins: bool = False) -> DataFrame:
    """Pairs of rows with equal keys whose intervals overlap, as structs l and r.

    Both sides have the keys and ``start`` and ``end`` (closed, whole numbers).
    Intervals are dealt to bins of width; a pair is kept in the bin where the
    later one begins, so none comes twice.  Intervals longer than MOST_BINS bins
    stand on coarser levels, and a pair is made on the coarser of its two.
    Where a bin has more than BIN_ROWS rows of a side, that side's rows are
    dealt to parts and the other's are given to each.  Without adaptive, bins
    aren't counted before and there is one level.  pad widens the left
    intervals.  how: overlap, or within (the right one inside the left one).
    Null bounds match nothing.

    with_bins: the pairs' bins come as columns of range_bins(keys), by which the
    pairs lie after a shuffled join; left rows of one place that are equal in
    alike, too, have equal ones.
    """

    def bounded(df: DataFrame, name: str, by: int) -> DataFrame:
        low, high = F.col("start") - by, F.col("end") + by
        rows = df.filter(F.col("start") <= F.col("end")).select(F.struct("*").alias(name), *[F.col(k).alias(f"_{k}") for k in keys], low.alias(f"{name}_low"), high.alias(f"{name}_high"))
        bins = (F.col(f"{name}_high") - F.col(f"{name}_low")) / (width * MOST_BINS)
        level = F.when(bins <= 1, 0).otherwise(F.ceil(F.log(bins) / F.log(F.lit(float(LEVEL)))))
        return rows.withColumn(f"{name}_level", level.cast("int") if adaptive else F.lit(0))

    def dealt(df: DataFrame, name: str, levels: list[int]) -> DataFrame:
        """Rows at their own level, or at each coarser one of the other side's."""
        at = F.array_distinct(F.transform(F.array(*[F.lit(x) for x in levels]), lambda x: F.greatest(x, F.col(f"{name}_level"))))
        rows = df.withColumn("_level", F.explode(at) if adaptive else F.lit(0))
        size = F.lit(width) * F.pow(F.lit(LEVEL), F.col("_level")).cast("long")
        return rows.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(f"{name}_low") / size), F.floor(F.col(f"{name}_high") / size))))

    by = [*[f"_{k}" for k in keys], "_level", "_bin"]
    a, b = bounded(left, "l", pad), bounded(right, "r", 0)
    if adaptive:
        sides = [sorted(r[0] for r in x.select(f"{n}_level").distinct().collect()) for x, n in ((a, "l"), (b, "r"))]  # a handful of levels
        a, b = dealt(a, "l", sides[1] or [0]), dealt(b, "r", sides[0] or [0])
        counts = a.select(*by, F.lit(1).alias("_l"), F.lit(0).alias("_r")).union(b.select(*by, F.lit(0), F.lit(1))).groupBy(*by).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        # bins with rows of one side alone make no pair
        hot = counts.filter((F.greatest("_l", "_r") > BIN_ROWS) & (F.least("_l", "_r") > 0)).orderBy(F.desc(F.greatest("_l", "_r")), *by).limit(SPLIT_BINS)
        parts = {n: F.when(F.col(f"_{n}") > BIN_ROWS, F.ceil(F.col(f"_{n}") / BIN_ROWS)).otherwise(1).cast("int").alias(f"_parts_{n}") for n in "lr"}
        hot = checkpointed(hot.select(*by, *parts.values()))
        a, b = split(a, hot, by, "l", "r", alike), split(b, hot, by, "r", "l")
        by = [*by, "_part_l", "_part_r"]
    else:
        a, b = dealt(a, "l", [0]), dealt(b, "r", [0])
    both = a.join(b, by)
    size = F.lit(width) * F.pow(F.lit(LEVEL), F.col("_level")).cast("long")
    meet = (F.col("l_low") <= F.col("r_high")) & (F.col("r_low") <= F.col("l_high")) & (F.col("_bin") == F.floor(F.greatest("l_low", "r_low") / size))
    meet = meet & (F.col("_level") == F.greatest("l_level", "r_level"))
    if how == "within":
        meet = meet & (F.col("r_low") >= F.col("l_low")) & (F.col("r_high") <= F.col("l_high"))
    return both.filter(meet).select("l", "r", *(by if with_bins else []))


def range_bins(keys: list[str]) -> list[str]:
    return [*[f"_{k}" for k in keys], "_level", "_bin", "_part_l", "_part_r"]


def split(rows: DataFrame, hot: DataFrame, by: list[str], own: str, other: str, alike: list[str] | None = None) -> DataFrame:
    """rows with _part_l and _part_r: in bins of hot, one of their own side's parts and every one of the other's."""
    rows = rows.join(F.broadcast(hot), by, "left")
    identity = [F.col(own)] if alike is None else [F.col(f"{own}.{c}") for c in ("start", "end", *alike)]
    mine = F.coalesce(F.pmod(F.xxhash64(*identity), F.col(f"_parts_{own}")).cast("int"), F.lit(0))
    every = F.sequence(F.lit(0), F.coalesce(F.col(f"_parts_{other}"), F.lit(1)) - 1)
    return rows.withColumns({f"_part_{own}": mine, f"_part_{other}": F.explode(every)}).drop("_parts_l", "_parts_r")


#: Letters of patterns of which every task can hold an automaton, about 100 bytes each; more are joined.
AUTOMATON_LETTERS = 4_000_000


def pattern_join(patterns: DataFrame, texts: DataFrame, *, seed: int = 7, first: bool = False, automaton_letters: int | None = None) -> DataFrame:
    """pattern_id, text_id, position (from 1) of every occurrence, or the first in each text.

    patterns: pattern_id, pattern; texts: text_id, text.  Patterns that
    together are short are sought with one automaton a task, in whole texts; others
    by their first letters: a bitmap of these drops nearly all places of the
    texts, the rest is joined and verified.  A text_id is one text's.  Null or
    empty patterns match nothing.
    """
    patterns = patterns.select("pattern_id", "pattern").filter(F.char_length("pattern") > 0)
    bounds = patterns.agg(F.coalesce(F.sum(F.char_length("pattern")), F.lit(0)), F.collect_set(F.least(F.char_length("pattern"), F.lit(seed)))).first()
    if bounds[0] <= (AUTOMATON_LETTERS if automaton_letters is None else automaton_letters):
        hits = _by_automaton(patterns, texts, first)
    else:
        hits = _by_seeds(patterns, texts, seed, sorted(bounds[1]) or [seed])
    return hits.groupBy("pattern_id", "text_id").agg(F.min("position").alias("position")) if first else hits


def _by_automaton(patterns: DataFrame, texts: DataFrame, first: bool) -> DataFrame:
    """Aho-Corasick over the distinct patterns; ids come by a join on the pattern's number."""
    spark = patterns.sparkSession
    known = [r.pattern for r in patterns.select("pattern").distinct().orderBy("pattern").collect()]
    shared = spark.sparkContext.broadcast(known)
    texts = texts.select("text_id", "text").filter("text <> ''")

    def find(batches):
        import ahocorasick
        import pyarrow as pa

        automaton = ahocorasick.Automaton()
        for i, x in enumerate(shared.value):
            automaton.add_word(x, (i, len(x)))
        if not len(automaton):
            return
        automaton.make_automaton()
        for batch in batches:
            rows, numbers, positions = [], [], []
            for k, text in enumerate(batch.column(1)):
                seen = set()
                for end, (i, n) in automaton.iter(text.as_py()):
                    if first:
                        if i in seen:
                            continue
                        seen.add(i)
                    rows.append(k)
                    numbers.append(i)
                    positions.append(end - n + 2)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(positions, pa.int32())], names=["text_id", "_number", "position"])

    kind = texts.schema["text_id"].dataType.simpleString()
    hits = texts.mapInArrow(find, f"text_id {kind}, _number int, position int")
    numbered = patterns.join(spark.createDataFrame(list(enumerate(known)), "_number int, pattern string"), "pattern").select("_number", "pattern_id")
    return hits.join(numbered, "_number").select("pattern_id", "text_id", "position")


#: Bits of the patterns' seeds that every task holds, at most: 16 MB; more patterns let more places through.
SEED_BITS = 1 << 27
#: Bits that each seed sets: with 16 bits a seed one place in 400 or so is let through in vain.
SEED_MARKS = 4


def _stretches(texts: list[str], sizes: list[int]):
    """For each size the places, in all texts one after another, of stretches inside one text, and their hashes; and where each text begins."""
    import numpy as np

    lengths = np.array([len(x) for x in texts], np.int64)
    begins = np.cumsum(lengths) - lengths
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    left = np.repeat(begins + lengths, lengths) - np.arange(len(letters))  # letters from here to the text's end
    found = np.zeros(len(letters), np.uint64)
    hashes = []
    for k in range(max(sizes)):
        found = found[: max(len(letters) - k, 0)] * np.uint64(0x9E3779B97F4A7C15) + letters[k:]
        if k + 1 in sizes:
            at = np.flatnonzero(left[: len(found)] > k)
            mixed = (found[at] ^ found[at] >> np.uint64(31)) * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
            hashes.append((k + 1, at, (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)))
    return begins, hashes


def _hashes(text: str, size: int):
    """Hashes of a text's stretches of size letters, by place."""
    return _stretches([text], [size])[1][0][2]


def _mark(hashes, k: int, bits: int):
    """The k-th bit of stretches by their hashes."""
    import numpy as np

    return (hashes + np.uint64(k) * (hashes >> np.uint64(22) | np.uint64(1))) % np.uint64(bits)


def _by_seeds(patterns: DataFrame, texts: DataFrame, seed: int, sizes: list[int]) -> DataFrame:
    """Places whose seed is among the patterns' go on; of these the pattern's letters are compared in the text.

    A task knows the seeds by a bitmap of all lengths, made by aggregation, so
    patterns pass through neither driver nor task.
    """
    spark = patterns.sparkSession
    asked = patterns.withColumn("_seed", F.left("pattern", F.lit(seed)))
    total, longest = asked.agg(F.approx_count_distinct("_seed"), F.max(F.char_length("pattern"))).first()
    bits = min(SEED_BITS, 1 << max(15, (16 * total - 1).bit_length()))

    def hashed(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            seeds = batch.column(0).to_pylist()
            lengths = np.array([len(x) for x in seeds], np.int64)
            begins, found = _stretches(seeds, sorted(set(lengths.tolist())) or [1])
            for size, at, h in found:
                whole = h[np.searchsorted(at, begins[lengths == size])]
                for k in range(SEED_MARKS):
                    yield pa.RecordBatch.from_arrays([pa.array(_mark(whole, k, bits).astype(np.int64))], ["at"])

    marks = asked.select("_seed").distinct().mapInArrow(hashed, "at long")
    pages = marks.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits"))
    shared = spark.sparkContext.broadcast([tuple(r) for r in pages.collect()])  # SEED_BITS at most

    def places(batches):
        import numpy as np
        import pyarrow as pa

        known = np.zeros(bits // 8, np.uint8)
        for page, found in shared.value:
            at = (page - 1) * len(found)
            part = np.frombuffer(found, np.uint8)[: bits // 8 - at]
            known[at : at + len(part)] = part
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):  # of long texts a few at a time
                ids, some = batch.column(0).slice(begin, 256), batch.column(1).slice(begin, 256).to_pylist()
                begins, found = _stretches(some, sizes)
                for size, at, h in found:
                    for k in range(SEED_MARKS):
                        bit = _mark(h, k, bits)
                        kept = (known[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1) > 0
                        at, h = at[kept], h[kept]
                    rows = np.searchsorted(begins, at, side="right") - 1
                    starts = at - begins[rows]
                    seeds = [some[k][x : x + size] for k, x in zip(rows.tolist(), starts.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(starts.astype(np.int32)), pa.array(seeds, pa.string())], names=["text_id", "_at", "_seed"])

    kind = texts.schema["text_id"].dataType.simpleString()
    texts = texts.select("text_id", "text").filter("text <> ''")
    met = texts.mapInArrow(places, f"text_id {kind}, _at int, _seed string").join(asked, "_seed")
    # where every pattern is its own seed, all have been compared
    if (longest or 0) > seed:
        met = met.join(texts, "text_id").filter(F.substring(F.col("text"), F.col("_at") + 1, F.char_length("pattern")) == F.col("pattern"))
    return met.select("pattern_id", "text_id", (F.col("_at") + 1).alias("position"))


def prioritised_join(left: DataFrame, right: DataFrame, attempts: list[list[tuple[str, str]]], key: list[str], order: list[Column] | None = None) -> DataFrame:
    """Each left row (its key is unique) with the best right row: of the first attempt that finds any, then by order.

    An attempt lists pairs of columns (left, right) to be equal.  Columns of the
    right side come as struct ``match`` with ``attempt`` from 0, null if none.
    """
    found = reduce(
        DataFrame.unionByName,
        [left.alias("a").join(right.alias("b"), reduce(Column.__and__, [F.col(f"a.{x}") == F.col(f"b.{y}") for x, y in pairs])).select(*[F.col(f"a.{k}").alias(k) for k in key], F.lit(n).alias("attempt"), F.struct("b.*").alias("match")) for n, pairs in enumerate(attempts)],
    )
    best = Window.partitionBy(*key).orderBy("attempt", *(order or []), "match")
    found = found.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")
    return left.join(found, key, "left")


def closure(edges: DataFrame, depth: int = 32) -> DataFrame:
    """node, ancestor of all nodes of edges (child, parent), a node itself included; cycles do no harm.

    A step joins the pairs that are new with all that are known, so that paths
    double in length and no pair is extended twice.
    """
    pairs = checkpointed(edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).filter("node <> ancestor").distinct())
    known = new = pairs
    for _ in range(depth):
        a, b = new.toDF("_a", "_via"), known.toDF("_via", "_b")
        c, d = known.toDF("_a", "_via"), new.toDF("_via", "_b")
        longer = a.join(b, "_via").select(F.col("_a").alias("node"), F.col("_b").alias("ancestor")).union(c.join(d, "_via").select("_a", "_b"))
        new = checkpointed(longer.filter("node <> ancestor").distinct().join(known, ["node", "ancestor"], "left_anti"))
        if new.isEmpty():
            break
        known = known.union(new)
    nodes = edges.select(F.col("child").alias("node")).union(edges.select("parent")).distinct()
    return known.union(nodes.select("node", F.col("node").alias("ancestor")))


#: Letters by which a peptide's parts are sought; longer ones are compared further.
PART_SEED = 32
#: First letters of patterns, of a few letters each, that are sent to every task; more are joined by a shuffle.
START_KEYS = 500_000


def longest_starts(patterns: DataFrame, texts: DataFrame, longest: int, *, least: int = 4, backwards: bool = False) -> DataFrame:
    """pattern, size, id, second: the most first letters of a pattern that any text holds, an id of such a text, and the most that a text of another id does; 0 if none.

    patterns: pattern, distinct; texts: id, text, either repeated or not; of no
    pattern more than longest letters matter, and none below least.  backwards:
    last letters in place of first.  What stands in texts is sorted together with
    the patterns: no text shares more with a pattern than its neighbours in that
    order do.  Neighbours share least letters, so each first letters' rows are
    sorted on their own, and only what begins as a pattern does is sorted at all.
    """
    turned = (lambda c: F.reverse(c)) if backwards else F.col
    start = F.left("_s", F.lit(least))
    asked = patterns.select("pattern", turned("pattern").alias("_s")).filter(F.char_length("_s") >= least).withColumn("_key", start)
    inside = texts.filter((F.char_length("text") >= least) & F.col("id").isNotNull()).select("id", turned("text").alias("_t"))
    stretches = F.transform(F.sequence(F.lit(1), F.char_length("_t") - least + 1), lambda at: F.substring(F.col("_t"), at, F.lit(longest)))
    places = inside.select("id", F.explode(stretches).alias("_s")).withColumn("_key", start)
    keys = checkpointed(asked.select("_key").distinct())
    places = places.join(F.broadcast(keys) if keys.count() <= START_KEYS else keys, "_key", "left_semi").groupBy("_key", "_s").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    rows = places.select("_key", "_s", F.struct("_s", "low", "high").alias("_text"), F.lit(None).cast("string").alias("pattern"))
    rows = rows.union(asked.select("_key", "_s", F.lit(None).cast(rows.schema["_text"].dataType), "pattern"))

    def nearest(rows: DataFrame, order: list[Column], out: str) -> DataFrame:
        """The text before a row in an order, and, if that one is a single id's, the nearest of another."""
        before = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        near, text = F.col(f"{out}1"), F.col("_text")
        rows = rows.withColumn(f"{out}1", F.last("_text", ignorenulls=True).over(before))
        rows = rows.withColumn("_other", F.when((near["low"] != near["high"]) | (near["low"] != text["low"]), near))
        return rows.withColumn(f"{out}2", F.last("_other", ignorenulls=True).over(before)).drop("_other")

    tie = F.col("pattern")
    rows = nearest(rows, [F.asc("_s"), tie.asc_nulls_first()], "_a")
    rows = nearest(rows, [F.desc("_s"), tie.desc_nulls_last()], "_b").filter("pattern IS NOT NULL")

    def shared(other: Column) -> Column:
        """Letters that two texts have in common at their beginnings."""
        most = F.least(F.char_length("_s"), F.char_length(other), F.lit(longest))
        return F.aggregate(F.sequence(F.lit(1), most), F.lit(0), lambda n, at: F.when((n == at - 1) & (F.substring(F.col("_s"), at, F.lit(1)) == F.substring(other, at, F.lit(1))), at).otherwise(n))

    sides = ("_a1", "_a2", "_b1", "_b2")
    rows = rows.select("pattern", *sides, *[F.when(F.col(c).isNotNull(), shared(F.col(c)["_s"])).alias(f"{c}_n") for c in sides])
    met = F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}_n").alias("n"), F.col(c)[x].alias("id"))) for c in sides for x in ("low", "high")])
    rows = rows.select("pattern", F.array_compact(met).alias("_met")).withColumn("_best", F.array_max("_met"))
    second = F.array_max(F.transform(F.filter("_met", lambda x: x["id"] != F.col("_best")["id"]), lambda x: x["n"]))
    return rows.select("pattern", F.coalesce(F.col("_best.n"), F.lit(0)).alias("size"), F.col("_best.id").alias("id"), F.coalesce(second, F.lit(0)).alias("second"))


def split_anchor(peptides: DataFrame, proteins: DataFrame, *, least: int = 4) -> DataFrame:
    """Peptides whose left part stands in one protein and right part in another: the most balanced split of each.

    peptides: peptide; proteins: protein_id, sequence, either repeated or not;
    a protein without an id counts as none.  Result: peptide, split,
    left_protein, right_protein, of equal splits the first and of proteins the
    least ids.

    What holds a part holds all shorter ones at the same end, too.  So the
    longest part at each end, the longest that another protein has, and whose
    the longest is say which splits there are, without looking for every part.
    Then only the chosen split's parts that several proteins hold are sought; of
    each the two proteins of the least ids are all that is needed, as two parts
    stand in different proteins if and only if they have two ids between them.
    """

    def least_two(rows: DataFrame, key: str) -> DataFrame:
        order = Window.partitionBy(key).orderBy("protein_id")
        return rows.select(key, "protein_id").distinct().withColumn("_n", F.row_number().over(order)).filter("_n <= 2").drop("_n")

    n = F.char_length("peptide")
    asked = checkpointed(peptides.filter(n >= 2 * least).select("peptide").distinct())
    longest = (asked.agg(F.max(n)).first()[0] or 2 * least) - least
    proteins = proteins.filter("protein_id IS NOT NULL")
    ends = {
        side: longest_starts(asked.select(F.col("peptide").alias("pattern")), proteins.select(F.col("protein_id").alias("id"), F.col("sequence").alias("text")), longest, least=least, backwards=side == "right").select(F.col("pattern").alias("peptide"), F.col("size").alias(f"_{side}"), F.col("id").alias(f"_{side}_id"), F.col("second").alias(f"_{side}_second"))
        for side in ("left", "right")
    }
    rows = ends["left"].join(ends["right"], "peptide")
    low, high = F.greatest(F.lit(least), n - F.col("_right")), F.least(n - least, F.col("_left"))
    several = lambda at: (at <= F.col("_left_second")) | (n - at <= F.col("_right_second")) | (F.col("_left_id") != F.col("_right_id"))
    splits = F.filter(F.when(low <= high, F.sequence(low, high)), several)
    best = F.array_min(F.transform(splits, lambda at: F.struct(-F.least(at, n - at), at.alias("split"))))
    rows = rows.withColumn("split", best["split"]).filter("split IS NOT NULL")
    one = lambda side, size: F.when(size > F.col(f"_{side}_second"), F.array(f"_{side}_id"))
    rows = rows.select("peptide", "split", F.left("peptide", F.col("split")).alias("_left"), F.expr("substring(peptide, split + 1)").alias("_right"), one("left", F.col("split")).alias("_lefts"), one("right", n - F.col("split")).alias("_rights"))
    rows = checkpointed(rows)
    parts = rows.filter("_lefts IS NULL").select(F.col("_left").alias("pattern")).union(rows.filter("_rights IS NULL").select("_right")).distinct()
    if not parts.isEmpty():
        texts = proteins.select("protein_id", F.col("sequence").alias("text"), F.unhex(F.md5("sequence")).alias("text_id"))
        # parts of a length up to PART_SEED meet texts whole: a short seed is many parts' and many places'
        seed = max(least, PART_SEED)
        hits = _by_seeds(parts.withColumn("pattern_id", F.col("pattern")), texts.select("text_id", "text").distinct(), seed, list(range(least, min(longest, seed) + 1)))
        ids = least_two(hits.join(least_two(texts, "text_id"), "text_id"), "pattern_id").groupBy("pattern_id").agg(F.collect_list("protein_id").alias("_ids"))
        for side in ("left", "right"):
            found = ids.select(F.col("pattern_id").alias(f"_{side}"), F.col("_ids").alias("_found"))
            rows = rows.join(found, f"_{side}", "left").withColumn(f"_{side}s", F.coalesce(f"_{side}s", "_found")).drop("_found")
    pairs = F.flatten(F.transform("_lefts", lambda x: F.transform("_rights", lambda y: F.struct(x.alias("left_protein"), y.alias("right_protein")))))
    rows = rows.withColumn("_pair", F.array_min(F.filter(pairs, lambda x: x["left_protein"] != x["right_protein"])))
    return rows.select("peptide", "split", "_pair.*")


def name_match(names: DataFrame, samples: DataFrame, *, required: bool = False) -> DataFrame:
    """name, sample: the one sample that stands in a name between boundaries; an error if several do.

    If none does the sample is null or, where it is required, that is an error.
    A sample's first word meets the words of the name; what stands around is
    verified.
    """
    rows, known = names.select("name").distinct(), samples.select("sample").distinct()
    word = r"[^\p{Alnum}]+"
    words = rows.select("name", F.explode(F.array_distinct(F.split(F.lower("name"), word))).alias("_word"))
    asked = known.withColumn("_word", F.try_element_at(F.filter(F.split(F.lower("sample"), word), lambda x: x != ""), F.lit(1))).filter("_word IS NOT NULL")
    hits = words.join(asked, "_word").filter(F.rlike("name", F.concat(F.lit(r"(?i)(^|[^A-Za-z0-9])\Q"), "sample", F.lit(r"\E($|[^A-Za-z0-9])"))))
    n = hits.groupBy("name").agg(F.min("sample").alias("_one"), F.max("sample").alias("_other"))
    several = F.raise_error(F.concat(F.lit("several samples: "), F.col("name")))
    found = F.when(F.col("_one") != F.col("_other"), several)
    if required:
        found = found.when(F.col("_one").isNull(), F.raise_error(F.concat(F.lit("no sample: "), F.col("name"))))
    return names.select("name").join(n, "name", "left").select("name", found.otherwise(F.col("_one")).alias("sample"))


def genome_slice(df: DataFrame, genome: DataFrame, chunk: int = 65536) -> DataFrame:
    """df (chrom, pos, length) with genome_ref: the reference's bases, null if the contig isn't there.

    genome: contig, chunk_no, seq, pieces of chunk bases.  A contig is looked up
    as given, without and with ``chr``.  A slice may run over into the next
    chunks.
    """
    plain = F.regexp_replace("chrom", "^chr", "")
    contigs = genome.select("contig").distinct()
    names = df.select("chrom").distinct().withColumn("_try", F.array(F.col("chrom"), plain, F.concat(F.lit("chr"), plain)))
    tried = names.select("chrom", F.posexplode("_try").alias("_p", "contig")).join(contigs, "contig")
    known = tried.groupBy("chrom").agg(F.min_by("contig", "_p").alias("_contig"))
    spans = df.join(known, "chrom", "left").select("chrom", "pos", "length", "_contig").distinct().withColumn("chunk_no", F.explode(F.sequence(F.floor((F.col("pos") - 1) / chunk), F.floor((F.col("pos") + F.col("length") - 2) / chunk))))
    pieces = spans.join(genome.withColumnRenamed("contig", "_contig"), ["_contig", "chunk_no"])
    text = pieces.groupBy("chrom", "pos", "length").agg(F.array_sort(F.collect_list(F.struct("chunk_no", "seq"))).alias("_p"))
    begin = (F.col("pos") - F.element_at("_p", 1)["chunk_no"] * chunk).cast("int")
    text = text.select("chrom", "pos", "length", F.upper(F.substring(F.array_join(F.transform("_p", lambda x: x["seq"]), ""), begin, F.col("length"))).alias("genome_ref"))
    return df.join(text, ["chrom", "pos", "length"], "left")
