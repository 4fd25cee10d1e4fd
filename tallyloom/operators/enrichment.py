"""Gene-set statistics: over-representation and ranked tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import stats


def over_representation(foreground: DataFrame, universe: DataFrame, sets: DataFrame, *, keys: list[str] | None = None, smallest: int = 1, largest: int = 1_000_000, drop_zero: bool = False, empty_p: float = 0.0, analyses: DataFrame | None = None) -> DataFrame:
    """keys, term: size, overlap, drawn, total, odds, p, fdr, genes.

    foreground: keys and gene (an analysis per key); universe: gene; sets: gene,
    term.  Only genes of the universe count.  odds has 0.5 added to each cell;
    terms of a size outside smallest to largest, and with drop_zero those
    without overlap, leave before the false-discovery rate.  analyses: all keys;
    without it an analysis with no gene of the universe has no rows.
    """
    keys = keys or []
    universe = universe.select("gene").distinct()
    fore = foreground.select(*keys, "gene").distinct().join(universe, "gene", "left_semi")
    sets = sets.select("term", "gene").distinct().join(universe, "gene", "left_semi")
    sizes = sets.groupBy("term").agg(F.count("*").alias("size")).filter(F.col("size").between(smallest, largest))
    total = universe.agg(F.count("*").alias("total"))
    if keys:
        drawn = fore.groupBy(*keys).agg(F.count("*").alias("drawn"))
        drawn = analyses.select(*keys).distinct().join(drawn, keys, "left").na.fill(0, ["drawn"]) if analyses is not None else drawn
    else:
        drawn = fore.agg(F.count("*").alias("drawn"))
    hits = fore.join(sets, "gene").groupBy(*keys, "term").agg(F.count("*").alias("overlap"), F.array_join(F.array_sort(F.collect_list(F.col("gene").cast("string"))), ";").alias("genes"))
    # totals are one row
    sizes = sizes.join(F.broadcast(total))
    if drop_zero:
        rows = hits.join(sizes, "term")
        rows = rows.join(drawn, keys) if keys else rows.join(F.broadcast(drawn))
    else:
        # every analysis has every term of the sets, without overlap too: its result is analyses times terms
        rows = sizes.join(drawn if keys else F.broadcast(drawn)).join(hits, [*keys, "term"], "left")
        rows = rows.withColumns({"overlap": F.coalesce("overlap", F.lit(0)), "genes": F.coalesce("genes", F.lit(""))})
    a, b, c = F.col("overlap") + 0.5, F.col("drawn") - F.col("overlap") + 0.5, F.col("size") - F.col("overlap") + 0.5
    d = F.col("total") - F.col("drawn") - F.col("size") + F.col("overlap") + 0.5
    rows = rows.withColumns({"odds": a * d / (b * c), "p": stats.hypergeom_tail(F.col("overlap"), F.col("drawn"), F.col("size"), F.col("total"), empty_p)})
    return stats.bh_fdr(rows, "p", keys)


def variant_set_tests(genes: DataFrame, samples: DataFrame, universe: DataFrame, sets: DataFrame, *, smallest: int = 10, largest: int = 500, most_fdr: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """Tests of the gene sets that follow-up samples of a subject share or have alone, and a summary of each.

    genes: sample, gene; samples: subject, sample, baseline; universe: gene;
    sets: gene, term.  Each subject has an analysis of the genes that all its
    follow-ups have (common_all_progression), and for each of these one of all
    its genes (``sample_all``) and one of those that no other has
    (``sample_exclusive``); of a single follow-up all three are the same.
    Samples without genes don't take part.  The universe is its genes that
    stand in a set.  Rows as of over_representation by subject, analysis,
    members; an analysis without genes is there too.  Summary: the keys,
    foreground, background, terms, significant.
    """
    keys = ["subject", "analysis", "members"]
    held = genes.join(samples.filter("NOT baseline").select("subject", "sample").distinct(), "sample").select("subject", "sample", "gene").distinct()
    # a subject has a handful of samples
    design = held.groupBy("subject").agg(F.array_sort(F.collect_set("sample")).alias("_all"))
    each = held.groupBy("subject", "gene").agg(F.collect_set("sample").alias("_in")).join(design, "subject")
    label = lambda name, members: F.struct(name.alias("analysis"), members.alias("members"))
    common = label(F.lit("common_all_progression"), F.array_join("_all", ","))
    whole = lambda c: F.transform(c, lambda s: label(F.concat(s, F.lit("_all")), s))
    alone = lambda c: F.transform(c, lambda s: label(F.concat(s, F.lit("_exclusive")), s))
    none = F.filter(F.array(common), lambda _: F.lit(False))
    of_gene = F.concat(F.when(F.size("_in") == F.size("_all"), F.array(common)).otherwise(none), whole("_in"), F.when(F.size("_in") == 1, alone("_in")).otherwise(none))
    foreground = each.select("subject", "gene", F.explode(of_gene).alias("x")).select("subject", "x.*", "gene")
    analyses = design.select("subject", F.explode(F.concat(F.array(common), whole("_all"), alone("_all"))).alias("x")).select("subject", "x.*")
    known = universe.select("gene").distinct().join(sets, "gene", "left_semi")
    rows = over_representation(foreground, known, sets, keys=keys, smallest=smallest, largest=largest, empty_p=1.0, analyses=analyses)
    drawn = foreground.join(known, "gene", "left_semi").groupBy(*keys).agg(F.count("*").alias("foreground"))
    tested = rows.groupBy(*keys).agg(F.count("*").alias("terms"), F.count_if(F.col("fdr") <= most_fdr).alias("significant"))
    summary = analyses.join(drawn, keys, "left").join(tested, keys, "left").na.fill(0, ["foreground", "terms", "significant"])
    # the background is one row
    return rows, summary.join(F.broadcast(known.agg(F.count("*").alias("background"))))


def ranked_set_test(scores: DataFrame, sets: DataFrame, *, keys: list[str] | None = None, leading: int = 50, with_p: bool = True) -> DataFrame:
    """keys, term: size, u, z, mean, leading genes by |score| and, with_p, the two-sided p and fdr.

    scores: keys, gene, score.  A term that holds all genes is left out.
    """
    keys = keys or []
    ranked = stats.tied_ranks(scores, "score", keys, "_rank")
    if keys:
        ranked = ranked.join(scores.groupBy(*keys).agg(F.count("*").alias("_n")), keys)
    else:
        ranked = ranked.join(F.broadcast(scores.agg(F.count("*").alias("_n"))))
    rows = ranked.join(sets.select("term", "gene").distinct(), "gene")
    n = rows.groupBy(*keys, "term").agg(F.count("*").alias("size"), F.sum("_rank").alias("_sum"), F.first("_n").alias("_n"), F.avg("score").alias("mean"))
    # the leading genes by rank, so that no term is gathered whole
    first = Window.partitionBy(*keys, "term").orderBy(F.desc(F.abs("score")), "gene")
    best = rows.select(*keys, "term", "gene", "score").withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= leading)
    best = best.groupBy(*keys, "term").agg(F.array_sort(F.collect_list(F.struct("_nth", F.col("gene").alias("g")))).alias("_best"))
    n = n.join(best, [*keys, "term"])
    n = n.filter(F.col("size") < F.col("_n"))
    m, size = F.col("_n"), F.col("size")
    u = F.col("_sum") - size * (size + 1) / 2
    n = n.withColumns({"u": u, "z": (u - size * (m - size) / 2) / F.sqrt(size * (m - size) * (m + 1) / 12.0)})
    n = n.withColumn("leading", F.array_join(F.transform("_best", lambda x: x["g"].cast("string")), ";")).drop("_sum", "_n", "_best")
    if not with_p:
        return n
    return stats.bh_fdr(n.withColumn("p", stats.two_sided_normal_p(F.col("z"))), "p", keys)
