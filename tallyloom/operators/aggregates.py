"""Counts and summaries of variants, reads, genes and task logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import alleles, cigar, units

#: Metrics that stand in a landscape even where they are 0.
LANDSCAPE = ("SNV", "MNV", "INSERTION", "DELETION", "COMPLEX", "transition", "transversion", "heterozygous", "homozygous_alt", "missing", "other", "multiallelic_sites")


def variant_landscape(variants: DataFrame, keys: list[str]) -> DataFrame:
    """keys, metric, count in long form from ref, alt, gt, n_alts: every metric of LANDSCAPE for every key."""
    kind, snv = alleles.allele_type(F.col("ref"), F.col("alt")), (F.char_length("ref") == 1) & (F.char_length("alt") == 1)
    ti = alleles.is_transition(F.col("ref"), F.col("alt"))
    zyg = alleles.zygosity(F.col("gt"))
    conditions = {n: kind == n for n in LANDSCAPE[:5]} | {"transition": snv & ti, "transversion": snv & ~ti} | {n: zyg == n for n in LANDSCAPE[7:11]} | {"multiallelic_sites": F.col("n_alts") > 1}
    n = variants.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    return n.unpivot(keys, list(LANDSCAPE), "metric", "count")


def stage_summary(variants: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: alleles, snvs, indels, transitions, transversions, ti_tv (null without a transversion), contigs; symbolic alleles are skipped."""
    rows = variants.filter(~F.col("alt").isin(*alleles.SYMBOLIC))
    snv = (F.char_length("ref") == 1) & (F.char_length("alt") == 1)
    ti = alleles.is_transition(F.col("ref"), F.col("alt"))
    n = rows.groupBy(*keys).agg(F.count("*").alias("alleles"), F.count_if(snv).alias("snvs"), F.count_if(F.char_length("ref") != F.char_length("alt")).alias("indels"), F.count_if(snv & ti).alias("transitions"), F.count_if(snv & ~ti).alias("transversions"), F.countDistinct("chrom").alias("contigs"))
    return n.withColumn("ti_tv", F.try_divide("transitions", "transversions"))


def multi_dimension_counts(df: DataFrame, dims: list[str]) -> DataFrame:
    """dimension, value, count of each dimension in one pass over the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("")).alias("value")) for d in dims]))
    return df.select(pairs.alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("count"))


def code_counts(df: DataFrame, keys: list[str], codes: str = "failure_codes") -> DataFrame:
    """keys, code, count of an array of codes."""
    return df.select(*keys, F.explode(codes).alias("code")).groupBy(*keys, "code").agg(F.count("*").alias("count"))


def status_counts(df: DataFrame, keys: list[str], valid: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("reported"), F.count_if(valid).alias("validated"), F.count_if(~valid).alias("rejected"))


def exclusion_detail(df: DataFrame, key: str, reason: str) -> DataFrame:
    """key, detail: ``reason=count`` of each key, the most common first."""
    n = df.groupBy(key, reason).agg(F.count("*").alias("n"))
    rows = n.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(reason).alias("r")))).alias("x"))
    return rows.select(key, F.array_join(F.transform("x", lambda x: F.concat(x["r"], F.lit("="), (-x["o"]).cast("string"))), ";").alias("detail"))


def finding_counts(reads: DataFrame, keys: list[str], kind: str = "class") -> DataFrame:
    """keys, alt, ref, excluded, callable, status and fractions from classified reads."""
    n = reads.groupBy(*keys).agg(F.count_if(F.col(kind) == "EXACT_ALT").alias("alt"), F.count_if(F.col(kind) == "CLEAN_REFERENCE").alias("ref"), F.count_if(F.col(kind) == "EXCLUDED").alias("excluded"))
    both = F.col("alt") + F.col("ref")
    return n.withColumns({"callable": both, "status": cigar.evidence_status(F.col("alt"), F.col("ref")), "alt_fraction": F.try_divide(F.col("alt"), both), "callable_fraction": F.try_divide(both, both + F.col("excluded"))})


def junction_counts(reads: DataFrame, keys: list[str]) -> DataFrame:
    """keys, start, end, n of intron gaps of primary reads (flag, cigar, pos)."""
    rows = reads.filter(cigar.primary(F.col("flag")) & F.contains("cigar", F.lit("N")))
    rows = rows.select(*keys, F.explode(cigar.junctions(cigar.blocks(F.col("cigar"), F.col("pos")))).alias("j"))
    return rows.groupBy(*keys, "j.start", "j.end").agg(F.count("*").alias("n"))


def junction_support(junctions: DataFrame, counts: DataFrame) -> DataFrame:
    """transcript, n_junctions, counts, min_support; a junction without reads counts 0."""
    rows = junctions.join(counts, ["chrom", "start", "end"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return rows.groupBy("transcript").agg(F.count("*").alias("n_junctions"), F.array_sort(F.collect_list(F.struct("junction_no", "n"))).alias("counts"), F.min("n").alias("min_support"))


def gene_model(exons: DataFrame) -> DataFrame:
    """gene, start, end, merged_length: exon bases with overlaps counted once."""
    from .windows import merge_intervals

    merged = merge_intervals(exons.select("gene", "start", "end"), ["gene"], 1)
    return merged.groupBy("gene").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.col("end") - F.col("start") + 1).alias("merged_length"))


def expression_matrix(counts: DataFrame, model: DataFrame) -> DataFrame:
    """sample, gene, count, cpm, tpm in long form.

    counts: sample, gene, count; model: gene, merged_length.  CPM's total is over
    all counted genes, TPM's over those of the model; 0 where a total is 0.
    """
    total = counts.groupBy("sample").agg(F.sum("count").alias("_total"))
    rows = counts.join(model.select("gene", "merged_length"), "gene").withColumn("_rpk", F.coalesce(F.try_divide(F.col("count"), F.col("merged_length") / 1000.0), F.lit(0.0)))
    rpk = rows.groupBy("sample").agg(F.sum("_rpk").alias("_all"))
    rows = rows.join(total, "sample").join(rpk, "sample")
    return rows.select("sample", "gene", "count", F.coalesce(F.try_divide(F.col("count") * 1e6, F.col("_total")), F.lit(0.0)).alias("cpm"), F.coalesce(F.try_divide(F.col("_rpk") * 1e6, F.col("_all")), F.lit(0.0)).alias("tpm"))


def expression_summary(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample").agg(F.sum("count").alias("assigned"), F.count_if(F.col("count") > 0).alias("genes"))


def gene_fold_change(matrix: DataFrame, pairs: DataFrame, value: str = "cpm") -> DataFrame:
    """base, followup, gene, log2_fc = log2((f + 0.5) / (b + 0.5)); a gene missing on one side is 0 there."""
    p = pairs.select("base", "followup").distinct()
    b = matrix.join(p, F.col("sample") == F.col("base")).select("base", "followup", "gene", F.col(value).alias("_b"))
    f = matrix.join(p, F.col("sample") == F.col("followup")).select("base", "followup", "gene", F.col(value).alias("_f"))
    both = f.join(b, ["base", "followup", "gene"], "full")
    return both.select("base", "followup", "gene", F.log2((F.coalesce("_f", F.lit(0.0)) + 0.5) / (F.coalesce("_b", F.lit(0.0)) + 0.5)).alias("log2_fc"))


def pathway_scores(fold: DataFrame, sets: DataFrame, top: int = 15) -> DataFrame:
    """base, followup, gene_set: genes, median, mean, up and down fractions, the top genes each way."""
    keys = ["base", "followup", "gene_set"]
    rows = fold.join(sets, "gene")
    n = rows.groupBy(*keys).agg(F.count("*").alias("genes"), F.median("log2_fc").alias("median"), F.avg("log2_fc").alias("mean"), F.avg((F.col("log2_fc") > 0).cast("double")).alias("up_fraction"), F.avg((F.col("log2_fc") < 0).cast("double")).alias("down_fraction"))
    # the top genes by rank, so that no group is gathered whole
    change = F.abs("log2_fc")
    side = F.when(F.col("log2_fc") > 0, "top_up").when(F.col("log2_fc") < 0, "top_down")
    best = rows.select(*keys, "gene", change.alias("_c"), side.alias("_side")).filter("_side IS NOT NULL")
    best = best.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_side").orderBy(F.desc("_c"), "gene"))).filter(F.col("_n") <= top)

    def listed(name: str) -> Column:
        named = F.array_sort(F.collect_list(F.when(F.col("_side") == name, F.struct("_n", F.col("gene").cast("string").alias("g")))))
        return F.array_join(F.transform(named, lambda x: x["g"]), ";").alias(name)

    tops = best.groupBy(*keys).agg(listed("top_up"), listed("top_down"))
    return n.join(tops, keys, "left").withColumns({c: F.coalesce(c, F.lit("")) for c in ("top_up", "top_down")})


def recurrence(findings: DataFrame, key: list[str]) -> DataFrame:
    """Alleles of more than one sample, with samples and genes."""
    n = findings.groupBy(*key).agg(F.array_sort(F.collect_set("sample")).alias("_s"), F.array_sort(F.collect_set("gene")).alias("_g"))
    return n.filter(F.size("_s") > 1).select(*key, F.size("_s").alias("n_samples"), F.array_join("_s", ";").alias("samples"), F.array_join("_g", ";").alias("genes"))


def trace_summary(tasks: DataFrame, max_cores: float = 32, max_bytes: float = 48e9, max_seconds: float = 43200) -> DataFrame:
    """Per process: tasks, upper median of cores, greatest memory and runtime, failures, warnings."""
    middle = upper_median("cores", ["process"], tasks.filter("cores IS NOT NULL")).withColumnRenamed("upper_median", "median_cores")
    n = tasks.groupBy("process").agg(F.count("*").alias("tasks"), F.max("rss").alias("max_rss"), F.max("seconds").alias("max_seconds"), F.count_if(~F.col("status").isin("COMPLETED", "CACHED")).alias("failures"))
    n = n.join(middle, "process", "left").select("process", "tasks", "median_cores", "max_rss", "max_seconds", "failures")
    flags = F.array_compact(F.array(F.when(F.col("median_cores") > max_cores, "cores"), F.when(F.col("max_rss") > max_bytes, "memory"), F.when(F.col("max_seconds") > max_seconds, "runtime")))
    return n.withColumn("warnings", F.array_join(flags, ";"))


def failure_ledger(tasks: DataFrame) -> DataFrame:
    """Tasks that failed, were aborted or left an exit code other than 0."""
    return tasks.filter(F.upper("status").isin("FAILED", "ABORTED") | (F.coalesce(F.col("exit"), F.lit(0)) != 0))


def process_contract(tasks: DataFrame, required: DataFrame) -> DataFrame:
    """process, tasks, bad, status of required processes: PASS, or FAIL if none ran or one didn't end well."""
    n = tasks.groupBy("process").agg(F.count("*").alias("tasks"), F.count_if(~F.col("status").isin("COMPLETED", "CACHED")).alias("bad"))
    out = required.select("process").distinct().join(n, "process", "left").na.fill(0, ["tasks", "bad"])
    return out.withColumn("status", F.when((F.col("tasks") > 0) & (F.col("bad") == 0), "PASS").otherwise("FAIL"))


def flagstat(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reads by SAM flag."""
    masks = {"secondary": 256, "supplementary": 2048, "duplicates": 1024, "paired": 1, "proper": 2, "read1": 64, "read2": 128}
    return reads.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(F.col("flag").bitwiseAND(F.lit(4)) == 0).alias("mapped"), *[F.count_if(F.col("flag").bitwiseAND(F.lit(m)) != 0).alias(k) for k, m in masks.items()])


def gene_read_counts(blocks: DataFrame, exons: DataFrame, width: int = 1024) -> DataFrame:
    """gene, n of fragments that overlap one gene's exons alone.

    blocks: chrom, start, end, fragment of primary reads' aligned blocks;
    exons: chrom, start, end, gene.
    """
    from tallyloom.functions.lineage import checkpointed

    from .joins import range_join

    # blocks are read from their CIGARs once, and read twice
    blocks = checkpointed(blocks.select("chrom", "start", "end", "fragment"))
    # blocks at one place hit the same genes; of a fragment's genes the least and the greatest tell whether there is one
    places = blocks.select("chrom", "start", "end").distinct()
    hits = range_join(checkpointed(places), exons.select("chrom", "start", "end", "gene"), ["chrom"], width)
    genes = hits.groupBy(*[F.col(f"l.{c}").alias(c) for c in ("chrom", "start", "end")]).agg(F.min("r.gene").alias("_low"), F.max("r.gene").alias("_high"))
    each = blocks.join(genes, ["chrom", "start", "end"]).groupBy("fragment").agg(F.min("_low").alias("gene"), F.max("_high").alias("_high"))
    return each.filter(F.col("gene") == F.col("_high")).groupBy("gene").agg(F.count("*").alias("n"))


def progression_genes(rows: DataFrame, impacts: tuple[str, ...] = ("MODIFIER", "LOW", "MODERATE", "HIGH")) -> DataFrame:
    """gene, best_impact, alleles, score = rank of the impact times 10."""
    rank = F.array_position(F.array(*[F.lit(x) for x in impacts]), F.col("impact"))
    return rows.groupBy("gene").agg(F.max_by("impact", rank).alias("best_impact"), F.count("*").alias("alleles"), (F.max(rank) * 10).alias("score"))


def splice_progression(base: DataFrame, followup: DataFrame, key: list[str]) -> DataFrame:
    """gene, shared, followup_only, baseline_only, log2_ratio of supported junctions per gene."""
    a, b = base.select("gene", *key).distinct().withColumn("_a", F.lit(1)), followup.select("gene", *key).distinct().withColumn("_b", F.lit(1))
    n = a.join(b, ["gene", *key], "full").groupBy("gene").agg(F.count("_a").alias("_na"), F.count("_b").alias("_nb"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("shared"))
    return n.select("gene", "shared", (F.col("_nb") - F.col("shared")).alias("followup_only"), (F.col("_na") - F.col("shared")).alias("baseline_only"), F.log2((F.col("_nb") + 0.5) / (F.col("_na") + 0.5)).alias("log2_ratio"))


def parsed_trace(rows: DataFrame) -> DataFrame:
    """process, task_id, status, exit, cores, rss, seconds from a task log's text columns."""
    return rows.select(units.process_name(F.col("name")).alias("process"), "task_id", "status", F.col("exit").try_cast("int").alias("exit"), (units.parse_percent(F.col("cpu")) / 100).alias("cores"), units.parse_bytes(F.col("peak_rss")).alias("rss"), units.parse_seconds(F.col("realtime")).alias("seconds"))


def fasta_stats(proteins: DataFrame, keys: list[str]) -> DataFrame:
    return proteins.groupBy(*keys).agg(F.count("*").alias("sequences"), F.sum(F.char_length("sequence")).alias("residues"))


def funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """stage_no, stage, count of named conditions in one pass."""
    one = df.agg(*[F.count_if(c).alias(n) for n, c in stages.items()])
    return one.select(F.posexplode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("count")) for n in stages])).alias("stage_no", "s")).select("stage_no", "s.stage", "s.count")


def upper_median(value: str, keys: list[str], df: DataFrame) -> DataFrame:
    """Per key the middle value, of two the greater, by rank and without a list."""
    w = Window.partitionBy(*keys)
    rows = df.withColumn("_r", F.row_number().over(w.orderBy(value))).withColumn("_n", F.count(F.lit(1)).over(w))
    return rows.filter(F.col("_r") == F.floor(F.col("_n") / 2) + 1).select(*keys, F.col(value).alias("upper_median"))
