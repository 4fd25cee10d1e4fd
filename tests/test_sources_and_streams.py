"""Readers, writers and streams on files of a few lines."""

import gzip

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import quality
from tallyloom.sources import readers, writers
from tallyloom.streaming import jobs


def test_vcf_and_annotations(spark, tmp_path):
    text = '##fileformat=VCFv4.2\n##INFO=<ID=CSQ,Number=.,Type=String,Description="x. Format: Allele|Gene|Impact">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\n1\t10\t.\tA\tT\t50\tPASS\tDP=9;DB;DP=11;CSQ=T|g1|HIGH,T|g2\tGT:AD\t0/1:3,8\n1\t11\t.\tA\tT\t.\tq\tX=a=b\n'
    with gzip.open(tmp_path / "S1.vcf.gz", "wt") as f:
        f.write(text)
    calls = readers.vcf(spark, str(tmp_path / "S1.vcf.gz"))
    a, b = sorted(calls.collect(), key=lambda r: r.pos)
    assert (a["sample"], a.pos, a.qual, a.info["DP"], "DB" in a.info, a.format) == ("S1", 10, 50.0, "11", False, {"GT": "0/1", "AD": "3,8"})
    assert b.qual is None and b.info == {"X": "a=b"} and b.format is None
    fields = readers.csq_fields(spark, str(tmp_path / "S1.vcf.gz"))
    assert fields == ["Allele", "Gene", "Impact"]
    got = [r.csq for r in readers.explode_csq(calls, fields).collect()]
    assert got == [{"Allele": "T", "Gene": "g1", "Impact": "HIGH"}, {"Allele": "T", "Gene": "g2", "Impact": ""}]
    (tmp_path / "none.vcf").write_text("#CHROM\n")
    with pytest.raises(ValueError):
        readers.csq_fields(spark, str(tmp_path / "none.vcf"))


def test_fasta_gtf_sam_counts(spark, tmp_path):
    (tmp_path / "p.fasta").write_text(">sp|P1|X a>b\nMKT\nAY\n>second\nMM\n")
    assert sorted((r.header, r.sequence) for r in readers.fasta(spark, str(tmp_path / "p.fasta")).collect()) == [("second", "MM"), ("sp|P1|X a>b", "MKTAY")]
    (tmp_path / "g.gtf").write_text('#c\n1\ts\texon\t5\t9\t.\t+\t.\tgene_id "G1"; transcript_id "T1";\n1\ts\tgene\t5\t9\t.\t+\t.\tgene_id=G1;x=2\n')
    r = readers.gtf(spark, str(tmp_path / "g.gtf")).first()
    assert (r.gene, r.transcript, r.start, r.end) == ("G1", "T1", 5, 9)
    assert readers.gtf(spark, str(tmp_path / "g.gtf"), None).filter("feature = 'gene'").first().gene == "G1"
    (tmp_path / "r.sam").write_text("@HD\nr1\t0\t1\t100\t60\t10M\t*\t0\t0\tACGTACGTAC\tIIIIIIIIII\nbad\n")
    assert [(r.qname, r.pos, r.cigar) for r in readers.sam(spark, str(tmp_path / "r.sam")).collect()] == [("r1", 100, "10M")]
    (tmp_path / "S7.counts").write_text("# x\nGeneid\tChr\tS7.bam\nG1\t1\t12\n")
    assert [tuple(r) for r in readers.gene_counts(spark, str(tmp_path / "S7.counts")).collect()] == [("S7", "G1", 12.0)]


def test_ontology(spark, tmp_path):
    (tmp_path / "go.obo").write_text("format-version: 1.2\n\n[Term]\nid: GO:1\nname: root\nnamespace: p\n\n[Term]\nid: GO:2\nname: leaf\nnamespace: p\nalt_id: GO:9\nis_a: GO:1 ! root\nrelationship: part_of GO:1 ! root\n\n[Term]\nid: GO:3\nname: old\nis_obsolete: true\n")
    terms, edges, aliases = readers.obo(spark, str(tmp_path / "go.obo"))
    assert {r.id for r in terms.collect()} == {"GO:1", "GO:2"}
    assert [tuple(r) for r in edges.collect()] == [("GO:2", "GO:1")] * 2 and [tuple(r) for r in aliases.collect()] == [("GO:9", "GO:2")]
    lines = [["d", "x", "G1", "", "GO:9", "", "", "", "P"], ["d", "x", "G2", "NOT|x", "GO:2", "", "", "", "P"], ["d", "x", "G3", "", "GO:3", "", "", "", "F"]]
    (tmp_path / "a.gaf").write_text("!c\n" + "\n".join("\t".join(x) for x in lines) + "\n")
    assert [tuple(r) for r in readers.gaf(spark, str(tmp_path / "a.gaf"), terms, aliases).collect()] == [("G1", "GO:2")]


def test_tables_and_json(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿sample,srr\nA,S1\n")
    assert readers.samplesheet(spark, str(tmp_path / "s.csv")).columns == ["sample", "srr"]
    (tmp_path / "t.tsv").write_text('Gene\tNote\nG1\t"a ""b"""\n')
    (tmp_path / "t_summary.tsv").write_text("Gene\nG9\n")
    assert readers.delimited(spark, str(tmp_path / "t.tsv")).columns == ["Gene", "Note"]
    t = readers.event_tables(spark, [str(tmp_path / "t.tsv"), str(tmp_path / "t_summary.tsv")], {"gene": ["symbol", "GENE"], "note": ["note"], "chrom": ["chrom"]})
    assert [tuple(r) for r in t.collect()] == [("G1", 'a "b"', None)]
    (tmp_path / "g.json").write_text('{"E1": {"event_type": "SNV", "regions": [{"chrom": "1", "start0": 9, "end0": 10, "role": "TARGET_ALLELE"}]}, "E2": {"event_type": "FUSION", "regions": []}}')
    assert {(r.event, r.start0) for r in readers.geometry(spark, str(tmp_path / "g.json")).collect()} == {("E1", 9), ("E2", None)}
    (tmp_path / "f.jsonl").write_text('{"EventID": "E1"}\nbroken\n')
    good, bad = readers.findings(spark, str(tmp_path / "f.jsonl"), "EventID string")
    assert good.count() == 1 and bad.count() == 1
    (tmp_path / "m.xml").write_text("<a><maxQuantVersion>2.4</maxQuantVersion><peptideFdr>0.01</peptideFdr><fastaFilePath>x.fa</fastaFilePath></a>")
    assert readers.search_parameters(spark, str(tmp_path / "m.xml")).first().version == "2.4"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("h1", "MK", "1", 5, 9, "ok"), ("h2", None, "1", 7, 8, "no")], "header string, sequence string, chrom string, start0 long, end0 long, status string")
    writers.tsv(df.limit(0), str(tmp_path / "t"), ["status", "header"])
    assert any(p.read_text().startswith("status\theader") for p in (tmp_path / "t").glob("part*"))
    writers.tsv(df, str(tmp_path / "t"), ["header", "sequence"])
    assert readers.tsv(spark, str(tmp_path / "t")).filter("sequence IS NULL").count() == 1
    writers.split_by_status(df, str(tmp_path / "s"))
    assert spark.read.parquet(f"{tmp_path}/s/status=ok").count() == 1
    writers.fasta(df.filter("sequence IS NOT NULL"), str(tmp_path / "f"), F.lit("S|VARIANT|"))
    assert readers.fasta(spark, str(tmp_path / "f")).first().header == "S|VARIANT|h1"
    writers.bed(df, str(tmp_path / "b"), F.col("header"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "b")).collect())[0] == "1\t5\t9\th1"
    assert writers.compact_rows(df, ["header", "sequence"]).first().row == '["h1","MK"]'


def test_streams_agree_with_tables(spark, tmp_path):
    rows = [(i % 7, f"P{i % 2}", f"2024-01-01 0{i % 5}:10:00", "FAILED" if i % 3 == 0 else "COMPLETED", 1 if i % 3 == 0 else 0, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "task_id int, process string, t string, status string, exit int, seconds double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.ledger(stream, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert sorted(r.task_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted({r[0] for r in rows if r[3] == "FAILED"})
    late = spark.createDataFrame([(999, "P0", "COMPLETED", 0, 1.0)], "task_id int, process string, status string, exit int, seconds double").withColumn("ts", F.lit("2024-03-01").cast("timestamp")).select(df.columns)
    late.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    jobs.write_rollup(stream, str(tmp_path / "roll"), str(tmp_path / "c2")).awaitTermination()
    got = {(str(r.window_start), r.process): (r.tasks, r.max_seconds, r.failures) for r in spark.read.parquet(str(tmp_path / "roll")).collect()}
    want = {(str(r.window_start), r.process): (r.tasks, r.max_seconds, r.failures) for r in jobs.rollup(df).collect()}
    assert {k: v for k, v in got.items() if k[0] < "2024-02"} == want


def test_discovery_maps_and_headers(spark, tmp_path):
    for name, text in (("a10.vcf", "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n1\t5\n"), ("b/a2.vcf", "1\t5\n"), ("c.txt", "x\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    assert [r.path.rsplit("/", 1)[-1] for r in readers.discover(spark, str(tmp_path), [".VCF"]).collect()] == ["a10.vcf", "a2.vcf"]
    with pytest.raises(ValueError):
        readers.discover(spark, str(tmp_path), [".bam"])
    got = {r.file: (r.rows, r.status) for r in readers.vcf_headers(spark, [str(tmp_path / "a10.vcf"), str(tmp_path / "b/a2.vcf")]).collect()}
    assert got == {"a10.vcf": (1, "PASS"), "a2.vcf": (1, "FAIL")}
    samples = spark.createDataFrame([("S1",), ("S2",)], "sample string")
    rows = spark.createDataFrame([("D:\\x\\r1.raw", "S1"), ("r1.raw", "S1"), ("r2", "S2")], ["Raw file", "rna_sample"])
    assert {r.raw_file: r["sample"] for r in readers.raw_file_map(rows, samples).collect()} == {"r1": "S1", "r2": "S2"}
    for bad in (("r1", "S2"), ("r3", "S9"), ("r3", None)):
        with pytest.raises(Exception):
            readers.raw_file_map(rows.union(spark.createDataFrame([bad], "a string, b string")), samples).collect()


def test_letters_before_the_first_header(spark, tmp_path):
    (tmp_path / "good.fa").write_text(">h1\r\nMK\r\nTA\r\n>h2\r\nAA\r\n")
    assert sorted((r.header, r.sequence) for r in readers.fasta(spark, str(tmp_path / "good.fa")).collect()) == [("h1", "MKTA"), ("h2", "AA")]
    (tmp_path / "bad.fa").write_text("MKT\n>h1\nAA\n")
    with pytest.raises(Exception, match="before the first header"):
        readers.fasta(spark, str(tmp_path / "bad.fa")).collect()


def test_histories_take_a_run_once(spark, tmp_path):
    path, schema = str(tmp_path / "h"), "a int, b string"
    one, two = (spark.createDataFrame([(k, "x")], schema) for k in (1, 2))
    assert writers.read_history(spark, path, schema).count() == 0
    assert [writers.append_once(one, path, "run/1"), writers.append_once(one, path, "run/1"), writers.append_once(two, path, "run:1")] == [True, False, True]
    # what a run that failed has written isn't published
    two.write.parquet(f"{path}/parts/lost")
    assert sorted(r.a for r in writers.read_history(spark, path, schema).collect()) == [1, 2]


def test_a_repeated_batch_is_published_once(spark, tmp_path):
    rows = [(i % 9, "P", "2024-01-01 00:10:00", "FAILED", 1, 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "task_id int, process string, t string, status string, exit int, seconds double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    for checkpoint in ("c1", "c2"):  # the second, without the first one's state, sees all batches again
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        jobs.ledger_once(stream, str(tmp_path / "out"), str(tmp_path / checkpoint), "ledger").awaitTermination()
    got = writers.read_history(spark, str(tmp_path / "out"), "task_id int, status string").collect()
    assert sorted(r.task_id for r in got) == list(range(9))


def test_guarded_writes(spark, tmp_path):
    path = str(tmp_path / "g")
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(counted, "id long")
    assert writers.guarded(df, path, most_rows=100, most_bytes=1 << 20)["rows"] == 100
    assert calls.value == 100  # evaluated once
    for bounds in ({"most_rows": 5}, {"most_bytes": 10}):
        with pytest.raises(writers.TooLarge):
            writers.guarded(spark.range(7), path, **bounds)
        assert spark.read.parquet(path).count() == 100
    writers.guarded(spark.range(7), path, most_rows=7, write=lambda d, p: d.write.json(p))
    assert spark.read.json(path).count() == 7 and [x.name for x in tmp_path.iterdir()] == ["g"]


def test_inventory_of_a_file_over_two_gigabytes(spark, tmp_path):
    import hashlib

    with (tmp_path / "large file%20.bin").open("wb") as out:
        out.truncate(3 << 30)
    (tmp_path / "é.txt").write_bytes(b"abc")
    got = {r.path.rsplit(".", 1)[-1]: (r.size, r.sha256) for r in quality.inventory(spark, str(tmp_path)).collect()}
    sha, block = hashlib.sha256(), bytes(1 << 24)
    for _ in range(3 << 6):
        sha.update(block)
    assert got == {"bin": (3 << 30, sha.hexdigest()), "txt": (3, hashlib.sha256(b"abc").hexdigest())}


def test_files_of_different_headers_together(spark, tmp_path):
    """Each file's rows go by its own sample columns and order of annotation fields."""
    head = "##fileformat=VCFv4.2\n##INFO=<ID=CSQ,Number=.,Description=\"x Format: {}\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO{}\n"
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "S1.x.vcf").write_text(head.format("Allele|Consequence|Feature", "\tFORMAT\tT\tN") + "chr1\t10\t.\tA\tG\t1\tPASS\tCSQ=G|missense|E1,G|stop|E2\tGT:DP\t0/1:5\t0/0:7\n1\t11\t.\tA\tC\t.\tPASS\tX=1\tGT\t0/1\n")
    (tmp_path / "S1.vcf").write_text(head.format("Feature | Allele|Consequence", "") + "1\t10\t.\tA\tT\t.\tPASS\tCSQ=E9|T\n")
    (tmp_path / "none.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n1\t12\t.\tA\tT\t.\tPASS\tX=1\n")
    paths = [str(tmp_path / x) for x in ("a/S1.x.vcf", "S1.vcf", "none.vcf")]
    calls = readers.vcf_calls(spark, paths)
    got = sorted(((r["sample"], r["column"], r.chrom, r.pos, r.format) for r in calls.collect()), key=str)
    assert got == sorted([("S1", "T", "chr1", 10, {"GT": "0/1", "DP": "5"}), ("S1", "N", "chr1", 10, {"GT": "0/0", "DP": "7"}), ("S1", "T", "1", 11, {"GT": "0/1"}), ("S1", "N", "1", 11, None), ("S1", None, "1", 10, None), ("none", None, "1", 12, None)], key=str)
    notes = sorted((r.alts, r.allele, r.feature, r.consequence) for r in readers.annotations(calls).collect())
    assert notes == [("G", "G", "E1", "missense"), ("G", "G", "E2", "stop"), ("T", "T", "E9", "")]
    with pytest.raises(ValueError, match="several orders"):
        readers.csq_fields(spark, paths)
    assert readers.csq_fields(spark, paths[1]) == ["Feature", "Allele", "Consequence"]
    bad = calls.filter("sample = 'none'").withColumn("info", F.create_map(F.lit("CSQ"), F.lit("T|x")))
    with pytest.raises(Exception, match="no annotation header"):
        readers.explode_csq(bad).collect()
