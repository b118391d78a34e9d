"""Whole runs and reports on small tables, and the entry point without the training-data subpackage."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from pyspark.sql import functions

from neolake.operators import aggregate, candidates, compare, predictions
from neolake.plans import post
from neolake.schemas import Thresholds
from neolake.sources import transcripts, vcf

ROOT = Path(__file__).resolve().parent.parent
PROTEIN = "MKTAYIAKQRQISFVKSHFSRQ"
VCF = (
    """##fileformat=VCFv4.2
##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations. Format: Allele|Consequence|SYMBOL|Feature|BIOTYPE|WildtypeProtein|FrameshiftSequence|Amino_acids|Protein_position|Gene|TSL|CANONICAL|MANE_SELECT">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT
"""
    f"1\t100\t.\tA\tT\t.\tPASS\tCSQ=T|missense_variant|G1|E1.1|protein_coding|{PROTEIN}||Q/W|9|ENSG|1|true|true\tGT:DP:AD\t0/1:20:15,5\n"
    f"1\t200\t.\tAT\tA\t.\tPASS\tCSQ=-|frameshift_variant|G2|E2|protein_coding|{PROTEIN}|{PROTEIN[:10]}CDEFGHIK|/|11|E|1|true|true\tGT:DP:AD\t0/1:20:10,10\n"
)


def test_variants_to_report(spark, tmp_path):
    (tmp_path / "x.vcf").write_text(VCF)
    predictions.register("sum", lambda f: f.assign(score=f["epitope"].map(lambda e: float(sum(map(ord, e)) % 400 + 1)), percentile=1.0))
    variants = vcf.annotated_variants(spark, str(tmp_path / "x.vcf"), "T")
    variants = variants.withColumn("index", vcf.dotted_index(variants.start, variants.gene_name, variants.transcript_name, variants.variant_type, variants.protein_position))

    def store(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    done = post.run(variants, ["HLA-A*02:01"], [8], ["sum"], post.Options(Thresholds(binding=500.0)), store=store)
    rows = done.all_epitopes.collect()
    changed = PROTEIN[:8] + "W" + PROTEIN[9:]
    own = {changed[i : i + 8] for i in range(len(PROTEIN) - 7)} - {PROTEIN[i : i + 8] for i in range(len(PROTEIN) - 7)}
    assert {r["MT Epitope Seq"] for r in rows if r["Gene Name"] == "G1"} == own
    shifted = PROTEIN[3:10] + "CDEFGHIK"
    novel = {shifted[i : i + 8] for i in range(len(shifted) - 7)}
    assert {r["MT Epitope Seq"] for r in rows if r["Gene Name"] == "G2"} <= novel and any(r["Gene Name"] == "G2" for r in rows)
    report = {r["Gene"]: r for r in post.tiered(done.aggregated, post.MATCHED, Thresholds(binding=500.0)).collect()}
    best = min(own, key=lambda e: float(sum(map(ord, e)) % 400 + 1))
    assert report["G1"]["IC50 MT"] == pytest.approx(sum(map(ord, best)) % 400 + 1) and report["G1"]["AA Change"] == "Q9W" and report["G2"]["AA Change"] == "FS11"
    assert report["G1"]["Num Included Peptides"] == len(own) and set(report) == {"G1", "G2"}
    assert {r["Gene Name"] for r in done.filtered.collect()} <= {"G1", "G2"}


def test_included_peptides_follow_their_own_order(spark):
    t = Thresholds(inclusion=1000.0, top_peptides=1)
    cols = "v string, ep string, `Median MT IC50 Score` double, Biotype string, `Transcript Support Level` string, `Transcript Length` int, `MANE Select` boolean, Canonical boolean, i int"
    # the best row is B's (a preferred transcript), the first peptide by support level and score is A
    rows = [("x", "A", 50.0, "protein_coding", "1", 10, False, False, 1), ("x", "B", 10.0, "protein_coding", "5", 10, True, False, 2), ("x", "C", 5000.0, "protein_coding", "1", 10, True, True, 3), ("y", "D", 9000.0, "other", None, 5, False, False, 4)]
    df = spark.createDataFrame(rows, cols)
    kept = {r.i for r in aggregate.included(df, ["v"], "ep", "Median MT IC50 Score", t, ["i"]).collect()}
    assert kept == {1, 2, 4}  # A by its order, B and D as best rows; C is above the threshold


def test_top_scores_count_repeated_epitopes_and_come_again(spark):
    cols = "v int, tr string, ep string, score double, Index string, i int"
    rows = [(1, "T1", "A", 5.0, "p.c", 1), (1, "T1", "A", 6.0, "q.c", 2), (1, "T2", "A", 4.0, "p.d", 3), (1, "T3", "A", 7.0, "r.c", 4), (2, "T1", "A", None, "p.c", 5)]
    got = candidates.top_score(spark.createDataFrame(rows, cols), [("v")], "tr", "ep", Thresholds(), "score", ["i"], "Index", tool="fusion").collect()
    # T1 has A twice, T2 and T3 once: two groups; the first winner's consequence c has prefixes p, q, r
    assert sorted((r.i, r.Index) for r in got) == [(1, "p.c"), (1, "q.c"), (1, "r.c"), (3, "p.d")]


def test_dense_ranks_without_one_window(spark):
    rows = [(i, None if i % 7 == 0 else float(i * 37 % 50)) for i in range(300)]
    got = candidates.with_dense_rank(spark.createDataFrame(rows, "i int, x double"), candidates.number("x"), "k", [functions.col("i").asc()], descending=True).collect()
    order = sorted({x for _, x in rows if x is not None}, reverse=True)
    assert {r.i: r.k for r in got} == {i: (order.index(x) + 1 if x is not None else len(order) + 1) for i, x in rows}
    assert candidates.with_dense_rank(spark.createDataFrame([(1, None)], "i int, x double"), candidates.number("x"), "k", [functions.col("i").asc()]).first().k == 1


def test_a_repeated_index_is_an_error(spark):
    scores, again = spark.createDataFrame([(1, 2.0)], "index int, score double"), spark.createDataFrame([(1, "a"), (1, "b")], "index int, g string")
    with pytest.raises(Exception, match="repeat the index 1"):
        predictions.joined_to_variants(scores, again).collect()


def test_agfusion_folder(spark, tmp_path):
    for name, sep in (("A_B", "\t"), ("C_D", ",")):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}_protein.fa").write_text(f">t1-t2 {name}\nMKL\nV*R\n>t3-t4\nmm\n")
        head = ["5'_gene", "3'_gene", "5'_transcript", "3'_transcript", "exon_gene_source", "exon_number", "exon_chr", "exon_start", "exon_end"]
        (tmp_path / name / f"{name}.exons.txt").write_text("\n".join(sep.join(x) for x in (head, ["A", "B", "t1", "t2", "A", "1", "1", "10", "20"])) + "\n")
    got = sorted((r.fusion, r.id, r.sequence) for r in transcripts.read_agfusion(spark, str(tmp_path)).collect())
    assert got == [("A_B", "t1-t2", "MKLV"), ("A_B", "t3-t4", "MM"), ("C_D", "t1-t2", "MKLV"), ("C_D", "t3-t4", "MM")]
    exons = transcripts.read_agfusion_exons(spark, str(tmp_path / "*" / "*.exons.txt"))
    assert [(r["exon_start"], r["exon_chr"]) for r in exons.collect()] == [("10", "1"), ("10", "1")]


def test_fasta_report_and_columns(spark):
    rows = spark.createDataFrame([("MT.1.a", "ACDEFGHIK"), ("WT.1.a", "ACDEFGHIL"), ("MT.2.b", "PPPPPPPPC")], "id string, sequence string")
    report = spark.createDataFrame([("1.a", "Accept"), ("2.b", "Reject")], "Index string, Evaluation string")
    assert sorted(r.id for r in post.peptide_fasta(rows, report=report).collect()) == ["MT.1.a", "WT.1.a"]
    assert [r.id for r in post.peptide_fasta(rows, True, report).collect()] == ["MT.1.a"]
    assert sorted(r.id for r in post.peptide_fasta(rows, report=report.drop("Evaluation")).collect()) == ["MT.1.a", "MT.2.b", "WT.1.a"]
    assert compare.comparable(["Gene", "Tier"], "aggregated") and compare.comparable(["NetMHC MT IC50 Score", "Biotype"], "unaggregated")
    with pytest.raises(ValueError, match="Nothing"):
        compare.comparable(["Nothing"], "unaggregated")


def test_entry_point_without_the_subpackage():
    code = "import sys; sys.modules['neolake.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'aggregated_report' in q and 'op1_mixing' not in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
