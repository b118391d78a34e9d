"""Readers and writers on small files."""

from __future__ import annotations

from pyspark.sql import functions as F

from neolake.sources import fasta, tables, transcripts, vcf


def test_tsv_round_trip_keeps_sentinels(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("a\tb\tc\nNA\tNone\t1.23456\nNot Run\tinf\tNA\n")
    df = tables.read_tsv(spark, str(tmp_path / "in.tsv"))
    assert [tuple(r) for r in df.collect()] == [(None, "None", "1.23456"), ("Not Run", "inf", None)]
    typed = tables.typed(df, {"c": "double", "gone": "int"})
    assert [tuple(r) for r in tables.exported(typed).collect()] == [("NA", "None", "1.235"), ("Not Run", "inf", "NA")]
    tables.write_tsv(typed, str(tmp_path / "out"))
    assert tables.read_tsv(spark, str(tmp_path / "out")).count() == 2


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">a first one\nMKL\nVV\n>b\nmk*l\n>c\nMKL VV\n")
    df = fasta.read_fasta(spark, str(tmp_path / "x.fa"))
    assert sorted((r.id, r.description, r.sequence) for r in df.collect()) == [("a", "a first one", "MKLVV"), ("b", "b", "mk*l"), ("c", "c", "MKLVV")]
    assert sorted(r.id for r in fasta.usable_sequences(df, 3).collect()) == ["a", "c"]
    assert [(r.number, r.ids) for r in fasta.unique_sequences(df).orderBy("number").collect()] == [(1, ["a", "c"]), (2, ["b"])]


VCF = """##fileformat=VCFv4.2
##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations. Format: Allele|Consequence|SYMBOL|Feature|BIOTYPE|WildtypeProtein|FrameshiftSequence|Amino_acids|Protein_position|Gene">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT\tN
1\t100\t.\tA\tT,G\t.\tPASS\tCSQ=T|missense_variant|G1|E1.1|protein_coding|MKL||K/R|2|ENSG,G|synonymous_variant|G1|E1.1|protein_coding|MKL||||ENSG\tGT:DP:AD:TX:GX\t0/1:20:15,5,0:E1|3.5:ENSG|2.5\t0/0:30:30,0,0:.:.
1\t200\t.\tAT\tA\t.\tq10\tCSQ=-|frameshift_variant&start_lost|G2|E2|x|MKL|||1|E,-|frameshift_variant|G2|E3|protein_coding|MK|MKLL|/|1|E\tGT:AF:DP\t0|1:0.4:10\t0/0:.:.
1\t300\t.\tC\tG\t.\tPASS\tCSQ=G|missense_variant|G3|E4|protein_coding|MKL||L/V|3|E\tGT:DP\t./.:.\t0/0:1
"""


def test_vcf(spark, tmp_path):
    (tmp_path / "x.vcf").write_text(VCF)
    rows = vcf.annotated_variants(spark, str(tmp_path / "x.vcf"), "T", "N").orderBy("start").collect()
    assert [(r.start, r.variant, r.variant_type, r.transcript_name) for r in rows] == [(100, "T", "missense", "E1.1"), (200, "A", "FS", "E3")]
    a, b = rows
    assert (a.tdna_depth, a.tdna_vaf, a.normal_depth, a.normal_vaf, a.transcript_expression, a.gene_expression) == (20, 0.25, 30, 0.0, 3.5, 2.5)
    assert (b.tdna_vaf, b.tdna_depth, b.protein_length_change, b.trna_vaf) == (0.4, 10, "+2", None)
    assert vcf.annotated_variants(spark, str(tmp_path / "x.vcf"), "T", pass_only=True).count() == 1


def test_consequences_and_alleles(spark):
    f = lambda t, r, a: spark.range(1).select(vcf.consequence(F.lit(t), F.lit(r), F.lit(a))).first()[0]
    assert [f("protein_altering_variant", "A", "ATGC"), f("protein_altering_variant", "ATGC", "A"), f("protein_altering_variant", "A", "AT"), f("stop_retained_variant&frameshift_variant", "A", "AT"), f("intron_variant", "A", "T"), f("Inframe_Deletion.x", "A", "T")] == ["inframe_ins", "inframe_del", None, None, None, "inframe_del"]
    g = lambda r, a: spark.range(1).select(vcf.csq_allele(F.lit(r), F.lit(a))).first()[0]
    assert [g("AT", "A"), g("A", "ATG"), g("A", "T"), g("AT", "GC"), g("ATG", "CT")] == ["-", "TG", "T", "GC", "CT"]
    assert spark.range(1).select(vcf.percent_decoded(F.lit("p.A1%3D+x"))).first()[0] == "p.A1=+x"


def test_gtf_and_junctions(spark, tmp_path):
    (tmp_path / "x.gtf").write_text('#c\n1\th\tCDS\t5\t9\t.\t+\t0\tgene_id "G"; transcript_id "T1"; transcript_biotype "protein_coding"; gene_name "N";\n1\th\tCDS\t5\t9\t.\t+\t0\tgene_id "G"; transcript_id "T2"; transcript_biotype "protein_coding"; tag "cds_end_NF";\n1\th\texon\t5\t9\t.\t+\t0\ttranscript_id "T1"; transcript_biotype "protein_coding";\n')
    gtf = transcripts.read_gtf(spark, str(tmp_path / "x.gtf"))
    assert [(r.transcript_id, r.cds_start, r.gene_name) for r in gtf.collect()] == [("T1", 5, "N")]
    head = "chrom start end name score strand splice_site acceptors_skipped exons_skipped donors_skipped anchor known_donor known_acceptor known_junction gene_names gene_ids transcripts variant_info".split()
    rows = [["1", "100", "200", "J1", "50", "+", "GT-AG", "0", "0", "0", "D", "1", "1", "0", "N", "G", "T1.3,T7", "1:150-151,1:900-901"], ["1", "100", "200", "J2", "5", "+", "GT-AG", "0", "0", "0", "D", "1", "1", "0", "N", "G", "T1", "1:150-151"]]
    (tmp_path / "j.tsv").write_text("\n".join("\t".join(r) for r in [head, *rows]) + "\n")
    kept = transcripts.filter_junctions(transcripts.read_junctions(spark, str(tmp_path / "j.tsv")))
    assert [(r.name, r.variant_info, r.transcripts) for r in kept.collect()] == [("J1", "1:150-151", ["T1", "T7"])]
    known, unknown = transcripts.junctions_with_models(kept, gtf)
    assert known.count() == 1 and [r.transcript_id for r in unknown.collect()] == ["T7"]


def test_fusions(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("#gene1\tgene2\tbreakpoint1\tbreakpoint2\treading_frame\tpeptide_sequence\ttranscript_id1\ttranscript_id2\tsplit_reads1\tsplit_reads2\tdiscordant_mates\nA\tB\tchr1:5\t2:7\tin-frame\tMK|lV\tT1\tT2\t1\t2\t3\nA\tB\t1:5\t2:7\t.\t.\tT1\tT2\t1\t2\t3\n")
    (tmp_path / "s.tsv").write_text("LeftBreakpoint\tRightBreakpoint\tJunctionReadCount\tSpanningFragCount\tFFPM\n1:5:+\tchr2:7:-\t4\t5\t0.5\n")
    f = transcripts.with_star_support(transcripts.read_arriba(spark, str(tmp_path / "a.tsv")), transcripts.read_star_fusion(spark, str(tmp_path / "s.tsv")))
    assert [(r.gene_name, r.variant_type, r.peptide, r.read_support, r.star_reads, r.star_expression) for r in f.collect()] == [("A-B", "inframe_fusion", "MK|LV", 6, 9, 0.5)]


def test_anchor_table(spark):
    w = tables.anchor_weights(spark.createDataFrame([("A", "0.5", "True")], "HLA string, `1` string, `2` string"))
    assert sorted((r.allele, r.length, r.pos, r.weight) for r in w.collect()) == [("A", 2, 1, 0.5), ("A", 2, 2, 1.0)]


def test_small_tables_and_forms(spark, tmp_path):
    from neolake.operators import compare
    from neolake.sources import tables

    df = spark.createDataFrame([(1, None, ["a"])], "id int, x double, y array<string>")
    tables.write_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"id":1,"x":null,"y":["a"]}'
    (tmp_path / "c.csv").write_text("allele,allele_specific_cutoff\nHLA-A*01:01,884.5\nHLA-B*07:02,x\n")
    assert sorted(map(tuple, tables.allele_cutoffs(spark, str(tmp_path / "c.csv")).collect())) == [("HLA-A*01:01", 884.5), ("HLA-B*07:02", None)]
    (tmp_path / "g.txt").write_text("TP53\n KRAS \n\nTP53\n")
    assert sorted(r[0] for r in tables.gene_list(spark, str(tmp_path / "g.txt")).collect()) == ["KRAS", "TP53"]
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1, 2)], "y int, z int")
    assert compare.shared_columns(a, b) == (["y"], ["x"], ["z"])
    sets = spark.createDataFrame([(1, "Transcript Set 1", [("T1-G-x",), ("T2-G-x",)], 2, 3, 4.5), (1, "Transcript Set 2", [("T3-G-x",)], 1, 1, 0.5), (2, "Transcript Set 1", [("T9",)], 1, 1, None)], "v int, set string, transcripts array<struct<name:string>>, transcript_count int, peptide_count int, total_expr double")
    best = spark.createDataFrame([(1, "T3")], "v int, best_transcript string")
    assert sorted(map(tuple, compare.set_table(sets, ["v"], best).collect())) == [(1, "Transcript Set 1", 2, 3, 4.5, False), (1, "Transcript Set 2", 1, 1, 0.5, True), (2, "Transcript Set 1", 1, 1, None, False)]
