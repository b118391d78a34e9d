"""Haplotypes, splice junctions and fusions: from files to filtered epitopes and reports."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from neolake.functions.sequences import CODONS
from neolake.operators import genomic, haplotypes, predictions, splicing
from neolake.plans import other_runs, post
from neolake.schemas import Thresholds
from neolake.sources import fasta, transcripts, vcf

SCORE = lambda e: float(sum(map(ord, e)) % 400 + 1)
OPTIONS = post.Options(Thresholds(binding=500.0))


@pytest.fixture(autouse=True)
def predictor():
    predictions.register("sum", lambda f: f.assign(score=f["epitope"].map(SCORE), percentile=1.0))


# --- haplotypes ------------------------------------------------------------------------

PROTEIN = "MKTAYIAKQRQISFVKSHFSRQLEERLGLIEVQ"
HEAD = """##fileformat=VCFv4.2
##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations. Format: Allele|Consequence|SYMBOL|Feature|BIOTYPE|WildtypeProtein|FrameshiftSequence|Amino_acids|Protein_position|Gene|Codons">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT
"""


def line(pos, ref, alt, kind, change, at, codons, call, shifted="", shape="GT:HP"):
    return f"1\t{pos}\t.\t{ref}\t{alt}\t.\tPASS\tCSQ={alt if len(ref) == len(alt) else '-'}|{kind}|G|E1|protein_coding|{PROTEIN}|{shifted}|{change}|{at}|ENSG|{codons}\t{shape}\t{call}\n"


def test_neighbours_change_the_peptides(spark, tmp_path):
    main = [(1025, "A", "T", "missense_variant", "Q/L", 9, "cAa/cTa", "0/1:a"), (1040, "C", "G", "missense_variant", "F/L", 14, "ttC/ttG", "0/1:b")]
    shifted = PROTEIN[:20] + "RCDEFGHIKLMN"
    frame = (1061, "CA", "C", "frameshift_variant", "S/X", 20, "agC/ag", "0/1:c", shifted)
    near = [
        (1024, "C", "A", "missense_variant", "Q/K", 9, "Caa/Aaa", "0/1:a"),  # same codon: cAa and Aaa give aTa, I
        (1031, "G", "A", "missense_variant", "Q/E", 11, "Caa/Gaa", "1/1:.", "", "GT:HP"),  # homozygous, without a phase
        (1019, "G", "A", "missense_variant", "A/V", 7, "gCa/gTa", "0/1:z"),  # on the other haplotype
        (1034, "T", "A", "synonymous_variant", "I", 12, "atT/atA", "0/1:a"),
        (1043, "G", "C", "missense_variant", "V/L", 15, "Gtt/Ctt", "0/1:b"),
        (1055, "T", "C", "missense_variant", "F/Y", 19, "tTc/tAc", "0/1:c"),
        (1064, "A", "C", "missense_variant", "R/T", 21, "aGa/aCa", "0/1:c"),  # after a frameshift's place
    ]
    (tmp_path / "main.vcf").write_text(HEAD + "".join(line(*x) for x in [*main, frame]))
    (tmp_path / "near.vcf").write_text(HEAD + "".join(line(*x) for x in [*main, frame, *near]))
    variants = vcf.annotated_variants(spark, str(tmp_path / "main.vcf"), "T")
    variants = variants.withColumn("index", vcf.dotted_index(variants.start, variants.variant_type))
    _, fields = vcf.header(spark, str(tmp_path / "near.vcf"))
    phased = haplotypes.phased_missense(vcf.read_vcf(spark, str(tmp_path / "near.vcf")), fields, "T")
    found = haplotypes.neighbours(variants, phased, 21)
    told = {(r["index"], r.protein_position, r.kind) for r in found.collect()}
    assert {("1025.missense", "9", "germline"), ("1025.missense", "11", "germline"), ("1040.missense", "15", "germline"), ("1061.FS", "19", "germline"), ("1061.FS", "21", "germline")} <= told
    assert not any(p in ("7", "12") for _, p, _ in told)
    # only variants of their own phase, and homozygous ones without a phase
    assert {p for i, p, _ in told if i == "1040.missense"} <= {"15", "11"}

    rows = {r.id: r.sequence for r in post.variant_sequences(haplotypes.with_neighbours(variants, found), 7).collect()}
    assert rows["MT.1025.missense"] == PROTEIN[1:8] + "I" + "R" + "E" + PROTEIN[11:16]
    assert rows["WT.1025.missense"] == PROTEIN[1:8] + "K" + "R" + "E" + PROTEIN[11:16]
    assert rows["MT.1040.missense"] == (PROTEIN[:10] + "E" + PROTEIN[11:13] + "LL" + PROTEIN[15:])[6:21]
    assert rows["MT.1061.FS"].startswith(PROTEIN[12:18] + "Y" + shifted[19:])
    done = post.run(variants, ["HLA-A*02:01"], [8], ["sum"], OPTIONS, phased=phased)
    peptides = {r["MT Epitope Seq"] for r in done.all_epitopes.where("`Gene Name` = 'G' and Start = 1025").collect()}
    own = rows["MT.1025.missense"]
    assert peptides == {own[i : i + 8] for i in range(len(own) - 7)} - {rows["WT.1025.missense"][i : i + 8] for i in range(8)}


def test_wrong_neighbours_are_an_error(spark):
    df = spark.createDataFrame([("ABC", [(2, "X", "Y")])], f"p string, c {haplotypes.CHANGES}")
    with pytest.raises(Exception, match="aren't at place 2"):
        df.select(haplotypes.carrying(F.col("p"), F.col("c"))).collect()


def test_overlap_join_equals_brute_force(spark):
    rnd = random.Random(1)
    rows = lambda: [(i, rnd.choice("ab"), s := rnd.randrange(500), s + rnd.choice([0, 1, 5, 90])) for i in range(80)]
    a, b = rows(), rows()
    x, y = spark.createDataFrame(a, "i int, k string, s int, e int"), spark.createDataFrame(b, "j int, k string, t int, f int")
    got = sorted((r.i, r.j) for r in genomic.overlap_join(x, y, ["k"], ("s", "e"), ("t", "f"), 10).collect())
    assert got == sorted((p[0], q[0]) for p in a for q in b if p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3])


# --- splicing --------------------------------------------------------------------------


def plain_exons(exons, start, stop, anchor, strand):
    """The rules, step by step over a list."""
    exons = [list(e) for e in exons]
    if anchor == "NDA":
        a = [i for i, e in enumerate(exons) if e[1] == start]
        b = [i for i, e in enumerate(exons) if e[0] == stop]
        return [e for i, e in enumerate(exons) if not a[0] < i < b[0]] if a and b else None
    if (anchor == "A") == (strand == "+"):
        if stop not in [e[0] for e in exons]:
            return None
        left = [i for i, e in enumerate(exons) if e[0] <= stop]
        for i in reversed(left):
            if i - 1 in left and exons[i - 1][0] < start < exons[i][0]:
                exons[i - 1][1] = start
                return exons
        return None
    if start not in [e[1] for e in exons]:
        return None
    right = [i for i, e in enumerate(exons) if e[1] >= start]
    for i in right:
        if i + 1 in right and exons[i][1] < stop < exons[i + 1][1]:
            exons[i + 1][0] = stop
            return exons
    return None


def test_exon_surgery(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        at, exons = 10, []
        for _ in range(rnd.randrange(1, 6)):
            exons.append((at, at + rnd.randrange(0, 12)))
            at = exons[-1][1] + rnd.randrange(2, 15)
        borders = [x for e in exons for x in e]
        start, stop = sorted(rnd.choice([rnd.choice(borders), rnd.randrange(5, at + 5)]) for _ in range(2))
        rows.append((i, exons, start, stop, rnd.choice(["A", "D", "NDA"]), rnd.choice("+-")))
    df = spark.createDataFrame(rows, "i int, exons array<struct<start:int,stop:int>>, a int, z int, anchor string, strand string")
    got = {r.i: r.x and [tuple(e) for e in r.x] for r in df.select("i", splicing.alternate_exons(F.col("exons"), F.col("a"), F.col("z"), F.col("anchor"), F.col("strand")).alias("x")).collect()}
    want = {i: (x := plain_exons(exons, a, z, anchor, strand)) and [tuple(e) for e in x] for i, exons, a, z, anchor, strand in rows if a < z}
    assert {i: got[i] for i in want} == want and sum(x is not None for x in want.values()) > 30


def test_sequences_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(splicing, "PIECE", 7)
    rnd = random.Random(2)
    seq = "".join(rnd.choice("ACGT") for _ in range(100))
    genome = spark.createDataFrame([("1", seq), ("2", "")], "chrom string, sequence string")
    new = {8: "a", 14: "C", 15: "G", 60: "T"}
    pieces = splicing.personal_pieces(splicing.genome_pieces(genome), spark.createDataFrame([("1", p, a) for p, a in new.items()] + [("1", 8, "t"), ("9", 1, "A")], "chrom string, pos int, alt string"))
    own = "".join(new.get(i + 1, x).upper() for i, x in enumerate(seq))
    asked = [(1, 1), (5, 30), (8, 14), (58, 100), (100, 100)]
    got = {(r.start, r.stop): r.sequence for r in splicing.exon_sequences(spark.createDataFrame([("1", a, b) for a, b in asked], "chrom string, start int, stop int"), pieces).collect()}
    assert got == {(a, b): own[a - 1 : b] for a, b in asked}


def translated(dna):
    out = ""
    for i in range(0, len(dna), 3):
        found = {v for k, v in CODONS.items() if k.startswith(dna[i : i + 3])}
        out += found.pop() if len(found) == 1 else "X"
    return out.split("*")[0]


def test_splice_run(spark, tmp_path):
    rnd = random.Random(12)
    coding = "ATG" + "".join(rnd.choice([k for k, v in CODONS.items() if v != "*"]) for _ in range(39))
    exons, at, seq = [], 31, "".join(rnd.choice("ACGT") for _ in range(30))
    for part in (coding[:40], coding[40:80], coding[80:]):
        gap = "GT" + "".join(rnd.choice("ACGT") for _ in range(20)) + "AG"
        exons.append((at, at + len(part) - 1))
        seq, at = seq + part + gap, at + len(part) + len(gap)
    (tmp_path / "g.fa").write_text(f">chr1 one\n{seq[:70]}\n{seq[70:]}\n")
    attrs = 'gene_id "ENSG1"; transcript_id "ENST1"; transcript_biotype "protein_coding"; transcript_support_level "1"; gene_name "GENE";'
    gtf = [f"chr1\tx\ttranscript\t31\t{exons[-1][1]}\t.\t+\t.\t{attrs}"] + [f"chr1\tx\tCDS\t{a}\t{b}\t.\t+\t0\t{attrs} exon_number \"{i + 1}\";" for i, (a, b) in enumerate(exons)]
    (tmp_path / "g.gtf").write_text("\n".join(gtf) + "\n")
    donor = exons[0][1] - 9  # a new donor inside the first exon, its acceptor known: anchor A on the plus strand
    head = "chrom start end name score strand splice_site acceptors_skipped exons_skipped donors_skipped anchor known_donor known_acceptor known_junction gene_names gene_ids transcripts variant_info".split()
    row = lambda name, a, z, score, anchor, info: ["chr1", a, z, name, score, "+", "GT-AG", 0, 0, 0, anchor, 0, 1, 0, "GENE", "ENSG1", "ENST1.2", info]
    var = f"chr1:{donor + 1}-{donor + 2}"
    rows = [row("J1", donor, exons[1][0], 50, "A", var), row("J2", exons[0][1], exons[2][0], 50, "NDA", var), row("J3", donor, exons[1][0], 3, "A", var), row("J4", donor + 1, exons[1][0] + 1, 50, "A", var), row("J5", donor, exons[1][0], 50, "A", "chr1:9-10")]
    (tmp_path / "j.tsv").write_text("\n".join("\t".join(map(str, x)) for x in [head, *rows]) + "\n")
    pos = donor + 2
    csq = "##INFO=<ID=CSQ,Number=.,Type=String,Description=\"Format: Allele|Consequence|SYMBOL|Feature|BIOTYPE|Gene|TSL|CANONICAL|MANE_SELECT\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tT\n"
    alt = "A" if seq[pos - 1] != "A" else "C"
    (tmp_path / "v.vcf").write_text(f"##fileformat=VCFv4.2\n{csq}chr1\t{pos}\t.\t{seq[pos - 1]}\t{alt}\t.\tPASS\tCSQ={alt}|splice_donor_variant|GENE|ENST1.2|protein_coding|ENSG1|1|YES|NM\tGT:DP:AD\t0/1:40:20,20\n")

    models = transcripts.read_gtf(spark, str(tmp_path / "g.gtf"))
    variants = vcf.annotated_variants(spark, str(tmp_path / "v.vcf"), "T", splice=True)
    events = other_runs.splice_inputs(transcripts.read_junctions(spark, str(tmp_path / "j.tsv")), models, variants)
    assert {r.name for r in events.collect()} == {"J1", "J2", "J4"}
    genome = fasta.read_fasta(spark, str(tmp_path / "g.fa")).select(F.col("id").alias("chrom"), "sequence")
    new = variants.select(F.col("chromosome_name").alias("chrom"), F.col("start").alias("pos"), F.col("variant").alias("alt"))
    done = other_runs.splice_run(events, models, genome, new, ["HLA-A*02:01"], [8, 9], ["sum"], OPTIONS)
    own = seq[: pos - 1] + alt + seq[pos:]
    piece = lambda *e: "".join(own[a - 1 : b] for a, b in e)
    wild, first, skipped = piece(*exons), piece((31, donor), *exons[1:]), piece(exons[0], exons[2])
    novel = lambda p: {p[i : i + k] for k in (8, 9) for i in range(len(p) - k + 1)} - {translated(wild)[i : i + k] for k in (8, 9) for i in range(len(translated(wild)))} if p.startswith("M") else set()
    got = {}
    for r in done.all_epitopes.collect():
        got.setdefault(r.Junction, set()).add(r["Epitope Seq"])
        assert r["Median IC50 Score"] == SCORE(r["Epitope Seq"]) and r["WT Protein Length"] == len(translated(wild)) and r["Tumor DNA VAF"] == 0.5
        dna = first if r.Junction == "J1" else skipped
        assert ("frameshift" in r.Index) == (len(dna) % 3 != 0) and translated(dna)[r["Protein Position"] - 1 :].startswith(r["Epitope Seq"])
    want = {"J1": {x for x in novel(translated(first)) if "X" not in x}, "J2": {x for x in novel(translated(skipped)) if "X" not in x}}
    assert got == {k: v for k, v in want.items() if v} and got
    report = {r["Junction Name"]: r for r in post.tiered(done.aggregated, post.SPLICE, Thresholds()).collect()}
    assert {k: r["IC50 MT"] for k, r in report.items()} == {k: min(map(SCORE, v)) for k, v in got.items()}


# --- fusions ---------------------------------------------------------------------------


def test_fusion_run(spark, tmp_path):
    head = ["#gene1", "gene2", "breakpoint1", "breakpoint2", "split_reads1", "split_reads2", "discordant_mates", "reading_frame", "peptide_sequence", "transcript_id1", "transcript_id2"]
    left, right = "MKTAYIAKQRQI", "WDEFGHIKLMNPQ"
    rows = [
        ("A", "B", "1:100", "2:200", 3, 4, 1, "in-frame", f"{left.lower()}|{right}*", "TA", "TB"), ("A", "C", "1:100", "chr3:300", 9, 0, 0, "out-of-frame", f"{left}|{right[::-1]}", "TA", "TC"), ("A", "D", "1:1", "2:2", 9, 9, 9, ".", f"{left}|{right}", "TA", "TD"),
        ("A", "E", "1:1", "2:2", 9, 9, 9, "in-frame", ".", "TA", "TE"),
    ]
    (tmp_path / "a.tsv").write_text("\n".join("\t".join(map(str, x)) for x in [head, *rows]) + "\n")
    (tmp_path / "s.tsv").write_text("LeftBreakpoint\tRightBreakpoint\tJunctionReadCount\tSpanningFragCount\tFFPM\nchr1:100:+\tchr2:200:-\t5\t6\t0.7\nchr1:80:-\tchr2:990:-\t7\t2\t1.5\n")
    star = transcripts.read_star_fusion(spark, str(tmp_path / "s.tsv"))
    fusions = other_runs.called_fusions(transcripts.read_arriba(spark, str(tmp_path / "a.tsv")), star)
    told = {r.gene_name: r for r in fusions.collect()}
    assert set(told) == {"A-B", "A-C"} and told["A-B"]["index"] == "1.A-B.TA-TB.inframe_fusion.12" and told["A-B"].start == "100 / 200" and (told["A-B"].read_support, told["A-B"].expression, told["A-C"].expression) == (8, 0.7, None)
    done = other_runs.fusion_run(fusions, ["HLA-A*02:01"], [8], ["sum"], OPTIONS)
    got = {}
    for r in done.all_epitopes.collect():
        got.setdefault(r["Gene Name"], set()).add((r["Sub-peptide Position"], r["Epitope Seq"]))
    windows = {"A-B": (left + right)[5:19], "A-C": (left + right[::-1])[5:]}
    assert got == {g: {(i + 1, w[i : i + 8]) for i in range(len(w) - 7)} for g, w in windows.items()}
    assert {r["Gene Name"] for r in done.filtered.collect()} == {"A-B", "A-C"}  # an expression that isn't there passes
    tier = {r.Gene: r.Tier for r in post.tiered(done.aggregated, post.FUSION, Thresholds()).collect()}
    assert tier["A-B"] == "Pass"

    (tmp_path / "ag" / "A-B").mkdir(parents=True)
    (tmp_path / "ag" / "A-B" / "A-B_protein.fa").write_text(f">TA_TB length: 25, kD: 2.0, transcripts: TA_TB, genes: A/B, fusion: A-B, effect: in-frame (with mutation)\n{left}*\n{right}\n")
    (tmp_path / "ag" / "A-B" / "A-B.exons.txt").write_text("5'_gene,3'_gene,5'_transcript,3'_transcript,exon_gene_source,exon_number,exon_chr,exon_start,exon_end\n" + "".join(f"A,B,TA,TB,{x}\n" for x in ("A,1,1,80,100", "A,2,1,120,140", "B,1,2,900,950", "B,2,2,970,990")))
    proteins = transcripts.read_agfusion_proteins(spark, str(tmp_path / "ag"))
    exons = transcripts.read_agfusion_exons(spark, str(tmp_path / "ag" / "*" / "*.exons.txt"))
    alone, = other_runs.assembled_fusions(proteins, exons).collect()
    assert (alone.gene_name, alone.transcript_name, alone.variant_type, alone.protein_position, alone.fusion_amino_acid_sequence, alone.read_support) == ("A/B", "TA-TB", "inframe_fusion", 12, left + right, None)
    both, = other_runs.assembled_fusions(proteins, exons, star).collect()  # minus and minus: the first gene's least place, the second's last
    assert (both.start, both.read_support, both.expression) == ("80 / 990", 9, 1.5)
    with pytest.raises(Exception, match="no joint"):
        other_runs.assembled_fusions(proteins.withColumn("sequence", F.lit("AAA")), exons).collect()


# --- constructs, alignment, documents, metrics, several scores -----------------------------


def plain_design(peptides, score, spacers, flank, k, threshold, clips):
    """One construct, round by round, with all orders tried."""
    import itertools

    ids, edges = sorted(peptides), {}
    for clip in range(clips + 1):
        for spacer in spacers:
            new = {}
            for a, b in itertools.permutations(ids, 2):
                if (a, b) in edges:
                    continue
                for i in range(clip + 1):
                    for j in range(clip + 1):
                        if max(i, j) != clip:
                            continue
                        left = peptides[a][: len(peptides[a]) - i][-flank:]
                        text = left + ("" if spacer == "None" else spacer) + peptides[b][j : j + flank]
                        scores = [score(text[n : n + k]) for n in range(len(text) - k + 1)]
                        if scores and min(scores) >= threshold:
                            new[a, b] = max(new.get((a, b), (-1.0,)), (min(scores), -(i + j), spacer, i, j))
            edges |= new
            best = max((sum(edges[e][0] for e in itertools.pairwise(p)) for p in itertools.permutations(ids) if all(e in edges for e in itertools.pairwise(p))), default=None)
            if best is not None:
                return best, edges
    return None, edges


def test_designs_of_many_constructs(spark):
    from neolake.operators import constructs

    rnd = random.Random(6)
    rows = [(f"c{i}", f"p{j}", "".join(rnd.choice("ACDEFG") for _ in range(rnd.choice([4, 9, 12])))) for i in range(12) for j in range(rnd.choice([1, 2, 3, 4, 5]))] + [("bad", "a", "AAAAAAA"), ("bad", "b", "AAAAAAAA")]
    score = lambda e: float(sum(ord(x) * (i + 3) for i, x in enumerate(e)) % 53)
    scored = F.udf(lambda e: score(e) if set(e) != {"A"} else 0.0, "double")
    plain = lambda e: score(e) if set(e) != {"A"} else 0.0
    df = spark.createDataFrame(rows, "construct string, id string, sequence string")
    done = {r.construct: r for r in constructs.design(df, lambda d: d.withColumns({"score": scored("epitope"), "percentile": F.lit(1.0)}), ["None", "GG"], 4, 5, 6.0, clips=1).collect()}
    assert set(done) == {r[0] for r in rows}
    for name, r in done.items():
        own = {i: s for c, i, s in rows if c == name}
        best, edges = plain_design(own, plain, ["None", "GG"], 4, 5, 6.0, 1)
        if best is None:
            assert r.order is None and r.sequence is None
            continue
        assert sorted(r.order) == sorted(own) and sum(j.weight for j in r.junctions) == best
        text = own[r.order[0]]
        for j in r.junctions:
            assert (j.weight, -(j.left_clip + j.right_clip), j.spacer) == edges[j.left, j.right][:3]
            text = text[: len(text) - j.left_clip] + ("" if j.spacer == "None" else j.spacer) + own[j.right][j.right_clip :]
        assert r.sequence == text
    assert done["bad"].order is None and sum(r.order is not None for r in done.values()) > 3


def plain_alignment_score(a, b):
    low = -1e9
    m = {(0, 0): (0.0, low, low)}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if i or j:
                x = max(m[i - 1, j - 1]) + (2 if a[i - 1] == b[j - 1] else -1) if i and j else low
                y = max(m[i - 1, j][0] - 5, m[i - 1, j][1] - 0.5, m[i - 1, j][2] - 5) if i else low
                z = max(m[i, j - 1][0] - 5, m[i, j - 1][1] - 5, m[i, j - 1][2] - 0.5) if j else low
                m[i, j] = (x, y, z)
    return max(m[len(a), len(b)])


def test_alignments(spark):
    from neolake.operators import alignment

    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("ACDé") for _ in range(n))
    rows = [(i, w := word(rnd.randrange(0, 25)), w[: rnd.randrange(len(w) + 1)] + word(rnd.randrange(6)) + w[rnd.randrange(len(w) + 1) :]) for i in range(120)] + [(998, None, "A"), (999, "A", None), (1000, "ACDEFGHIK", "ACDHIK"), (1001, "ACDEF", "ACWEF")]
    df = spark.createDataFrame(rows, "i int, w string, m string").repartition(3)
    got = {r.i: r for r in df.select("i", alignment.aligned(F.col("w"), F.col("m")).alias("a"), alignment.aligned(F.col("w"), F.col("m"), band=60).alias("b")).select("i", "a", "b", alignment.changed_places(F.col("a")).alias("at")).collect()}
    for i, w, m in rows:
        if w is None or m is None:
            assert got[i].a is None and got[i].at is None
            continue
        a = got[i].a
        assert a.wild.replace("-", "") == w and a.mutant.replace("-", "") == m and len(a.wild) == len(a.mutant) and a == got[i].b
        assert a.score == plain_alignment_score(w, m)
    assert got[1000].a[1:] == ("ACDEFGHIK", "ACD---HIK") and got[1001]["at"] == [3]


def test_document_differences(spark):
    import json

    from neolake.operators import documents

    rnd = random.Random(10)

    def value(depth):
        k = rnd.randrange(8 if depth else 5)
        return [rnd.randrange(4), rnd.choice(["x", "y\"\\", "", "é\n"]), None, rnd.choice([True, False]), rnd.randrange(3) + 0.5, [value(depth - 1) for _ in range(rnd.randrange(4))] if depth else 0, {rnd.choice(["a", "b/c", "~", "chrX", 'q"']): value(depth - 1) for _ in range(rnd.randrange(4))} if depth else 0, [1, 2]][k]

    def shuffled(x):
        if isinstance(x, dict):
            items = [(k, shuffled(v)) for k, v in x.items()]
            rnd.shuffle(items)
            return dict(items)
        if isinstance(x, list):
            return rnd.sample([shuffled(v) for v in x], len(x))
        return x

    def bare(x):
        if isinstance(x, dict):
            return {k: bare(v) for k, v in x.items() if not k.startswith("chr")}
        return [bare(v) for v in x] if isinstance(x, list) else x

    def form(x):
        if isinstance(x, dict):
            return "{" + ",".join(sorted(json.dumps(k, ensure_ascii=False) + ":" + form(v) for k, v in x.items())) + "}"
        if isinstance(x, list):
            return "[" + ",".join(sorted(map(form, x))) + "]"
        return json.dumps(x, ensure_ascii=False)

    def flat(x, path=""):
        from collections import Counter

        if isinstance(x, dict) and x:
            out = Counter()
            for k, v in x.items():
                out += flat(v, path + "/" + k.replace("~", "~0").replace("/", "~1"))
            return out
        if isinstance(x, list) and x:
            return Counter((path + "[]", form(v)) for v in x)
        return Counter({(path, form(x)): 1})

    pairs = []
    for i in range(60):
        a = {"top": value(3), "l": [value(2) for _ in range(3)], "chr1": value(1)}
        b = shuffled(a) if i % 2 else {**shuffled(a), "top": value(3)}
        pairs.append((i, a, b))
    make = lambda k: spark.createDataFrame([(p[0], json.dumps(p[k])) for p in pairs] + [(99, None)], "doc int, json string")
    got = documents.document_differences(make(1), make(2), "^chr").collect()
    want = {}
    for i, a, b in pairs:
        x, y = flat(bare(a)), flat(bare(b))
        for path, text in x.keys() | y.keys():
            if x[path, text] != y[path, text]:
                want.setdefault((i, path), []).append((text, x[path, text], y[path, text]))
    assert {r.doc for r in got} == {i for i, _ in want} and not any(i % 2 for i, _ in want)
    seen = {}
    for r in got:
        if r.path.endswith("[]"):
            seen.setdefault((r.doc, r.path), []).append((r.value_1 or r.value_2, r.n_1, r.n_2))
        else:
            seen.setdefault((r.doc, r.path), []).extend((t, n, m) for t, n, m in ((r.value_1, 1, 0), (r.value_2, 0, 1)) if t is not None)
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    with pytest.raises(Exception, match="JSON|json"):
        documents.flattened(spark.createDataFrame([(1, "{")], "doc int, json string")).collect()


def test_metrics_object(spark, tmp_path):
    import json

    from neolake.operators import metrics

    names = ["v", "Transcript", "MT Epitope Seq", "WT Epitope Seq", "HLA Allele", "n", "Median MT IC50 Score", "Median WT IC50 Score", "Median MT Percentile", "A MT IC50 Score", "A WT IC50 Score", "A MT Percentile", "BigMHC_EL MT Score", "Problematic Positions", "Mutation Position", "Variant Type", "ok", "Transcript Expression", "MANE Select", "Tumor DNA VAF"]
    row = lambda n, tr, ep, wt, al, mt, prob="None", ok=True, kind="missense": (1, tr, ep, wt, al, n, mt, 900.0, 0.5, mt, None, 1.5, 0.25, prob, "3", kind, ok, None, True, 0.4)
    rows = [row(1, "T1", "PB", "WB", "X2", 50.0, ok=False), row(2, "T1", "PA", "WA", "X1", 70.0), row(3, "T1", "PA", "WA", "X1", 60.0), row(4, "T2", "PA", None, "X1", None, "2", kind="FS"), row(5, "T3", "PB", "WB", "X2", 10.0), row(6, "T3", "PA", "WA", "X1", 20.0)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {t}" for n, t in zip(names, "int string string string string int double double double double double double double string string string boolean double boolean double".split(), strict=True)))
    objects = metrics.metrics_objects(df, df.where("n = 5"), ["v"], "Transcript", ["X2", "X1"], ["n"], ["A"], ["BigMHC_EL"], anchor="ok")
    metrics.write_metrics(objects, ["v"], str(tmp_path / "m"))
    told = json.loads(spark.read.text(str(tmp_path / "m")).first()[0])
    assert told["ID"] == "1"
    m = told["metrics"]
    assert m["sets"] == ["Transcript Set 1", "Transcript Set 2"] and m["transcript_counts"] == [2, 1] and m["peptide_counts"] == [2, 1] and m["best_peptide_mt"] == "PB" and m["RNA VAF"] == "NA" and m["DNA VAF"] == 0.4 and m["best_hla_allele"] == "X2"
    one = m["good_binders"]["Transcript Set 1"]
    assert list(one["peptides"]) == ["PA", "PB"] and sorted(one["transcripts"]) == ["T1", "T3"] and one["transcript_expr"] == ["NA", "NA"]
    pa, pb = one["peptides"]["PA"], one["peptides"]["PB"]
    assert pa["ic50s_MT"] == [60, "X"] and pb["ic50s_MT"] == ["X", 50] and pa["hla_types"] == ["X1", "X2"] and pb["anchor_fails"] == "X2" and pa["anchor_fails"] == "None" and pa["wt_peptide"] == "WA" and pa["mutation_position"] == "3"
    assert pa["individual_ic50_calls"] == {"algorithms": ["A"], "MT": {"X1": [60]}, "WT": {"X1": ["NA"]}} and pb["individual_el_calls"]["MT"] == {"X2": [0.25]} and pb["individual_el_percentile_calls"]["MT"] == {"X2": ["NA"]} and pa["individual_percentile_calls"] == {"algorithms": ["A"], "MT": {"X1": [1.5]}, "WT": {"X1": ["NA"]}}
    two = m["good_binders"]["Transcript Set 2"]["peptides"]["PA"]
    assert two["ic50s_MT"] == ["NA", "X"] and two["wt_peptide"] == "FS-NA" and two["problematic_positions"] == "2"


def test_values_of_methods(spark):
    rows = [
        ("MHCflurry", {"ic50": "10", "percentile": "0.5", "mhcflurry_processing_score": "0.1", "mhcflurry_presentation_score": "0.2", "mhcflurry_presentation_percentile": ""}), ("NetMHC", {"ic50": "20", "rank": "None"}), ("PickPocket", {"ic50": "5", "percentile_rank": "3"}),
        ("DeepImmuno", {"immunogenicity": "0.7"}), ("NetMHCIIpanEL", {"score": "0.9", "rank": "1"}), ("netmhciipan_el-4", {"ic50": "0.4"}), ("NetMHCpan_EL", {"score": "0.3", "percentile": "2"}),
    ]
    df = spark.createDataFrame(rows, "m string, f map<string,string>")
    value = lambda how: {r.m: (r.x.scores, r.x.percentiles) for r in df.select("m", predictions.method_values(F.col("m"), F.col("f"), how).alias("x")).collect()}
    got = value("both")
    assert got["MHCflurry"] == ({"ic50": 10.0, "mhcflurry_processing_score": 0.1, "mhcflurry_presentation_score": 0.2}, {"percentile": 0.5, "mhcflurry_presentation_percentile": None})
    assert value("only")["MHCflurry"] == ({"mhcflurry_processing_score": 0.1, "mhcflurry_presentation_score": 0.2}, {"mhcflurry_presentation_percentile": None}) and value("none")["MHCflurry"] == ({"ic50": 10.0}, {"percentile": 0.5})
    assert got["NetMHC"] == ({"ic50": 20.0}, {"percentile": None}) and got["PickPocket"][1] == {"percentile": 3.0} and got["DeepImmuno"] == ({"score": 0.7}, {"percentile": None}) and got["netmhciipan_el-4"][0] == {"score": 0.4} and got["NetMHCpan_EL"] == ({"score": 0.3}, {"percentile": 2.0})
    with pytest.raises(Exception, match="no score in the output"):
        spark.createDataFrame([("netmhciipan_el", {"x": "1"})], "m string, f map<string,string>").select(predictions.method_values(F.col("m"), F.col("f"))).collect()


def test_peptides_of_several_lengths(spark):
    df = spark.createDataFrame([("MT.a", "ACDEF")], "id string, sequence string")
    got = sorted((r.length, r.position, r.epitope) for r in post.peptides_of(df, [3, 4], ["x"]).collect())
    assert got == sorted((k, i + 1, "ACDEF"[i : i + k]) for k in (3, 4) for i in range(6 - k))


def test_ordering_form(spark):
    names = "index string, variant_type string, protein_position string, amino_acid_change string, wildtype_amino_acid_sequence string, frameshift_amino_acid_sequence string"
    variants = spark.createDataFrame([("v1", "missense", "9", "Q/W", PROTEIN, None), ("v2", "inframe_del", "5", "YI/Y", PROTEIN, None), ("v3", "missense", "9", "Q/K", PROTEIN, None)], names)
    shape = "ID string, Index string, Evaluation string, `Best Peptide` string, `IC50 MT` double, `%ile MT` double"
    one = spark.createDataFrame([("1-9", "v1", "Accept", "AKWRQISF", 50.0, 9.0), ("1-5", "v2", "Accept", "TAYAKQ", 5000.0, 9.0), ("1-9", "v3", "Reject", "AKKRQISF", 1.0, 0.1)], shape)
    two = spark.createDataFrame([("1-9", "v1", "Pending", "KWRQ", 9999.0, 0.5), ("1-5", "v2", "Pending", "TAYAKQ", 9999.0, 99.0)], shape)
    calls = spark.createDataFrame([("1-9",), ("1-9",)], "ID string")
    form = {r.Index: r for r in post.ordering_run(variants, one, two, (calls, calls), flank=8, limits=post.OrderLimits(difficult=("K",))).collect()}
    assert set(form) == {"v1", "v2"}
    r = form["v1"]
    own = PROTEIN[:8] + "W" + PROTEIN[9:17]
    assert r.sequence == own and r["Variant Called by External Pipeline"] and not form["v2"]["Variant Called by External Pipeline"] and r["c_terminal_cysteine"] is False
    told = {k: [i for i, s in enumerate(r.styles) if s[k]] for k in ("bold", "color", "underline", "large")}
    assert "".join(s.aa for s in r.styles) == own and told["underline"] == [8] and told["color"] == list(range(own.index("AKWRQISF"), own.index("AKWRQISF") + 8)) and told["bold"] == list(range(7, 11)) and told["large"] == [i for i, x in enumerate(own) if x == "K"]
    assert not any(s.color or s.bold for s in form["v2"].styles) and form["v2"].sequence.startswith("MKTAYAKQ")
