"""Predicates and sequence expressions against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from neolake.functions import filters as P
from neolake.functions import sequences as S
from neolake.sources import fasta


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


@pytest.mark.parametrize(("op", "value", "ok"), [("<", 5.0, False), ("<=", 5.0, True), ("==", 5.0, True), (">=", 5.0, True), (">", 5.0, False), (">", 4.0, True)])
def test_criterion_operators(spark, op, value, ok):
    df = spark.createDataFrame([("5",)], "x string")
    assert df.select(P.Criterion("x", op, value).passes().alias("p")).first()["p"] is ok


def test_criterion_missing_and_special_values(spark):
    df = spark.createDataFrame([(None,), ("NA",), ("inf",), ("Not Run",), ("bad",)], "x string")
    keep = [r[0] for r in df.select(P.Criterion("x", ">=", 1.0, skip="Not Run").passes()).collect()]
    assert keep == [True, True, True, True, False]
    drop = [r[0] for r in df.select(P.Criterion("x", ">=", 1.0, exclude_nas=True).passes()).collect()]
    assert drop == [False, False, True, False, False]


def test_or_keeps_all_that_and_keeps(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 9)) if rnd.random() > 0.2 else None, float(rnd.randint(0, 9))) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double")
    tests = [P.Criterion("a", "<", 5.0), P.Criterion("b", ">", 3.0)]
    got = df.select(P.all_of(tests).alias("x"), P.any_of(tests).alias("y")).collect()
    assert all(not r.x or r.y for r in got) and all(r.x is not None and r.y is not None for r in got)


def test_problematic_positions(spark):
    seq = F.lit("CPCAAC")
    got = one(spark, a=P.problematic_positions(seq, ["C"]), b=P.problematic_positions(seq, ["C:1"]), c=P.problematic_positions(seq, ["C:-1"]), d=P.problematic_positions(seq, ["W", "K:2"]), e=P.problematic_positions(seq, ["AA", "P"]))
    assert tuple(got) == ("1, 3, 6", "1", "6", "None", "2, 4")


def test_anchor_pass(spark):
    f = lambda pos, wt: P.anchor_pass(F.lit(pos), P.default_anchors(F.lit(9)), F.lit(wt).cast("double"), F.lit(500.0))
    assert tuple(one(spark, a=f("2", 100.0), b=f("2", 900.0), c=f("2", None), d=f("5", 100.0), e=f("1, 2, 9", 100.0), g=f("2, 5", 100.0))) == (False, True, False, True, True, True)


def test_preferred_transcript(spark):
    df = spark.createDataFrame([("True", "False", "5"), ("False", "False", "Not Supported"), ("False", "False", None), ("Not Run", "False", "5"), ("False", "False", "1")], "`MANE Select` string, Canonical string, `Transcript Support Level` string")
    assert [r[0] for r in df.select(P.preferred_transcript(["mane_select", "tsl"], 1)).collect()] == [True, True, False, True, True]


def test_kmers_short_and_long(spark):
    got = one(spark, a=S.kmers(F.lit("ABCD"), 3), b=S.kmers(F.lit("AB"), 3), c=S.places(F.lit(0)))
    assert [tuple(x) for x in got.a] == [(1, "ABC"), (2, "BCD")] and got.b == [] and got.c == []


def test_match_measures(spark):
    rnd = random.Random(1)
    pairs = [("".join(rnd.choice("AC") for _ in range(6)), "".join(rnd.choice("AC") for _ in range(6))) for _ in range(50)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", S.matches(F.col("a"), F.col("b")).alias("m"), S.matches_from_left(F.col("a"), F.col("b")).alias("l"), S.matches_from_right(F.col("a"), F.col("b")).alias("r"), S.mutated_positions(F.col("a"), F.col("b")).alias("p")).collect():
        same = [x == y for x, y in zip(r.a, r.b)]
        left = next((i for i, s in enumerate(same) if not s), 6)
        right = next((i for i, s in enumerate(same[::-1]) if not s), 6)
        assert (r.m, r.l, r.r, r.p) == (sum(same), left, right, ", ".join(str(i + 1) for i, s in enumerate(same) if not s))


def test_windows_and_changes(spark):
    got = one(
        spark, a=S.changed_window(F.lit("MKLVTTPQR"), F.lit("MKLVAAPQR"), 2), b=S.centred(F.lit("ABCDEFGHIJ"), F.lit(1), 2), c=S.centred(F.lit("ABCDEFGHIJ"), F.lit(5), 2), d=S.frameshift_window(F.lit("ABCDEFGHIJ"), F.lit(5), 2, 3),
        e=S.mutated_protein(F.lit("MKLV"), F.lit("K/R"), F.lit(2)), f=S.mutated_protein(F.lit("MKLV"), F.lit("-/WW"), F.lit(2)), g=S.mutated_protein(F.lit("MKLV"), F.lit("KL/-"), F.lit(2)), h=S.mutated_protein(F.lit("MKLV"), F.lit("K/*"), F.lit(2)), i=S.mutated_protein(F.lit("MKLV"), F.lit("L/R"), F.lit(2)),
    )
    assert tuple(got) == ("LVTTPQ", "ABCDE", "CDEFG", "CDEFGH", "MRLV", "MKWWLV", "MV", "M", None)


def test_nucleotides(spark):
    got = one(spark, a=S.translate_dna(F.lit("ATGGCCTAAGGG")), b=S.translate_dna(F.lit("ATGNNNA")), c=S.reverse_complement(F.lit("ATGC")), d=S.back_translated(F.lit("MA")), e=S.merged_codon(F.array(F.lit("gAt/gCt"), F.lit("Gat/Aat"))))
    assert tuple(got) == ("MA", "MX", "GCAT", "ATGGCC", "ACT")
    back = one(spark, a=S.translate_dna(S.back_translated(F.lit(fasta.AMINO_ACIDS))))
    assert back.a == fasta.AMINO_ACIDS


def test_manufacturability(spark):
    m = one(spark, **S.manufacturability(F.lit("QCNPAAAAC")))
    assert (m.difficult_n_terminal_residue, m.c_terminal_cysteine, m.c_terminal_proline, m.cysteine_count, m.n_terminal_asparagine, m.asparagine_proline_bond_count) == (True, True, False, 2, False, 1)
    kd = S.HYDROPATHY
    sevens = [sum(kd[c] for c in "QCNPAAAAC"[i : i + 7]) / 7 for i in range(3)]
    assert m.max_7mer_gravy_score == pytest.approx(max(sevens), abs=1e-5) and m.cterm_7mer_gravy_score == pytest.approx(sevens[-1], abs=1e-5)
    assert all(v is None for v in one(spark, **S.manufacturability(F.lit("QCNPA"))))


def test_overlay_core_and_window(spark):
    changes = F.array(F.struct(F.lit(2).alias("pos"), F.lit("B").alias("wild"), F.lit("X").alias("mutant")), F.struct(F.lit(3).alias("pos"), F.lit("Q").alias("wild"), F.lit("Y").alias("mutant")))
    got = one(spark, a=S.overlaid(F.lit("ABCD"), changes), b=S.core_position(F.lit(5), F.lit("CD"), F.lit("ABCDE")), c=S.window_around(F.lit("AAXYAAXYAA"), F.lit("XY"), 1, F.lit(7)))
    assert tuple(got) == ("AXCD", 3, "AXYA")


def test_sequence_cleaning(spark):
    got = one(spark, a=fasta.clean_sequence(F.lit("mkl*vv")), b=fasta.supported(F.lit("MKU")), c=fasta.trim_unsupported(F.lit("AU" + "C" * 8 + "XX")), d=fasta.trim_unsupported(F.lit("CCCCCCUA")))
    assert tuple(got) == ("MKL", False, "CCCCCCCC", "CCCCCC")


def test_kmers_of_long_texts_take_linear_time(spark):
    import time

    text = "".join(chr(97 + (i * i + i // 7) % 26) if i % 5 else "é\U0001f600"[i % 2] for i in range(1_000_000))
    sizes = (256, 257, 1000, 20_000)
    df = spark.createDataFrame([(text[:n],) for n in sizes], "s string").coalesce(1)
    for k in (1, 9, 40, 255, 256, 700):
        got = df.select(S.kmers(F.col("s"), k).alias("k")).select(F.size("k"), F.expr("try_element_at(k, 1)"), F.expr("try_element_at(k, greatest(size(k), 1))"), F.expr("try_element_at(k, 301)")).collect()
        for r, n in zip(got, sizes):
            if n < k or n < 1000:
                assert r[0] == max(0, n - k + 1)
                continue
            assert r[0] == n - k + 1 and tuple(r[1]) == (1, text[:k]) and tuple(r[2]) == (n - k + 1, text[n - k : n]) and tuple(r[3]) == (301, text[300 : 300 + k])
    took = []
    for size in (250_000, 1_000_000):
        one = spark.createDataFrame([(text[:size],)], "s string")
        began = time.time()
        one.select(F.size(S.kmers(F.col("s"), 20)), S.matches(F.col("s"), F.reverse("s")), F.length(S.translate_dna(F.col("s"))), F.size(S.letters(F.col("s")))).collect()
        took.append(time.time() - began)
    assert took[1] < 12 * took[0] + 2  # four times the letters; quadratic time would be over 16 times, and minutes
