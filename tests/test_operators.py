"""Operators against literal versions of what they stand for."""

from __future__ import annotations

import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from neolake.operators import aggregate, candidates, compare, filters, genomic, predictions, reference, tiers, vector
from neolake.schemas import Thresholds


def test_fold_change_is_anded_unless_compat(spark):
    df = spark.createDataFrame([(900.0, 0.1, 9.0), (100.0, 9.0, 0.1), (900.0, 9.0, 9.0)], "`Median MT IC50 Score` double, `Median MT Percentile` double, `Corresponding Fold Change` double")
    t = Thresholds(percentile=1.0, fold_change=1.0, strategy="exploratory")
    assert filters.binding_filter(df, t).count() == 1
    assert filters.binding_filter(df, t, compat=True).count() == 3


def test_allele_specific_filter_uses_the_default_elsewhere(spark):
    df = spark.createDataFrame([("a", 700.0), ("b", 700.0), ("b", None)], "`HLA Allele` string, `Median MT IC50 Score` double")
    cut = spark.createDataFrame([("a", 800.0)], "allele string, cutoff double")
    assert sorted(r[0] for r in filters.allele_specific_filter(df, cut, Thresholds()).collect()) == ["a", "b"]
    assert [r[0] for r in filters.allele_specific_filter(df, cut, Thresholds(exclude_nas=True)).collect()] == ["a"]


@pytest.mark.parametrize("incomplete", [False, True])
def test_best_candidate_equals_the_literal_cascade(spark, incomplete):
    rnd = random.Random(5)
    rows = [
        (i, rnd.randrange(40), rnd.choice(["None", "cds_start_NF"]), rnd.choice(["protein_coding", "x"]), rnd.random() < 0.5, rnd.random() < 0.5, str(rnd.choice([1, 2, "Not Supported"])), rnd.choice(["None", "3"]), float(rnd.randint(1, 4)), rnd.randint(1, 3), float(rnd.randint(1, 3)))
        for i in range(500)
    ]
    names = ["id", "key", "Transcript CDS Flags", "Biotype", "MANE Select", "Canonical", "Transcript Support Level", "Problematic Positions", "score", "Transcript Length", "Transcript Expression"]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=names))
    got = {r["key"]: r["id"] for r in candidates.best_candidate(df, ["key"], Thresholds(), "score", ["id"], allow_incomplete=incomplete).collect()}
    for key, g in pd.DataFrame(rows, columns=names).groupby("key"):
        tsl = g["Transcript Support Level"]
        for keep in (g["Transcript CDS Flags"] == "None" if incomplete else g.key == key, g.Biotype == "protein_coding", g["MANE Select"] | g.Canonical | (tsl == "Not Supported") | (tsl == "1"), g["Problematic Positions"] == "None"):
            part = g[keep.reindex(g.index)]
            g = part if len(part) else g
        g = g.assign(t=pd.to_numeric(g["Transcript Support Level"], errors="coerce"))
        g = g.sort_values(["score", "MANE Select", "Canonical", "t", "Transcript Length", "Transcript Expression", "id"], ascending=[True, False, False, True, False, False, True], na_position="last")
        assert got[key] == g.iloc[0].id


def test_summary_ties_and_independent_percentile(spark):
    df = spark.createDataFrame([("k", "B", 5.0, 50.0, 2.0, None), ("k", "A", 5.0, 10.0, 3.0, 1.0), ("k", "C", 9.0, None, 1.0, 7.0), ("z", "A", 0.0, 4.0, None, None), ("w", "A", 3.0, None, None, None)], "key string, method string, score double, wt_score double, percentile double, wt_percentile double")
    r = {x["key"]: x for x in predictions.summarise(df, ["key"]).collect()}
    assert (r["k"].best_score, r["k"].best_score_method, r["k"].corresponding_wt_score, r["k"].median_score, r["k"].median_wt_score) == (5.0, "A", 10.0, 5.0, 30.0)
    assert (r["k"].best_percentile, r["k"].best_percentile_method, r["k"].corresponding_wt_percentile) == (1.0, "C", 7.0)
    assert r["z"].corresponding_fold_change == float("inf") and r["w"].corresponding_fold_change is None and r["k"].corresponding_fold_change == 2.0


def test_wildtype_matching(spark):
    mt = [("s", "A", 3, 1, "ABC", "missense", 0), ("s", "A", 3, 2, "BCX", "missense", 0), ("s", "A", 3, 3, "XYZ", "FS", 0), ("i", "A", 4, 1, "ABCD", "inframe_del", 2), ("i", "A", 4, 2, "BCFG", "inframe_del", 2), ("i", "A", 4, 3, "CFGH", "inframe_del", 2)]
    mt += [("i", "A", 4, 4, "FGHI", "inframe_del", 2)]
    wt = [("s", "A", 3, 1, "ABC"), ("s", "A", 3, 2, "BCD"), ("s", "A", 3, 3, "CDE")] + [("i", "A", 4, p + 1, "ABCDEFGHIJ"[p : p + 4]) for p in range(7)]
    cols = "index string, allele string, length int, position int, epitope string"
    got = {(r["index"], r.position): (r.wt_epitope, r.mutation_position) for r in predictions.match_wildtype(spark.createDataFrame(mt, cols + ", variant_type string, shift int"), spark.createDataFrame(wt, cols)).collect()}
    assert got == {("s", 2): ("BCD", "3"), ("s", 3): (None, None), ("i", 2): ("BCDE", "3, 4"), ("i", 3): ("EFGH", "1")}
    with pytest.raises(Exception, match="no wild-type"):
        predictions.match_wildtype(spark.createDataFrame([("q", "A", 3, 1, "ABC", "missense", 0)], cols + ", variant_type string, shift int"), spark.createDataFrame(wt, cols), strict=True).collect()


def test_predictors_see_each_peptide_once(spark):
    def length_score(f):
        assert not f.duplicated().any()
        return f.assign(score=f.epitope.str.len().astype(float), percentile=1.0)

    predictions.register("toy", length_score)
    df = spark.createDataFrame([("A", 3, "ABC")] * 5 + [("A", 4, "ABCD")], "allele string, length int, epitope string")
    assert sorted((r.epitope, r.score, r.method) for r in predictions.predict(df, ["toy"]).collect()) == [("ABC", 3.0, "toy"), ("ABCD", 4.0, "toy")]


def test_tiers_are_total_and_single(spark):
    rows = list(itertools.product([100.0, 900.0], [True, False], ["None", "2"], [0.1, 0.5], [1.0, 9.0, 0.0], ["True", "False"]))
    df = spark.createDataFrame(rows, "`IC50 MT` double, `Ref Match` boolean, `Prob Pos` string, `DNA VAF` double, `Allele Expr` double, `MANE Select` string")
    df = df.withColumns({"%ile MT": F.lit(0.1), "RNA Expr": F.col("Allele Expr"), "RNA VAF": F.lit(0.5), "RNA Depth": F.lit(5.0), "Canonical": F.lit("False"), "TSL": F.lit("5")})
    got = df.select("*", tiers.matched_tier(df, Thresholds(), 0.5, F.lit(True)).alias("t")).collect()
    assert all(r.t in candidates.TIER_ORDER["matched"] for r in got)
    clean = [r for r in got if r["IC50 MT"] < 500 and not r["Ref Match"] and r["Prob Pos"] == "None" and r["DNA VAF"] > 0.25 and r["MANE Select"] == "True"]
    assert {(r["Allele Expr"], r.t) for r in clean} == {(9.0, "Pass"), (1.0, "LowExpr"), (0.0, "NoExpr")}


def test_fusion_and_bind_tiers(spark):
    df = spark.createDataFrame([(100.0, 9.0, 1.0), (900.0, 9.0, 1.0), (100.0, 1.0, 1.0), (100.0, 9.0, 0.01), (100.0, 1.0, 0.01)], "`IC50 MT` double, `Read Support` double, Expr double").withColumn("%ile MT", F.lit(1.0))
    assert [r[0] for r in df.select(tiers.fusion_tier(df, Thresholds())).collect()] == ["Pass", "PoorBinder", "LowReadSupport", "LowExpr", "Poor"]
    assert [r[0] for r in df.select(tiers.bind_tier(df, Thresholds())).collect()] == ["Pass", "PoorBinder", "Pass", "Pass", "Pass"]


def test_reference_matches_and_islands(spark):
    q = spark.createDataFrame([("q1", "ABCDEFGHIJKL", "T1.2", None), ("q2", "ABCDEFGH", "T9", "ABCDEFGH")], "query string, sequence string, transcript string, wildtype string")
    p = spark.createDataFrame([("P1", "P1 transcript:T5 gene_symbol:G", "XXABCDEFGHIJXX"), ("P2", "P2 transcript:T1.7", "ABCDEFGHIJKL"), ("P3", "P3", "CDEFGHIJYYEFGHIJKL")], "id string, description string, sequence string")
    got = sorted((r.query, r.hit, r.match_start, r.match_stop) for r in reference.merged_windows(reference.reference_hits(q, p)).collect())
    assert got == [("q1", "P1", 1, 11), ("q1", "P3", 3, 11), ("q1", "P3", 5, 13)]
    grouped = {r.match_sequence: r.genes for r in reference.grouped_matches(reference.merged_windows(reference.reference_hits(q, p)), q).collect()}
    assert grouped["ABCDEFGHIJ"] == "G"


def test_anchors(spark):
    w = spark.createDataFrame([("A", 3, 1, 0.5), ("A", 3, 2, 0.3), ("A", 3, 3, 0.2)], "allele string, length int, pos int, weight double")
    assert aggregate.anchors_of(w, 0.8).first().anchors == [1, 2, 3] and aggregate.anchors_of(w, 0.7).first().anchors == [1, 2]
    assert aggregate.anchors_of(w, 0.4).first().anchors == [1] and aggregate.anchors_of(w, 0.5, stop_at=True).first().anchors == [1]


def test_interval_join_equals_brute_force(spark):
    rnd = random.Random(2)
    a = [(rnd.choice("xy"), rnd.randint(-50, 50), i) for i in range(60)]
    b = [(rnd.choice("xy"), rnd.randint(-50, 50), i) for i in range(60)]
    got = genomic.interval_join(spark.createDataFrame(a, "c string, p int, i int"), spark.createDataFrame(b, "c string, q int, j int"), ["c"], "p", "q", 7)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((x[2], y[2]) for x in a for y in b if x[0] == y[0] and abs(x[1] - y[1]) <= 7)


def test_splicing(spark):
    exons = spark.createDataFrame([("t", "+", 1, "ATGGC"), ("t", "+", 10, "CTAA"), ("u", "-", 1, "TTAGGC"), ("u", "-", 10, "CAT"), ("v", "+", 1, "GGG")], "k string, strand string, cds_start int, exon_sequence string")
    got = {r.k: (r.dna, r.protein, r.frameshift) for r in genomic.spliced_protein(exons, ["k"]).collect()}
    assert got == {"t": ("ATGGCCTAA", "MA", False), "u": ("ATGGCCTAA", "MA", False)}


def test_alternate_exons(spark):
    base = [(1, 10), (20, 30), (40, 50), (60, 70)]
    rows = [("skip", "NDA", s, e, 10, 40) for s, e in base] + [("donor", "D", s, e, 25, 40) for s, e in base] + [("none", "NDA", s, e, 11, 40) for s, e in base]
    df = spark.createDataFrame(rows, "k string, anchor string, cds_start int, cds_stop int, junction_start int, junction_stop int")
    got = {}
    for r in genomic.alternate_exons(df, ["k"]).collect():
        got.setdefault(r.k, []).append((r.cds_start, r.cds_stop))
    assert {k: sorted(v) for k, v in got.items()} == {"skip": [(1, 10), (40, 50), (60, 70)], "donor": [(1, 10), (20, 25), (40, 50), (60, 70)]}


def test_differences_are_symmetric(spark):
    a = spark.createDataFrame([("x", 1.0, "p"), ("y", 2.0, None), ("z", 3.0, "r")], "id string, n double, s string")
    b = spark.createDataFrame([("x", 1.05, "p"), ("y", 2.5, "q"), ("z", 3.0, "r")], "id string, n double, s string")
    key = lambda d: sorted((r.id, r["column"]) for r in d.collect())
    assert key(compare.differences(a, b, "id", ["n", "s"])) == key(compare.differences(b, a, "id", ["n", "s"])) == [("y", "n"), ("y", "s")]


def test_json_and_parameter_differences(spark):
    a, b = (spark.createDataFrame([(x,)], "j string") for x in ('{"k": [2, 1], "v": 1, "chr1-5": 3}', '{"k": [1, 2], "v": 2, "w": 3}'))
    assert sorted(r.key for r in compare.json_differences(a, b).collect()) == ["v", "w"]


def test_best_order_equals_all_permutations(spark):
    rnd = random.Random(4)
    for n in (2, 4, 6):
        nodes = [f"n{i}" for i in range(n)]
        weight = {(a, b): rnd.randint(1, 99) for a in nodes for b in nodes if a != b and rnd.random() < 0.8}
        best = max((sum(weight[e] for e in itertools.pairwise(p)) for p in itertools.permutations(nodes) if all(e in weight for e in itertools.pairwise(p))), default=None)
        got = vector.best_order(nodes, weight)
        assert (got is None) == (best is None) and (got is None or sum(weight[e] for e in itertools.pairwise(got)) == best)


def test_junctions_and_construct(spark):
    peptides = spark.createDataFrame([("a", "AAAA"), ("b", "BBBB")], "id string, sequence string")
    j = vector.junction_sequences(vector.ordered_pairs(peptides), ["None", "GG"], 1, 3)
    got = {(r.left, r.right, r.spacer, r.left_clip, r.right_clip): r.sequence for r in j.collect()}
    assert got["a", "b", "GG", 0, 0] == "AAAGGBBB" and got["a", "b", "None", 1, 0] == "AAABBB" and len(got) == 16


def test_clonal_vaf_and_union(spark):
    f = lambda *v: aggregate.clonal_vaf(spark.createDataFrame([(x,) for x in v], "`Tumor DNA VAF` double")).first()[0]
    assert (f(0.7, 0.3), f(0.55, 0.2), f(0.9), f(None)) == (0.3, 0.5, 0.6, 0.6)
    u = filters.union_filled(spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(3, 4)], "c int, a int"))
    assert u.columns == ["a", "b", "c"] and sorted(tuple(r) for r in u.collect()) == [(1, 2, None), (4, None, 3)]


def test_genes_of_interest_take_either_side_of_a_fusion(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B-C"), (3, "C"), (4, None), (5, "A-C"), (1, "A")], "id int, `Gene Name` string")
    genes = spark.createDataFrame([("A",), ("B",), ("A",)], "gene string")
    got = filters.mark_genes(df, genes)
    assert got.columns == ["id", "Gene Name", "Gene of Interest"]
    assert sorted((r["id"], r["Gene of Interest"]) for r in got.collect()) == [(1, True), (1, True), (2, True), (3, False), (4, False), (5, True)]


def test_species_by_the_only_prefix(spark):
    prefixes = spark.createDataFrame([("HLA-", "human"), ("H-2-", "mouse"), ("H2-", "mouse"), ("DLA", "dog")], "prefix string, species string")
    alleles = spark.createDataFrame([("HLA-A*02:01",), ("H-2-Kb",), ("DLA-88*01",)], "allele string")
    got = {r["allele"]: r["species"] for r in predictions.species_of_allele(alleles, prefixes).collect()}
    assert got == {"HLA-A*02:01": "human", "H-2-Kb": "mouse", "DLA-88*01": "dog"}
    with pytest.raises(Exception, match="no single species"):
        predictions.species_of_allele(spark.createDataFrame([("X-1",)], "allele string"), prefixes).collect()


def test_reference_hits_equal_all_kmers(spark):
    rnd = random.Random(11)
    word = lambda n: "".join(rnd.choice("ACDY") for _ in range(n))
    proteins = [(f"p{i}.1", f"p{i} transcript:T{i}.2", word(rnd.choice([3, 7, 8, 40, 300]))) for i in range(30)] + [("none", "", None), ("empty", "", ""), ("same", "", "A" * 60), ("wide", "", "\U0001f600é" * 20)]
    queries = [(f"q{i}", rnd.choice([word(20), proteins[i][2], "A" * 12, "\U0001f600é" * 6, None]), rnd.choice([None, f"T{i}.5", "p3"]), rnd.choice([None, word(12), proteins[i][2]])) for i in range(25)]
    q = spark.createDataFrame(queries, "query string, sequence string, transcript string, wildtype string")
    p = spark.createDataFrame(proteins, "id string, description string, sequence string")
    for k in (1, 3, 8, 13):
        want = {}
        for name, seq, transcript, wild in queries:
            for hit, description, there in proteins:
                own = transcript and transcript.split(".")[0] in (hit.split(".")[0], (description.split("transcript:") + [""])[1].split(".")[0])
                for i in range(len(seq or "") - k + 1):
                    at = (there or "").find(seq[i : i + k])
                    if at >= 0 and not own and not (wild and seq[i : i + k] in wild):
                        want[name, hit, i + 1] = at + 1
        got = {(r.query, r.hit, r.start): r.hit_start for r in reference.reference_hits(q, p, k).collect()}
        assert got == want
        reference.KNOWN, before = 0, reference.KNOWN
        try:
            assert {(r.query, r.hit, r.start): r.hit_start for r in reference.reference_hits(q, p, k).collect()} == want
        finally:
            reference.KNOWN = before


def test_unique_names_count_on_past_given_ones(spark):
    rnd = random.Random(3)
    values = ["x", "x", "x.1", "x.1", "x", "y", "x.1.1", "x.3", "x", "x", "y", "z.2", "z", "z", "z", ".1", "", "", None]
    values += [rnd.choice(["a", "a.1", "a.2", "a.1.1", "b", "b.10", "b.01"]) for _ in range(80)]
    seen, want = set(), []
    for v in values:
        name, n = v, 0
        while v is not None and name in seen:
            n += 1
            name = f"{v}.{n}"
        seen.add(name)
        want.append(name)
    df = spark.createDataFrame(list(enumerate(values)), "i int, name string")
    got = [r.name for r in candidates.uniquified(df, "name", ["i"]).orderBy("i").collect()]
    assert got == want


def test_ranks_by_ranges(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([None, 1.0, 1.0, 1.0, 2.5, float(rnd.randrange(50)), float("nan")]), f"n{i % 7}") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, `a score` double, name string").repartition(5)
    order = lambda r: (r[1] is None, r[1] is None or r[1] != r[1], r[1] or 0.0)
    keys = sorted({(order(r)[0], order(r)[1], -1.0 if r[1] is None or r[1] != r[1] else r[1]) for r in rows})
    dense = {r.id: r["rank"] for r in candidates.with_dense_rank(df, df["a score"], "rank", [df["id"].asc()]).collect()}
    assert dense == {r[0]: keys.index((order(r)[0], order(r)[1], -1.0 if r[1] is None or r[1] != r[1] else r[1])) + 1 for r in rows}
    place = {r.id: r["place"] for r in candidates.with_row_number(df, [df["name"].asc(), df["a score"].desc_nulls_last(), df["id"].asc()], "place").collect()}
    assert sorted(place.values()) == list(range(1, 401))
    by_name = sorted(rows, key=lambda r: (r[2], r[1] is None, not (r[1] is not None and r[1] != r[1]), -(r[1] or 0.0) if r[1] == r[1] else 0, r[0]))
    assert [place[r[0]] for r in by_name] == list(range(1, 401))
    plan = candidates.rank_sum_order(df.withColumn("Tier", F.lit("Pass")), "bind", "a score", None, ["id"], ties="first")._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(a score" not in plan
