"""Registered queries against their SQL on tables with what the smallest ones lack."""

from __future__ import annotations

import pytest

from neolake.plans import catalogue
from test_queries import rows


def same_as_sql(spark, folder, name, **tables):
    """The query's rows and its SQL's over tables made by SQL."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.execute(catalogue.ORACLES[name]).fetchdf()
    got = catalogue.QUERIES[name](spark, str(folder)).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert len(want) and rows(got[columns]) == rows(want[columns])


#: Times in parts of a second: two to a user whose seconds' distance depends on rounding, with halves.
EVENTS = "SELECT (2 * u + j)::BIGINT AS event_id, make_timestamp((1704067200000000 + u * 100000000 + j * ({0} * 1000000 + (u % 3 - 1) * 400000) + u % 5 * 250000)::BIGINT) AS ts, u::BIGINT AS user_id FROM range(60) a(u), range(2) b(j)"


def test_interval_pairs_of_rounded_seconds(spark, tmp_path):
    same_as_sql(spark, tmp_path, "interval_bin_join", events=EVENTS.format(60))


def test_proximal_variants_of_rounded_seconds(spark, tmp_path):
    same_as_sql(spark, tmp_path, "proximal_variants", events=EVENTS.format(600))


def test_paths_of_many_tables_are_those_of_one():
    import numpy as np
    from neolake.operators import constructs, vector

    r = np.random.default_rng(1)
    for n in range(1, 7):
        tables = r.integers(0, 4, (40, n, n)).astype(float)  # small weights: many equal paths
        tables[r.random(tables.shape) < 0.4] = -np.inf
        tables[:, range(n), range(n)] = -np.inf
        for table, got in zip(tables, constructs._paths(tables).tolist(), strict=True):
            edges = {(a, b): table[a, b] for a, b in np.argwhere(np.isfinite(table)).tolist()}
            assert vector.best_order(list(range(n)), edges) == (None if got[0] < 0 else got)


def test_picks_of_many_constructs_are_the_best_paths(monkeypatch):
    import numpy as np
    from neolake.operators import constructs, vector

    monkeypatch.setattr(constructs, "CELLS", 64)  # several tables for each size
    r = np.random.default_rng(2)
    kinds, sizes = 5, r.integers(1, 7, 200)
    edges = [[(p * kinds + k, float(r.integers(0, 4))) for p in range(n * n) if p // n != p % n for k in range(kinds) if r.random() < 0.2] for n in sizes.tolist()]
    for own in edges:
        r.shuffle(own)
    flat = [(int(code), w) for own in edges for code, w in own]
    found, picks = constructs._picked(sizes, np.array([len(own) for own in edges]), np.array([c for c, _ in flat]), np.array([w for _, w in flat]), kinds, 5, 0)
    at = 0
    for n, own, has in zip(sizes.tolist(), edges, found.tolist(), strict=True):
        best = {}
        for code, w in sorted((int(code), w) for code, w in own):
            pair = divmod(int(code) // kinds, n)
            if pair not in best or w > best[pair][0]:
                best[pair] = w, code
        order = vector.best_order(list(range(n)), {e: w for e, (w, _) in best.items()}, 5)
        assert (order is not None) == has
        if has:
            assert [own[i][0] for i in picks[at : at + n - 1].tolist()] == [best[e][1] for e in zip(order, order[1:])]
            at += n - 1
    assert at == len(picks) and 0 < found.sum() < len(found)


def test_rounds_of_constructs_unfold_numbers(spark):
    from neolake.operators import constructs, vector
    from neolake.plans.catalogue_runs import _junction_scores

    seen = []
    peptides = spark.createDataFrame([("c", "a", "ACDEFG"), ("c", "b", "GFED"), ("d", "a", "A")], "construct string, id string, sequence string")
    # all junctions hold a binder, so that every round comes
    done = constructs.design(peptides, lambda rows: seen.append(rows) or _junction_scores(rows), ["None", "GG"], 3, 5, 1000.0, clips=1)
    assert {r.construct: (r.order, r.sequence) for r in done.collect()} == {"c": (None, None), "d": (["a"], "A")}
    assert len(seen) == 4
    for rows in seen:
        # an epitope comes with its construct and a number; texts are cut by generated code, not by lambdas
        assert sorted(t for _, t in rows.dtypes) == ["bigint", "string", "string"]
        assert not any("substr" in x for x in _plan(rows).split("\n") if "lambda" in x)
    pairs = spark.createDataFrame([("a", "b", "ACDEFG", "GFED"), ("b", "a", "GFED", "ACDEFG")], "left string, right string, left_seq string, right_seq string")
    want = vector.junction_epitopes(vector.junction_sequences(pairs, ["GG"], 1, 3).where("greatest(left_clip, right_clip) = 1"), 5)
    assert sorted(r.epitope for r in want.collect()) == sorted(r.epitope for r in seen[3].collect())
    assert want.select("left", "right", "left_clip", "right_clip").distinct().count() == seen[3].select("code").distinct().count()


def test_best_paths_of_ids(spark):
    from neolake.operators import constructs

    ids = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "c"), ("y", "q"), ("z", "a"), ("z", "b")], "construct string, id string")
    edges = spark.createDataFrame([("x", "c", "a", 1.0), ("x", "a", "b", 2.0), ("x", "b", "c", 0.5), ("z", "a", "no", 1.0)], "construct string, left string, right string, weight double")
    assert {r.construct: r.order for r in constructs.best_paths(ids, edges).collect()} == {"x": ["c", "a", "b"], "y": ["q"]}


def test_proteins_are_dealt_over_all_cores(spark, tmp_path):
    from neolake.plans.standins import proteins

    spark.range(5000).selectExpr("id as p_partkey", "1 as p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    assert proteins(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_tables_are_not_broadcast(spark):
    assert "Broadcast" not in _plan(catalogue.QUERIES["match_wildtype"](spark, "/root/testdata/sf0.001"))


def test_novel_kmers_of_junctions_need_no_join(spark):
    from neolake.plans import other_runs

    rows = [("a", "ALT", "MACDAC"), ("a", "WT", "MAC"), ("b", "ALT", "MXX"), ("b", "WT", "M")]
    out = other_runs.splice_kmers(spark.createDataFrame(rows, "index string, side string, protein string"), [2])
    assert "Join" not in _plan(out)
    assert sorted(map(tuple, out.collect())) == [("a", "CD", 2, 3), ("a", "DA", 2, 4)]


def test_ids_unfold_after_the_join(spark):
    from neolake.operators import predictions

    scores = spark.createDataFrame([(1, 0.5), (2, 0.7), (1, 0.9)], "seq_num long, score double")
    out = predictions.joined_to_ids(scores, spark.createDataFrame([(1, [7, 8]), (2, [9])], "number long, ids array<long>"))
    plan = _plan(out)
    assert plan.index("Generate") < plan.index("Join")  # above it
    assert sorted(map(tuple, out.select("seq_num", "score", "index").collect())) == [(1, 0.5, 7), (1, 0.5, 8), (1, 0.9, 7), (1, 0.9, 8), (2, 0.7, 9)]


@pytest.mark.parametrize("held", [8_000_000, 1])
def test_predictions_stay_dealt_when_they_meet_ids(spark, monkeypatch, held):
    from neolake.operators import predictions

    monkeypatch.setattr(predictions, "HELD", held)
    # one name has all predictions, which are few enough to be broadcast
    scores = spark.range(4000).selectExpr("least(id, 0L) + 1 as seq_num", "id", "id / 2 as score")
    out = predictions.joined_to_ids(scores, spark.createDataFrame([(1, list(range(300))), (2, [9])], "number long, ids array<long>"))
    tasks = out.rdd.glom().map(len).collect()
    assert sum(tasks) == 1_200_000 and max(tasks) <= 900_000
    assert out.distinct().count() == 1_200_000 and sorted(out.columns) == ["id", "index", "score", "seq_num"]


def test_documents_are_dealt_once(spark):
    from neolake.operators import documents

    make = lambda *x: spark.createDataFrame(list(enumerate(x)), "doc int, json string")
    a = make('{"l[]": [1, 2, 2], "m": {"z": [[1, {"b": 1, "a": [2, 1]}]]}, "v": 1}', "[3, 3]", '{"v": "x"}')
    b = make('{"m": {"z": [[{"a": [1, 2], "b": 1}, 1]]}, "l[]": [2, 1]}', "[3]", '{"v": "x"}')
    out = documents.document_differences(a, b)
    # rows unfold where their document lies: no step is joined or dealt again
    assert _plan(out).count("Exchange hashpartitioning") == 1 and "Join" not in _plan(out)
    assert sorted(map(tuple, out.collect()), key=repr) == [(0, "/l[][]", "2", "2", 2, 1), (0, "/v", "1", None, 1, 0), (1, "[]", "3", "3", 2, 1)]
    nobody = spark.createDataFrame([(None, "1")], "doc int, json string")
    assert sorted(map(tuple, documents.document_differences(nobody, nobody).collect()), key=repr) == [(None, "", "1", None, 1, 0), (None, "", None, "1", 0, 1)]


def test_metrics_deal_rows_once(spark):
    from neolake.operators import metrics

    # the rows of the variants, and their best ones, which the join may deal again: no group of the objects is
    assert _plan(catalogue.QUERIES["metrics_objects"](spark, "/root/testdata/sf0.001")).count("Exchange hashpartitioning") <= 3
    import pyspark.sql.functions as F

    numbers = spark.createDataFrame([(x,) for x in (None, 0.0, -0.0, 60.0, -0.5, 0.001, 1e-5, 1 / 3, 9999999.5, 1e7, 1e22)], "x double")
    assert numbers.where(F.to_json(metrics._double(F.col("x"))) != F.to_json(metrics._quoted(F.col("x")))).count() == 0


def test_fusions_are_dealt_once_with_their_support(spark, monkeypatch):
    from neolake.operators import candidates
    from neolake.plans import other_runs

    seen = []
    monkeypatch.setattr(candidates, "stored", lambda df, label: seen.append(df) or df.cache())
    row = lambda left, pos, gene, peptide="MK|TA*": (left, pos, "chr2", 7, gene, "T-T", "inframe_fusion", peptide, 3)
    fusions = spark.createDataFrame([row("chr1", 5, "A-B"), row("1", 5, "A-C"), row(None, 5, "A-D"), row("10", 9, "A-E")], "left_chrom string, left_pos long, right_chrom string, right_pos long, gene_name string, transcript_name string, variant_type string, peptide string, read_support int")
    star = spark.createDataFrame([("1", 5, "2", 7, 4, 0.5), ("chr1", 5, "chr2", 7, 4, 0.7), ("1", 5, "2", 7, None, 9.0), (None, 5, "2", 7, 9, 0.9), ("3", 1, "2", 7, 9, 0.9)], "left_chrom string, left_pos int, right_chrom string, right_pos int, read_support int, expression double")
    out = other_runs.called_fusions(fusions, star)
    plan = _plan(seen[0])
    assert plan.count("Exchange") == 1 and "Join" not in plan and "peptide" not in seen[0].columns
    assert [(r["index"][:5], r.chromosome_name, r.expression) for r in out.orderBy("index").collect()] == [("1.A-B", "1 / 2", 0.7), ("2.A-C", "1 / 2", 0.7), ("3.A-E", "10 / 2", None), ("4.A-D", "NA / 2", None)]


def test_calls_are_made_once(spark):
    for name in ("phased_neighbours", "haplotype_windows"):
        assert "md5(" not in _plan(catalogue.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_windows_compare_once_from_either_end(spark):
    from neolake.functions import sequences as S
    from pyspark.sql import functions as F

    rows = [("MKLVTTPQR", "MKLVAAPQR"), ("MK", "MK"), ("MKAAQ", "MKAQ"), ("", "MK"), (None, "MK"), ("MK", None)]
    df = spark.createDataFrame(rows, "m string, w string").select("m", "w", S.changed_window(F.col("m"), F.col("w"), 1).alias("a"), S.changed_window(F.col("m"), F.col("w"), 1, shown=F.lower("m")).alias("b"))
    assert _plan(df.select("a")).count("array_position") == 2
    assert [r.a for r in df.collect()][:4] == ["VTTP", "K", "AAQ", ""] and all(r.b == (None if r.a is None else r.a.lower()) for r in df.collect() if r.m is not None)
