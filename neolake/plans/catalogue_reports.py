"""Queries of the reports and the top-score filters, for every tool, and the same in SQL.

The stand-in epitope table is ``lineitem``: ``l_partkey`` variant, five
transcripts, twenty peptides, three alleles; SQL ``x`` and ``table`` below are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neolake.operators import aggregate, candidates
from neolake.plans import post
from neolake.plans.catalogue import query, read
from neolake.plans.standins import _TIE, TIE, T, X, table

_MODEL = "mane DESC, canonical DESC, tsl, len DESC, expr DESC"
_TR = "(mane OR canonical OR tsl <= 1) DESC"
BEST = {
    "matched": f"(flags = 'None') DESC, (biotype = 'protein_coding') DESC, {_TR}, (prob = 'None') DESC, anchor DESC, score NULLS LAST, {_MODEL}, {_TIE}",
    "splice": f"(biotype = 'protein_coding') DESC, {_TR}, (prob = 'None') DESC, score NULLS LAST, {_MODEL}, {_TIE}",
    "fusion": f"(prob = 'None') DESC, score NULLS LAST, expr DESC, {_TIE}",
    "bind": f"(prob = 'None') DESC, score NULLS LAST, {_TIE}",
}
INCLUDED = {
    "matched": f"(biotype = 'protein_coding') DESC, tsl, anchor DESC, (flags = 'None') DESC, (prob = 'None') DESC, score, len DESC, pct, {_TIE}",
    **dict.fromkeys(("splice", "fusion", "bind"), f"score, pct, {_TIE}"),
}
HOW = {"matched": {"anchor": "anchor", "allow_incomplete": True}, "splice": {}, "fusion": {}, "bind": {}}
_ALLELES = ["HLA-A", "HLA-B", "HLA-C"]


def _included(tool: str) -> str:
    return f"""{X}, m AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY v ORDER BY {BEST[tool]}) AS b, coalesce(score < 70000, false) AS low FROM x),
p AS (SELECT *, row_number() OVER (PARTITION BY v, ep ORDER BY {BEST[tool]}) AS f FROM m WHERE low), q AS MATERIALIZED (SELECT v, ep, row_number() OVER (PARTITION BY v ORDER BY {INCLUDED[tool]}) AS j FROM p WHERE f = 1),
i AS (SELECT m.*, score < 30000 AS good FROM m LEFT JOIN q ON m.v = q.v AND m.ep = q.ep WHERE b = 1 OR (low AND j <= 4))"""


@query(f"WITH {_included('matched')} SELECT v, ep, tr, al, l_orderkey, l_linenumber, l_extendedprice FROM i")
def included_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = aggregate.included(table(spark, sf_dir), ["v"], "MT Epitope Seq", "Median MT IC50 Score", T, TIE, **HOW["matched"])
    return rows.select("v", F.col("MT Epitope Seq").alias("ep"), F.col("Transcript").alias("tr"), F.col("HLA Allele").alias("al"), "l_orderkey", "l_linenumber", "l_extendedprice")


_COUNTS = ", ".join(f"nullif(count(DISTINCT ep) FILTER (good AND al = 'HLA-{a}'), 0) AS {a.lower()}" for a in "ABC") + ", count(DISTINCT ep) AS included, count(DISTINCT ep) FILTER (good) AS passing"
_FIRST = "v::VARCHAR AS id, any_value(ep) FILTER (b = 1) AS peptide, any_value(al) FILTER (b = 1) AS allele, any_value(prob) FILTER (b = 1) AS problem, any_value(score) FILTER (b = 1) AS score, any_value(pct) FILTER (b = 1) AS pct"
_OWN = {
    "matched": ", any_value(tr) FILTER (b = 1) AS transcript, count(DISTINCT (tr, ppos)) AS transcripts, any_value(CASE WHEN kind = 'FS' THEN 'FS' || ppos ELSE 'V' || ppos || 'E' END) FILTER (b = 1) AS change, any_value(round(gexpr * rvaf, 3)) FILTER (b = 1) AS allele_expr",
    "splice": ", any_value(tr) FILTER (b = 1) AS transcript, any_value(round(gexpr * rvaf, 3)) FILTER (b = 1) AS allele_expr", "fusion": ", any_value(expr) FILTER (b = 1) AS expr", "bind": "",
}


def _report_sql(tool: str) -> str:
    return f"WITH {_included(tool)} SELECT {_FIRST}, {_COUNTS}{_OWN[tool]} FROM i GROUP BY v"


def _report(spark: SparkSession, sf_dir: str, tool: str) -> DataFrame:
    side = "MT " if tool == "matched" else ""
    df = table(spark, sf_dir, tool)
    if tool == "splice":
        df = df.drop("Index")
    r = aggregate.aggregated_report(df, ["v"], _ALLELES, T, f"Median {side}IC50 Score", f"{side}Epitope Seq", "Transcript", TIE, tool=tool, **HOW[tool])
    names = {"ID": "id", "Best Peptide": "peptide", "Allele": "allele", "Prob Pos": "problem", "IC50 MT": "score", "%ile MT": "pct", "A": "a", "B": "b", "C": "c", "Num Included Peptides": "included", "Num Passing Peptides": "passing"}
    own = {
        "matched": {"Best Transcript": "transcript", "Num Passing Transcripts": "transcripts", "AA Change": "change", "Allele Expr": "allele_expr"}, "splice": {"Transcript": "transcript", "Allele Expr": "allele_expr"}, "fusion": {"Expr": "expr"}, "bind": {},
    }
    return r.select(*[F.col(f"`{k}`").alias(n) for k, n in (names | own[tool]).items()])


@query(_report_sql("matched"))
def aggregated_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "matched")


@query(_report_sql("splice"))
def aggregated_report_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "splice")


@query(_report_sql("fusion"))
def aggregated_report_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "fusion")


@query(_report_sql("bind"))
def aggregated_report_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir, "bind")


# --- top scores -----------------------------------------------------------------------

_ROW = ["v", "label", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


def _top_sql(tool: str) -> str:
    by = "v, sig" if tool in ("matched", "fusion") else "v"
    emitted = "SELECT w.v, t.pre || '.' || w.cons AS label, w.l_orderkey, w.l_linenumber, w.l_suppkey, w.l_extendedprice FROM w JOIN t ON w.v = t.v AND w.cons = t.cons"
    plain = "SELECT v, pre || '.' || cons AS label, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM w"
    return f"""WITH {X}, y AS (SELECT * FROM x WHERE score IS NOT NULL), s AS (SELECT v, tr, string_agg(ep, '|' ORDER BY ep) AS sig FROM y GROUP BY v, tr),
r AS (SELECT y.*, s.sig FROM y JOIN s ON y.v = s.v AND y.tr = s.tr), k AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {BEST[tool]}) AS k FROM r), w AS (SELECT * FROM k WHERE k = 1),
t AS (SELECT DISTINCT v, cons, pre FROM y) {emitted if tool in ("matched", "fusion") else plain}"""


def _top(spark: SparkSession, sf_dir: str, tool: str) -> DataFrame:
    side = "MT " if tool == "matched" else ""
    rows = candidates.top_score(table(spark, sf_dir, tool), ["v"], "Transcript", f"{side}Epitope Seq", T, f"Median {side}IC50 Score", TIE, "Index" if tool in ("matched", "fusion") else None, tool=tool, **HOW[tool])
    return rows.withColumnRenamed("Index", "label").select(*_ROW)


@query(_top_sql("matched"))
def top_score_same_epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "matched")


@query(_top_sql("fusion"))
def top_score_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "fusion")


@query(_top_sql("bind"))
def top_score_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "bind")


@query(_top_sql("splice"))
def top_score_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, "splice")


def _best(tool: str) -> str:
    return f"WITH {X}, k AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY {BEST[tool]}) AS k FROM x) SELECT v, pre || '.' || cons AS label, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM k WHERE k = 1"


def _best_rows(spark: SparkSession, sf_dir: str, tool: str) -> DataFrame:
    side = "MT " if tool == "matched" else ""
    return candidates.best_candidate(table(spark, sf_dir, tool), ["v"], T, f"Median {side}IC50 Score", TIE, tool=tool, **HOW[tool]).withColumnRenamed("Index", "label").select(*_ROW)


@query(_best("matched"))
def best_candidate_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_rows(spark, sf_dir, "matched")


@query(_best("fusion"))
def best_candidate_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_rows(spark, sf_dir, "fusion")


@query(_best("splice"))
def best_candidate_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_rows(spark, sf_dir, "splice")


# --- sets and metrics ---------------------------------------------------------------------


@query(f"""WITH {X}, o AS (SELECT *, row_number() OVER (ORDER BY {_TIE}) AS nth FROM x), e AS (SELECT v, tr, ep2, min(nth) AS nth FROM o GROUP BY v, tr, ep2), own AS (SELECT v, tr, array_to_string(list(ep2 ORDER BY nth), '|') AS peptides, min(nth) AS nth FROM e GROUP BY v, tr),
l AS (SELECT own.*, o.biotype, o.mane, o.canonical, o.tsl, o.len, o.expr, o.flags FROM own JOIN o ON own.nth = o.nth),
s AS (SELECT v, peptides, string_agg(tr, ',' ORDER BY (flags = 'None') DESC, (biotype = 'protein_coding') DESC, mane DESC, canonical DESC, tsl, len DESC, expr DESC, nth) AS transcripts, count(*)::INT AS transcript_count, sum(expr) AS total, min(nth) AS nth FROM l GROUP BY v, peptides)
SELECT v, 'Transcript Set ' || row_number() OVER (PARTITION BY v ORDER BY nth) AS "set", peptides, transcripts, transcript_count, round(total, 3) AS total_expr FROM s""")
def transcript_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = aggregate.transcript_sets(table(spark, sf_dir), ["v"], "Transcript", "ep2", TIE, allow_incomplete=True)
    return s.select("v", "set", F.array_join("peptides", "|").alias("peptides"), F.array_join(F.transform("transcripts", lambda x: x["name"]), ",").alias("transcripts"), "transcript_count", F.round("total_expr", 3).alias("total_expr"))


@query(f"""WITH {X}, o AS (SELECT *, row_number() OVER (PARTITION BY v, ep, al ORDER BY {_TIE.replace(", ", " DESC, ")} DESC) AS k FROM x)
SELECT v, ep, string_agg(al || '=' || (score IS NULL)::INT || '/' || round(pct, 2) || '/' || round(rvaf, 2), ';' ORDER BY al) AS calls FROM o WHERE k = 1 GROUP BY v, ep""")
def algorithm_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir).withColumns({"one MT IC50 Score": F.col("Median MT IC50 Score"), "two MT IC50 Score": F.col("Median MT Percentile"), "one WT IC50 Score": F.col("Tumor RNA VAF"), "two WT IC50 Score": F.lit(None).cast("double")})
    calls = aggregate.algorithm_calls(df, ["v"], "MT Epitope Seq", ["one", "two"], TIE)
    text = F.transform(F.map_entries("MT"), lambda e: F.concat(e["key"], F.lit("="), e["value"][0].isNull().cast("int").cast("string"), F.lit("/"), F.round(e["value"][1], 2).cast("string"), F.lit("/"), F.round(F.col("WT")[e["key"]][0], 2).cast("string")))
    return calls.select("v", F.col("MT Epitope Seq").alias("ep"), F.array_join(text, ";").alias("calls"))


@query(f"""WITH {X}, c AS (SELECT v, ep, min(score) AS s, bool_or(prob <> 'None') AS p FROM x GROUP BY v, ep) SELECT v, string_agg(ep, ',' ORDER BY p, s NULLS LAST, ep) AS peptides FROM c GROUP BY v""")
def ordered_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir)
    calls = aggregate.peptide_calls(df, ["v"], "MT Epitope Seq", "HLA Allele", _ALLELES, "Median MT IC50 Score", "Tumor RNA VAF")
    bad = df.groupBy("v", "MT Epitope Seq").agg(F.bool_or(F.col("Problematic Positions") != "None").alias("bad"))
    return aggregate.ordered_peptides(calls.join(bad, ["v", "MT Epitope Seq"]), ["v"], "MT Epitope Seq", problematic="bad").select("v", F.array_join("peptides.peptide", ",").alias("peptides"))


_CHAIN = f"""WITH {X}, y AS (SELECT * FROM x WHERE score <= 30000 AND (mane OR canonical OR tsl <= 1)), k AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY {BEST["splice"]}) AS k FROM y)
SELECT v, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM k WHERE k = 1"""


@query(_CHAIN)
def post_process_combined_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "splice").withColumnRenamed("v", "Junction")
    one, two = df.where("`HLA Allele` = 'HLA-A'"), df.where("`HLA Allele` <> 'HLA-A'")
    tool = post.Tool("splice", ("Junction",), "Epitope Seq", "Transcript", "Median IC50 Score", tuple(TIE), coverage=False, genes=False)
    done = post.combined(one, two, tool=tool, o=post.Options(T), alleles=_ALLELES)
    return done.filtered.select(F.col("Junction").alias("v"), *TIE[:4])


@query(f"""WITH {_included("bind")}, r AS (SELECT v::VARCHAR AS id, any_value(score) FILTER (b = 1) AS score, any_value(prob) FILTER (b = 1) AS prob FROM i GROUP BY v)
SELECT id, CASE WHEN score < 30000 AND prob = 'None' THEN 'Pass' WHEN NOT coalesce(score < 30000, false) AND prob = 'None' THEN 'PoorBinder' WHEN score < 30000 THEN 'ProbPos' ELSE 'Poor' END AS tier FROM r""")
def report_then_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "bind").drop("Index")
    r = aggregate.aggregated_report(df, ["v"], _ALLELES, T, "Median IC50 Score", "Epitope Seq", "Transcript", TIE, tool="bind")
    return post.tiered(r, post.BIND, T).select(F.col("ID").alias("id"), F.col("Tier").alias("tier"))
