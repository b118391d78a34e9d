"""Registered queries of the operators over the driver's tables, and the same in SQL.

The tables are structural stand-ins. ``lineitem`` plays the epitope table:
``l_orderkey`` variant, ``l_partkey`` transcript, ``l_suppkey`` allele,
``l_extendedprice`` score, ``l_discount`` percentile or fraction, ``l_quantity``
depth, ``l_returnflag`` biotype; ``part`` and ``documents`` play sequences,
``documents`` also the reference proteome, ``events.props`` nested metrics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neolake.functions import filters as P
from neolake.functions import sequences as S
from neolake.operators import aggregate, candidates, compare, filters, genomic, predictions, reference, tiers, vector
from neolake.plans.standins import read, seconds
from neolake.schemas import Thresholds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
TIE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]

#: The stand-in epitope table in SQL, under the names that the operators know.
EPITOPES = """
e AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate,
  nullif(l_extendedprice, 0) AS score, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS pct, CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS depth,
  l_tax AS vaf, CASE WHEN l_returnflag = 'N' THEN 'protein_coding' ELSE 'other' END AS biotype, l_linestatus = 'O' AS mane, l_returnflag = 'R' AS canonical, l_suppkey % 5 + 1 AS tsl,
  CASE WHEN l_partkey % 3 = 0 THEN '2, 5' ELSE 'None' END AS prob, l_partkey % 11 AS len, l_quantity / 10 AS expr FROM lineitem)"""


def epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    df = read(spark, sf_dir, "lineitem", *KEY, "l_shipdate", "l_discount", "l_quantity", "l_tax", "l_returnflag", "l_linestatus")
    return df.select(
        *KEY, "l_shipdate", F.nullif("l_extendedprice", F.lit(0.0)).alias("Median MT IC50 Score"), F.when(c("l_linenumber") != 7, c("l_discount")).alias("Median MT Percentile"), F.when(c("l_linenumber") != 6, c("l_quantity")).alias("Tumor DNA Depth"),
        c("l_tax").alias("Tumor DNA VAF"), F.when(c("l_returnflag") == "N", "protein_coding").otherwise("other").alias("Biotype"), (c("l_linestatus") == "O").alias("MANE Select"), (c("l_returnflag") == "R").alias("Canonical"),
        (c("l_suppkey") % 5 + 1).alias("Transcript Support Level"), F.when(c("l_partkey") % 3 == 0, "2, 5").otherwise("None").alias("Problematic Positions"), (c("l_partkey") % 11).alias("Transcript Length"), (c("l_quantity") / 10).alias("Transcript Expression"),
    )


# --- filters -------------------------------------------------------------------------

_AND = [P.Criterion("Median MT IC50 Score", "<=", 40000.0), P.Criterion("Median MT Percentile", "<=", 0.05, True), P.Criterion("Tumor DNA Depth", ">=", 10)]


@query(f"WITH {EPITOPES} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM e WHERE coalesce(score <= 40000, true) AND coalesce(pct <= 0.05, false) AND coalesce(depth >= 10, true)")
def criteria_filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epitopes(spark, sf_dir).where(P.all_of(_AND)).select(*KEY)


@query(f"WITH {EPITOPES} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM e WHERE coalesce(score <= 40000, true) OR coalesce(pct <= 0.05, false) OR coalesce(depth >= 10, true)")
def criteria_filter_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epitopes(spark, sf_dir).where(P.any_of(_AND)).select(*KEY)


@query(f"WITH {EPITOPES} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM e WHERE coalesce(score <= 30000, true) AND coalesce(pct <= 0.04, true)")
def binding_filter_conservative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.binding_filter(epitopes(spark, sf_dir), Thresholds(binding=30000.0, percentile=0.04)).select(*KEY)


@query(f"WITH {EPITOPES} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM e WHERE coalesce(score <= 30000, true) OR coalesce(pct <= 0.04, true)")
def binding_filter_exploratory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.binding_filter(epitopes(spark, sf_dir), Thresholds(binding=30000.0, percentile=0.04, strategy="exploratory")).select(*KEY)


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem LEFT JOIN (SELECT s_suppkey, 20000 + s_nationkey * 1000 AS cutoff FROM supplier WHERE s_nationkey < 12) ON l_suppkey = s_suppkey
WHERE l_extendedprice <= coalesce(cutoff, 30000)""")
def allele_specific_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    cutoffs = read(spark, sf_dir, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("allele"), (20000 + F.col("s_nationkey") * 1000).cast("double").alias("cutoff"))
    rows = epitopes(spark, sf_dir).withColumn("HLA Allele", F.col("l_suppkey"))
    return filters.allele_specific_filter(rows, cutoffs, Thresholds(binding=30000.0)).select(*KEY)


@query(f"WITH {EPITOPES} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM e WHERE coalesce(depth >= 10, true) AND coalesce(vaf >= 0.04, true) AND coalesce(expr >= 1, true)")
def coverage_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.coverage_filter(epitopes(spark, sf_dir), Thresholds(tdna_vaf=0.04)).select(*KEY)


@query(f"WITH {EPITOPES} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM e WHERE mane OR canonical OR tsl <= 1")
def preferred_transcript(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.transcript_filter(epitopes(spark, sf_dir), Thresholds()).select(*KEY)


@query("""SELECT p_partkey, coalesce(nullif(array_to_string(list_filter(range(1, length(p_name) + 1), lambda i: substr(p_name, i, 1) = 'e'), ', '), ''), 'None') AS positions FROM part""")
def problematic_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part", "p_partkey", "p_name").select("p_partkey", P.problematic_positions(F.col("p_name"), ["e"]).alias("positions"))


@query("SELECT p_partkey, p_brand IN ('Brand#12', 'Brand#23', 'Brand#34') AS of_interest FROM part")
def genes_of_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    genes = spark.createDataFrame([("Brand#12",), ("Brand#23",), ("Brand#34",)], "gene string")
    marked = filters.mark_genes(read(spark, sf_dir, "part", "p_partkey", "p_brand"), genes, "p_brand")
    return marked.select("p_partkey", F.col("Gene of Interest").alias("of_interest"))


@query("SELECT count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag IN ('R'))")
def semi_join_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = filters.evaluation_filter(read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "Evaluation"), ["R"])
    return read(spark, sf_dir, "orders").join(accepted, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").agg(F.count("*").alias("n"))


# --- predictions and summaries ----------------------------------------------------------

_LONG = """long AS (
  SELECT p_partkey, 'size' AS method, p_size::DOUBLE AS score, p_retailprice AS wt FROM part WHERE p_size % 7 <> 0
  UNION ALL SELECT p_partkey, 'price', floor(p_retailprice / 40)::DOUBLE, p_size::DOUBLE FROM part
  UNION ALL SELECT p_partkey, 'key', (p_partkey % 50)::DOUBLE, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 7.0 END FROM part)"""


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    row = lambda m, s, w: p.select("p_partkey", F.lit(m).alias("method"), s.cast("double").alias("score"), w.cast("double").alias("wt_score"))
    size, price, key = F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey")
    out = row("size", size, price).where("score % 7 <> 0").union(row("price", F.floor(price / 40), size)).union(row("key", key % 50, F.when(key % 4 != 0, 7.0)))
    return out.withColumns({"percentile": F.col("score") / 4, "wt_percentile": F.col("wt_score") / 4})


@query(f"""WITH {_LONG}, b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score, method) AS k FROM long),
m AS (SELECT p_partkey, median(score) AS median_score FROM long GROUP BY p_partkey)
SELECT b.p_partkey, b.score AS best_score, b.method AS best_score_method, b.wt AS corresponding_wt_score, m.median_score FROM b JOIN m ON b.p_partkey = m.p_partkey WHERE k = 1""")
def best_method_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions.summarise(_long(spark, sf_dir), ["p_partkey"]).select("p_partkey", "best_score", "best_score_method", "corresponding_wt_score", "median_score")


@query(f"""WITH {_LONG}, b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score, method) AS k FROM long)
SELECT p_partkey, round(CASE WHEN wt IS NULL THEN NULL WHEN score = 0 THEN -1 ELSE wt / score END, 6) AS fold_change FROM b WHERE k = 1""")
def fold_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("corresponding_fold_change")
    return predictions.summarise(_long(spark, sf_dir), ["p_partkey"]).select("p_partkey", F.round(F.when(x == float("inf"), -1.0).otherwise(x), 6).alias("fold_change"))


@query(f"""WITH {_LONG} SELECT p_partkey, max(score) FILTER (method = 'size') AS size_score, max(score) FILTER (method = 'price') AS price_score, max(score) FILTER (method = 'key') AS key_score FROM long GROUP BY p_partkey""")
def methods_pivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    methods = ["size", "price", "key"]
    wide = predictions.widened(_long(spark, sf_dir), ["p_partkey"], methods)
    return wide.select("p_partkey", *[F.col(f"`{m} MT IC50 Score`").alias(f"{m}_score") for m in methods])


@query("""WITH s AS (SELECT l_orderkey, l_partkey, max(l_tax) AS score FROM lineitem GROUP BY ALL)
SELECT l_orderkey, first(l_partkey ORDER BY score DESC, l_partkey) AS best_position, max(score) AS best_score, string_agg(l_partkey::VARCHAR || ':' || score::VARCHAR, ',' ORDER BY l_partkey) AS sites FROM s GROUP BY l_orderkey""")
def best_cleavage(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_partkey").alias("position")).agg(F.max("l_tax").alias("score"))
    return predictions.best_cleavage(sites, ["l_orderkey"]).toDF("l_orderkey", "best_position", "best_score", "sites")


# --- candidates -------------------------------------------------------------------------


@query("""WITH b AS (SELECT * FROM lineitem WHERE l_extendedprice <= 40000),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn FROM b)
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM r WHERE rn = 1""")
def best_binder_per_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filters.binding_filter(epitopes(spark, sf_dir).drop("Problematic Positions"), Thresholds(binding=40000.0))
    best = candidates.best_candidate(rows, ["l_orderkey"], Thresholds(), "Median MT IC50 Score", TIE, tool="bind")
    return best.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


_CASCADE = """(biotype = 'protein_coding') DESC, (mane OR canonical OR tsl <= 1) DESC, (prob = 'None') DESC, score NULLS LAST, mane DESC, canonical DESC, tsl, len DESC, expr DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate"""


@query(f"""WITH {EPITOPES}, r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_CASCADE}) AS k FROM e)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM r WHERE k = 1""")
def best_candidate_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.best_candidate(epitopes(spark, sf_dir), ["l_orderkey"], Thresholds(), "Median MT IC50 Score", TIE).select(*KEY)


@query("""SELECT l_orderkey, nullif(count(DISTINCT l_partkey) FILTER (l_extendedprice < 30000 AND l_returnflag = 'A'), 0) AS A, nullif(count(DISTINCT l_partkey) FILTER (l_extendedprice < 30000 AND l_returnflag = 'N'), 0) AS N,
nullif(count(DISTINCT l_partkey) FILTER (l_extendedprice < 30000 AND l_returnflag = 'R'), 0) AS R FROM lineitem GROUP BY l_orderkey""")
def allele_pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_extendedprice", "l_returnflag")
    good = aggregate.good_binder("l_extendedprice", Thresholds(binding=30000.0))
    return aggregate.per_allele_counts(rows.withColumn("a", F.concat(F.lit("HLA-"), "l_returnflag")), ["l_orderkey"], ["HLA-A", "HLA-N", "HLA-R"], "l_partkey", good, "a")


@query("SELECT CASE WHEN max(l_discount * 10) FILTER (l_discount * 10 < 0.6) IS NULL THEN 0.6 ELSE least(max(l_discount * 10) FILTER (l_discount * 10 < 0.6), 0.5) END::DOUBLE AS vaf_clonal FROM lineitem")
def clonal_vaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.clonal_vaf(read(spark, sf_dir, "lineitem").withColumn("v", F.col("l_discount") * 10), "v")


# --- tiers --------------------------------------------------------------------------------

_REPORT = """r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_extendedprice AS ic50, l_discount AS pct, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax * 100 END AS ae,
  (l_quantity % 4)::DOUBLE AS rna, l_tax * 10 AS rvaf, l_quantity AS rdepth, l_discount * 4 AS dvaf, l_partkey % 9 = 0 AS refm, l_partkey % 7 <> 0 AS okp, l_linestatus = 'O' OR l_suppkey % 5 = 0 AS tr, l_suppkey % 4 <> 0 AS anchor, l_quantity AS reads, l_tax * 4 AS fexpr FROM lineitem)"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return read(spark, sf_dir, "lineitem").select(
        *KEY, c("l_extendedprice").alias("IC50 MT"), c("l_discount").alias("%ile MT"), F.when(c("l_linenumber") != 3, c("l_tax") * 100).alias("Allele Expr"), (c("l_quantity") % 4).alias("RNA Expr"), (c("l_tax") * 10).alias("RNA VAF"),
        c("l_quantity").alias("RNA Depth"), (c("l_discount") * 4).alias("DNA VAF"), (c("l_partkey") % 9 == 0).alias("Ref Match"), F.when(c("l_partkey") % 7 != 0, "None").otherwise("3").alias("Prob Pos"), (c("l_linestatus") == "O").alias("MANE Select"),
        F.lit(False).alias("Canonical"), F.when(c("l_suppkey") % 5 == 0, 1).otherwise(4).alias("TSL"), (c("l_suppkey") % 4 != 0).alias("anchor"), c("l_quantity").alias("Read Support"), (c("l_tax") * 4).alias("Expr"),
    )


_T = Thresholds(binding=60000.0, percentile=0.08, read_support=5)
_MATCHED = """p AS (SELECT *, ic50 < 60000 AND pct < 0.08 AS b, coalesce(ae > 2.5, true) AS x, dvaf >= 0.1 AS cl, ae IS NOT NULL AND (ae > 0 OR (rna = 0 AND rdepth > 10 AND rvaf > 0.25)) AS low FROM r)"""


@query(f"""WITH {_REPORT}, {_MATCHED} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CASE
 WHEN b AND x AND cl AND tr AND anchor AND NOT refm AND okp THEN 'Pass' WHEN NOT b AND x AND cl AND tr AND anchor AND NOT refm AND okp THEN 'PoorBinder' WHEN b AND x AND cl AND tr AND anchor AND refm AND okp THEN 'RefMatch'
 WHEN b AND x AND cl AND tr AND anchor AND NOT refm AND NOT okp THEN 'ProbPos' WHEN b AND x AND cl AND NOT tr AND NOT refm AND okp THEN 'PoorTranscript' WHEN b AND x AND cl AND tr AND NOT anchor AND NOT refm AND okp THEN 'Anchor'
 WHEN b AND x AND NOT cl AND tr AND anchor AND NOT refm AND okp THEN 'Subclonal' WHEN b AND low AND cl AND tr AND anchor AND NOT refm AND okp THEN 'LowExpr' WHEN (rna = 0 OR rvaf = 0) AND NOT low THEN 'NoExpr' ELSE 'Poor' END AS tier FROM p""")
def tier_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _report(spark, sf_dir)
    return r.select(*KEY, tiers.matched_tier(r, _T, 0.2, F.col("anchor")).alias("tier"))


@query(f"""WITH {_REPORT}, {_MATCHED} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CASE
 WHEN b AND x AND cl AND tr AND NOT refm AND okp THEN 'Pass' WHEN NOT b AND x AND cl AND tr AND NOT refm AND okp THEN 'PoorBinder' WHEN b AND x AND cl AND tr AND refm AND okp THEN 'RefMatch'
 WHEN b AND x AND cl AND tr AND NOT refm AND NOT okp THEN 'ProbPos' WHEN b AND x AND cl AND NOT tr AND NOT refm AND okp THEN 'PoorTranscript'
 WHEN b AND x AND NOT cl AND tr AND NOT refm AND okp THEN 'Subclonal' WHEN b AND low AND cl AND tr AND NOT refm AND okp THEN 'LowExpr' WHEN (rna = 0 OR rvaf = 0) AND NOT low THEN 'NoExpr' ELSE 'Poor' END AS tier FROM p""")
def tier_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _report(spark, sf_dir)
    return r.select(*KEY, tiers.matched_tier(r, _T, 0.2).alias("tier"))


@query(f"""WITH {_REPORT}, p AS (SELECT *, ic50 < 60000 AND pct < 0.08 AS b, reads < 5 AS lr, fexpr < 0.1 AS le FROM r) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CASE
 WHEN b AND NOT lr AND NOT le AND NOT refm AND okp THEN 'Pass' WHEN NOT b AND NOT lr AND NOT le AND NOT refm AND okp THEN 'PoorBinder' WHEN b AND NOT lr AND NOT le AND refm AND okp THEN 'RefMatch' WHEN b AND NOT lr AND NOT le AND NOT refm AND NOT okp THEN 'ProbPos'
 WHEN b AND lr AND NOT le AND NOT refm AND okp THEN 'LowReadSupport' WHEN b AND NOT lr AND le AND NOT refm AND okp THEN 'LowExpr' ELSE 'Poor' END AS tier FROM p""")
def tier_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _report(spark, sf_dir)
    return r.select(*KEY, tiers.fusion_tier(r, _T).alias("tier"))


@query(f"""WITH {_REPORT}, p AS (SELECT *, ic50 < 60000 AND pct < 0.08 AS b FROM r) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, CASE
 WHEN b AND NOT refm AND okp THEN 'Pass' WHEN NOT b AND NOT refm AND okp THEN 'PoorBinder' WHEN b AND refm AND okp THEN 'RefMatch' WHEN b AND NOT refm AND NOT okp THEN 'ProbPos' ELSE 'Poor' END AS tier FROM p""")
def tier_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _report(spark, sf_dir)
    return r.select(*KEY, tiers.bind_tier(r, _T).alias("tier"))


@query("""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Pass' WHEN o_orderstatus = 'O' THEN 'RefMatch' ELSE 'Poor' END AS tier, o_totalprice, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey % 100 END AS x FROM orders)
SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_totalprice NULLS LAST) + dense_rank() OVER (ORDER BY x DESC NULLS LAST))::BIGINT AS rank FROM r""")
def dense_rank_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    r = o.withColumns({"Tier": F.when(F.col("o_orderstatus") == "F", "Pass").when(F.col("o_orderstatus") == "O", "RefMatch").otherwise("Poor"), "x": F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey") % 100)})
    return candidates.rank_sum_order(r, "matched", "o_totalprice", "x", ["o_orderkey"]).select("o_orderkey", F.col("rank").cast("long").alias("rank"))


# --- aggregation and metrics -----------------------------------------------------------------


@query("""WITH w AS (SELECT l_suppkey, l_partkey % 12 + 1 AS pos, sum(l_quantity) AS w FROM lineitem GROUP BY ALL),
s AS (SELECT *, w / sum(w) OVER (PARTITION BY l_suppkey) AS share FROM w), q AS (SELECT *, coalesce(sum(round(share, 6)) OVER (PARTITION BY l_suppkey ORDER BY round(share, 6) DESC, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
SELECT l_suppkey, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS anchors FROM q WHERE before <= 0.4000001 GROUP BY l_suppkey""")
def anchor_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = read(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("allele"), (F.col("l_partkey") % 12 + 1).alias("pos")).agg(F.sum("l_quantity").alias("w"))
    w = w.withColumn("weight", F.round(F.col("w") / F.sum("w").over(Window.partitionBy("allele")), 6)).withColumn("length", F.lit(12))
    out = aggregate.anchors_of(w.select("allele", "length", "pos", "weight"), 0.4000001)
    return out.select(F.col("allele").alias("l_suppkey"), F.array_join(F.col("anchors").cast("array<string>"), ",").alias("anchors"))


@query("""SELECT user_id, '{"event_id":' || event_id || ',"event_type":' || coalesce('"' || nullif(event_type, 'error') || '"', 'null') || ',"k":' || (props->>'$.k') || '}' AS json FROM events""")
def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events", "user_id", "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), F.from_json("props", "k int")["k"].alias("k"))
    return aggregate.metrics_json(e, "user_id")


@query("""WITH m AS (SELECT l_orderkey, l_suppkey, l_returnflag AS a, min(l_extendedprice) AS s FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_suppkey, max(s) FILTER (a = 'A') AS a, max(s) FILTER (a = 'N') AS n, max(s) FILTER (a = 'R') AS r, min(s) AS best FROM m GROUP BY ALL""")
def peptide_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = aggregate.peptide_calls(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_suppkey", "l_returnflag", ["A", "N", "R"], "l_extendedprice", "l_tax")
    return c.select("l_orderkey", "l_suppkey", *[F.col("ic50s_MT")[i].alias(x) for i, x in enumerate("anr")], F.col("best_ic50_MT").alias("best"))


@query("""SELECT l_orderkey, bool_or(l_extendedprice < 5000) AS bad, min(l_extendedprice) AS weight FROM lineitem GROUP BY l_orderkey HAVING NOT bool_or(l_extendedprice < 5000)""")
def junction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("score"), F.col("l_discount").alias("percentile"))
    return vector.junction_scores(rows, ["l_orderkey"], 5000.0).select("l_orderkey", F.lit(False).alias("bad"), "weight")


# --- sequences ---------------------------------------------------------------------------------


@query("SELECT k.kmer, count(*) AS n FROM (SELECT unnest(list_transform(range(1, greatest(length(p_name) - 8, 0) + 1), lambda i: {'kmer': substr(p_name, i, 9)})) AS k FROM part) GROUP BY k.kmer")
def kmer_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part", "p_name").select(F.explode(S.kmers(F.col("p_name"), 9)).alias("k")).groupBy("k.kmer").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT p_partkey % 20 AS g, unnest(list_transform(range(1, greatest(length(p_name) - 8, 0) + 1), lambda i: {'kmer': substr(p_name, i, 9), 'pos': i})) AS k FROM part),
b AS (SELECT p_partkey % 20 AS g, unnest(list_transform(range(1, greatest(length(p_type) - 8, 0) + 1), lambda i: {'kmer': substr(p_type, i, 9)})) AS k FROM part)
SELECT a.g, a.k.kmer AS kmer, max(a.k.pos)::INT AS position FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.g = a.g AND b.k.kmer = a.k.kmer) GROUP BY ALL""")
def kmer_novel_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_type").withColumn("g", F.col("p_partkey") % 20)
    return genomic.novel_kmers(p.select("g", F.col("p_name").alias("protein")), p.select("g", F.col("p_type").alias("protein")), "g", 9)


@query("""WITH k AS (SELECT item_id, unnest(list_transform(range(1, greatest(length(text) - 39, 0) + 1), lambda i: {'pos': i, 'kmer': substr(text, i, 40)})) AS k FROM benchmark),
kd AS (SELECT doc_id AS hit, unnest(list_transform(range(1, greatest(length(text) - 39, 0) + 1), lambda i: {'kmer': substr(text, i, 40)})) AS k FROM documents),
h AS (SELECT DISTINCT k.item_id, kd.hit, k.k.pos AS pos FROM k JOIN kd ON k.k.kmer = kd.k.kmer), i AS (SELECT *, pos - row_number() OVER (PARTITION BY item_id, hit ORDER BY pos) AS island FROM h)
SELECT item_id AS query, hit, min(pos)::INT AS match_start, (max(pos) + 40)::INT AS match_stop FROM i GROUP BY item_id, hit, island""")
def reference_match_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    queries = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), F.col("text").alias("sequence"), none.alias("transcript"), none.alias("wildtype"))
    proteome = read(spark, sf_dir, "documents", F.col("doc_id").cast("string").alias("id"), F.lit("").alias("description"), F.col("text").alias("sequence"))
    hits = reference.reference_hits(queries, proteome, 40)
    return reference.merged_windows(hits, 40).select("query", F.col("hit").cast("long").alias("hit"), "match_start", "match_stop")


@query("""SELECT count(*) AS pairs FROM (SELECT user_id, event_id, epoch(ts)::BIGINT AS t FROM events) a JOIN (SELECT user_id, event_id, epoch(ts)::BIGINT AS t FROM events) b ON a.user_id = b.user_id AND abs(a.t - b.t) <= 60""")
def interval_bin_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "event_id", seconds(F.col("ts")).alias("t"))
    return genomic.interval_join(e, e.select("user_id", F.col("event_id").alias("other"), F.col("t").alias("u")), ["user_id"], "t", "u", 60).agg(F.count("*").alias("pairs"))


_DNA = "translate(substr(md5(p_partkey::VARCHAR), 1, 30), '0123456789abcdef', 'ACGTACGTACGTACGT')"
_CODONS_SQL = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in S.CODONS.items()) + "}"


@query(f"""WITH d AS (SELECT p_partkey, {_DNA} AS dna FROM part)
SELECT p_partkey, split_part(array_to_string(list_transform(range(0, 10), lambda i: {_CODONS_SQL}[substr(dna, i * 3 + 1, 3)]), ''), '*', 1) AS protein FROM d""")
def codon_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    dna = F.translate(F.substring(F.md5(F.col("p_partkey").cast("string").cast("binary")), 1, 30), "0123456789abcdef", "ACGTACGTACGTACGT")
    return read(spark, sf_dir, "part", "p_partkey").withColumn("dna", dna).select("p_partkey", S.translate_dna(F.col("dna")).alias("protein"))


@query(f"WITH d AS (SELECT p_partkey, {_DNA} AS dna FROM part) SELECT p_partkey, translate(reverse(dna), 'ACGT', 'TGCA') AS rc FROM d")
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    dna = F.translate(F.substring(F.md5(F.col("p_partkey").cast("string").cast("binary")), 1, 30), "0123456789abcdef", "ACGTACGTACGTACGT")
    return read(spark, sf_dir, "part", "p_partkey").select("p_partkey", S.reverse_complement(dna).alias("rc"))


@query("""SELECT p_partkey, array_to_string(list_filter(range(1, length(p_name) + 1), lambda i: substr(p_name, i, 1) <> substr(p_type, i, 1)), ', ') AS positions,
len(list_filter(range(1, least(length(p_name), length(p_type)) + 1), lambda i: substr(p_name, i, 1) = substr(p_type, i, 1)))::INT AS same FROM part""")
def mutated_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("p_name"), F.col("p_type")
    return read(spark, sf_dir, "part", "p_partkey", "p_name", "p_type").select("p_partkey", S.mutated_positions(a, b).alias("positions"), S.matches(a, b).alias("same"))


# --- sets, comparison, review ----------------------------------------------------------------------


@query("""SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::INT AS nation FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier""")
def union_by_name_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return filters.union_filled(c, s)


@query("""WITH b AS (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0.01 END AS p, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS s FROM orders)
SELECT o.o_orderkey, 'o_totalprice' AS "column" FROM orders o JOIN b ON o.o_orderkey = b.o_orderkey WHERE abs(o.o_totalprice - b.p) > 0.1
UNION ALL SELECT o.o_orderkey, 'o_orderstatus' FROM orders o JOIN b ON o.o_orderkey = b.o_orderkey WHERE o.o_orderstatus IS DISTINCT FROM b.s""")
def report_diff_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    key = F.col("o_orderkey")
    b = a.withColumns({"o_totalprice": F.col("o_totalprice") + F.when(key % 5 == 0, 1.0).otherwise(0.01), "o_orderstatus": F.when(key % 7 != 0, F.col("o_orderstatus"))})
    return compare.differences(a, b, "o_orderkey", ["o_totalprice", "o_orderstatus"]).select("o_orderkey", "column")


@query("SELECT l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A') EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def ids_in_one_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem", "l_partkey", "l_returnflag")
    return compare.only_in(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), "l_partkey")


@query("SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def ids_in_both_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem", "l_partkey", "l_returnflag")
    return compare.in_both(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), "l_partkey")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY coalesce(nullif(l_tax, 0.01), 0), l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem) SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM r WHERE k = 1""")
def first_row_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.01)))
    return compare.first_per_group(rows, "l_suppkey", "l_tax", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("""WITH RECURSIVE g AS (SELECT c_custkey, CASE WHEN c_custkey % 40 = 7 THEN c_mktsegment || '.' || c_custkey // 40 ELSE c_mktsegment END AS name FROM customer), o AS (SELECT *, row_number() OVER (ORDER BY c_custkey) AS n FROM g),
f AS (SELECT *, regexp_replace(name, '(\\.[1-9][0-9]*)+$', '') AS family FROM o), i AS (SELECT family, n, name, c_custkey, row_number() OVER (PARTITION BY family ORDER BY n) AS k FROM f),
r AS (SELECT family, k, c_custkey, name AS c_mktsegment, [name] AS seen FROM i WHERE k = 1
  UNION ALL SELECT i.family, i.k, i.c_custkey, u.u, list_append(r.seen, u.u) FROM r JOIN i ON i.family = r.family AND i.k = r.k + 1,
    LATERAL (SELECT CASE WHEN NOT list_contains(r.seen, i.name) THEN i.name ELSE i.name || '.' || list_min(list_filter(range(1, len(r.seen) + 2), lambda x: NOT list_contains(r.seen, i.name || '.' || x))) END AS u) u)
SELECT c_custkey, c_mktsegment FROM r""")
def uniquified_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    named = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").withColumn("c_mktsegment", F.when(key % 40 == 7, F.concat_ws(".", "c_mktsegment", F.floor(key / 40).cast("string"))).otherwise(F.col("c_mktsegment")))
    return candidates.uniquified(named, "c_mktsegment", ["c_custkey"])


@query("""SELECT n_name, a.r_name AS first_region, b.r_name AS second_region FROM nation JOIN region a ON n_regionkey = a.r_regionkey JOIN region b ON b.r_regionkey <> a.r_regionkey""")
def ordered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = read(spark, sf_dir, "region", "r_name", "r_regionkey")
    pairs = vector.ordered_pairs(regions)
    return read(spark, sf_dir, "nation").join(pairs, F.col("n_regionkey") == F.col("left_seq")).select("n_name", F.col("left").alias("first_region"), F.col("right").alias("second_region"))


from neolake.plans import catalogue_operators, catalogue_reports, catalogue_runs  # noqa: E402,F401  (they add their queries)
