"""Stand-in tables that several catalogues' queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neolake.schemas import Thresholds
from neolake.storage import spread

c = F.col


def read(spark: SparkSession, sf_dir: str, name: str, *columns) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def seconds(ts: Column) -> Column:
    """Seconds since 1970 to the nearest one, of halves the even, as SQL casts an epoch to whole numbers."""
    return F.rint(F.unix_micros(ts.cast("timestamp")) / 1e6).cast("long")


#: Proteins from hashes of ``part``: ``wt``, and ``mt`` with residues from ``pos`` on replaced, taken out or put in.
PROTEINS = """
q AS (SELECT p_partkey, p_size, translate(md5(p_partkey::VARCHAR), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS wt, (p_partkey % 30 + 1)::INT AS pos, (p_partkey % 4)::INT AS gone, substr('WYV', 1, (p_partkey % 3 + 1)::INT) AS new FROM part),
p AS (SELECT *, substr(wt, 1, pos - 1) || new || substr(wt, pos + gone) AS mt FROM q)"""


def proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("p_partkey")
    wt = F.translate(F.md5(key.cast("string").cast("binary")), "0123456789abcdef", "ACDEFGHIKLMNPQRS")
    df = spread(read(spark, sf_dir, "part", "p_partkey", "p_size")).withColumns({"wt": wt, "pos": (key % 30 + 1).cast("int"), "gone": (key % 4).cast("int"), "new": F.substring(F.lit("WYV"), F.lit(1), (key % 3 + 1).cast("int"))})
    return df.withColumn("mt", F.concat(F.expr("substring(wt, 1, pos - 1)"), "new", F.expr("substring(wt, pos + gone)")))


#: The epitope table of the reports: ``lineitem`` with ``l_partkey`` as variant, five transcripts, twenty peptides, three alleles.
X = """
x AS (SELECT l_partkey AS v, 'T' || (l_suppkey % 5) AS tr, 'P' || (l_orderkey % 20) AS ep, 'P' || (l_orderkey % 2) AS ep2, 'HLA-' || substr('ABC', l_linenumber % 3 + 1, 1) AS al, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS score, l_discount AS pct, CASE WHEN l_returnflag = 'N' THEN 'protein_coding' ELSE 'other' END AS biotype, l_linestatus = 'O' AS mane, l_returnflag = 'R' AS canonical,
  l_suppkey % 5 + 1 AS tsl, CASE WHEN l_orderkey % 3 = 0 THEN '2, 5' ELSE 'None' END AS prob, l_suppkey % 11 AS len, l_quantity / 10 AS expr, l_suppkey % 4 <> 0 AS anchor, CASE WHEN l_suppkey % 7 = 0 THEN 'cds_start_nf' ELSE 'None' END AS flags,
  l_linenumber % 2 AS pre, 'T' || (l_suppkey % 5) || '.' || (l_orderkey % 3) AS cons, l_quantity AS gexpr, l_tax AS rvaf, CASE WHEN l_suppkey % 6 = 0 THEN 'FS' ELSE 'missense' END AS kind, l_suppkey % 50 AS ppos FROM lineitem)"""
TIE = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate"]
_TIE = ", ".join(TIE)


def table(spark: SparkSession, sf_dir: str, tool: str = "matched") -> DataFrame:
    c = F.col
    side = "MT " if tool == "matched" else ""
    df = read(spark, sf_dir, "lineitem").select(
        c("l_partkey").alias("v"), F.concat(F.lit("T"), c("l_suppkey") % 5).alias("Transcript"), F.concat(F.lit("P"), c("l_orderkey") % 20).alias("MT Epitope Seq" if tool == "matched" else "Epitope Seq"), F.concat(F.lit("P"), c("l_orderkey") % 2).alias("ep2"),
        F.concat(F.lit("HLA-"), F.substring(F.lit("ABC"), c("l_linenumber") % 3 + 1, F.lit(1))).alias("HLA Allele"), *TIE, F.when(c("l_linenumber") != 7, c("l_extendedprice")).alias(f"Median {side}IC50 Score"), c("l_discount").alias(f"Median {side}Percentile"),
        F.when(c("l_returnflag") == "N", "protein_coding").otherwise("other").alias("Biotype"), (c("l_linestatus") == "O").alias("MANE Select"), (c("l_returnflag") == "R").alias("Canonical"), (c("l_suppkey") % 5 + 1).alias("Transcript Support Level"),
        F.when(c("l_orderkey") % 3 == 0, "2, 5").otherwise("None").alias("Problematic Positions"), (c("l_suppkey") % 11).alias("WT Protein Length" if tool == "splice" else "Transcript Length"), (c("l_quantity") / 10).alias("Expression" if tool == "fusion" else "Transcript Expression"),
        (c("l_suppkey") % 4 != 0).alias("anchor"), F.when(c("l_suppkey") % 7 == 0, "cds_start_nf").otherwise("None").alias("Transcript CDS Flags"), c("l_quantity").alias("Gene Expression"), c("l_tax").alias("Tumor RNA VAF"),
        F.when(c("l_suppkey") % 6 == 0, "FS").otherwise("missense").alias("Variant Type"), (c("l_suppkey") % 50).cast("string").alias("Protein Position"), F.lit("V/E").alias("Mutation"),
        F.concat_ws(".", (c("l_linenumber") % 2).cast("string"), F.concat(F.lit("T"), c("l_suppkey") % 5), (c("l_orderkey") % 3).cast("string")).alias("Index"),
    )
    return df if tool == "matched" else df.drop("Mutation")


T = Thresholds(binding=30000.0, inclusion=70000.0, top_peptides=4)
