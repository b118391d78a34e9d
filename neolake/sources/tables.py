"""Delimited tables in and out, and small reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neolake.schemas import NA


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A header and tab-separated text columns; only ``NA`` is null."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False, nullValue=NA, emptyValue="", quote="")


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns tried as the given types; what doesn't parse, and NaN, is null. Absent ones are passed over."""

    def cast(name: str) -> Column:
        c = F.col(f"`{name}`").try_cast(kinds[name])
        return (F.when(~F.isnan(c), c) if kinds[name] in ("double", "float") else c).alias(name)

    return df.select(*[cast(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def scored(df: DataFrame, column: str) -> DataFrame:
    """Rows with a score, the score as a double."""
    return typed(df, {column: "double"}).where(F.col(f"`{column}`").isNotNull())


def exported(df: DataFrame, decimals: int | None = 3) -> DataFrame:
    """All columns as text: null is ``NA``, infinity ``inf``, doubles with ``decimals`` places."""

    def text(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            shown = F.format_string(f"%.{decimals}f", c) if decimals is not None else c.cast("string")
            return F.coalesce(F.when(c == float("inf"), "inf").otherwise(F.when(c.isNotNull(), shown)), F.lit(NA)).alias(name)
        return F.coalesce(F.initcap(c.cast("string")) if kind == "boolean" else c.cast("string"), F.lit(NA)).alias(name)

    return df.select(*[text(n, k) for n, k in df.dtypes])


def write_tsv(df: DataFrame, path: str, decimals: int | None = 3) -> None:
    exported(df, decimals).write.csv(path, sep="\t", header=True, quote="", emptyValue="")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a row (nested metrics)."""
    df.write.json(path, ignoreNullFields=False)


def anchor_weights(df: DataFrame, allele: str = "HLA") -> DataFrame:
    """(allele, length, pos, weight) of a wide table of one length: columns ``1`` .. ``n`` of weights, or of true and false."""
    places = [c for c in df.columns if c.isdigit()]
    values = [F.coalesce(F.col(f"`{c}`").cast("string").try_cast("double"), F.col(f"`{c}`").cast("string").try_cast("boolean").cast("double")) for c in places]
    long = F.explode(F.array(*[F.struct(F.lit(int(c)).alias("pos"), v.alias("weight")) for c, v in zip(places, values)])).alias("x")
    return df.select(F.col(f"`{allele}`").alias("allele"), F.lit(len(places)).alias("length"), long).select("allele", "length", "x.pos", "x.weight")


def allele_cutoffs(spark: SparkSession, path: str) -> DataFrame:
    """(allele, cutoff) of a CSV file."""
    raw = spark.read.csv(path, header=True)
    return raw.select(F.col(raw.columns[0]).alias("allele"), F.col(raw.columns[1]).try_cast("double").alias("cutoff"))


def gene_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("gene")).where("gene <> ''").distinct()
