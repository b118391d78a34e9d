"""Differences of two reports, and forms for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neolake.functions.filters import col


def normalised_names(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Columns under their newer names."""
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns and v not in df.columns})


def shared_columns(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Columns of both, of the first only, of the second only."""
    return [c for c in a.columns if c in b.columns], [c for c in a.columns if c not in b.columns], [c for c in b.columns if c not in a.columns]


def gene_change_id(gene: str = "Gene", change: str = "AA Change") -> Column:
    return F.concat(col(gene), F.lit(" ("), col(change), F.lit(")"))


def split_id(df: DataFrame, column: str = "ID") -> DataFrame:
    """Coordinates of ``chr-start-stop-ref-alt`` ids."""
    part = lambda k: F.split_part(col(column), F.lit("-"), F.lit(k))
    return df.withColumns({"Chromosome": part(1), "Start": part(2).try_cast("long"), "Stop": part(3).try_cast("long"), "Reference": part(4), "Variant": part(5)})


def only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).distinct().join(b.select(key), key, "left_anti")


def in_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).count().where("count > 1")


def differences(a: DataFrame, b: DataFrame, key: str, columns: list[str], tolerance: float = 0.1) -> DataFrame:
    """(key, column, value_1, value_2): cells that differ, numbers by more than ``tolerance``, or that one side lacks."""
    x, y = (df.select(col(key), *[col(c).cast("string").alias(f"{c}\0{i}") for c in columns]) for i, df in enumerate((a, b)))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(f"{c}\0{0}").alias("value_1"), col(f"{c}\0{1}").alias("value_2")) for c in columns])
    cells = x.join(y, key).select(col(key), F.explode(pairs).alias("x")).select(col(key), "x.*")
    n1, n2 = F.col("value_1").try_cast("double"), F.col("value_2").try_cast("double")
    far = F.when(n1.isNotNull() & n2.isNotNull(), F.abs(n1 - n2) > tolerance).otherwise(~F.col("value_1").eqNullSafe(F.col("value_2")))
    return cells.where(far)


def flattened(json: Column) -> Column:
    """Top-level fields of a JSON object as (path, value) rows in an array; values as text."""
    return F.map_entries(F.from_json(json, "map<string,string>"))


def json_differences(a: DataFrame, b: DataFrame, ignore: str = "^chr") -> DataFrame:
    """(key, value_1, value_2) of one-column tables of JSON objects: fields that differ; elements of lists in any order."""

    def fields(df: DataFrame) -> DataFrame:
        rows = df.select(F.explode(flattened(F.col(df.columns[0]))).alias("e")).select("e.key", "e.value").where(~F.col("key").rlike(ignore))
        listed = F.from_json("value", "array<string>")
        return rows.withColumn("value", F.when(F.startswith(F.col("value"), F.lit("[")) & listed.isNotNull(), F.to_json(F.array_sort(listed))).otherwise(F.col("value")))

    x, y = fields(a).withColumnRenamed("value", "value_1"), fields(b).withColumnRenamed("value", "value_2")
    return x.join(y, "key", "full_outer").where(~F.col("value_1").eqNullSafe(F.col("value_2")))


# --- review forms ------------------------------------------------------------------


def in_two_vcfs(variants: DataFrame, first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """``Variant Called by External Pipeline``: the variant is in both call sets."""
    mark = lambda df, n: df.select(*keys).distinct().withColumn(n, F.lit(True))
    both = variants.join(mark(first, "_a"), keys, "left").join(mark(second, "_b"), keys, "left")
    return both.withColumn("Variant Called by External Pipeline", F.coalesce(F.col("_a") & F.col("_b"), F.lit(False))).drop("_a", "_b")


def ordering_form(class_one: DataFrame, class_two: DataFrame, peptides: DataFrame) -> DataFrame:
    """Class I and II candidates of a variant in one row, with the peptide to order (``Index``, ``sequence``)."""
    suffix = lambda df, s: df.withColumnsRenamed({c: f"{c} {s}" for c in df.columns if c not in ("ID", "Index")})
    merged = suffix(class_one, "Class I").join(suffix(class_two.drop("Index"), "Class II"), "ID")
    return merged.join(peptides, "Index", "left")


def first_per_group(df: DataFrame, group: str, order: str, tie: list[str]) -> DataFrame:
    """The group's first row by a feature; a missing feature counts as 0."""
    value = F.coalesce(col(order).try_cast("double"), F.lit(0.0))
    w = Window.partitionBy(col(group)).orderBy(value, *[col(c) for c in tie])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def with_own_evaluations(report: DataFrame, evaluations: DataFrame, key: str = "ID") -> DataFrame:
    """A user's evaluations and comments over those of the report."""
    own = evaluations.select(key, F.col("Evaluation").alias("_e"), F.col("Comments").alias("_c"))
    out = report.join(own, key, "left")
    given = lambda c: F.col(c) if c in report.columns else F.lit(None).cast("string")
    return out.withColumns({"Evaluation": F.coalesce("_e", given("Evaluation"), F.lit("Pending")), "Comments": F.coalesce("_c", given("Comments"))}).drop("_e", "_c")


# The columns that two reports may be compared by, of each kind of table.
AGGREGATED = ["Gene", "AA Change", "Num Passing Transcripts", "Best Peptide", "Best Transcript", "Num Passing Peptides", "IC50 MT", "IC50 WT", "%ile MT", "%ile WT", "RNA Expr", "RNA VAF", "DNA VAF", "Tier"]
REFERENCE_MATCH = ["Peptide", "Hit Definition", "Match Window", "Match Sequence"]
UNAGGREGATED = [
    "Biotype", "Sub-peptide Position", "Median MT IC50 Score", "Median WT IC50 Score", "Median MT Percentile", "Median WT Percentile", "WT Epitope Seq", "Tumor DNA VAF", "Tumor RNA Depth", "Tumor RNA VAF", "Gene Expression", "Problematic Positions",
]
IC50_METHODS = ["MHCflurry", "MHCnuggetsI", "NetMHC", "NetMHCcons", "NetMHCpan", "PickPocket", "SMM", "SMMPMBEC"]
SCORE_METHODS = ["BigMHC_EL", "BigMHC_IM", "DeepImmuno", "MHCflurryEL Processing", "MHCflurryEL Presentation", "NetMHCpanEL"]
RANKED_METHODS = [*IC50_METHODS, "MHCflurryEL Presentation", "NetMHCpanEL"]


def method_columns() -> list[str]:
    """The columns of each method: a score of either side, and a percentile of those that rank."""
    kinds = [(IC50_METHODS, "IC50 Score"), (SCORE_METHODS, "Score"), (RANKED_METHODS, "Percentile")]
    return [f"{m} {side} {measure}" for methods, measure in kinds for m in methods for side in ("WT", "MT")]


def comparable(columns: list[str], kind: str) -> list[str]:
    """``columns``, if all of them are ones that tables of the kind (aggregated, unaggregated, reference_match) may be compared by; else an error."""
    known = {"aggregated": AGGREGATED, "unaggregated": [*UNAGGREGATED, *method_columns()], "reference_match": REFERENCE_MATCH}[kind]
    wrong = [c for c in columns if c not in known]
    if wrong:
        raise ValueError(f"columns that can't be compared: {', '.join(wrong)}")
    return columns


# --- the viewer's tables ---------------------------------------------------------------


def set_table(sets: DataFrame, keys: list[str], best: DataFrame) -> DataFrame:
    """Transcript sets of each variant, with the one that holds its best transcript marked; ``best``: keys, best_transcript."""
    names = F.transform("transcripts", lambda x: F.split(x["name"], "-")[0])
    marked = F.coalesce(F.array_contains(names, F.col("best_transcript")), F.lit(False))
    return sets.join(best, keys, "left").select(*keys, "set", "transcript_count", "peptide_count", "total_expr", marked.alias("has_best"))


def calls_by_allele(calls: DataFrame, keys: list[str], alleles: list[str], values: str = "ic50s_MT") -> DataFrame:
    """A peptide's array of values, in the order of ``alleles``, as a column for each allele; a value that is lacking is null."""
    return calls.select(*[col(k) for k in keys], *[F.col(values)[i].alias(a) for i, a in enumerate(alleles)])


def gathered(wide: DataFrame, keys: list[str], name: str = "allele", value: str = "value") -> DataFrame:
    """The reverse: a row for each allele's value that is there."""
    columns = [c for c in wide.columns if c not in keys]
    return wide.unpivot([col(k) for k in keys], [col(c) for c in columns], name, value).where(col(value).isNotNull())
