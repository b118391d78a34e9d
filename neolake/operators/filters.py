"""Row filters of the post-processing chain."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neolake.functions.filters import Criterion, all_of, any_of, col, preferred_transcript, problematic_positions
from neolake.schemas import NONE, Thresholds


def binding_filter(df: DataFrame, t: Thresholds, score: str = "Median MT IC50 Score", percentile: str = "Median MT Percentile", fold_change: str = "Corresponding Fold Change", compat: bool = False) -> DataFrame:
    """Score at most the threshold, and (conservative) or else (exploratory) the percentile.

    The fold change must pass as well. ``compat``: it joins an exploratory choice instead.
    """
    tests = [Criterion(score, "<=", t.binding, t.exclude_nas)]
    if t.percentile is not None:
        tests.append(Criterion(percentile, "<=", t.percentile, t.exclude_nas))
    fold = [Criterion(fold_change, ">=", t.fold_change, t.exclude_nas)] if t.fold_change is not None else []
    if t.strategy == "conservative":
        return df.where(all_of(tests + fold))
    return df.where(any_of(tests + fold)) if compat else df.where(any_of(tests) & all_of(fold))


def allele_specific_filter(df: DataFrame, cutoffs: DataFrame, t: Thresholds, score: str = "Median MT IC50 Score", percentile: str = "Median MT Percentile", fold_change: str | None = None, allele: str = "HLA Allele") -> DataFrame:
    """As the binding filter, with a threshold for each allele that ``cutoffs`` (allele, cutoff) names; a missing score passes unless excluded."""
    # a row an allele; Spark broadcasts it by its measured size, and shuffles beyond that
    known = df.join(cutoffs.select(F.col("allele").alias(allele), F.col("cutoff").alias("_cutoff")), allele, "left")
    value = col(score).try_cast("double")
    binds = F.coalesce(value <= F.coalesce("_cutoff", F.lit(t.binding)), F.lit(not t.exclude_nas))
    if t.percentile is not None:
        rank = Criterion(percentile, "<=", t.percentile, t.exclude_nas).passes()
        binds = (binds & rank) if t.strategy == "conservative" else (binds | rank)
    if fold_change is not None and t.fold_change is not None:
        binds = binds & F.coalesce(col(fold_change).try_cast("double") >= t.fold_change, F.lit(True))
    return known.where(binds).select(*[col(c) for c in df.columns])


def coverage_criteria(t: Thresholds, tool: str = "matched") -> list[Criterion]:
    """Depth, fraction and expression tests of matched, splice or fusion tables."""
    if tool == "fusion":
        return [Criterion("Read Support", ">=", t.read_support, t.exclude_nas), Criterion("Expression", ">=", t.fusion_expression, t.exclude_nas)]
    out = [
        Criterion("Normal Depth", ">=", t.normal_depth, t.exclude_nas), Criterion("Normal VAF", "<=", t.normal_vaf, t.exclude_nas), Criterion("Tumor DNA Depth", ">=", t.tdna_depth, t.exclude_nas), Criterion("Tumor DNA VAF", ">=", t.tdna_vaf, t.exclude_nas),
        Criterion("Tumor RNA Depth", ">=", t.trna_depth, t.exclude_nas), Criterion("Tumor RNA VAF", ">=", t.trna_vaf, t.exclude_nas), Criterion("Gene Expression", ">=", t.expression, t.exclude_nas),
    ]
    return out if tool == "splice" else [*out, Criterion("Transcript Expression", ">=", t.expression, t.exclude_nas)]


def coverage_filter(df: DataFrame, t: Thresholds, tool: str = "matched") -> DataFrame:
    """Tests whose column the table has."""
    return df.where(all_of(c for c in coverage_criteria(t, tool) if c.column in df.columns))


def transcript_filter(df: DataFrame, t: Thresholds) -> DataFrame:
    tsl = "TSL" if "TSL" in df.columns else "Transcript Support Level"
    return df.where(preferred_transcript(t.transcript_strategies, t.tsl, tsl=tsl))


def mark_problematic(df: DataFrame, entries: Iterable[str], sequence: str, drop: bool = False) -> DataFrame:
    """Adds ``Prob Pos`` to an aggregated table or ``Problematic Positions`` to another; with ``drop`` keeps the rows without."""
    name = "Prob Pos" if "Best Peptide" in df.columns else "Problematic Positions"
    found = problematic_positions(col(sequence), entries)
    return df.where(found == NONE) if drop else df.withColumn(name, found)


def mark_genes(df: DataFrame, genes: DataFrame, gene: str = "Gene Name") -> DataFrame:
    """``Gene of Interest``: the gene, or one of a fusion's two, is listed."""
    names = df.select(col(gene).alias("_name")).where("_name is not null").distinct()
    parts = F.explode(F.array_union(F.array("_name"), F.split("_name", "-"))).alias("gene")
    hits = names.select("_name", parts).join(genes.select("gene"), "gene", "left_semi").select("_name").distinct().withColumn("_hit", F.lit(True))
    return df.join(hits, col(gene) == F.col("_name"), "left").withColumn("Gene of Interest", F.coalesce("_hit", F.lit(False))).drop("_name", "_hit")


def evaluation_filter(df: DataFrame, accepted: Iterable[str] = ("Accept",)) -> DataFrame:
    return df.where(F.col("Evaluation").isin(*accepted))


def without_dna_warnings(predictions: DataFrame, allele: str = "allele") -> DataFrame:
    return predictions.where(~F.coalesce(F.contains(col(allele), F.lit("Potential DNA sequence")), F.lit(False)))


def supported_combinations(wanted: DataFrame, support: DataFrame) -> DataFrame:
    """Allele, length and method combinations that a predictor knows."""
    return wanted.join(support, ["method", "allele", "length"], "left_semi")


def append_columns(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Columns of a table with one row a key, for rows that have it or not."""
    return df.join(other, key, "left")


def union_filled(*tables: DataFrame) -> DataFrame:
    """All rows; columns in order of first sight, missing cells null."""
    out, names = tables[0], list(tables[0].columns)
    for t in tables[1:]:
        names += [c for c in t.columns if c not in names]
        out = out.unionByName(t, allowMissingColumns=True)
    return out.select(*[col(c) for c in names])
