"""Tiers: what, if anything, speaks against a candidate.

Each predicate that fails is a strike. A candidate without strikes passes; one
with a single strike (or a tolerated pair) is in that strike's tier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.filters import col, preferred_transcript
from neolake.operators.candidates import number
from neolake.schemas import NONE, Thresholds


def binds(t: Thresholds, score: str = "IC50 MT", percentile: str = "%ile MT", cutoff: Column | None = None, inclusive_percentile: bool = False) -> Column:
    """Below the score threshold and (conservative) or else or (exploratory) below the percentile; strict, unlike the filter."""
    limit = F.coalesce(cutoff, F.lit(t.binding)) if cutoff is not None else F.lit(t.binding)
    ic50 = F.coalesce(number(score) < limit, F.lit(False))
    if t.percentile is None:
        return ic50 if t.strategy == "conservative" else F.lit(True)
    rank = number(percentile) <= t.percentile if inclusive_percentile else number(percentile) < t.percentile
    rank = F.coalesce(rank, F.lit(False))
    return ic50 & rank if t.strategy == "conservative" else ic50 | rank


def strikes(failing: dict[str, Column]) -> Column:
    """Names of the predicates that hold, in the given order, joined by ``+``."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in failing.items()])), "+")


def _common(df: DataFrame, t: Thresholds, cutoff: Column | None, viewer: bool) -> dict[str, Column]:
    text = lambda c: col(c).cast("string")
    out = {"binding": ~binds(t, cutoff=cutoff, inclusive_percentile=viewer)}
    out["reference"] = F.coalesce(F.lower(text("Ref Match")) == "true", F.lit(False)) if "Ref Match" in df.columns else F.lit(False)
    out["problem"] = F.coalesce(text("Prob Pos") != NONE, F.lit(True)) if "Prob Pos" in df.columns else F.lit(False)
    return out


def _named(code: Column, names: dict[str, str], otherwise: Column | str) -> Column:
    out = F.when(code == "", "Pass")
    for k, v in names.items():
        out = out.when(code == k, v)
    return out.otherwise(otherwise)


SIMPLE = {"binding": "PoorBinder", "reference": "RefMatch", "problem": "ProbPos"}


def matched_tier(df: DataFrame, t: Thresholds, vaf_clonal: Column | float, anchor_pass: Column | None = None, cutoff: Column | None = None, mode: str = "report") -> Column:
    """Tier of matched (with ``anchor_pass``) and splice (without) reports.

    ``mode='viewer'``: percentiles pass at the threshold, and a poor transcript must not have an anchor strike as well.
    """
    tsl = "TSL" if "TSL" in df.columns else "Transcript Support Level"
    allele_expr, rna_expr, rna_vaf, rna_depth, dna_vaf = (number(c) for c in ("Allele Expr", "RNA Expr", "RNA VAF", "RNA Depth", "DNA VAF"))
    no = F.lit(False)
    failing = _common(df, t, cutoff, mode == "viewer") | {
        "expression": F.coalesce(allele_expr <= t.allele_expression, no),
        "clonality": F.coalesce(dna_vaf < (F.lit(vaf_clonal) if isinstance(vaf_clonal, float) else vaf_clonal) / 2, no),
        "transcript": ~preferred_transcript(t.transcript_strategies, t.tsl, tsl=tsl),
        "anchor": ~anchor_pass if anchor_pass is not None else no,
    }
    code = strikes(failing)
    known = rna_vaf.isNotNull() & rna_expr.isNotNull() & rna_depth.isNotNull() & allele_expr.isNotNull()
    low = F.coalesce(known & ((allele_expr > 0) | ((rna_expr == 0) & (rna_depth > t.trna_depth) & (rna_vaf > t.trna_vaf))), no)
    none = F.coalesce(rna_expr == 0, no) | F.coalesce(rna_vaf == 0, no)
    names = SIMPLE | {"transcript": "PoorTranscript", "anchor": "Anchor", "clonality": "Subclonal"}
    if mode != "viewer":
        names["transcript+anchor"] = "PoorTranscript"
    rest = F.when((code == "expression") & low, "LowExpr").when(none & ~low, "NoExpr").otherwise("Poor")
    return _named(code, names, rest)


def fusion_tier(df: DataFrame, t: Thresholds, cutoff: Column | None = None) -> Column:
    low = lambda c, x: F.coalesce(number(c) < x, F.lit(False))
    failing = _common(df, t, cutoff, False) | {"reads": low("Read Support", t.read_support), "expression": low("Expr", t.fusion_expression)}
    return _named(strikes(failing), SIMPLE | {"reads": "LowReadSupport", "expression": "LowExpr"}, "Poor")


def bind_tier(df: DataFrame, t: Thresholds, cutoff: Column | None = None) -> Column:
    return _named(strikes(_common(df, t, cutoff, False)), SIMPLE, "Poor")


def viewer_flags(df: DataFrame, t: Thresholds, vaf_clonal: float, anchor_pass: Column) -> DataFrame:
    """Pass or fail of each single measure, as columns."""
    tsl = "TSL" if "TSL" in df.columns else "Transcript Support Level"
    yes = lambda c: F.coalesce(c, F.lit(True))
    flags = {
        "IC50 Pass": F.coalesce(number("IC50 MT") < t.binding, F.lit(False)), "Percentile Pass": yes(number("%ile MT") <= t.percentile) if t.percentile is not None else F.lit(True), "Anchor Pass": anchor_pass, "Clonal Pass": yes(number("DNA VAF") >= vaf_clonal / 2),
        "Allele Expr Pass": yes(number("Allele Expr") > t.allele_expression), "RNA Expr Pass": yes(number("RNA Expr") > 0), "RNA VAF Pass": yes(number("RNA VAF") >= t.trna_vaf), "RNA Depth Pass": yes(number("RNA Depth") >= t.trna_depth),
        "Prob Pos Pass": F.coalesce(col("Prob Pos") == NONE, F.lit(False)) if "Prob Pos" in df.columns else F.lit(True), "TSL Pass": preferred_transcript(["tsl"], t.tsl, tsl=tsl), "MANE Pass": preferred_transcript(["mane_select"], t.tsl, tsl=tsl), "Canonical Pass": preferred_transcript(["canonical"], t.tsl, tsl=tsl),
        "Scaled BA": number("IC50 MT") / t.binding, "Scaled Percentile": number("%ile MT") / (t.percentile or 1.0),
    }
    return df.withColumns(flags)


def metrics_refreshed(metrics: DataFrame, t: Thresholds, vaf_clonal: float) -> DataFrame:
    """The thresholds of a nested ``parameters`` column as they are after a new tiering."""
    new = {"binding_threshold": F.lit(t.binding), "percentile_threshold": F.lit(t.percentile).cast("double"), "percentile_threshold_strategy": F.lit(t.strategy), "vaf_clonal": F.lit(vaf_clonal), "allele_expr_threshold": F.lit(t.allele_expression)}
    out = F.col("parameters")
    for k, v in new.items():
        out = out.withField(k, v)
    return metrics.withColumn("parameters", out)
