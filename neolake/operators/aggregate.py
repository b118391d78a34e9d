"""The aggregated report: one row a variant, and its nested metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neolake.functions.filters import col, truthy
from neolake.operators.candidates import best_order, number
from neolake.schemas import NONE, Thresholds


def anchors_of(weights: DataFrame, threshold: float = 0.8, boolean: bool = False, stop_at: bool = False) -> DataFrame:
    """(allele, length, anchors): heaviest positions until their share of the weight exceeds ``threshold`` (``stop_at``: reaches it).

    ``boolean``: positions with a weight of 1 instead.
    """
    key = ["allele", "length"]
    if boolean:
        return weights.where("weight > 0").groupBy(*key).agg(F.array_sort(F.collect_set("pos")).alias("anchors"))
    order = Window.partitionBy(*key).orderBy(F.desc("weight"), "pos").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    kept = weights.withColumn("before", before).where(F.col("before") < threshold if stop_at else F.col("before") <= threshold)
    return kept.groupBy(*key).agg(F.array_sort(F.collect_set("pos")).alias("anchors"))


def included_order(df: DataFrame, t: Thresholds, score: str, tie: list[str], tool: str = "matched", anchor: str | None = None, allow_incomplete: bool = False) -> list[Column]:
    """The order of a variant's peptides, of which the first are included.

    Matched: coding, support level, anchor, [complete], [no problem], score, longest
    transcript, second score. Others: score and second score.
    """
    has = lambda c: c in df.columns
    yes = lambda c: F.coalesce(c, F.lit(False)).desc()
    second = score.replace("IC50 Score", "Percentile") if "IC50 Score" in score else score.replace("Percentile", "IC50 Score")
    out: list[Column] = []
    if tool == "matched":
        tsl = "TSL" if has("TSL") else "Transcript Support Level"
        out += [yes(col("Biotype") == "protein_coding")] if has("Biotype") else []
        out += [F.coalesce(number(tsl), F.lit(6.0)).asc()] if has(tsl) else []
        out += [yes(col(anchor))] if anchor else []
        if allow_incomplete and has("Transcript CDS Flags"):
            out.append(F.coalesce(col("Transcript CDS Flags").rlike("cds_start_nf|cds_end_nf"), F.lit(False)).asc())
        out += [yes(col("Problematic Positions") == NONE)] if has("Problematic Positions") else []
    out.append(number(score).asc_nulls_last())
    out += [number("Transcript Length").desc_nulls_last()] if tool == "matched" and has("Transcript Length") else []
    out += [number(second).asc_nulls_last()] if second != score and has(second) else []
    return [*out, *[col(c).asc_nulls_last() for c in tie]]


def with_inclusion(df: DataFrame, keys: list[str], epitope: str, score: str, t: Thresholds, tie: list[str], **how) -> DataFrame:
    """``df`` with ``_best``, the variant's best row, and ``_included``: that row, and those below the inclusion threshold of its best peptides.

    A peptide stands where its best row stands in the order of included peptides;
    the first ``t.top_peptides`` count. Rows are partitioned by variant once, for all windows.
    """
    by, order = [col(k) for k in keys], best_order(df, t, score, tie, **how)
    out = df.repartition(*by).withColumn("_best", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) == 1)
    out = out.withColumn("_low", F.coalesce(number(score) < t.inclusion, F.lit(False)))
    out = out.withColumn("_first", F.col("_low") & (F.row_number().over(Window.partitionBy(*by, col(epitope), "_low").orderBy(*order)) == 1))
    place = F.row_number().over(Window.partitionBy(*by, "_first").orderBy(*included_order(df, t, score, tie, **how)))
    out = out.withColumn("_place", F.when(F.col("_first"), place))
    at = F.min("_place").over(Window.partitionBy(*by, col(epitope)))
    return out.withColumn("_included", F.col("_best") | F.coalesce(F.col("_low") & (at <= t.top_peptides), F.lit(False))).drop("_low", "_first", "_place")


def included(df: DataFrame, keys: list[str], epitope: str, score: str, t: Thresholds, tie: list[str], **how) -> DataFrame:
    """The rows that a variant's report is made from."""
    return with_inclusion(df, keys, epitope, score, t, tie, **how).where("_included").drop("_best", "_included")


def clonal_vaf(df: DataFrame, vaf: str = "Tumor DNA VAF", purity: float | None = None) -> DataFrame:
    """One row (vaf_clonal): half the purity, or the largest fraction below 0.6, at most 0.5; 0.6 if there is none."""
    if purity is not None:
        return df.sparkSession.range(1).select(F.lit(purity * 0.5).alias("vaf_clonal"))
    top = F.max(F.when(number(vaf) < 0.6, number(vaf)))
    return df.agg(F.when(top.isNull(), 0.6).otherwise(F.least(top, F.lit(0.5))).alias("vaf_clonal"))


def allele_expression(gene: str = "Gene Expression", vaf: str = "Tumor RNA VAF") -> Column:
    return F.round(number(gene) * number(vaf), 3)


def good_binder(score: str, t: Thresholds, cutoff: Column | None = None) -> Column:
    return F.coalesce(number(score) < (F.coalesce(cutoff, F.lit(t.binding)) if cutoff is not None else F.lit(t.binding)), F.lit(False))


def per_allele_counts(df: DataFrame, keys: list[str], alleles: list[str], epitope: str, good: Column, allele: str = "HLA Allele") -> DataFrame:
    """One column for each allele, without ``HLA-``: its different well-binding peptides, null if there are none."""
    count = lambda a: F.count_distinct(F.when(good & (col(allele) == a), col(epitope)))
    return df.groupBy(*[col(k) for k in keys]).agg(*[F.nullif(count(a), F.lit(0)).alias(a.removeprefix("HLA-")) for a in alleles])


def counts(df: DataFrame, keys: list[str], epitope: str, transcript: str, good: Column) -> DataFrame:
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.count_distinct(col(epitope)).alias("Num Included Peptides"), F.count_distinct(F.when(good, col(epitope))).alias("Num Passing Peptides"), F.count_distinct(F.when(good, col(transcript))).alias("Num Passing Transcripts")
    )


def aa_change(kind: str = "Variant Type", mutation: str = "Mutation", position: str = "Protein Position") -> Column:
    """``V600E`` for substitutions, ``FS600`` for frameshifts, position and change for in-frame ones."""
    wild, mutant = F.split_part(col(mutation), F.lit("/"), F.lit(1)), F.split_part(col(mutation), F.lit("/"), F.lit(2))
    return F.when(col(kind) == "FS", F.concat(F.lit("FS"), col(position))).otherwise(F.concat(wild, col(position), mutant))


def set_line(df: DataFrame, transcript: str, fields: list[str] = [], allow_incomplete: bool = False) -> Column:  # noqa: B006
    """What ``transcript_sets`` has to know of a transcript's row that comes first by ``_at``."""
    has = lambda c: c in df.columns
    tsl = "TSL" if has("TSL") else "Transcript Support Level"
    low = lambda c: F.when(F.coalesce(c, F.lit(False)), 0).otherwise(1)
    sort = [
        F.coalesce(col("Transcript CDS Flags").rlike("cds_start_nf|cds_end_nf"), F.lit(False)).cast("int") if allow_incomplete and has("Transcript CDS Flags") else F.lit(0),
        low(col("Biotype") == "protein_coding") if has("Biotype") else F.lit(0), low(truthy(col("MANE Select"))) if has("MANE Select") else F.lit(0), low(truthy(col("Canonical"))) if has("Canonical") else F.lit(0),
        F.coalesce(number(tsl), F.lit(6.0)) if has(tsl) else F.lit(0.0), F.coalesce(-number("Transcript Length"), F.lit(float("inf"))) if has("Transcript Length") else F.lit(0.0),
        F.coalesce(-number("Transcript Expression"), F.lit(float("inf"))) if has("Transcript Expression") else F.lit(0.0),
    ]
    expression = number("Transcript Expression") if has("Transcript Expression") else F.lit(None).cast("double")
    return F.struct(*[x.alias(f"s{i}") for i, x in enumerate(sort)], F.col("_at"), expression.alias("_expr"), F.struct(col(transcript).alias("name"), *[col(f) for f in fields]).alias("line"))


def sets_of(each: DataFrame, keys: list[str], carried: list[str] = []) -> DataFrame:  # noqa: B006
    """``transcript_sets`` of one row a transcript and peptide: keys, _transcript, _peptide, _at, _line (``set_line``).

    ``carried``: columns of ``each`` that are kept of the first transcript of a set, as ``_carried``, structs a peptide.
    """
    by = [col(k) for k in keys]
    first = lambda c: F.min_by(c, F.col("_at"))
    kept = F.collect_list(F.struct(*carried)) if carried else F.lit(None)
    own = each.groupBy(*by, "_transcript").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_peptide"))), lambda x: x["_peptide"]).alias("peptides"), first(F.col("_line")).alias("_line"), F.min("_at").alias("_at"), kept.alias("_carried"))
    sets = own.groupBy(*by, "peptides").agg(F.array_sort(F.collect_list("_line")).alias("_lines"), first(F.col("_carried")).alias("_carried"), F.min("_at").alias("_at"))
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("_at"))
    total = F.aggregate("_lines", F.lit(0.0).cast("double"), lambda s, x: s + F.coalesce(x["_expr"], F.lit(0.0)))
    return sets.select(
        *by, F.format_string("Transcript Set %d", nth).alias("set"), "peptides", F.transform("_lines", lambda x: x["line"]).alias("transcripts"), F.size("_lines").alias("transcript_count"), F.size("peptides").alias("peptide_count"), total.alias("total_expr"), "_carried"
    )


def transcript_sets(df: DataFrame, keys: list[str], transcript: str, epitope: str, order: list[str], fields: list[str] = [], allow_incomplete: bool = False) -> DataFrame:  # noqa: B006
    """(keys, set, peptides, transcripts, transcript_count, peptide_count, total_expr): a variant's transcripts with the same peptides.

    ``order``: columns whose order is that of the rows. Peptides are listed by first
    appearance, sets numbered by it. Transcripts in a set: [complete], coding, MANE,
    canonical, support level, longest, highest expression, then by appearance;
    ``transcripts`` holds structs of the name and ``fields``, from its first row.
    """
    by = [col(k) for k in keys]
    rows = df.repartition(*by).withColumn("_at", F.struct(*[col(c) for c in order]))
    each = rows.groupBy(*by, col(transcript).alias("_transcript"), col(epitope).alias("_peptide")).agg(F.min("_at").alias("_at"), F.min_by(set_line(df, transcript, fields, allow_incomplete), F.col("_at")).alias("_line"))
    return sets_of(each, keys).drop("_carried")


def peptide_calls(df: DataFrame, keys: list[str], epitope: str, allele: str, alleles: list[str], score: str, wildtype: str) -> DataFrame:
    """For each peptide, mutant and wild-type scores in the order of ``alleles`` (null: not predicted) and the least of them."""
    entry = lambda c: F.map_from_entries(F.collect_list(F.struct(col(allele), number(c))))
    once = df.groupBy(*[col(k) for k in [*keys, epitope, allele]]).agg(F.min(number(score)).alias(score), F.min(number(wildtype)).alias(wildtype))
    maps = once.groupBy(*[col(k) for k in [*keys, epitope]]).agg(entry(score).alias("_mt"), entry(wildtype).alias("_wt"))
    listed = lambda m: F.array(*[F.try_element_at(m, F.lit(a)) for a in alleles])
    out = maps.select(*[col(k) for k in [*keys, epitope]], listed(F.col("_mt")).alias("ic50s_MT"), listed(F.col("_wt")).alias("ic50s_WT"))
    return out.withColumn("best_ic50_MT", F.array_min("ic50s_MT"))


def algorithm_calls(df: DataFrame, keys: list[str], epitope: str, algorithms: list[str], order: list[str], measure: str = "IC50 Score", allele: str = "HLA Allele") -> DataFrame:
    """(keys, epitope, MT, WT): maps from the allele to each algorithm's values, in the order of ``algorithms``; of several rows the last."""
    last = F.struct(*[col(c) for c in order])
    values = lambda side: F.array(*[number(f"{m} {side} {measure}") for m in algorithms])
    once = df.groupBy(*[col(k) for k in [*keys, epitope, allele]]).agg(F.max_by(values("MT"), last).alias("_mt"), F.max_by(values("WT"), last).alias("_wt"))
    pairs = lambda c: F.map_from_entries(F.array_sort(F.collect_list(F.struct(col(allele), c))))
    return once.groupBy(*[col(k) for k in [*keys, epitope]]).agg(pairs("_mt").alias("MT"), pairs("_wt").alias("WT"))


def ordered_peptides(calls: DataFrame, keys: list[str], epitope: str, problematic: str | None = None, anchor_fails: str | None = None) -> DataFrame:
    """A variant's peptides as one array: without problem first, then with anchor pass, then by least score."""
    flag = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)) if c else F.lit(0)
    item = F.struct(flag(problematic).alias("a"), flag(anchor_fails).alias("b"), F.coalesce("best_ic50_MT", F.lit(float("inf"))).alias("c"), col(epitope).alias("peptide"), "ic50s_MT", "ic50s_WT")
    return calls.groupBy(*[col(k) for k in keys]).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["peptide"].alias("peptide"), x["ic50s_MT"].alias("ic50s_MT"), x["ic50s_WT"].alias("ic50s_WT"))).alias("peptides"))


def metrics_json(metrics: DataFrame, key: str) -> DataFrame:
    """(key, json): everything but the key as one object."""
    return metrics.select(F.col(key), F.to_json(F.struct(*[col(c) for c in metrics.columns if c != key]), {"ignoreNullFields": "false"}).alias("json"))


# The reports' columns, and the columns of the epitope table that they show; scores carry their prefix (Median or Best).
_SHARED = {"Gene": "Gene Name", "Allele": "HLA Allele", "Prob Pos": "Problematic Positions"}
_RNA = {"RNA Expr": "Gene Expression", "RNA VAF": "Tumor RNA VAF", "RNA Depth": "Tumor RNA Depth", "DNA VAF": "Tumor DNA VAF"}
_MODEL = {"MANE Select": "MANE Select", "Canonical": "Canonical", "TSL": "Transcript Support Level"}
REPORT = {
    "matched": {**_SHARED, **_MODEL, **_RNA, "Index": "Index", "Best Peptide": "MT Epitope Seq", "Best Transcript": "Transcript", "Pos": "Mutation Position"},
    "splice": {**_SHARED, **_MODEL, **_RNA, "Transcript": "Transcript", "Junction Name": "Junction", "AA Change": "Amino Acid Change", "Best Peptide": "Epitope Seq", "Pos": "Protein Position"},
    "fusion": {**_SHARED, "Best Peptide": "Epitope Seq", "Best Transcript": "Transcript", "Expr": "Expression", "Read Support": "Read Support"},
    "bind": {"Best Peptide": "Epitope Seq", "Allele": "HLA Allele", "Pos": "Sub-peptide Position", "Prob Pos": "Problematic Positions"},
}


def score_columns(tool: str, prefix: str) -> dict[str, str]:
    """The report's score columns and what they show."""
    if tool != "matched":
        return {"IC50 MT": f"{prefix} IC50 Score", "%ile MT": f"{prefix} Percentile"}
    wild = "Corresponding" if prefix == "Best" else prefix
    return {"IC50 MT": f"{prefix} MT IC50 Score", "IC50 WT": f"{wild} WT IC50 Score", "%ile MT": f"{prefix} MT Percentile", "%ile WT": f"{wild} WT Percentile"}


def aggregated_report(df: DataFrame, keys: list[str], alleles: list[str], t: Thresholds, score: str, epitope: str, transcript: str, tie: list[str], tool: str = "matched", cutoff: Column | None = None, **how) -> DataFrame:
    """One row a variant: its best row's figures and counts over the included peptides, under the report's column names.

    ``ID`` is the keys joined by ``-`` (of splice tables the best row's index). An
    allele's column has its different well-binding peptides, null if none. What
    the epitope table lacks is null, but ``None`` for problematic positions. Tier
    is ``Not Tiered`` until a tiering fills it. Windows and groups share one shuffle by variant.
    """
    rows = with_inclusion(df, keys, epitope, score, t, tie, tool=tool, **how).where("_included").withColumn("_good", good_binder(score, t, cutoff))
    different = lambda c, when: F.size(F.collect_set(F.when(when, c)))  # noqa: E731  (a variant's included rows are bounded)
    annotation = F.concat_ws("-", *[col(c).cast("string") for c in (transcript, "Gene Name", "Mutation", "Protein Position") if c in df.columns])
    everything = F.first(F.when(F.col("_best"), F.struct(*[col(c) for c in df.columns])), ignorenulls=True)
    own = lambda a: F.nullif(different(col(epitope), F.col("_good") & (col("HLA Allele") == a)), F.lit(0))
    out = rows.groupBy(*[col(k) for k in keys]).agg(
        everything.alias("_b"), *[own(a).alias(a.removeprefix("HLA-")) for a in sorted(alleles)], different(annotation, F.lit(True)).alias("Num Passing Transcripts"), different(col(epitope), F.lit(True)).alias("Num Included Peptides"),
        different(col(epitope), F.col("_good")).alias("Num Passing Peptides"),
    )
    prefix = score.split(" ")[0]
    best = lambda c: F.col("_b").getField(c) if c in df.columns else F.lit("None" if c == "Problematic Positions" else None).cast("string")
    shown = REPORT[tool] | score_columns(tool, prefix)
    name = F.concat_ws("-", *[col(k).cast("string") for k in keys])
    columns = [(best("Index") if tool == "splice" and "Index" in df.columns else name).alias("ID"), *[col(a.removeprefix("HLA-")) for a in sorted(alleles)], *[best(c).alias(n) for n, c in shown.items()]]
    if tool == "matched":
        columns += [F.when(best("Variant Type") == "FS", F.concat(F.lit("FS"), best("Protein Position"))).otherwise(F.concat(F.split_part(best("Mutation"), F.lit("/"), F.lit(1)), best("Protein Position"), F.split_part(best("Mutation"), F.lit("/"), F.lit(2)))).alias("AA Change"), F.col("Num Passing Transcripts")]
    if tool in ("matched", "splice"):
        columns.append(F.round(best("Gene Expression").try_cast("double") * best("Tumor RNA VAF").try_cast("double"), 3).alias("Allele Expr"))
    return out.select(*columns, "Num Included Peptides", "Num Passing Peptides", F.lit("Not Tiered").alias("Tier"), F.lit("Pending").alias("Evaluation"))


def no_problem(c: str = "Prob Pos") -> Column:
    return F.coalesce(col(c) == NONE, F.lit(False))
