"""The post-processing chain of an epitope table, and whole runs, as compositions of operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.sequences import centred, changed_window, every_kmer, frameshift_window, letters, manufacturability, mutated_protein, residue_styles
from neolake.operators import aggregate, alignment, candidates, compare, filters, genomic, haplotypes, predictions, reference, tiers
from neolake.schemas import Thresholds


@dataclass(frozen=True)
class Tool:
    """What a table of one tool has."""

    name: str
    keys: tuple[str, ...]
    epitope: str
    transcript: str
    score: str
    tie: tuple[str, ...]
    coverage: bool = True
    transcripts: bool = True
    genes: bool = True
    #: The variant of the top-score filter where it isn't ``keys``, and the column of ``prefix.consequence`` names.
    top: tuple[str, ...] = ()
    label: str | None = None


MATCHED = Tool("matched", ("Chromosome", "Start", "Stop", "Reference", "Variant"), "MT Epitope Seq", "Transcript", "Median MT IC50 Score", ("Transcript", "HLA Allele", "MT Epitope Seq"), label="Index")
SPLICE = Tool("splice", ("Junction",), "Epitope Seq", "Transcript", "Median IC50 Score", ("Index", "HLA Allele"))
FUSION = Tool("fusion", ("Mutation",), "Epitope Seq", "Mutation", "Median IC50 Score", ("HLA Allele", "Epitope Seq"), transcripts=False, top=("Chromosome", "Start", "Stop"), label="Mutation")
BIND = Tool("bind", ("Mutation",), "Epitope Seq", "Mutation", "Median IC50 Score", ("HLA Allele", "Epitope Seq"), coverage=False, transcripts=False, genes=False)


@dataclass(frozen=True)
class Options:
    thresholds: Thresholds = field(default_factory=Thresholds)
    problematic: tuple[str, ...] = ()
    elution_only: bool = False
    cutoffs: DataFrame | None = None
    genes: DataFrame | None = None


@dataclass(frozen=True)
class Results:
    all_epitopes: DataFrame
    filtered: DataFrame
    aggregated: DataFrame | None


def post_process(df: DataFrame, tool: Tool, o: Options, alleles: list[str]) -> Results:
    """Marks, report over the unfiltered table, then binding, coverage, transcript and top-score filters, in this order.

    With elution methods only, there is no binding score: the report and the filters on it are left out.
    """
    t = o.thresholds
    marked = filters.mark_problematic(df, o.problematic, tool.epitope) if o.problematic else df
    if tool.genes and o.genes is not None and "Gene Name" in df.columns:
        marked = filters.mark_genes(marked, o.genes)
    report = None
    if not o.elution_only:
        report = aggregate.aggregated_report(marked, list(tool.keys), alleles, t, tool.score, tool.epitope, tool.transcript, list(tool.tie), tool=tool.name)
    out = marked
    if not o.elution_only:
        fold = "Corresponding Fold Change" if "Corresponding Fold Change" in out.columns else None
        if o.cutoffs is not None:
            out = filters.allele_specific_filter(out, o.cutoffs, t, tool.score, fold_change=fold)
        else:
            out = filters.binding_filter(out, t, tool.score, tool.score.replace("IC50 Score", "Percentile"), fold or "Corresponding Fold Change")
    if tool.coverage:
        out = filters.coverage_filter(out, t, tool.name)
    if tool.transcripts:
        out = filters.transcript_filter(out, t)
    if not o.elution_only:
        variant = list(tool.top) if set(tool.top) <= set(out.columns) and tool.top else list(tool.keys)
        label = tool.label if tool.label in out.columns else None
        out = candidates.top_score(out, variant, tool.transcript, tool.epitope, t, tool.score, list(tool.tie), label, tool=tool.name)
        out = out.orderBy(*candidates.default_order(tool.name)) if _sortable(out, tool.name) else out
    return Results(marked, out, report)


def _sortable(df: DataFrame, tool: str) -> bool:
    """The table has the columns that its order asks for."""
    score = "MT IC50 Score" if tool == "matched" else "IC50 Score"
    own = {"matched": "Corresponding Fold Change", "splice": "Index"}.get(tool, "Sub-peptide Position")
    return {f"Median {score}", f"Best {score}", own} <= set(df.columns)


def combined(*tables: DataFrame, tool: Tool, o: Options, alleles: list[str]) -> Results:
    """Epitope tables of several runs (classes of alleles, or lengths) as one, and its post-processing."""
    return post_process(filters.union_filled(*tables), tool, o, alleles)


def tiered(report: DataFrame, tool: Tool, t: Thresholds, vaf_clonal: float = 0.5, anchors: DataFrame | None = None) -> DataFrame:
    """A report with ``Tier``, in the order of tier, rank sum and names; ``anchors``: allele, length, anchors."""
    from neolake.functions.filters import anchor_pass, default_anchors

    if tool.name in ("matched", "splice"):
        passed = None
        if tool.name == "matched":
            length = F.length("Best Peptide")
            own = default_anchors(length)
            if anchors is not None:
                table = anchors.select(F.col("allele").alias("Allele"), F.col("length").alias("_length"), "anchors")
                report = report.withColumn("_length", length).join(table, ["Allele", "_length"], "left").drop("_length")
                own = F.coalesce("anchors", own)
            passed = anchor_pass(F.col("Pos"), own, F.col("`IC50 WT`").try_cast("double"), F.lit(t.binding))
        tier = tiers.matched_tier(report, t, vaf_clonal, passed)
        expression = "Allele Expr"
    elif tool.name == "fusion":
        tier, expression = tiers.fusion_tier(report, t), "Expr"
    else:
        tier, expression = tiers.bind_tier(report, t), None
    return candidates.rank_sum_order(report.withColumn("Tier", tier), tool.name, "IC50 MT", expression, ["ID"])


def with_reference_matches(report: DataFrame, queries: DataFrame, proteome: DataFrame, k: int = 8) -> DataFrame:
    """``Ref Match`` of a report by exact k-mers of a proteome."""
    return reference.with_reference_match(report, reference.merged_windows(reference.reference_hits(queries, proteome, k), k))


def splice_peptides(alternate: DataFrame, wildtype: DataFrame, key: str, lengths: list[int]) -> DataFrame:
    """(kmer, ids, length): novel peptides of all lengths."""
    out = None
    for k in lengths:
        part = genomic.kmer_ids(genomic.novel_kmers(alternate, wildtype, key, k), key).withColumn("length", F.lit(k))
        out = part if out is None else out.union(part)
    return out


def epitope_table(mutant: DataFrame, wildtype: DataFrame, scores: DataFrame) -> DataFrame:
    """Matched epitopes with their summaries over methods: one row (index, allele, length, position)."""
    pairs = predictions.match_wildtype(mutant, wildtype)
    own = scores.select("allele", "epitope", "method", "score", "percentile")
    wt = own.select("allele", F.col("epitope").alias("wt_epitope"), "method", F.col("score").alias("wt_score"), F.col("percentile").alias("wt_percentile"))
    long = pairs.join(own, ["allele", "epitope"]).join(wt, ["allele", "wt_epitope", "method"], "left")
    return predictions.summarise(long, ["index", "allele", "length", "position", "epitope", "wt_epitope", "mutation_position"])


def peptide_fasta(sequences: DataFrame, mutant_only: bool = False, report: DataFrame | None = None, accepted: tuple[str, ...] = ("Accept",)) -> DataFrame:
    """(id, sequence, and the measures of how hard each is to make): the peptides of a FASTA report.

    ``sequences``: id (``MT.index`` or ``WT.index``), sequence. ``report`` (Index)
    keeps the sequences it lists; one with ``Evaluation`` those of accepted rows.
    """
    rows = sequences.withColumn("_side", F.split_part("id", F.lit("."), F.lit(1))).withColumn("_index", F.expr("substring(id, instr(id, '.') + 1)"))
    rows = rows.where("_side <> 'WT'") if mutant_only else rows
    if report is not None:
        listed = filters.evaluation_filter(report, accepted) if "Evaluation" in report.columns else report
        rows = rows.join(listed.select(F.col("Index").alias("_index")).distinct(), "_index", "left_semi")
    return rows.select("id", "sequence", *[v.alias(k) for k, v in manufacturability(F.col("sequence")).items()])


def variant_sequences(variants: DataFrame, flank: int, downstream: int | None = 1000) -> DataFrame:
    """(id, sequence) of the mutant and wild-type windows of every variant (index and the columns of an annotated variant).

    Frameshifts go from ``flank`` residues before to ``downstream`` after their
    position, the others ``flank`` residues to either side of what changes. A change
    that doesn't fit its protein gives no rows; a wild type has a window of its own.
    With neighbours (``haplotypes.with_neighbours``) the wild type carries the
    germline ones, the mutant all of them, of a frameshift those before it; windows
    stay where they are.
    """
    position = F.regexp_extract("protein_position", r"^(\d+)", 1).cast("int")
    shift = F.col("variant_type") == "FS"
    wild, change = F.col("wildtype_amino_acid_sequence"), F.col("amino_acid_change")
    mutant = F.when(shift, F.col("frameshift_amino_acid_sequence")).otherwise(mutated_protein(wild, change, position))
    rows = variants.withColumns({"_position": position, "_wild": wild, "_mutant": mutant}).where("_mutant is not null")
    rows = rows.withColumns({"_shown": F.col("_mutant"), "_base": F.col("_wild")})
    if "near_all" in variants.columns:
        merged = F.when(F.col("variant_type") == "missense", haplotypes.merged_change(change, F.col("codon_change"), F.col("near_codons"))).otherwise(change)
        # columns of their own, as what follows uses each several times
        rows = rows.withColumns({
            "_all": F.when(~shift, haplotypes.carrying(F.col("_wild"), F.col("near_all"))), "_change": merged, "_base": haplotypes.carrying(F.col("_wild"), F.col("near_germline")),
            "_shifted": F.when(shift, haplotypes.carrying(F.col("_mutant"), F.col("near_all"), F.col("_position"))),
        })
        rows = rows.withColumn("_shown", F.when(shift, F.col("_shifted")).otherwise(mutated_protein(F.col("_all"), F.col("_change"), F.col("_position"), F.col("_wild"))))
    windows = {
        "MT": F.when(shift, frameshift_window(F.col("_shown"), F.col("_position"), flank, downstream)).otherwise(changed_window(F.col("_mutant"), F.col("_wild"), flank, shown=F.col("_shown"))),
        "WT": F.when(shift, frameshift_window(F.col("_base"), F.col("_position"), flank, flank)).otherwise(centred(F.col("_base"), F.col("_position"), flank)),
    }
    each = F.explode(F.array(*[F.struct(F.concat(F.lit(side + "."), F.col("index")).alias("id"), w.alias("sequence")) for side, w in windows.items()])).alias("x")
    return rows.select(each).select("x.*").where("sequence <> ''")


def peptides_of(sequences: DataFrame, lengths: list[int], alleles: list[str]) -> DataFrame:
    """(side, index, allele, length, position, epitope): every peptide of the sequences, for every allele."""
    side, index = F.split_part("id", F.lit("."), F.lit(1)), F.expr("substring(id, instr(id, '.') + 1)")
    usable = sequences.where(F.col("sequence").rlike("^[ACDEFGHIKLMNPQRSTVWY]+$"))
    each = F.explode(every_kmer(F.col("sequence"), lengths)).alias("k")
    rows = usable.select(side.alias("side"), index.alias("index"), each, F.array(*[F.lit(a) for a in alleles]).alias("a"))
    return rows.select("side", "index", F.explode("a").alias("allele"), "k.length", "k.position", "k.epitope")


def run(variants: DataFrame, alleles: list[str], lengths: list[int], methods: list[str], o: Options, flank: int | None = None, store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df, phased: DataFrame | None = None) -> Results:
    """A whole run on annotated variants (with ``index``): neighbours of ``phased`` calls, windows, peptides, predictions, the epitope table, and its post-processing.

    Every peptide is predicted once for each allele and method, however many variants have it.
    ``store`` writes a step's table under a name and returns the written one, so that
    what follows doesn't compute it again: variants, sequences, scores and epitopes.
    """
    variants = store(variants, "variants")
    flank = flank if flank is not None else max(lengths) - 1
    if phased is not None:
        near = haplotypes.neighbours(variants, phased, 3 * flank)
        variants = store(haplotypes.with_neighbours(variants, near), "neighbours")
    sequences = store(variant_sequences(variants, flank), "sequences")
    peptides = peptides_of(sequences, lengths, alleles)
    scores = store(predictions.predict(peptides.select("allele", "length", "epitope"), methods), "scores")
    kinds = variants.select("index", "variant_type", F.abs(F.length(F.replace(F.split_part("amino_acid_change", F.lit("/"), F.lit(2)), F.lit("-"), F.lit(""))) - F.length(F.replace(F.split_part("amino_acid_change", F.lit("/"), F.lit(1)), F.lit("-"), F.lit("")))).alias("shift"))
    key = ["index", "allele", "length", "position", "epitope"]
    mutant = peptides.where("side = 'MT'").select(*key).join(kinds.fillna(0, ["shift"]), "index")
    table = epitope_table(mutant, peptides.where("side = 'WT'").select(*key), scores)
    return post_process(store(exported_epitopes(table, variants), "epitopes"), MATCHED, o, alleles)


def exported_epitopes(table: DataFrame, variants: DataFrame) -> DataFrame:
    """Summarised epitopes with their variants' columns, under the names of the exported table."""
    joined = predictions.joined_to_variants(table, variants)
    names = {
        "chromosome_name": "Chromosome", "start": "Start", "stop": "Stop", "reference": "Reference", "variant": "Variant", "transcript_name": "Transcript", "transcript_support_level": "Transcript Support Level", "transcript_length": "Transcript Length",
        "canonical": "Canonical", "mane_select": "MANE Select", "biotype": "Biotype", "transcript_cds_flags": "Transcript CDS Flags", "variant_type": "Variant Type", "amino_acid_change": "Mutation", "protein_position": "Protein Position", "gene_name": "Gene Name",
        "allele": "HLA Allele", "length": "Peptide Length", "position": "Sub-peptide Position", "epitope": "MT Epitope Seq", "wt_epitope": "WT Epitope Seq", "mutation_position": "Mutation Position", "index": "Index",
        "best_score_method": "Best MT IC50 Score Method", "best_score": "Best MT IC50 Score", "corresponding_wt_score": "Corresponding WT IC50 Score", "corresponding_fold_change": "Corresponding Fold Change", "best_percentile": "Best MT Percentile",
        "corresponding_wt_percentile": "Corresponding WT Percentile", "median_score": "Median MT IC50 Score", "median_wt_score": "Median WT IC50 Score", "median_fold_change": "Median Fold Change", "median_percentile": "Median MT Percentile", "median_wt_percentile": "Median WT Percentile",
        "tdna_depth": "Tumor DNA Depth", "tdna_vaf": "Tumor DNA VAF", "trna_depth": "Tumor RNA Depth", "trna_vaf": "Tumor RNA VAF", "normal_depth": "Normal Depth", "normal_vaf": "Normal VAF", "gene_expression": "Gene Expression", "transcript_expression": "Transcript Expression",
    }
    return joined.select(*[F.col(k).alias(v) for k, v in names.items() if k in joined.columns])


@dataclass(frozen=True)
class OrderLimits:
    """Up to which score or percentile a class's best peptide is marked in a peptide to order, and the residues that are hard to make."""

    one: tuple[float, float] = (1000.0, 2.0)
    two: tuple[float, float] = (500.0, 2.0)
    difficult: tuple[str, ...] = ()


def ordering_run(variants: DataFrame, class_one: DataFrame, class_two: DataFrame, called: tuple[DataFrame, DataFrame] | None = None, accepted: tuple[str, ...] = ("Accept",), flank: int = 25, limits: OrderLimits | None = None, phased: DataFrame | None = None) -> DataFrame:
    """The form for ordering the peptides of accepted variants, in its three stages.

    First the mutant sequences around the variants (index) of accepted rows of the
    class I report, with how hard they are to make; then both classes' reports
    (ID, Index, Evaluation, Best Peptide, ``IC50 MT``, ``%ile MT``) beside them, with
    ids that repeat numbered on and (``called``: two tables of ID) whether both
    callers have the variant; then every residue's marks: what the alignment with
    the wild type shows as changed, either class's best peptide if it binds, and
    ``limits.difficult`` residues.
    """
    limits = limits or OrderLimits()
    if phased is not None:
        variants = haplotypes.with_neighbours(variants, haplotypes.neighbours(variants, phased, 3 * flank))
    sequences = variant_sequences(variants, flank)
    index = F.expr("substring(id, instr(id, '.') + 1)").alias("Index")
    peptides = peptide_fasta(sequences, True, class_one, accepted).withColumn("Index", index).drop("id")
    wild = sequences.where("id like 'WT.%'").select(index, F.col("sequence").alias("_wild"))
    form = compare.ordering_form(filters.evaluation_filter(class_one, accepted), class_two, peptides).where("sequence is not null").join(wild, "Index", "left")
    if called is not None:
        form = compare.in_two_vcfs(form, *called, ["ID"])
    form = candidates.uniquified(form, "ID", ["ID", "Index"])

    def bound(name: str, most: tuple[float, float]) -> Column:
        peptide, at = F.col(f"Best Peptide {name}"), F.expr(f"instr(sequence, `Best Peptide {name}`)")
        value = lambda c: F.coalesce(F.col(f"`{c} {name}`").try_cast("double"), F.lit(float("inf")))
        binds = (value("IC50 MT") < most[0]) | (value("%ile MT") < most[1])
        return F.when(binds & (at > 0), F.sequence(at, at + F.length(peptide) - 1)).otherwise(F.array().cast("array<int>"))

    form = form.withColumn("_aligned", alignment.aligned(F.col("_wild"), F.col("sequence")))
    changed = F.coalesce(alignment.changed_places(F.col("_aligned")), F.array().cast("array<int>"))
    hard = F.filter(F.transform(letters(F.col("sequence")), lambda x, i: F.when(x.isin(*limits.difficult), i + 1)), lambda i: i.isNotNull()) if limits.difficult else F.array().cast("array<int>")
    return form.withColumn("styles", residue_styles(F.col("sequence"), changed, bound("Class I", limits.one), bound("Class II", limits.two), hard)).drop("_wild", "_aligned")
