"""Whole runs of splice junctions and gene fusions: from called events to filtered epitopes and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neolake.functions.sequences import every_kmer, frameshift_window
from neolake.operators import candidates, genomic, predictions, splicing
from neolake.plans.post import FUSION, SPLICE, Options, Results, post_process
from neolake.sources import fasta, transcripts

Store = Callable[[DataFrame, str], DataFrame]


def _kept(df: DataFrame, name: str) -> DataFrame:
    return df


def _summaries(peptides: DataFrame, keys: list[str], alleles: list[str], methods: list[str], store: Store) -> DataFrame:
    """Scores of the different peptides (epitope, length), each predicted once for an allele, summarised over the methods and joined to all rows."""
    asked = peptides.select("epitope", "length").distinct().select("epitope", "length", F.explode(F.array(*[F.lit(a) for a in alleles])).alias("allele"))
    scores = store(predictions.predict(asked, methods), "scores")
    none = F.lit(None).cast("double")
    best = predictions.summarise(scores.withColumns({"wt_score": none, "wt_percentile": none}), ["allele", "length", "epitope"])
    return peptides.select(*keys, "epitope", "length").join(best, ["epitope", "length"])


def _named(rows: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    scores = {
        "HLA Allele": "allele", "Peptide Length": "length", "Epitope Seq": "epitope", "Median IC50 Score": "median_score", "Best IC50 Score": "best_score", "Best IC50 Score Method": "best_score_method", "Median Percentile": "median_percentile",
        "Best Percentile": "best_percentile", "Best Percentile Method": "best_percentile_method",
    }
    return rows.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in (columns | scores).items()])


# --- splice junctions -------------------------------------------------------------------


def splice_inputs(junctions: DataFrame, gtf: DataFrame, variants: DataFrame, score: int = 10, distance: int = 100, anchors: tuple[str, ...] = ("A", "D", "NDA")) -> DataFrame:
    """Supported junctions with their transcripts' models and the variants beside them, under one ``index`` a junction, transcript and variant.

    ``variants``: annotated ones of every consequence, which meet a junction by their
    place (``chrom:start-stop``) and transcript.
    """
    kept = transcripts.filter_junctions(junctions, score, distance, anchors)
    models, _ = transcripts.junctions_with_models(kept, gtf.where("feature = 'transcript'").select("transcript_id", "transcript_biotype", "transcript_support_level", "gene_name").distinct())
    place = F.concat(F.col("chromosome_name"), F.lit(":"), F.col("start") - 1, F.lit("-"), F.col("stop"))
    told = variants.withColumns({"variant_info": place, "transcript_id": F.split("transcript_name", r"\.")[0]}).withColumnsRenamed({"start": "variant_start", "stop": "variant_stop", "transcript_support_level": "variant_tsl", "gene_name": "variant_gene"})
    found, _ = transcripts.junctions_with_variants(models, told, ["variant_info", "transcript_id"])
    return found.withColumn("index", F.concat_ws(".", "gene_name", "transcript_id", "name", "variant_info"))


def splice_kmers(proteins: DataFrame, lengths: list[int]) -> DataFrame:
    """(index, epitope, length, position): peptides of the alternate proteins that their wild type lacks, of known residues only."""
    side = lambda s: F.collect_list(F.when(F.col("side") == s, F.col("protein")))
    # both sides of a junction in one row: proteins are made once, and k-mers needn't be joined
    both = proteins.groupBy("index").agg(side("ALT").alias("_alt"), side("WT").alias("_wt"))
    fresh = F.filter(every_kmer(F.col("_a"), lengths), lambda x: ~F.exists("_wt", lambda w: F.contains(w, x["epitope"])))
    each = both.select("index", "_wt", F.explode("_alt").alias("_a")).select("index", F.explode(fresh).alias("k")).select("index", "k.*")
    return each.where(fasta.supported(F.col("epitope"))).groupBy("index", "epitope", "length").agg(F.max("position").alias("position"))


def splice_run(events: DataFrame, gtf: DataFrame, genome: DataFrame, substitutions: DataFrame, alleles: list[str], lengths: list[int], methods: list[str], o: Options, store: Store = _kept) -> Results:
    """A whole run on ``splice_inputs``: proteins either side of each junction, novel peptides, predictions, the epitope table, its post-processing.

    ``genome``: chrom, sequence; ``substitutions``: chrom, pos, alt of the sample.
    """
    events = store(events, "events")
    pieces = store(splicing.personal_pieces(splicing.genome_pieces(genome), substitutions), "pieces")
    asked = events.select("index", F.col("junction_chrom").alias("chrom"), "transcript_id", F.col("junction_start").alias("start"), F.col("junction_stop").alias("stop"), "anchor", "strand")
    proteins = store(splicing.junction_proteins(asked, splicing.coding_exons(gtf), pieces), "proteins")
    novel = store(splice_kmers(proteins, lengths), "kmers")
    best = _summaries(novel, ["index", "position"], alleles, methods, store)
    length = proteins.where("side = 'WT'").select("index", F.length("protein").alias("wt_length"))
    rows = best.join(length, "index").withColumn("_event", F.regexp_replace("index", r"\.(inframe|frameshift)_splice_site$", "")).join(events.withColumnRenamed("index", "_event").dropDuplicates(["_event"]), "_event")
    optional = {
        "Chromosome": "chromosome_name", "Start": "variant_start", "Stop": "variant_stop", "Reference": "reference", "Variant": "variant", "Canonical": "canonical", "MANE Select": "mane_select", "Transcript Support Level": "transcript_support_level", "Biotype": "transcript_biotype",
        "Amino Acid Change": "amino_acid_change", "Tumor DNA Depth": "tdna_depth", "Tumor DNA VAF": "tdna_vaf", "Tumor RNA Depth": "trna_depth", "Tumor RNA VAF": "trna_vaf", "Normal Depth": "normal_depth", "Normal VAF": "normal_vaf",
        "Gene Expression": "gene_expression", "Transcript Expression": "transcript_expression",
    }
    shown = {k: v for k, v in optional.items() if v in rows.columns}
    table = _named(rows, {"Junction": "name", "Junction Start": "junction_start", "Junction Stop": "junction_stop", "Junction Score": "score", "Junction Anchor": "anchor", "Transcript": "transcript_id", "Gene Name": "gene_name", "Index": F.concat_ws(".", "index", "position"), "Protein Position": "position", "WT Protein Length": "wt_length"} | shown)
    return post_process(store(table, "epitopes"), SPLICE, o, alleles)


# --- fusions ----------------------------------------------------------------------------


def called_fusions(fusions: DataFrame, star: DataFrame | None = None) -> DataFrame:
    """Fusion rows of ``transcripts.read_arriba``: breakpoints, names, the sequence without its signs, where it joins, support, expression, ``index``.

    The bar in a peptide marks the joint; a row without one is an error. ``star``
    (``transcripts.read_star_fusion``) gives expression by equal breakpoints.
    """
    joint = F.instr("peptide", "|") - 1
    missing = F.raise_error(F.concat(F.lit("no joint in the fusion sequence of "), "gene_name")).cast("int")
    rows = fusions.select(*_BREAKS, "gene_name", "transcript_name", "variant_type", "peptide", "read_support")
    rows = _in_ranges(rows, star) if star is not None else rows.withColumn("star_expression", F.lit(None).cast("double"))
    # joints are looked for where the rows lie, so that a sequence is dealt once
    rows = rows.withColumn("protein_position", F.when(joint >= 0, joint).otherwise(missing)).withColumn("fusion_amino_acid_sequence", F.regexp_replace("peptide", r"[|*]", ""))
    return _indexed(rows, ranged=star is not None)


def assembled_fusions(proteins: DataFrame, exons: DataFrame, star: DataFrame | None = None) -> DataFrame:
    """The same from proteins (genes, transcripts, effect, sequence with ``*`` at the joint) and exon tables.

    Breakpoints are the ends of either gene's exons; the caller's strand tells which
    end of an exon range lies at the joint: on the plus strand the last place of
    the first gene and the first of the second, on minus the other way round.
    """
    extents = transcripts.exon_extents(exons).withColumn("transcripts", F.concat_ws("-", "5'_transcript", "3'_transcript"))
    joint = F.instr("sequence", "*") - 1
    missing = F.raise_error(F.concat(F.lit("no joint in the fusion sequence of "), "genes")).cast("int")
    unknown = F.raise_error(F.concat(F.lit("unknown effect "), "effect")).cast("string")
    kind = F.when(F.col("effect").isin("in-frame", "in-frame (with mutation)"), "inframe_fusion").when(F.col("effect") == "out-of-frame", "frameshift_fusion").otherwise(unknown)
    rows = proteins.withColumn("transcripts", F.replace("transcripts", F.lit("_"), F.lit("-"))).join(extents, "transcripts")
    rows = rows.withColumns({"protein_position": F.when(joint >= 0, joint).otherwise(missing), "fusion_amino_acid_sequence": F.upper(F.replace("sequence", F.lit("*"), F.lit(""))), "variant_type": kind}).withColumnsRenamed({"genes": "gene_name", "transcripts": "transcript_name"})
    if star is None:
        return _indexed(rows.withColumns({"left_pos": F.col("left_start"), "right_pos": F.col("right_start"), "star_expression": F.lit(None).cast("double"), "read_support": F.lit(None).cast("int")}))
    # one look-up for each choice of strands, with the strands that the other caller gives
    out = None
    for left in "+-":
        for right in "+-":
            own = star.where((F.col("left_strand") == left) & (F.col("right_strand") == right))
            part = transcripts.with_star_support(transcripts.fusion_breakpoints(rows.withColumns({"left_strand": F.lit(left), "right_strand": F.lit(right)})), own).where("star_reads is not null")
            out = part if out is None else out.unionByName(part)
    first = out.groupBy("transcript_name", "gene_name").agg(F.max(F.struct("star_reads", "star_expression", "left_pos", "right_pos")).alias("_s"))
    rows = rows.join(first, ["transcript_name", "gene_name"], "left")
    return _indexed(rows.withColumns({"read_support": F.col("_s.star_reads"), "star_expression": F.col("_s.star_expression"), "left_pos": F.coalesce("_s.left_pos", "left_start"), "right_pos": F.coalesce("_s.right_pos", "right_start")}).drop("_s"))


_BREAKS = ["left_chrom", "left_pos", "right_chrom", "right_pos"]


def _in_ranges(rows: DataFrame, star: DataFrame) -> DataFrame:
    """``transcripts.with_star_support`` of rows that come to lie in ranges of their breakpoints: calls of both kinds are dealt together, once, instead of joined and then sorted."""
    told = transcripts.bare(star).where(" and ".join(f"{x} is not null" for x in _BREAKS)).select(*_BREAKS, F.struct("read_support", "expression").alias("_star"))
    both = transcripts.bare(rows).withColumn("_own", F.lit(True)).unionByName(told.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    best = F.max("_star").over(Window.partitionBy(*_BREAKS))
    return both.repartitionByRange(*[F.asc_nulls_last(x) for x in _BREAKS]).withColumn("star_expression", best["expression"]).where("_own").drop("_own", "_star")


def _indexed(rows: DataFrame, ranged: bool = False) -> DataFrame:
    """Numbered in order of their breakpoints and transcripts; a number, names, kind and joint make the index."""
    shown = [*_BREAKS, "gene_name", "transcript_name", "variant_type", "protein_position", "fusion_amino_acid_sequence", "read_support", "star_expression"]
    order = [*_BREAKS, "gene_name", "transcript_name", "variant_type", "fusion_amino_acid_sequence", "protein_position", "read_support"]
    rows = candidates.with_row_number(rows.select(*shown), [F.asc_nulls_last(x) for x in order], "_n", ranged)
    pair = lambda a, b: F.concat_ws(" / ", F.coalesce(F.col(a).cast("string"), F.lit("NA")), F.coalesce(F.col(b).cast("string"), F.lit("NA")))
    index = F.concat_ws(".", F.col("_n").cast("string"), "gene_name", "transcript_name", "variant_type", F.col("protein_position").cast("string"))
    return rows.select(index.alias("index"), pair("left_chrom", "right_chrom").alias("chromosome_name"), pair("left_pos", "right_pos").alias("start"), "gene_name", "transcript_name", "variant_type", "protein_position", "fusion_amino_acid_sequence", "read_support", F.col("star_expression").alias("expression"))


def fusion_sequences(fusions: DataFrame, flank: int, downstream: int | None = 1000, shortest: int = 0, trim: bool = False) -> DataFrame:
    """(index, sequence) around each joint: to ``flank`` residues after it in frame, to ``downstream`` (null: the end) out of frame.

    A last X goes. Sequences with unknown residues go, or (``trim``) lose what
    lies beyond them; so do those under ``shortest``.
    """
    joint, whole = F.col("protein_position"), F.col("fusion_amino_acid_sequence")
    first = F.greatest(joint - flank, F.lit(0)) + 1
    inframe = whole.substr(first.cast("int"), F.greatest(joint + flank - first + 1, F.lit(0)).cast("int"))
    shifted = frameshift_window(whole, joint + 1, flank, None if downstream is None else downstream - 1)
    cut = F.regexp_replace(F.when(F.col("variant_type") == "inframe_fusion", inframe).otherwise(shifted), "X$", "")
    rows = fusions.where(F.col("variant_type").isin("inframe_fusion", "frameshift_fusion")).select("index", cut.alias("sequence"))
    rows = rows.withColumn("sequence", fasta.trim_unsupported(F.col("sequence"))) if trim else rows.where(fasta.supported(F.col("sequence")))
    return rows.where((F.length("sequence") >= shortest) & (F.col("sequence") != ""))


def fusion_run(fusions: DataFrame, alleles: list[str], lengths: list[int], methods: list[str], o: Options, flank: int | None = None, store: Store = _kept) -> Results:
    """A whole run on ``called_fusions`` or ``assembled_fusions``: windows, peptides, predictions, the epitope table with its fusions' columns, its post-processing."""
    fusions = store(fusions, "fusions")
    sequences = store(fusion_sequences(fusions, flank if flank is not None else max(lengths) - 1, shortest=min(lengths)), "sequences")
    each = F.explode(every_kmer(F.col("sequence"), lengths)).alias("k")
    peptides = sequences.select("index", each).select("index", "k.position", "k.length", "k.epitope")
    best = _summaries(peptides, ["index", "position"], alleles, methods, store)
    rows = best.join(fusions.drop("fusion_amino_acid_sequence", "protein_position"), "index")
    table = _named(rows, {"Mutation": "index", "Sub-peptide Position": "position", "Chromosome": "chromosome_name", "Start": "start", "Stop": F.lit(None).cast("string"), "Gene Name": "gene_name", "Transcript": "transcript_name", "Variant Type": "variant_type", "Read Support": "read_support", "Expression": "expression"})
    return post_process(store(table, "epitopes"), FUSION, o, alleles)
