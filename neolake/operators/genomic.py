"""Interval joins, proximal variants, splice sequences and novel k-mers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neolake.functions.sequences import kmers, reverse_complement, translate_dna


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], place: str, other: str, distance: int) -> DataFrame:
    """Pairs with equal keys whose places differ by ``distance`` or less.

    Places are cut into bins of the distance; the left side goes to three bins, so
    that the join is an equality, and pairs are then compared.
    """
    width = max(1, distance)
    bin_of = lambda c: F.floor(F.col(c) / width)
    near = left.withColumn("_bin", F.explode(F.array(*[bin_of(place) + d for d in (-1, 0, 1)])))
    return near.join(right.withColumn("_bin", bin_of(other)), [*keys, "_bin"]).where(F.abs(F.col(place) - F.col(other)) <= distance).drop("_bin")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], left_ends: tuple[str, str], right_ends: tuple[str, str], width: int) -> DataFrame:
    """Pairs with equal keys whose intervals (ends included) share a place.

    Both sides go to all bins of ``width`` that they touch, and a pair counts in the
    first bin that both have; equality joins only.
    """
    bins = lambda ends: F.explode(F.sequence(F.floor(F.col(ends[0]) / width), F.floor(F.greatest(*map(F.col, ends)) / width)))
    pairs = left.withColumn("_bin", bins(left_ends)).join(right.withColumn("_bin", bins(right_ends)), [*keys, "_bin"])
    later = F.greatest(F.col(left_ends[0]), F.col(right_ends[0]))
    shared = later <= F.least(F.col(left_ends[1]), F.col(right_ends[1]))
    return pairs.where(shared & (F.col("_bin") == F.floor(later / width))).drop("_bin")


def in_phase(somatic: Column, neighbour: Column, homozygous: Column) -> Column:
    """Phased genotypes share a haplotype with the alternate, or the neighbour is on both."""
    hap = lambda g: F.split(g, r"\|")
    shares = F.exists(F.sequence(F.lit(0), F.lit(1)), lambda i: (F.get(hap(somatic), i) != "0") & (F.get(hap(neighbour), i) != "0"))
    return F.coalesce(homozygous, F.lit(False)) | (F.contains(somatic, F.lit("|")) & F.contains(neighbour, F.lit("|")) & F.coalesce(shares, F.lit(False)))


def proximal_variants(somatic: DataFrame, phased: DataFrame, flank_bases: int) -> DataFrame:
    """Variants near a somatic one on the same haplotype: somatic (main_somatic_variant, chrom, pos, genotype), phased (chrom, near_pos, near_genotype, ...)."""
    pairs = interval_join(somatic, phased, ["chrom"], "pos", "near_pos", flank_bases).where("pos <> near_pos")
    both = F.col("near_genotype").rlike(r"^([1-9])[|/]\1$")
    return pairs.where(in_phase(F.col("genotype"), F.col("near_genotype"), both))


def spliced_protein(exons: DataFrame, keys: list[str], strand: str = "strand", sequence: str = "exon_sequence", order: str = "cds_start") -> DataFrame:
    """(keys, dna, protein, frameshift): exons joined in genomic order, reversed on the minus strand, translated to the first stop; only what starts with M."""
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, sequence))), lambda x: x[sequence]), "")
    out = exons.groupBy(*keys, strand).agg(parts.alias("_plus"))
    out = out.withColumn("dna", F.when(F.col(strand) == "-", reverse_complement(F.col("_plus"))).otherwise(F.col("_plus"))).drop("_plus")
    return out.withColumn("protein", translate_dna(F.col("dna"))).withColumn("frameshift", F.length("dna") % 3 != 0).where("protein like 'M%'")


def alternate_exons(exons: DataFrame, keys: list[str]) -> DataFrame:
    """A junction's exon set after it: rows (keys, cds_start, cds_stop, anchor, strand, junction_start, junction_stop).

    An alternative donor or acceptor moves the boundary of the exon next to the
    junction; exons inside the junction (skipped ones) go. Transcripts where the
    junction's known side is no exon boundary give nothing.
    """
    w = Window.partitionBy(*keys)
    left_known, right_known = F.max((F.col("cds_stop") == F.col("junction_start")).cast("int")).over(w), F.max((F.col("cds_start") == F.col("junction_stop")).cast("int")).over(w)
    df = exons.withColumns({"_l": left_known, "_r": right_known})
    both = (F.col("_l") == 1) & (F.col("_r") == 1)
    df = df.where(F.when(F.col("anchor") == "NDA", both).otherwise((F.col("_l") == 1) | (F.col("_r") == 1)))
    inside = (F.col("cds_start") > F.col("junction_start")) & (F.col("cds_stop") < F.col("junction_stop"))
    df = df.where(~inside)
    # the exon on the side that isn't a known boundary: the last one to start before, or the first to end after
    before = F.max(F.when(F.col("cds_start") < F.col("junction_start"), F.col("cds_start"))).over(w)
    after = F.min(F.when(F.col("cds_stop") > F.col("junction_stop"), F.col("cds_stop"))).over(w)
    stop = F.when((F.col("_l") == 0) & (F.col("cds_start") == before), F.col("junction_start")).otherwise(F.col("cds_stop"))
    start = F.when((F.col("_r") == 0) & (F.col("cds_stop") == after), F.col("junction_stop")).otherwise(F.col("cds_start"))
    return df.withColumns({"cds_start": start, "cds_stop": stop}).where("cds_start <= cds_stop").drop("_l", "_r")


def novel_kmers(alternate: DataFrame, wildtype: DataFrame, key: str, k: int) -> DataFrame:
    """(key, kmer, position): k-mers of the alternate proteins that the wild type of the same key lacks; of a repeated one the last place."""
    explode = lambda df: df.select(key, F.explode(kmers(F.col("protein"), k)).alias("k")).select(key, "k.kmer", "k.position")
    fresh = explode(alternate).join(explode(wildtype), [key, "kmer"], "left_anti")
    return fresh.groupBy(key, "kmer").agg(F.max("position").alias("position"))


def kmer_ids(novel: DataFrame, key: str) -> DataFrame:
    """(kmer, ids): each k-mer once, with its sorted ids."""
    return novel.groupBy("kmer").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(".", F.col(key).cast("string"), F.col("position").cast("string")))), ",").alias("ids"))


def is_novel(mutant: Column, wildtype: Column, k: int) -> Column:
    """Some k-mer of the mutant isn't in the wild type."""
    return ~F.forall(kmers(mutant, k), lambda x: F.contains(wildtype, x["kmer"]))
