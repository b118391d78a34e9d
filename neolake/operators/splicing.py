"""From splice junctions to alternate and wild-type proteins: exon arrays, look-ups in a genome by interval, translation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.sequences import let, reverse_complement, translate_dna
from neolake.operators.genomic import overlap_join

#: Bases of a piece of a chromosome.
PIECE = 4096


def coding_exons(gtf: DataFrame) -> DataFrame:
    """(transcript_id, exons): each transcript's coding exons (start, stop) by start."""
    exon = F.struct(F.col("cds_start").cast("int").alias("start"), F.col("cds_stop").cast("int").alias("stop"))
    return gtf.where("feature = 'CDS'").groupBy("transcript_id").agg(F.array_sort(F.collect_set(exon)).alias("exons"))


def alternate_exons(exons: Column, start: Column, stop: Column, anchor: Column, strand: Column) -> Column:
    """A transcript's exons after a junction from ``start`` to ``stop``, null where the junction doesn't fit it.

    Of a new acceptor (A) or donor (D) the known side has to be an exon's border.
    The other side becomes the border of the exon whose body or following intron
    it lies in, seen from the known side; it mustn't be where an exon's same border
    is already. Exons between the two stay. Of skipped exons (NDA) both sides have
    to be borders, and the exons between go.
    """
    reverse = ((anchor == "A") & (strand == "+")) | ((anchor == "D") & (strand == "-"))
    forward = ((anchor == "D") & (strand == "+")) | ((anchor == "A") & (strand == "-"))
    has = lambda side, at: F.exists(exons, lambda e: e[side] == at)
    moved = lambda cond, side, at: F.transform(exons, lambda e: F.when(cond(e), e.withField(side, at)).otherwise(e))
    before = F.array_max(F.transform(F.filter(exons, lambda e: e["start"] < start), lambda e: e["start"]))
    after = F.array_min(F.transform(F.filter(exons, lambda e: e["stop"] > stop), lambda e: e["stop"]))
    skipped = F.filter(exons, lambda e: ~((e["start"] > start) & (e["stop"] < stop)))
    out = F.when((anchor == "NDA") & has("stop", start) & has("start", stop), skipped)
    out = out.when(reverse & has("start", stop) & before.isNotNull() & ~has("start", start), moved(lambda e: e["start"] == before, "stop", start))
    return out.when(forward & has("stop", start) & after.isNotNull() & ~has("stop", stop), moved(lambda e: e["stop"] == after, "start", stop))


def genome_pieces(genome: DataFrame) -> DataFrame:
    """(chrom, start, stop, piece) of (chrom, sequence): pieces of PIECE bases, places from 1."""
    pieces = F.posexplode(F.regexp_extract_all("sequence", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))).alias("n", "piece")
    cut = genome.select("chrom", pieces).withColumn("start", F.col("n") * PIECE + 1)
    return cut.select("chrom", "start", (F.col("start") + F.length("piece") - 1).alias("stop"), "piece")


def personal_pieces(pieces: DataFrame, substitutions: DataFrame) -> DataFrame:
    """Pieces with a sample's single-base changes (chrom, pos, alt); of several at one place the first alternate."""
    at = substitutions.select("chrom", "pos", F.upper("alt").alias("alt")).groupBy("chrom", "pos").agg(F.min("alt").alias("alt"))
    at = at.withColumn("start", F.floor((F.col("pos") - 1) / PIECE) * PIECE + 1).groupBy("chrom", "start").agg(F.array_sort(F.collect_list(F.struct("pos", "alt"))).alias("_new"))
    put = F.aggregate("_new", F.col("piece"), lambda s, x: F.overlay(s, x["alt"], (x["pos"] - F.col("start") + 1).cast("int"), F.lit(1)))
    return pieces.join(at, ["chrom", "start"], "left").withColumn("piece", F.when(F.col("_new").isNull(), F.col("piece")).otherwise(put)).drop("_new")


def exon_sequences(exons: DataFrame, pieces: DataFrame) -> DataFrame:
    """(chrom, start, stop, sequence) of the different (chrom, start, stop), from the pieces that they touch."""
    asked = exons.select("chrom", F.col("start").alias("_start"), F.col("stop").alias("_stop")).distinct()
    met = overlap_join(asked, pieces, ["chrom"], ("_start", "_stop"), ("start", "stop"), PIECE)
    first, last = F.greatest("_start", "start"), F.least("_stop", "stop")
    part = F.substr("piece", (first - F.col("start") + 1).cast("int"), (last - first + 1).cast("int"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", part.alias("part")))), lambda x: x["part"]), "")
    return met.groupBy("chrom", F.col("_start").alias("start"), F.col("_stop").alias("stop")).agg(joined.alias("sequence"))


def junction_proteins(junctions: DataFrame, exons: DataFrame, pieces: DataFrame) -> DataFrame:
    """(index, side, dna, protein, frameshift) of the alternate (ALT) and wild-type (WT) proteins of (index, chrom, transcript_id, start, stop, anchor, strand).

    Sequences are those of the plus strand in order of their places, turned for the
    minus strand, translated to the first stop, a rest of one or two bases counting
    as a codon. Only junctions both of whose proteins begin with M are there, under
    ``index`` with ``inframe_splice_site`` or ``frameshift_splice_site`` behind it,
    by the alternate's length.
    """
    known = junctions.select("index", "chrom", "transcript_id", "start", "stop", "anchor", "strand").dropDuplicates(["index"]).join(exons, "transcript_id")
    known = known.withColumn("_alt", alternate_exons(F.col("exons"), F.col("start"), F.col("stop"), F.col("anchor"), F.col("strand"))).where("_alt is not null")
    sides = F.explode(F.array(F.struct(F.lit("ALT").alias("side"), F.col("_alt").alias("exons")), F.struct(F.lit("WT").alias("side"), F.col("exons").alias("exons")))).alias("s")
    rows = known.select("index", "chrom", "strand", sides).select("index", "chrom", "strand", "s.side", F.explode("s.exons").alias("e"))
    rows = rows.select("index", "chrom", "strand", "side", "e.start", "e.stop").where("start <= stop")
    found = rows.join(exon_sequences(rows, pieces), ["chrom", "start", "stop"])
    plus = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "sequence"))), lambda x: x["sequence"]), "")
    dna = found.groupBy("index", "strand", "side").agg(plus.alias("_plus")).withColumn("dna", F.when(F.col("strand") == "-", reverse_complement(F.col("_plus"))).otherwise(F.col("_plus")))
    both = dna.groupBy("index").agg(*[F.max(F.when(F.col("side") == x, F.col("dna"))).alias(x) for x in ("ALT", "WT")])
    both = both.withColumns({f"{x}_protein": let(translate_dna(F.col(x), padded=True), lambda p: F.when(F.startswith(p, F.lit("M")), p)) for x in ("ALT", "WT")}).where("ALT_protein is not null and WT_protein is not null")
    frame = F.length("ALT") % 3 != 0
    name = F.concat_ws(".", "index", F.when(frame, "frameshift_splice_site").otherwise("inframe_splice_site"))
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), F.col(x).alias("dna"), F.col(f"{x}_protein").alias("protein")) for x in ("ALT", "WT")])).alias("p")
    return both.select(name.alias("index"), each, frame.alias("frameshift")).select("index", "p.side", "p.dna", "p.protein", "frameshift")
