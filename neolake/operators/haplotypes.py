"""Phased neighbours of a variant, and the proteins that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.sequences import merged_codon, translate_dna
from neolake.operators.genomic import overlap_join
from neolake.sources import vcf

SITE = ["chromosome_name", "start", "reference", "variant"]
CHANGES = "array<struct<position:int,wild:string,mutant:string>>"


def phased_missense(calls: DataFrame, fields: list[str], sample: str, pass_only: bool = False) -> DataFrame:
    """Rows of a phased VCF (``vcf.read_vcf``) as substitutions by transcript: SITE, stop, transcript_name, the changes, ``phase`` (HP), ``homozygous``.

    Every alternate of the file is there, so that a somatic variant finds its phase;
    only substitutions with a protein position have a transcript.
    """
    rows = vcf.explode_alternates(calls.where(F.col("filter").isin("PASS", ".")) if pass_only else calls)
    call = F.col("calls")[sample]
    sides = F.split(F.regexp_replace(call["GT"], r"\|", "/"), "/")
    same = F.forall(sides, lambda x: (x == sides[0]) & ~x.isin("0", "."))
    site = [F.col("chrom").alias("chromosome_name"), F.col("pos").alias("start"), (F.col("pos") + F.length("ref") - 1).alias("stop"), F.col("ref").alias("reference"), F.col("alternate").alias("variant")]
    rows = rows.withColumns({"phase": F.nullif(F.nullif(call["HP"], F.lit(".")), F.lit("")), "homozygous": F.coalesce(same, F.lit(False))})
    each = vcf.explode_transcripts(rows, fields)
    place = F.split(F.col("csq")["Protein_position"], "/")
    at = F.nullif(F.when(place[0] != "-", place[0]).otherwise(F.try_element_at(place, F.lit(2))), F.lit("-"))
    missense = F.array_contains(F.split(F.lower(F.col("csq")["Consequence"]), "&"), "missense_variant") & at.isNotNull()
    told = each.where(missense).select(*site, F.col("csq")["Feature"].alias("transcript_name"), F.col("csq")["Amino_acids"].alias("amino_acid_change"), F.col("csq")["Codons"].alias("codon_change"), at.alias("protein_position"), "phase", "homozygous")
    return told.unionByName(rows.select(*site, "phase", "homozygous"), allowMissingColumns=True)


def neighbours(somatic: DataFrame, phased: DataFrame, flank_bases: int) -> DataFrame:
    """(index, protein_position, start, amino_acid_change, codon_change, kind) of the substitutions near somatic variants on their haplotype.

    ``somatic``: index, SITE, stop, transcript_name; ``phased``: see
    ``phased_missense``. Where the somatic variant and its neighbour both have a
    phase these are equal; a neighbour without one is homozygous. A variant that
    the phased calls lack has no neighbours. ``kind`` is somatic where the somatic
    calls have a variant at the neighbour's place, else germline.
    """
    known = phased.select(*SITE, F.col("phase").alias("own_phase")).groupBy(*SITE).agg(F.max("own_phase").alias("own_phase"))
    main = somatic.select("index", *SITE, "stop", "transcript_name").join(known, SITE)
    main = main.withColumns({"first": F.col("start") - flank_bases, "last": F.col("stop") + flank_bases}).withColumnsRenamed({c: f"own_{c}" for c in ("start", "reference", "variant", "stop")})
    near = phased.where("transcript_name is not null")
    pairs = overlap_join(main, near, ["chromosome_name", "transcript_name"], ("first", "last"), ("start", "stop"), 2 * flank_bases + 1)
    other = (F.col("start") != F.col("own_start")) | (F.col("reference") != F.col("own_reference")) | (F.col("variant") != F.col("own_variant"))
    shared = F.when(F.col("own_phase").isNotNull() & F.col("phase").isNotNull(), F.col("own_phase") == F.col("phase")).otherwise(F.col("phase").isNull() & F.col("homozygous") | F.col("own_phase").isNull() & F.col("homozygous"))
    places = somatic.select("chromosome_name", "start").distinct().withColumn("kind", F.lit("somatic"))
    out = pairs.where(other & shared).join(places, ["chromosome_name", "start"], "left")
    return out.select("index", "protein_position", "start", "amino_acid_change", "codon_change", F.coalesce("kind", F.lit("germline")).alias("kind")).distinct()


def _first(position: Column) -> Column:
    return F.split(position, "-")[0].cast("int")


def with_neighbours(variants: DataFrame, near: DataFrame) -> DataFrame:
    """``variants`` with the changes of their neighbours: ``near_all`` and ``near_germline`` by place, and ``near_codons``, the codon changes at the variant's own place.

    Several changes of one codon are merged, in order of their starts. Only
    changes of as many residues as they replace count.
    """
    part = lambda k: F.split_part("amino_acid_change", F.lit("/"), F.lit(k))
    entry = F.struct("start", "codon_change", part(1).alias("wild"), part(2).alias("mutant"))
    listed = lambda cond: F.array_sort(F.collect_list(F.when(cond, entry)))
    places = near.groupBy("index", "protein_position").agg(listed(F.lit(True)).alias("all"), listed(F.col("kind") == "germline").alias("germline"))

    def change(found: Column) -> Column:
        several = translate_dna(merged_codon(F.transform(found, lambda x: x["codon_change"])), whole=True)
        mutant = F.when(F.size(found) == 1, found[0]["mutant"]).otherwise(several)
        wild = found[0]["wild"]
        return F.when((F.size(found) > 0) & (F.length(wild) == F.length(mutant)), F.struct(_first(F.col("protein_position")).alias("position"), wild.alias("wild"), mutant.alias("mutant")))

    each = places.select("index", "protein_position", change(F.col("all")).alias("a"), change(F.col("germline")).alias("g"), F.transform("all", lambda x: x["codon_change"]).alias("codons"))
    own = each.groupBy("index").agg(F.array_sort(F.collect_list("a")).alias("near_all"), F.array_sort(F.collect_list("g")).alias("near_germline"), F.map_from_entries(F.collect_list(F.struct("protein_position", "codons"))).alias("_codons"))
    out = variants.join(own, "index", "left").withColumn("near_codons", F.try_element_at("_codons", F.col("protein_position")))
    return out.drop("_codons").withColumns({c: F.coalesce(c, F.array().cast(CHANGES)) for c in ("near_all", "near_germline")})


def carrying(protein: Column, changes: Column, upto: Column | None = None) -> Column:
    """A protein with changes laid over it, those that begin before ``upto`` if that is given; residues that aren't there are an error."""

    def put(s: Column, x: Column) -> Column:
        at, size = x["position"], F.length(x["wild"])
        fits = s.substr(at, size) == x["wild"]
        wrong = F.raise_error(F.concat(F.lit("a neighbour's wild residues "), x["wild"], F.lit(" aren't at place "), at.cast("string"))).cast("string")
        return F.when(fits, F.overlay(s, x["mutant"], at, size)).otherwise(wrong)

    used = changes if upto is None else F.filter(changes, lambda x: x["position"] < upto)
    return F.aggregate(used, protein, put)


def merged_change(change: Column, codon: Column, near_codons: Column) -> Column:
    """``wild/mutant`` of a substitution together with its neighbours in the same codon."""
    merged = translate_dna(merged_codon(F.array_append(near_codons, codon)), whole=True)
    return F.when(near_codons.isNull() | codon.isNull(), change).otherwise(F.concat_ws("/", F.split_part(change, F.lit("/"), F.lit(1)), merged))
