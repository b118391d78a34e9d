"""VEP-annotated VCF files as one row for each variant, alternate and transcript."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIXED = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format"]


def header(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Sample names and the fields of the CSQ annotation; reads only header lines."""
    lines = [r["value"] for r in spark.read.text(path).where("value like '#CHROM%' or value like '##INFO=<ID=CSQ%'").collect()]
    samples = next((x.split("\t")[9:] for x in lines if x.startswith("#CHROM")), [])
    csq = next((x for x in lines if x.startswith("##INFO")), None)
    found = re.search(r'Format: ([^">]*)', csq) if csq else None
    if csq and not found:
        raise ValueError("the CSQ header has no format")
    return samples, found.group(1).split("|") if found else []


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """The records of a VCF file, see ``records``."""
    samples, _ = header(spark, path)
    return records(spark.read.text(path), samples)


def records(lines: DataFrame, samples: list[str]) -> DataFrame:
    """Records of lines of text (``value``): fixed columns, ``alts`` as an array, and a map of each sample's genotype fields in ``calls``; header and empty lines go."""
    cells = F.split("value", "\t")
    df = lines.where("value not like '#%' and trim(value) <> ''").select(*[F.try_element_at(cells, F.lit(i + 1)).alias(c) for i, c in enumerate(FIXED)], cells.alias("_cells"))
    keys = F.split("format", ":")

    def call(i: int) -> Column:
        values = F.split(F.try_element_at("_cells", F.lit(10 + i)), ":")
        return F.map_from_arrays(F.slice(keys, 1, F.least(F.size(keys), F.size(values))), F.slice(values, 1, F.least(F.size(keys), F.size(values))))

    calls = F.create_map(*[x for i, s in enumerate(samples) for x in (F.lit(s), call(i))]) if samples else F.lit(None).cast("map<string,map<string,string>>")
    return df.withColumn("pos", F.col("pos").cast("int")).withColumn("alts", F.split("alt", ",")).withColumn("calls", calls).drop("_cells")


def info_value(key: str) -> Column:
    return F.nullif(F.regexp_extract("info", rf"(?:^|;){re.escape(key)}=([^;]*)", 1), F.lit(""))


def csq_allele(ref: Column, alt: Column) -> Column:
    """An alternate as the annotation writes it: without the first shared base where lengths differ, ``-`` if nothing is left."""
    indel = (F.length(ref) != F.length(alt)) & (F.substring(ref, 1, 1) == F.substring(alt, 1, 1))
    rest = alt.substr(F.lit(2), F.length(alt))
    return F.when(~indel, alt).when(rest == "", "-").otherwise(rest)


def explode_alternates(df: DataFrame) -> DataFrame:
    return df.select("*", F.posexplode("alts").alias("alt_index", "alternate")).withColumn("csq_allele", csq_allele(F.col("ref"), F.col("alternate")))


def explode_transcripts(df: DataFrame, fields: list[str]) -> DataFrame:
    """A row for each annotation of the alternate, as a map ``csq`` from field to value (empty: null)."""
    entries = F.explode(F.split(info_value("CSQ"), ","))
    names = F.array(*[F.lit(f) for f in fields])

    def as_map(e: Column) -> Column:
        values = F.transform(F.split(e, r"\|"), lambda v: F.nullif(v, F.lit("")))
        return F.map_from_arrays(F.slice(names, 1, F.least(F.size(names), F.size(values))), F.slice(values, 1, F.least(F.size(names), F.size(values))))

    out = df.withColumn("_entry", entries)
    return out.withColumn("csq", as_map(F.col("_entry"))).drop("_entry").where(F.coalesce(F.col("csq")["Allele"], F.lit("-")) == F.col("csq_allele"))


def called(sample: str, pass_only: bool = False) -> Column:
    """The alternate is in the sample's genotype (and the record passed, if asked)."""
    genotype = F.split(F.regexp_replace(F.col("calls")[sample]["GT"], r"\|", "/"), "/")
    hit = F.array_contains(genotype, (F.col("alt_index") + 1).cast("string"))
    ok = F.coalesce(hit, F.lit(False))
    return ok & F.col("filter").isin("PASS", ".") if pass_only else ok


def consequence(terms: Column, ref: Column, alt: Column) -> Column:
    """FS, missense, inframe_ins, inframe_del or null of an annotation's consequence terms."""
    sep = F.when(F.contains(terms, F.lit("&")), F.split(F.lower(terms), "&")).otherwise(F.split(F.lower(terms), r"\."))
    has = lambda x: F.array_contains(sep, x)
    change = F.length(alt) - F.length(ref)
    altering = F.when(change % 3 != 0, None).when(change > 0, "inframe_ins").when(change < 0, "inframe_del")
    kinds = [("frameshift_variant", "FS"), ("missense_variant", "missense"), ("inframe_insertion", "inframe_ins"), ("inframe_deletion", "inframe_del")]
    out = F.when(has("start_lost") | has("stop_retained_variant"), F.lit(None).cast("string"))
    for term, kind in kinds:
        out = out.when(has(term), kind)
    return out.when(has("protein_altering_variant"), altering)


def _number(text: Column) -> Column:
    return F.nullif(F.nullif(text, F.lit(".")), F.lit("")).try_cast("double")


def vaf(call: Column, alt_index: Column, n_alts: Column, af: str = "AF", ad: str = "AD", dp: str = "DP") -> Column:
    """Allele fraction: the AF tag, else AD over DP; lists are by alternate, AD maybe with the reference first."""
    fractions, depths = F.split(call[af], ","), F.split(call[ad], ",")
    own = _number(F.when(F.size(fractions) == 1, fractions[0]).otherwise(F.try_element_at(fractions, (alt_index + 1).cast("int"))))
    at = F.when(F.size(depths) == n_alts, alt_index + 1).when(F.size(depths) == n_alts + 1, alt_index + 2).when(F.size(depths) == 1, 1)
    counted = F.try_divide(_number(F.try_element_at(depths, at.cast("int"))), _number(call[dp]))
    return F.when(call[af].isNotNull(), own).otherwise(F.coalesce(counted, F.when(_number(call[dp]) == 0, 0.0)))


def depth(call: Column, tag: str = "DP") -> Column:
    return _number(call[tag]).cast("int")


def with_coverage(df: DataFrame, sample: str, normal: str | None = None) -> DataFrame:
    """Depths and fractions of tumour DNA and RNA, and of the normal sample (null without one)."""
    t, n_alts = F.col("calls")[sample], F.size("alts")
    df = df.withColumns({"tdna_depth": depth(t), "trna_depth": depth(t, "RDP"), "tdna_vaf": vaf(t, F.col("alt_index"), n_alts), "trna_vaf": vaf(t, F.col("alt_index"), n_alts, "RAF", "RAD", "RDP")})
    n = F.col("calls")[normal] if normal else None
    none = F.lit(None)
    return df.withColumns({"normal_depth": depth(n) if normal else none.cast("int"), "normal_vaf": vaf(n, F.col("alt_index"), n_alts) if normal else none.cast("double")})


def expression(call: Column, tag: str, *names: Column) -> Column:
    """The value of a ``name|value,...`` list for the first of the names that it has."""
    pairs = F.transform(F.split(call[tag], ","), lambda x: F.split(x, r"\|"))
    known = F.map_from_entries(F.transform(F.array_distinct(F.transform(pairs, lambda p: p[0])), lambda k: F.struct(k, F.try_element_at(F.filter(pairs, lambda p: p[0] == k)[0], F.lit(2)))))
    return F.coalesce(*[F.try_element_at(known, n).try_cast("double") for n in names])


def percent_decoded(text: Column) -> Column:
    """``%XX`` as characters; a plus sign stays one."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def protein_length_change(wildtype: Column, frameshift: Column) -> Column:
    d = F.length(frameshift) - F.length(wildtype)
    return F.when(F.coalesce(frameshift, F.lit("")) == "", "").when(d == 0, "0").otherwise(F.format_string("%+d", d))


def dotted_index(*parts: Column) -> Column:
    """A variant's id: its parts joined by dots."""
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def annotated_variants(spark: SparkSession, path: str, sample: str, normal: str | None = None, biotypes: list[str] | None = None, pass_only: bool = False, splice: bool = False) -> DataFrame:
    """Variants of a VCF file with their transcripts, see ``annotated_records``."""
    return annotated_records(read_vcf(spark, path), header(spark, path)[1], sample, normal, biotypes, pass_only, splice)


def annotated_records(calls: DataFrame, fields: list[str], sample: str, normal: str | None = None, biotypes: list[str] | None = None, pass_only: bool = False, splice: bool = False) -> DataFrame:
    """Variants of ``records`` that a sample has, with their transcripts: consequence, proteins, coverage and expression.

    ``fields``: those of the annotation. ``splice``: keeps every consequence and asks
    for no protein sequence.
    """
    df = explode_transcripts(explode_alternates(calls).where(called(sample, pass_only)), fields)
    csq = lambda k: F.col("csq")[k] if k in fields else F.lit(None).cast("string")
    kind = csq("Consequence") if splice else consequence(csq("Consequence"), F.col("ref"), F.col("alternate"))
    df = df.withColumn("variant_type", kind).where("variant_type is not null")
    if biotypes is not None:
        df = df.where(csq("BIOTYPE").isNull() | csq("BIOTYPE").isin(*biotypes))
    if not splice:
        df = df.where(~F.contains(F.coalesce(csq("WildtypeProtein"), F.lit("*")), F.lit("*")))
    df = with_coverage(df, sample, normal)
    call = F.col("calls")[sample]
    bare = F.split(csq("Feature"), r"\.")[0]
    return df.select(
        F.col("chrom").alias("chromosome_name"), F.col("pos").alias("start"), (F.col("pos") + F.length("ref") - 1).alias("stop"), F.col("ref").alias("reference"), F.col("alternate").alias("variant"),
        csq("SYMBOL").alias("gene_name"), csq("Feature").alias("transcript_name"), csq("TSL").alias("transcript_support_level"), csq("CANONICAL").alias("canonical"), csq("MANE_SELECT").alias("mane_select"),
        F.length(csq("WildtypeProtein")).alias("transcript_length"), csq("BIOTYPE").alias("biotype"), F.coalesce(csq("FLAGS"), F.lit("None")).alias("transcript_cds_flags"),
        csq("Amino_acids").alias("amino_acid_change"), csq("Codons").alias("codon_change"), csq("Gene").alias("ensembl_gene_id"), percent_decoded(csq("HGVSc")).alias("hgvsc"), percent_decoded(csq("HGVSp")).alias("hgvsp"),
        csq("WildtypeProtein").alias("wildtype_amino_acid_sequence"), csq("FrameshiftSequence").alias("frameshift_amino_acid_sequence"), "variant_type", csq("Protein_position").alias("protein_position"),
        expression(call, "TX", csq("Feature"), bare).alias("transcript_expression"), expression(call, "GX", csq("Gene"), csq("SYMBOL")).alias("gene_expression"),
        "normal_depth", "normal_vaf", "tdna_depth", "tdna_vaf", "trna_depth", "trna_vaf", protein_length_change(csq("WildtypeProtein"), csq("FrameshiftSequence")).alias("protein_length_change"),
    )
