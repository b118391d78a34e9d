"""Gene models, splice junctions and gene fusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GTF = ["seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"]


def read_gtf(spark: SparkSession, path: str, biotypes: list[str] = ["protein_coding"]) -> DataFrame:  # noqa: B006
    """CDS and transcript features of the chosen biotypes whose coding sequence is complete."""
    raw = spark.read.csv(path, sep="\t", comment="#", quote="", schema=", ".join(f"`{c}` string" for c in GTF))

    def attribute(name: str) -> Column:
        return F.nullif(F.regexp_extract("attributes", rf'(?:^|; *){name} "([^"]*)"', 1), F.lit("")).alias(name)

    tags = F.array_join(F.regexp_extract_all("attributes", F.lit(r'(?:^|; *)tag "([^"]*)"'), F.lit(1)), ",")
    names = ["transcript_id", "transcript_biotype", "transcript_version", "transcript_support_level", "exon_number", "gene_name", "gene_id"]
    df = raw.where("feature in ('CDS', 'transcript')").select("seqname", "feature", F.col("start").cast("int"), F.col("end").cast("int"), "strand", *[attribute(n) for n in names], tags.alias("tag"))
    df = df.where(F.col("transcript_biotype").isin(*biotypes) & ~F.col("tag").rlike("cds_start_NF|cds_end_NF"))
    return df.withColumnsRenamed({"seqname": "cds_chrom", "start": "cds_start", "end": "cds_stop"})


def read_junctions(spark: SparkSession, path: str) -> DataFrame:
    """Junction calls with transcripts as an array of names without versions, and variants as an array."""
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    clean = F.transform(F.split("transcripts", ","), lambda t: F.split(t, r"\.")[0])
    numbers = {c: F.col(c).try_cast("int") for c in ("start", "end", "score")}
    return raw.withColumns(numbers).withColumn("transcripts", clean).withColumn("variant_info", F.split("variant_info", ",")).withColumnsRenamed({"chrom": "junction_chrom", "start": "junction_start", "end": "junction_stop"})


def filter_junctions(df: DataFrame, score: int = 10, distance: int = 100, anchors: tuple[str, ...] = ("A", "D", "NDA")) -> DataFrame:
    """Well supported junctions of known strand with a variant near by; a row for each variant."""
    kept = df.where((F.col("score") > score) & (F.col("strand") != "?") & F.col("anchor").isin(*anchors)).dropDuplicates()
    each = kept.withColumn("variant_info", F.explode("variant_info"))
    place = F.regexp_extract("variant_info", r":(\d+)-", 1).try_cast("int")
    return each.where((F.col("junction_start") - distance < place) & (place < F.col("junction_stop") + distance))


def junctions_with_models(junctions: DataFrame, gtf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Junctions joined to the gene models of their transcripts, and the junction transcripts that have no model."""
    each = junctions.withColumn("transcript_id", F.explode("transcripts")).drop("transcripts")
    used = gtf.join(each.select("transcript_id").distinct(), "transcript_id", "left_semi")
    shared = [c for c in ("strand",) if c in used.columns]
    return each.join(used.drop(*shared), "transcript_id"), each.join(used, "transcript_id", "left_anti")


def junctions_with_variants(junctions: DataFrame, variants: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Inner join on the variant keys, and the junctions that no variant fits."""
    return junctions.join(variants, keys), junctions.join(variants, keys, "left_anti")


def variant_category(ref: Column, alt: Column) -> Column:
    return F.when(F.length(ref) == F.length(alt), "SNV").when(F.length(ref) < F.length(alt), "INS").otherwise("DEL")


# --- fusions ---------------------------------------------------------------------


def _breakpoint(c: Column, prefix: str) -> list[Column]:
    return [F.regexp_replace(F.split(c, ":")[0], "^chr", "").alias(f"{prefix}_chrom"), F.split(c, ":")[1].try_cast("int").alias(f"{prefix}_pos")]


def read_arriba(spark: SparkSession, path: str) -> DataFrame:
    """In-frame and out-of-frame fusions with a peptide; support is the sum of the three read counts."""
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    reads = sum((F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in ("split_reads1", "split_reads2", "discordant_mates")), F.lit(0))
    named = F.col("reading_frame").isin("in-frame", "out-of-frame") & (F.col("peptide_sequence") != ".")
    return raw.where(named).select(
        *_breakpoint(F.col("breakpoint1"), "left"), *_breakpoint(F.col("breakpoint2"), "right"), F.concat_ws("-", F.col("`#gene1`"), "gene2").alias("gene_name"), F.concat_ws("-", "transcript_id1", "transcript_id2").alias("transcript_name"),
        F.when(F.col("reading_frame") == "in-frame", "inframe_fusion").otherwise("frameshift_fusion").alias("variant_type"), F.upper(F.regexp_replace("peptide_sequence", r"[^A-Za-z|*]", "")).alias("peptide"), reads.alias("read_support"),
    )


def read_star_fusion(spark: SparkSession, path: str) -> DataFrame:
    """(left_chrom, left_pos, left_strand, right_chrom, right_pos, right_strand, read_support, expression)."""
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    spanning = next((c for c in raw.columns if c.lower().startswith("spanningfrag")), None)
    reads = F.coalesce(F.col("JunctionReadCount").try_cast("int"), F.lit(0)) + (F.coalesce(F.col(f"`{spanning}`").try_cast("int"), F.lit(0)) if spanning else F.lit(0))
    strand = lambda side: F.try_element_at(F.split(f"{side}Breakpoint", ":"), F.lit(3)).alias(f"{side.lower()}_strand")
    return raw.select(*_breakpoint(F.col("LeftBreakpoint"), "left"), strand("Left"), *_breakpoint(F.col("RightBreakpoint"), "right"), strand("Right"), reads.alias("read_support"), F.col("FFPM").try_cast("double").alias("expression"))


def read_agfusion_exons(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Exon tables, tab- or comma-separated by what stands in each file, as text columns; ``file`` is where a row comes from."""
    lines = spark.read.text(paths).withColumn("file", F.input_file_name())
    cells = F.split("value", F.when(F.contains("value", F.lit("\t")), F.lit("\t")).otherwise(F.lit(",")))
    names = "5'_gene 3'_gene 5'_transcript 3'_transcript exon_gene_source exon_number exon_chr exon_start exon_end".split()
    rows = lines.select("file", F.transform(cells, lambda x: F.trim(F.replace(x, F.lit('"'), F.lit("")))).alias("c"))
    heads = rows.where(F.array_contains("c", "exon_start") & F.array_contains("c", "exon_chr")).select("file", F.col("c").alias("h")).distinct()  # one row a file
    body = rows.join(heads, "file").where(F.col("c") != F.col("h"))
    return body.select("file", *[F.try_element_at("c", F.array_position("h", n).cast("int")).alias(n) if n != "exon_number" else F.when(F.array_contains("h", n), F.try_element_at("c", F.greatest(F.array_position("h", n), F.lit(1)).cast("int"))).alias(n) for n in names])


def read_agfusion(spark: SparkSession, folder: str) -> DataFrame:
    """(fusion, id, sequence) of all ``*_protein.fa`` files one level below a folder; ``fusion`` is the folder's name.

    Proteins are cut at the first stop and upper case.
    """
    lines = spark.read.text(f"{folder}/*/*_protein.fa", lineSep="\n>").withColumn("fusion", F.element_at(F.split(F.input_file_name(), "/"), -2))
    records = lines.select("fusion", F.regexp_replace("value", r"^>", "").alias("r")).where(F.trim("r") != "")
    head = F.split("r", "\n", 2)
    sequence = F.upper(F.regexp_replace(F.coalesce(F.try_element_at(head, F.lit(2)), F.lit("")), r"\s", ""))
    return records.select("fusion", F.split(F.trim(head[0]), r"\s+", 2)[0].alias("id"), F.regexp_extract(sequence, r"^[^*]*", 0).alias("sequence"))


def read_agfusion_proteins(spark: SparkSession, folder: str) -> DataFrame:
    """(fusion, genes, transcripts, effect, sequence) of the same files: what each record's title tells, and its sequence with the ``*`` at the joint."""
    lines = spark.read.text(f"{folder}/*/*_protein.fa", lineSep="\n>").withColumn("fusion", F.element_at(F.split(F.input_file_name(), "/"), -2))
    records = lines.select("fusion", F.split(F.regexp_replace("value", r"^>", ""), "\n", 2).alias("r")).where(F.trim(F.col("r")[0]) != "")
    told = lambda key: F.nullif(F.regexp_extract(F.col("r")[0], rf"(?:^|, ){key}: ([^,]*?)\s*(?:,|$)", 1), F.lit("")).alias(key)
    return records.select("fusion", told("genes"), told("transcripts"), told("effect"), F.upper(F.regexp_replace(F.coalesce(F.try_element_at("r", F.lit(2)), F.lit("")), r"\s", "")).alias("sequence"))


def exon_extents(exons: DataFrame) -> DataFrame:
    """For each transcript pair, first and last exon coordinates of either side."""
    side = lambda g: F.col("exon_gene_source") == F.col(g)
    place = lambda c: F.col(c).try_cast("int")
    aggs = [
        f(F.when(side(gene), place(col))).alias(f"{name}_{what}")
        for name, gene in (("left", "`5'_gene`"), ("right", "`3'_gene`"))
        for what, f, col in (("start", F.min, "exon_start"), ("stop", F.max, "exon_end"))
    ]
    return exons.groupBy("`5'_transcript`", "`3'_transcript`").agg(*aggs, F.max(F.when(side("`5'_gene`"), F.col("exon_chr"))).alias("left_chrom"), F.max(F.when(side("`3'_gene`"), F.col("exon_chr"))).alias("right_chrom"))


def bare(df: DataFrame) -> DataFrame:
    """Calls with chromosomes without ``chr``."""
    return df.withColumns({c: F.regexp_replace(c, "^chr", "") for c in ("left_chrom", "right_chrom")})


def with_star_support(fusions: DataFrame, star: DataFrame) -> DataFrame:
    """Read support and expression of the first call with the same breakpoints; chromosomes with or without ``chr``."""
    keys = ["left_chrom", "left_pos", "right_chrom", "right_pos"]
    first = Window.partitionBy(*keys).orderBy(F.desc("read_support"), F.desc("expression"))
    star = bare(star).withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*keys, F.col("read_support").alias("star_reads"), F.col("expression").alias("star_expression"))
    return bare(fusions).join(star, keys, "left")


def fusion_breakpoints(extents: DataFrame, left_strand: str = "left_strand", right_strand: str = "right_strand") -> DataFrame:
    """Where a fusion joins: the end of the 5' exons and the start of the 3' ones on the plus strand, the other way on minus."""
    return extents.withColumns({
        "left_pos": F.when(F.col(left_strand) == "+", F.col("left_stop")).otherwise(F.col("left_start")),
        "right_pos": F.when(F.col(right_strand) == "+", F.col("right_start")).otherwise(F.col("right_stop")),
    })
