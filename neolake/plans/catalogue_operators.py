"""Queries of the operators on single rows, sequences, variants and tables, and the same in SQL.

Proteins are made from hashes of ``part``: ``wt``, and ``mt`` with residues from
``pos`` on replaced, taken out or put in. DNA likewise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neolake.functions import filters as P
from neolake.functions import sequences as S
from neolake.operators import aggregate, candidates, compare, filters, genomic, predictions, reference, tiers, vector
from neolake.plans.catalogue import _CODONS_SQL, _REPORT, _T, KEY, _report, epitopes, query, read
from neolake.plans.standins import PROTEINS, proteins, seconds
from neolake.schemas import Thresholds
from neolake.sources import fasta, tables, transcripts, vcf

c = F.col
_KEY = ", ".join(KEY)

# --- proteins ---------------------------------------------------------------------------

_RUN = "coalesce(list_min(list_filter(range(1, least(length({a}), length({b})) + 1), lambda i: substr({a}, i, 1) <> substr({b}, i, 1))) - 1, least(length({a}), length({b})))::INT"
_LEFT, _RIGHT = _RUN.format(a="mt", b="wt"), _RUN.format(a="reverse(mt)", b="reverse(wt)")


@query(f"WITH {PROTEINS} SELECT p_partkey, {_LEFT} AS from_left, {_RIGHT} AS from_right FROM p")
def matching_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", S.matches_from_left(c("mt"), c("wt")).alias("from_left"), S.matches_from_right(c("mt"), c("wt")).alias("from_right"))


@query(f"""WITH {PROTEINS}, r AS (SELECT *, {_LEFT} AS l, {_RIGHT} AS r0 FROM p), s AS (SELECT *, least(r0, least(length(mt), length(wt)) - l) AS r, greatest(l - 7, 1) AS a FROM r)
SELECT p_partkey, substr(mt, a, greatest(least(length(mt) - r + 8, length(mt)) - a + 1, 0)) AS part, substr(mt, a) AS rest FROM s""")
def mutated_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", S.changed_window(c("mt"), c("wt"), 8).alias("part"), S.changed_window(c("mt"), c("wt"), 8, to_end=True).alias("rest"))


@query(f"WITH {PROTEINS}, s AS (SELECT *, least(13, length(wt)) AS n FROM p) SELECT p_partkey, substr(wt, greatest(1, least(pos - 6, length(wt) - n + 1)), n) AS part FROM s")
def wildtype_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", S.centred(c("wt"), c("pos"), 6).alias("part"))


@query(f"WITH {PROTEINS} SELECT p_partkey, wt[greatest(1, pos - 5):] AS whole, wt[greatest(1, pos - 5):least(length(wt), pos + 9)] AS part FROM p")
def frameshift_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", S.frameshift_window(c("wt"), c("pos"), 5).alias("whole"), S.frameshift_window(c("wt"), c("pos"), 5, 9).alias("part"))


_CHANGE = "CASE p_partkey % 5 WHEN 0 THEN substr(wt, pos, 1) || '/W' WHEN 1 THEN '-/WY' WHEN 2 THEN substr(wt, pos, 2) || '/-' WHEN 3 THEN substr(wt, pos, 1) || '/W*K' ELSE 'Z/W' END"


@query(f"""WITH {PROTEINS} SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN wt[:pos - 1] || 'W' || wt[pos + 1:] WHEN 1 THEN wt[:pos] || 'WY' || wt[pos + 1:] WHEN 2 THEN wt[:pos - 1] || wt[pos + 2:] WHEN 3 THEN wt[:pos - 1] || 'W' END AS protein FROM p""")
def mutated_protein(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = proteins(spark, sf_dir).withColumn("change", F.expr(_CHANGE.replace("substr(", "substring(")))
    return df.select("p_partkey", S.mutated_protein(c("wt"), c("change"), c("pos")).alias("protein"))


@query(f"""WITH {PROTEINS} SELECT p_partkey, overlay_1[:pos] || (CASE WHEN p_partkey % 2 = 0 THEN 'Y' ELSE overlay_1[pos + 1:pos + 1] END) || overlay_1[pos + 2:] AS protein FROM (SELECT *, wt[:pos - 1] || 'W' || wt[pos + 1:] AS overlay_1 FROM p)""")
def proximal_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda at, n, new: F.struct(at.alias("pos"), n.alias("wild"), F.lit(new).alias("mutant"))
    here, there = F.expr("substring(wt, pos, 1)"), F.when(c("p_partkey") % 2 == 0, F.expr("substring(wt, pos + 1, 1)")).otherwise("Z")
    return proteins(spark, sf_dir).select("p_partkey", S.overlaid(c("wt"), F.array(one(c("pos"), here, "W"), one(c("pos") + 1, there, "Y"))).alias("protein"))


_DNA = "translate(substr(md5(p_partkey::VARCHAR), 1, 30), '0123456789abcdef', 'ACGTACGTACGTACGT')"


def _dna(column: str = "p_partkey"):
    return F.translate(F.substring(F.md5(c(column).cast("string").cast("binary")), 1, 30), "0123456789abcdef", "ACGTACGTACGTACGT")


@query(f"WITH d AS (SELECT p_partkey, {_DNA} AS dna FROM part) SELECT p_partkey, 'GT' || substr(dna, 3, 1) AS codon FROM d")
def merged_codon(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = lambda i: F.lower(F.substring("dna", i, 1))
    up = lambda i: F.substring("dna", i, 1)
    two = F.array(F.concat(low(1), up(2), low(3), F.lit("/"), low(1), F.lit("T"), low(3)), F.concat(up(1), low(2), low(3), F.lit("/G"), low(2), low(3)))
    return read(spark, sf_dir, "part", "p_partkey").withColumn("dna", _dna()).select("p_partkey", S.merged_codon(two).alias("codon"))


@query(f"WITH {PROTEINS} SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN pos ELSE pos - (p_partkey % 3)::INT END AS start FROM p WHERE pos + 9 <= length(wt)")
def core_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = (c("p_partkey") % 3).cast("int")
    df = proteins(spark, sf_dir).where("pos + 9 <= length(wt)").withColumn("core", F.when(k == 0, F.expr("substring(mt, 1, 0) || 'ZZZ'")).otherwise(F.substring(F.lit("ABCDEFGHI"), k + 1, F.lit(5))))
    return df.select("p_partkey", S.core_position(c("pos"), c("core"), F.lit("ABCDEFGHI")).alias("start"))


@query("""SELECT p_partkey, try_cast(CASE WHEN p_size % 3 = 0 THEN p_retailprice::VARCHAR WHEN p_size % 3 = 1 THEN p_size::VARCHAR END AS DOUBLE) AS percentile, p_size AS position FROM part""")
def percentile_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = c("p_size")
    first = F.when(size % 3 == 0, c("p_retailprice").cast("string")).when(size % 3 == 1, F.lit("None")).otherwise(F.lit("NA"))
    raw = read(spark, sf_dir, "part").withColumns({"start": size, "percentile": first, "percentile_rank": F.when(size % 3 == 1, size.cast("string"))})
    return predictions.normalised(raw).select("p_partkey", "percentile", "position")


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'FS' || p_size ELSE 'V' || p_size || 'E' END AS change FROM part""")
def aa_change_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumns({"Variant Type": F.when(c("p_size") % 2 == 0, "FS").otherwise("missense"), "Mutation": F.lit("V/E"), "Protein Position": c("p_size").cast("string")})
    return df.select("p_partkey", aggregate.aa_change().alias("change"))


@query("SELECT p_partkey, CASE WHEN length(p_name) = length(p_type) THEN 'SNV' WHEN length(p_name) < length(p_type) THEN 'INS' ELSE 'DEL' END AS kind FROM part")
def variant_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", transcripts.variant_category(c("p_name"), c("p_type")).alias("kind"))


@query(f"""WITH d AS (SELECT p_partkey // 4 AS gene, p_partkey AS exon, (p_partkey // 4) % 2 = 0 AS plus, CASE WHEN p_partkey % 4 = 0 THEN 'ATG' ELSE '' END || {_DNA} || CASE WHEN p_partkey % 4 = 3 THEN 'CAT' ELSE '' END AS dna FROM part),
g AS (SELECT gene, plus, string_agg(dna, '' ORDER BY exon) AS dna FROM d GROUP BY gene, plus), h AS (SELECT gene, CASE WHEN plus THEN dna ELSE translate(reverse(dna), 'ACGT', 'TGCA') END AS dna FROM g)
SELECT gene, dna, split_part(array_to_string(list_transform(range(0, length(dna) // 3), lambda i: {_CODONS_SQL}[substr(dna, i * 3 + 1, 3)]), ''), '*', 1) AS protein, length(dna) % 3 <> 0 AS frameshift FROM h""")
def spliced_protein(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("p_partkey")
    dna = F.concat(F.when(key % 4 == 0, "ATG").otherwise(""), _dna(), F.when(key % 4 == 3, "CAT").otherwise(""))
    exons = read(spark, sf_dir, "part", "p_partkey").select(F.floor(key / 4).alias("gene"), key.alias("cds_start"), F.when(F.floor(key / 4) % 2 == 0, "+").otherwise("-").alias("strand"), dna.alias("exon_sequence"))
    return genomic.spliced_protein(exons, ["gene"]).select("gene", "dna", "protein", "frameshift")


@query(f"WITH {PROTEINS}, s AS (SELECT *, greatest(pos - 7, 1) AS a, least(pos + 8 + 7, length(wt)) AS b FROM p) SELECT p_partkey, wt[a:b] AS part FROM s")
def reference_query_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", reference.query_window(c("wt"), c("pos"), 9).alias("part"))


@query("""SELECT a.r_name AS "left", b.r_name AS "right", s AS spacer, i::INT AS left_clip, j::INT AS right_clip, right(left(a.r_name, length(a.r_name) - i::INT), 3) || CASE s WHEN 'None' THEN '' ELSE s END || substr(b.r_name, j::INT + 1, 3) AS sequence
FROM region a JOIN region b ON a.r_name <> b.r_name, (VALUES ('None'), ('AAY')) x(s), range(0, 2) y(i), range(0, 2) z(j)""")
def junction_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = vector.ordered_pairs(read(spark, sf_dir, "region").select("r_name", c("r_name").alias("s")))
    return vector.junction_sequences(pairs, ["None", "AAY"], 1, 3).select("left", "right", "spacer", "left_clip", "right_clip", "sequence")


@query(f"WITH {PROTEINS}, s AS (SELECT *, wt[pos:pos + 2] AS e FROM p WHERE pos <= 30), t AS (SELECT *, list_sort(list_transform(list_filter(range(1, 31), lambda i: wt[i:i + 2] = e), lambda i: {{'d': abs(i - 12), 'i': i}}))[1].i AS b FROM s) SELECT p_partkey, wt[greatest(b - 4, 1):least(b + 6, 32)] AS part FROM t")
def window_around_epitope(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = proteins(spark, sf_dir).where("pos <= 30").withColumn("e", F.expr("substring(wt, pos, 3)"))
    return df.select("p_partkey", S.window_around(c("wt"), c("e"), 4, F.lit(12)).alias("part"))


_PREFERRED = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in S.PREFERRED_CODONS.items()) + "}"
_NUMBERS = lambda d: "MAP {" + ", ".join(f"'{k}': {v}::DOUBLE" for k, v in d.items()) + "}"


@query(f"WITH {PROTEINS} SELECT p_partkey, array_to_string(list_transform(string_split(mt, ''), lambda x: {_PREFERRED}[x]), '') AS dna FROM p")
def back_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", S.back_translated(c("mt")).alias("dna"))


@query(f"WITH {PROTEINS} SELECT p_partkey, round(list_reduce(list_prepend({S.WATER}::DOUBLE, list_transform(string_split(mt, ''), lambda x: {_NUMBERS(S.MASS)}[x])), lambda t, x: t + x), 4) AS mass FROM p")
def molecular_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", S.molecular_weight(c("mt")).alias("mass"))


_SEVEN = lambda at: f"(list_sum(list_transform(range({at}, {at} + 7), lambda j: {_NUMBERS(S.HYDROPATHY)}[substr(mt, j, 1)])) / 7)"


@query(f"""WITH {PROTEINS} SELECT p_partkey, round({_SEVEN("length(mt) - 6")}, 5) + 0.0 AS last, round(list_max(list_transform(range(1, length(mt) - 5), lambda i: {_SEVEN("i")})), 5) + 0.0 AS most, mt[1:1] IN ('Q', 'E', 'C') AS difficult, mt[length(mt):] = 'C' AS cysteine,
mt[length(mt):] = 'P' AS proline, (length(mt) - length(replace(mt, 'C', '')))::INT AS cysteines, mt[1:1] = 'N' AS asparagine, ((length(mt) - length(replace(mt, 'NP', ''))) // 2)::INT AS bonds FROM p""")
def sliding_hydropathy(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = S.manufacturability(c("mt"))
    names = ["last", "most", "difficult", "cysteine", "proline", "cysteines", "asparagine", "bonds"]
    values = [F.round(v, 5) + 0.0 if n in ("last", "most") else v for n, v in zip(names, m.values())]
    return proteins(spark, sf_dir).select("p_partkey", *[v.alias(n) for n, v in zip(names, values)])


_ID = "'G' || p_size || '.ENST000' || p_partkey || '.4.' || CASE p_partkey % 4 WHEN 0 THEN 'missense.84D/Y' WHEN 1 THEN 'FS.405-410CGC/C' WHEN 2 THEN 'inframe_del.585-589KTGV*/R' ELSE 'inframe_ins.7-8-/AA' END"


@query("""SELECT p_partkey, 'G' || p_size || '.ENST000' || p_partkey || '.4.' || CASE p_partkey % 4 WHEN 0 THEN '84D/Y' WHEN 1 THEN 'FS405-410' WHEN 2 THEN 'KTGV*585-589R' ELSE '7-8-/AA' END AS short, p_size || 'G/D' AS change FROM part""")
def short_peptide_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("id", F.expr(_ID))
    return df.select("p_partkey", S.short_peptide_id(c("id")).alias("short"), S.rearranged_change(F.concat(F.lit("G"), c("p_size").cast("string"), F.lit("D"))).alias("change"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_type || '|HLA-A*02:0' || p_size || '|x' ELSE p_type || '|A|x' END AS parts FROM part")
def id_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("id", F.concat(c("p_type"), F.when(c("p_size") % 2 == 0, F.concat(F.lit("-HLA-A*02:0"), c("p_size").cast("string"))).otherwise("-A"), F.lit("-x")))
    return df.select("p_partkey", F.array_join(S.id_parts(c("id")), "|").alias("parts"))


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_retailprice WHEN 1 THEN p_size::DOUBLE WHEN 2 THEN p_retailprice / 2 WHEN 3 THEN p_size / 2 ELSE p_retailprice END AS score FROM part")
def score_of_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("MHCflurry", "DeepImmuno", "BigMHC_EL", "netmhcpan_el", "NetMHCIIpan_EL")])
    price, size = c("p_retailprice"), c("p_size")
    fields = F.create_map(F.lit("ic50"), price.cast("string"), F.lit("immunogenicity"), size.cast("string"), F.lit("BigMHC_EL"), (price / 2).cast("string"), F.lit("score"), F.when(c("p_partkey") % 5 == 3, (size / 2).cast("string")))
    return read(spark, sf_dir, "part").select("p_partkey", S.score_of_method(names[(c("p_partkey") % 5).cast("int")], fields).alias("score"))


@query(f"""WITH {PROTEINS} SELECT p_partkey, array_to_string(list_transform(range(1, length(mt) + 1), lambda i: mt[i:i] || CASE WHEN i = pos THEN 'u' ELSE '' END || CASE WHEN i % 2 = 0 AND i < 5 THEN 'c' ELSE '' END), '') AS styled FROM p""")
def residue_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.array().cast("array<int>")
    styled = S.residue_styles(c("mt"), F.array("pos"), F.array(F.lit(2), F.lit(4)), none, none)
    text = F.transform(styled, lambda x: F.concat(x["aa"], F.when(x["underline"], "u").otherwise(""), F.when(x["color"], "c").otherwise("")))
    return proteins(spark, sf_dir).select("p_partkey", F.array_join(text, "").alias("styled"))


@query("SELECT DISTINCT p_brand AS allele, 'kind ' || p_brand[7:7] AS species FROM part")
def species_of_allele(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefixes = spark.createDataFrame([(f"Brand#{i}", f"kind {i}") for i in range(1, 10)], "prefix string, species string")
    return predictions.species_of_allele(read(spark, sf_dir, "part").select(c("p_brand").alias("allele")).distinct(), prefixes)


@query(f"WITH {PROTEINS} SELECT p_partkey, regexp_extract(s, '^[^X*]*') AS cleaned FROM (SELECT p_partkey, upper(CASE p_partkey % 3 WHEN 0 THEN mt[:9] || 'X' || mt[10:] WHEN 1 THEN lower(mt) || '*' ELSE mt || 'B' END) AS s FROM p) WHERE p_partkey % 3 <> 2 AND length(regexp_extract(s, '^[^X*]*')) >= 9")
def usable_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("p_partkey") % 3
    df = proteins(spark, sf_dir).withColumn("sequence", F.when(k == 0, F.expr("substring(mt, 1, 9) || 'X' || substring(mt, 10)")).when(k == 1, F.expr("lower(mt) || '*'")).otherwise(F.expr("mt || 'B'")))
    return fasta.usable_sequences(df.select("p_partkey", "sequence"), 9).select("p_partkey", c("sequence").alias("cleaned"))


@query(f"WITH {PROTEINS} SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN mt[4:] ELSE mt[:length(mt) - 3] END AS cleaned FROM p")
def trimmed_fusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = proteins(spark, sf_dir).withColumn("s", F.when(c("p_partkey") % 2 == 0, F.expr("'AZ' || 'Z' || substring(mt, 4) || 'XX'")).otherwise(F.expr("substring(mt, 1, length(mt) - 3) || 'ZA'")))
    return df.select("p_partkey", fasta.trim_unsupported(c("s")).alias("cleaned"))


# --- alternate and wild type -------------------------------------------------------------

_MATCH = """
w AS (SELECT p_partkey AS index, 'a' AS allele, 9 AS length, unnest(range(1, 25)) AS position, wt FROM p), wx AS (SELECT index, allele, length, position, wt[position:position + 8] AS epitope FROM w),
m0 AS (SELECT p_partkey AS index, 'a' AS allele, 9 AS length, unnest(range(1, 25)) AS position, mt, CASE WHEN gone = length(new) THEN 'missense' WHEN gone < length(new) THEN 'inframe_ins' ELSE 'inframe_del' END AS kind, gone - length(new) AS shift FROM p),
m AS (SELECT index, allele, length, position, mt[position:position + 8] AS epitope, kind, shift FROM m0 WHERE length(mt[position:position + 8]) = 9),
j AS (SELECT m.*, a.epitope AS l, b.epitope AS r FROM m LEFT JOIN wx a ON m.index = a.index AND m.position = a.position LEFT JOIN wx b ON m.index = b.index AND m.position + m.shift = b.position)"""
_SAME = "coalesce(len(list_filter(range(1, 10), lambda i: substr(epitope, i, 1) = substr({0}, i, 1))), -1)"


@query(f"""WITH {PROTEINS}, {_MATCH}, k AS (SELECT *, CASE WHEN l IS NULL THEN -1 ELSE {_SAME.format("l")} END AS nl, CASE WHEN r IS NULL THEN -1 ELSE {_SAME.format("r")} END AS nr FROM j),
t AS (SELECT *, max(CASE WHEN kind <> 'missense' AND nr > nl THEN 1 ELSE 0 END) OVER (PARTITION BY index ORDER BY position) AS turned FROM k), f AS (SELECT *, CASE WHEN turned = 1 THEN r ELSE l END AS found, CASE WHEN turned = 1 THEN nr ELSE nl END AS n FROM t)
SELECT index, position::INT AS position, epitope, CASE WHEN n >= 5 THEN found END AS wt_epitope, CASE WHEN n >= 5 THEN array_to_string(list_filter(range(1, 10), lambda i: substr(epitope, i, 1) <> substr(found, i, 1)), ', ') END AS places FROM f WHERE epitope IS DISTINCT FROM found""")
def match_wildtype(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = proteins(spark, sf_dir).withColumns({"index": c("p_partkey"), "allele": F.lit("a"), "length": F.lit(9)})
    each = lambda s: p.withColumn("k", F.explode(S.kmers(c(s), 9))).withColumns({"position": c("k.position"), "epitope": c("k.kmer")}).where("position < 25")
    kind = F.when(c("gone") == F.length("new"), "missense").when(c("gone") < F.length("new"), "inframe_ins").otherwise("inframe_del")
    mutant = each("mt").withColumns({"variant_type": kind, "shift": c("gone") - F.length("new")}).select("index", "allele", "length", "position", "epitope", "variant_type", "shift")
    out = predictions.match_wildtype(mutant, each("wt").select("index", "allele", "length", "position", "epitope"))
    return out.select("index", "position", "epitope", "wt_epitope", c("mutation_position").alias("places"))


@query(f"WITH {PROTEINS} SELECT p_partkey, len(list_filter(range(1, length(mt) - 7), lambda i: NOT contains(wt, mt[i:i + 8]))) > 0 AS novel FROM p")
def novel_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proteins(spark, sf_dir).select("p_partkey", genomic.is_novel(c("mt"), c("wt"), 9).alias("novel"))


@query(f"WITH {PROTEINS}, k AS (SELECT p_partkey, unnest(list_transform(range(1, length(wt) - 1), lambda i: {{'kmer': wt[i:i + 2], 'at': i}})) AS k FROM p), d AS (SELECT p_partkey, k.kmer AS kmer, p_partkey || '.' || max(k.at) AS id FROM k GROUP BY p_partkey, k.kmer) SELECT kmer, string_agg(id, ',' ORDER BY id) AS ids FROM d GROUP BY kmer")
def kmer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = proteins(spark, sf_dir)
    novel = genomic.novel_kmers(p.select("p_partkey", c("wt").alias("protein")), p.select("p_partkey", F.lit("").alias("protein")), "p_partkey", 3)
    return genomic.kmer_ids(novel, "p_partkey")


@query("""WITH s AS (SELECT p_name AS sequence, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS ids FROM part GROUP BY p_name), n AS (SELECT row_number() OVER (ORDER BY sequence) AS number, * FROM s)
SELECT number, sequence, ids, (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name = sequence)::BIGINT AS n FROM n""")
def unique_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fasta.unique_sequences(read(spark, sf_dir, "part").select(c("p_partkey").alias("id"), c("p_name").alias("sequence")))
    scores = read(spark, sf_dir, "lineitem", "l_partkey").join(fasta.id_keys(found), c("l_partkey") == c("id")).select(c("number").alias("seq_num"))
    n = scores.groupBy("seq_num").agg(F.count("*").alias("n"))
    return found.join(n, c("number") == c("seq_num"), "left").select("number", "sequence", F.array_join(c("ids").cast("array<string>"), ",").alias("ids"), F.coalesce("n", F.lit(0)).alias("n"))


@query("""WITH s AS (SELECT row_number() OVER (ORDER BY p_name) AS number, p_name FROM (SELECT DISTINCT p_name FROM part)) SELECT l_orderkey, l_linenumber, l_extendedprice, p_partkey AS index FROM (SELECT *, 1 + l_suppkey % 50 AS seq FROM lineitem) JOIN s ON seq = number JOIN part USING (p_name)""")
def predictions_to_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fasta.unique_sequences(read(spark, sf_dir, "part").select(c("p_partkey").alias("id"), c("p_name").alias("sequence")))
    scores = read(spark, sf_dir, "lineitem").withColumn("seq_num", (c("l_suppkey") % 50 + 1).cast("long"))
    return predictions.joined_to_ids(scores, found).select("l_orderkey", "l_linenumber", "l_extendedprice", "index")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey")
def predictions_to_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = read(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "index")
    return predictions.joined_to_variants(scores, read(spark, sf_dir, "part").withColumnRenamed("p_partkey", "index")).select("l_orderkey", "l_linenumber", "l_extendedprice", "p_brand")


# --- variants --------------------------------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN length(p_name) <> length(p_type) AND p_name[1] = p_type[1] THEN CASE WHEN p_type[2:] = '' THEN '-' ELSE p_type[2:] END ELSE p_type END AS allele FROM (SELECT p_partkey, upper(p_name)[1:(p_size % 4 + 1)::INT] AS p_name, p_type[1:(p_size % 3 + 1)::INT] AS p_type FROM part)""")
def csq_allele(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumns({"ref": F.expr("substring(upper(p_name), 1, p_size % 4 + 1)"), "alt": F.expr("substring(p_type, 1, p_size % 3 + 1)")})
    return df.select("p_partkey", vcf.csq_allele(c("ref"), c("alt")).alias("allele"))


_TERMS = ["missense_variant", "frameshift_variant&splice", "inframe_insertion", "inframe_deletion", "protein_altering_variant", "start_lost&missense_variant", "synonymous_variant", "stop_retained_variant"]


@query("""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'missense' WHEN 1 THEN 'FS' WHEN 2 THEN 'inframe_ins' WHEN 3 THEN 'inframe_del' WHEN 4 THEN CASE WHEN d % 3 <> 0 OR d = 0 THEN NULL WHEN d > 0 THEN 'inframe_ins' ELSE 'inframe_del' END END AS kind FROM (SELECT *, length(p_type) - length(p_name) AS d FROM part)""")
def consequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.array(*[F.lit(x) for x in _TERMS])[(c("p_partkey") % 8).cast("int")]
    return read(spark, sf_dir, "part").select("p_partkey", vcf.consequence(terms, c("p_name"), c("p_type")).alias("kind"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '' WHEN length(p_type) = length(p_name) THEN '0' WHEN length(p_type) > length(p_name) THEN '+' || (length(p_type) - length(p_name)) ELSE (length(p_type) - length(p_name))::VARCHAR END AS change FROM part")
def protein_length_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", vcf.protein_length_change(c("p_name"), F.when(c("p_size") % 5 != 0, c("p_type"))).alias("change"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 0.25 WHEN 1 THEN p_size / 100 WHEN 2 THEN p_size / 100 ELSE NULL END AS vaf, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE 100 END AS depth FROM part""")
def vaf_and_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = c("p_partkey") % 4, c("p_size").cast("string")
    call = F.create_map(F.lit("AF"), F.when(k == 0, "0.5,0.25"), F.lit("AD"), F.when(k == 1, F.concat(F.lit("7,9,"), size)).when(k == 2, F.concat(F.lit("9,"), size)), F.lit("DP"), F.when(k != 3, "100").otherwise("."))
    df = read(spark, sf_dir, "part").withColumn("call", call)
    return df.select("p_partkey", vcf.vaf(c("call"), F.lit(1), F.lit(2)).alias("vaf"), vcf.depth(c("call")).alias("depth"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_retailprice WHEN 1 THEN 2.5 END AS expr, p_name[1:4] || ' +x' AS decoded, p_partkey % 2 = 1 AS called, '1.' || p_brand || '.' || p_size AS "index" FROM part""")
def variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("p_partkey")
    call = F.create_map(F.lit("GX"), F.concat(F.lit("G1|"), c("p_retailprice").cast("string"), F.lit(",G2|2.5,G2|9")))
    df = read(spark, sf_dir, "part").withColumns({"call": call, "calls": F.create_map(F.lit("s"), F.create_map(F.lit("GT"), F.when(k % 2 == 1, "0|2").otherwise("0/1"))), "alt_index": F.lit(1)})
    name = F.array(F.lit("G1"), F.lit("G2"), F.lit("G3"))[(k % 3).cast("int")]
    return df.select("p_partkey", vcf.expression(c("call"), "GX", F.lit("none"), name).alias("expr"), vcf.percent_decoded(F.concat(F.substring("p_name", 1, 4), F.lit("%20%2Bx"))).alias("decoded"), vcf.called("s").alias("called"), vcf.dotted_index(F.lit(1), c("p_brand"), c("p_size")).alias("index"))


@query("""WITH j AS (SELECT DISTINCT o_orderkey, o_custkey * 10 + 1000 AS a, o_custkey * 10 + 1040 AS b, o_orderkey % 20 AS score, o_orderkey % 7 AS strand FROM orders), v AS (SELECT *, unnest([a - 99, a - 100, b + 99, b + 100]) AS place FROM j) SELECT o_orderkey, place FROM v WHERE score > 10 AND strand <> 0 AND o_orderkey % 3 <> 0 AND a - 100 < place AND place < b + 100""")
def filtered_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, at = c("o_orderkey"), c("o_custkey") * 10 + 1000
    info = F.array(*[F.concat(F.lit("1:"), x.cast("string"), F.lit("-"), x.cast("string")) for x in (at - 99, at - 100, at + 139, at + 140)])
    df = read(spark, sf_dir, "orders").select(key, at.alias("junction_start"), (at + 40).alias("junction_stop"), (key % 20).alias("score"), F.when(key % 7 == 0, "?").otherwise("+").alias("strand"), F.when(key % 3 == 0, "N").otherwise("A").alias("anchor"), info.alias("variant_info"))
    return transcripts.filter_junctions(df).select("o_orderkey", F.regexp_extract("variant_info", r":(\d+)-", 1).cast("long").alias("place"))


@query("""SELECT o_orderkey, c_custkey FROM orders JOIN (SELECT * FROM customer WHERE c_nationkey < 20) ON c_custkey = o_custkey""")
def junctions_with_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = read(spark, sf_dir, "orders").select("o_orderkey", F.array(c("o_custkey").cast("string"), F.lit("none")).alias("transcripts"))
    gtf = read(spark, sf_dir, "customer").where("c_nationkey < 20").select(c("c_custkey").cast("string").alias("transcript_id"), "c_custkey")
    return transcripts.junctions_with_models(j, gtf)[0].select("o_orderkey", "c_custkey")


@query("""SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_nationkey < 20)""")
def junctions_without_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = read(spark, sf_dir, "customer").where("c_nationkey < 20").select(c("c_custkey").alias("o_custkey"), "c_nationkey")
    return transcripts.junctions_with_variants(read(spark, sf_dir, "orders"), variants, ["o_custkey"])[1].select("o_orderkey")


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY l_quantity DESC, l_extendedprice DESC) AS k FROM lineitem)
SELECT p_partkey, l_quantity AS reads, l_extendedprice AS expression FROM part LEFT JOIN (SELECT * FROM s WHERE k = 1) ON l_suppkey = p_size AND l_linenumber = p_partkey % 9""")
def star_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = lambda a, b: [F.lit("1").alias("left_chrom"), a.alias("left_pos"), F.lit("chr2").alias("right_chrom"), b.alias("right_pos")]
    fusions = read(spark, sf_dir, "part").select("p_partkey", *place(c("p_size").cast("long"), (c("p_partkey") % 9).cast("long")))
    star = read(spark, sf_dir, "lineitem").select(*place(c("l_suppkey").cast("long"), c("l_linenumber").cast("long")), c("l_quantity").alias("read_support"), c("l_extendedprice").alias("expression")).withColumn("left_chrom", F.lit("chr1"))
    return transcripts.with_star_support(fusions, star).select("p_partkey", c("star_reads").alias("reads"), c("star_expression").alias("expression"))


@query("""WITH e AS (SELECT l_orderkey AS f, l_linenumber % 2 = 0 AS lft, l_partkey AS a, l_partkey + 10 AS b FROM lineitem), x AS (SELECT f, min(a) FILTER (lft) AS la, max(b) FILTER (lft) AS lb, min(a) FILTER (NOT lft) AS ra, max(b) FILTER (NOT lft) AS rb FROM e GROUP BY f)
SELECT f, la AS left_start, rb AS right_stop, CASE WHEN f % 2 = 0 THEN lb ELSE la END AS left_pos, CASE WHEN f % 3 = 0 THEN ra ELSE rb END AS right_pos FROM x""")
def exon_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = c("l_orderkey").cast("string")
    e = read(spark, sf_dir, "lineitem").select(f.alias("5'_transcript"), f.alias("3'_transcript"), F.lit("L").alias("5'_gene"), F.lit("R").alias("3'_gene"), F.when(c("l_linenumber") % 2 == 0, "L").otherwise("R").alias("exon_gene_source"), F.lit("1").alias("exon_chr"), c("l_partkey").alias("exon_start"), (c("l_partkey") + 10).alias("exon_end"))
    x = transcripts.exon_extents(e).withColumn("f", c("5'_transcript").cast("long"))
    strand = lambda k: F.when(c("f") % k == 0, "+").otherwise("-")
    x = transcripts.fusion_breakpoints(x.withColumns({"left_strand": strand(2), "right_strand": strand(3)}))
    return x.select("f", *[c(n).cast("long").alias(n) for n in ("left_start", "right_stop", "left_pos", "right_pos")])


@query("""WITH s AS (SELECT event_id, user_id, epoch(ts)::BIGINT AS t, event_id % 3 AS g FROM events), n AS (SELECT event_id AS other, user_id, epoch(ts)::BIGINT AS u, event_id % 4 AS h FROM events)
SELECT event_id, other FROM s JOIN n USING (user_id) WHERE abs(t - u) <= 600 AND t <> u AND (h = 0 OR (g <> 2 AND ((g = 0 AND h = 1) OR (g = 1 AND h = 2))))""")
def proximal_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("t", seconds(c("ts")))
    own = F.when(c("event_id") % 3 == 0, "0|1").when(c("event_id") % 3 == 1, "1|0").otherwise("0/1")
    near = F.when(c("event_id") % 4 == 0, "1/1").when(c("event_id") % 4 == 1, "0|1").when(c("event_id") % 4 == 2, "1|0").otherwise("0/1")
    somatic = e.select("event_id", c("user_id").alias("chrom"), c("t").alias("pos"), own.alias("genotype"))
    phased = e.select(c("event_id").alias("other"), c("user_id").alias("chrom"), c("t").alias("near_pos"), near.alias("near_genotype"))
    return genomic.proximal_variants(somatic, phased, 600).select("event_id", "other")


# --- tables -----------------------------------------------------------------------------------


@query("""SELECT o_orderkey::VARCHAR AS o_orderkey, CASE WHEN o_custkey % 9 = 0 THEN 'NA' WHEN o_custkey % 9 = 1 THEN 'inf' ELSE printf('%.3f', o_totalprice) END AS price, CASE WHEN o_custkey % 2 = 0 THEN 'True' ELSE 'False' END AS flag, coalesce(nullif(o_orderstatus, 'F'), 'NA') AS status FROM orders""")
def exported_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(c("o_custkey") % 9 == 1, F.lit(float("inf"))).when(c("o_custkey") % 9 != 0, c("o_totalprice"))
    df = read(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"), (c("o_custkey") % 2 == 0).alias("flag"), F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    return tables.exported(df)


@query("SELECT p_partkey, try_cast(CASE WHEN p_size % 3 = 0 THEN 'x' ELSE p_retailprice::VARCHAR END AS DOUBLE) AS price FROM part WHERE p_size % 3 <> 0")
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").select("p_partkey", F.when(c("p_size") % 3 == 0, "x").otherwise(c("p_retailprice").cast("string")).alias("price"))
    return tables.scored(df, "price")


@query("SELECT s_name AS allele, 3 AS length, pos::INT AS pos, CASE pos WHEN 1 THEN s_acctbal WHEN 2 THEN s_nationkey::DOUBLE ELSE (s_suppkey % 2)::DOUBLE END AS weight FROM supplier, range(1, 4) r(pos)")
def anchor_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = read(spark, sf_dir, "supplier").select(c("s_name").alias("HLA"), c("s_acctbal").alias("1"), c("s_nationkey").alias("2"), (c("s_suppkey") % 2 == 1).alias("3"))
    return tables.anchor_weights(wide)


_COVERAGE = "coalesce(l_quantity >= 5, true) AND coalesce(l_tax <= 0.05, true)"


@query(f"SELECT {_KEY} FROM lineitem WHERE (l_linenumber = 6 OR l_quantity >= 10) AND l_discount >= 0.02 AND l_tax * 50 >= 1")
def coverage_filter_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"Tumor DNA Depth": F.when(c("l_linenumber") != 6, c("l_quantity")), "Tumor DNA VAF": c("l_discount"), "Gene Expression": c("l_tax") * 50, "Transcript Expression": F.lit(0.0)})
    return filters.coverage_filter(df, Thresholds(tdna_vaf=0.02), "splice").select(*KEY)


@query(f"SELECT {_KEY} FROM lineitem WHERE l_quantity >= 5 AND (l_linenumber = 6 OR l_tax >= 0.03)")
def coverage_filter_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"Read Support": c("l_quantity"), "Expression": F.when(c("l_linenumber") != 6, c("l_tax"))})
    return filters.coverage_filter(df, Thresholds(fusion_expression=0.03), "fusion").select(*KEY)


@query("""SELECT p_partkey, NOT (CASE p_partkey % 4 WHEN 0 THEN p_size % 10 IN (1, 2, 8, 9) WHEN 1 THEN true WHEN 2 THEN false ELSE false END AND (p_partkey % 5 = 0 OR p_retailprice < 1000)) AS passes FROM part""")
def anchor_residue_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = c("p_partkey") % 4
    places = F.when(k == 0, (c("p_size") % 10).cast("string")).when(k == 1, "1, 9").when(k == 2, "1, 2, 9")
    wild = F.when(c("p_partkey") % 5 != 0, c("p_retailprice"))
    return read(spark, sf_dir, "part").select("p_partkey", P.anchor_pass(places, P.default_anchors(F.lit(9)), wild, F.lit(1000.0)).alias("passes"))


@query("SELECT l_suppkey AS allele, string_agg(DISTINCT (l_partkey % 12 + 1)::VARCHAR, ',' ORDER BY (l_partkey % 12 + 1)::VARCHAR) AS anchors FROM lineitem WHERE l_partkey % 5 = 0 GROUP BY l_suppkey")
def anchor_positions_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = read(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("allele"), F.lit(12).alias("length"), (c("l_partkey") % 12 + 1).alias("pos"), (c("l_partkey") % 5 == 0).cast("double").alias("weight"))
    out = aggregate.anchors_of(w, boolean=True)
    return out.select("allele", F.array_join(F.array_sort(c("anchors").cast("array<string>")), ",").alias("anchors"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_suppkey % 3 = 0 AND l_returnflag = 'A'")
def supported_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = read(spark, sf_dir, "lineitem").withColumns({"method": c("l_returnflag"), "allele": c("l_suppkey"), "length": F.lit(9)})
    support = read(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0").select(F.lit("A").alias("method"), c("s_suppkey").alias("allele"), F.lit(9).alias("length"))
    return filters.supported_combinations(wanted, support).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT p_partkey FROM part WHERE p_size % 4 <> 0")
def without_dna_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("allele", F.when(c("p_size") % 4 == 0, "Warning: Potential DNA sequence(s) found").when(c("p_size") % 4 == 1, c("p_brand")))
    return filters.without_dna_warnings(df).select("p_partkey")


@query("SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey > 5) ON o_custkey = c_custkey")
def appended_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = read(spark, sf_dir, "customer").where("c_nationkey > 5").select(c("c_custkey").alias("o_custkey"), "c_mktsegment")
    return filters.append_columns(read(spark, sf_dir, "orders"), other, "o_custkey").select("o_orderkey", "o_totalprice", "c_mktsegment")


@query("SELECT a.n AS alpha, b.n AS beta FROM (SELECT n_name AS n FROM nation WHERE n_nationkey < 8) a, (SELECT n_name AS n FROM nation WHERE n_nationkey >= 8) b WHERE (length(a.n) + length(b.n)) % 2 = 0")
def alpha_beta_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    name = lambda k, df: df.select(F.concat(F.lit(k), "n_name").alias("allele"))
    a, b = name("DPA", n.where("n_nationkey < 8")), name("DPB", n.where("n_nationkey >= 8"))
    valid = a.toDF("a").join(b.toDF("b")).where("(length(a) + length(b)) % 2 = 0").select(F.concat_ws("-", "a", "b").alias("allele"))  # a table of the method's alleles, 25 names
    pairs = predictions.alpha_beta_pairs(a, b.union(b.select(F.regexp_replace("allele", "DPB", "DQB").alias("allele"))), valid)
    return pairs.select(F.expr("substring(split(allele, '-')[0], 4)").alias("alpha"), F.expr("substring(split(allele, '-')[1], 4)").alias("beta"))


@query("SELECT l_suppkey AS allele, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS methods, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS lengths FROM lineitem GROUP BY l_suppkey")
def methods_of_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("allele"), c("l_returnflag").alias("method"), c("l_linenumber").alias("length"))
    return predictions.methods_of_alleles(s).select("allele", F.array_join("methods", ",").alias("methods"), F.array_join(c("lengths").cast("array<string>"), ",").alias("lengths"))


@query("SELECT c_custkey, (c_nationkey < 10 AND c_acctbal > 3000) AS called FROM customer")
def in_two_call_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "customer")
    out = compare.in_two_vcfs(df, df.where("c_nationkey < 10"), df.where("c_acctbal > 3000"), ["c_custkey"])
    return out.select("c_custkey", c("`Variant Called by External Pipeline`").alias("called"))


@query("SELECT c_custkey, c_name AS one, s_name AS two, p_name AS sequence FROM customer JOIN supplier ON s_suppkey = c_custkey LEFT JOIN part ON p_partkey = c_nationkey * 100")
def ordering_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = read(spark, sf_dir, "customer").select(c("c_custkey").alias("ID"), (c("c_nationkey") * 100).cast("long").alias("Index"), c("c_name").alias("n"))
    two = read(spark, sf_dir, "supplier").select(c("s_suppkey").alias("ID"), F.lit(0).alias("Index"), c("s_name").alias("n"))
    form = compare.ordering_form(one, two, read(spark, sf_dir, "part").select(c("p_partkey").alias("Index"), c("p_name").alias("sequence")))
    return form.select(c("ID").alias("c_custkey"), c("`n Class I`").alias("one"), c("`n Class II`").alias("two"), "sequence")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Accept' WHEN c_custkey % 2 = 0 THEN 'Review' ELSE 'Pending' END AS evaluation, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS comments FROM customer")
def own_evaluations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "customer").select(c("c_custkey").alias("ID"), F.when(c("c_custkey") % 2 == 0, "Review").alias("Evaluation"), "c_name")
    own = df.where("ID % 3 = 0").select("ID", F.lit("Accept").alias("Evaluation"), c("c_name").alias("Comments"))
    return compare.with_own_evaluations(df.drop("c_name"), own).select(c("ID").alias("c_custkey"), c("Evaluation").alias("evaluation"), c("Comments").alias("comments"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity * l_tax, 3) AS expr FROM lineitem")
def allele_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", aggregate.allele_expression("l_quantity", "l_tax").alias("expr"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_extendedprice DESC, l_linenumber + l_partkey % 2, l_returnflag DESC) AS k FROM lineitem) SELECT l_orderkey AS a, l_suppkey AS b, l_extendedprice AS weight FROM r WHERE k = 1""")
def best_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = read(spark, sf_dir, "lineitem").select(c("l_orderkey").alias("left"), c("l_suppkey").alias("right"), c("l_extendedprice").alias("weight"), c("l_tax").alias("percentile"), c("l_returnflag").alias("spacer"), c("l_linenumber").alias("left_clip"), (c("l_partkey") % 2).alias("right_clip"))
    return vector.edges(j).select(c("left").alias("a"), c("right").alias("b"), "weight")


@query("""WITH m AS (SELECT p_partkey, p_name[1:4] AS s, l_suppkey FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON l_partkey = p_partkey)
SELECT p_partkey AS query, s AS match_sequence, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS hits, string_agg(DISTINCT 'g' || (l_suppkey % 3), ',' ORDER BY 'g' || (l_suppkey % 3)) AS genes FROM m GROUP BY ALL""")
def grouped_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = read(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey").distinct()
    m = hits.select(c("l_partkey").alias("query"), c("l_suppkey").cast("string").alias("hit"), F.concat(F.lit("x gene_symbol:g"), (c("l_suppkey") % 3).cast("string"), F.lit(" y")).alias("definition"), F.lit(1).alias("match_start"), F.lit(5).alias("match_stop"))
    return reference.grouped_matches(m, read(spark, sf_dir, "part").select(c("p_partkey").alias("query"), c("p_name").alias("sequence"))).select("query", "match_sequence", "hits", "genes")


@query("SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.repeated_ids(read(spark, sf_dir, "lineitem", "l_orderkey"), "l_orderkey")


# --- orders -----------------------------------------------------------------------------------

_TIERS = "CASE o_orderstatus WHEN 'F' THEN 'Pass' WHEN 'O' THEN 'RefMatch' ELSE 'Poor' END"


def _tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = c("o_orderstatus")
    return read(spark, sf_dir, "orders").withColumns({"Tier": F.when(status == "F", "Pass").when(status == "O", "RefMatch").otherwise("Poor"), "x": F.when(c("o_custkey") % 10 != 0, c("o_custkey") % 100)})


@query(f"""SELECT o_orderkey, (row_number() OVER (ORDER BY o_totalprice NULLS LAST, o_orderkey) + row_number() OVER (ORDER BY CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey % 100 END DESC NULLS LAST, o_orderkey))::BIGINT AS rank FROM orders""")
def first_ties_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.rank_sum_order(_tiered(spark, sf_dir), "matched", "o_totalprice", "x", ["o_orderkey"], ties="first").select("o_orderkey", c("rank").cast("long").alias("rank"))


@query(f"SELECT o_orderkey, CASE {_TIERS} WHEN 'Pass' THEN 1 WHEN 'RefMatch' THEN 3 ELSE 5 END AS place, dense_rank() OVER (ORDER BY o_totalprice NULLS LAST)::BIGINT AS rank FROM orders")
def bind_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = candidates.rank_sum_order(_tiered(spark, sf_dir), "bind", "o_totalprice", None, ["o_orderkey"])
    return out.select("o_orderkey", candidates.tier_place("bind").alias("place"), c("rank").cast("long").alias("rank"))


def _ordered(df: DataFrame, order: list, keys: list[str]) -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn("place", F.row_number().over(Window.partitionBy("l_suppkey").orderBy(*order, "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))).select(*keys, "place")


_OWN = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"


@query(f"SELECT {_KEY}, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity, l_discount DESC NULLS LAST, l_tax, {_OWN})::INT AS place FROM lineitem")
def default_order_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"Median MT IC50 Score": c("l_quantity"), "Corresponding Fold Change": c("l_discount"), "Best MT IC50 Score": c("l_tax")})
    return _ordered(df, candidates.default_order("matched"), KEY)


@query(f"SELECT {_KEY}, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_tax, l_linenumber, l_quantity, l_returnflag, {_OWN})::INT AS place FROM lineitem")
def default_order_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"Median IC50 Score": c("l_quantity"), "Sub-peptide Position": c("l_linenumber"), "Best IC50 Score": c("l_tax"), "Mutation": c("l_returnflag")})
    return _ordered(df, candidates.default_order("bind", "lowest"), KEY)


@query(f"SELECT {_KEY}, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity, l_tax, l_returnflag, {_OWN})::INT AS place FROM lineitem")
def default_order_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "lineitem").withColumns({"Median IC50 Score": c("l_quantity"), "Best IC50 Score": c("l_tax"), "Index": c("l_returnflag")})
    return _ordered(df, candidates.default_order("splice"), KEY)


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 4 = 0 THEN 'infinity'::DOUBLE ELSE o_orderkey % 23 END, o_custkey, o_orderkey)::INT AS place FROM orders""")
def genomic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    chrom = F.when(c("o_orderkey") % 4 == 0, "X").otherwise((c("o_orderkey") % 23).cast("string"))
    df = read(spark, sf_dir, "orders").withColumn("ID", F.concat_ws("-", F.concat(F.lit("chr"), chrom), c("o_custkey").cast("string"), c("o_orderkey").cast("string"), F.lit("A"), F.lit("T")))
    return df.withColumn("place", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*candidates.genomic_order()))).select("o_orderkey", "place")


@query("SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def in_order_of_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = read(spark, sf_dir, "customer").where("c_acctbal > 5000").select(c("c_custkey").alias("o_custkey"), c("c_acctbal").alias("row"))
    return candidates.in_order_of(read(spark, sf_dir, "orders"), order, "o_custkey").select("o_orderkey", "o_totalprice")


# --- tiers and forms ------------------------------------------------------------------------------


@query(f"""WITH {_REPORT}, p AS (SELECT *, ic50 < 60000 AND pct <= 0.08 AS b, coalesce(ae > 2.5, true) AS x, dvaf >= 0.1 AS cl, ae IS NOT NULL AND (ae > 0 OR (rna = 0 AND rdepth > 10 AND rvaf > 0.25)) AS low FROM r) SELECT {_KEY}, CASE
 WHEN b AND x AND cl AND tr AND anchor AND NOT refm AND okp THEN 'Pass' WHEN NOT b AND x AND cl AND tr AND anchor AND NOT refm AND okp THEN 'PoorBinder' WHEN b AND x AND cl AND tr AND anchor AND refm AND okp THEN 'RefMatch'
 WHEN b AND x AND cl AND tr AND anchor AND NOT refm AND NOT okp THEN 'ProbPos' WHEN b AND x AND cl AND NOT tr AND anchor AND NOT refm AND okp THEN 'PoorTranscript' WHEN b AND x AND cl AND tr AND NOT anchor AND NOT refm AND okp THEN 'Anchor'
 WHEN b AND x AND NOT cl AND tr AND anchor AND NOT refm AND okp THEN 'Subclonal' WHEN b AND low AND cl AND tr AND anchor AND NOT refm AND okp THEN 'LowExpr' WHEN (rna = 0 OR rvaf = 0) AND NOT low THEN 'NoExpr' ELSE 'Poor' END AS tier FROM p""")
def tier_viewer(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _report(spark, sf_dir)
    return r.select(*KEY, tiers.matched_tier(r, _T, 0.2, c("anchor"), mode="viewer").alias("tier"))


@query(f"""WITH {_REPORT} SELECT {_KEY}, ic50 < 60000 AS ic50_pass, pct <= 0.08 AS percentile_pass, dvaf >= 0.1 AS clonal_pass, coalesce(ae > 2.5, true) AS allele_expr_pass, rna > 0 AS rna_expr_pass, okp AS prob_pass, l_linestatus = 'O' AS mane_pass, ic50 / 60000 AS scaled FROM r JOIN (SELECT DISTINCT l_orderkey AS a, l_partkey AS b, l_suppkey AS c, l_linenumber AS d, l_extendedprice AS e, l_linestatus FROM lineitem) ON a = l_orderkey AND b = l_partkey AND c = l_suppkey AND d = l_linenumber AND e = l_extendedprice""")
def viewer_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = tiers.viewer_flags(_report(spark, sf_dir), _T, 0.2, c("anchor"))
    names = {"IC50 Pass": "ic50_pass", "Percentile Pass": "percentile_pass", "Clonal Pass": "clonal_pass", "Allele Expr Pass": "allele_expr_pass", "RNA Expr Pass": "rna_expr_pass", "Prob Pos Pass": "prob_pass", "MANE Pass": "mane_pass"}
    return f.select(*KEY, *[c(f"`{k}`").alias(v) for k, v in names.items()], c("`Scaled BA`").alias("scaled"))


@query("""SELECT event_id, (props->>'$.k')::INT AS k, 60000.0::DOUBLE AS binding, 0.08::DOUBLE AS percentile, 'conservative' AS strategy, 0.2::DOUBLE AS vaf FROM events""")
def metrics_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", F.struct(F.from_json("props", "k int")["k"].alias("k"), F.lit(500.0).alias("binding_threshold"), F.lit(9.0).alias("vaf_clonal")).alias("parameters"))
    m = tiers.metrics_refreshed(e, _T, 0.2)
    return m.select("event_id", "parameters.k", c("parameters.binding_threshold").alias("binding"), c("parameters.percentile_threshold").alias("percentile"), c("parameters.percentile_threshold_strategy").alias("strategy"), c("parameters.vaf_clonal").alias("vaf"))


@query("SELECT p_partkey, p_brand || ' (' || p_type || ')' AS gene_change, 'chr' || p_size AS chromosome, p_partkey AS start, p_partkey + 1 AS stop, 'A' AS reference FROM part")
def report_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "part").withColumn("ID", F.concat_ws("-", F.concat(F.lit("chr"), c("p_size").cast("string")), c("p_partkey").cast("string"), (c("p_partkey") + 1).cast("string"), F.lit("A"), F.lit("T")))
    df = compare.normalised_names(df.withColumnRenamed("p_brand", "gene"), {"gene": "Gene", "nothing": "else"})
    out = compare.split_id(df).withColumn("gene_change", compare.gene_change_id("Gene", "p_type"))
    return out.select("p_partkey", "gene_change", c("Chromosome").alias("chromosome"), c("Start").alias("start"), c("Stop").alias("stop"), c("Reference").alias("reference"))


@query("""SELECT 'k' || event_id AS key, (props->>'$.k') AS value_1, ((props->>'$.k')::INT + event_id % 2)::VARCHAR AS value_2 FROM events WHERE event_id % 2 = 1""")
def json_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k int")["k"])
    entry = lambda v: F.concat(F.lit('{"k'), c("event_id").cast("string"), F.lit('":'), v.cast("string"), F.lit(',"chr'), c("event_id").cast("string"), F.lit('":1}'))
    listed = lambda v, order: F.concat(F.lit('{"l'), c("event_id").cast("string"), F.lit(f'":{order}}}'))  # noqa: E731, ARG005
    a = e.select(entry(c("k")).alias("j")).union(e.select(listed(None, '["x","y"]').alias("j")))
    b = e.select(entry(c("k") + c("event_id") % 2).alias("j")).union(e.select(listed(None, '["y","x"]').alias("j")))
    return compare.json_differences(a, b).select("key", "value_1", "value_2")


@query("SELECT l_orderkey, 'm' AS method, min(l_extendedprice) AS score FROM lineitem WHERE l_extendedprice > 0 GROUP BY l_orderkey")
def methods_lengthened(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(F.nullif("l_extendedprice", F.lit(0.0))).alias("m IC50 Score"), F.lit(None).cast("double").alias("n IC50 Score"))
    return predictions.lengthened(wide, ["l_orderkey"], ["m", "n"])


@query("""WITH m AS (SELECT l_orderkey, l_suppkey, l_returnflag AS allele, min(l_extendedprice) AS value FROM lineitem GROUP BY ALL) SELECT * FROM m""")
def viewer_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = aggregate.peptide_calls(read(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_suppkey", "l_returnflag", ["A", "N", "R"], "l_extendedprice", "l_tax")
    keys = ["l_orderkey", "l_suppkey"]
    return compare.gathered(compare.calls_by_allele(calls, keys, ["A", "N", "R"]), keys)


@query("""WITH p AS (SELECT DISTINCT p_name AS epitope, length(p_name) AS length, l_suppkey % 3 AS a FROM part JOIN lineitem ON l_partkey = p_partkey) SELECT 'A' || a AS allele, epitope, m AS method, CASE m WHEN 'one' THEN length * 10.0 + a ELSE length / 2.0 END::DOUBLE AS score FROM p, (VALUES ('one'), ('two')) v(m)""")
def predicted_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions.register("one", _one)
    predictions.register("two", _two)
    p = read(spark, sf_dir, "part").join(read(spark, sf_dir, "lineitem"), c("l_partkey") == c("p_partkey"))
    peptides = p.select(F.concat(F.lit("A"), (c("l_suppkey") % 3).cast("string")).alias("allele"), F.length("p_name").alias("length"), c("p_name").alias("epitope"))
    return predictions.predict(peptides, ["one", "two"]).select("allele", "epitope", "method", "score")


def _one(f):  # noqa: ANN001, ANN202
    return f.assign(score=f["length"] * 10.0 + f["allele"].str[1:].astype(float), percentile=0.5)


def _two(f):  # noqa: ANN001, ANN202
    return f.assign(score=f["length"] / 2.0, percentile=0.1)
