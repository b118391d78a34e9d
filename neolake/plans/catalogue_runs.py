"""Queries of whole runs' steps: haplotypes, splicing, fusions, constructs, documents and metrics, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neolake.functions import sequences as S
from neolake.operators import alignment, candidates, constructs, documents, haplotypes, metrics, predictions, splicing
from neolake.plans import other_runs, post
from neolake.plans.catalogue import _CODONS_SQL, query, read
from neolake.plans.standins import _TIE, PROTEINS, TIE, T, X, proteins, table
from neolake.sources import vcf
from neolake.storage import spread, stored

c = F.col

# --- haplotypes: an order is a variant of its customer's protein ------------------------------
# 96 bases without a T code for 32 residues and no stop; an order changes one base.

_BASES = "translate(md5({0}::VARCHAR) || md5(({0} + 1)::VARCHAR) || md5(({0} + 2)::VARCHAR), '0123456789abcdef', 'ACGACGACGACGACGA')"
_CALLS = f"""
o AS (SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus <> 'F' AS som, (o_orderkey % 32 + 1)::INT AS p, (o_orderkey // 32 % 3 + 1)::INT AS b, {_BASES.format("o_custkey")} AS dna FROM orders),
v AS (SELECT *, 3 * (p - 1) + b AS g, substr(dna, 3 * p - 2, 3) AS codon, translate(substr(dna, 3 * (p - 1) + b, 1), 'ACG', 'CGA') AS new FROM o),
w AS (SELECT *, substr(codon, 1, b - 1) || new || substr(codon, b + 1) AS after FROM v),
m AS MATERIALIZED (SELECT * FROM w WHERE {_CODONS_SQL}[codon] <> {_CODONS_SQL}[after]),
ph AS MATERIALIZED (SELECT cust, g, p, b, new, nullif(min(k % 4), 0) AS hp, bool_or(k % 5 = 0) AS hom, bool_or(som) AS som FROM m GROUP BY cust, g, p, b, new)"""
_NEAR = """
n AS (SELECT s.k, x.p, x.b, x.new, x.som FROM m s JOIN ph own ON own.cust = s.cust AND own.g = s.g JOIN ph x ON x.cust = s.cust AND abs(x.g - s.g) <= 9 AND x.g <> s.g
  WHERE s.som AND CASE WHEN own.hp IS NOT NULL AND x.hp IS NOT NULL THEN own.hp = x.hp ELSE x.hom END)"""


def _calls(spark: SparkSession, sf_dir: str, *unused: str) -> DataFrame:
    key, cust = c("o_orderkey"), c("o_custkey")
    md5 = lambda k: F.md5((cust + k).cast("string").cast("binary"))
    df = spread(read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")).withColumns({"p": (key % 32 + 1).cast("int"), "b": (F.floor(key / 32) % 3 + 1).cast("int"), "dna": F.translate(F.concat(md5(0), md5(1), md5(2)), "0123456789abcdef", "ACGACGACGACGACGA")})
    df = df.withColumn("start", 3 * (c("p") - 1) + c("b")).withColumn("reference", F.substr("dna", "start", F.lit(1))).withColumn("variant", F.translate("reference", "ACG", "CGA"))
    wild = F.lower(F.substr("dna", 3 * c("p") - 2, F.lit(3)))
    marked = lambda base: F.overlay(wild, base, c("b"), F.lit(1))
    change = F.concat_ws("/", S.translate_dna(wild), S.translate_dna(marked(c("variant"))))
    rows = df.select(
        key.cast("string").alias("index"), cust.alias("chromosome_name"), "start", c("start").alias("stop"), "reference", "variant", F.concat(F.lit("T"), cust).alias("transcript_name"), F.lit("missense").alias("variant_type"), change.alias("amino_acid_change"),
        F.concat_ws("/", marked(c("reference")), marked(c("variant"))).alias("codon_change"), c("p").cast("string").alias("protein_position"), S.translate_dna(c("dna")).alias("wildtype_amino_acid_sequence"), F.lit(None).cast("string").alias("frameshift_amino_acid_sequence"), "o_orderstatus", "o_orderkey",
    )
    # made once, and stored before the filter, which would make each change anew; several steps read them
    made = stored(rows.drop(*unused), "calls")
    return made.where(F.split_part("amino_acid_change", F.lit("/"), F.lit(1)) != F.split_part("amino_acid_change", F.lit("/"), F.lit(2)))


def _phased(calls: DataFrame) -> DataFrame:
    site = [*haplotypes.SITE, "stop", "transcript_name", "amino_acid_change", "codon_change", "protein_position"]
    return calls.groupBy(*site).agg(F.nullif(F.min(c("o_orderkey") % 4), F.lit(0)).cast("string").alias("phase"), F.bool_or(c("o_orderkey") % 5 == 0).alias("homozygous"))


@query(f"WITH {_CALLS}, {_NEAR} SELECT k::VARCHAR AS \"index\", p::VARCHAR AS protein_position, 3 * (p - 1) + b AS start, CASE WHEN som THEN 'somatic' ELSE 'germline' END AS kind FROM n")
def phased_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _calls(spark, sf_dir, "wildtype_amino_acid_sequence")
    return haplotypes.neighbours(calls.where("o_orderstatus <> 'F'"), _phased(calls), 9).select("index", "protein_position", "start", "kind")


@query(f"""WITH {_CALLS}, {_NEAR}, r AS (SELECT m.k, m.p, m.b, m.new, m.dna, q, substr(m.dna, 3 * q - 2, 3) AS codon FROM m, (SELECT unnest(range(1, 33))::INT AS q) WHERE m.som),
z AS (SELECT k, p AS q, max(CASE WHEN b = 1 THEN new END) AS a1, max(CASE WHEN b = 2 THEN new END) AS a2, max(CASE WHEN b = 3 THEN new END) AS a3,
  max(CASE WHEN b = 1 AND NOT som THEN new END) AS g1, max(CASE WHEN b = 2 AND NOT som THEN new END) AS g2, max(CASE WHEN b = 3 AND NOT som THEN new END) AS g3 FROM n GROUP BY k, p),
x AS (SELECT r.k, r.p, r.q, coalesce(CASE WHEN q_own AND r.b = 1 THEN r.new END, a1, substr(codon, 1, 1)) || coalesce(CASE WHEN q_own AND r.b = 2 THEN r.new END, a2, substr(codon, 2, 1)) || coalesce(CASE WHEN q_own AND r.b = 3 THEN r.new END, a3, substr(codon, 3, 1)) AS mt,
  coalesce(g1, substr(codon, 1, 1)) || coalesce(g2, substr(codon, 2, 1)) || coalesce(g3, substr(codon, 3, 1)) AS wt FROM (SELECT *, p = q AS q_own FROM r) r LEFT JOIN z ON z.k = r.k AND z.q = r.q),
s AS (SELECT k, p, string_agg({_CODONS_SQL}[mt], '' ORDER BY q) AS mt, string_agg({_CODONS_SQL}[wt], '' ORDER BY q) AS wt FROM x GROUP BY k, p)
SELECT 'MT.' || k AS id, substr(mt, greatest(p - 8, 1), least(p + 8, 32) - greatest(p - 8, 1) + 1) AS sequence FROM s
UNION ALL SELECT 'WT.' || k, substr(wt, greatest(1, least(p - 8, 16)), 17) FROM s""")
def haplotype_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _calls(spark, sf_dir)
    somatic = calls.where("o_orderstatus <> 'F'")
    near = haplotypes.neighbours(somatic, _phased(calls), 9)
    return post.variant_sequences(haplotypes.with_neighbours(somatic, near), 8)


# --- splicing: an order is a junction of its own transcript of four exons --------------------

_HEX = "'0123456789abcdef', 'ACGTACGTACGTACGT'"
_MODELS = f"""
ge AS MATERIALIZED (SELECT p_partkey % 25 AS chrom, string_agg(translate(md5(p_partkey::VARCHAR), {_HEX}), '' ORDER BY p_partkey) AS seq FROM part GROUP BY ALL),
sn AS (SELECT s_nationkey AS chrom, s_suppkey * 7 % 200 + 1 AS pos, min(substr('ACGT', (s_suppkey % 4 + 1)::INT, 1)) AS alt FROM supplier GROUP BY ALL),
gn AS MATERIALIZED (SELECT chrom, string_agg(base, '' ORDER BY i) AS seq FROM (SELECT u.chrom, u.i, coalesce(sn.alt, u.base) AS base FROM (SELECT chrom, unnest(string_split(seq, '')) AS base, unnest(range(1, length(seq) + 1)) AS i FROM ge) u LEFT JOIN sn ON sn.chrom = u.chrom AND sn.pos = u.i) GROUP BY chrom),
t AS (SELECT o_orderkey AS k, o_custkey % 25 AS chrom, CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand, ['A', 'D', 'NDA'][o_orderkey % 3 + 1] AS anchor,
  list_transform(range(4), lambda j: {{'a': (o_orderkey % 40 + 1 + 50 * j + o_orderkey // (j + 1) % 7)::INT, 'z': (o_orderkey % 40 + 15 + 50 * j + o_orderkey // (j + 1) % 7 + (o_custkey + j) % 11)::INT}}) AS ex FROM orders),
j AS (SELECT *, CASE WHEN anchor = 'NDA' THEN ex[1].z WHEN (anchor = 'A') = (strand = '+') THEN ex[2].a + 5 + k % 9 ELSE ex[2].z END AS s, CASE WHEN anchor = 'NDA' THEN ex[3].a + (k % 7 = 0)::INT WHEN (anchor = 'A') = (strand = '+') THEN ex[3].a ELSE ex[3].z - 10 + k % 30 END AS e FROM t),
al AS (SELECT *, CASE WHEN anchor = 'NDA' THEN CASE WHEN k % 7 <> 0 THEN [ex[1], ex[3], ex[4]] END WHEN (anchor = 'A') = (strand = '+') THEN [ex[1], {{'a': ex[2].a, 'z': s::INT}}, ex[3], ex[4]]
  WHEN e = ex[3].z OR e >= ex[4].z THEN NULL WHEN e < ex[3].z THEN [ex[1], ex[2], {{'a': e::INT, 'z': ex[3].z}}, ex[4]] ELSE [ex[1], ex[2], ex[3], {{'a': e::INT, 'z': ex[4].z}}] END AS alt FROM j),
dn AS (SELECT al.k, al.strand, list_reduce(list_transform(alt, lambda x: CASE WHEN x.a <= x.z THEN substr(seq, x.a, x.z - x.a + 1) ELSE '' END), lambda x, y: x || y) AS alt, list_reduce(list_transform(ex, lambda x: substr(seq, x.a, x.z - x.a + 1)), lambda x, y: x || y) AS wt
  FROM al JOIN gn ON gn.chrom = al.chrom WHERE alt IS NOT NULL),
rc AS (SELECT k, CASE WHEN strand = '-' THEN translate(reverse(alt), 'ACGT', 'TGCA') ELSE alt END AS alt, CASE WHEN strand = '-' THEN translate(reverse(wt), 'ACGT', 'TGCA') ELSE wt END AS wt FROM dn),
pr AS MATERIALIZED (SELECT k, length(alt) % 3 <> 0 AS fs, {{alt}} AS alt, {{wt}} AS wt FROM rc)"""
_PADDED = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in (S.CODONS | S._SHORT).items()) + "}"
_TRANSLATED = "split_part(array_to_string(list_transform(range(0, (length({0}) + 2) // 3), lambda i: coalesce(" + _PADDED + "[substr({0}, i * 3 + 1, 3)], 'X')), ''), '*', 1)"
_PROTEINS = _MODELS.replace("{alt}", _TRANSLATED.replace("{0}", "alt")).replace("{wt}", _TRANSLATED.replace("{0}", "wt"))


def _splice_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Junctions, exons, the genome and a sample's substitutions."""
    key, cust = c("o_orderkey"), c("o_custkey")
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    first = lambda j: (key % 40 + 1 + 50 * j + F.floor(key / (j + 1)) % 7).cast("int")
    exons = [F.struct(first(j).alias("start"), (first(j) + 14 + (cust + j) % 11).cast("int").alias("stop")) for j in range(4)]
    o = o.withColumns({"exons": F.array(*exons), "strand": F.when(c("o_orderstatus") == "F", "-").otherwise("+"), "anchor": F.element_at(F.array(F.lit("A"), F.lit("D"), F.lit("NDA")), (key % 3 + 1).cast("int"))})
    ex = lambda j, x: c("exons")[j][x]
    skip, acceptor = c("anchor") == "NDA", (c("anchor") == "A") == (c("strand") == "+")
    start = F.when(skip, ex(0, "stop")).when(acceptor, ex(1, "start") + 5 + key % 9).otherwise(ex(1, "stop"))
    stop = F.when(skip, ex(2, "start") + (key % 7 == 0).cast("int")).when(acceptor, ex(2, "start")).otherwise(ex(2, "stop") - 10 + key % 30)
    junctions = o.select(key.cast("string").alias("index"), (cust % 25).cast("string").alias("chrom"), key.alias("transcript_id"), start.cast("int").alias("start"), stop.cast("int").alias("stop"), "anchor", "strand")
    part = read(spark, sf_dir, "part", "p_partkey")
    bases = F.translate(F.md5(c("p_partkey").cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT")
    genome = part.groupBy((c("p_partkey") % 25).cast("string").alias("chrom")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", bases.alias("b")))), lambda x: x["b"]), "").alias("sequence"))
    new = read(spark, sf_dir, "supplier").select(c("s_nationkey").cast("string").alias("chrom"), (c("s_suppkey") * 7 % 200 + 1).alias("pos"), F.substr(F.lit("ACGT"), (c("s_suppkey") % 4 + 1).cast("int"), F.lit(1)).alias("alt"))
    return junctions, o.select(key.alias("transcript_id"), "exons"), genome, new


def _splice_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    junctions, exons, genome, new = _splice_tables(spark, sf_dir)
    return splicing.junction_proteins(junctions, exons, splicing.personal_pieces(splicing.genome_pieces(genome), new))


@query(f"""WITH {_PROTEINS}, b AS (SELECT k || CASE WHEN fs THEN '.frameshift_splice_site' ELSE '.inframe_splice_site' END AS "index", alt, wt FROM pr WHERE alt LIKE 'M%' AND wt LIKE 'M%')
SELECT "index", 'ALT' AS side, alt AS protein FROM b UNION ALL SELECT "index", 'WT', wt FROM b""")
def splice_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _splice_proteins(spark, sf_dir).select("index", "side", "protein")


@query(f"""WITH {_PROTEINS}, b AS (SELECT k || CASE WHEN fs THEN '.frameshift_splice_site' ELSE '.inframe_splice_site' END AS "index", alt, wt FROM pr WHERE alt LIKE 'M%' AND wt LIKE 'M%'),
s AS (SELECT "index", wt, n, unnest(list_transform(range(1, greatest(length(alt) - n + 1, 0) + 1), lambda i: {{'k': substr(alt, i, n), 'i': i}})) AS x FROM b, (SELECT unnest([4, 6])::INT AS n))
SELECT "index", x.k AS epitope, n AS length, max(x.i)::INT AS position FROM s WHERE NOT contains(wt, x.k) AND NOT contains(x.k, 'X') GROUP BY ALL""")
def splice_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return other_runs.splice_kmers(_splice_proteins(spark, sf_dir), [4, 6])


# --- fusions: a line item joins its order's gene to its part's --------------------------------

_FUSED = """
d AS (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_quantity::INT AS q, l_suppkey FROM lineitem),
f AS (SELECT 'chr' || l_orderkey % 22 AS c1, l_orderkey AS p1, (l_partkey % 22)::VARCHAR AS c2, l_partkey AS p2, 'G' || l_orderkey || '-G' || l_partkey AS gene, 'T' || l_orderkey || '-T' || l_linenumber AS tr, l_linenumber % 2 = 0 AS fs, q AS reads,
  translate(md5(l_orderkey::VARCHAR), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') AS a, translate(md5(l_partkey::VARCHAR), '0123456789abcdef', 'ACDEFGHIKLMNPQRX') || CASE WHEN l_suppkey % 3 = 0 THEN 'X' ELSE '' END AS z, (l_suppkey % 33)::INT AS n, l_orderkey, l_partkey FROM d),
st AS (SELECT l_orderkey, l_partkey, max(struct_pack(r := l_quantity::INT, x := l_extendedprice)) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
g AS (SELECT row_number() OVER (ORDER BY regexp_replace(c1, '^chr', ''), p1, c2, p2, gene, tr, CASE WHEN fs THEN 'frameshift_fusion' ELSE 'inframe_fusion' END, substr(a, 1, n) || z, n, reads) AS i, f.*, st.s.x AS expression FROM f LEFT JOIN st ON st.l_orderkey = f.l_orderkey AND st.l_partkey = f.l_partkey)"""


def _fusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", c("l_quantity").cast("int").alias("q"), "l_suppkey").distinct()
    name = lambda k, to: F.translate(F.md5(c(k).cast("string").cast("binary")), "0123456789abcdef", to)
    cat = lambda *x: F.concat(*[F.lit(v) if v.isalpha() or v == "-" else c(v).cast("string") for v in x])
    peptide = F.concat(F.left(name("l_orderkey", "ACDEFGHIKLMNPQRS"), (c("l_suppkey") % 33).cast("int")), F.lit("|"), name("l_partkey", "ACDEFGHIKLMNPQRX"), F.when(c("l_suppkey") % 3 == 0, "X*").otherwise("*"))
    fused = d.select(
        F.concat(F.lit("chr"), c("l_orderkey") % 22).alias("left_chrom"), c("l_orderkey").alias("left_pos"), (c("l_partkey") % 22).cast("string").alias("right_chrom"), c("l_partkey").alias("right_pos"), cat("G", "l_orderkey", "-", "G", "l_partkey").alias("gene_name"),
        cat("T", "l_orderkey", "-", "T", "l_linenumber").alias("transcript_name"), F.when(c("l_linenumber") % 2 == 0, "frameshift_fusion").otherwise("inframe_fusion").alias("variant_type"), peptide.alias("peptide"), c("q").alias("read_support"),
    )
    star = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select((c("l_orderkey") % 22).cast("string").alias("left_chrom"), c("l_orderkey").alias("left_pos"), F.concat(F.lit("chr"), c("l_partkey") % 22).alias("right_chrom"), c("l_partkey").alias("right_pos"), c("l_quantity").cast("int").alias("read_support"), c("l_extendedprice").alias("expression"))
    return other_runs.called_fusions(fused, star)


@query(f"""WITH {_FUSED} SELECT i || '.' || gene || '.' || tr || '.' || CASE WHEN fs THEN 'frameshift_fusion' ELSE 'inframe_fusion' END || '.' || n AS "index", regexp_replace(c1, '^chr', '') || ' / ' || c2 AS chromosome_name, p1 || ' / ' || p2 AS start, reads AS read_support, expression FROM g""")
def fusion_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fusions(spark, sf_dir).select("index", "chromosome_name", "start", "read_support", "expression")


@query(f"""WITH {_FUSED}, w AS (SELECT i, substr(substr(a, 1, n) || z, greatest(n - 9, 0) + 1, CASE WHEN fs THEN n + 12 ELSE n + 9 END - greatest(n - 9, 0)) AS s, gene || '.' || tr || '.' || CASE WHEN fs THEN 'frameshift_fusion' ELSE 'inframe_fusion' END || '.' || n AS name FROM g)
SELECT i || '.' || name AS "index", regexp_replace(s, 'X$', '') AS sequence FROM w WHERE NOT contains(regexp_replace(s, 'X$', ''), 'X') AND length(regexp_replace(s, 'X$', '')) >= 9""")
def fusion_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return other_runs.fusion_sequences(_fusions(spark, sf_dir), 9, 12, shortest=9)


# --- alignment: a part's mutant protein against its wild type ----------------------------------

_LOW = "-1e18::DOUBLE"
_DIAGONALS = f"""
al AS (SELECT p_partkey AS k, wt, mt, length(wt)::INT AS n, length(mt)::INT AS m, 0 AS d, list_transform(range(0, length(wt) + 1), lambda i: CASE WHEN i = 0 THEN 0.0::DOUBLE ELSE {_LOW} END) AS m1,
  list_transform(range(0, length(wt) + 1), lambda i: {_LOW}) AS x1, list_transform(range(0, length(wt) + 1), lambda i: {_LOW}) AS y1, list_transform(range(0, length(wt) + 1), lambda i: {_LOW}) AS m2, list_transform(range(0, length(wt) + 1), lambda i: {_LOW}) AS x2,
  list_transform(range(0, length(wt) + 1), lambda i: {_LOW}) AS y2 FROM p
UNION ALL SELECT k, wt, mt, n, m, d + 1,
  list_transform(range(0, n + 1), lambda i: CASE WHEN i >= 1 AND d + 1 - i BETWEEN 1 AND m THEN greatest(m2[i], x2[i], y2[i]) + CASE WHEN substr(wt, i::INT, 1) = substr(mt, (d + 1 - i)::INT, 1) THEN 2.0 ELSE -1.0 END ELSE {_LOW} END),
  list_transform(range(0, n + 1), lambda i: CASE WHEN i >= 1 AND d + 1 - i BETWEEN 0 AND m THEN greatest(m1[i] - 5, x1[i] - 0.5, y1[i] - 5) ELSE {_LOW} END),
  list_transform(range(0, n + 1), lambda i: CASE WHEN d + 1 - i BETWEEN 1 AND m THEN greatest(m1[i + 1] - 5, x1[i + 1] - 5, y1[i + 1] - 0.5) ELSE {_LOW} END), m1, x1, y1 FROM al WHERE d < n + m)"""


@query(f"WITH RECURSIVE {PROTEINS}, {_DIAGONALS} SELECT k AS p_partkey, greatest(m1[n + 1], x1[n + 1], y1[n + 1]) AS score, greatest(m1[n + 1], x1[n + 1], y1[n + 1]) AS counted, wt, mt FROM al WHERE d = n + m")
def aligned_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = proteins(spark, sf_dir).select("p_partkey", alignment.aligned(c("wt"), c("mt")).alias("a")).select("p_partkey", "a.*")
    gaps = sum((F.regexp_count(x, F.lit("-+")) for x in ("wild", "mutant")), F.lit(0))
    dashes = sum((F.regexp_count(x, F.lit("-")) for x in ("wild", "mutant")), F.lit(0))
    same = S.matches(c("wild"), c("mutant"))
    counted = 2.0 * same - 1.0 * (F.length("wild") - dashes - same) - 5.0 * gaps - 0.5 * (dashes - gaps)
    return rows.select("p_partkey", "score", counted.alias("counted"), F.replace("wild", F.lit("-"), F.lit("")).alias("wt"), F.replace("mutant", F.lit("-"), F.lit("")).alias("mt"))


# --- documents: an order's lines as one nested object, and a changed version of it ---------------

_LISTED = """
l AS (SELECT l_orderkey AS o, l_partkey AS p, l_quantity::INT AS q, l_returnflag AS f, l_linenumber AS n, floor(l_extendedprice)::BIGINT AS x FROM lineitem),
t AS (SELECT o, max(x) AS top FROM l GROUP BY o),
i AS (SELECT o, '{"p":' || p || ',"q":' || q || '}' AS e, 1 AS a, 0 AS b FROM l UNION ALL SELECT o, '{"p":' || p || ',"q":' || CASE WHEN p % 10 = 0 THEN q + 1 ELSE q END || '}', 0, 1 FROM l),
g AS (SELECT o, '"' || f || '"' AS e, 1 AS a, 0 AS b FROM l UNION ALL SELECT o, '"' || f || '"', 0, 1 FROM l WHERE n <> 3)"""


@query(f"""WITH {_LISTED}
SELECT o AS doc, '/items[]' AS path, CASE WHEN sum(a) > 0 THEN e END AS value_1, CASE WHEN sum(b) > 0 THEN e END AS value_2, sum(a)::BIGINT AS n_1, sum(b)::BIGINT AS n_2 FROM i GROUP BY o, e HAVING sum(a) <> sum(b)
UNION ALL SELECT o, '/more/flags[]', CASE WHEN sum(a) > 0 THEN e END, CASE WHEN sum(b) > 0 THEN e END, sum(a)::BIGINT, sum(b)::BIGINT FROM g GROUP BY o, e HAVING sum(a) <> sum(b)
UNION ALL SELECT o, '/more/flags', NULL, '[]', 0, 1 FROM l GROUP BY o HAVING bool_and(n = 3)
UNION ALL SELECT o, '/more/top', top::VARCHAR, (top + 1)::VARCHAR, 1, 1 FROM t WHERE o % 3 = 0
UNION ALL SELECT o, '/extra~1', NULL, '"x"', 0, 1 FROM t WHERE o % 5 = 0""")
def document_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", c("l_partkey").alias("p"), c("l_quantity").cast("int").alias("q"), "l_returnflag", "l_linenumber", F.floor("l_extendedprice").alias("x"))
    late = F.when(c("p") % 10 == 0, c("q") + 1).otherwise(c("q"))
    items = lambda q: F.sort_array(F.collect_list(F.struct("p", q.alias("q"))))
    flags = F.collect_list(F.when(c("l_linenumber") != 3, c("l_returnflag")))
    all_ = rows.groupBy("l_orderkey").agg(items(c("q")).alias("i1"), F.reverse(items(late)).alias("i2"), F.collect_list("l_returnflag").alias("f1"), F.sort_array(flags, False).alias("f2"), F.max("x").alias("top"))
    key = c("l_orderkey")
    first = F.struct(c("i1").alias("items"), F.struct(c("top"), c("f1").alias("flags")).alias("more"), F.lit(1).alias("chr1"))
    second = F.struct(F.when(key % 5 == 0, "x").alias("extra/"), F.struct(c("f2").alias("flags"), (c("top") + F.when(key % 3 == 0, 1).otherwise(0)).alias("top")).alias("more"), c("i2").alias("items"))
    docs = lambda x: all_.select(key.alias("doc"), F.to_json(x).alias("json"))
    return documents.document_differences(docs(first), docs(second), "^chr")


# --- methods with several scores ------------------------------------------------------------------

_METHODS = """
r AS (SELECT p_partkey AS k, 'MHCflurry' AS method, p_size::DOUBLE AS ic50, [p_size / 4.0, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size / 2.0 END] AS ranks, [p_size / 8.0, 3.0] AS wt_ranks, 100.0::DOUBLE AS wt FROM part
  UNION ALL SELECT p_partkey, 'NetMHC', CASE WHEN p_size % 7 = 0 THEN NULL ELSE floor(p_retailprice / 40) END, [p_partkey % 20], [5.0], p_size::DOUBLE FROM part UNION ALL SELECT p_partkey, 'BigMHC_EL', NULL, [NULL], [NULL], NULL FROM part),
s AS (SELECT k, min([ic50::VARCHAR, method]) AS _, median(ic50) AS median_score FROM r WHERE method <> 'BigMHC_EL' GROUP BY k),
b AS (SELECT k, ic50, method, wt, row_number() OVER (PARTITION BY k ORDER BY ic50, method) AS n FROM r WHERE ic50 IS NOT NULL),
q AS (SELECT k, method, unnest(ranks)::DOUBLE AS v, unnest(wt_ranks)::DOUBLE AS wt, unnest(['percentile', 'presentation'][1:len(ranks)]) AS kind FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v, method, CASE kind WHEN 'percentile' THEN 2 ELSE 1 END) AS n FROM q WHERE v IS NOT NULL), m AS (SELECT k, median(v) AS v, median(wt) AS wt FROM q GROUP BY k)"""


@query(f"""WITH {_METHODS} SELECT s.k AS p_partkey, b.ic50 AS best_score, b.method AS best_score_method, b.wt AS corresponding_wt_score, s.median_score, p.v AS best_percentile, p.method AS best_percentile_method, p.wt AS corresponding_wt_percentile, m.v AS median_percentile, m.wt AS median_wt_percentile
FROM s JOIN b ON b.k = s.k AND b.n = 1 JOIN p ON p.k = s.k AND p.n = 1 JOIN m ON m.k = s.k""")
def several_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    size, key = c("p_size"), c("p_partkey")
    fields = lambda **x: F.create_map(*[y for k, v in x.items() for y in (F.lit(k), F.coalesce(v.cast("string"), F.lit("None")))])
    outputs = {
        "MHCflurry": (fields(ic50=size, percentile=size / 4, mhcflurry_processing_score=size * 2, mhcflurry_presentation_score=size * 3, mhcflurry_presentation_percentile=F.when(size % 3 != 0, size / 2)), fields(ic50=F.lit(100), percentile=size / 8, mhcflurry_presentation_percentile=F.lit(3))),
        "NetMHC": (fields(ic50=F.when(size % 7 != 0, F.floor(c("p_retailprice") / 40)), rank=key % 20), fields(ic50=size, rank=F.lit(5))), "BigMHC_EL": (fields(BigMHC_EL=size), fields(BigMHC_EL=size)),
    }
    rows = None
    for method, (own, wild) in outputs.items():
        x, y = (predictions.method_values(F.lit(method), f, "both") for f in (own, wild))
        one = part.select("p_partkey", F.lit(method).alias("method"), x.alias("x"), y.alias("y")).select("p_partkey", "method", "x.scores", "x.percentiles", c("y.scores").alias("wt_scores"), c("y.percentiles").alias("wt_percentiles"))
        rows = one if rows is None else rows.unionByName(one)
    names = ["best_score", "best_score_method", "corresponding_wt_score", "median_score", "best_percentile", "best_percentile_method", "corresponding_wt_percentile", "median_percentile", "median_wt_percentile"]
    return predictions.summarise_maps(rows, ["p_partkey"]).select("p_partkey", *names)


# --- constructs: an order's parts in one construct --------------------------------------------------


def _junction_scores(rows: DataFrame) -> DataFrame:
    """A stand-in score of a junction's epitope, from its letters."""
    score = (F.ascii(F.substring("epitope", 1, 1)) * 31 + F.ascii(F.substring("epitope", 4, 1)) * 17 + F.ascii(F.substring("epitope", 7, 1)) * 7) % 997
    return rows.withColumns({"score": score.cast("double"), "percentile": score / 100})


@query()
def designed_constructs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey"), "l_orderkey").distinct()  # an order's parts stay together from here
    sequence = F.translate(F.md5(c("l_partkey").cast("string").cast("binary")), "0123456789abcdef", "ACDEFGHIKLMNPQRS")
    peptides = lines.select(c("l_orderkey").alias("construct"), c("l_partkey").alias("id"), sequence.alias("sequence"))
    done = constructs.design(peptides, _junction_scores, ["None", "AAY", "HHHH"], 7, 8, 60.0)
    return done.select(c("construct").alias("l_orderkey"), F.array_join("order", ",").alias("parts"), F.size("junctions").alias("junctions"), "sequence")


# --- metrics: the whole object of a variant, read back --------------------------------------------

_X = X.replace("l_extendedprice END AS score", "floor(l_extendedprice)::BIGINT END AS score")


@query(f"""WITH {_X}, o AS (SELECT *, row_number() OVER (ORDER BY {_TIE}) AS nth, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'W' || l_suppkey % 4 END AS wt FROM x),
e AS (SELECT v, tr, ep2, min(nth) AS nth FROM o GROUP BY ALL), own AS (SELECT v, tr, array_to_string(list(ep2 ORDER BY nth), '|') AS peptides, min(nth) AS nth FROM e GROUP BY v, tr),
s AS (SELECT v, peptides, min_by(tr, nth) AS tr, count(*) AS members, row_number() OVER (PARTITION BY v ORDER BY min(nth)) AS set_number FROM own GROUP BY v, peptides),
r AS (SELECT o.*, s.set_number, s.members FROM o JOIN s ON s.v = o.v AND s.tr = o.tr), k AS (SELECT *, row_number() OVER (PARTITION BY v, set_number, ep2, al ORDER BY nth DESC) AS last FROM r),
f AS (SELECT v, set_number, ep2, al, min(nth) FILTER (NOT anchor) AS nth FROM r GROUP BY ALL), fa AS (SELECT v, set_number, ep2, string_agg(al, ', ' ORDER BY nth) AS fails FROM f WHERE nth IS NOT NULL GROUP BY ALL),
c AS (SELECT v, set_number, ep2, string_agg(al || '=' || coalesce(score::VARCHAR, 'NA') || '/' || round(pct * 100)::INT, ';' ORDER BY al) AS calls, min(score) AS least, max(CASE WHEN al = 'HLA-A' THEN coalesce(score::VARCHAR, 'NA') END) AS a, max(CASE WHEN al = 'HLA-B' THEN coalesce(score::VARCHAR, 'NA') END) AS b, max(CASE WHEN al = 'HLA-C' THEN coalesce(score::VARCHAR, 'NA') END) AS cc FROM k WHERE last = 1 GROUP BY ALL),
h AS (SELECT v, set_number, ep2, any_value(members) AS members, min_by(prob, nth) AS prob, min_by(coalesce(wt, CASE WHEN kind = 'FS' THEN 'FS-NA' ELSE 'NA' END), nth) AS wt FROM r GROUP BY ALL)
SELECT h.v, 'Transcript Set ' || h.set_number AS "set", h.members, row_number() OVER (PARTITION BY h.v, h.set_number ORDER BY h.prob <> 'None', fa.fails IS NOT NULL, c.least NULLS LAST, h.ep2)::INT AS place, h.ep2 AS peptide, coalesce(a, 'X') || ',' || coalesce(b, 'X') || ',' || coalesce(cc, 'X') AS ic50s, c.calls,
  coalesce(fa.fails, 'None') AS fails, h.wt FROM h JOIN c ON c.v = h.v AND c.set_number = h.set_number AND c.ep2 = h.ep2 LEFT JOIN fa ON fa.v = h.v AND fa.set_number = h.set_number AND fa.ep2 = h.ep2""")
def metrics_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir).drop("MT Epitope Seq").withColumnRenamed("ep2", "MT Epitope Seq").withColumn("Median MT IC50 Score", F.floor("Median MT IC50 Score"))
    df = df.withColumns({"WT Epitope Seq": F.when(c("l_suppkey") % 3 != 0, F.concat(F.lit("W"), c("l_suppkey") % 4)), "one MT IC50 Score": c("Median MT IC50 Score"), "two MT IC50 Score": F.round(c("Median MT Percentile") * 100)})
    best = candidates.best_candidate(df, ["v"], T, "Median MT IC50 Score", TIE)
    objects = metrics.metrics_objects(df, best, ["v"], "Transcript", ["HLA-A", "HLA-B", "HLA-C"], TIE, ["one", "two"], anchor="anchor", allow_incomplete=True)
    detail = "struct<ic50s_MT:array<string>,anchor_fails:string,wt_peptide:string,individual_ic50_calls:struct<MT:map<string,array<string>>>>"
    parsed = F.from_json("json", f"good_binders map<string,struct<peptides:map<string,{detail}>,transcript_count:int,place:array<string>>>")
    sets = objects.select("v", "json", F.explode(parsed["good_binders"]).alias("set", "body"))
    rows = sets.select("v", "json", "set", c("body.transcript_count").cast("long").alias("members"), F.posexplode("body.peptides").alias("place", "peptide", "d"))
    calls = F.transform(F.array_sort(F.map_entries("d.individual_ic50_calls.MT")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "/")))
    return rows.select("v", "set", "members", (c("place") + 1).alias("place"), "peptide", F.array_join("d.ic50s_MT", ",").alias("ic50s"), F.array_join(calls, ";").alias("calls"), c("d.anchor_fails").alias("fails"), c("d.wt_peptide").alias("wt"))


# --- VCF text: a part is a record of one or two alternates, with an annotation for each transcript ---

_FIELDS = ["Allele", "Consequence", "SYMBOL", "Feature", "BIOTYPE", "WildtypeProtein", "FrameshiftSequence", "Amino_acids", "Protein_position", "Gene", "TSL"]
_RECORDS = """
k AS (SELECT p_partkey AS k, p_size AS dp, p_partkey % 4 = 0 AS two, ['PASS', '.', 'q10'][p_partkey % 3 + 1] AS filter, ['0/1', '1|1', '0/0', '1/2', './.'][p_partkey % 5 + 1] AS gt,
  translate(md5(p_partkey::VARCHAR), '0123456789abcdef', 'ACDEFGHIKLMNPQRS') || CASE WHEN p_partkey % 6 = 0 THEN '*' ELSE '' END AS wt FROM part),
a AS (SELECT k.*, 1 AS nth, 'T' AS alt, CASE WHEN k % 2 = 0 THEN 'missense' END AS kind, NULL AS fs FROM k UNION ALL SELECT k.*, 2, 'AG', 'FS', wt || 'ACD' FROM k WHERE two),
c AS (SELECT *, CASE WHEN two THEN 3 ELSE 2 END AS depths FROM a WHERE list_contains(string_split(replace(gt, '|', '/'), '/'), nth::VARCHAR) AND filter <> 'q10' AND kind IS NOT NULL AND NOT contains(wt, '*'))"""


@query(f"""WITH {_RECORDS} SELECT (k % 22)::VARCHAR AS chromosome_name, (k * 10)::INT AS start, (k * 10)::INT AS stop, 'A' AS reference, alt AS variant, 'E' || k || CASE nth WHEN 1 THEN '.1' ELSE '.2' END AS transcript_name, kind AS variant_type, wt AS wildtype_amino_acid_sequence, fs AS frameshift_amino_acid_sequence,
dp AS tdna_depth, round((nth * 3 + k % 5) / dp::DOUBLE, 6) AS tdna_vaf, CASE WHEN k % 7 <> 0 THEN (k % 50 + 0.5)::DOUBLE END AS gene_expression, CASE WHEN fs IS NULL THEN '' ELSE '+3' END AS protein_length_change FROM c""")
def vcf_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("p_partkey")
    text = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    two = key % 4 == 0
    at = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (key % n + 1).cast("int"))
    wt = F.concat(F.translate(F.md5(key.cast("string").cast("binary")), "0123456789abcdef", "ACDEFGHIKLMNPQRS"), F.when(key % 6 == 0, "*").otherwise(""))
    first = text("T|", F.when(key % 2 == 0, "missense_variant&splice_region_variant").otherwise("synonymous_variant"), "|G", key, "|E", key, ".1|protein_coding|", wt, "||K/N|", key % 30 + 1, "|ENSG", key, "|1")
    second = text("G|frameshift_variant|G", key, "|E", key, ".2|protein_coding|", wt, "|", wt, "ACD|K/X|", key % 30 + 1, "|ENSG", key, "|2")
    info = text("DP=", c("p_size"), ";CSQ=", first, F.when(two, F.concat(F.lit(","), second)).otherwise(""), ";END=1")
    depths = text(key % 9, ",", key % 5 + 3, F.when(two, text(",", key % 5 + 6)).otherwise(""))
    call = text(at(["0/1", "1|1", "0/0", "1/2", "./."], 5), ":", c("p_size"), ":", depths, ":", F.when(key % 7 != 0, text("ENSG", key, "|", key % 50, ".5")).otherwise("."))
    line = F.concat_ws("\t", (key % 22).cast("string"), (key * 10).cast("string"), F.lit("."), F.lit("A"), F.when(two, "T,AG").otherwise("T"), F.lit("."), at(["PASS", ".", "q10"], 3), info, F.lit("GT:DP:AD:GX"), call)
    lines = read(spark, sf_dir, "part", "p_partkey", "p_size").select(line.alias("value"))
    rows = vcf.annotated_records(vcf.records(lines, ["T"]), _FIELDS, "T", pass_only=True)
    names = ["chromosome_name", "start", "stop", "reference", "variant", "transcript_name", "variant_type", "wildtype_amino_acid_sequence", "frameshift_amino_acid_sequence", "tdna_depth"]
    return rows.select(*names, F.round("tdna_vaf", 6).alias("tdna_vaf"), "gene_expression", "protein_length_change")
