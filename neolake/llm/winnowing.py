"""Document fingerprints by winnowing, in DataFrame functions only.

Words are hashed, every run of K words gets a rolling polynomial hash, and of
every W consecutive ones the least is kept, the rightmost of equal ones, with its
position. Two texts that share a run of K + W - 1 words share a fingerprint.

The hash rolls by powers of two: that of a run follows from those of its parts,
so that a few passes over whole arrays give all of them, and so do a few passes
give the least of every window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch

K, W = 5, 8
#: Base and modulus of the rolling hash; a hash and a position are packed into one long.
BASE, MODULUS = 1_000_003, 2_147_483_629
SHIFT = 32
LAST = (1 << SHIFT) - 1
#: Document ids that are put in order together, and the most parts that the id range is cut into (beyond, parts get longer, and their sort spills).
ROWS, PARTS = 1024, 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACES = "\t\n\x0b\x0c\r"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also inside the lambdas of ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _beside(a: Column, b: Column, apart: int, f: Callable[[Column, Column], Column]) -> Column:
    """f(a[i], b[i + apart]) for every i that both arrays have."""
    n = F.greatest(F.least(F.size(a), F.size(b) - apart), F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(b, apart + 1, n), f)


def _runs(one: Column, n: int, join: Callable[[Column, Column, int], Column], then: Callable[[Column], Column]) -> Column:
    """``then`` of the values of all runs of n, from those of single elements: ``join`` puts a run and the m that follow it together."""
    bits = f"{n:b}"[1:]

    def grow(runs: Column, size: int, k: int) -> Column:
        if k == len(bits):
            return then(runs)
        if bits[k] == "0":
            return _let(_beside(runs, runs, size, lambda x, y: join(x, y, size)), lambda r: grow(r, 2 * size, k + 1))
        return _let(_beside(runs, runs, size, lambda x, y: join(x, y, size)), lambda r: _let(_beside(r, one, 2 * size, lambda x, y: join(x, y, 1)), lambda r1: grow(r1, 2 * size + 1, k + 1)))

    return grow(one, 1, 0)


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """The kept hashes of a text as longs, by position: hash * 2**32 + (2**32 - 1 - position).

    Words are runs of characters other than ASCII white space, A-Z lower-cased. A
    text of 1 to k - 1 words has one hash over all of them, a null text or one
    without words none; one of fewer than w hashes keeps the least.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SPACES, _LOWER + " " * len(_SPACES))
    parts = F.array_remove(F.split(spaced, " "), "")
    hashes = F.transform(parts, lambda x: F.crc32(x.cast("binary")))
    rolled = lambda x, y, m: (x * pow(BASE, m, MODULUS) + y) % MODULUS
    least = lambda x, y, m: F.least(x, y)
    pack = lambda x, i: x * (LAST + 1) + (LAST - i.cast("long"))
    kept = lambda r: _let(F.transform(r, pack), lambda g: F.when(F.size(g) <= w, F.array(F.array_min(g))).otherwise(_runs(g, w, least, F.array_distinct)))
    short = lambda h: F.array(F.aggregate(h, F.lit(0).cast("long"), lambda a, x: (a * BASE + x) % MODULUS))

    none = F.array().cast("array<bigint>")
    return _let(hashes, lambda h: F.when(F.size(h) == 0, none).when(F.size(h) < k, kept(short(h))).otherwise(_runs(h, k, rolled, kept)))


def hashes(fp: Column) -> Column:
    """The different hashes of a fingerprint, without positions."""
    return F.array_distinct(F.transform(fp, lambda v: F.shiftright(v, SHIFT)))


def positions(fp: Column) -> Column:
    """The word each kept run starts at, from 0."""
    return F.transform(fp, lambda v: F.lit(LAST) - v.bitwiseAND(F.lit(LAST)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of different hashes; 1 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    both = F.size(a) + F.size(b) - shared
    return F.when(both == 0, 1.0).otherwise(shared / both)


def digest(fp: Column) -> Column:
    return F.md5(F.array_join(fp.cast("array<string>"), " ").cast("binary"))


def _ids(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, part): the different ids, range-sorted into parts."""
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    n = ids.count()
    return scratch.store(ids.repartitionByRange(max(1, min(PARTS, -(-n // ROWS))), "doc_id").withColumn("part", F.spark_partition_id()), "ids")


def next_ids(ids: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, next_id): the following id in ascending order, after the last the first."""
    heads = ids.groupBy("part").agg(F.min("doc_id").alias("head"))  # a row a part
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(order), F.min("head").over(whole)).alias("after"))
    ahead = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    return scratch.store(ids.withColumn("ahead", ahead).join(heads, "part").select("doc_id", F.coalesce("ahead", "after").alias("next_id")), "next")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text, own, next) for every row of (doc_id, text): its fingerprint, and text and own of the next document.

    Of rows that share an id the least text counts as the next one's.

    With ids that are all there and different, whole rows are shuffled once, by
    part of the id range, and fingerprinted there; the first row of each part is
    sent to the part before as well. Else rows are joined by id.
    """
    docs = _plain(docs)
    ids = _ids(docs, scratch)
    n, known, different = docs.count(), docs.where("doc_id is not null").count(), ids.count()
    if n == known == different:
        return _by_parts(docs, ids)
    marked = docs.withColumn("own", fingerprint(F.col("text")))
    following = next_ids(ids, scratch)
    first = following.agg(F.min("doc_id")).first()[0]
    texts = marked.groupBy(F.col("doc_id").alias("next_id")).agg(F.min(F.struct("text", "own")).alias("next"))
    known = marked.join(following, "doc_id", "left").withColumn("next_id", F.coalesce("next_id", F.lit(first).cast("long")))
    return known.join(texts, "next_id", "left").select("doc_id", "text", "own", "next")


def _by_parts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    heads = sorted(r[1] for r in ids.groupBy("part").agg(F.min("doc_id")).collect())  # PARTS ids at most
    if not heads:
        return docs.withColumn("own", fingerprint(F.col("text"))).withColumn("next", F.struct("text", "own"))
    steps = max(1, len(heads).bit_length())
    last = len(heads) - 1

    def part(head: Column) -> Column:
        """The last part whose first id isn't beyond doc_id, by bisection."""
        halve = lambda s, _: _let((s["lo"] + s["hi"] + 1).bitwiseAND(F.lit(~1)) / 2, lambda m: F.when(F.element_at(head, m.cast("int") + 1) <= F.col("doc_id"), F.struct(m.cast("int").alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), (m - 1).cast("int").alias("hi"))))
        start = F.struct(F.lit(0).alias("lo"), F.lit(last).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["lo"]

    known = F.array(*[F.lit(h).cast("long") for h in heads]) if len(heads) <= 64 else F.from_json(F.lit(str(heads)), "array<bigint>")
    rows = docs.withColumn("_part", part(known))
    rows = rows.withColumn("_guest", F.element_at(known, F.col("_part") + 1) == F.col("doc_id"))
    own = F.struct(F.col("_part").alias("part"), F.lit(False).alias("guest"))
    before = F.struct(F.when(F.col("_part") == 0, last).otherwise(F.col("_part") - 1).alias("part"), F.lit(True).alias("guest"))
    rows = rows.select("doc_id", "text", F.explode(F.when(F.col("_guest"), F.array(own, before)).otherwise(F.array(own))).alias("at"))
    rows = rows.select("doc_id", "text", F.col("at.part").alias("part"), F.col("at.guest").alias("guest"))
    # texts are shuffled without their fingerprints; the window below finds its rows in place
    rows = rows.repartition(F.col("part")).withColumn("own", fingerprint(F.col("text")))
    ahead = F.lead(F.struct("text", "own")).over(Window.partitionBy("part").orderBy("guest", "doc_id"))
    return rows.withColumn("next", ahead).where("not guest").select("doc_id", "text", "own", "next")


def winnow(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row for every row.

    The edited text keeps all but the last floor(n_chars / 2) code points and goes
    on with as many (or all) first ones of the next document. A null text is an
    empty one; a row with a null doc_id is followed by the first document and
    follows none. Other columns are ignored.
    """
    rows = with_next(docs, Scratch(docs.sparkSession, "winnow"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    edited = F.concat(F.expr("left(text, cast(n_chars - half as int))"), F.expr("left(coalesce(next.text, ''), half)"))
    rows = rows.withColumn("edited", edited)
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", fingerprint(F.col("edited")).alias("other"), F.coalesce("next.own", F.array().cast("array<bigint>")).alias("following"))
    sets = rows.select("*", hashes(F.col("own")).alias("a"), hashes(F.col("other")).alias("b"), hashes(F.col("following")).alias("c"))
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", digest(F.col("own")).alias("fingerprint"), digest(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"),
    )


def _sql_words(text: str) -> str:
    ws = r"[\x20\x09-\x0D]+"
    return f"list_filter(regexp_split_to_array(translate({text}, '{_UPPER}', '{_LOWER}'), '{ws}'), lambda x: x <> '')"


#: CRC-32 of every different word, by bytes; then, for each text, the polynomial of every run from its start on and the least of every window.
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text FROM d),
e AS (SELECT doc_id, text, next_text, length(text) AS n_chars, left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited FROM n),
h AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_sql_words('text')} AS a, {_sql_words('edited')} AS b, {_sql_words('next_text')} AS c FROM e),
s0 AS (SELECT doc_id, 'a' AS k, a AS ws FROM h UNION ALL SELECT doc_id, 'b', b FROM h UNION ALL SELECT doc_id, 'c', c FROM h),
s1 AS (SELECT doc_id, k, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM s0),
tb AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
s2 AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM s1)),
s3 AS (SELECT word, xor(4294967295, list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INT + 1, 2))::BIGINT), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8), 4294967295::BIGINT)) AS v FROM s2, tb),
w AS (SELECT s1.doc_id, s1.k, list(s3.v ORDER BY s1.i) AS h FROM s1 JOIN s3 ON s1.word = s3.word GROUP BY s1.doc_id, s1.k),
g AS (SELECT doc_id, k, list_transform(range(1, greatest(len(h) - {K - 1}, 1) + 1),
  lambda i: list_reduce(list_transform(h[i:i + {K - 1}], lambda x: x::BIGINT), lambda a, x: (a * {BASE} + x) % {MODULUS}, 0::BIGINT) * {LAST + 1} + ({LAST} - (i - 1))) AS g FROM w),
f AS (SELECT doc_id, k, list_transform(range(1, greatest(len(g) - {W - 1}, 1) + 1), lambda i: list_min(g[i:i + {W - 1}])) AS f FROM g),
u AS (SELECT DISTINCT doc_id, k, v FROM (SELECT doc_id, k, unnest(f) AS v FROM f)),
s AS (SELECT doc_id, k, md5(string_agg(v::VARCHAR, ' ' ORDER BY {LAST} - (v & {LAST}))) AS fp FROM u GROUP BY doc_id, k),
q AS (SELECT DISTINCT doc_id, k, v >> {SHIFT} AS v FROM u),
z AS (SELECT doc_id, k, count(*) AS z FROM q GROUP BY doc_id, k),
i AS (SELECT x.doc_id, y.k, count(*) AS i FROM q x JOIN q y ON x.doc_id = y.doc_id AND x.v = y.v AND x.k = 'a' AND y.k <> 'a' GROUP BY x.doc_id, y.k),
t AS (SELECT h.doc_id, h.n_chars, h.edited_sha256, coalesce(sa.fp, md5('')) AS fingerprint, coalesce(sb.fp, md5('')) AS edited_fingerprint,
  coalesce(za.z, 0) AS za, coalesce(zb.z, 0) AS zb, coalesce(zc.z, 0) AS zc, coalesce(ib.i, 0) AS ib, coalesce(ic.i, 0) AS ic
  FROM h LEFT JOIN s sa ON sa.doc_id = h.doc_id AND sa.k = 'a' LEFT JOIN s sb ON sb.doc_id = h.doc_id AND sb.k = 'b'
  LEFT JOIN z za ON za.doc_id = h.doc_id AND za.k = 'a' LEFT JOIN z zb ON zb.doc_id = h.doc_id AND zb.k = 'b' LEFT JOIN z zc ON zc.doc_id = h.doc_id AND zc.k = 'c'
  LEFT JOIN i ib ON ib.doc_id = h.doc_id AND ib.k = 'b' LEFT JOIN i ic ON ic.doc_id = h.doc_id AND ic.k = 'c')
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  CASE WHEN za + zb = 0 THEN 1.0 ELSE ib::DOUBLE / (za + zb - ib) END::DOUBLE AS near_edited,
  CASE WHEN za + zc = 0 THEN 1.0 ELSE ic::DOUBLE / (za + zc - ic) END::DOUBLE AS near_next
FROM t
"""
