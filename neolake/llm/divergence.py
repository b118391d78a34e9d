"""How sources of one language differ in their terms.

Only terms in enough documents of their language count. Whether a term can be one
of them is first asked of a count-min sketch of document frequencies: every task
fills a sketch of its own, the sketches are merged, and as a count-min sketch
never underestimates, a term with a cell below the threshold is out before
anything about it is shuffled. Survivors are counted exactly by language, source
and term. Distances of two sources then come from the terms that both hold, by a
join on the term, and from sums over each one's own terms: what neither holds adds
the same for every term.

All shares are integers, in billionths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch, mix64, name_hashes, prepare, slices, small_join, utf8

#: A term: letters and whatever isn't ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP = 30, 50
SCALE, SMOOTH = 1_000_000_000, 5
#: Rows of the sketch, and its cells a row: a power of two for CELLS_A_DOC cells a document, within bounds.
DEPTH, CELLS_A_DOC, LEAST_WIDTH, MOST_WIDTH = 3, 16, 1 << 16, 1 << 22
#: Cells that are merged and sent together, and sketches merged in one step.
CHUNK, FAN_IN = 1 << 16, 64
#: Sources of one language whose rows of a term meet in one task.
BLOCK = 256


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A-Z lower-cased, starts, ends, rows) of every term; terms never cross rows."""
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data).astype(np.uint8)
    ink = (data >= 128) | ((data >= 97) & (data <= 122))
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return data, none, none, none
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] |= ink[edges]
    last[edges - 1] |= ink[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Codes of a batch's values, and the values."""
    d = column.dictionary_encode()
    return d.indices.to_numpy(), d.dictionary.to_pylist()


def _named(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Terms of a batch: (bytes, starts, ends, rows, hash of language and term, languages, language of each row)."""
    data, starts, ends, rows = terms(*utf8(part.column("text")))
    of, langs = _coded(part.column("lang"))
    raw = [x.encode() for x in langs]
    at = np.cumsum([0, *map(len, raw)])
    salt = name_hashes(np.frombuffer(b"".join(raw), np.uint8), at[:-1], at[1:])
    return data, starts, ends, rows, mix64(name_hashes(data, starts, ends) + mix64(salt)[of[rows]]), langs, of


def _cells(names: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each name in every row of the sketch."""
    return [(mix64(names + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) & np.uint64(width - 1)).astype(np.int64) + k * width for k in range(DEPTH)]


def sketch_width(n_docs: int) -> int:
    return min(MOST_WIDTH, max(LEAST_WIDTH, 1 << (CELLS_A_DOC * n_docs - 1).bit_length()))


def possible(docs: DataFrame, min_docs: int, width: int, scratch: Scratch) -> np.ndarray:
    """For each cell of the merged sketch of document frequencies by language and term whether it reaches ``min_docs``.

    Cells stop at ``min_docs`` (255 at most) in every sketch, which can't turn a
    merged cell that reaches it into one that doesn't. What comes to the driver is
    a bit a cell, MOST_WIDTH * DEPTH of them at most.
    """
    most = min(min_docs, 255)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(DEPTH * width, np.uint8)
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, _, rows, names, _, _ = _named(part)
                order = np.lexsort((names, rows))
                rows, names = rows[order], names[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (names[1:] != names[:-1])
                for cells in _cells(names[new], width):
                    cell, n = np.unique(cells, return_counts=True)
                    sketch[cell] = np.minimum(sketch[cell] + n, most)
        sketch = sketch.reshape(-1, CHUNK)
        for k in np.flatnonzero(sketch.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "cells": [sketch[k].tobytes()]})

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for raw in group.column("cells").to_pylist():  # FAN_IN of them at most
            total = np.minimum(total + np.frombuffer(raw, np.uint8), most)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()), "cells": [total.astype(np.uint8).tobytes()]})

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(np.frombuffer(x, np.uint8) >= most).tobytes() for x in batch.column("cells").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(bits, pa.binary())], ["chunk", "bits"])

    sketches = docs.select("text", "lang").mapInArrow(fill, "chunk int, cells binary").withColumn("task", F.spark_partition_id())
    sketches = scratch.store(sketches, "sketches")
    left = (sketches.agg(F.max("task")).first()[0] or 0) + 1
    while left > 1:
        left = -(-left // FAN_IN)
        merged = sketches.withColumn("task", F.pmod("task", F.lit(left))).groupBy("chunk", "task").applyInArrow(merge, "chunk int, task int, cells binary")
        merged, old = scratch.store(merged, "sketches"), sketches
        scratch.drop(old)
        sketches = merged
    found = np.zeros((DEPTH * width // CHUNK, CHUNK), bool)
    for chunk, bits in sketches.select("chunk", "cells").mapInArrow(reached, "chunk int, bits binary").collect():
        found[chunk] = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    return found.ravel()


def counted(docs: DataFrame, cells: np.ndarray, width: int) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term, of all terms that the sketch lets pass."""
    spark = docs.sparkSession
    packed = spark.sparkContext.broadcast(np.packbits(cells).tobytes())  # MOST_WIDTH * DEPTH bits at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = np.unpackbits(np.frombuffer(packed.value, np.uint8)).astype(bool)
        for batch in batches:
            for part in slices(batch, "text"):
                data, starts, ends, rows, names, langs, lang_of = _named(part)
                keep = np.ones(len(names), bool)
                for row in _cells(names, width):
                    keep &= passing[row]
                at = np.flatnonzero(keep)
                source_of, sources = _coded(part.column("source"))
                # by source and term (whose name holds the language), then by row
                source, name, row = source_of[rows[at]], names[at], rows[at]
                order = np.lexsort((row, name, source))
                at, source, name, row = at[order], source[order], name[order], row[order]
                new = np.ones(len(at), bool)
                new[1:] = (source[1:] != source[:-1]) | (name[1:] != name[:-1])
                other = new.copy()
                other[1:] |= row[1:] != row[:-1]
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                in_docs = np.add.reduceat(other.astype(np.int64), first) if len(first) else first
                raw = data.tobytes()
                found = [raw[i:j] for i, j in zip(starts[at[first]].tolist(), ends[at[first]].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs, pa.string()).take(pa.array(lang_of[row[first]])), pa.array(sources, pa.string()).take(pa.array(source[first])), pa.array(found, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(in_docs, pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )

    seen = docs.select("text", "lang", "source").mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return seen.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, kept: str = "v") -> Column:
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * kept)), exactly."""
    of = lambda c: f"cast({c} as decimal(20, 0))"
    return F.expr(f"case when {kept} > 0 then 1L + (cast({SCALE} as decimal(10, 0)) * ({of(n)} + {SMOOTH})) div ({of(total)} + {SMOOTH} * {of(kept)}) else 0L end")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of (text, lang, source).

    Part ``pair``: for each source of a language the language's other sources, by
    the distance of their shares summed over all kept terms (those in at least
    ``min_docs`` of the language's documents). Part ``term``: the ``top`` terms
    whose share in the source exceeds that in the whole language, by how much.
    Ranks go by falling value, then by item. Null text, lang and source are empty
    strings; each row is a document, repeated or not. A language without kept
    terms has pairs at distance 0; a source alone in its language has none. An
    empty table gives an empty one. Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "divergence")
    docs = _plain(docs)
    sizes = scratch.store(docs.groupBy("lang", "source").count(), "groups")  # a row a source and language
    width = sketch_width(sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0])
    counts = scratch.store(counted(docs, possible(docs, min_docs, width, scratch), width), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang")).where(F.col("docs") >= min_docs).drop("docs")
    kept = scratch.store(kept, "kept")
    own = scratch.store(counts.drop("docs").join(kept, ["lang", "term"]), "own")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = Window.partitionBy("lang").orderBy("source")
    groups = sizes.drop("count").join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["v", "total", "total_lang"])
    groups = groups.withColumn("block", F.floor((F.row_number().over(place) - 1) / BLOCK).cast("int")).withColumn("blocks", F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / BLOCK).cast("int") + 1)
    groups = scratch.store(groups.withColumn("rest", _share("0", "total")), "groups")  # rest: the share of a term that the source lacks

    shares = small_join(own, groups, ["lang", "source"])
    shares = shares.select("lang", "source", "term", _share("n", "total").alias("p"), _share("n_lang", "total_lang").alias("q"), "rest", "block", "blocks")
    shares = scratch.store(shares, "shares")
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms_ = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms_ = terms_.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)

    pairs = _distances(shares, groups).withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(ranked))
    out = scratch.store(terms_.unionByName(pairs), "ranked")
    scratch.keep(out)
    return out


def _distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): distances of each source to all others of its language."""
    a, b = F.col("rest"), F.col("other_rest")
    others = groups.select("lang", F.col("source").alias("other"), F.col("rest").alias("other_rest"))

    # what a source's own terms add against a source that lacks them; terms of one share count together
    levels = shares.groupBy("lang", "source", "rest", "p").agg(F.count("*").alias("times"))
    alone = small_join(levels, others, ["lang"]).where("source <> other")
    alone = alone.groupBy("lang", "source", "other").agg(F.sum(F.col("times") * (F.abs(F.col("p") - b) - F.abs(a - b))).alias("alone"))

    # what changes where both have the term; sources meet by blocks
    left = shares.select("lang", "term", "source", "p", "rest", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"))
    right = shares.select("lang", "term", F.col("source").alias("other"), F.col("p").alias("other_p"), F.col("rest").alias("other_rest"), F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    both = left.join(right, ["lang", "term", "i", "j"]).where("source < other")
    gain = F.abs(F.col("p") - F.col("other_p")) - F.abs(F.col("p") - b) - F.abs(a - F.col("other_p")) + F.abs(a - b)
    both = both.groupBy("lang", "source", "other").agg(F.sum(gain).alias("both"))

    # a row a pair of sources, as the result has
    pairs = small_join(groups.select("lang", "source", "v", "rest"), others, ["lang"]).where("source < other").withColumn("base", F.col("v") * F.abs(a - b))
    mirrored = alone.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("alone").alias("other_alone"))
    for part in (alone, mirrored, both):
        pairs = pairs.join(part, ["lang", "source", "other"], "left")
    value = F.col("base") + sum((F.coalesce(F.col(c), F.lit(0)) for c in ("alone", "other_alone", "both")), F.lit(0))
    either = F.explode(F.array(F.struct(F.col("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    return pairs.select("lang", value.cast("long").alias("value"), either.alias("x")).select("lang", "x.source", "x.item", "value")


def _sql_share(n: str, total: str) -> str:
    return f"1 + ({SCALE}::HUGEINT * ({n} + {SMOOTH})) // ({total} + {SMOOTH} * v)"


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS (SELECT i, lang, source, translate(unnest(regexp_extract_all(text, '{TERM}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n_lang FROM t GROUP BY lang, term HAVING count(DISTINCT i) >= {MIN_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, k.term, k.n_lang, coalesce(n.n, 0) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
s AS (SELECT c.*, sum(n) OVER (PARTITION BY c.lang, c.source) AS total, l.v, l.total_lang FROM c JOIN l ON l.lang = c.lang),
p AS (SELECT lang, source, term, n, {_sql_share('n', 'total')} AS p, {_sql_share('n_lang', 'total_lang')} AS q FROM s),
x AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, part, item, value::BIGINT AS value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT * FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
