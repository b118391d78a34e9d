"""Compression of vectors to one small code a part, by metric trees over the codebooks.

A vector's components become integers, the vector is cut into equal parts, and
each part is named by its nearest entry in the codebook of its position. Nearest
entries come from a vantage-point tree for each part position: a node knows the
least and largest distance of each half's entries from its vantage point, and a
half is left out only if the triangle inequality shows that all of it is further
away than the best entry so far. Distances of the bounds are rounded outwards and
compared without strictness; what decides is the integer square at a leaf, ties
going to the lower index. So the codes are exactly those of a full search.

Codebooks hold at most ENTRIES entries a position: they, their trees and the sums
of a round (one number for each component of an entry) are all that the driver sees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, small_join

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component is floor(SCALE * x).
SCALE = 256
#: Integer components beyond are not coded: squares of their differences, summed over a vector, need not fit a long.
LARGEST = 1 << 24
#: Entries that a leaf of a tree compares one by one.
LEAF = 6
#: Bounds are widened by this share of the distances in them; square roots and differences of doubles are off by far less.
SLACK = 2.0**-48


@dataclass(frozen=True)
class Codebooks:
    """entries[part, entry, position within the part], integers."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all components as decimal integers, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Tree:
    """A vantage-point tree over the rows of an integer array."""

    def __init__(self, points: np.ndarray, members: np.ndarray | None = None) -> None:
        members = np.arange(len(points)) if members is None else members
        self.points, self.members, self.halves = points, members, []
        if len(members) <= LEAF:
            return
        # the entry furthest from the first one lies at the rim, where balls around it cut best
        self.vantage = members[np.argmax(_squares(points[members], points[members[0]]))]
        square = _squares(points[members], points[self.vantage])
        order = np.argsort(square, kind="stable")
        for part in np.array_split(order, 2):
            low, high = np.sqrt(square[part[[0, -1]]].astype(float))
            self.halves.append((low * (1 - SLACK), high * (1 + SLACK), Tree(points, members[np.sort(part)])))

    def search(self, queries: np.ndarray, index: np.ndarray, square: np.ndarray) -> None:
        """Improve the nearest entry (``index``, ``square``) of each query in place."""
        if not self.halves:
            # all entries of the leaf by integer squares; the lower index wins a tie
            for k in self.members:
                d = _squares(queries, self.points[k])
                better = (d < square) | ((d == square) & (k < index))
                index[better], square[better] = k, d[better]
            return
        away = np.sqrt(_squares(queries, self.points[self.vantage]).astype(float))
        middle = (self.halves[0][1] + self.halves[1][0]) / 2
        # each query's likelier half first
        for group, halves in ((np.flatnonzero(away <= middle), self.halves), (np.flatnonzero(away > middle), self.halves[::-1])):
            for low, high, half in halves if group.size else ():
                d, best = away[group], np.sqrt(square[group].astype(float)) * (1 + SLACK)
                at = group[(d * (1 - SLACK) - best <= high) & (d * (1 + SLACK) + best >= low)]
                if at.size:
                    i, s = index[at], square[at]
                    half.search(queries[at], i, s)
                    index[at], square[at] = i, s


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def nearest(trees: list[Tree], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes[row, part], squares[row, part]) of integer vectors[row, component]."""
    n, parts = len(values), len(trees)
    width = values.shape[1] // parts
    codes, squares = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
    for p, tree in enumerate(trees):
        index, square = np.full(n, len(tree.points), np.int64), np.full(n, np.iinfo(np.int64).max, np.int64)
        tree.search(np.ascontiguousarray(values[:, p * width : (p + 1) * width]), index, square)
        codes[:, p], squares[:, p] = index, square
    return codes, squares


def _trees(books: Codebooks) -> list[Tree]:
    return [Tree(part) for part in books.entries]


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of lists of equal length as a matrix."""
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), -1)


def integers(vector: Column) -> Column:
    """floor(SCALE * x) of every component; null for a vector that is null or has a component that is null, not finite or beyond LARGEST."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE <= LARGEST - 1))
    return F.when(usable, scaled.cast("array<int>"))


def coded_rows(vectors: DataFrame, scratch: Scratch, parts: int = PARTS, *, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, values) of the rows that can be coded, stored.

    Left out are vectors that ``integers`` makes null, and those whose length
    isn't that of the row of the smallest id (nulls last), or isn't a positive
    multiple of ``parts``.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(label).alias("label"), integers(F.col(vector)).alias("values")).where("values is not null")
    rows = scratch.store(rows, "values")
    sizes = rows.where((F.size("values") > 0) & (F.size("values") % parts == 0)).select("vec_id", F.size("values").alias("n"))
    first = sizes.orderBy(F.col("vec_id").asc_nulls_last(), "n").first()
    return rows.where(F.size("values") == (first.n if first else -1))


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of (vec_id, values): the smallest ids' parts, then ``rounds`` of assignment and floored means.

    Rows that repeat an id are entries of their own, in the order of their
    values; with fewer than ``entries`` rows there are fewer entries; with none
    the codebooks are empty. An entry that no part is assigned to stays.
    """
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(entries).select("values").collect()
    values = np.array([r[0] for r in start], np.int64)
    if not len(values):
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    books = np.ascontiguousarray(values.reshape(len(values), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        cells = dict(_sums(rows, Codebooks(books)).collect())  # parts * entries * (width + 1) numbers
        sums = np.zeros((parts, books.shape[1], books.shape[2] + 1), np.int64)
        sums.ravel()[list(cells.keys())] = list(cells.values())
        count = sums[:, :, -1:]
        books = np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), books)
    return Codebooks(books)


def _sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(cell, total): for each part and entry the sums of its parts' components and, last, their count."""
    parts, n, width = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, totals = _trees(books), np.zeros((parts * n, width + 1), np.int64)
        for batch in batches:
            values = _matrix(batch.column(0))
            codes, _ = nearest(trees, values)
            for p in range(parts):
                at = p * n + codes[:, p]
                totals[:, -1] += np.bincount(at, minlength=parts * n)
                np.add.at(totals[:, :-1], at, values[:, p * width : (p + 1) * width])
        cells = np.flatnonzero(totals.ravel())
        yield pa.RecordBatch.from_pydict({"cell": cells, "total": totals.ravel()[cells]})

    return rows.select("values").mapInArrow(add, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total"))


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part, and the squared distances summed."""
    width = max(2, len(f"{max(books.entries.shape[1] - 1, 0):x}"))
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    names = np.array([f"{i:0{width}x}" for i in range(books.entries.shape[1])], object)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, squares = nearest(trees, _matrix(batch.column("values")))
            text = ["".join(row) for row in names[codes].tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(squares.sum(axis=1))], ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "values").mapInArrow(coded, schema)


def decode(codes: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``codes`` with ``decoded``, the integer vector that the code stands for."""
    parts, n, _ = books.entries.shape
    width = max(2, len(f"{max(n - 1, 0):x}"))
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in part]) for part in books.entries])
    entry = lambda p: F.conv(F.substring(F.col(code), p * width + 1, width), 16, 10).cast("int")
    return codes.withColumn("decoded", F.flatten(F.array(*[F.element_at(F.element_at(table, p + 1), entry(p) + 1) for p in range(parts)])))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of (vec_id, embedding, label), one row for every row that can be coded.

    label_error is the error summed over the rows of an equal label, null labels
    together. Left out are rows whose vector is null, has a null or non-finite
    component or one whose integer is beyond LARGEST, or another length than the
    first row's (see ``coded_rows``). Equal rows get equal rows. A null vec_id
    comes after all others. An empty table gives an empty one. Other columns are
    ignored.
    """
    scratch = Scratch(vectors.sparkSession, "codes")
    rows = coded_rows(vectors, scratch, parts)
    books = fit(rows, parts, entries, rounds)
    out = scratch.store(encode(rows, books), "codes")
    scratch.keep(out)
    known = lambda c: F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("label"))
    out = out.withColumn("by", known("label"))
    labels = out.groupBy("by").agg(F.sum("error").alias("label_error"))
    key = F.struct(F.col("by.none"), F.coalesce(F.col("by.label").cast("string"), F.lit("")))
    joined = small_join(out.withColumn("by", key), labels.withColumn("by", key), ["by"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _assigned(k: int) -> str:
    """Parts with the entry of codebook ``k`` that is nearest."""
    return f"""a{k} AS MATERIALIZED (SELECT u.*, m.m[1]::BIGINT AS dist, m.m[2]::BIGINT AS entry FROM (
  SELECT u.i, u.part, min([list_sum(list_transform(range(1, u.w + 1), lambda j: (u.v[j] - c.v[j]) * (u.v[j] - c.v[j])))::BIGINT, c.entry::BIGINT]) AS m
  FROM u JOIN c{k} c ON c.part = u.part GROUP BY u.i, u.part) m JOIN u ON u.i = m.i AND u.part = m.part)"""


def _means(k: int) -> str:
    return f"""s{k} AS (SELECT part, entry, j, sum(x)::HUGEINT AS s, count(*) AS n FROM (SELECT part, entry, unnest(v) AS x, unnest(range(1, w + 1)) AS j FROM a{k}) GROUP BY part, entry, j),
f{k} AS (SELECT part, entry, list((s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY j) AS v FROM s{k} GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(f.v, c.v) AS v FROM c{k} c LEFT JOIN f{k} f ON f.part = c.part AND f.entry = c.entry)"""


ORACLE = f"""
WITH r AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
o AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS i, * FROM r),
u AS MATERIALIZED (SELECT i, part, len(v) // {PARTS} AS w, v[part * (len(v) // {PARTS}) + 1:(part + 1) * (len(v) // {PARTS})] AS v FROM o, (SELECT unnest(range({PARTS})) AS part)),
c0 AS MATERIALIZED (SELECT part, i - 1 AS entry, v FROM u WHERE i <= {ENTRIES}),
{_assigned(0)},
{_means(0)},
{_assigned(1)},
{_means(1)},
{_assigned(2)},
h AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, j)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS j FROM c2)),
e AS (SELECT i, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a2 GROUP BY i)
SELECT o.vec_id, e.code, e.error, sum(e.error) OVER (PARTITION BY o.label)::BIGINT AS label_error, h.codebooks_sha256 FROM o JOIN e ON e.i = o.i, h
"""
