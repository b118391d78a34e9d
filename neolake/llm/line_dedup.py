"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

An index holds, for every key (a line without outer white space, in lower case),
which documents refer to it, and from these references the number of documents
and the last of them. Keys in enough documents also stand in cuckoo filters, one
a shard of the key range. Documents are judged by probing their references in the
filters; most lines are unique and end there, and only hits are joined with the
exact counts, which decides. Inserting documents adds references and puts keys
that reach the threshold into their filter; deleting documents takes references
away and takes the keys that fall below it out again, which a cuckoo filter allows.
An index from which documents are deleted equals one that never had them.

Keys are named by 128 bits of XXH3. Everything is a table in the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Scratch, mix64, prepare, slices, small_join

#: A key's least number of code points, and the number of documents from which on it is dropped.
MIN_CHARS, MIN_DOCS = 20, 3
#: Keys of a filter, and references that are probed together.
SHARD_KEYS, PART_ROWS = 1 << 17, 1 << 17
LEAST_SHARDS = 16
SLOTS = 4
#: Rounds of displacement after which a filter counts as full.
KICKS = 200
SPACE = " \t\n\x0b\x0c\r"


class Cuckoo:
    """A cuckoo filter: buckets of SLOTS 16-bit fingerprints, each in one of its two buckets."""

    def __init__(self, cells: np.ndarray) -> None:
        self.cells = cells  # [bucket, slot], 0 is free

    @classmethod
    def build(cls, names: np.ndarray, buckets: int = 1) -> Cuckoo:
        """A filter that holds all of ``names``, of the least fitting power of two from ``buckets`` on."""
        while buckets * SLOTS * 0.9 < len(names):
            buckets *= 2
        made = cls(np.zeros((buckets, SLOTS), np.uint16))
        return made if made.insert(names) else cls.build(names, 2 * buckets)

    def _places(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names = names.view(np.uint64)
        prints = (names & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, ((names >> np.uint64(16)) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (mix64(prints.astype(np.uint64)) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def holds(self, names: np.ndarray) -> np.ndarray:
        """False only for names that were never inserted or are deleted."""
        prints, at = self._places(names)
        found = (self.cells[at] == prints[:, None]).any(axis=1)
        return found | (self.cells[self._other(prints, at)] == prints[:, None]).any(axis=1)

    def insert(self, names: np.ndarray) -> bool:
        """Insert all names at once; False if some found no place (the filter is then of no use)."""
        prints, at = self._places(names)
        for turn in range(KICKS):
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            first = np.searchsorted(at, at)
            rank = np.arange(len(at)) - first  # among those that want this bucket
            row = self.cells[at]
            free = (row == 0).sum(axis=1)
            put = rank < free
            slot = np.argsort(row != 0, axis=1, kind="stable")[np.arange(len(at)), np.minimum(rank, SLOTS - 1)]  # free ones first
            self.cells[at[put], slot[put]] = prints[put]
            left = ~put
            if not left.any():
                return True
            if turn:  # both buckets have been tried: the first of a bucket's losers takes a slot, and its fingerprint moves on
                kick = np.flatnonzero(left & (rank == free))
                slot = (at[kick] + turn) % SLOTS
                prints[kick], self.cells[at[kick], slot] = self.cells[at[kick], slot], prints[kick].copy()
            prints, at = prints[left], at[left]
            at = self._other(prints, at)
        return False

    def delete(self, names: np.ndarray) -> None:
        """Take out names that are in; of equal fingerprints in one bucket any will do."""
        prints, at = self._places(names)
        while len(prints):
            other = self._other(prints, at)
            here = self.cells[at] == prints[:, None]
            there = self.cells[other] == prints[:, None]
            use = here.any(axis=1)
            cell = np.where(use, at * SLOTS + here.argmax(axis=1), other * SLOTS + there.argmax(axis=1))
            if not (use | there.any(axis=1)).all():
                raise ValueError("a name to delete isn't in the filter")
            _, one = np.unique(cell, return_index=True)  # one name a cell and turn
            self.cells.reshape(-1)[cell[one]] = 0
            rest = np.ones(len(prints), bool)
            rest[one] = False
            prints, at = prints[rest], at[rest]


def key_name(line: str, min_chars: int) -> bytes | None:
    """Sixteen bytes that name a line's key; None for a short one."""
    key = line.strip(SPACE)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None  # bytes: only A-Z changes


def _names(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(hi, lo, doc_id): the different keys of every row of (doc_id, text)."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, rows = [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    if text:
                        own = {key_name(line, min_chars) for line in text.split("\n")} - {None}
                        found += sorted(own)
                        rows += [row] * len(own)
                names = _names(found)
                yield pa.RecordBatch.from_arrays([pa.array(names[:, 0]), pa.array(names[:, 1]), part.column("doc_id").take(pa.array(rows, pa.int64()))], ["hi", "lo", "doc_id"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(keys, "hi long, lo long, doc_id long")


def _counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("hi", "lo").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))


class LineIndex:
    """References, counts and filters of the documents inserted so far.

    A document is what has one doc_id: rows that repeat an id add their lines to
    it, all rows without an id are one document, before all others. ``delete``
    takes ids.
    """

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int | None = None) -> None:
        self.spark, self.min_chars, self.min_docs, self.shards = spark, min_chars, min_docs, shards
        self.scratch = Scratch(spark, "lines")
        self.refs = spark.createDataFrame([], "hi long, lo long, doc_id long")
        self.counts = spark.createDataFrame([], "hi long, lo long, docs long, last long")
        self.filters = spark.createDataFrame([], "shard int, cells binary")

    def insert(self, docs: DataFrame) -> LineIndex:
        """Add the documents' lines. Lines that a document already has change nothing."""
        new = self.scratch.store(references(docs, self.min_chars).distinct(), "new")
        known = self.refs.withColumnRenamed("doc_id", "known")
        if not known.isEmpty():
            new = self.scratch.store(new.join(known, (new.hi == known.hi) & (new.lo == known.lo) & new.doc_id.eqNullSafe(known.known), "left_anti"), "new")
        counts = _counts(new)
        if not self.counts.isEmpty():
            counts = self.counts.unionByName(counts).groupBy("hi", "lo").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))
        self.refs = self.refs.unionByName(new)
        self._count(self.scratch.store(counts, "counts"))
        return self

    def delete(self, ids: DataFrame) -> LineIndex:
        """Take out the documents with the given doc_id (null: those without one). Unknown ids change nothing."""
        ids = ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        same = lambda refs: refs.doc_id.eqNullSafe(ids.gone)
        touched = self.scratch.store(self.refs.join(ids, same(self.refs), "left_semi").select("hi", "lo").distinct(), "touched")
        self.refs = self.scratch.store(self.refs.join(ids, same(self.refs), "left_anti"), "refs")
        again = _counts(self.refs.join(touched, ["hi", "lo"], "left_semi"))
        self._count(self.scratch.store(self.counts.join(touched, ["hi", "lo"], "left_anti").unionByName(again), "counts"))
        return self

    def _count(self, counts: DataFrame) -> None:
        """Take over new counts; the filters follow the keys that have passed the threshold either way."""
        frequent = lambda c: c.where(F.col("docs") >= self.min_docs).select("hi", "lo")
        before, after = frequent(self.counts), frequent(counts)
        self.counts = counts
        if self.shards is None:
            self.shards = max(LEAST_SHARDS, -(-after.count() // SHARD_KEYS))
        up, down = after.join(before, ["hi", "lo"], "left_anti"), before.join(after, ["hi", "lo"], "left_anti")
        changes = self._sharded(up.withColumn("come", F.lit(True)).unionByName(down.withColumn("come", F.lit(False))))

        def change(old: pa.Table, changed: pa.Table) -> pa.Table:
            names, come = changed.column("lo").to_numpy(), changed.column("come").to_numpy(zero_copy_only=False)
            shard = (old if old.num_rows else changed).column("shard")[0].as_py()
            full = False
            if old.num_rows:
                filter_ = Cuckoo(np.frombuffer(old.column("cells")[0].as_py(), np.uint16).reshape(-1, SLOTS).copy())
                filter_.delete(names[~come])
                full = not filter_.insert(names[come])
            else:
                filter_ = Cuckoo.build(names[come])
            return pa.table({"shard": pa.array([shard], pa.int32()), "cells": pa.array([filter_.cells.tobytes()], pa.binary()), "full": [full]})

        filters = self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(change, "shard int, cells binary, full boolean")
        filters = self.scratch.store(filters, "filters")
        full = filters.where("full").select("shard")
        kept = filters.where("not full").drop("full")
        if not full.isEmpty():  # those are made anew, from the exact counts
            names = self._sharded(after).join(full, "shard", "left_semi")

            def rebuild(table: pa.Table) -> pa.Table:
                cells = Cuckoo.build(table.column("lo").to_numpy()).cells
                return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "cells": pa.array([cells.tobytes()], pa.binary())})

            kept = self.scratch.store(kept.unionByName(names.groupBy("shard").applyInArrow(rebuild, "shard int, cells binary")), "filters")
        self.filters = kept

    def _sharded(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod("hi", F.lit(self.shards)).cast("int"))

    def candidates(self, refs: DataFrame) -> DataFrame:
        """(hi, lo, doc_id) of ``refs`` that the filters let pass: all keys in enough documents and few others.

        A shard's references are dealt to tasks in parts of about PART_ROWS, each with a copy of the filter.
        """
        refs = self._sharded(refs)
        parts = refs.groupBy("shard").count().select("shard", F.ceil(F.col("count") / PART_ROWS).cast("int").alias("parts"))
        parts = self.scratch.store(parts.join(self.filters.select("shard"), "shard", "left_semi"), "parts")  # a row a shard
        dealt = small_join(refs, parts, ["shard"]).select("shard", F.pmod(F.xxhash64("hi", "doc_id"), "parts").cast("int").alias("part"), "hi", "lo", "doc_id")
        filters = small_join(self.filters, parts, ["shard"]).select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "cells")

        def probe(cells: pa.Table, asked: pa.Table) -> pa.Table:
            asked = asked.select(["hi", "lo", "doc_id"])
            if not (cells.num_rows and asked.num_rows):
                return asked.slice(0, 0)
            filter_ = Cuckoo(np.frombuffer(cells.column("cells")[0].as_py(), np.uint16).reshape(-1, SLOTS))
            return asked.filter(pa.array(filter_.holds(asked.column("lo").to_numpy())))

        return filters.groupBy("shard", "part").cogroup(dealt.groupBy("shard", "part")).applyInArrow(probe, "hi long, lo long, doc_id long")

    def dropped(self) -> DataFrame:
        """(doc_id, hi, lo): keys whose lines go from a document, as other documents up to the last one hold them."""
        hits = self.candidates(self.refs)
        exact = self.counts.where(F.col("docs") >= self.min_docs).select("hi", "lo", "last")
        return small_join(hits, exact, ["hi", "lo"]).where("doc_id is null or doc_id < last").select("doc_id", "hi", "lo")

    def apply(self, docs: DataFrame, texts: bool = True) -> DataFrame:
        """(doc_id, n_lines, n_dropped, kept_sha256[, kept]) of documents that are in the index; others lose nothing."""
        prepare(self.spark)
        lists = self.dropped().groupBy(F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("hi", "lo")).alias("gone"))
        plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        rows = plain.join(lists, plain.doc_id.eqNullSafe(lists.of), "left").select("doc_id", "text", "gone.hi", "gone.lo")
        min_chars = self.min_chars

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    out = []
                    for text, hi, lo in zip(*(part.column(c).to_pylist() for c in ("text", "hi", "lo")), strict=True):
                        lines = (text or "").split("\n")
                        kept = lines
                        if hi:
                            raw = np.array([hi, lo], "<i8").T.tobytes()
                            gone = {raw[i : i + 16] for i in range(0, len(raw), 16)}
                            kept = [x for x in lines if key_name(x, min_chars) not in gone]
                        rest = "\n".join(kept)
                        out.append((len(lines), len(lines) - len(kept), hashlib.sha256(rest.encode()).hexdigest(), rest))
                    columns = list(zip(*out, strict=True))
                    arrays = [part.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())]
                    yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(columns[3], pa.string())] if texts else [])], ["doc_id", "n_lines", "n_dropped", "kept_sha256", *(["kept"] if texts else [])])

        return rows.mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", kept string" * texts)

    def save(self, path: str) -> None:
        """Write the index to a folder, to be opened again by ``open``."""
        for name in ("refs", "counts", "filters"):
            getattr(self, name).write.parquet(f"{path}/{name}")
        self.spark.createDataFrame([(self.min_chars, self.min_docs, self.shards)], "min_chars int, min_docs int, shards int").write.parquet(f"{path}/settings")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineIndex:
        index = cls(spark, **spark.read.parquet(f"{path}/settings").first().asDict())
        for name in ("refs", "counts", "filters"):
            setattr(index, name, spark.read.parquet(f"{path}/{name}"))
        return index


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, texts: bool = True) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256[, kept]) for every row of (doc_id, text).

    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents
    lose their lines in all documents but the one with the largest doc_id, which
    keeps all of its own. A null text is one empty line. Rows that share an id are
    one document (each row is cut by itself), so are all rows without an id, which
    come before all others. Repeated lines of one document count once. An empty
    table gives an empty one. Other columns are ignored.
    """
    return LineIndex(docs.sparkSession, min_chars, min_docs).insert(docs).apply(docs, texts)


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
WITH l AS (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id
"""
