"""Token-ID output: documents to ids to files of rANS blocks, and back.

A written data set is a folder with three Parquet tables: ``table`` (the shared
frequencies), ``blocks`` (one row a block: part, task and block, doc_ids and their lengths,
states, words, checkpoints, CRC-32). Nothing else is needed to decode a block.
Blocks hold whole documents in ascending doc_id order; part numbers ascend too.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import rans
from ._common import Scratch, batches_of, name_hashes, slices, small_join, utf8

END = 2
#: Ids of a block, but for the last document in it.
BLOCK_IDS = 1 << 18
#: Different pieces that a worker keeps the ids of, and how many of them before they are merged.
CACHE, RECENT = 3_000_000, 200_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    Its pre-tokenizer starts a piece at every single space between two
    characters that aren't white space. Texts are cut at such spaces (where the
    bytes beside one leave no doubt), and each different piece is encoded once
    and kept by its hash, while there is room.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(vocabulary)
        vocab = self.t.get_vocab(with_added_tokens=True)
        #: Bytes of each id: a byte-level vocabulary writes every byte as one character.
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.clear()

    def clear(self) -> None:
        """Known pieces: a large sorted table and a small recent one, as (hash, start in ids, number of ids)."""
        none = np.zeros(0, np.uint32)
        self.tables = [(none.astype(np.uint64), none, none)] * 2
        self.ids = np.zeros(0, np.uint16 if len(self.width) <= 1 << 16 else np.uint32)

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and number of ids of each hash, and whether it is known."""
        at, n, known = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        for hashes, starts, sizes in self.tables:
            if len(hashes):
                place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                hit = hashes[place] == h
                at[hit], n[hit] = starts[place[hit]], sizes[place[hit]]
                known |= hit
        return at, n, known

    def _learn(self, h: np.ndarray, pieces: list[bytes], joint: np.ndarray) -> None:
        """``joint``: pieces that stand between two cuts; a run of them is encoded as one text and its ids are told apart by their bytes."""
        order = np.r_[np.flatnonzero(joint), np.flatnonzero(~joint)]
        one = [pieces[i] for i in order[: int(joint.sum())]]
        ids, n = [], []
        for i in range(0, len(one), 20_000):
            part = one[i : i + 20_000]
            x = np.array(self.t.encode_batch_fast([b"".join(part).decode("utf-8", "surrogatepass")], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.searchsorted(np.cumsum(self.width[x]), np.cumsum([len(p) for p in part])) + 1
            ids.append(x)
            n.append(np.diff(np.r_[0, ends]))
        for e in self.t.encode_batch_fast([pieces[i].decode("utf-8", "surrogatepass") for i in order[len(one) :]], add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint32))
            n.append(np.array([len(e.ids)], np.int64))
        n = np.concatenate(n)
        at = np.cumsum(n) - n + len(self.ids)
        self.ids = np.concatenate([self.ids, np.concatenate(ids).astype(self.ids.dtype)])
        large, recent = self.tables
        h, at, n = (np.concatenate(x) for x in zip(recent, (h[order], at.astype(np.uint32), n.astype(np.uint32))))
        if len(h) > RECENT:
            h, at, n = (np.concatenate(x) for x in zip(large, (h, at, n)))
            large = (h[:0], at[:0], n[:0])
        o = np.argsort(h)
        table = (h[o], at[o], n[o])
        self.tables = [large, table] if len(h) <= RECENT or len(large[0]) else [table, large]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a column, and where each text's begin and end."""
        data, off = utf8(column)
        starts = cuts(data, off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        ends = np.r_[starts[1:], len(data)]
        h, first, which = np.unique(name_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.tables[0][0]) > CACHE:
            self.clear()
        at, n, known = self._find(h)
        if not known.all():
            raw, new = data.tobytes(), first[~known]
            between = ~np.isin(starts[new], off) & ~np.isin(ends[new], off)
            self._learn(h[~known], [raw[starts[i] : ends[i]] for i in new], between)
            at, n, _ = self._find(h)
        at, n = at[which], n[which]
        upto = np.cumsum(n)
        ids = self.ids[np.repeat(at - (upto - n), n) + np.arange(upto[-1])].astype(np.uint32)
        return ids, np.r_[0, upto][np.searchsorted(starts, off)]


def cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of pieces: of texts that aren't empty, and spaces that surely stand between two other characters."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    graphic = (data > 32) & (data < 127)
    two = (data >= 0xC3) & (data <= 0xDF)  # starts a two-byte character; white space is C2, E1, E2 or E3
    after = graphic | two | (data >= 0xE4)
    before = graphic.copy()
    before[1:] |= two[:-1]
    cut = np.zeros(n, bool)
    cut[1:-1] = (data[1:-1] == 32) & before[:-2] & after[2:]
    edges = off[off < n]
    cut[edges] = True
    for side in (edges + 1, edges - 1):  # a neighbour in another text decides nothing
        side = side[(side >= 0) & (side < n)]
        own = np.isin(side, edges)
        cut[side[~own]] &= False
    return np.flatnonzero(cut)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The worker's encoder of a vocabulary file; what it knows serves the tasks that follow."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def tokenize(docs: DataFrame, vocabulary: str, end: int = END) -> DataFrame:
    """(doc_id, ids): the ids of every whole text (null: empty) and the end id, as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for b in slices(batch, "text"):
                ids, off = encode(b.column("text"))
                ids = np.insert(ids, off[1:], np.uint32(end)).astype("<u4")
                off = off + np.arange(len(off))
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer((off * 4).astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), out.cast(pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for b in slices(batch, "ids"):
            c = np.bincount(utf8(b.column("ids"))[0].view("<u4"))
            if len(c) > len(total):
                total = np.r_[total, np.zeros(len(c) - len(total), np.int64)]
            total[: len(c)] += c
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["id", "n"])


BLOCKS = "part int, first_id long, last_id long, task int, block int, doc_ids array<bigint>, lengths array<bigint>, n long, lanes int, states binary, payload binary, marks binary, crc long"


def _encode(symbols: np.ndarray, freq: np.ndarray):
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    names = [c.split()[0] for c in BLOCKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, block, part, held = rans.Table(symbols, freq), 0, None, 0
        task = TaskContext.get().partitionId()  # with the block's number a name of its own, also where one part is encoded by several tasks
        docs: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            e = rans.encode(np.concatenate(ids), table)
            row = [part, docs[0], docs[-1], task, block, docs, [len(x) for x in ids], e["n"], e["lanes"], e["states"], e["payload"], e["marks"], e["crc"]]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

        for b in batches:
            for p, d, x in zip(b.column("part").to_pylist(), b.column("doc_id").to_pylist(), b.column("ids")):
                if ids and (held >= BLOCK_IDS or p != part):
                    yield flush()
                    block, docs, ids, held = block + 1, [], [], 0
                part = p
                docs.append(d)
                ids.append(np.frombuffer(x.as_buffer(), "<u4"))
                held += len(ids[-1])
        if ids:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end: int = END) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write the files under ``path``.

    Range-sorted by doc_id, nulls first; rows that repeat a doc_id follow each
    other. An empty table writes empty files. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = plain.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    ids = tokenize(texts, vocabulary or default_vocabulary(), end).withColumn("part", F.spark_partition_id())
    with batches_of(spark, 1000):
        tokens = scratch.store(ids, "ids", "zstd")
        _encode_files(tokens, path)
    scratch.drop(tokens)


def _encode_files(tokens: DataFrame, path: str) -> None:
    spark = tokens.sparkSession
    counts = tokens.select("ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counts.collect()  # a row for each id that occurs: at most the vocabulary
    shared = rans.Table.of_counts(np.array([r["id"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64))
    symbols, freq = shared.symbols.astype(np.int64), shared.freq.astype(np.int64)
    spark.createDataFrame([(int(s), int(f)) for s, f in zip(symbols, freq)], "id long, freq long").coalesce(1).write.parquet(f"{path}/table")
    tokens.mapInArrow(_encode(symbols, freq), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def _decode(symbols: np.ndarray, freq: np.ndarray, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(symbols, freq)
        for batch in batches:
            for block in batch.to_pylist():
                ids = rans.decode(block, table).astype("<u4")
                lengths = np.array(block["lengths"], np.int64)
                ends = np.cumsum(lengths)
                views = [memoryview(ids[e - n : e]).cast("B") for n, e in zip(lengths, ends)]
                last = pa.array([bytes(v) for v in views], pa.binary()) if keep_ids else pa.array([zlib.crc32(v) for v in views], pa.int64())
                k = len(lengths)
                key = [pa.array([block[c]] * k, t) for c, t in (("task", pa.int32()), ("block", pa.int32()))]
                yield pa.RecordBatch.from_arrays([*key, pa.array(ends - lengths), pa.array(block["doc_ids"], pa.int64()), pa.array(lengths), last], ["task", "block", "within", "doc_id", "n_tokens", "last"])

    return run


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, and ids or ids_crc32), decoded from the files.

    ``start`` counts the ids of all documents before; every block's checksum is verified.
    """
    table = spark.read.parquet(f"{path}/table").collect()  # at most the vocabulary
    symbols, freq = np.array([r["id"] for r in table], np.int64), np.array([r["freq"] for r in table], np.int64)
    by_id = np.argsort(symbols)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    heads = blocks.select("part", "first_id", "last_id", "task", "block", "n")
    parts = heads.groupBy("part").agg(F.sum("n").alias("n"))  # as many as the range partitions
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before_part"))
    # of blocks that begin with one id, those of several tasks among them, the last to end with it comes last
    order = [F.col("first_id").asc_nulls_first(), F.col("last_id").asc_nulls_first(), "task", "block"]
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.join(parts, "part").select("task", "block", (F.col("before_part") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))
    last = "ids binary" if keep_ids else "ids_crc32 long"
    docs = blocks.mapInArrow(_decode(symbols[by_id], freq[by_id], keep_ids), "task int, block int, within long, doc_id long, n_tokens long, last " + last.split()[1])
    docs = small_join(docs, heads, ["task", "block"])
    return docs.select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", F.col("last").alias(last.split()[0]))
