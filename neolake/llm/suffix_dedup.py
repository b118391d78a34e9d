"""Removal of repeated byte strings, by threshold-bounded interval expansion on Burrows-Wheeler transforms.

A string of LENGTH bytes has a key: the least hash of the K-byte strings in it.
Consecutive strings of one text with equal keys form a segment. Texts meet by key,
so equal strings meet: first only keys and hashes of whole texts travel, to tell
which keys occur in more than one text; then the segments of those keys, equal
ones once, in blocks of whole keys. Equal texts count as one: all but the first
go whole. Each block gets a suffix order and its
Burrows-Wheeler transform. Breadth-first backward extension sets common prefixes
by increasing length and stops at LENGTH; neighbours still without a value share
LENGTH bytes or more. So each string gets the least document that has it, and
every document that comes later loses its bytes.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import BATCH_ROWS, Scratch, slices, span_hashes, utf8

LENGTH, K = 50, 20
#: Bytes of text in slices of the first pass, and of segments in a block.
SLICE, BLOCK = 1 << 20, 2 << 20
#: A key with more different segments than this, or more bytes in them, goes string by string, each under its own hash.
HOT, HOT_BYTES = 50_000, 8 << 20


# --- one block -----------------------------------------------------------------


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of their next ``depth`` symbols or more (zeros follow the end), by prefix doubling."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    padded = np.r_[text.astype(np.uint64), np.zeros(7, np.uint64)]
    for i in range(7):
        key = (key << np.uint64(9)) | padded[i : i + n]
    step = 7
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]]).astype(np.uint64)
        if step >= depth or int(rank[order[-1]]) == n:
            return order
        later = np.zeros(n, np.uint64)
        later[: n - step] = rank[step:]
        key = (rank << np.uint64(32)) | later
        step *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Common prefix with the predecessor in the order, for values below ``length``; -1 where it is ``length`` or more."""
    n = len(text)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[by_symbol] = np.arange(n)  # where the suffix one symbol longer stands
    first = text[order]
    turn = np.r_[True, first[1:] != first[:-1]]
    prefix = np.full(n + 1, -1, np.int16)
    prefix[0] = prefix[n] = 0
    starts, ends = np.array([0]), np.array([n])
    for value in range(length):
        size = ends - starts
        members = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
        owner = np.repeat(np.arange(len(starts)), size)
        if len(members) * 8 > n:  # dense: by scattering, else by sorting
            at = np.full(n, -1, np.int64)
            at[back[members]] = owner
            place = np.flatnonzero(at >= 0)
            owner = at[place]
        else:
            place = back[members]
            o = np.argsort(place)
            place, owner = place[o], owner[o]
        begin = np.r_[True, (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1) | turn[place[1:]]]
        starts = place[begin]
        ends = place[np.r_[begin[1:], True]] + 1
        fresh = prefix[ends] == -1
        starts, ends = starts[fresh], ends[fresh]
        prefix[ends] = value
        if not len(starts):
            break
    return prefix[:n]


def least_holders(segments: np.ndarray, offsets: np.ndarray, holders: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each string of ``length`` bytes of the segments, in order, the least holder of a segment that has it."""
    count = len(holders)
    sizes = np.diff(offsets)
    text = np.zeros(len(segments) + count, np.uint16)
    at = np.arange(len(segments)) + np.repeat(np.arange(count), sizes)
    text[at] = segments.astype(np.uint16) + 1  # a zero ends each segment
    order = suffix_order(text, length)
    prefix = common_prefixes(text, order, length)
    begins = offsets[:-1] + np.arange(count)
    own = np.repeat(np.arange(count), sizes + 1)
    holder = holders[own]
    whole = np.arange(len(text)) - begins[own] + length <= sizes[own]
    kind = np.cumsum(prefix != -1) - 1  # equal for suffixes that share ``length`` symbols
    value = np.where(whole, holder, np.iinfo(np.int64).max)[order]
    least = np.minimum.reduceat(value, np.flatnonzero(prefix != -1))
    out = np.empty(len(text), np.int64)
    out[order] = least[kind]
    return out[whole]


# --- keys ----------------------------------------------------------------------


def segment_starts(data: np.ndarray, off: np.ndarray, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, first string, number of strings) of every segment of texts cut at ``off``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    s = np.arange(len(data) - k + 1)
    h = span_hashes(data, s, s + k)
    w, m, span = length - k + 1, h, 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    n = len(h) - w + 1
    m = np.minimum(m[:n], m[w - span : w - span + n])
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    ok = np.arange(n) + length <= off[row + 1]
    begin = ok & np.r_[True, (m[1:] != m[:-1]) | (row[1:] != row[:-1])]
    last = ok & np.r_[(m[1:] != m[:-1]) | (row[1:] != row[:-1]) | ~ok[1:], True]
    i, j = np.flatnonzero(begin), np.flatnonzero(last)
    return m[i], row[i], i, j - i + 1


def _packed(part: np.ndarray, key: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One row for each part with its keys and, side by side, their texts."""
    o = np.argsort(part, kind="stable")
    part, key, doc = part[o], key[o].astype("<u8"), doc[o].astype("<i8")
    cut = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cut[:-1]].astype(np.int32)), pa.array([key[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()), pa.array([doc[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary())],
        ["part", "keys", "docs"],
    )


def _bucket(doc: np.ndarray, parts: int) -> np.ndarray:
    """The bucket that a text's keys are gathered in."""
    return (doc.view(np.uint64) % np.uint64(parts)).astype(np.int64)


def _keys(parts: int):
    """Of each slice: keys in more than one of its texts, by bucket (-1 - bucket as the part), and a text for each key to the key's part. Texts are told apart by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", SLICE):
                data, off = utf8(b.column("text"))
                key, row, _, _ = segment_starts(data, off)
                if not len(key):
                    continue
                doc = b.column("h").to_numpy()[row]
                o = np.lexsort((doc, key))
                key, doc = key[o], doc[o]
                new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
                key, doc = key[new], doc[new]
                group = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                many = np.repeat(np.diff(np.r_[group, len(key)]) > 1, np.diff(np.r_[group, len(key)]))
                if many.any():
                    yield _packed(-1 - _bucket(doc[many], parts), key[many], doc[many])
                key, doc = key[group], doc[group]
                yield _packed((key % np.uint64(parts)).astype(np.int64), key, doc)

    return run


def _repeated(parts: int):
    """Of one part, the keys that came with different texts, in a row for each bucket of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs = [], []
        for b in batches:
            part = b.column("part").to_numpy()
            ready = b.filter(pa.array(part < 0))
            if ready.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(-1 - part[part < 0]), ready.column("keys"), ready.column("docs")], ["bucket", "keys", "docs"])
            for p, k, d in zip(part, b.column("keys"), b.column("docs")):
                if p >= 0:
                    keys.append(np.frombuffer(k.as_buffer(), "<u8"))
                    docs.append(np.frombuffer(d.as_buffer(), "<i8"))
        if not keys:
            return
        key, doc = np.concatenate(keys), np.concatenate(docs)
        del keys, docs
        o = np.argsort(key, kind="stable")
        key, doc = key[o], doc[o]
        group = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        many = np.maximum.reduceat(doc, group) > np.minimum.reduceat(doc, group)
        keep = np.repeat(many, np.diff(np.r_[group, len(key)]))
        if keep.any():
            yield _packed(_bucket(doc[keep], parts), key[keep], doc[keep]).rename_columns(["bucket", "keys", "docs"])

    return run


def _by_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of whole buckets, in one row a text."""
    keys, docs = [], []
    for b in batches:
        for k, d in zip(b.column("keys"), b.column("docs")):
            keys.append(np.frombuffer(k.as_buffer(), "<u8"))
            docs.append(np.frombuffer(d.as_buffer(), "<i8"))
    if not keys:
        return
    key, doc = np.concatenate(keys), np.concatenate(docs)
    del keys, docs
    o = np.argsort(doc, kind="stable")
    key, doc = key[o], doc[o]
    cut = np.r_[np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)]
    for i in range(0, len(cut) - 1, BATCH_ROWS):
        ends = cut[i : i + BATCH_ROWS + 1]
        yield pa.RecordBatch.from_arrays([pa.array(doc[ends[:-1]]), pa.array([key[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary())], ["h", "keys"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of each document whose keys were found to be repeated."""
    for batch in batches:
        for b in slices(batch, "text", SLICE):
            data, off = utf8(b.column("text"))
            key, row, start, n = segment_starts(data, off)
            if not len(key):
                continue
            wanted = [np.frombuffer(x or b"", "<u8") for x in b.column("keys").to_pylist()]
            cut = np.searchsorted(row, np.arange(b.num_rows + 1))
            keep = np.concatenate([np.isin(key[i:j], w) for i, j, w in zip(cut, cut[1:], wanted)])
            key, row, start, n = key[keep], row[keep], start[keep], n[keep]
            if not len(key):
                continue
            end = start + n + LENGTH - 1
            raw = data.tobytes()
            parts = [raw[i:j] for i, j in zip(start.tolist(), end.tolist())]
            name = np.array([xxhash.xxh3_64_intdigest(x) for x in parts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(name.view(np.int64)), pa.array(b.column("doc_id").to_numpy()[row]), pa.array(b.column("twin").to_numpy()[row]), pa.array(start - off[row]), pa.array(parts, pa.binary())],
                ["key", "name", "doc_id", "twin", "start", "segment"],
            )


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of whole keys (rows come sorted by key): per segment the least holders of its strings.

    The only segment of a key shares no string with another one, so it isn't put into the block.
    """

    def solve(rows: pa.RecordBatch) -> pa.RecordBatch:
        key, name, holder = (rows.column(c).to_numpy() for c in ("key", "name", "holder"))
        data, off = utf8(rows.column("segment"))
        n = np.diff(off) - LENGTH + 1
        new = np.r_[True, key[1:] != key[:-1]]
        several = ~(new & np.r_[new[1:], True])
        least = np.repeat(holder, n)
        if several.any():
            own, many = utf8(rows.filter(pa.array(several)).column("segment"))
            least[np.repeat(several, n)] = least_holders(own, many, holder[several])
        cut = np.r_[0, np.cumsum(n)]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(name), pa.array([least[i:j].astype("<i8").tobytes() for i, j in zip(cut, cut[1:])], pa.binary())], ["key", "name", "least"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for b in slices(batch, "segment", BLOCK):
            held.append(b)
            size += len(utf8(b.column("segment"))[0])
            if size < BLOCK:
                continue
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = t.column("key").to_numpy()
            cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if cut:
                yield solve(t.slice(0, cut))
            held = [t.slice(cut)]
            size = len(utf8(held[0].column("segment"))[0])
    if held:
        t = pa.Table.from_batches(held).combine_chunks().to_batches()
        if t and t[0].num_rows:
            yield solve(t[0])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a segment as a segment of its own, under its own hash."""
    for b in batches:
        for key, name, holder, x in zip(*(b.column(c).to_pylist() for c in ("key", "name", "holder", "segment"))):
            data = np.frombuffer(x, np.uint8)
            s = np.arange(len(data) - LENGTH + 1)
            h = span_hashes(data, s, s + LENGTH).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(s), key)), pa.array(np.full(len(s), name)), pa.array(s), pa.array(np.full(len(s), holder)), pa.array([x[i : i + LENGTH] for i in s], pa.binary())], ["key", "parent_key", "parent", "nth", "holder", "segment"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each occurrence of a segment, runs of bytes whose strings have a holder before the document."""
    for b in batches:
        least, off = utf8(b.column("least"))
        if not b.num_rows:
            continue
        least, off = least.view("<i8"), off // 8
        row = np.repeat(np.arange(b.num_rows), np.diff(off))
        doc = b.column("doc_id").to_numpy()
        at = np.flatnonzero(least < doc[row])
        if not len(at):
            continue
        pos = b.column("start").to_numpy()[row[at]] + at - off[row[at]]
        new = np.r_[True, (row[at][1:] != row[at][:-1]) | (at[1:] != at[:-1] + 1)]
        end = np.r_[new[1:], True]
        twin = b.column("twin").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(doc[row[at][new]]), pa.array(twin[row[at][new]]), pa.array(pos[new]), pa.array(pos[end] + LENGTH)], ["doc_id", "twin", "from", "to"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text without its removed runs, and its figures."""
    for batch in batches:
        for b in slices(batch, "text"):
            rows = []
            for i, text, runs in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("runs").to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                kept, at, spans = [], 0, 0
                for r in sorted((r["from"], r["to"]) for r in runs or ()):
                    if r[1] <= at:
                        continue
                    if spans == 0 or r[0] > at:
                        spans += 1
                    kept.append(raw[at : r[0]])
                    at = r[1]
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((i, len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest(), left))
            cols = list(zip(*rows))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _release(scratch: Scratch) -> None:
    """Let Spark delete the shuffle files of plans that are done with."""
    gc.collect()
    scratch.spark._jvm.System.gc()


def removed_runs(texts: DataFrame, firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, twin, from, to): runs of bytes, overlapping maybe, that an earlier document's strings cover, of the first of equal texts."""
    parts = max(1, int(scratch.spark.conf.get("spark.sql.shuffle.partitions")))
    met = texts.select("text", "h").mapInArrow(_keys(parts), "part int, keys binary, docs binary").repartition(parts, F.when(F.col("part") < 0, F.xxhash64("docs")).otherwise(F.col("part").cast("long")))
    gathered = met.mapInArrow(_repeated(parts), "bucket int, keys binary, docs binary").repartition(parts, "bucket")
    # one row a text before the join; a text's keys are fewer than its bytes
    wanted = scratch.store(gathered.mapInArrow(_by_text, "h long, keys binary"), "keys")
    del met, gathered
    _release(scratch)
    asked = wanted.join(firsts.select("h", "g", F.col("first").alias("doc_id"), "twin"), "h")
    # rows that repeat an id and a text give equal rows here; they count once below
    own = texts.join(asked, ["doc_id", "h", "g"]).select("doc_id", "twin", "text", "keys")
    found = scratch.store(own.mapInArrow(_segments, "key long, name long, doc_id long, twin int, start long, segment binary"), "segments", "zstd")
    scratch.drop(wanted)
    del asked, own
    _release(scratch)
    distinct = scratch.store(found.groupBy("key", "name", "segment").agg(F.min("doc_id").alias("holder")).select("key", "name", "holder", "segment"), "distinct", "zstd")
    _release(scratch)
    sizes = distinct.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("segment")).alias("bytes"))
    hot = scratch.store(sizes.where((F.col("n") > HOT) | (F.col("bytes") > HOT_BYTES)).select("key"), "hot")
    solve = lambda df: df.repartition("key").sortWithinPartitions("key").mapInArrow(_resolve, "key long, name long, least binary")
    if hot.isEmpty():
        least = solve(distinct)
    else:
        least = solve(distinct.join(hot, "key", "left_anti").select("key", "name", "holder", "segment"))
        each = distinct.join(hot, "key", "left_semi").select("key", "name", "holder", "segment").mapInArrow(_windows, "key long, parent_key long, parent long, nth long, holder long, segment binary")
        each = scratch.store(each, "strings", "zstd")
        once = each.groupBy("key", "segment").agg(F.min("holder").alias("holder"))
        named = once.select("key", F.col("key").alias("name"), "holder", "segment")
        back = each.join(solve(named).drop("name"), "key")
        joined = back.groupBy("parent_key", "parent").agg(F.sort_array(F.collect_list(F.struct("nth", "least"))).alias("x"))
        least = least.union(joined.select(F.col("parent_key").alias("key"), F.col("parent").alias("name"), F.expr("aggregate(x, cast('' as binary), (a, y) -> concat(a, y.least))").alias("least")))
    least = scratch.store(least, "least", "zstd")
    scratch.drop(distinct)
    _release(scratch)
    hits = found.select("key", "name", "doc_id", "twin", "start").join(least, ["key", "name"])
    runs = scratch.store(hits.select("doc_id", "twin", "start", "least").mapInArrow(_removed, "doc_id long, twin int, `from` long, `to` long"), "runs")
    scratch.drop(found)
    scratch.drop(least)
    _release(scratch)
    return runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept), one row for every row of ``docs`` (doc_id, text).

    A byte goes if a string of LENGTH bytes over it starts in a document with a
    smaller doc_id too; strings are those of the input and stay inside one text.
    A null text is an empty one. A row with a null doc_id neither loses bytes nor
    makes others lose some; rows that repeat a doc_id don't count against each
    other. Other columns are ignored. Texts are told apart by two 64-bit hashes.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumns({"h": F.xxhash64("text"), "g": F.xxhash64(F.lit(7), F.col("text"))})
    firsts = texts.where("doc_id is not null").groupBy("h", "g").agg(F.min("doc_id").alias("first"))
    twins = Window.partitionBy("first").orderBy("h", "g")
    firsts = scratch.store(firsts.withColumn("twin", F.row_number().over(twins) - 1), "firsts")
    runs = removed_runs(texts.where("doc_id is not null"), firsts, scratch)
    scratch.keep(firsts, runs)
    runs = runs.groupBy("doc_id", "twin").agg(F.collect_set(F.struct("from", "to")).alias("runs"))
    runs = firsts.join(runs.withColumnRenamed("doc_id", "first"), ["first", "twin"], "left").select("h", "g", "first", "runs")
    out = texts.join(runs, ["h", "g"], "left")
    size = F.octet_length("text").cast("long")
    whole = (F.col("doc_id") > F.col("first")) & (size >= LENGTH)
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("from"), size.alias("to")))
    runs = F.when(F.col("doc_id").isNull(), F.lit(None)).when(whole, all_of_it).otherwise(F.col("runs"))
    return out.select("doc_id", "text", runs.alias("runs")).mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
