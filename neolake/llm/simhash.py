"""SimHash near-duplicates by anchor-point covering.

Fingerprints at ``RADIUS`` = 3 or fewer differing bits agree, in one of their two
32-bit halves, up to one bit. For each half the anchors are the words of a
covering code: Hamming's perfect code on 31 bits times one free bit, covering
radius 1. A fingerprint is replicated to every anchor within the covering
radius plus the threshold of the half, 1 + 1, that is to 17 anchors at most; it
is at home at the nearest. If x and y are within one bit, y is within 2 of x's
home, so the two meet there and their whole 64 bits are compared.

An anchor with more than ``HOT`` fingerprints isn't compared pair by pair.
Its fingerprints go to all points within two bits of them instead. Where some
fingerprint is within one bit of a point, all that are within two of it are
within three of that one; and any two within three bits meet so. (For a smaller
radius r: within r - r // 2 and r // 2 bits.) Their work is linear, and the
links found have the same components.

Near copies by Jaccard index start from such links and are completed by a prefix
filter. Before two texts' shingle sets are compared, so are their parity bits: a
shingle flips one of B bits, so two sets differ in at least as many elements as
their bits do, and pairs too far apart are dropped without their sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import BASE, Scratch, mix64, name_hashes, slices, small_join, utf8, words
from .graph import connected_components

SEED = 42
HOT = 4096
#: Bytes of text that are outlined at once: a word takes 128 bytes there.
OUTLINED = 1 << 19
#: Most frequent shingles that come last in the order of a text's shingles; any order gives the same copies.
FREQUENT = 100_000
#: Texts of one shingle are paired by their distance in order of size: up to the first of these, then SPREAD times as far.
NEAR, SPREAD = 8, 8
#: Before that, each text is tried with so many neighbours by so many of its most frequent shingles.
SHARED = 2
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over the word shingles of ``text``, repeats included; 0 where there is no word."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(runs), 1 << 16):
        h = np.array([xxhash.xxh64_intdigest(x, SEED) for x in runs[i : i + (1 << 16)]], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(runs), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row a document; fp is the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(x, shingle) for x in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _syndrome(x: np.ndarray) -> np.ndarray:
    s = np.zeros(len(x), np.uint32)
    for i in range(1, 32):
        s ^= np.where((x >> np.uint32(i - 1)) & np.uint32(1), np.uint32(i), np.uint32(0))
    return s


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within 2 of each 32-bit value, as a matrix, and which of them to use; column 0 is its home."""
    s = _syndrome(half)
    bit = np.array([0] + [1 << (i - 1) for i in range(1, 32)], np.uint32)
    pairs = np.array([[bit[i] | bit[i ^ k] for i in range(1, 32) if i < i ^ k] if k else [0] * 15 for k in range(32)], np.uint32)
    home = half ^ bit[s]
    out = np.concatenate([home[:, None], home[:, None] ^ np.uint32(1 << 31), half[:, None] ^ pairs[s]], axis=1)
    use = np.ones(out.shape, bool)
    use[s == 0, 2:] = False  # the value is a code word: the others are at 3 or more
    return out, use


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column("fp").to_numpy().view(np.uint64)
        for k in (0, 1):
            half = (fp >> np.uint64(32 * k)).astype(np.uint32)
            at, use = anchors(half)
            rows = np.nonzero(use)
            key = at[rows].astype(np.int64) | np.int64(k << 32)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[rows[0]].view(np.int64)), pa.array(rows[1] == 0)], ["anchor", "fp", "home"])


def _forest(fp: np.ndarray, home: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one anchor's fingerprints: pairs are compared, few are returned."""
    left, out = np.ones(len(fp), bool), []
    todo: list[int] = []
    while left.any():
        if not todo:
            todo = [int(np.flatnonzero(left)[0])]
            left[todo] = False
        i = todo.pop()
        near = left & (np.bitwise_count(fp ^ fp[i]) <= radius)
        if not home[i]:
            near &= home
        found = np.flatnonzero(near)
        left[found] = False
        todo += found.tolist()
        out += [(int(fp[i]), int(fp[j])) for j in found]
    return out


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, home = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        hot_key: int | None = None

        def emit(u: np.ndarray, v: np.ndarray, hot: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(np.full(len(u), hot))], ["u", "v", "hot"])

        def compare(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[pa.RecordBatch]:
            if not len(key):
                return
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            links: list[tuple[int, int]] = []
            pair = start[size == 2]
            if len(pair):
                a, b = fp[pair], fp[pair + 1]
                ok = (home[pair] | home[pair + 1]) & (np.bitwise_count(a ^ b) <= radius)
                yield emit(a[ok], b[ok], False)
            for i, n in zip(start[size > 2], size[size > 2]):
                if n > HOT:
                    yield emit(fp[i : i + n], fp[i : i + n], True)
                elif home[i : i + n].any():
                    links += _forest(fp[i : i + n], home[i : i + n], radius)
            if links:
                x = np.array(links, np.uint64)
                yield emit(x[:, 0].copy(), x[:, 1].copy(), False)

        for b in batches:
            k, f, h = b.column("anchor").to_numpy(), b.column("fp").to_numpy().view(np.uint64), b.column("home").to_numpy(zero_copy_only=False)
            if hot_key is not None:  # the rest of an anchor already known to be hot
                same = k == hot_key
                if same.any():
                    yield emit(f[same], f[same], True)
                    k, f, h = k[~same], f[~same], h[~same]
                if len(k):
                    hot_key = None
            key, fp, home = np.r_[key, k], np.r_[fp, f], np.r_[home, h]
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1], side="left"))  # the last anchor may go on in the next batch
            yield from compare(key[:cut], fp[:cut], home[:cut])
            key, fp, home = key[cut:], fp[cut:], home[cut:]
            if len(key) > HOT:
                yield emit(fp, fp, True)
                hot_key, key, fp, home = int(key[-1]), key[:0], fp[:0], home[:0]
        yield from compare(key, fp, home)

    return run


def _balls(inner: int, outer: int):
    """Each fingerprint at every point within ``outer`` (0 to 2) bits, marked where within ``inner``."""
    one = [1 << i for i in range(64)]
    two = [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    kept = [m for k, m in enumerate(([0], one, two)) if k <= outer]
    masks = np.array([x for m in kept for x in m], np.uint64)
    near = np.repeat([k <= inner for k in range(len(kept))], [len(m) for m in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(fp), 256):
                part = fp[i : i + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((part[:, None] ^ masks).ravel().view(np.int64)), pa.array(np.repeat(part, len(masks)).view(np.int64)), pa.array(np.tile(near, len(part)))], ["point", "fp", "inner"]
                )

    return run


def links(fps: DataFrame, scratch: Scratch, radius: int = 3) -> DataFrame:
    """(u, v): links whose components are those of all pairs of ``fps`` (distinct fp) within ``radius`` bits."""
    if not 0 <= radius <= 3:
        raise ValueError("the covering code is for 0 to 3 differing bits")
    met = fps.select("fp").mapInArrow(_replicate, "anchor long, fp long, home boolean").repartition("anchor").sortWithinPartitions("anchor")
    found = scratch.store(met.mapInArrow(_compare(radius), "u long, v long, hot boolean"), "met")
    cold = found.where("not hot").select("u", "v").distinct()
    hot = found.where("hot").select(F.col("u").alias("fp")).distinct()
    if hot.isEmpty():
        return cold
    balls = scratch.store(hot.mapInArrow(_balls(radius // 2, radius - radius // 2), "point long, fp long, inner boolean"), "balls")
    hubs = balls.groupBy("point").agg(F.min(F.when(F.col("inner"), F.col("fp"))).alias("hub"), F.count("*").alias("n")).where("hub is not null and n > 1")
    stars = balls.join(hubs.select("point", "hub"), "point").where("fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v"))
    return cold.union(stars.distinct())


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    ``fingerprint``: 16 hex digits over shingles of ``shingle`` words, 0 for a
    null text or one without words. ``component_id``: the least doc_id reachable
    by links of ``radius`` or fewer differing bits. Repeated rows are kept;
    documents with one fingerprint are one node, however many they are; a null
    doc_id is linked but never names a component unless all are null. Other
    columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    own = scratch.store(fingerprints(docs, shingle), "fingerprints")
    fps = scratch.store(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    parts = connected_components(links(fps, scratch, radius), scratch)
    named = fps.join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = scratch.store(named.join(least, "component").select("fp", "component_id"), "components")
    scratch.keep(own, ids)
    return own.join(ids, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _bits(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SimHash of each run of ``counts`` hashes: a bit is 1 if set in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    at = np.flatnonzero(counts)
    if len(at):
        ones = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(ones, (np.cumsum(counts) - counts)[at], axis=0, dtype=np.int32)
        out[at] = np.packbits(2 * sums > counts[at, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _parities(h: np.ndarray, counts: np.ndarray) -> pa.Array:
    """For each run of ``counts`` hashes, bits flipped by each: as many as hashes, up to the next power of two, 64 at least."""
    size = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64))
    ends = np.cumsum(size)
    at = np.repeat(ends - size, counts) + (h & np.repeat(size - 1, counts).astype(np.uint64)).astype(np.int64)
    flipped = (np.bincount(at, minlength=int(ends[-1]) if len(ends) else 0) & 1).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(np.r_[0, ends // 8].astype(np.int32)), pa.py_buffer(np.packbits(flipped, bitorder="little"))])


#: Parity bits of a fixed size, 256, for comparisons inside a task.
SMALL = ["s0", "s1", "s2", "s3"]
OUTLINE = "doc_id long, name binary, fp0 long, fp1 long, n int, bits binary, " + ", ".join(f"{x} long" for x in SMALL)


def _outlines(shingle: int):
    """The text's 128-bit name, SimHash of its sets of shingles and of words, number of shingles and their parity bits, of two sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", OUTLINED):
                h, row = _words(b)
                upto = np.searchsorted(row, np.arange(b.num_rows + 1))
                names = [xxhash.xxh3_128_digest(h[i:j].tobytes()) for i, j in zip(upto, upto[1:])]
                own, words = _sets(row, h)
                at, shingles = _sets(*_runs(row, h, shingle))
                n = np.bincount(at, minlength=b.num_rows)
                flipped = np.bincount(at * 256 + (shingles & np.uint64(255)).astype(np.int64), minlength=256 * b.num_rows) & 1
                small = np.packbits(flipped.astype(np.uint8), bitorder="little").view("<i8").reshape(-1, 4)
                fps = _bits(shingles, n), _bits(mix64(words ^ np.uint64(BASE)), np.bincount(own, minlength=b.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(names, pa.binary()), *[pa.array(x.view(np.int64)) for x in fps], pa.array(n.astype(np.int32)), _parities(shingles, n), *[pa.array(small[:, k].copy()) for k in range(4)]], [c.split()[0] for c in OUTLINE.split(", ")]
                )

    return run


def _far_in_bits(a: bytes, b: bytes) -> int:
    """Differing parity bits; the longer field is folded to the length of the other."""
    if len(a) < len(b):
        a, b = b, a
    x, size = int.from_bytes(a, "little"), 8 * len(a)
    while size > 8 * len(b):
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def _may_be_close(similarity: float):
    """Pairs whose parity bits allow an index of ``similarity``: the sets differ in at most (1 - s) / (1 + s) of n + m elements."""
    share = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = share * (b.column("nu").to_numpy().astype(np.int64) + b.column("nv").to_numpy()) + 1e-9
            keep = [_far_in_bits(x, y) <= m for x, y, m in zip(b.column("bu").to_pylist(), b.column("bv").to_pylist(), most.tolist())]
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shingle_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                row, h = _shingles(b, shingle)
                upto = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(upto), pa.array(h.view(np.int64)))], ["doc_id", "shingles"])

    return run


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every lower-cased word."""
    data, off = utf8(batch.column("text"))
    data = np.frombuffer(_LOWER, np.uint8)[data]
    s, e, row = words(data, off)
    return (name_hashes(data, s, e) if len(s) else np.zeros(0, np.uint64)), row


def _runs(row: np.ndarray, h: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``shingle`` words; a shorter text is one run, a wordless one has none."""
    if not len(h):
        return row, h
    first, last = np.searchsorted(row, row), np.searchsorted(row, row, side="right")
    i = np.arange(len(row))
    i = i[(i + shingle <= last) | (i == first)]
    out = h[i]
    for k in range(1, shingle):
        more = i + k < last[i]
        out[more] = mix64(out[more] * np.uint64(BASE) + h[i[more] + k])
    return row[i], out


def _sets(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's hashes once, in order."""
    if not len(h):
        return row, h
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]
    return row[new], h[new]


def _shingles(batch: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word shingle, once a row, by row."""
    h, row = _words(batch)
    return _sets(*_runs(row, h, shingle))


def _frequent(shingle: int):
    """Shingles that some run of texts has three times or more, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                h, n = np.unique(_shingles(b, shingle)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[n > 2].view(np.int64)), pa.array(n[n > 2])], ["key", "n"])

    return run


def _prefixes(shingle: int, similarity: float, frequent: np.ndarray, counts: np.ndarray):
    """Each text's first shingles, by count in ``frequent`` and hash: two texts at ``similarity`` share one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                row, h = _shingles(b, shingle)
                weight = np.zeros(len(h), np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
                    weight = np.where(frequent[at] == h, counts[at], 0)
                h = h[np.lexsort((h, weight, row))]
                first = np.searchsorted(row, row)
                n, at = np.searchsorted(row, row, side="right") - first, np.arange(len(row)) - first
                use = at <= n - np.ceil(similarity * n - 1e-9)
                head = b.column("doc_id").to_numpy()[row[use]]
                yield pa.RecordBatch.from_arrays([pa.array(h[use].view(np.int64)), pa.array(head), pa.array(n[use].astype(np.int32)), pa.array(at[use].astype(np.int32))], ["key", "head", "n", "at"])

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows by key, those whose key another row has."""
    held: pa.RecordBatch | None = None
    held_met = False
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column("key").to_numpy()
        same = key[1:] == key[:-1]
        on = held is not None and held.column("key")[0].as_py() == key[0]
        if held is not None and (held_met or on):
            yield held
        met = np.r_[on, same] | np.r_[same, False]
        yield b.slice(0, b.num_rows - 1).filter(pa.array(met[:-1]))
        held, held_met = b.slice(b.num_rows - 1), bool(met[-1])
    if held is not None and held_met:
        yield held


def _pairs(similarity: float, start: int, stop: int):
    """Pairs of one key's texts, by size, that are ``start`` to ``stop - 1`` places apart, that aren't in one component yet and that sizes, places and small parity bits allow to be copies."""
    share = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "head", "component", "n", "at", *SMALL]
        rows = [np.zeros(0, np.int64)] * len(names)
        for b in batches:
            if not b.num_rows:
                continue
            old = len(rows[0])
            rows = [np.r_[x, b.column(c).to_numpy().astype(np.int64)] for x, c in zip(rows, names)]
            key, head, component, n, at, *small = rows
            j = np.arange(max(old, start), len(key))
            for d in range(start, stop):
                j = j[j >= d]
                j = j[(key[j - d] == key[j]) & (n[j - d] >= similarity * n[j] - 1e-9)]
                if not len(j):
                    break
                i = j - d
                most = np.minimum(at[i], at[j]) + 1 + np.minimum(n[i] - at[i], n[j] - at[j]) - 1
                ok = (component[i] != component[j]) & (most >= similarity * (n[i] + n[j] - most) - 1e-9)
                i, o = i[ok], j[ok]
                far = sum((np.bitwise_count((x[i] ^ x[o]).view(np.uint64)).astype(np.int64) for x in small), np.zeros(len(i), np.int64))
                ok = far <= share * (n[i] + n[o]) + 1e-9
                u, v = head[i[ok]], head[o[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])
            keep = max(int(np.searchsorted(key, key[-1])), len(key) - stop + 1)
            rows = [x[keep:] for x in rows]

    return run


def _close(texts: DataFrame, outlines: DataFrame, edges: DataFrame, shingle: int, similarity: float, scratch: Scratch) -> DataFrame:
    """The ``edges`` whose texts' shingle sets have a Jaccard index of ``similarity`` or more."""
    side = lambda x: outlines.select(F.col("head").alias(x), F.col("n").alias("n" + x), F.col("bits").alias("b" + x))
    edges = scratch.store(edges.join(side("u"), "u").join(side("v"), "v").mapInArrow(_may_be_close(similarity), "u long, v long"), "likely")
    nodes = edges.select(F.col("u").alias("doc_id")).union(edges.select("v")).distinct()
    sets = small_join(texts, nodes, ["doc_id"], "left_semi").mapInArrow(_shingle_sets(shingle), "doc_id long, shingles array<bigint>")
    sets = scratch.store(sets, "shingles")
    a, b = sets.toDF("u", "a"), sets.toDF("v", "b")
    shared = F.size(F.array_intersect("a", "b"))
    out = scratch.store(edges.join(a, "u").join(b, "v").where(shared >= similarity * (F.size("a") + F.size("b") - shared)).select("u", "v"), "close")
    scratch.drop(sets)
    return out


def _merged(parts: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Components (node, component) with more edges (u, v): only components, not their nodes, are joined anew."""
    side = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    named = edges.join(side("u"), "u", "left").join(side("v"), "v", "left").select(F.coalesce("u_part", "u").alias("u"), F.coalesce("v_part", "v").alias("v"))
    joined = scratch.store(connected_components(named, scratch), "joined")
    known = parts.join(joined.toDF("component", "now"), "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    fresh = joined.join(parts.select("node"), "node", "left_anti")
    out = scratch.store(known.unionByName(fresh), "parts")
    scratch.drop(joined)
    return out


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id) of the documents that are copies of one with a smaller id.

    Every doc_id must be there once; null and empty texts, and those without
    words, are copies of each other. Copies are linked where the sets of
    ``shingle``-word shingles have a Jaccard index of ``similarity`` or more; equal
    word sequences always are. Links of SimHash fingerprints within 3 bits, of the
    set of shingles and of the set of words, are tried first and gather most
    copies. What they miss comes from a prefix filter, which misses none: in any
    one order of all shingles, two such texts share one of their first
    n - ceil(similarity * n) + 1. Texts of one shingle are paired by rising
    distance in order of size, except where a link already joins them, until no
    pair is left; so a large group of copies takes a few links a text.
    """
    scratch = Scratch(docs.sparkSession, "copies")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    own = scratch.store(texts.mapInArrow(_outlines(shingle), OUTLINE), "outlines")
    heads = own.groupBy("name").agg(F.min("doc_id").alias("head"), *[F.any_value(x).alias(x) for x in ("fp0", "fp1", "n", "bits", *SMALL)])  # equal names, equal outlines
    heads = scratch.store(heads, "heads")
    edges = None
    for x in ("fp0", "fp1"):
        first = scratch.store(heads.groupBy(F.col(x).alias("fp")).agg(F.min("head").alias("node")), "first")
        met = links(first.select("fp"), scratch)
        u, v = first.toDF("u", "node_u"), first.toDF("v", "node_v")
        far = met.join(u, "u").join(v, "v").select(F.least("node_u", "node_v").alias("u"), F.greatest("node_u", "node_v").alias("v"))
        same = heads.select(F.col(x).alias("fp"), "head").join(first, "fp").where("head <> node").select(F.col("node").alias("u"), F.col("head").alias("v"))
        both = far.union(same)
        edges = both if edges is None else edges.union(both)
    close = _close(texts, heads, edges.distinct(), shingle, similarity, scratch)
    parts = scratch.store(connected_components(close, scratch), "parts")

    again = own.select("doc_id").join(heads.select(F.col("head").alias("doc_id")), "doc_id", "left_anti")
    once = small_join(texts, scratch.store(again, "again"), ["doc_id"], "left_anti")
    often = once.mapInArrow(_frequent(shingle), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(FREQUENT).toPandas()
    keys = often["key"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    prefixes = once.mapInArrow(_prefixes(shingle, similarity, keys[order], often["n"].to_numpy()[order]), "key long, head long, n int, at int")
    rows = scratch.store(prefixes.repartition("key").sortWithinPartitions("key").mapInArrow(_met, "key long, head long, n int, at int"), "prefixes")
    held, start, stop, early = rows, 1, NEAR + 1, True
    while True:
        known = heads.select("head", *SMALL).join(parts.withColumnRenamed("node", "head"), "head", "left").withColumn("component", F.coalesce("component", "head"))
        named = rows.join(known, "head")
        sides = named.groupBy("key").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"))
        left = scratch.store(named.join(sides.where((F.col("low") < F.col("high")) & (F.col("rows") > start)).select("key", "rows"), "key"), "left")
        if left.isEmpty():
            break
        tried = left
        if early:  # large groups first: each text by its most shared shingles only, with the texts next to it
            nth = F.row_number().over(Window.partitionBy("head").orderBy(F.desc("rows"), "key"))
            tried = left.withColumn("nth", nth).where(F.col("nth") <= SHARED)
        found = tried.drop("rows").repartition("key").sortWithinPartitions("key", "n", "head").mapInArrow(_pairs(similarity, start, SHARED + 1 if early else stop), "u long, v long").where("u <> v").distinct()
        parts, old = _merged(parts, _close(texts, heads, found, shingle, similarity, scratch), scratch), parts
        scratch.drop(old)
        scratch.drop(held)
        held, rows = left, left.select("key", "head", "n", "at")
        start, stop, early = (start, stop, False) if early else (stop, stop * SPREAD, False)
    named = heads.select("name", "head").join(parts.withColumnRenamed("node", "head"), "head", "left").select("name", F.coalesce("component", "head").alias("component_id"))
    out = scratch.store(own.select("doc_id", "name").join(named, "name").where("doc_id <> component_id").select("doc_id", "component_id"), "copies")
    scratch.keep(out)
    return out


def near_dedup(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of copies the document with the least doc_id.

    Rows that repeat a doc_id are documents of their own, in order of their texts
    (null first); of equal ones one stays. Rows with a null doc_id stay and take
    no part; null and wordless texts are copies of each other. An empty table
    gives an empty one.
    """
    known = docs.where("doc_id is not null")
    key, nameless = "doc_id", docs.where("doc_id is null")
    n, different = known.select(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if n != different:
        key = "_row"
        parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows = known.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
        known = Scratch(docs.sparkSession, "rows").store(rows.withColumn(key, F.monotonically_increasing_id()), "rows")
    gone = near_copies(known.select(F.col(key).alias("doc_id"), "text"), shingle, similarity).select(F.col("doc_id").alias(key))
    return small_join(known, gone, [key], "left_anti").select(*docs.columns).union(nameless)
