"""Benchmark decontamination by latent semantic retrieval.

Texts become sequences of benchmark word ids. Passages are TF-IDF vectors over
those; a distributed randomised SVD gives the space in which every passage is
compared with every passage of the benchmark, a stated query set, in blocks of
items. Candidates by cosine are then checked by their longest common subsequence
with the item, and by the item's answer, its last sentence, for paraphrases.

The matrix has the corpus's passages and the benchmark's, those with a larger
weight: rare words tell items apart, and alone the corpus's leading directions
hold almost none of them (at rank 128, 6 % of the items' energy). The sketch is
a sparse one: the product of the Gram matrix with a random sign for one column
of each word needs only the pairs of words of each passage, and Nystroem's
formula turns it into singular vectors without another pass. Cosines divide by
the whole vectors' lengths, so what a passage has outside the space counts
against it; where the space holds too small a share of it, no cosine is needed.
Passages of the benchmark that keep less than ``ENERGY`` of their squared length
in the space are compared by the whole vectors, word by word, instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, name_hashes, slices, utf8, words

#: Words of half a passage; passages overlap by one half.
HALF = 16
RANK, SKETCH = 256, 512
#: Weight of the benchmark's passages against the corpus's, and the share of passages above which a word counts as common.
EMPHASIS, COMMON = 10.0, 0.02
#: Words that each passage of an item keeps, its rarest, however common they are.
KEPT = 8
COSINE = 0.3
#: Share of the item's words in order that is a leak, and that is one if the answer is there too.
LCS, LCS_WITH_ANSWER = 0.8, 0.6
#: Benchmark items that are searched for at once (they are held by every task).
ITEMS = 256
#: Passages of such a block (about: items aren't cut), and the share of its squared length that a passage needs to be searched for in the space.
PASSAGES, ENERGY = 2 * RANK, 0.75
_FOLD = np.full(256, 32, np.uint8)
for _c in range(256):
    if _c >= 128 or chr(_c).isalnum():
        _FOLD[_c] = ord(chr(_c).lower()) if _c < 128 else _c


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word: lower case, ASCII punctuation as white space."""
    data, off = utf8(column)
    data = _FOLD[data]
    s, e, row = words(data, off)
    return (name_hashes(data, s, e) if len(s) else np.zeros(0, np.uint64)), row


def answer(text: str) -> str:
    """The last sentence of an item."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if re.search(r"\w", p)]
    return parts[-1] if parts else text


class Items:
    """A block of benchmark items as ids over its own vocabulary."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.ids = [i for i, _ in rows]
        h, row = word_hashes(pa.array([t for _, t in rows], pa.string()))
        self.vocabulary = np.unique(h)
        at = np.searchsorted(self.vocabulary, h).astype(np.int32)
        self.words = [at[row == k] for k in range(len(rows))]
        h, row = word_hashes(pa.array([answer(t) for _, t in rows], pa.string()))
        at = np.searchsorted(self.vocabulary, h).astype(np.int32)
        self.answers = [at[row == k] for k in range(len(rows))]

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item of every passage, passage of every word, and the words: starts at every HALF words and at the end."""
        owner, where, out = [], [], []
        for k, w in enumerate(self.words):
            last = max(0, len(w) - 2 * HALF)
            for s in sorted({*range(0, last + 1, HALF), last}):
                out.append(w[s : s + 2 * HALF])
                where.append(np.full(len(out[-1]), len(owner)))
                owner.append(k)
        return np.array(owner, np.int64), np.concatenate(where) if where else np.zeros(0, np.int64), np.concatenate(out) if out else np.zeros(0, np.int32)


def lookup(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Ids of word hashes, -1 for words the benchmark doesn't have."""
    if not len(vocabulary):
        return np.full(len(hashes), -1, np.int32)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1).astype(np.int32)


def _kind(size: int) -> str:
    """The type that written ids of ``size`` words have."""
    return "<i2" if size < 1 << 15 else "<i4"


def _to_ids(vocabulary: np.ndarray):
    kind = _kind(len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                h, row = word_hashes(b.column("text"))
                ids = lookup(h, vocabulary).astype(kind)
                off = np.searchsorted(row, np.arange(b.num_rows + 1))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([ids[i:j].tobytes() for i, j in zip(off, off[1:])], pa.binary())], ["doc_id", "ids"])

    return run


def _halves(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All ids, their texts' offsets, and of every half passage its first word and its text."""
    data, off = utf8(batch.column("ids"))
    kind = np.dtype(_kind(size))
    ids, off = data.view(kind).astype(np.int32), off // kind.itemsize
    n = -(-np.diff(off) // HALF)
    doc = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return ids, off, off[doc] + nth * HALF, doc


def _passages(ids: np.ndarray, starts: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Passage and word, once each, of passages of two halves that don't overlap; and the number of passages."""
    new = np.r_[True, doc[1:] != doc[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    passage = np.cumsum(new | ((np.arange(len(doc)) - first) % 2 == 0)) - 1
    half = np.zeros(len(ids), np.int64)
    half[starts[1:]] = 1
    known = ids >= 0
    pair = np.unique(passage[np.cumsum(half)][known] * size + ids[known])
    return pair // size, pair % size, int(passage[-1]) + 1


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size + 1, np.int64)
        for batch in batches:
            for b in slices(batch, "ids", 1 << 20):
                ids, _, starts, doc = _halves(b, size)
                if len(starts):
                    _, w, n = _passages(ids, starts, doc, size)
                    df[:size] += np.bincount(w, minlength=size)
                    df[size] += n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["id", "n"])

    return run


def _pairs(passage: np.ndarray, w: np.ndarray, x: np.ndarray, column: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Gram matrix times sketch, as words by SKETCH, of passages given as (passage, word, value), ascending."""
    out = np.zeros(len(column) * SKETCH)
    if not len(w):
        return out
    start = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    size = np.diff(np.r_[start, len(w)])
    each, base = np.repeat(size, size), np.repeat(start, size)
    upto = np.cumsum(each)
    for i in range(0, len(w), 1 << 16):
        j = min(i + (1 << 16), len(w))
        a = np.repeat(np.arange(i, j), each[i:j])
        b = base[a] + np.arange(len(a)) - (upto[a] - each[a] - (upto[i] - each[i]))
        wa, wb = w[a], w[b]
        out += np.bincount(wa * SKETCH + column[wb], x[a] * x[b] * sign[wb], len(out))
    return out


def _sketch(idf: np.ndarray, column: np.ndarray, sign: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(idf) * SKETCH)
        for batch in batches:
            for b in slices(batch, "ids", 1 << 20):
                ids, _, starts, doc = _halves(b, len(idf))
                if len(starts):
                    ids = np.where((ids >= 0) & (idf[ids] > 0), ids, -1)
                    passage, w, _ = _passages(ids, starts, doc, len(idf))
                    out += _pairs(passage, w, idf[w], column, sign)
        rows = out.reshape(len(idf), SKETCH).astype("<f4")
        at = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([rows[i].tobytes() for i in at], pa.binary())], ["id", "row"])

    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, x in zip(b.column("id").to_pylist(), b.column("row")):
            total[i] = total.get(i, 0) + np.frombuffer(x.as_buffer(), "<f4").astype(np.float64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.astype("<f4").tobytes() for x in total.values()], pa.binary())], ["id", "row"])


def latent_space(tokens: DataFrame, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(IDF, right singular vectors) of the TF-IDF passages over the block's words; common words have an IDF of 0, but for the rarest of each item's passage."""
    size = len(items.vocabulary)
    counts = np.zeros(size + 1)
    for r in tokens.select("ids").mapInArrow(_frequencies(size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # a row a benchmark word
        counts[r["id"]] = r["n"]
    idf = np.maximum(np.log((1 + counts[size]) / (1 + counts[:size])), 0.05)
    owner, where, w = items.passages()
    pair = np.unique(where * size + w)
    order = np.lexsort((pair % size, -idf[pair % size], pair // size))
    first = np.searchsorted(pair // size, np.arange(len(owner)))
    rarest = (pair % size)[order[np.arange(len(pair)) - first[pair // size] < KEPT]]
    common = counts[:size] > COMMON * counts[size]
    common[rarest] = False
    idf[common] = 0
    random = np.random.default_rng(7)
    column, sign = random.integers(0, SKETCH, size), random.choice([-1.0, 1.0], size)
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # few partial sums: a task adds up several splits before its rows (words x SKETCH at most) are shuffled by word
    partial = tokens.select("ids").coalesce(max(8, parts // 4)).mapInArrow(_sketch(idf, column, sign), "id long, row binary")
    gram = np.zeros((size, SKETCH))
    for r in partial.repartition("id").mapInArrow(_sum_rows, "id long, row binary").collect():  # a row a benchmark word
        gram[r["id"]] = np.frombuffer(r["row"], "<f4")
    pair = pair[idf[pair % size] > 0]
    # rows of the benchmark have one length each, so that short items are in the space as well
    x = idf[pair % size] / np.sqrt(np.bincount(pair // size, idf[pair % size] ** 2, len(owner)))[pair // size]
    own = _pairs(pair // size, pair % size, x, column, sign).reshape(size, SKETCH)
    signs = np.zeros((size, SKETCH))
    signs[np.arange(size), column] = sign
    mass = counts[:size] @ (idf * idf) / max(1, len(owner))
    gram += EMPHASIS * mass * own
    core = signs.T @ gram
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values[-1], 1e-300) * 1e-10
    u, _, _ = np.linalg.svd(gram @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return idf, u[:, :RANK]


def lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, one big integer step for each word of ``b``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        u = v & masks.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def contains(text: np.ndarray, run: np.ndarray) -> bool:
    n = len(run)
    return bool(n) and any(np.array_equal(text[i : i + n], run) for i in np.flatnonzero(text[: len(text) - n + 1] == run[0]))


def _search(items: Items, idf: np.ndarray, space: np.ndarray, cosine: float):
    weights = np.r_[space * idf[:, None], np.zeros((1, space.shape[1]))].astype(np.float32)  # id -1 is the last row: nothing
    square = np.r_[idf * idf, 0.0]
    owner, where, w = items.passages()
    pair = np.unique(where * len(idf) + w)
    bench, length = np.zeros((len(owner), space.shape[1]), np.float32), np.zeros(len(owner))
    np.add.at(bench, pair // len(idf), weights[pair % len(idf)])
    np.add.at(length, pair // len(idf), square[pair % len(idf)])
    bench /= np.sqrt(np.maximum(length, 1e-12))[:, None].astype(np.float32)
    weak = np.flatnonzero(np.einsum("ij,ij->i", bench, bench) < ENERGY)
    strong = np.setdiff1d(np.arange(len(owner)), weak)
    bench = bench[strong]
    # what each word brings to the weak passages that have it, by word
    nth = np.full(len(owner), -1)
    nth[weak] = np.arange(len(weak))
    pair = pair[(nth[pair // len(idf)] >= 0) & (square[pair % len(idf)] > 0)]
    pair = pair[np.argsort(pair % len(idf), kind="stable")]
    word, of = pair % len(idf), nth[pair // len(idf)]
    brings = square[word] / np.sqrt(length[weak])[of] if len(pair) else np.zeros(0)
    since = np.searchsorted(word, np.arange(len(idf) + 1))

    def near_whole(ids: np.ndarray, starts: np.ndarray, doc: np.ndarray, total: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(half passage, passage of the benchmark, cosine) of the weak passages, by whole vectors; a passage is two halves."""
        half = np.zeros(len(ids), np.int64)
        half[starts[1:]] = 1
        half = np.cumsum(half)
        known = ids >= 0
        pair = np.unique(half[known] * len(idf) + ids[known])
        h, w = pair // len(idf), pair % len(idf)
        n = since[w + 1] - since[w]
        h, w, n = h[n > 0], w[n > 0], n[n > 0]
        step = max(1, (1 << 21) // len(weak))
        for i in range(0, len(starts), step):
            a, b = np.searchsorted(h, (i, i + step + 1))  # the last passage's second half is the next one's first
            if a == b:
                continue
            m = n[a:b]
            at = np.repeat(since[w[a:b]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            dots = np.bincount(np.repeat(h[a:b] - i, m) * len(weak) + of[at], brings[at], (step + 1) * len(weak)).reshape(step + 1, len(weak))
            rows = np.arange(min(step, len(starts) - i))
            both = dots[rows]
            on = rows[(i + rows + 1 < len(doc)) & (doc[np.minimum(i + rows + 1, len(doc) - 1)] == doc[i + rows])]
            both[on] += dots[on + 1]
            both /= np.sqrt(np.maximum(total[i + rows], 1e-12))[:, None]
            for r, q in zip(*np.nonzero(both >= cosine)):
                yield i + int(r), int(weak[q]), float(both[r, q])

    def halves(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the space and squared length of every half passage, a word once."""
        half = np.zeros(len(ids), np.int64)
        half[starts[1:]] = 1
        half = np.cumsum(half)
        counts = (ids >= 0) & (square[ids] > 0)
        pair = np.unique(half[counts] * len(idf) + ids[counts])
        h, w = pair // len(idf), pair % len(idf)
        z = np.zeros((len(starts), weights.shape[1]), np.float32)
        if len(h):
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            z[h[first]] = np.add.reduceat(weights[w], first, axis=0)
        return z, np.bincount(h, square[w], len(starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int], tuple] = {}
            for b in slices(batch, "ids", 1 << 18):
                ids, off, starts, doc = _halves(b, len(idf))
                if not len(starts):
                    continue
                name = b.column("doc_id").to_pylist()
                z, length = halves(ids, starts)
                same = np.flatnonzero(doc[1:] == doc[:-1])
                both, total = z.copy(), length.copy()
                both[same] += z[same + 1]
                total[same] += length[same + 1]
                both /= np.sqrt(np.maximum(total, 1e-12))[:, None].astype(np.float32)
                near_enough = np.flatnonzero(np.einsum("ij,ij->i", both, both) >= cosine * cosine)  # else no cosine can reach it

                def near_in_space() -> Iterator[tuple[int, int, float]]:
                    for i in range(0, len(near_enough), 8192):
                        rows = near_enough[i : i + 8192]
                        near = both[rows] @ bench.T
                        for r, q in zip(*np.nonzero(near >= cosine)):
                            yield int(rows[r]), int(strong[q]), float(near[r, q])

                for p, q, near in chain(near_in_space(), near_whole(ids, starts, doc, total) if len(weak) else ()):
                    k, d = int(owner[q]), int(doc[p])
                    item = items.words[k]
                    key = (name[d], items.ids[k])
                    old = found.get(key)
                    if old and old[1] >= 1:
                        continue
                    m = len(item)
                    lo, hi = max(off[d], starts[p] - m), min(off[d + 1], starts[p] + 2 * HALF + m)
                    share = lcs(item, ids[lo:hi]) / m
                    if share < LCS_WITH_ANSWER or old and share <= old[1]:
                        continue
                    told = contains(ids[lo:hi], items.answers[k])
                    if share >= LCS or told:
                        found[key] = (near, share, told)
            if found:
                cols = [[k[0] for k in found], [k[1] for k in found], *zip(*found.values())]
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "item_id", "cosine", "lcs", "answer"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, items_at_once: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): documents that hold a benchmark item, at most a row a pair.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. ``lcs`` is the share of the
    item's words found in order near the passage; ``answer`` tells whether its last
    sentence is there. A pair is returned at LCS, or at LCS_WITH_ANSWER with the
    answer. Null or wordless texts and items match nothing; repeated rows give
    their pairs once; other columns are ignored. The benchmark is read in
    blocks of ``items_at_once`` items and ``PASSAGES`` passages, so it may be of any size.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    asked = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropDuplicates()
    n_words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    n, passages = asked.agg(F.count("*"), F.sum(F.greatest(F.lit(1), F.ceil((n_words - 2 * HALF) / HALF) + 1))).first()
    blocks = max(1, -(-n // items_at_once), -(-(passages or 0) // PASSAGES))
    out = spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs double, answer boolean")
    for k in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()  # about items_at_once rows
        rows = [(r["item_id"], r["text"]) for r in rows if len(word_hashes(pa.array([r["text"]]))[0])]
        if not rows:
            continue
        items = Items(rows)
        tokens = scratch.store(plain.mapInArrow(_to_ids(items.vocabulary), "doc_id long, ids binary"), "ids", "zstd")
        idf, space = latent_space(tokens, items)
        schema = "doc_id long, item_id long, cosine double, lcs double, answer boolean"
        found = scratch.store(tokens.mapInArrow(_search(items, idf, space, cosine), schema), "found")
        scratch.drop(tokens)
        out = out.union(found)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs", "cosine", "answer")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.cosine").alias("cosine"), F.col("m.lcs").alias("lcs"), F.col("m.answer").alias("answer"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all their columns. Rows with a null doc_id stay unless one of them leaks."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_leak")), "left_anti")
