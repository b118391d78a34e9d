"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are learned by follow-the-regularised-leader (proximal, elastic net) on a
bounded sample of labelled rows; document frequencies come from all of them. The
scores are softmax probabilities at a temperature fitted on rows left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import slices

#: Hashed n-gram buckets; n-grams of 1 to ORDERS characters.
DIM = 1 << 15
ORDERS = 3
#: The fit reads about so many rows of each language at most; every language that occurs is one to predict.
PER_LANGUAGE = 1500
UNKNOWN = "und"
#: A pipeline rejects documents below this probability.
REJECT = 0.3
#: L1 leaves about two thirds of the n-grams that occur without a weight.
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 0.05, 1e-4, 3

_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letter


def ngrams(text: str) -> np.ndarray:
    """Bucket of every n-gram of the lower-cased text, with runs of other characters as one space; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    known = _letters()[np.minimum(codes, 0x10FFFF)]
    if not known.any():
        return np.zeros(0, np.int64)
    codes = np.where(known, codes, 32)
    keep = known.copy()
    keep[1:] |= known[:-1]  # the first of a run of others
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
    out, h = [], np.zeros(len(codes), np.uint64)
    for n in range(ORDERS):
        h = h[: len(codes) - n] * np.uint64(0x100000001B3) + codes[n:] + np.uint64(1)
        out.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64))
    return np.concatenate(out)


def _vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and unit-length TF-IDF values of a text."""
    counts = np.bincount(ngrams(text), minlength=DIM)
    at = np.flatnonzero(counts)
    v = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(v @ v)
    return at, (v / norm if norm else v).astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages:
            return UNKNOWN, 0.0
        at, v = _vector(text, self.idf)
        if not len(at):
            return UNKNOWN, 0.0
        z = self.logits(at, v) / self.temperature
        k = int(np.argmax(z))
        return self.languages[k], float(1 / np.exp(z - z[k]).sum())


def _train(rows: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL over the first four fifths of the rows, the temperature over the rest."""
    split = max(1, len(rows) * 4 // 5)
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= L1, 0.0, -(own - np.sign(own) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for y, at, v in rows[:split]:
            at, v = np.append(at, DIM), np.append(v, 1.0)
            w = weights(at)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = v[:, None] * p
            g2 = g * g
            z[at] += g - (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g2
    w = weights(np.arange(DIM + 1)).astype(np.float32)
    held = rows[split:] or rows
    scores = np.array([v @ w[at] + w[DIM] for _, at, v in held])
    truth = np.array([y for y, _, _ in held])
    best, temperature = np.inf, 1.0
    for t in np.exp(np.linspace(np.log(0.05), np.log(20), 121)):
        s = scores / t
        top = s.max(axis=1)
        loss = float((np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[np.arange(len(s)), truth]).mean())
        if loss < best - 1e-12:
            best, temperature = loss, float(t)
    return w[:DIM], w[DIM], temperature


def held_out() -> F.Column:
    """Documents that nothing is learned from: CRC-32 of the id's digits is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from text and lang of the documents that aren't held out; rows of null lang or text are left out (an empty lang is a language)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), held_out().alias("_held"))
    rows = rows.where("not _held and doc_id is not null and text is not null and lang is not null").drop("_held")
    counts = rows.groupBy("lang").count().collect()  # a row a language
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return Model([], np.zeros(DIM), np.zeros((DIM, 0), np.float32), np.zeros(0), 1.0)
    total = sum(r["count"] for r in counts)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIM, np.int64)
        for batch in batches:
            for b in slices(batch, "text"):
                for x in b.column("text").to_pylist():
                    df += np.bincount(ngrams(x), minlength=DIM) > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["bucket", "n"])

    df = rows.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    idf = np.zeros(DIM)
    for r in df.collect():  # a row a bucket: DIM at most
        idf[r["bucket"]] = np.log((1 + total) / (1 + r["n"])) + 0.1

    of = {r["lang"]: min(1 << 20, -(-per_language * (1 << 20) // r["count"])) for r in counts}
    share = F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[F.col("lang")]
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("language")), F.lit(1 << 20))
    sample = rows.where(place < share).select("doc_id", "text", "lang").distinct().repartition(1)
    index = {x: i for i, x in enumerate(languages)}

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for i, x, y in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("lang").to_pylist()):
                at, v = _vector(x, idf)
                if len(at):
                    rows.append((i * 0x9E3779B97F4A7C15 % (1 << 64), i, y, x, (index[y], at.astype(np.int32), v)))
        rows.sort(key=lambda r: r[:4])  # one order, however the rows arrived
        if rows:
            w, b, t = _train([r[4] for r in rows], len(languages))
            yield pa.RecordBatch.from_arrays([pa.array([x.astype("<f4").tobytes() for x in (w, b)] + [np.array([t], "<f4").tobytes()], pa.binary())], ["x"])

    out = [r["x"] for r in sample.mapInArrow(train, "x binary").collect()]  # three rows
    if not out:
        return Model([], idf, np.zeros((DIM, 0), np.float32), np.zeros(0), 1.0)
    w, b, t = (np.frombuffer(x, "<f4") for x in out)
    return Model(languages, idf, w.reshape(DIM, len(languages)), b, float(t[0]))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row, from its whole text alone.

    ``und`` with score 0 where the text is null, empty or without letters, or where
    nothing could be learned. Repeated rows get equal results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                found = [model.predict(x) for x in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model | None = None, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` whose language is told with a probability of ``reject`` or more; all their columns."""
    model = model or fit(docs)
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                found = [model.predict(x) for x in b.column(at).to_pylist()]
                yield b.filter(pa.array([x != UNKNOWN and s >= reject for x, s in found]))

    return docs.mapInArrow(run, docs.schema)
