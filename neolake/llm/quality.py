"""Quality classifier by importance resampling.

Two generative models of hashed word n-grams, one of the documents labelled good
and one of all documents, give each text the log of its likelihood ratio. A
sample of k rows without replacement, with probability by that ratio, takes the
k largest of the logs plus Gumbel noise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Scratch, mix64, name_hashes, slices, utf8, words

#: Hash buckets of unigrams and bigrams.
DIM = 10_000
SMOOTH = 1.0
#: The target model learns from at most about so many labelled rows.
LABELLED = 100_000
SEED = "gumbel"
#: Rows that are put in exact order at once.
EXACT = 20_000


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every unigram and bigram of the lower-cased words."""
    data, off = utf8(batch.column("text"))
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    s, e, row = words(data, off)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = name_hashes(data, s, e)
    two = mix64(h[:-1] * np.uint64(3) + h[1:] * np.uint64(0x9E3779B97F4A7C15))
    same = row[1:] == row[:-1]
    buckets = np.concatenate([h, two[same]]) % np.uint64(DIM)
    return buckets.astype(np.int64), np.concatenate([row, row[1:][same]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(DIM, np.int64), np.zeros(DIM, np.int64)
    for batch in batches:
        for b in slices(batch, "text"):
            bucket, row = _features(b)
            good = b.column("good").to_numpy(zero_copy_only=False).astype(bool)
            raw += np.bincount(bucket, minlength=DIM)
            target += np.bincount(bucket[good[row]], minlength=DIM)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> np.ndarray:
    """Log ratio of every bucket. The raw model counts all rows, the target model those of a bounded sample of good labels."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long")).distinct()
    n = good.count()
    if n > labelled:
        good = good.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < labelled * (1 << 20) // n)
    marked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # about ``labelled`` ids at most, by the sample above
    marked = marked.join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    rows = marked.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # DIM rows at most
    raw, target = np.zeros(DIM), np.zeros(DIM)
    for r in rows:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(DIM)
    logs = lambda c: np.log((c + SMOOTH) / (c.sum() + SMOOTH * DIM))
    return logs(target) - logs(raw)


def log_weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, log_weight): the log likelihood ratio of the whole text; 0 where there is no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text"):
                bucket, row = _features(b)
                w = np.bincount(row, ratio[bucket], minlength=b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(w)], ["doc_id", "log_weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, log_weight double")


def gumbel(seed: str = SEED) -> Column:
    """Standard Gumbel noise that depends on doc_id and the seed alone."""
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def nth_largest(keys: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, doc_id) of the k-th row by key descending, then doc_id ascending (null first); None if all rows are among the first k.

    The range that holds it is narrowed by counts of 1024 parts until it has at
    most EXACT rows; ties of one key are narrowed by doc_id. Nothing larger than
    a histogram or EXACT rows leaves the executors.
    """
    if k >= keys.count():
        return None
    rows = keys.select("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))
    for column, sign in (("key", -1.0), ("id", 1.0)):
        rows = rows.withColumn("by", F.col(column).cast("double") * sign)
        while True:
            lo, hi, n = rows.agg(F.min("by"), F.max("by"), F.count("*")).first()
            if n <= EXACT or lo == hi:
                break
            part = F.least(F.floor((F.col("by") - lo) / (hi - lo) * 1024), F.lit(1023)).alias("part")
            for r in rows.groupBy(part).count().orderBy("part").collect():
                if k <= r["count"]:
                    rows = rows.where(part == r["part"])
                    break
                k -= r["count"]
        if n <= EXACT:
            break
    found = rows.orderBy(F.desc("key"), "id").limit(min(k, EXACT)).collect()[-1]
    return found["key"], found["id"]


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: str = SEED) -> DataFrame:
    """(doc_id, log_weight, gumbel_key) of the sampled rows.

    k is ``share`` of the rows, by default the share of good ones among the
    labels (1 without labels). Texts that are null or empty have the weight 0.
    Rows that repeat a doc_id and text get equal keys: they are taken together.
    Without good labels all weights are 0 and the sample is uniform.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    if share is None:
        share = labels.where("quality is not null").agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    scored = log_weights(docs, fit(docs, labels)).withColumn("key", F.col("log_weight") + gumbel(seed))
    scored = scratch.store(scored, "keys")
    k = round(scored.count() * (1.0 if share is None else share))
    out = scored.select("doc_id", "log_weight", F.col("key").alias("gumbel_key"))
    if k <= 0:
        return out.limit(0)
    last = nth_largest(scored, k)
    if last is None:
        return out
    key, at = last
    return out.where((F.col("gumbel_key") > key) | ((F.col("gumbel_key") == key) & (F.coalesce("doc_id", F.lit(-(1 << 63))) <= at)))
