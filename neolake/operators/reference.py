"""Matches in a reference proteome, found by sampled seeds and extended letter by letter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from neolake.functions.sequences import matches_from_left
from neolake.shipping import ship

#: Letters that are hashed together in a task.
SLICE = 1 << 22
#: Seeds of the queries up to which the proteome's tasks get their hashes, 8 bytes each, and drop the others at once.
KNOWN = 1 << 20


def _minimisers(codes: np.ndarray, borders: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the seeds: of every k letters of one text the s with the least hash, the last of equal ones."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # hashes of s letters from those of their parts, in as many passes as s has bits
    one = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    base, h, size = 0xD6E8FEB86659FD93, one, 1
    for bit in f"{s:b}"[1:]:
        h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
        if bit == "1":
            h = h[:-1] * np.uint64(base) + one[size : size + len(h) - 1]
            size += 1
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    # the least of every k - s + 1 hashes, by doubling
    least, width = np.arange(len(h)), 1
    while width < k - s + 1:
        step = min(width, k - s + 1 - width)
        a, b = least[:-step], least[step:]
        least = np.where(h[b] <= h[a], b, a)
        width += step
    starts = np.arange(n)
    inside = np.searchsorted(borders, starts, side="right") == np.searchsorted(borders, starts + k - 1, side="right")
    places = np.unique(least[:n][inside])
    return places, h[places]


def seeds(df: DataFrame, k: int, known: DataFrame | None = None) -> DataFrame:
    """``df`` (with ``sequence``) exploded into its seeds: ``seed``, ``at`` from 1, and the letters ``before`` and ``after`` (the seed among them).

    Any k letters that two texts share hold a common seed, with all k letters in
    ``before`` and ``after``; about one place in four (k = 8) to nine (k = 40) is a
    seed. Texts of under k letters and null ones have none. Only seeds in
    ``known`` come out, if that is given; it is sent to the tasks if it's small.
    """
    s = max(1, k * 5 // 8)
    others = [f for f in df.schema.fields if f.name != "sequence"]
    spark = df.sparkSession
    ship(spark)
    few = None
    if known is not None:
        known = known.select("seed").distinct()
        found = known.limit(KNOWN + 1).collect()
        if len(found) <= KNOWN:
            few = spark.sparkContext.broadcast(np.array([r[0] for r in found], np.int64))

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in part.column("sequence").to_pylist()]
        joined = "".join(texts)
        ends = np.cumsum([len(x) for x in texts])
        places, hashes = _minimisers(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), ends, k, s)
        hashes = hashes.view(np.int64)
        if few is not None:
            keep = np.isin(hashes, few.value)
            places, hashes = places[keep], hashes[keep]
        rows = np.searchsorted(ends, places, side="right")
        first = ends[rows] - np.array([len(x) for x in texts], np.int64)[rows] if len(rows) else rows
        left = [joined[max(a, p - k + s) : p] for a, p in zip(first.tolist(), places.tolist(), strict=True)]
        right = [joined[p : min(b, p + k)] for b, p in zip(ends[rows].tolist(), places.tolist(), strict=True)]
        given = part.take(pa.array(rows, pa.int64()))
        arrays = [*[given.column(f.name) for f in others], pa.array(places - first + 1, pa.int32()), pa.array(hashes, pa.int64()), pa.array(left, pa.string()), pa.array(right, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, [*[f.name for f in others], "at", "seed", "before", "after"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("sequence")).fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + SLICE, side="right")))
                yield cut(batch.slice(start, stop - start))
                start = stop

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "at int", "seed long", "before string", "after string"])
    out = df.mapInArrow(each, schema)
    return out.join(known, "seed", "left_semi") if known is not None and few is None else out


def shared_runs(asked: DataFrame, there: DataFrame, k: int) -> DataFrame:
    """Pairs of seeds (``asked_`` and ``there_`` columns) whose surroundings share k letters: ``asked_start``, ``there_start``, ``kmers``.

    Both are extended letter by letter to either side of the seed; ``kmers`` is how
    many k-mers begin there, one after the other. Equality is that of the letters:
    hashes only bring seeds together.
    """
    a, b = (df.withColumnsRenamed({c: f"{side}_{c}" for c in df.columns if c != "seed"}) for df, side in ((asked, "asked"), (there, "there")))
    left = matches_from_left(F.reverse("asked_before"), F.reverse("there_before"))
    right = matches_from_left(F.col("asked_after"), F.col("there_after"))
    pairs = a.join(b, "seed").withColumn("_right", right).where(F.col("_right") > 0).withColumn("_left", left)
    pairs = pairs.withColumn("kmers", F.col("_left") + F.col("_right") - k + 1).where("kmers > 0")
    return pairs.withColumns({"asked_start": F.col("asked_at") - F.col("_left"), "there_start": F.col("there_at") - F.col("_left")})


def reference_hits(queries: DataFrame, proteome: DataFrame, k: int = 8) -> DataFrame:
    """(query, hit, definition, start, hit_start): k-mers of the queries found in proteins.

    ``queries``: query, sequence, transcript (its own, left out), wildtype (its own
    peptide, whose k-mers don't count); ``proteome``: id, description, sequence. Of
    a k-mer that a protein repeats, the first place. What is joined are seeds, a
    small share of all places, by their hashes; see ``seeds`` and ``shared_runs``.
    """
    asked = seeds(queries.select("query", "transcript", "wildtype", "sequence"), k)
    there = seeds(proteome.select(F.col("id").alias("hit"), F.col("description").alias("definition"), "sequence"), k, asked)
    runs = shared_runs(asked, there, k)
    bare = lambda c: F.split(F.col(c), r"\.")[0]
    named = F.regexp_extract("there_definition", r"transcript:([^\s.]+)", 1)
    own = (bare("there_hit") == bare("asked_transcript")) | (named == bare("asked_transcript"))
    runs = runs.where(~F.coalesce(own, F.lit(False)))
    around = F.concat("asked_before", "asked_after")
    first = F.length("asked_before") - F.col("_left")
    kmer = lambda i: F.substring(around, first + i + 1, F.lit(k))
    fresh = lambda i: ~F.coalesce(F.contains("asked_wildtype", kmer(i)), F.lit(False))
    each = runs.select("*", F.explode(F.filter(F.sequence(F.lit(0), F.col("kmers") - 1), fresh)).alias("_i"))
    rows = each.select(F.col("asked_query").alias("query"), F.col("there_hit").alias("hit"), F.col("there_definition").alias("definition"), (F.col("asked_start") + F.col("_i")).alias("start"), (F.col("there_start") + F.col("_i")).alias("hit_start"))
    return rows.groupBy("query", "hit", "definition", "start").agg(F.min("hit_start").alias("hit_start"))


def merged_windows(hits: DataFrame, k: int = 8) -> DataFrame:
    """(query, hit, definition, match_start, match_stop): runs of consecutive k-mers as one match; 1-based, stop exclusive."""
    order = Window.partitionBy("query", "hit").orderBy("start")
    once = hits.dropDuplicates(["query", "hit", "start"])
    islands = once.withColumn("_island", F.col("start") - F.row_number().over(order))
    out = islands.groupBy("query", "hit", "definition", "_island").agg(F.min("start").alias("match_start"), (F.max("start") + k).alias("match_stop"))
    return out.drop("_island")


def grouped_matches(matches: DataFrame, queries: DataFrame) -> DataFrame:
    """For each matched part of a query: hits, genes and transcripts that have it."""
    seq = queries.select("query", "sequence")
    part = F.expr("substring(sequence, cast(match_start as int), cast(match_stop - match_start as int))")
    named = lambda key: F.nullif(F.regexp_extract("definition", rf"{key}:(\S+)", 1), F.lit(""))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    rows = matches.join(seq, "query").withColumn("match_sequence", part)
    return rows.groupBy("query", "match_sequence").agg(joined("hit").alias("hits"), joined(named("gene_symbol")).alias("genes"), joined(named("transcript")).alias("transcripts"))


def with_reference_match(report: DataFrame, matches: DataFrame, key: str = "ID") -> DataFrame:
    """``Ref Match``: the row's key has a match."""
    hit = matches.select(F.col("query").alias(key)).distinct().withColumn("_hit", F.lit(True))
    return report.join(hit, key, "left").withColumn("Ref Match", F.coalesce("_hit", F.lit(False))).drop("_hit")


def query_window(sequence, epitope_start, epitope_length: int, k: int = 8):  # noqa: ANN001, ANN201
    """The part of a protein whose k-mers can overlap the epitope, clamped at either end."""
    start = F.greatest(epitope_start - (k - 1), F.lit(1))
    stop = F.least(epitope_start + epitope_length - 1 + (k - 1), F.length(sequence))
    return sequence.substr(start.cast("int"), (stop - start + 1).cast("int"))
