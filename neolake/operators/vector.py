"""Ordering peptides in one construct: junctions, their scores, and the best path."""

from __future__ import annotations

import itertools
import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neolake.functions.sequences import back_translated, kmers


def ordered_pairs(peptides: DataFrame) -> DataFrame:
    """(left, right, left_seq, right_seq) of every two different peptides of one construct (tens of peptides)."""
    a, b = peptides.toDF("left", "left_seq"), peptides.toDF("right", "right_seq")
    return a.join(b, F.col("left") != F.col("right"))


def junction_sequences(pairs: DataFrame, spacers: list[str], clips: int, flank: int, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """A junction for each pair, spacer and number of residues clipped on either side; ``None`` is no spacer. ``keys``: columns that stay."""
    grid = F.array(*[F.struct(F.lit(s).alias("spacer"), F.lit(i).alias("left_clip"), F.lit(j).alias("right_clip")) for s in spacers for i in range(clips + 1) for j in range(clips + 1)])
    rows = pairs.withColumn("g", F.explode(grid)).select(*keys, "left", "right", "left_seq", "right_seq", "g.*")
    left = F.expr("right(substring(left_seq, 1, length(left_seq) - left_clip), {0})".format(flank))
    right = F.expr("substring(right_seq, right_clip + 1, {0})".format(flank))
    return rows.withColumn("sequence", F.concat(left, F.when(F.col("spacer") == "None", "").otherwise(F.col("spacer")), right))


def junction_epitopes(junctions: DataFrame, k: int) -> DataFrame:
    return junctions.withColumn("_k", F.explode(kmers(F.col("sequence"), k))).withColumn("epitope", F.col("_k.kmer")).drop("_k")


def junction_scores(scored: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """Least score and percentile of each junction none of whose epitopes binds."""
    return scored.groupBy(*keys).agg(F.bool_or(F.col("score") < threshold).alias("bad"), F.min("score").alias("weight"), F.min("percentile").alias("percentile")).where("not bad").drop("bad")


def edges(junctions: DataFrame, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """For each ordered pair the junction of greatest weight; least clipping, then spacer, then least clipped on the left, of equal ones."""
    order = F.struct("weight", (-(F.col("left_clip") + F.col("right_clip"))).alias("c"), F.col("spacer"), (-F.col("left_clip")).alias("l"))
    cols = ["weight", "percentile", "spacer", "left_clip", "right_clip"]
    return junctions.groupBy(*keys, "left", "right").agg(F.max_by(F.struct(*cols), order).alias("j")).select(*keys, "left", "right", "j.*")


def best_order(nodes: list[str], weight: dict[tuple[str, str], float], exact_up_to: int = 12, seed: int = 0, steps: int = 20_000) -> list[str] | None:
    """The path over all nodes with the greatest sum of weights; None if there is none.

    A construct has tens of peptides: exact dynamic programming up to
    ``exact_up_to``, annealing beyond.
    """
    nodes = sorted(nodes)
    n = len(nodes)
    if n <= exact_up_to:
        best: dict[tuple[int, int], tuple[float, tuple[int, ...]]] = {(1 << i, i): (0.0, (i,)) for i in range(n)}
        for mask in range(1, 1 << n):
            for i in range(n):
                state = best.get((mask, i))
                if state is None:
                    continue
                for j in range(n):
                    w = weight.get((nodes[i], nodes[j]))
                    if mask >> j & 1 or w is None:
                        continue
                    new = (state[0] + w, state[1] + (j,))
                    old = best.get((mask | 1 << j, j))
                    if old is None or new[0] > old[0]:
                        best[mask | 1 << j, j] = new
        ends = [v for (m, _), v in best.items() if m == (1 << n) - 1]
        return [nodes[i] for i in max(ends, key=lambda v: v[0])[1]] if ends else None
    r = random.Random(seed)
    missing = -1e6
    known = {e: weight.get(e, missing) for e in itertools.product(nodes, nodes)}
    value = lambda p: sum(map(known.__getitem__, itertools.pairwise(p)))
    path = nodes[:]
    r.shuffle(path)
    now, top = value(path), (value(path), path[:])
    spread = max(1.0, max(weight.values(), default=1.0))
    for k in range(steps):
        i, j = sorted(r.sample(range(n), 2))
        new = path[:i] + path[i : j + 1][::-1] + path[j + 1 :]
        if r.random() < 0.5:
            new[i], new[j] = path[j], path[i]
        v = value(new)
        if v >= now or r.random() < math.exp((v - now) / (spread * (1 - k / steps) + 1e-9)):
            path, now = new, v
            if now > top[0]:
                top = (now, path[:])
    return top[1] if top[0] > missing / 2 else None


def construct_dna(df: DataFrame, sequence: str = "sequence") -> DataFrame:
    return df.withColumn("dna", back_translated(F.col(sequence)))
