"""Ordering the peptides of many constructs at once: junctions in rounds, then a path for each construct."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.sequences import places
from neolake.operators import vector
from neolake.shipping import ship
from neolake.storage import spread, stored

#: Of a construct's junctions: the pair by its places times the kinds (spacer and clipping) there are, plus the kind.
EDGES = "array<struct<code:bigint,weight:double,percentile:double>>"
#: A scorer adds ``score`` and ``percentile`` to rows with ``epitope``.
Scorer = Callable[[DataFrame], DataFrame]
#: Cells of the tables of paths that are filled side by side.
CELLS = 1 << 19
#: Constructs that a task takes at most: a round's tables grow with them.
SHARE = 50_000


def edges_of_round(dealt: DataFrame, scorer: Scorer, spacer: str, clipped: dict[int, tuple[int, int]], kinds: int, flank: int, k: int, threshold: float) -> DataFrame:
    """(construct, _new): the junctions, none of which holds a binder, of the pairs without one: with one spacer, and as many residues clipped as ``clipped`` says for each kind.

    All groups are inside a construct: rows dealt by it aren't shuffled again. A
    junction is a number in its construct, so that its epitopes meet by plain keys.
    """
    n = F.size("peptides").cast("long")
    div = lambda x, y: F.call_function("div", x, y)
    at = lambda place: F.get("peptides", place.cast("int"))
    others = lambda a, i: F.transform(F.filter(F.sequence(F.lit(0).cast("long"), n - 1), lambda b: at(b)["id"] != a["id"]), lambda b: i * n + b)
    open_ = F.array_except(F.flatten(F.transform("peptides", others)), F.transform("edges", lambda e: div(e["code"], F.lit(kinds))))
    codes = F.flatten(F.transform(open_, lambda p: F.array(*[p * kinds + kind for kind in clipped])))
    # only numbers unfold; texts are cut by generated code after that
    each = dealt.select("construct", "peptides", F.explode(codes).alias("code"))
    pair = div(F.col("code"), F.lit(kinds))
    left, right = at(div(pair, n))["sequence"], at(pair % n)["sequence"]
    off, on = (F.get(F.array(*[F.lit(x[side]) for x in clipped.values()]), (F.col("code") % kinds - min(clipped)).cast("int")) for side in (0, 1))
    text = F.concat(F.right(F.substr(left, F.lit(1), F.length(left) - off), F.lit(flank)), F.lit("" if spacer == "None" else spacer), F.substr(right, on + 1, F.lit(flank)))
    cut = each.select("construct", "code", text.alias("sequence")).select("construct", "code", "sequence", F.explode(places(F.length("sequence"), k - 1)).alias("i"))
    rows = cut.select("construct", "code", F.substr("sequence", "i", F.lit(k)).alias("epitope"))
    best = vector.junction_scores(scorer(rows), ["construct", "code"], threshold)
    return best.groupBy("construct").agg(F.collect_list(F.struct("code", F.col("weight").cast("double").alias("weight"), F.col("percentile").cast("double").alias("percentile"))).alias("_new"))


def _paths(weight: np.ndarray) -> np.ndarray:
    """The places in order of the best path through each table of weights[row, from, to], -inf for no edge; -1 where there is none.

    ``vector.best_order``'s choices among equal paths, for all rows of one size together.
    """
    rows, n, _ = weight.shape
    weight = np.ascontiguousarray(weight.transpose(1, 2, 0))  # rows side by side
    best = np.full((n, 1 << n, rows), -np.inf)
    before = np.zeros((n, 1 << n, rows), np.int8)
    for i in range(n):
        best[i, 1 << i] = 0.0
    masks = np.arange(1 << n)
    inside = masks[:, None] >> np.arange(n) & 1
    for size in range(1, n):
        for j in range(n):
            free = masks[(inside.sum(axis=1) == size) & (inside[:, j] == 0)]
            now, at = np.full((len(free), rows), -np.inf), np.zeros((len(free), rows), np.int8)
            for i in range(n):
                if i != j:
                    sums = best[i, free] + weight[i, j]
                    more = sums > now  # the first of equal ones stays
                    np.copyto(now, sums, where=more)
                    np.copyto(at, np.int8(i), where=more)
            best[j, free | 1 << j], before[j, free | 1 << j] = now, at
    each, mask = np.arange(rows), np.full(rows, (1 << n) - 1)
    last = n - 1 - best[::-1, -1].argmax(axis=0)
    none = ~np.isfinite(best[last, -1, each])
    out = np.empty((rows, n), np.int64)
    for step in range(n - 1, -1, -1):
        out[:, step] = last
        last, mask = before[last, mask, each].astype(np.int64), mask & ~(1 << last)
    out[none] = -1
    return out


def _may_have_path(weight: np.ndarray) -> bool:
    """At most one place has nothing after it, at most one nothing before it, none neither."""
    out, into = np.isfinite(weight).any(axis=1), np.isfinite(weight).any(axis=0)
    return (~out).sum() <= 1 and (~into).sum() <= 1 and not (~out & ~into).any()


def _annealed(weight: np.ndarray, seed: int) -> np.ndarray:
    """The places in the order that ``vector.best_order`` finds by annealing; -1 where it finds none."""
    n = len(weight)
    found = vector.best_order(list(range(n)), {(a, b): float(weight[a, b]) for a, b in np.argwhere(np.isfinite(weight)).tolist()}, 0, seed) if _may_have_path(weight) else None
    return np.array(found or [-1] * n, np.int64)


def _picked(sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray, weights: np.ndarray, kinds: int, exact_up_to: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of so many peptides and so many edges (their codes and weights, one row's after the other's): (found, picks), the edges of each best path by their places in the row, n - 1 for each row found.

    Of a pair's edges the one of greatest weight counts, of equal ones that of the
    least kind. Rows of one size are solved together.
    """
    row, pair = np.repeat(np.arange(len(sizes)), lengths), codes // kinds
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.lexsort((codes, -weights, pair, row))
    keep = order[np.append(True, (np.diff(row[order]) != 0) | (np.diff(pair[order]) != 0))[: len(order)]]
    found, parts = np.zeros(len(sizes), bool), {}
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        own = keep[sizes[row[keep]] == n]
        to = np.searchsorted(at, row[own])
        take = max(1, CELLS // (n << n if n <= exact_up_to else n * n))
        for low in range(0, len(at), take):
            rows = at[low : low + take]
            here = slice(*np.searchsorted(to, [low, low + take]))
            cells = to[here] - low, pair[own[here]]
            table, edge = np.full((len(rows), n * n), -np.inf), np.zeros((len(rows), n * n), np.int32)
            table[cells], edge[cells] = weights[own[here]], place[own[here]]
            tables = table.reshape(-1, n, n)
            places = _paths(tables) if n <= exact_up_to else np.stack([_annealed(t, seed) for t in tables])
            found[rows] = places[:, 0] >= 0
            parts[rows[0], n] = rows, np.take_along_axis(edge, np.maximum(places[:, :-1] * n + places[:, 1:], 0), axis=1)
    ends = np.cumsum(np.where(found, sizes - 1, 0))
    picks = np.empty(ends[-1] if len(ends) else 0, np.int32)
    for rows, edges in parts.values():
        has = found[rows]
        picks[(ends[rows[has]] - edges.shape[1])[:, None] + np.arange(edges.shape[1])] = edges[has]
    return found, picks


def with_paths(df: DataFrame, size: Column, edges: Column, kinds: int = 1, exact_up_to: int = 12, seed: int = 0) -> DataFrame:
    """``df`` with ``picks``: the places of those of its ``edges`` (code, weight) that make the path over all ``size`` peptides with the greatest sum of weights, null if there is none.

    Exact up to ``exact_up_to`` peptides, annealed beyond.
    """

    @F.arrow_udf("array<int>")
    def picks(sizes: pa.Array, codes: pa.Array, weights: pa.Array) -> pa.Array:
        number = lambda x, t: x.to_numpy(zero_copy_only=False).astype(t)
        sizes = number(sizes, np.int64)
        found, values = _picked(sizes, number(codes.value_lengths(), np.int64), number(codes.flatten(), np.int64), number(weights.flatten(), float), kinds, exact_up_to, seed)
        offsets = np.append(0, np.cumsum(np.where(found, sizes - 1, 0)))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), mask=pa.array(~found))

    return df.withColumn("picks", picks(size, edges["code"], edges["weight"]))


def order_of(n: Column, path: Column, kinds: int = 1) -> Column:
    """The places on a path of edges (code), in order; a construct of one peptide has none and is that peptide."""
    pair = lambda e: F.call_function("div", e["code"], F.lit(kinds))
    first = F.coalesce(F.call_function("div", pair(F.get(path, F.lit(0))), n), F.lit(0).cast("long"))
    return F.transform(F.concat(F.array(first), F.transform(path, lambda e: pair(e) % n)), lambda p: p.cast("int"))


def best_paths(peptides: DataFrame, edges: DataFrame, exact_up_to: int = 12, seed: int = 0) -> DataFrame:
    """(construct, order): the path over all peptides of a construct with the greatest sum of weights, for those that have one."""
    ship(peptides.sparkSession)
    ids = peptides.groupBy("construct").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    found = edges.groupBy("construct").agg(F.collect_list(F.struct("left", "right", "weight")).alias("edges"))
    n = F.size("ids").cast("long")
    known = F.filter("edges", lambda e: F.array_contains("ids", e["left"]) & F.array_contains("ids", e["right"]))
    codes = F.transform(known, lambda e: F.struct(((F.array_position("ids", e["left"]) - 1) * n + F.array_position("ids", e["right"]) - 1).alias("code"), e["weight"].cast("double").alias("weight")))
    both = ids.join(found, "construct", "left").withColumn("edges", F.coalesce(codes, F.array().cast("array<struct<code:bigint,weight:double>>")))
    paths = with_paths(both, F.size("ids"), F.col("edges"), 1, exact_up_to, seed).where("picks is not null")
    order = order_of(n, F.transform("picks", lambda i: F.get("edges", i)))
    return stored(paths.select("construct", F.transform(order, lambda p: F.get("ids", p)).alias("order")), "orders")


def design(peptides: DataFrame, scorer: Scorer, spacers: list[str], flank: int, k: int, threshold: float, clips: int = 2) -> DataFrame:
    """(construct, order, junctions, sequence) of every construct of (construct, id, sequence); null where no order exists.

    All constructs take a round together: the spacers in turn, then with more
    residues clipped, one side at least by just that many, on the pairs without a
    junction of the constructs without an order. A construct is one row with its
    peptides and junctions; a round deals the open ones out once, and all its steps
    stay there. What a round makes of them is stored, of those with an order only the
    junctions in it; the driver sees only how many constructs are left. A construct of
    one peptide is that peptide.
    """
    ship(peptides.sparkSession)
    rounds = [(spacer, [(i, j) for i in range(clip + 1) for j in range(clip + 1) if max(i, j) == clip]) for clip in range(clips + 1) for spacer in spacers]
    # of equal junctions of a round the first counts: least clipping, then on the left
    kinds = [(spacer, i, j) for spacer, clipped in rounds for i, j in sorted(clipped, key=lambda x: (sum(x), x[0]))]
    peptide = F.struct(F.col("id").cast("string").alias("id"), F.col("sequence").alias("sequence"))
    open_ = peptides.groupBy("construct").agg(F.array_sort(F.collect_list(peptide)).alias("peptides"))
    open_ = stored(open_.withColumn("edges", F.array().cast(EDGES)), "peptides")
    done, kind = None, 0
    for spacer, clipped in rounds:
        if not (rows := open_.count()):
            break
        own = {kind + x: kinds[kind + x][1:] for x in range(len(clipped))}
        kind += len(clipped)
        dealt = spread(open_, "construct", parts=-(-rows // SHARE))
        new = edges_of_round(dealt, scorer, spacer, own, len(kinds), flank, k, threshold)
        joined = dealt.join(new, "construct", "left").select("construct", "peptides", F.concat("edges", F.coalesce("_new", F.array().cast(EDGES))).alias("edges"))
        paths = with_paths(joined, F.size("peptides"), F.col("edges"), len(kinds))
        path = F.transform("picks", lambda i: F.get("edges", i))
        state = stored(paths.select("construct", "peptides", F.when(F.col("picks").isNull(), F.col("edges")).otherwise(path).alias("edges"), F.col("picks").isNotNull().alias("done")), "orders")
        found, open_ = state.where("done"), state.where("not done").drop("done")
        done = found if done is None else done.unionByName(found)
    left = open_.withColumn("done", F.lit(False))
    return assembled(left if done is None else done.unionByName(left), kinds)


def assembled(constructs: DataFrame, kinds: list[tuple[str, int, int]]) -> DataFrame:
    """Each construct of (construct, peptides, edges, done: whether these are its path) with its order, the junctions in it, and its sequence: peptides with what the junctions clip and put between."""
    n = F.size("peptides").cast("long")
    table = F.array(*[F.struct(F.lit(s).alias("spacer"), F.lit(i).alias("left_clip"), F.lit(j).alias("right_clip")) for s, i, j in kinds])
    at = lambda place: F.get("peptides", place)
    order = F.when(F.col("done"), order_of(n, F.col("edges"), len(kinds)))
    steps = constructs.select("construct", "peptides", order.alias("places"), F.when(F.col("done"), F.col("edges")).alias("path"))

    def junction(e: Column, i: Column) -> Column:
        kind = F.get(table, (e["code"] % len(kinds)).cast("int"))
        ids = [at(F.get("places", i + x))["id"].alias(side) for x, side in enumerate(("left", "right"))]
        return F.struct(*ids, e["weight"].alias("weight"), e["percentile"].alias("percentile"), *[kind[c].alias(c) for c in ("spacer", "left_clip", "right_clip")])

    rows = steps.select("construct", "peptides", "places", F.transform("path", junction).alias("junctions"))
    nexts = F.transform("junctions", lambda j, i: F.struct(j.alias("j"), at(F.get("places", i + 1))["sequence"].alias("sequence")))

    def add(done: Column, x: Column) -> Column:
        between = F.when(x["j"]["spacer"] == "None", "").otherwise(x["j"]["spacer"])
        return F.concat(F.left(done, F.length(done) - x["j"]["left_clip"]), between, F.substr(x["sequence"], x["j"]["right_clip"] + 1, F.length(x["sequence"])))

    text = F.aggregate(nexts, at(F.get("places", F.lit(0)))["sequence"], add)
    return rows.select("construct", F.transform("places", lambda p: at(p)["id"]).alias("order"), "junctions", text.alias("sequence"))
