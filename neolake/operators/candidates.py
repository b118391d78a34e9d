"""Best candidates, top scores and orders.

A cascade of filters, each skipped if it would leave nothing, followed by the
first row of a sort, is one window: the filters' results sort first, true before
false, then the sort keys, then a tie-break that makes the order total.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neolake.functions.filters import col, preferred_transcript, truthy
from neolake.schemas import NONE, Thresholds
from neolake.storage import stored


def first_by(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def number(name: str) -> Column:
    return col(name).try_cast("double")


def _prefer(df: DataFrame, t: Thresholds, anchor: str | None, allow_incomplete: bool) -> list[Column]:
    tsl = "TSL" if "TSL" in df.columns else "Transcript Support Level"
    out = []
    if allow_incomplete and "Transcript CDS Flags" in df.columns:
        out.append(col("Transcript CDS Flags") == NONE)
    if "Biotype" in df.columns:
        out.append(col("Biotype") == "protein_coding")
    if {"MANE Select", "Canonical", tsl} <= set(df.columns):
        out.append(preferred_transcript(t.transcript_strategies, t.tsl, tsl=tsl))
    if "Problematic Positions" in df.columns:
        out.append(col("Problematic Positions") == NONE)
    if anchor:
        out.append(col(anchor))
    return [F.coalesce(c, F.lit(False)).desc() for c in out]


def best_order(df: DataFrame, t: Thresholds, score: str, tie: list[str], tool: str = "matched", anchor: str | None = None, allow_incomplete: bool = False) -> list[Column]:
    """The order whose first row is the best candidate: matched, splice, fusion or bind."""
    first = _prefer(df, t, anchor, allow_incomplete) if tool in ("matched", "splice") else _prefer(df.select(*[col(c) for c in df.columns if c == "Problematic Positions"]), t, None, False)
    out = [*first, number(score).asc_nulls_last()]
    tsl = "TSL" if "TSL" in df.columns else "Transcript Support Level"
    length = "WT Protein Length" if tool == "splice" else "Transcript Length"
    model = {
        "MANE Select": truthy(col("MANE Select")).desc(), "Canonical": truthy(col("Canonical")).desc(), tsl: F.coalesce(number(tsl), F.lit(6.0)).asc(), length: number(length).desc_nulls_last(), "Transcript Expression": number("Transcript Expression").desc_nulls_last(),
    }
    by = {"matched": model, "splice": model, "fusion": {"Expression": number("Expression").desc_nulls_last()}}.get(tool, {})
    return [*out, *[order for name, order in by.items() if name in df.columns], *[col(c).asc_nulls_last() for c in tie]]


def best_candidate(df: DataFrame, keys: list[str], t: Thresholds, score: str, tie: list[str], **how) -> DataFrame:
    """The best row for each key."""
    return first_by(df, keys, best_order(df, t, score, tie, **how))


def signature(keys: list[str], epitope: str) -> Column:
    """The sorted list of the epitopes of each key (a variant and transcript), repeats included, as one text; over a window."""
    listed = F.collect_list(col(epitope)).over(Window.partitionBy(*[col(k) for k in keys]))
    return F.array_join(F.array_sort(listed), "|")


def top_score(df: DataFrame, variant: list[str], transcript: str, epitope: str, t: Thresholds, score: str, tie: list[str], label: str | None = None, **how) -> DataFrame:
    """The best scored row of each variant; of matched and fusion tables, of each group of its transcripts with the same epitopes.

    ``label`` (``prefix.consequence``): the row comes again under every other prefix
    that the variant's rows have for its consequence. All windows run on rows that
    are partitioned by variant once.
    """
    own = df.where(number(score).isNotNull()).repartition(*[col(k) for k in variant])
    keys = list(variant)
    if how.get("tool", "matched") in ("matched", "fusion"):
        own, keys = own.withColumn("_signature", signature([*variant, transcript], epitope)), [*variant, "_signature"]
    if label is None:
        return best_candidate(own, keys, t, score, tie, **how).select(*[col(c) for c in df.columns])
    place = F.instr(col(label), ".")
    own = own.withColumn("_prefix", F.substring(col(label), F.lit(1), place - 1)).withColumn("_consequence", F.substring(col(label), place + 1, F.length(col(label))))
    own = own.withColumn("_prefixes", F.collect_set("_prefix").over(Window.partitionBy(*[col(k) for k in variant], "_consequence")))
    best = best_candidate(own, keys, t, score, tie, **how).withColumn("_prefix", F.explode("_prefixes"))
    return best.withColumn(label, F.concat_ws(".", "_prefix", "_consequence")).select(*[col(c) for c in df.columns])


def default_order(table: str = "matched", metric: str = "median") -> list[Column]:
    """Orders of matched, fusion or bind, and splice tables; ``metric``: median or lowest."""
    names = ("Median MT IC50 Score", "Best MT IC50 Score") if table == "matched" else ("Median IC50 Score", "Best IC50 Score")
    first, second = names if metric == "median" else names[::-1]
    up = lambda c: number(c).asc_nulls_last()
    if table == "matched":
        return [up(first), number("Corresponding Fold Change").desc_nulls_last(), up(second)]
    if table == "splice":
        return [up(first), up(second), col("Index")]
    return [up(first), number("Sub-peptide Position").asc_nulls_last(), up(second), col("Mutation")]


# The tools' tiers, best first.
TIER_ORDER = {
    "matched": ["Pass", "PoorBinder", "RefMatch", "PoorTranscript", "LowExpr", "Anchor", "Subclonal", "ProbPos", "Poor", "NoExpr"],
    "splice": ["Pass", "PoorBinder", "RefMatch", "PoorTranscript", "LowExpr", "Subclonal", "ProbPos", "Poor", "NoExpr"],
    "fusion": ["Pass", "PoorBinder", "RefMatch", "LowReadSupport", "LowExpr", "ProbPos", "Poor"],
    "bind": ["Pass", "PoorBinder", "RefMatch", "ProbPos", "Poor"],
}


def tier_place(tool: str, tier: str = "Tier") -> Column:
    """The tier's place in its tool's order, from 1; an unknown tier comes last."""
    names = TIER_ORDER[tool]
    at = F.array_position(F.array(*[F.lit(x) for x in names]), col(tier))
    return F.when(at > 0, at).otherwise(len(names) + 1)


def _by_ranges(df: DataFrame, order: list[Column], ranged: bool = False) -> DataFrame:
    """``df`` sorted by ranges and stored, with ``_part``, the range, and ``_at``, the place in it from 0."""
    ranged = (df if ranged else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), "ranks")
    low = (1 << 33) - 1  # an id is the partition and, in its lower 33 bits, the place
    return kept.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit(low))}).drop("_id")


def with_row_number(df: DataFrame, order: list[Column], name: str, ranged: bool = False) -> DataFrame:
    """``df`` with the place of each row in a total order, from 1, without a window over the whole table.

    Rows are sorted by ranges; a place is that in the range, plus the rows of the
    ranges before: one row a range. ``ranged``: ``df`` lies in ranges of the first
    columns of the order.
    """
    rows = _by_ranges(df, order, ranged)
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(sizes), "_part").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def with_dense_rank(df: DataFrame, value: Column, name: str, tie: list[Column], descending: bool = False) -> DataFrame:
    """``df`` with the dense rank of a number, nulls last, without a window over the whole table.

    Rows are sorted by ranges, ``tie`` splitting equal values, and ranked inside
    each range. The ranks of the ranges before are added, less one for each border
    that cuts through equal values: one row a range.
    """
    order = [F.col("_value").asc_nulls_last(), *tie]
    rows = _by_ranges(df.withColumn("_value", -value if descending else value), order)
    rows = rows.withColumn("_dense", F.dense_rank().over(Window.partitionBy("_part").orderBy(F.col("_value").asc_nulls_last())))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("_part").agg(F.max("_dense").alias("_n"), F.min_by(F.struct("_value"), "_at").alias("_first"), F.max_by(F.struct("_value"), "_at").alias("_last"))
    cut = F.coalesce(F.col("_first").eqNullSafe(F.lag("_last").over(Window.orderBy("_part"))), F.lit(False)).cast("int")
    ends = ends.withColumn("_cut", cut).select("_part", (F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.sum("_cut").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))).alias("_before"))
    return rows.join(F.broadcast(ends), "_part").withColumn(name, F.col("_before") + F.col("_dense")).drop("_part", "_at", "_value", "_dense", "_before")


def rank_sum_order(df: DataFrame, tool: str, score: str, expression: str | None, names: list[str], ties: str = "dense") -> DataFrame:
    """Rows with ``rank``, in order of tier, then the sum of the ranks by score and expression, then names.

    The ranks run over the whole report, by ranges. ``ties``: dense, or first (equal
    values in the order of names), as the viewer ranks the report that it shows.
    """
    tail = [col(c).asc_nulls_last() for c in names]
    if ties == "dense":
        rank = lambda d, value, down, name: with_dense_rank(d, value, name, tail, down)
    else:
        rank = lambda d, value, down, name: with_row_number(d, [value.desc_nulls_last() if down else value.asc_nulls_last(), *tail], name)
    out = rank(df, number(score), False, "rank")
    if expression:
        out = rank(out, number(expression), True, "_second").withColumn("rank", F.col("rank") + F.col("_second")).drop("_second")
    out = out.withColumn("_tier", tier_place(tool))
    return out.orderBy("_tier", "rank", *tail).drop("_tier")


def genomic_order(index: str = "ID") -> list[Column]:
    """Numeric chromosomes in order, the others last; then start and stop, from ids like ``chr1-100-101-A-T``."""
    part = lambda k: F.split_part(col(index), F.lit("-"), F.lit(k))
    return [F.coalesce(F.regexp_replace(part(1), "^chr", "").try_cast("double"), F.lit(float("inf"))), part(1), part(2).try_cast("long"), part(3).try_cast("long")]


def in_order_of(df: DataFrame, order: DataFrame, key: str) -> DataFrame:
    """Rows whose key another table lists, in that table's order (``row`` numbers it)."""
    return df.join(order.select(key, "row"), key).orderBy("row").drop("row")


def uniquified(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Repeats of a value get ``.1``, ``.2`` and so on in the rows' order, past names that an earlier row has; the first stays.

    A given ``x.1`` after the second ``x`` repeats that one's new name, and becomes
    ``x.1.1``. Values that differ by such endings only are numbered together, row
    after row; those without any such relative, nearly all, by a window. ``order``
    is a total order of the rows.
    """
    number = r"(\.[1-9][0-9]*)+$"
    rows = df.withColumn("_family", F.regexp_replace(col(column), number, ""))
    mixed = rows.where(col(column) != F.col("_family")).select("_family").distinct()
    plain = rows.join(mixed, "_family", "left_anti")
    k = F.row_number().over(Window.partitionBy("_family").orderBy(*[col(c) for c in order])) - 1
    plain = plain.withColumn("_k", k).withColumn(column, F.when(F.col("_k") == 0, col(column)).otherwise(F.concat_ws(".", col(column), F.col("_k").cast("string")))).select(*[col(c) for c in df.columns])

    def name(frame: pd.DataFrame) -> pd.DataFrame:
        seen, last = set(), {}
        for i, value in frame[column].items():
            given, n = value, last.get(value, 0)  # numbers up to the last given one are taken
            while value in seen:
                n += 1
                value = f"{given}.{n}"
            last[given] = n
            seen.add(value)
            frame.at[i, column] = value
        return frame

    related = rows.join(mixed, "_family", "left_semi").select("_family", *[col(c) for c in df.columns])
    named = related.groupBy("_family").applyInPandas(lambda f: name(f.sort_values(order, ignore_index=True)).drop(columns="_family"), df.schema)
    return plain.unionByName(named)
