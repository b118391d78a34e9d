"""Mixing sources to target weights, by weighted fair queueing over DataFrames.

Every document of a source gets a place in the source's shuffled order. Its
virtual finish time is the source's tokens up to its end divided by the source's
target; a source that wants more than it has goes round again, with the times of
its next round. The rows are range-sorted by that time and cut where their sizes
reach the budget. The sort is a two-level one: sums by range of time, a running
sum over those, then exact order inside the one range that the budget cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch, small_join

#: What counts as a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one source that are put in order together.
ROWS = 2048
#: Ranges of virtual time at most.
RANGES = 1 << 17
#: No document is taken more often.
ROUNDS = 3


def source_targets(sources: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(source, n, source_size, weight, target) of (source, n, source_size), one row a source.

    Weights are 1, 2, 3, 1, 2, ... by code point of the source, null last. All
    sizes together are shared by weight; a target stops at ``rounds`` times the
    source's size and the excess is shared again. With sources by rising limit
    per weight that is: the first ones stop, the others get ``level`` times their
    weight, where ``level`` is the first that doesn't exceed the next limit.
    """
    # One row a source: the two windows below see as many rows as there are sources.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    w = w.withColumn("limit", F.col("source_size") * rounds).withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("before", F.coalesce(F.sum("limit").over(upto), F.lit(0)))
    w = w.withColumn("rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    w = w.withColumn("level", (F.sum("source_size").over(whole) - F.col("before")) / F.col("rest"))
    w = w.withColumn("open", F.col("level") <= F.col("ratio"))
    w = w.withColumn("level", F.min(F.when(F.col("open"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(whole)["level"])
    target = F.when(F.col("ratio") < F.col("level"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return w.select("source", "n", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, seed: str = "mix", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row for every row of ``docs``.

    ``docs`` has doc_id, text and source. size: words of the text, null or empty: 0.
    taken: words that the mix takes of this row, a whole number of times its size
    from 0 to ``rounds``. Order within a source is by MD5 of seed and doc_id, then
    doc_id, then size; equal rows are interchangeable. A null source is a source
    of its own. Other columns are ignored, whatever their names.
    An empty table, or one without words, takes nothing.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    key = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).cast("binary"))
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), key.alias("order"))
    sized = scratch.store(sized, "sized")
    n = sized.count()
    sources = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    targets = scratch.store(source_targets(sources, rounds).withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))).drop("source"), "targets")

    # A place in the source's order: part by the leading bits of the key, running sum inside the part.
    rows = small_join(sized.withColumn("name", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), targets, ["name"])
    lead = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("part", F.floor(lead * F.ceil(F.col("n") / ROWS) / (1 << 32)).cast("long"))
    sums = rows.groupBy("name", "part").agg(F.sum("size").alias("in_part"))
    # running sums in two levels: by group of ROWS parts, then inside each group
    sums = sums.withColumn("group", F.floor(F.col("part") / ROWS))
    ahead = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    groups = sums.groupBy("name", "group").agg(F.sum("in_part").alias("in_group"))
    groups = groups.select("name", "group", F.coalesce(F.sum("in_group").over(ahead("name", "group")), F.lit(0)).alias("before_group"))
    sums = sums.withColumn("inside", F.coalesce(F.sum("in_part").over(ahead("name", "group", "part")), F.lit(0)))
    sums = sums.join(groups, ["name", "group"]).select("name", "part", (F.col("before_group") + F.col("inside")).alias("before"))
    place = Window.partitionBy("name", "part").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(sums, ["name", "part"]).withColumn("upto", F.col("before") + F.sum("size").over(place))
    rows = scratch.store(rows.select("doc_id", "source", "size", "order", "source_size", "target", "upto"), "placed")

    # Virtual finish times of all rounds; the budget is the sum of all sizes.
    rounds_of = F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round")
    finish = (F.col("round") * F.col("source_size") + F.col("upto")) / F.col("target")
    times = rows.where("size > 0 and target > 0").select("*", rounds_of).withColumn("finish", finish)
    # a source stops with the document that crosses its target; those after it never count
    times = times.where((F.col("finish") - F.col("size") / F.col("target")) <= 1)
    ranges = max(1, min(RANGES, -(-n // ROWS)))
    times = times.withColumn("range", F.least(F.floor(F.col("finish") * ranges), F.lit(2 * ranges)).cast("long"))
    budget = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"))
    per_range = times.groupBy("range").agg(F.sum("size").alias("in_range"))
    run = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    cut = per_range.withColumn("upto_range", F.sum("in_range").over(run)).join(F.broadcast(budget)).where("upto_range > budget")
    cut = cut.agg(F.min(F.struct("range", (F.col("upto_range") - F.col("in_range")).alias("before_range"), "budget")).alias("c")).select("c.*")
    order = Window.partitionBy("range").orderBy("finish", F.col("source").asc_nulls_last(), "order", "doc_id", "size", "round").rowsBetween(Window.unboundedPreceding, 0)
    last = times.join(F.broadcast(cut), "range").withColumn("total", F.col("before_range") + F.sum("size").over(order)).where("total > budget")
    tie = F.struct("finish", F.col("source").isNull(), F.coalesce("source", F.lit("")), "order", "doc_id", "size", "round")
    last = scratch.store(last.agg(F.min(tie).alias("stop")), "stop")  # one row: the first that is not taken, or null
    scratch.keep(rows, last)

    def taken(k: int) -> F.Column:
        at = (k * F.col("source_size") + F.col("upto")) / F.col("target")
        mine = F.struct(at, F.col("source").isNull(), F.coalesce("source", F.lit("")), "order", "doc_id", "size", F.lit(k))
        within = (at - F.col("size") / F.col("target")) <= 1
        return F.when((F.col("size") > 0) & (F.col("target") > 0) & within & (F.col("stop").isNull() | (mine < F.col("stop"))), 1).otherwise(0)

    times_taken = sum((taken(k) for k in range(1, rounds)), taken(0))
    mixed = rows.join(F.broadcast(last)).withColumn("taken", (F.col("size") * times_taken).cast("long"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def mix_documents(docs: DataFrame, seed: str = "mix", rounds: int = ROUNDS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them (0 to ``rounds`` times).

    A document without words is in no mix. Repeated doc_ids share their rows' takings in order of size.
    Rows with a null doc_id share those of their source and size, one row each; which gets which is by text.
    """
    named = mix(docs, seed, rounds).where("taken > 0").select("doc_id", "source", F.col("size").alias("_size"), (F.col("taken") / F.col("size")).cast("int").alias("_times"))
    named = Scratch(docs.sparkSession, "mixed").store(named, "taken")
    times = named.groupBy("doc_id", "_size").agg(F.max("_times").alias("_times"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.withColumn("_size", size)
    out = sized.join(times, ["doc_id", "_size"])
    if not named.where("doc_id is null").isEmpty():
        nth = lambda *o: F.row_number().over(Window.partitionBy("_source", "_size").orderBy(*o))
        source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
        nameless = named.where("doc_id is null").select(source.alias("_source"), "_size", "_times").withColumn("_nth", nth(F.desc("_times")))
        rows = sized.where("doc_id is null").withColumn("_source", source).withColumn("_nth", nth("text"))
        out = out.unionByName(rows.join(nameless, ["_source", "_size", "_nth"]).drop("_source", "_nth"))
    return out.withColumn("_round", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || CAST(doc_id AS VARCHAR)) AS k
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM src),
r AS (SELECT *, (3 * source_size)::DOUBLE / weight AS ratio FROM w),
lv AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS lvl FROM r),
lev AS (SELECT lvl AS level FROM lv WHERE lvl <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
tg AS (SELECT source, source_size, CASE WHEN ratio < level THEN (3 * source_size)::DOUBLE ELSE weight * level END AS target FROM r, lev),
pl AS (SELECT s.doc_id, s.source, s.size, s.k, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
       FROM sized s JOIN tg t ON s.source IS NOT DISTINCT FROM t.source),
it AS (SELECT pl.*, e.round, ((e.round * source_size + upto)::DOUBLE / target) AS finish
       FROM pl, (VALUES (0), (1), (2)) e(round) WHERE size > 0 AND target > 0),
nr AS (SELECT * FROM it WHERE finish - size / target <= 1),
run AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, k, doc_id, size, round ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM nr),
tk AS (SELECT doc_id, source, sum(size) AS taken FROM run WHERE total <= (SELECT sum(size) FROM sized) GROUP BY doc_id, source)
SELECT pl.doc_id, pl.size, pl.source_size, pl.target, coalesce(tk.taken, 0)::BIGINT AS taken
FROM pl LEFT JOIN tk ON pl.doc_id = tk.doc_id AND pl.source IS NOT DISTINCT FROM tk.source
"""
