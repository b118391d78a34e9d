"""Differences of nested documents, whatever the order of their fields and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neolake.functions.sequences import letters
from neolake.storage import stored


def _depth(docs: DataFrame) -> int:
    """How many objects and lists lie in each other at most in the JSON texts of ``text``."""
    bare = F.regexp_replace(F.regexp_replace("text", r"\\.", ""), '"[^"]*"', "")
    shapes = docs.select(F.regexp_replace(bare, r"[^\[\]{}]+", "").alias("shape")).distinct()  # few documents have a shape of their own
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("most"))

    def step(state: Column, sign: Column) -> Column:
        at = state["at"] + F.when(sign.isin("{", "["), 1).otherwise(-1)
        return F.struct(at.alias("at"), F.greatest(state["most"], at).alias("most"))

    return shapes.agg(F.max(F.aggregate(letters(F.col("shape")), start, step)["most"])).first()[0] or 0


def _inner(text: Column, ignore: str | None) -> Column:
    """Structs (key, text) of what an object or a list holds, without fields to be ignored; null for a value."""
    each = lambda key, v: F.struct(key.alias("key"), F.coalesce(F.to_json(v), F.lit("null")).alias("text"))
    fields = F.transform(F.map_entries(F.from_json(text, "map<string,variant>")), lambda x: each(x["key"], x["value"]))
    if ignore is not None:
        fields = F.filter(fields, lambda x: ~x["key"].rlike(ignore))
    elements = F.transform(F.from_json(text, "array<variant>"), lambda v: each(F.lit(None).cast("string"), v))
    return F.when(F.startswith(text, F.lit("{")), fields).when(F.startswith(text, F.lit("[")), elements)


def _form(text: Column, ignore: str | None, depth: int) -> Column:
    """A JSON text with fields and lists sorted, to a depth that it doesn't pass."""
    if depth == 0:
        return text

    def item(x: Column) -> Column:
        quoted = F.to_json(F.struct(x["key"].alias("key")))
        form = _form(x["text"], ignore, depth - 1)
        return F.when(x["key"].isNull(), form).otherwise(F.concat(quoted.substr(F.lit(8), F.length(quoted) - 8), F.lit(":"), form))

    joined = F.array_join(F.array_sort(F.transform(_inner(text, ignore), item)), ",")
    return F.when(F.startswith(text, F.lit("{")), F.concat(F.lit("{"), joined, F.lit("}"))).when(F.startswith(text, F.lit("[")), F.concat(F.lit("["), joined, F.lit("]"))).otherwise(text)


def _below(ignore: str | None, depth: int) -> Column:
    """Structs (path, listed, text) of what lies in a row's ``_inner``; the row itself if that is nothing."""
    path, text = F.col("path"), F.col("text")
    row = lambda path, listed, text: F.struct(path.alias("path"), F.lit(listed).alias("listed"), text.alias("text"))
    # names are escaped, so that a path names one field
    name = lambda key: F.replace(F.replace(key, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    below = F.transform("_inner", lambda x: F.when(x["key"].isNull(), row(F.concat(path, F.lit("[]")), True, _form(x["text"], ignore, depth))).otherwise(row(F.concat(path, F.lit("/"), name(x["key"])), False, x["text"])))
    emptied = F.when(F.size("_inner") == 0, F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))).otherwise(text)
    return F.when(F.size("_inner") > 0, below).otherwise(F.array(F.struct("path", "listed", emptied.alias("text"))))


def _values(docs: DataFrame, ignore: str | None) -> DataFrame:
    """(doc, side, path, listed, text) of (doc, side, json): values outside of lists, and elements of outermost lists.

    Texts are stored once, for their depth, and dealt by document; a document's rows
    unfold where it lies, level by level.
    """
    texts = stored(docs.where("json is not null").select("doc", "side", F.to_json(F.parse_json("json")).alias("text")), "documents")
    rows = texts.repartition("doc").select("doc", "side", F.lit("").alias("path"), F.lit(False).alias("listed"), "text")
    for left in reversed(range(_depth(texts))):
        inner = F.when(~F.col("listed"), _inner(F.col("text"), ignore))
        rows = rows.withColumn("_inner", inner).select("doc", "side", F.explode(_below(ignore, left)).alias("x")).select("doc", "side", "x.*")
    return rows


def flattened(docs: DataFrame, ignore: str | None = None) -> DataFrame:
    """(doc, path, element, text, n) of (doc, json): one row a value, and one for each different element of a list.

    ``path`` joins field names by ``/``, and has ``[]`` for elements. A list is a
    multiset: its elements, whatever is nested in them, have one form in which fields
    and inner lists are sorted, ``n`` tells how often. Empty objects and lists, and
    those that lose all fields to ``ignore`` (a pattern of field names, at any
    depth), are values. A null document has no rows, a text that isn't JSON is an error.
    """
    rows = _values(docs.select("doc", F.lit(1).alias("side"), "json"), ignore)
    element = F.when(F.col("listed"), F.col("text")).otherwise("").alias("element")
    return rows.groupBy("doc", "path", element).agg(F.first("text").alias("text"), F.count("*").alias("n"))


def document_differences(first: DataFrame, second: DataFrame, ignore: str | None = None) -> DataFrame:
    """(doc, path, value_1, value_2, n_1, n_2) of two tables of (doc, json): values that differ or that one side lacks, and list elements that one side has more often.

    A value's texts are JSON (a text in quotes, a number not); numbers of equal value
    are equal. Both sides' rows of a document lie in one task and are counted there;
    a document without an id equals none of the other side.
    """
    a, b = (df.select("doc", F.lit(k).alias("side"), "json") for k, df in ((1, first), (2, second)))
    of = lambda k: F.count(F.when(F.col("side") == k, 1)).alias(f"n_{k}")
    apart = F.when(F.col("doc").isNull(), F.col("side")).alias("_apart")
    counts = _values(a.unionByName(b), ignore).groupBy("doc", apart, "path", "listed", "text").agg(of(1), of(2)).where("n_1 <> n_2")
    # a value that differs has a row for either side's text
    element = F.when(F.col("listed"), F.col("text")).alias("_element")
    text = lambda k: F.min(F.when(F.col(f"n_{k}") > 0, F.col("text"))).alias(f"value_{k}")
    return counts.groupBy("doc", "_apart", "path", element).agg(text(1), text(2), F.sum("n_1").alias("n_1"), F.sum("n_2").alias("n_2")).drop("_apart", "_element")
