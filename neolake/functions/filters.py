"""Two-valued predicates on epitope rows. Every one is true or false, never null."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from neolake.schemas import NONE, NOT_RUN, NOT_SUPPORTED

_OPS = {"<": operator.lt, "<=": operator.le, "==": operator.eq, ">=": operator.ge, ">": operator.gt}


def col(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Criterion:
    """``column op threshold``; null fails only with ``exclude_nas``; a raw text equal to ``skip`` passes."""

    column: str
    op: str
    threshold: float | str
    exclude_nas: bool = False
    skip: str | None = None

    def passes(self) -> Column:
        c = col(self.column)
        value = c.try_cast("double") if isinstance(self.threshold, (int, float)) else c
        test = F.coalesce(_OPS[self.op](value, F.lit(self.threshold)), F.lit(False))
        out = F.when(c.isNull() | (c.cast("string") == "NA"), F.lit(not self.exclude_nas))
        return (out.when(c.cast("string") == self.skip, F.lit(True)) if self.skip is not None else out).otherwise(test)


def all_of(criteria: Iterable[Criterion]) -> Column:
    return reduce(operator.and_, (c.passes() for c in criteria), F.lit(True))


def any_of(criteria: Iterable[Criterion]) -> Column:
    tests = [c.passes() for c in criteria]
    return reduce(operator.or_, tests) if tests else F.lit(True)


def truthy(c: Column) -> Column:
    """True for a true value in text or boolean form, and where the annotation wasn't asked for."""
    text = F.lower(c.cast("string"))
    return F.coalesce(text.isin("true", NOT_RUN.lower()), F.lit(False))


def preferred_transcript(strategies: Iterable[str], tsl_at_most: int, mane: str = "MANE Select", canonical: str = "Canonical", tsl: str = "Transcript Support Level") -> Column:
    """Some enabled strategy accepts the transcript."""
    support = col(tsl).cast("string")
    tests = {"mane_select": truthy(col(mane)), "canonical": truthy(col(canonical)), "tsl": (support == NOT_SUPPORTED) | (support.try_cast("double") <= tsl_at_most)}
    return reduce(operator.or_, (F.coalesce(tests[s], F.lit(False)) for s in strategies), F.lit(False))


def _starts_with(sequence: Column, residues: str) -> Callable[[Column], Column]:
    return lambda i: sequence.substr(i, F.lit(len(residues))) == residues


def problematic_positions(sequence: Column, entries: Iterable[str]) -> Column:
    """Positions of problematic residues, joined by ``, ``, or ``None``.

    An entry is residues, anywhere, or ``residues:n``, at position n; negative n counts from the end.
    """
    found = []
    for entry in entries:
        residues, _, place = entry.partition(":")
        k, n = len(residues), F.length(sequence)
        if place:
            p = F.lit(int(place)) if int(place) > 0 else n + int(place) + 1
            hit = (p >= 1) & (sequence.substr(p.cast("int"), F.lit(k)) == residues)
            found.append(F.when(hit, F.array(p.cast("int"))).otherwise(F.array().cast("array<int>")))
        else:
            places = F.when(n >= k, F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
            found.append(F.filter(places, _starts_with(sequence, residues)))
    if not found:
        return F.lit(NONE)
    joined = F.array_join(F.array_sort(F.array_distinct(F.concat(*found))).cast("array<string>"), ", ")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(NONE))


def anchor_pass(positions: Column, anchors: Column, wildtype_score: Column, threshold: Column) -> Column:
    """False where one or two changed positions are all anchors and the wild type binds as well (or is unknown)."""
    places = F.transform(F.split(F.coalesce(positions.cast("string"), F.lit("")), r",\s*"), lambda p: p.try_cast("int"))
    places = F.filter(places, lambda p: p.isNotNull())
    hidden = (F.size(places) > 0) & (F.size(places) <= 2) & F.forall(places, lambda p: F.coalesce(F.array_contains(anchors, p), F.lit(False)))
    return ~(hidden & (wildtype_score.isNull() | (wildtype_score < threshold)))


def default_anchors(length: Column) -> Column:
    return F.array(F.lit(1), F.lit(2), (length - 1).cast("int"), length.cast("int"))
