"""Global alignment of a wild-type and a mutant sequence, for many pairs at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cells of all tables that are filled side by side.
CELLS = 1 << 24
RESULT = "score double, wild string, mutant string"


def _fill(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, match: float, mismatch: float, opening: float, extension: float, band: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Best scores and choices[pair, state, i, j]: states are both letters, a gap in b, a gap in a.

    A choice is the state before: the first of equal ones in this order.
    """
    pairs, rows, cols = len(a), a.shape[1], b.shape[1]
    low = -1e18
    score = np.full((3, rows + 1, cols + 1, pairs), low)
    choice = np.zeros((3, rows + 1, cols + 1, pairs), np.int8)
    score[0, 0, 0] = 0.0
    for i in range(rows + 1):
        first, last = (0, cols) if band is None else (max(0, i - band), min(cols, i + band))
        for j in range(first, last + 1):
            if i and j:
                before = score[:, i - 1, j - 1]
                choice[0, i, j] = before.argmax(axis=0)
                score[0, i, j] = before.max(axis=0) + np.where(a[:, i - 1] == b[:, j - 1], match, mismatch)
            if i:
                before = score[:, i - 1, j] + np.array([opening, extension, opening])[:, None]
                choice[1, i, j], score[1, i, j] = before.argmax(axis=0), before.max(axis=0)
            if j:
                before = score[:, i, j - 1] + np.array([opening, opening, extension])[:, None]
                choice[2, i, j], score[2, i, j] = before.argmax(axis=0), before.max(axis=0)
    return score[:, n, m, np.arange(pairs)], choice


def align_all(wild: list[str], mutant: list[str], match: float, mismatch: float, opening: float, extension: float, band: int | None) -> list[tuple[float, str, str]]:
    """(score, wild, mutant) with ``-`` for gaps of each pair; all pairs' tables are filled cell by cell together."""
    n, m = np.array([len(x) for x in wild]), np.array([len(x) for x in mutant])
    code = lambda xs, size: np.array([[ord(c) for c in x] + [0] * (size - len(x)) for x in xs], np.int64).reshape(len(xs), size)
    a, b = code(wild, n.max(initial=0)), code(mutant, m.max(initial=0))
    # a band has to reach the corner of every table
    band = None if band is None else band + int(np.abs(n - m).max(initial=0))
    ends, choice = _fill(a, b, n, m, match, mismatch, opening, extension, band)
    out = []
    for p, (x, y) in enumerate(zip(wild, mutant, strict=True)):
        i, j, state, left, right = len(x), len(y), int(ends[:, p].argmax()), [], []
        score = float(ends[state, p])
        while i or j:
            before = int(choice[state, i, j, p])
            left.append(x[i - 1] if state != 2 else "-")
            right.append(y[j - 1] if state != 1 else "-")
            i, j, state = i - (state != 2), j - (state != 1), before
        out.append((score, "".join(reversed(left)), "".join(reversed(right))))
    return out


def aligned(wild: Column, mutant: Column, match: float = 2.0, mismatch: float = -1.0, opening: float = -5.0, extension: float = -0.5, band: int | None = None) -> Column:
    """Struct (score, wild, mutant): the best global alignment with affine gaps, ``-`` for a gap; null if either is null.

    A gap's first letter costs ``opening``, each further one ``extension``, at the
    ends as well. Of equal alignments the one that ends with paired letters, then
    with a gap in the mutant, looking back from the end. ``band``: only places up
    to that many off the diagonal (and the difference of the lengths) are tried.
    """

    @F.pandas_udf(RESULT)
    def align(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in parts:
            out: list[tuple[float, str, str] | None] = [None] * len(x)
            known = [i for i in range(len(x)) if x.iloc[i] is not None and y.iloc[i] is not None]
            known.sort(key=lambda i: (len(x.iloc[i]), len(y.iloc[i])))  # tables of like sizes together
            while known:
                shortest, cols, take = len(x.iloc[known[0]]), 0, 0
                for i in known:
                    cols = max(cols, len(y.iloc[i]))
                    if take and (3 * (len(x.iloc[i]) + 1) * (cols + 1) * (take + 1) > CELLS or len(x.iloc[i]) > 1.2 * shortest + 2):
                        break
                    take += 1
                part, known = known[:take], known[take:]
                for i, r in zip(part, align_all([x.iloc[i] for i in part], [y.iloc[i] for i in part], match, mismatch, opening, extension, band), strict=True):
                    out[i] = r
            yield pd.DataFrame([r or (None, None, None) for r in out], columns=["score", "wild", "mutant"])

    both = align(wild, mutant)
    return F.when(wild.isNotNull() & mutant.isNotNull(), both)


def changed_places(alignment: Column) -> Column:
    """Places of the mutant, from 1, whose residue the wild type hasn't at its side of the alignment."""
    pairs = F.zip_with(F.split(alignment["wild"], ""), F.split(alignment["mutant"], ""), lambda w, m: F.struct(w.alias("w"), m.alias("m")))
    own = F.filter(pairs, lambda x: x["m"] != "-")
    return F.filter(F.transform(own, lambda x, i: F.when(x["w"] != x["m"], i + 1)), lambda i: i.isNotNull())
