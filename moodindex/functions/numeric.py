"""Numeric column functions: softmax, arg-max, finite values, NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softmax(logits: Sequence[Column | str]) -> list[Column]:
    """Numerically stable softmax over a fixed set of logit columns."""
    cols = [_c(c) for c in logits]
    m = F.greatest(*cols)
    exps = [F.exp(c - m) for c in cols]
    total = exps[0]
    for e in exps[1:]:
        total = total + e
    return [e / total for e in exps]


def argmax(values: Sequence[Column | str]) -> Column:
    """0-based index of the largest value; the first one wins ties."""
    cols = [_c(c) for c in values]
    expr = None
    for i in range(len(cols) - 1, -1, -1):
        cond = None
        for j in range(i + 1, len(cols)):
            cmp = cols[i] >= cols[j]
            cond = cmp if cond is None else cond & cmp
        if expr is None:
            expr = F.lit(i)
        else:
            expr = F.when(cond, F.lit(i)).otherwise(expr)
        # cols before i are handled by the enclosing (earlier) branches
    return expr.cast("int")


def finite(c: Column | str) -> Column:
    """A number as double; NaN, infinities and text that is no number are
    null, so that one bad value neither fails nor swallows a mean."""
    col = _c(c).try_cast("double")
    return F.when(~F.isnan(col) & (F.abs(col) < F.lit(float("inf"))), col)


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes SQL null before publishing."""
    col = _c(c)
    return F.when(~F.isnan(col), col)
