"""Array and numeric column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col

# --- fixed values: reserved ids ----------------------------------------------
BOS_ID, EOS_ID, PAD_ID, UNK_ID, MASK_ID = 0, 1, 2, 3, 4
IGNORE_LABEL = -100
# -----------------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    An expression written inside an array lambda is evaluated for every element; this is
    how a row-level value is bound outside of it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(xs: Column | str) -> Column:
    return F.aggregate(as_col(xs), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return total(F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double")))


def doubles(xs: Column | str) -> Column:
    return as_col(xs).cast("array<double>")


def softmax(xs: Column | str) -> Column:
    """Max-shifted softmax over an array."""
    xs = as_col(xs)
    exps = let(F.array_max(xs), lambda m: F.transform(xs, lambda x: F.exp(x - m)))
    return let(exps, lambda es: let(total(es), lambda s: F.transform(es, lambda e: e / s)))


def head(xs: Column | str, n: int | Column) -> Column:
    return F.slice(as_col(xs), F.lit(1), F.greatest(_lit(n), F.lit(0)))


def tail(xs: Column | str, n: int | Column) -> Column:
    """Last ``n`` elements; the whole array when it is shorter (``slice`` alone gives [])."""
    xs, n = as_col(xs), _lit(n)
    keep = F.greatest(F.least(F.size(xs), n), F.lit(0))
    return F.slice(xs, F.size(xs) - keep + 1, keep)


def pad_to(xs: Column | str, length: int | Column, value: int) -> Column:
    """Right-pad with ``value``, or cut, to ``length``."""
    xs, length = as_col(xs), _lit(length)
    fill = F.array_repeat(F.lit(value), F.greatest(length - F.size(xs), F.lit(0)))
    return head(F.concat(xs, fill), length)


def shift_labels(xs: Column | str) -> Column:
    """Next-token labels: shifted left by one, the last one ignored."""
    xs = as_col(xs)
    shifted = F.concat(F.slice(xs, F.lit(2), F.greatest(F.size(xs) - 1, F.lit(0))), F.array(F.lit(IGNORE_LABEL)))
    return F.when(F.size(xs) == 0, xs).otherwise(shifted)


def softplus(x: Column | str) -> Column:
    """log(1 + e^x) without overflow."""
    x = as_col(x)
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def _lit(n: int | Column) -> Column:
    return F.lit(n) if isinstance(n, int) else n
