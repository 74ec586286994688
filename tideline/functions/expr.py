"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str) -> Column:
    """Division that is NULL, not an error, when the divisor is zero."""
    return F.try_divide(col(a), col(b))


def label(*cases: tuple[Column, str], default: str) -> Column:
    """First matching label; a NULL condition falls through to the default."""
    out = None
    for condition, name in cases:
        out = F.when(condition, F.lit(name)) if out is None else out.when(condition, F.lit(name))
    return out.otherwise(F.lit(default))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pairwise-complete Pearson correlation, NULL when either side is constant.

    Built from covariance and deviations: ``corr`` raises on a constant side even behind a condition, because
    aggregates are finished before the condition is looked at.
    """
    x, y = col(x), col(y)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def hash_uniform(*parts: Column | str) -> Column:
    """A uniform number in [0, 1) fixed by its arguments, the same whatever the partitioning."""
    digest = F.md5(F.concat_ws("|", *[col(p).cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def hash_normal(*parts: Column | str) -> Column:
    """A standard normal number fixed by its arguments (Box-Muller on two hash uniforms)."""
    first = hash_uniform(*parts, F.lit("a"))
    second = hash_uniform(*parts, F.lit("b"))
    return F.sqrt(-2 * F.log(1 - first)) * F.cos(F.lit(6.283185307179586) * second)


def key_text(*parts: Column | str) -> Column:
    """One text for a key of several columns: equal for equal keys only, NULL being equal to NULL. Never NULL."""
    texts = [col(p).cast("string") for p in parts]
    return F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts])
