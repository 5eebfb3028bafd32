"""Column expressions shared by all operators (all JVM-side, codegen'd)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """Missing = null, or NaN for floating columns (pandas folds both)."""
    c = _col(c)
    if dtype is not None and not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNull()
    return c.isNull() | F.isnan(c)


def not_missing(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    return ~is_missing(c, dtype)


def round_half_even(c: ColumnOrName, digits: int) -> Column:
    """NumPy-style ``round``: scale, round half to even, unscale."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def round_half_up(c: ColumnOrName) -> Column:
    """``round(c)`` of a double, halves away from zero, without a decimal for every row: a double's
    distance from the nearest whole number is exact, so a half is seen as one."""
    c = _col(c)
    return F.when(F.abs(c - F.rint(c)) == 0.5, F.rint(c + F.signum(c) * 0.5)).otherwise(F.rint(c))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null on a zero denominator (ANSI-safe)."""
    return F.try_divide(_col(num), _col(den))


def zero_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division whose zero denominator yields 0.0 (metric convention)."""
    return F.coalesce(F.try_divide(_col(num).cast("double"), _col(den).cast("double")),
                      F.lit(0.0))


def row_key(*cols: ColumnOrName) -> Column:
    """Deterministic string key of a row (for hashing, not for joins)."""
    return F.concat_ws(":", *[_col(c).cast("string") for c in cols])


def hash_uniform(key: Column, seed: int | str, salt: str = "") -> Column:
    """Uniform [0, 1) draw from md5(key:seed[:salt]).

    Independent of partitioning and recomputation, so splits and samples
    are identical across runs, executors and engines.
    """
    parts = [key, F.lit(str(seed))]
    if salt:
        parts.append(F.lit(salt))
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_normal(key: Column, seed: int | str, mean: float = 0.0, std: float = 1.0) -> Column:
    """Normal draw by Box-Muller from two hash uniforms."""
    u1 = hash_uniform(key, seed, "n1")
    u2 = hash_uniform(key, seed, "n2")
    # 1 - u keeps the log argument in (0, 1]
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(mean) + F.lit(std) * z
