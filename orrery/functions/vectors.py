"""Vector expressions over ``array<double>`` columns (VEC-1..6).

Everything is a higher-order SQL function (``transform``, ``zip_with``,
``aggregate``), so it runs inside whole-stage code generation with no
Python in the loop.  Arrays of float are widened to double first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(a) -> Column:
    return _c(a).cast("array<double>")


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


# VEC-1 -------------------------------------------------------------------

def scale(a, k) -> Column:
    """Element-wise array x scalar (NumPy broadcasting of a scalar)."""
    return F.transform(_c(a), lambda x: x * k)


def multiply(a, b) -> Column:
    """Element-wise array x array (equal lengths)."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x * y)


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


# VEC-2 -------------------------------------------------------------------

def repeat_list(a, n: int) -> Column:
    """Python list repetition: ``[1, 2] * 2 == [1, 2, 1, 2]``."""
    return F.flatten(F.array_repeat(_c(a), n))


# VEC-3 -------------------------------------------------------------------

def full(value, n) -> Column:
    """``np.full(n, value)``; ``np.ones`` / ``np.zeros`` are value 1 / 0."""
    return F.array_repeat(F.lit(float(value)), n if isinstance(n, Column) else F.lit(n))


def arange(start: float, stop: float, step: float) -> Column:
    """``np.arange(start, stop, step)`` incl. fractional and negative steps."""
    import math
    n = max(0, math.ceil((stop - start) / step))
    if n == 0:
        return F.array().cast("array<double>")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.lit(float(start)) + i * F.lit(float(step)))


# VEC-4 -------------------------------------------------------------------

def reshape(a, width: int) -> Column:
    """1-D array -> array of rows of ``width`` (row-major, like reshape)."""
    col = _c(a)
    return F.transform(F.sequence(F.lit(0), (F.size(col) / width).cast("int") - 1),
                       lambda i: F.slice(col, i * width + 1, width))


def flatten(m) -> Column:
    return F.flatten(_c(m))


def column_slice(m, start: int, length: int) -> Column:
    """``m[:, start:start+length]`` on an array of rows."""
    return F.transform(_c(m), lambda r: F.slice(r, start + 1, length))


def transpose(m) -> Column:
    """Transpose a rectangular array of rows."""
    col = _c(m)
    return F.transform(F.sequence(F.lit(1), F.size(F.element_at(col, 1))),
                       lambda j: F.transform(col, lambda r: F.element_at(r, j)))


# VEC-5 -------------------------------------------------------------------

def dot(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def norm(a) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x * x)))


def euclidean(a, b) -> Column:
    return F.sqrt(_sum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))))


def sq_euclidean(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)))


def manhattan(a, b) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y)))


def chebyshev(a, b) -> Column:
    return F.array_max(F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y)))


def cosine_similarity(a, b) -> Column:
    """Per-pair norms (the outer product of norms, not element-wise)."""
    n = norm(a) * norm(b)
    # a zero vector is similar to none
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / F.when(n != 0, n))


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


METRICS = {
    "euclidean": euclidean,
    "manhattan": manhattan,
    "chebyshev": chebyshev,
    "cosine": cosine_distance,
}


def round_array(a, digits: int = 6) -> Column:
    return F.transform(_c(a), lambda x: F.round(x, digits))


# VEC-6 -------------------------------------------------------------------

def line(x, slope, intercept) -> Column:
    """Evaluate a fitted line ``m * x + b``."""
    return _c(x) * slope + intercept


# AG-4 --------------------------------------------------------------------

def array_sum(a) -> Column:
    """In-row sum (axis 1 of a row-per-sample matrix)."""
    return _sum(_c(a))


def axis_sum_3d(df, m: str, axis: int, key: str | None = None):
    """AG-4: sums of an n x a x b tensor (one a x b matrix per row) over one
    axis: 0 gives (i, j, total) over all rows, 1 (key, j, total) and 2
    (key, i, total) per row.  Any other axis raises ``ValueError``."""
    if axis not in (0, 1, 2):
        raise ValueError(f"axis {axis} is out of bounds for an array of dimension 3")
    cells = df.select(*([key] if axis else []), F.posexplode(m).alias("i", "_row"))
    if axis == 2:
        return cells.select(key, F.col("i").cast("long").alias("i"), array_sum("_row").alias("total"))
    if axis == 0:
        cells = cells.select("i", F.posexplode("_row").alias("j", "_x"))
        return cells.groupBy(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j")).agg(F.sum("_x").alias("total"))
    cols = df.select(key, F.posexplode(transpose(m)).alias("j", "_col"))
    return cols.select(key, F.col("j").cast("long").alias("j"), array_sum("_col").alias("total"))


def with_value(a, index: int, value) -> Column:
    """VEC-4: a copy of the array with the element at a 0-based index set."""
    return F.transform(_c(a), lambda x, i: F.when(i == index, F.lit(value)).otherwise(x))
