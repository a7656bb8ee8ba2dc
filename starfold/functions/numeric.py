"""NaN/NULL handling and small numeric builders.

Undefined numbers are NULL throughout the engine: NaN is turned into NULL on the way in, because
Spark orders NaN above every number and treats NaN as equal to NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: ColumnLike) -> Column:
    """Double column with NaN and infinities read as NULL."""
    value = col(c).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def div(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, NULL where the divisor is zero."""
    return F.try_divide(col(a), col(b))


def round_id(c: ColumnLike) -> Column:
    """Whole-number ids kept in floating columns: half-even rounding, then BIGINT."""
    return F.rint(col(c).cast("double")).cast("bigint")


def norm3(x: ColumnLike, y: ColumnLike, z: ColumnLike) -> Column:
    x, y, z = col(x), col(y), col(z)
    return F.sqrt(x * x + y * y + z * z)


def on_grid(t: ColumnLike, step: float | None) -> Column:
    """True where t is a multiple of step (absolute tolerance 1e-9 on the ratio)."""
    if step is None or step <= 0:
        return F.lit(True)
    ratio = col(t).cast("double") / F.lit(float(step))
    return F.abs(ratio - F.rint(ratio)) <= 1e-9


def order_bin(value: ColumnLike, per_efold: int = 1024) -> Column:
    """Order-preserving BIGINT bin of a double: equal relative width, symmetric around zero."""
    v = col(value).cast("double")
    offset = 800 * per_efold
    size = (F.floor(F.ln(F.abs(v)) * per_efold) + offset).cast("bigint")
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("bigint"))
