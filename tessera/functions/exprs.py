"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c, dtype: T.DataType | None = None) -> Column:
    """NaN and +/-inf become NULL (floating columns only)."""
    c = col_(c)
    if dtype is not None and not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c
    return F.when(F.abs(c) < F.lit(INF), c)     # NaN orders above infinity


def finite_table(df: DataFrame, cols=None) -> DataFrame:
    """The missing-value rule on entry: NaN and +/-inf of the floating columns
    (of ``cols``, if given) become NULL. Other columns cost nothing."""
    kinds = (T.DoubleType, T.FloatType)
    if not any(isinstance(f.dataType, kinds) and (cols is None or f.name in cols) for f in df.schema.fields):
        return df
    return df.select(*[finite(F.col(f.name)).alias(f.name) if isinstance(f.dataType, kinds) and (cols is None or f.name in cols)
                       else F.col(f.name) for f in df.schema.fields])


def int_label(c) -> Column:
    """The label as an integer. Under ANSI a text that is not a number
    raises at run time instead of silently becoming NULL."""
    return col_(c).cast("int")


def _passes_through(c: Column) -> Column:
    """NULL is not clipped (``least``/``greatest`` skip it, so the bound would
    come out), nor is NaN, should one get here past :func:`finite_table`."""
    return c.isNull() | F.isnan(c)


def clip_upper(c, hi) -> Column:
    """One-sided cap that keeps NULL and NaN."""
    c = col_(c)
    if hi is None:
        return c
    return F.when(_passes_through(c), c).otherwise(F.least(c, F.lit(float(hi))))


def clip(c, lo, hi) -> Column:
    c = col_(c)
    x = c
    if hi is not None:
        x = F.least(x, F.lit(float(hi)))
    if lo is not None:
        x = F.greatest(x, F.lit(float(lo)))
    return F.when(_passes_through(c), c).otherwise(x)


def div_zero_as_one(a, b) -> Column:
    """a / b with a zero divisor replaced by 1."""
    b = col_(b)
    return col_(a) / F.when(b == 0, F.lit(1)).otherwise(b)


def div_zero_as_null(a, b) -> Column:
    """a / b with a zero divisor giving NULL (T13); ANSI-safe."""
    return F.try_divide(col_(a), col_(b))


def r6(c) -> Column:
    return F.round(col_(c).cast("double"), 6)


def lit_double(v) -> Column:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return F.lit(None).cast("double")
    return F.lit(float(v))


def unpivot(df: DataFrame, cols: list[str], ids: list[str] | tuple = (), cast: str | None = "double",
            feature: str = "feature", value: str = "value", drop_nulls: bool = True) -> DataFrame:
    """Wide -> long (ids..., feature, value): one Expand, no shuffle."""
    sel = [F.col(i) for i in ids] + [
        (F.col(c).cast(cast) if cast else F.col(c)).alias(c) for c in cols]
    long = df.select(*sel).unpivot(list(ids), list(cols), feature, value)
    if drop_nulls:
        cond = F.col(value).isNotNull()
        if cast == "double":
            cond = cond & (F.abs(F.col(value)) < F.lit(INF))
        long = long.where(cond)
    return long


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def case_by(key: Column, mapping: dict, default=None) -> Column:
    """CASE key WHEN k THEN v ... from a small driver-side dict."""
    out = None
    for k, v in mapping.items():
        val = v if isinstance(v, Column) else F.lit(v)
        out = F.when(key == F.lit(k), val) if out is None else out.when(key == F.lit(k), val)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if out is None else out.otherwise(dflt)


def sorted_bucket(v: Column, edges: list) -> Column:
    """Number of edges strictly below v (edges sorted ascending; numbers or
    strings), as a balanced CASE tree: log2(len(edges)) comparisons per row,
    code-generated."""
    def lit(e):
        return F.lit(e) if isinstance(e, str) else F.lit(float(e))

    def tree(lo: int, hi: int) -> Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v <= lit(edges[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(edges))
