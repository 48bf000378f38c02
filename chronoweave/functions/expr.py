"""Reusable column expressions.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def nan_f() -> Column:
    return F.lit(float("nan")).cast("float")


def nan_d() -> Column:
    return F.lit(float("nan")).cast("double")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shape_width(shape) -> Column:
    """Product of the declared shape; ``[]`` (scalar) has width 1."""
    return F.aggregate(F.coalesce(col(shape), F.array().cast("array<int>")),
                       F.lit(1), lambda acc, d: acc * d)


def nan_array(width) -> Column:
    """A gap: ``width`` NaN floats (never NULL inside payload arrays)."""
    return F.array_repeat(nan_f(), col(width).cast("int"))


def blend(a, b, w) -> Column:
    """Linear blend ``a*(1-w) + b*w`` element-wise, kept in float32."""
    wf = col(w).cast("float")
    one = F.lit(1.0).cast("float")
    return F.zip_with(col(a), col(b), lambda x, y: x * (one - wf) + y * wf)


def clip_unit(x) -> Column:
    """numpy ``clip(x, 0, 1)``: NaN stays NaN (Spark's least(1, NaN) is 1)."""
    x = col(x)
    return F.when(F.isnan(x), nan_d()).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def unit_confidence(source, clock, interp):
    """Fold the three components: all missing → ones; scalar = clip(s*c*i)."""
    s, c, i = col(source).cast("double"), col(clock).cast("double"), col(interp).cast("double")
    missing = s.isNull() & c.isNull() & i.isNull()
    one = F.lit(1.0)
    s2 = F.when(missing, one).otherwise(s)
    c2 = F.when(missing, one).otherwise(c)
    i2 = F.when(missing, one).otherwise(i)
    return s2, c2, i2, clip_unit(s2 * c2 * i2)


def safe_div(num, den) -> Column:
    """numpy-style division: x/0 → NaN instead of an ANSI error."""
    return F.coalesce(F.try_divide(col(num), col(den)), nan_d())


def round6(x) -> Column:
    return F.round(col(x).cast("double"), 6)


def zero_pad3(i) -> Column:
    """``cNNN`` element suffix (3 digits, widening beyond 999)."""
    return F.concat(F.lit("c"), F.lpad(col(i).cast("string"), 3, "0"))
