"""Column-expression helpers (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(a, b) -> Column:
    """``a / b`` with 0 where b is 0 and where the result is null, NaN or infinite."""
    q = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    return F.coalesce(finite_or_null(q), F.lit(0.0))


def finite_or_null(c) -> Column:
    """NaN and +/-inf become null (ANSI comparisons on NaN are defined in Spark)."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def is_numeric(dtype: str) -> bool:
    return dtype.split("(")[0] in NUMERIC_TYPES


def numeric_columns(df, exclude=()) -> list[str]:
    return [n for n, t in df.dtypes if is_numeric(t) and n not in set(exclude)]


def minmax_expr(c, lo: float, hi: float) -> Column:
    """(x - min) / (max - min); a constant column gives x - min (as the reference's scaler)."""
    x = col(c).cast("double")
    if lo is None or hi is None:  # no known value: all stays null
        return F.when(F.lit(False), x)
    rng = hi - lo
    return (x - F.lit(lo)) / F.lit(rng) if rng != 0 else (x - F.lit(lo))


def uniform_bin_expr(c, lo: float, hi: float, n_bins: int = 10) -> Column:
    """Equal-width bin index 0..n_bins-1 over [lo, hi]; max falls in the last bin."""
    x = col(c).cast("double")
    if lo is None or hi is None or hi == lo:
        return F.when(x.isNotNull(), F.lit(0)).cast("int")
    b = F.floor((x - F.lit(lo)) * F.lit(float(n_bins)) / F.lit(hi - lo))
    return F.least(F.greatest(b, F.lit(0)), F.lit(n_bins - 1)).cast("int")


# The seven candidate power transforms, names as in the reference.
POWER_TRANSFORMS = ["x", "log", "sqrt", "exp", "**1/4", "**2", "**4"]
LOG_FLOOR = -50.0


def power_expr(c, name: str, digits: int = 4) -> Column:
    """One of the seven transforms, rounded to ``digits``; non-finite log -> -50."""
    x = col(c).cast("double")
    if name == "x":
        v = x
    elif name == "log":
        return F.when(x > 0, F.round(F.ln(x), digits)).otherwise(F.lit(LOG_FLOOR))
    elif name == "sqrt":
        v = F.when(x >= 0, F.sqrt(x))
    elif name == "exp":
        v = F.exp(x)
    elif name == "**1/4":
        v = F.when(x >= 0, F.pow(x, 0.25))
    elif name == "**2":
        v = F.pow(x, 2.0)
    elif name == "**4":
        v = F.pow(x, 4.0)
    else:
        raise ValueError(name)
    return F.round(v, digits)


def power_suffix(name: str) -> str:
    return {"x": "x", "log": "log", "sqrt": "sqrt", "exp": "exp", "**1/4": "p025",
            "**2": "p2", "**4": "p4"}[name]
