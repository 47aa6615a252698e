"""Numeric expressions of the signal path."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: The largest half-precision number, the power of the compressed
#: statistic, the usual target total.
HALF_MAX = 65504.0
POWER = 0.75
TARGET_TOTAL = 1e8
LINEAR, COMPRESSED = ("sum", "mean"), "sum_sqrt"


def zero_missing(x: Column) -> Column:
    """Null, NaN and infinities as 0."""
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)


def normalisation_factor(total: Column, target: float = TARGET_TOTAL) -> Column:
    """``target / total``; a total that is not finite and positive fails."""
    good = total.isNotNull() & ~F.isnan(total) & (total > 0) & (total < float("inf"))
    return F.when(good, F.lit(target) / total).otherwise(F.raise_error(F.lit("the signal total must be finite and positive")).cast("double"))


def transform_value(x: Column, factor: Column, statistic: Column, strict: bool = True) -> Column:
    """Missing to 0, scaled, and raised to 3/4 where the statistic asks for it.
    An unknown or null statistic fails if ``strict``, else is linear."""
    scaled = (zero_missing(x) * factor).cast("float")
    raised = F.pow(F.greatest(scaled, F.lit(0.0).cast("float")), F.lit(POWER)).cast("float")
    out = F.when(statistic == COMPRESSED, raised)
    if strict:
        bad = F.raise_error(F.concat(F.lit("unsupported statistic: "), F.coalesce(statistic, F.lit("null")))).cast("float")
        return out.when(statistic.isin(*LINEAR), scaled).otherwise(bad)
    return out.otherwise(scaled)


def cap(x: Column, limit: float = HALF_MAX) -> Column:
    """Values above the limit become it; NaN stays NaN, there is no lower bound."""
    return F.when(~F.isnan(x) & (x > limit), F.lit(limit).cast("float")).otherwise(x)


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def guard_finite(x: Column) -> Column:
    """The value, or an error where it is NaN or infinite."""
    return F.when(is_finite(x) | x.isNull(), x).otherwise(F.raise_error(F.lit("a value is not finite after the cap")).cast("float"))


@pandas_udf(T.FloatType())
def half_rounded(x: pd.Series) -> pd.Series:
    """Values rounded to half precision (Spark has no such type); values under
    -65504 become -infinity, as they do in that format."""
    with np.errstate(over="ignore"):
        return pd.Series(x.to_numpy(np.float32, na_value=np.nan).astype(np.float16).astype(np.float32))


@pandas_udf(T.ArrayType(T.FloatType()))
def half_rounded_array(x: pd.Series) -> pd.Series:
    with np.errstate(over="ignore"):
        return x.map(lambda v: None if v is None else np.asarray(v, np.float32).astype(np.float16).astype(np.float32))


def stride_for(n: Column, most: int) -> Column:
    """Rows that one plotted point stands for."""
    return F.greatest(F.ceil(n / most), F.lit(1)).cast("long")


def coordinates(start: Column, end: Column) -> Column:
    """Every position of ``[start, end)``; none where it is empty."""
    return F.when(end > start, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))


def missing_count(x: Column) -> Column:
    """Aggregate: rows whose value is null or NaN."""
    return F.count_if(x.isNull() | F.isnan(x))
