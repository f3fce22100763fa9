"""Column expressions with the engine's null and number rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = "__MISSING__"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def as_date(c: Column, kind: T.DataType) -> Column:
    """Dates as they are; text by cast, where an empty one is null and a malformed one an error."""
    return blank_to_null(c).cast("date") if isinstance(kind, T.StringType) else c.cast("date")


def days(c: Column, kind: T.DataType) -> Column:
    """Days since 1970-01-01."""
    return F.unix_date(as_date(c, kind))


def missing_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def number(c: Column, kind: T.DataType) -> Column:
    """As double; NaN counts as missing."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d) if isinstance(kind, (T.FloatType, T.DoubleType)) else d


def standardised(c: Column, mean: float | Column, scale: float | Column) -> Column:
    """Missing values become the mean, then (x - mean) / scale."""
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    return (F.coalesce(c, mean) - mean) / scale


def boolean_value(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(-1.0))


def token(name: str, c: Column) -> Column:
    return F.concat(F.lit(f"{name}="), F.coalesce(c.cast("string"), F.lit(MISSING)))


def logit(p: Column, least: float = 1e-6) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - least)), F.lit(least))
    return F.log(q / (1 - q))


def gini(auc: Column | float) -> Column | float:
    return 2.0 * auc - 1.0
