"""Preparation of predictors: imputation, scaling, booleans, hashed categories."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions.values import boolean_value, number, standardised, token

HASH_BUCKETS = 4096


@dataclass(frozen=True)
class Predictors:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    boolean: tuple[str, ...]

    @property
    def all(self) -> tuple[str, ...]:
        return self.numeric + self.categorical + self.boolean


def predictor_sets(schema: T.StructType, keep: list[str]) -> Predictors:
    """Kept columns by kind: int, long, float and double are numbers; what isn't boolean either is a category."""
    lacking = sorted(set(keep) - set(schema.names))
    if lacking:
        raise ValueError(f"columns that should be kept are missing: {lacking[:10]}")
    kinds = {n: schema[n].dataType for n in sorted(keep)}
    numeric = tuple(n for n, t in kinds.items() if isinstance(t, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)))
    boolean = tuple(n for n, t in kinds.items() if isinstance(t, T.BooleanType))
    return Predictors(numeric, tuple(n for n in kinds if n not in numeric and n not in boolean), boolean)


def numeric_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, mean and scale of each: population deviation, 1 where it is 0; mean 0 where all are missing.

    Columns become (place, value) rows that are aggregated by place: two aggregates instead of two for
    each column, so that hundreds of columns neither take minutes to plan nor leave generated code.
    Each task sums its own rows first; a row for each column is shuffled.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    values = df.select(F.posexplode(F.array(*[number(F.col(f"`{c}`"), kinds[c]) for c in columns])).alias("place", "x"))
    found = values.groupBy("place").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "_i int, column string")  # so that a table without rows has its columns, too
    return names.join(F.broadcast(found), F.col("_i") == F.col("place"), "left").select(  # a row for each column
        "column", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0).alias("scale")
    )


def stats_dict(stats: DataFrame) -> dict[str, tuple[float, float]]:
    return {r["column"]: (r["mean"], r["scale"]) for r in stats.collect()}  # a row for each predictor


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(*[standardised(number(F.col(f"`{c}`"), kinds[c]), *stats[c]).alias(c) if c in stats else F.col(f"`{c}`") for c in df.columns])


def tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    """Categories as texts column=value, a missing value by its own token."""
    return df.withColumns({c: token(c, F.col(f"`{c}`")) for c in columns})


def design(df: DataFrame, predictors: Predictors, stats: dict[str, tuple[float, float]], *, buckets: int = HASH_BUCKETS) -> DataFrame:
    """``df`` with the vector ``features``: numbers, booleans, then hashed categories."""
    kinds = {f.name: f.dataType for f in df.schema}
    plain = [standardised(number(F.col(f"`{c}`"), kinds[c]), *stats[c]) for c in predictors.numeric]
    plain += [boolean_value(F.col(f"`{c}`")) for c in predictors.boolean]
    cats = {f"_c{i}": token(c, F.col(f"`{c}`")) for i, c in enumerate(predictors.categorical)}
    out, parts = df, []
    if plain:  # one vector of all numbers, not a column of its own for each
        out, parts = out.withColumn("_plain", array_to_vector(F.array(*plain))), ["_plain"]
    if cats:
        out = out.withColumns(cats)
        out = FeatureHasher(numFeatures=buckets, inputCols=list(cats), categoricalCols=list(cats), outputCol="_h").transform(out)
        parts.append("_h")
    return VectorAssembler(inputCols=parts, outputCol="features").transform(out).select(*df.columns, "features")


def class_weights(df: DataFrame, weight: str | float | None) -> dict[int, float] | None:
    """None, {0: 1, 1: w}, or for "balanced" rows / (2 * rows of the class)."""
    if weight is None:
        return None
    if isinstance(weight, (int, float)):
        return {0: 1.0, 1: float(weight)}
    if weight != "balanced":
        raise ValueError(f"unknown class weight {weight!r}")
    n = {int(r[0]): r[1] for r in df.where(F.col("target").isin(0, 1)).groupBy("target").count().collect()}
    if len(n) < 2:
        raise ValueError("balanced weights need both classes")
    return {k: sum(n.values()) / (2 * n[k]) for k in (0, 1)}


def weight_name(weight: str | float | None) -> str:
    return "unweighted" if weight is None else weight if isinstance(weight, str) else f"positive_weight_{weight:g}"
