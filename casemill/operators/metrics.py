"""Ranking, calibration and quantile metrics of scored cases (columns y and score).

Running counts over all rows don't go through one task: rows are dealt by ranges of the order,
each range counts its own, and the counts of the ranges before are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.values import gini, logit
from casemill.session import materialised


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with _n (place in the order, from 1) and the running sum of each of ``sums``."""
    names = {k: f"_s{i}" for i, k in enumerate(sums)}
    dealt = df.withColumns({names[k]: c for k, c in sums.items()}).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    dealt = materialised(dealt, "ranges")  # the ranges must not change between the two uses
    own = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_c"), *[F.sum(s).alias(s) for s in names.values()])
    offsets = counts.select(F.col("_range").alias("_r"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}") for c in ("_c", *names.values())])
    out = dealt.join(F.broadcast(offsets), F.col("_range") == F.col("_r"))
    added = {"_n": F.row_number().over(own) + F.col("_b_c")} | {k: F.sum(s).over(own) + F.col(f"_b{s}") for k, s in names.items()}
    return out.withColumns(added).select(*df.columns, *added)


def totals(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("_rows"), F.coalesce(F.sum("y"), F.lit(0)).cast("long").alias("_pos"))


def ranking(scored: DataFrame) -> DataFrame:
    """case_id, y, score, _n (place by falling score, equal ones by case_id) and _cp (positives so far).

    Written once: all metrics of order are aggregates of it.
    """
    ranked = running(scored.select("case_id", "y", "score"), [F.desc("score"), F.asc("case_id")], {"_cp": F.coalesce(F.col("y"), F.lit(0)).cast("long")})
    return materialised(ranked, "ranking")


def score_groups(ranked: DataFrame) -> DataFrame:
    """A row for each score: pos and all with it, and _tp and _up, those with it or a higher one."""
    return ranked.groupBy("score").agg(F.coalesce(F.sum("y"), F.lit(0)).cast("long").alias("pos"), F.count(F.lit(1)).alias("all"), F.max("_cp").alias("_tp"), F.max("_n").alias("_up"))


def _with_totals(rows: DataFrame, scored: DataFrame) -> DataFrame:
    return rows.crossJoin(F.broadcast(totals(scored)))  # one row


def _auc(groups: DataFrame) -> list[Column]:
    """roc_auc and gini, of groups with the totals.  Pairs with equal scores count half; null with one class only."""
    neg = F.col("all") - F.col("pos")
    below = F.col("_rows") - F.col("_pos") - (F.col("_up") - F.col("_tp"))
    p, m = F.max("_pos"), F.max("_rows") - F.max("_pos")
    auc = F.when((p > 0) & (m > 0), F.sum(F.col("pos").cast("double") * (below + neg / 2.0)) / p / m)
    return [auc.alias("roc_auc"), gini(auc).alias("gini")]


def _precision(groups: DataFrame) -> Column:
    """The sum of precision over the steps of recall; equal scores are one step."""
    p = F.max("_pos")
    return F.when(p > 0, F.sum(F.col("pos").cast("double") * F.col("_tp") / F.col("_up")) / p).otherwise(0.0).alias("pr_auc")


def _gap() -> Column:
    gap = F.abs(F.col("_cp") / F.col("_pos") - (F.col("_n") - F.col("_cp")) / (F.col("_rows") - F.col("_pos")))
    ok = (F.col("_pos") > 0) & (F.col("_pos") < F.col("_rows"))
    return F.coalesce(F.max(F.when(ok, gap)), F.lit(float("nan"))).alias("ks")


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row: roc_auc and gini."""
    groups = _with_totals(score_groups(ranking(scored)), scored)
    return groups.agg(*_auc(groups))


def average_precision(scored: DataFrame) -> DataFrame:
    """One row: pr_auc."""
    groups = _with_totals(score_groups(ranking(scored)), scored)
    return groups.agg(_precision(groups))


def ks(scored: DataFrame) -> DataFrame:
    """One row: the largest gap between the running shares of both classes, row by row.

    Rows of equal scores follow by case_id.  NaN with one class only.
    """
    return _with_totals(ranking(scored), scored).agg(_gap())


def brier(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg((F.col("score") - F.col("y")) * (F.col("score") - F.col("y"))).alias("brier_score"))


QUANTILES = {"p01": 0.01, "p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99}


def _quantiles() -> list[Column]:
    """Of groups with totals: the quantiles, interpolated between the two scores whose places are nearest."""
    below = F.col("_rows") - F.col("_up")  # rows with a lower score
    out = []
    for name, q in QUANTILES.items():
        place = (F.col("_rows") - 1) * F.lit(q)
        at = lambda k: F.max(F.when((below <= k) & (k < below + F.col("all")), F.col("score")))
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        out.append((low + (high - low) * share).alias(name))
    return out


def _summary() -> list[Column]:
    return [F.min("score").alias("min"), *_quantiles(), (F.sum(F.col("score") * F.col("all")) / F.sum("all")).alias("mean"), F.max("score").alias("max")]


def probability_summary(scored: DataFrame) -> DataFrame:
    """min, 1, 5, 50, 95 and 99 percent, mean and max; exact, by the places of the scores."""
    return _with_totals(score_groups(ranking(scored)), scored).agg(*_summary())


def decile_table(scored: DataFrame, bins: int = 10, *, ranked: DataFrame | None = None) -> DataFrame:
    """Rows ranked by falling score (equal ones by case_id) in ``bins`` equal parts, with lifts."""
    rows = _with_totals(ranking(scored) if ranked is None else ranked, scored)
    # As ntile: the first rows % bins parts have one more row.
    small, more = F.floor(F.col("_rows") / bins), F.col("_rows") % bins
    place = F.col("_n") - 1
    part = F.when(place < more * (small + 1), F.floor(place / (small + 1))).otherwise(more + F.floor((place - more * (small + 1)) / F.greatest(small, F.lit(1))))
    base = F.col("_pos") / F.col("_rows")
    out = rows.groupBy((part + 1).cast("long").alias("decile"), "_rows", "_pos").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("y").cast("long").alias("positive_cases"), F.min("score").alias("score_min"), F.max("score").alias("score_max")
    )
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # a row for each part
    out = out.withColumn("default_rate", F.col("positive_cases") / F.col("rows")).withColumn("cumulative_rows", F.sum("rows").over(upto)).withColumn("cumulative_positives", F.sum("positive_cases").over(upto))
    some = F.col("_pos") > 0
    return out.select(
        "decile", "rows", "positive_cases", "default_rate", "score_min", "score_max", "cumulative_rows", (F.col("cumulative_rows") / F.col("_rows")).alias("cumulative_row_pct"), "cumulative_positives",
        F.when(some, F.col("cumulative_positives") / F.col("_pos")).otherwise(float("nan")).alias("cumulative_positive_pct"),
        F.when(some, F.col("default_rate") / base).otherwise(float("nan")).alias("lift"),
        F.when(some, F.col("cumulative_positives") / F.col("cumulative_rows") / base).otherwise(float("nan")).alias("cumulative_lift"),
    )


def top_deciles(deciles: DataFrame) -> DataFrame:
    """The first tenth and the first three tenths."""
    return deciles.where(F.col("decile").isin(1, 3)).select("decile", "default_rate", "lift", "cumulative_positive_pct", "cumulative_lift")


def calibration(scored: DataFrame, steps: int = 200) -> dict[str, float]:
    """Intercept and slope of y on the logit of the score, by Newton steps of one aggregate each."""
    return _newton(scored.groupBy("score").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("all")), steps)


def _newton(groups: DataFrame, steps: int) -> dict[str, float]:
    rows = groups.select(F.col("pos").cast("double").alias("y"), logit(F.col("score")).alias("x"), F.col("all").alias("n")).cache()
    a, b = 0.0, 1.0
    try:
        for _ in range(steps):
            p = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("x"))))
            w, g = F.col("n") * p * (1 - p), F.col("y") - F.col("n") * p
            r = rows.agg(F.sum(g), F.sum(g * F.col("x")), F.sum(w), F.sum(w * F.col("x")), F.sum(w * F.col("x") * F.col("x"))).first()
            if r[0] is None:
                return {"calibration_intercept": math.nan, "calibration_slope": math.nan}
            det = r[2] * r[4] - r[3] * r[3]
            if not det > 1e-300:
                break
            da, db = (r[4] * r[0] - r[3] * r[1]) / det, (r[2] * r[1] - r[3] * r[0]) / det
            scale = min(1.0, 5.0 / max(abs(da), abs(db), 1e-300))
            a, b = a + scale * da, b + scale * db
            if max(abs(da), abs(db)) < 1e-10:
                break
    finally:
        rows.unpersist()
    return {"calibration_intercept": a, "calibration_slope": b}


def evaluate(scored: DataFrame, steps: int = 200) -> dict:
    """All metrics of a split, as plain values.

    ``scored`` is ranked once; what order says is read from the ranking, by row or by score.
    """
    ranked = ranking(scored)
    n = ranked.agg(F.count(F.lit(1)).alias("rows"), F.sum("y").cast("long").alias("positive_cases"), F.avg("y").alias("positive_rate")).first().asDict()
    by_score = materialised(score_groups(ranked), "scores")
    groups = _with_totals(by_score, ranked)
    error = (F.sum(F.col("pos") * (1 - F.col("score")) ** 2 + (F.col("all") - F.col("pos")) * F.col("score") ** 2) / F.sum("all")).alias("brier_score")
    one = groups.agg(*_auc(groups), _precision(groups), error, *_summary()).first().asDict()
    summary = {k: one.pop(k) for k in ("min", *QUANTILES, "mean", "max")}
    return n | one | _with_totals(ranked, ranked).agg(_gap()).first().asDict() | {
        "probability_summary": summary, "deciles": [r.asDict() for r in decile_table(ranked, ranked=ranked).orderBy("decile").collect()],
    } | _newton(by_score, steps)
