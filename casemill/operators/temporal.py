"""Chronological split by week."""

from __future__ import annotations

from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")
SHIFT = 0.02


@dataclass(frozen=True)
class Boundary:
    train_start_week: int
    train_end_week: int
    validation_start_week: int
    validation_end_week: int
    test_start_week: int
    test_end_week: int


def _daily(labels: DataFrame, *by: str) -> DataFrame:
    """Counts by date.

    Dates are texts, whose least and greatest Spark finds by sorting; over a row for each date that
    costs nothing, and the pass over all rows is a hash aggregate of counts.
    """
    return labels.groupBy(*by, "date_decision").agg(F.count(F.lit(1)).alias("_n"), F.sum("target").alias("_pos"), F.count("target").alias("_known"))


def _summed() -> dict[str, Column]:
    known = F.sum("_known")
    return {
        "rows": F.sum("_n"), "positive_cases": F.coalesce(F.sum("_pos"), F.lit(0)).cast("long"), "default_rate": F.when(known > 0, F.sum("_pos").cast("double") / known),
        "first": F.min("date_decision"), "last": F.max("date_decision"),
    }


def weekly_profile(labels: DataFrame) -> DataFrame:
    """Rows, positives, rate and dates of each week, with running counts and shares."""
    names = {"rows": "row_count", "first": "min_date_decision", "last": "max_date_decision"}
    weekly = _daily(labels, "WEEK_NUM").groupBy("WEEK_NUM").agg(*[c.alias(names.get(k, k)) for k, c in _summed().items()])
    upto = Window.orderBy("WEEK_NUM").rowsBetween(Window.unboundedPreceding, 0)  # a row for each week
    total = F.sum("row_count").over(Window.partitionBy())
    return weekly.withColumn("cumulative_row_count", F.sum("row_count").over(upto)).withColumn("cumulative_pct", F.col("cumulative_row_count") / total)


def choose_boundaries(profile: DataFrame, train: float = 0.70, validation: float = 0.15) -> Boundary:
    """Ends of train and validation: the weeks whose running shares are nearest, each split keeping a week."""
    rows = profile.where(F.col("WEEK_NUM").isNotNull()).orderBy("WEEK_NUM").select("WEEK_NUM", "cumulative_pct").collect()  # a row for each week
    if len(rows) < 3:
        raise ValueError(f"a split needs three weeks at least; there are {len(rows)}")
    week, share = [int(r[0]) for r in rows], [r[1] for r in rows]

    def nearest(x: float) -> int:
        return min(range(len(share)), key=lambda i: abs(share[i] - x))

    a = min(nearest(train), len(week) - 3)
    b = max(a + 1, min(nearest(train + validation), len(week) - 2))
    return Boundary(week[0], week[a], week[a + 1], week[b], week[b + 1], week[-1])


def split_column(b: Boundary, week: Column | str = "WEEK_NUM") -> Column:
    w = F.col(week) if isinstance(week, str) else week
    return F.when(w <= b.train_end_week, "train").when(w <= b.validation_end_week, "validation").otherwise("test")


def split_labels(labels: DataFrame, b: Boundary) -> DataFrame:
    return labels.select("case_id", split_column(b).alias("split"), "WEEK_NUM", "date_decision", "target")


def split_diagnostics(split: DataFrame) -> DataFrame:
    """Counts, rates and ranges of each split; null case ids count as one value."""
    names = {"first": "date_start", "last": "date_end"}
    weeks = (F.min("WEEK_NUM").alias("week_start"), F.max("WEEK_NUM").alias("week_end"))
    out = _daily(split, "split", "WEEK_NUM").groupBy("split").agg(*[c.alias(names.get(k, k)) for k, c in _summed().items()], *weeks)
    unique = split.groupBy("split").agg(F.count_distinct(F.struct("case_id")).alias("unique_case_ids"))
    out = out.join(F.broadcast(unique), "split")  # a row for each split
    return out.withColumn("row_pct", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def checked_diagnostics(split: DataFrame) -> dict[str, dict]:
    found = {r["split"]: r.asDict() for r in split_diagnostics(split).collect()}
    for s in SPLITS:
        if s not in found:
            raise ValueError(f"split {s} has no rows")
    return {s: found[s] for s in SPLITS}


def overlapping_weeks(split: DataFrame) -> DataFrame:
    return split.groupBy("WEEK_NUM").agg(F.count_distinct("split").alias("_n")).where("_n > 1").select("WEEK_NUM")


def validation(split: DataFrame, b: Boundary) -> DataFrame:
    """One row: whether each case is assigned once, weeks don't overlap, and splits follow in time."""
    counts = split.agg(F.count(F.lit(1)).alias("assigned_rows"), F.count_distinct(F.struct("case_id")).alias("unique_case_ids"))
    weeks = overlapping_weeks(split).agg(F.count(F.lit(1)).alias("overlapping_weeks"))
    ordered = b.train_end_week < b.validation_start_week and b.validation_end_week < b.test_start_week
    return counts.crossJoin(weeks).select(
        "assigned_rows", "unique_case_ids", (F.col("assigned_rows") == F.col("unique_case_ids")).alias("every_case_assigned_once"),
        (F.col("assigned_rows") - F.col("unique_case_ids")).alias("duplicate_case_id_count"), "overlapping_weeks", (F.col("overlapping_weeks") == 0).alias("no_overlapping_weeks"), F.lit(ordered).alias("chronological_ordering"),
    )


def target_drift(split: DataFrame) -> DataFrame:
    """Differences of the default rates between the splits; material from ``SHIFT`` up."""
    rates = split.groupBy().pivot("split", list(SPLITS)).agg(F.avg("target"))
    pairs = (("train", "validation"), ("train", "test"), ("validation", "test"))
    out = rates.select(*[F.abs(F.col(b) - F.col(a)).alias(f"{a}_{b}_abs_diff") for a, b in pairs])
    out = out.withColumn("max_abs_diff", F.greatest(*out.columns))
    return out.withColumn("material_shift", F.col("max_abs_diff") >= SHIFT)


def temporal_split(labels: DataFrame, train: float = 0.70, validation_share: float = 0.15) -> tuple[DataFrame, Boundary]:
    """The split labels and the boundary; an error where the split would not hold."""
    b = choose_boundaries(weekly_profile(labels), train, validation_share)
    split = split_labels(labels, b)
    v = validation(split, b).first()
    for test in ("every_case_assigned_once", "no_overlapping_weeks", "chronological_ordering"):
        if not v[test]:
            raise ValueError(f"temporal split: {test} is false")
    return split, b


def split_overlaps(split: DataFrame) -> DataFrame:
    """Cases that two splits share, by pair; all from one count by case."""
    sets = split.groupBy("case_id").agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in SPLITS])
    pairs = (("train", "validation"), ("train", "test"), ("validation", "test"))
    return sets.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("long").alias(f"{a}_{b}") for a, b in pairs])


def week_range(split: DataFrame, name: str) -> tuple[int, int]:
    low, high = split.where(F.col("split") == name).agg(F.min("WEEK_NUM"), F.max("WEEK_NUM")).first()
    if low is None:
        raise ValueError(f"split {name} has no weeks")
    return int(low), int(high)


def split_scan(modeling: DataFrame, split: DataFrame, name: str, columns: list[str], *, row_limit: int | None = None) -> DataFrame:
    """case_id, target and ``columns`` of a split: by its range of weeks, which a scan can push down.

    With a limit, the first cases by week and id, in that order.
    """
    wanted = ["case_id", "target", *[c for c in columns if c not in ("case_id", "target")]]
    low, high = week_range(split, name)
    rows = modeling.where(F.col("WEEK_NUM").between(low, high))
    if row_limit is None:
        return rows.select(*wanted)
    # Only the two columns of the order go through one task; the wide rows are then found by the last of them.
    order = F.struct("WEEK_NUM", "case_id")
    last = rows.select("WEEK_NUM", "case_id").orderBy("WEEK_NUM", "case_id").limit(row_limit).agg(F.max(order).alias("last")).first()["last"]
    if last is None:
        return rows.limit(0).select(*wanted)
    upto = (F.col("WEEK_NUM") < last["WEEK_NUM"]) | ((F.col("WEEK_NUM") == last["WEEK_NUM"]) & (F.col("case_id") <= last["case_id"]))
    return rows.where(upto).orderBy("WEEK_NUM", "case_id").select(*wanted)


def expected_rows(split: DataFrame, name: str, row_limit: int | None = None) -> int:
    found = expected_row_counts(split, row_limit).where(F.col("split") == name).first()
    return found["rows"] if found else 0


def expected_row_counts(split: DataFrame, row_limit: int | None = None) -> DataFrame:
    """split and rows: how many of each split a scan gives."""
    n = F.count(F.lit(1))
    return split.groupBy("split").agg((n if row_limit is None else F.least(n, F.lit(row_limit))).alias("rows"))


def config(b: Boundary, split: DataFrame, labels: DataFrame) -> dict:
    """What a split is described by, as plain values."""
    names = ["train_start_week", "train_end_week", "validation_start_week", "validation_end_week", "test_start_week", "test_end_week"]
    ends = labels.agg(F.min("date_decision"), F.max("date_decision"), F.min("WEEK_NUM"), F.max("WEEK_NUM")).first()
    return {
        "target_split_pct": {"train": 0.70, "validation": 0.15, "test": 0.15}, "week_boundaries": dict(zip(names, astuple(b), strict=True)),
        "date_decision_min": str(ends[0]), "date_decision_max": str(ends[1]), "week_num_min": ends[2], "week_num_max": ends[3],
        "weekly_profile": [r.asDict() for r in weekly_profile(labels).orderBy("WEEK_NUM").collect()],
        "split_diagnostics": checked_diagnostics(split), "target_drift": target_drift(split).first().asDict(), "validation": validation(split, b).first().asDict(),
    }
