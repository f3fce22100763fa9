"""Assembly of features into one row for each case.

Histories are aggregated by case before anything is joined, so each join is one row to one row, and
all of them share the key ``case_id``.  Days before the decision are linear in the date: the history
aggregates dates alone, and the decision date comes in after the join.  So no history is joined
row by row with the base, and a case with very many records is summed up by the tasks that read it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions.values import as_date, days, missing_flag
from casemill.plans.specs import FeatureSpec, by_family, by_table, declared_type, is_static

SET_VALUES, BIT_VALUES = 10_000, 60
BASE = ["case_id", "target", "date_decision", "WEEK_NUM", "MONTH"]


def base_frame(base: DataFrame, limit: int | None = None) -> DataFrame:
    """The base columns; with a limit the cases of smallest id."""
    cases = base.select(*[c for c in BASE if c in base.columns])
    return cases if limit is None else cases.orderBy("case_id").limit(limit)


def one_per_case(df: DataFrame) -> DataFrame:
    """One row for each case: the least by all columns, so that the choice is the same each time.

    It is an aggregate, so tasks shuffle one row of each case at most and nothing is ranked.
    """
    rest = [c for c in df.columns if c != "case_id"]
    if not rest:
        return df.distinct()
    least = df.groupBy("case_id").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_least"))
    return least.select(*["case_id" if c == "case_id" else F.col("_least").getField(c).alias(c) for c in df.columns])


def _number(name: str, step: str) -> Column:
    c = F.col(f"`{name}`")
    return {"min": F.min, "mean": F.avg, "max": F.max, "std": F.stddev_samp, "sum": lambda c: F.sum(c.cast("double"))}[step](c).cast("double")


def distinct_ways(history: DataFrame, columns: list[str], most: int = SET_VALUES) -> dict[str, Callable[[Column], Column]]:
    """How to count distinct values of each column.

    Several exact distinct counts cost a copy of each row for each of them.  A text column that has
    few values in the whole table is counted by bits, one for each value, which a hash aggregate can
    hold; one with at most about ``most`` by sets, which are bounded so; only the rest exactly so.
    """
    if not columns:
        return {}
    n = history.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    few = [c for c in columns if n[c] <= BIT_VALUES // 2 and isinstance(history.schema[c].dataType, T.StringType)]
    values = history.agg(*[F.collect_set(F.col(f"`{c}`")).alias(c) for c in few]).first() if few else {}
    out: dict[str, Callable[[Column], Column]] = {}
    for c in columns:
        if c in few and len(values[c]) <= BIT_VALUES:
            out[c] = _by_bits(sorted(values[c]))
        else:
            out[c] = (lambda x: F.size(F.collect_set(x))) if n[c] <= most and len(columns) > 1 else F.count_distinct
    return out


def _by_bits(values: list[str]) -> Callable[[Column], Column]:
    """Counts distinct values among the given ones; null is none."""
    if not values:
        return lambda c: F.count(c) * 0
    known = F.array(*map(F.lit, values))

    def count(c: Column) -> Column:
        place = (F.array_position(known, c) - 1).cast("int")
        return F.bit_count(F.coalesce(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)), F.lit(0).cast("long")))

    return count


def history_features(history: DataFrame, specs: list[FeatureSpec], *, distinct: Callable[[Column], Column] | None = None) -> tuple[DataFrame, dict[str, Callable[[Column], Column]]]:
    """(a row for each case of the history, what is left to do with the day number of the decision).

    ``distinct`` sets how distinct values are counted; by default ``distinct_ways`` decides.
    """
    ways = {} if distinct else distinct_ways(history, [s.source_columns[0] for s in specs if s.transformation == "n_distinct"])
    kinds = {f.name: f.dataType for f in history.schema}
    out, later = [], {}
    for s in specs:
        name = s.source_columns[0]
        if s.transformation == "count":
            agg = F.count(F.lit(1)).cast("double")
        elif s.transformation == "n_distinct":
            agg = ways.get(name, distinct)(F.col(f"`{name}`")).cast("double")
        elif s.transformation.endswith("_days_before_decision"):
            day = days(F.col(f"`{name}`"), kinds[name])
            if s.transformation[:3] == "min":
                agg, after = F.max(day), lambda c, d: (d - c).cast("double")
            elif s.transformation[:3] == "max":
                agg, after = F.min(day), lambda c, d: (d - c).cast("double")
            else:
                agg = F.struct(F.sum(day.cast("long")).alias("s"), F.count(day).alias("n"))
                after = lambda c, d: F.when(c["n"] > 0, (d * c["n"] - c["s"]).cast("double") / c["n"])
            later[s.feature_name] = after
        else:
            agg = _number(name, s.transformation)
        out.append(agg.alias(s.feature_name))
    return history.groupBy("case_id").agg(*out), later


def _static_column(s: FeatureSpec) -> Column:
    c = F.col(f"`{s.source_columns[0]}`")
    return missing_flag(c) if s.transformation == "is_missing" else c


def assemble(base: DataFrame, tables: dict[str, DataFrame], specs: Iterable[FeatureSpec], *, limit: int | None = None, missing_in_source: bool = False, distinct: Callable[[Column], Column] | None = None) -> DataFrame:
    """The base columns and all features, a row for each case.

    A case without rows in a history has null in all its features.  ``is_missing`` is 1 where a
    static table has no row for the case, or null if ``missing_in_source``.  With a ``limit`` only the
    histories of the chosen cases are read on.
    """
    out = base_frame(base, limit)
    wanted = F.broadcast(out.select("case_id")) if limit is not None and limit <= 100_000 else out.select("case_id")
    later: dict[str, Callable] = {}
    names = [c for c in out.columns]
    for table, own in by_table(specs).items():
        source = tables[table].where(F.col("case_id").isNotNull())
        if limit is not None:
            source = source.join(wanted, "case_id", "left_semi")
        if is_static(table):
            columns = sorted({s.source_columns[0] for s in own})
            part = one_per_case(source.select("case_id", *[F.col(f"`{c}`") for c in columns]))
            if missing_in_source:
                part = part.select("case_id", *[_static_column(s).alias(s.feature_name) for s in own])
            else:
                kept = {c: f"_{table}_{i}" for i, c in enumerate(columns)}
                part = part.select("case_id", *[F.col(f"`{c}`").alias(k) for c, k in kept.items()])
                for s in own:
                    c = kept[s.source_columns[0]]
                    later[s.feature_name] = lambda _, d, c=c, s=s: missing_flag(F.col(c)) if s.transformation == "is_missing" else F.col(c)
        else:
            part, after = history_features(source, own, distinct=distinct)
            later |= after
        out = out.join(part, "case_id", "left")
        names += [s.feature_name for s in own]
    day = F.unix_date(as_date(F.col("date_decision"), base.schema["date_decision"].dataType)).cast("long")
    return out.select(*[later[n](F.col(f"`{n}`") if n in out.columns else None, day).alias(n) if n in later else F.col(f"`{n}`") for n in names])


def family_frame(base: DataFrame, tables: dict[str, DataFrame], specs: Iterable[FeatureSpec], family: str, *, limit: int | None = None) -> DataFrame:
    """case_id and the features of one family, in sorted order and with the declared types."""
    own = by_family(specs)[family]
    wide = assemble(base, tables, own, limit=limit, missing_in_source=True)
    return wide.select("case_id", *[F.col(f"`{s.feature_name}`").cast(declared_type(s, tables[s.source_table].schema)) for s in own])


def expected_schema(base: DataFrame, tables: dict[str, DataFrame], specs: list[FeatureSpec]) -> T.StructType:
    return T.StructType([base.schema["case_id"], *[T.StructField(s.feature_name, declared_type(s, tables[s.source_table].schema)) for s in specs]])
