"""Feature specifications, made from the catalog."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

from casemill.functions.names import classify, feature_name
from casemill.plans.catalog import CatalogColumn

# Columns that would leak the outcome, and the group of each table family.
LEAKAGE = frozenset({("base", "target"), ("applprev_1", "approvaldate_319D"), ("static_0", "lastapprdate_640D"), ("static_cb_0", "riskassesment_302T")})
GROUPS = {
    "static": "static applicant/bureau snapshots", "static_credit_bureau": "static applicant/bureau snapshots", "previous_application": "previous applications",
    "credit_bureau_a": "credit bureau histories", "credit_bureau_b": "credit bureau histories", "person": "person/participant histories",
    "debit_card": "debit/deposit/other histories", "deposit": "debit/deposit/other histories", "other": "debit/deposit/other histories",
    "tax_registry_a": "tax registry histories", "tax_registry_b": "tax registry histories", "tax_registry_c": "tax registry histories",
}
NUMBER_STEPS, SUMMED = ("min", "mean", "max", "std"), {"amount", "payment", "count"}
DATE_STEPS = ("min_days_before_decision", "mean_days_before_decision", "max_days_before_decision")
FLAGGED = {"amount", "date/days", "payment"}


@dataclass(frozen=True)
class FeatureSpec:
    feature_name: str
    source_table: str
    source_columns: tuple[str, ...]
    transformation: str
    feature_family: str
    description: str
    leakage_review_status: str = "approved"


def group_of(table: str) -> str:
    return GROUPS.get(classify(table)[0], "other histories")


def is_number(data_type: str) -> bool:
    return data_type in {"tinyint", "smallint", "int", "bigint", "float", "double"} or data_type.startswith("decimal")


def is_static(table: str) -> bool:
    return table.endswith("_0")


def eligible(c: CatalogColumn) -> bool:
    return not (c.is_key_or_grouping_field or c.is_target or c.is_metadata_field or (c.logical_table, c.column_name) in LEAKAGE)


def steps_for(c: CatalogColumn) -> tuple[str, ...]:
    """The transformations of a column: by type first, then dates, then categories."""
    if is_static(c.logical_table):
        return ("direct", "is_missing") if c.semantic_category in FLAGGED else ("direct",)
    if is_number(c.data_type):
        return (*NUMBER_STEPS, "sum") if c.semantic_category in SUMMED else NUMBER_STEPS
    if c.semantic_category == "date/days" or c.data_type == "date":
        return DATE_STEPS
    return ("n_distinct",) if c.data_type == "string" or c.semantic_category == "categorical status" else ()


def registry(columns: Iterable[CatalogColumn]) -> list[FeatureSpec]:
    """All features of all tables but the base, by name."""
    out, repeated = [], set()
    for c in columns:
        table = c.logical_table
        if table == "base":
            continue
        family = group_of(table)
        if not is_static(table) and table not in repeated:
            repeated.add(table)
            out.append(FeatureSpec(feature_name(table, "records", "count"), table, ("case_id",), "count", family, f"Number of {table} records of the case."))
        if eligible(c):
            out += [FeatureSpec(feature_name(table, c.column_name, s), table, (c.column_name,), s, family, f"{s} of {c.column_name}: {c.description or 'meaning ambiguous'}") for s in steps_for(c)]
    return sorted(out, key=lambda s: s.feature_name)


def by_table(specs: Iterable[FeatureSpec]) -> dict[str, list[FeatureSpec]]:
    out: dict[str, list[FeatureSpec]] = {}
    for s in sorted(specs, key=lambda s: (s.source_table, s.feature_name)):
        out.setdefault(s.source_table, []).append(s)
    return out


def by_family(specs: Iterable[FeatureSpec]) -> dict[str, list[FeatureSpec]]:
    out: dict[str, list[FeatureSpec]] = {}
    for s in sorted(specs, key=lambda s: (s.feature_family, s.source_table, s.feature_name)):
        out.setdefault(s.feature_family, []).append(s)
    return out


def family_counts(specs: Iterable[FeatureSpec]) -> dict[str, int]:
    return dict(Counter(s.feature_family for s in specs))


def within_bytes(specs: Iterable[FeatureSpec], most: int | None = None) -> list[FeatureSpec]:
    """Optionally without features whose names some databases would cut off."""
    return [s for s in specs if most is None or len(s.feature_name.encode()) <= most]


def estimated_bytes(cases: int, columns: int) -> int:
    return int(cases * columns * 8 * 1.35)


def declared_type(spec: FeatureSpec, source: T.StructType) -> T.DataType:
    """The type of a feature in exported files."""
    if spec.transformation == "is_missing":
        return T.LongType()
    if spec.transformation != "direct":
        return T.DoubleType()
    kind = source[spec.source_columns[0]].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DoubleType()
    return kind if isinstance(kind, T.BooleanType) else T.StringType()
