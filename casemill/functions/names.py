"""Names of tables and features."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name markers of the table families, tried in this order.
FAMILY_MARKERS = (
    ("base", "base"), ("static_cb", "static_credit_bureau"), ("static", "static"), ("applprev", "previous_application"),
    ("credit_bureau_a", "credit_bureau_a"), ("credit_bureau_b", "credit_bureau_b"), ("debitcard", "debit_card"), ("deposit", "deposit"),
    ("person", "person"), ("other", "other"), ("tax_registry_a", "tax_registry_a"), ("tax_registry_b", "tax_registry_b"), ("tax_registry_c", "tax_registry_c"),
)


def name_part(text: str) -> str:
    """Lower case, every run of other than letters and digits one underscore, none at the ends."""
    return "_".join(re.findall(r"[^\W_]+", text.lower()))


def name_part_column(text: Column) -> Column:
    """``name_part`` of a column, for ASCII texts."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^0-9a-z]+", "_"), "^_|_$", "")


def feature_name(table: str, column: str, transformation: str) -> str:
    return "__".join(map(name_part, (table, column, transformation)))


def logical_name(file_name: str) -> str:
    """The table that a file belongs to: no ``train_``, and of two trailing numbers only the first."""
    stem = re.sub(r"\.parquet$", "", file_name.rsplit("/", 1)[-1]).removeprefix("train_")
    return re.sub(r"_(\d+)_\d+$", r"_\1", stem)


def classify(file_name: str) -> tuple[str, int | None]:
    """(family, depth) by the name of a file."""
    name = re.sub(r"\.parquet$", "", file_name.rsplit("/", 1)[-1]).removeprefix("train_")
    depth = re.search(r"_(\d)(?:_\d+)?$", name)
    family = next((f for marker, f in FAMILY_MARKERS if f"{name}_".startswith(f"{marker}_")), "unknown")
    return family, int(depth[1]) if depth else None


def depth_label(table: str) -> str:
    return "base" if table == "base" else {"_0": "depth 0", "_1": "depth 1", "_2": "depth 2"}.get(table[-2:], "unknown")


def repeat_label(table: str) -> str:
    return {"base": "static", "depth 0": "static", "depth 1": "repeated/history-based", "depth 2": "repeated/history-based"}.get(depth_label(table), "ambiguous")


def grain(columns: list[str]) -> list[str]:
    """The columns that are expected to identify a row."""
    return ["case_id", *[c for c in ("num_group1", "num_group2") if c in columns]]
