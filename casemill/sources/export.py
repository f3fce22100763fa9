"""Export of feature families as Parquet, their join, and its validation."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.plans.assemble import BASE, base_frame, expected_schema, family_frame
from casemill.plans.specs import FeatureSpec, by_family
from casemill.session import exists, listed, read_text, remove, rename, write_text

# The files of the families, in the order of the join.
SLUGS = {
    "static applicant/bureau snapshots": "static_features", "previous applications": "previous_application_features", "credit bureau histories": "credit_bureau_features",
    "person/participant histories": "person_features", "debit/deposit/other histories": "debit_deposit_other_features", "tax registry histories": "tax_registry_features",
}
BASE_FILE = "base_labels"


class ExportError(ValueError):
    pass


def settle(spark: SparkSession, path: str) -> None:
    """After a crash between the renames of a write: the old data come back, what is left over goes."""
    path = path.rstrip("/")
    old = listed(spark, f"{path}.old-*")
    if old and not exists(spark, path):
        rename(spark, old.pop(), path)
    for left in [*old, *listed(spark, f"{path}.tmp-*")]:
        remove(spark, left)


def _replace(spark: SparkSession, aside: str, path: str) -> None:
    """Puts ``aside`` in the place of ``path``; if that fails, the old data stay there."""
    old = f"{path}.old-{uuid.uuid4().hex}"
    had = exists(spark, path)
    try:
        if had:
            rename(spark, path, old)
        rename(spark, aside, path)
    except BaseException:
        if had and exists(spark, old):
            rename(spark, old, path)
        remove(spark, aside)
        raise
    if had:
        remove(spark, old)


def write_checked(df: DataFrame, path: str, schema: T.StructType | None = None, *, compression: str = "zstd") -> int:
    """Writes to a folder aside, then renames; on failure the old data stay and nothing is left.

    The columns must be those of ``schema``, in order and type.  Returns the number of rows.  A process
    that is killed between the two renames leaves the old data aside, and ``settle`` puts them back.
    """
    if schema is not None:
        want, have = [(f.name, f.dataType) for f in schema], [(f.name, f.dataType) for f in df.schema]
        if want != have:
            raise ExportError(f"columns of {path} differ from the declared ones: {[x for x in have if x not in want][:5]}, {[x for x in want if x not in have][:5]}")
    spark, path = df.sparkSession, path.rstrip("/")
    settle(spark, path)
    aside = f"{path}.tmp-{uuid.uuid4().hex}"
    try:
        df.write.option("compression", compression).parquet(aside)
        n = spark.read.parquet(aside).count()  # of footers
    except BaseException:
        remove(spark, aside)
        raise
    _replace(spark, aside, path)
    return n


def write_batches(spark: SparkSession, batches: Iterable[list[tuple]], schema: T.StructType, path: str, *, compression: str = "zstd", rows_at_once: int = 100_000) -> int:
    """Rows that come in small batches, under one declared schema; a file for many batches, in place at the end."""
    path = path.rstrip("/")
    settle(spark, path)
    aside, n, held = f"{path}.tmp-{uuid.uuid4().hex}", 0, []

    def put() -> None:
        spark.createDataFrame(held, schema).coalesce(1).write.mode("append").option("compression", compression).parquet(aside)
        held.clear()

    try:
        for rows in batches:
            held += rows
            n += len(rows)
            if len(held) >= rows_at_once:
                put()
        if held or not n:
            put()
    except BaseException:
        remove(spark, aside)
        raise
    _replace(spark, aside, path)
    return n


@dataclass
class Exporter:
    """Exports a base and its feature families to a folder; what is done is skipped next time.

    The manifest is written after each family, so that a crash forgets none.  It keeps smoke and full
    exports apart, so that neither undoes the other.
    """

    spark: SparkSession
    root: str
    smoke_limit: int | None = None
    compression: str = "zstd"
    manifest: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        if exists(self.spark, f"{self.root}/manifest.json"):
            self.manifest = json.loads(read_text(self.spark, f"{self.root}/manifest.json"))

    @property
    def smoke(self) -> bool:
        return self.smoke_limit is not None

    def key(self, slug: str) -> str:
        return f"{slug}{'_smoke' if self.smoke else ''}"

    def path(self, slug: str) -> str:
        return f"{self.root}/{self.key(slug)}.parquet"

    def done(self, slug: str) -> bool:
        m = self.manifest.get(self.key(slug), {})
        if m.get("completion_status") != "success" or m.get("smoke_limit") != self.smoke_limit:
            return False
        settle(self.spark, self.path(slug))
        return exists(self.spark, self.path(slug))

    def entries(self) -> dict[str, dict]:
        """What the manifest holds of exports of this kind, by family file."""
        return {v["family_file"]: v for v in self.manifest.values() if v["smoke"] == self.smoke}

    def _one(self, slug: str, make, schema: T.StructType, force: bool) -> str:
        if self.done(slug) and not force:
            return "skipped"
        entry = {"family_file": slug, "path": self.path(slug), "smoke": self.smoke, "smoke_limit": self.smoke_limit}
        try:
            df = make()
            entry |= {"row_count": write_checked(df, self.path(slug), schema, compression=self.compression), "column_count": len(df.columns), "columns": df.columns, "completion_status": "success"}
            return "success"
        except BaseException as e:
            entry |= {"completion_status": "failed", "error": str(e)[:500]}
            raise
        finally:
            self.manifest[self.key(slug)] = entry
            write_text(self.spark, f"{self.root}/manifest.json", json.dumps(self.manifest, indent=2, sort_keys=True))

    def validate(self, base_rows: int, specs: list[FeatureSpec]) -> list[dict]:
        """For the base and each family: whether its files have the rows, columns and cases that they should have."""
        out = []
        for slug, wanted in [(BASE_FILE, None), *((SLUGS[f], own) for f, own in by_family(specs).items() if f in SLUGS)]:
            here = {"file": slug, "exported": self.done(slug)}
            if here["exported"]:
                df = self.spark.read.parquet(self.path(slug))
                n = df.agg(F.count(F.lit(1)), F.count_distinct("case_id")).first()
                columns = wanted is None or df.columns == ["case_id", *[s.feature_name for s in wanted]]
                here |= {"rows": n[0], "one_row_per_case": n[0] == n[1] == base_rows, "columns_match": columns, "manifest_matches": self.manifest[self.key(slug)]["row_count"] == n[0]}
            out.append(here | {"ok": here["exported"] and all(here[k] for k in ("one_row_per_case", "columns_match", "manifest_matches"))})
        return out

    def run(self, base: DataFrame, tables: dict[str, DataFrame], specs: list[FeatureSpec], families: list[str] | None = None, *, force: bool = False) -> dict[str, str]:
        groups = by_family(specs)
        unknown = sorted(set(families or groups) - set(groups)) + sorted(set(families or groups) - set(SLUGS))
        if unknown:
            raise ExportError(f"families that can't be exported: {unknown}")
        labels = base_frame(base, self.smoke_limit)
        out = {BASE_FILE: self._one(BASE_FILE, lambda: labels, labels.schema, force)}
        for family in sorted(families or groups):
            declared = expected_schema(base, tables, groups[family])
            out[SLUGS[family]] = self._one(SLUGS[family], lambda f=family: family_frame(base, tables, specs, f, limit=self.smoke_limit), declared, force)
        return out

    def joined(self, keep: list[str] | None = None) -> DataFrame:
        """The base with all exported families, left joined on case_id in a fixed order.

        With ``keep`` only these features; it is an error if an export lacks one.  Every part has a row
        for each case, however few bytes its file takes, so none is broadcast: all joins are by sorting.
        """
        out = self.spark.read.parquet(self.path(BASE_FILE))
        for slug in SLUGS.values():
            if exists(self.spark, self.path(slug)):
                part = self.spark.read.parquet(self.path(slug))
                part = part if keep is None else part.select("case_id", *[F.col(f"`{c}`") for c in part.columns if c in set(keep)])
                twice = sorted(set(out.columns) & set(part.columns) - {"case_id"})
                if twice:
                    raise ExportError(f"{slug} repeats columns {twice[:5]}")
                out = out.join(part.hint("merge"), "case_id", "left")
        lacking = sorted(set(keep or ()) - set(out.columns))
        if lacking:
            raise ExportError(f"features to keep that no export has: {lacking[:5]}")
        return out


def validate_joined(df: DataFrame, base: DataFrame, specs: list[FeatureSpec]) -> DataFrame:
    """One row: rows, cases, and how the columns follow the specifications."""
    want, have = {s.feature_name for s in specs}, [c for c in df.columns if c not in BASE]
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(F.struct("case_id")).alias("distinct_cases"))
    cases = base.agg(F.count(F.lit(1)).alias("base_rows"))
    return counts.crossJoin(cases).select(
        "row_count", "distinct_cases", F.lit(len(df.columns)).cast("long").alias("column_count"), F.lit(len(want - set(have))).cast("long").alias("missing_columns"),
        F.lit(len(set(have) - want)).cast("long").alias("extra_columns"), F.lit(len(have) - len(set(have))).cast("long").alias("duplicate_columns"),
        ((F.col("row_count") == F.col("distinct_cases")) & (F.col("row_count") == F.col("base_rows"))).alias("one_row_per_case"), F.lit(set(have) == want).alias("lineage_matches"),
    )
