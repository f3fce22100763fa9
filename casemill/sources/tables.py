"""Logical tables over partitioned Parquet files."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions.names import logical_name
from casemill.functions.values import blank_to_null
from casemill.session import listed

ATOMIC = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.BinaryType)


class SourceError(ValueError):
    """Files that don't form a table."""


@dataclass(frozen=True)
class LogicalTable:
    name: str
    paths: tuple[str, ...]
    schema: T.StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*self.paths)


def common_schema(schemas: dict[str, T.StructType]) -> T.StructType:
    """The schema of all files: names in order and types must be equal, and types atomic."""
    if not schemas:
        raise SourceError("a table needs at least one file")
    first, wanted = next(iter(schemas.items()))
    for path, schema in schemas.items():
        if schema.names != wanted.names:
            raise SourceError(f"columns of {path} and {first} differ: {schema.names} and {wanted.names}")
        for a, b in zip(schema, wanted, strict=True):
            if a.dataType != b.dataType:
                raise SourceError(f"column {a.name} is {a.dataType.simpleString()} in {path} and {b.dataType.simpleString()} in {first}")
    for field in wanted:
        if not isinstance(field.dataType, ATOMIC):
            raise SourceError(f"column {field.name} has the unsupported type {field.dataType.simpleString()}")
    return wanted


def footers(spark: SparkSession, paths: list[str], at_once: int = 32) -> list[T.StructType]:
    """The schema of each file; many footers are read at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda path: spark.read.parquet(path).schema, paths))


def row_counts(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> dict[str, int]:
    """The rows of each file (or folder of files), by one job that reads no column.

    Files with different columns may be counted together; without a ``schema`` that of the first is used.
    """
    if not paths:
        return {}
    reader = spark.read.schema(schema) if schema is not None else spark.read
    found = reader.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("path")).count().collect()  # a row for each file
    bare = lambda path: re.sub("^[a-z0-9]+:/*", "/", unquote(path)).rstrip("/")
    out, names = dict.fromkeys(paths, 0), {bare(p): p for p in paths}
    for path, n in found:
        parts = bare(path)
        while parts not in names:
            parts = parts.rsplit("/", 1)[0]
        out[names[parts]] += n
    return out


def discover(spark: SparkSession, folder: str, pattern: str = "train_*.parquet") -> list[LogicalTable]:
    """The tables of a folder, by name; only file footers are read."""
    paths = listed(spark, f"{folder.rstrip('/')}/{pattern}")
    if not paths:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    groups: dict[str, dict[str, T.StructType]] = {}
    for path, schema in zip(paths, footers(spark, paths), strict=True):
        groups.setdefault(logical_name(path), {})[path] = schema
    return [LogicalTable(name, tuple(files), common_schema(files)) for name, files in sorted(groups.items())]


def chosen(tables: list[LogicalTable], names: list[str] | None) -> list[LogicalTable]:
    """The tables of these names (all for none), in the order of ``tables``."""
    unknown = sorted(set(names or ()) - {t.name for t in tables})
    if unknown:
        raise SourceError(f"unknown tables: {', '.join(unknown)}")
    return [t for t in tables if not names or t.name in names]


def blanks_as_nulls(df: DataFrame) -> DataFrame:
    """Empty texts become null, in tables of two or more columns."""
    if len(df.columns) < 2:
        return df
    return df.select(*[blank_to_null(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def sample_values(df: DataFrame, order: list[str], limit: int = 5) -> dict[str, list[str]]:
    """Up to ``limit`` values of each column from the first rows in the given order."""
    rows = df.orderBy(*order).limit(limit).select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).collect()
    return {c: [r[c] for r in rows if r[c] is not None] for c in df.columns}
