"""Profiles of raw files and of the table of feature definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.functions.names import classify
from casemill.session import exists, listed, size_of
from casemill.sources.tables import footers, row_counts

# Key columns, and the names that the columns of a table of definitions may have.
KEYS = ("case_id", "num_group1", "num_group2", "target", "date_decision", "WEEK_NUM", "MONTH")
NAME_COLUMNS = ("Variable", "variable", "feature", "feature_name")
TEXT_COLUMNS = ("Description", "description")
FILE_SCHEMA = "file_name string, file_size_bytes long, row_count long, column_count int, logical_family string, depth int, key_columns array<string>, columns array<string>, types array<string>"


def file_profiles(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A row for each file: footers are read many at a time, and all rows counted by one job."""
    rows = row_counts(spark, paths)
    out = []
    for path, schema in zip(paths, footers(spark, paths), strict=True):
        name = path.rsplit("/", 1)[-1]
        family, depth = classify(name)
        types = [f.dataType.simpleString() for f in schema]
        out.append((name, size_of(spark, path), rows[path], len(schema), family, depth, [c for c in KEYS if c in schema.names], schema.names, types))
    return spark.createDataFrame(out, FILE_SCHEMA)


def definitions_frame(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """name and description of the defined features, where both are given."""
    df = definitions_frame(spark, path)
    name = next((c for c in NAME_COLUMNS if c in df.columns), None)
    text = next((c for c in TEXT_COLUMNS if c in df.columns), None)
    if name is None or text is None:
        raise ValueError(f"{path} has no column for names or descriptions: {df.columns}")
    return df.select(F.col(name).alias("name"), F.col(text).alias("description")).dropna()


def definitions_profile(spark: SparkSession, path: str) -> dict:
    df = definitions_frame(spark, path)
    return {
        "file_name": path.rsplit("/", 1)[-1], "file_size_bytes": size_of(spark, path), "row_count": df.count(), "column_count": len(df.columns),
        "columns": df.columns, "feature_name_column": next((c for c in NAME_COLUMNS if c in df.columns), None),
    }


def build_inventory(spark: SparkSession, folder: str) -> dict:
    folder = folder.rstrip("/")
    paths = listed(spark, f"{folder}/train_*.parquet")
    if not paths:
        raise FileNotFoundError(f"no train_*.parquet in {folder}")
    if not exists(spark, f"{folder}/feature_definitions.csv"):
        raise FileNotFoundError(f"no feature_definitions.csv in {folder}")
    files = file_profiles(spark, paths)
    total = files.agg(F.count(F.lit(1)), F.sum("file_size_bytes"), F.sum("row_count")).first()
    return {
        "raw_dir": folder, "table_count": total[0], "total_parquet_size_bytes": total[1], "total_rows": total[2],
        "tables": [r.asDict() for r in files.collect()], "feature_definitions": definitions_profile(spark, f"{folder}/feature_definitions.csv"),
    }
