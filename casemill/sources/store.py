"""A store of tables as folders of Parquet: ingest, reconcile, promote, records, reset.

Layout: ``<root>/<schema>/<table>/v<number>-<id>``.  A load is written to ``<root>/<schema>/__load_<table>_<id>``,
reconciled with its sources, and then renamed to the next version of its table.  The table is its
latest version, so that one rename replaces it and a crash at any point leaves it whole, old or new.
Older versions go after that, or with ``cleanup``.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.session import hadoop, listed, remove, rename
from casemill.sources.tables import LogicalTable, blanks_as_nulls, chosen, discover, row_counts

SCHEMAS = ("raw", "staging", "features", "analytics", "monitoring")
RECORDS = {
    "ingestion_runs": "run_id string, status string, started_at timestamp, finished_at timestamp, error_message string",
    "ingested_tables": "run_id string, table_name string, status string, source_rows long, loaded_rows long, started_at timestamp, finished_at timestamp, error_message string",
    "ingested_files": "run_id string, table_name string, path string, source_rows long, loaded_rows long, status string, error_message string",
}


class ReconciliationError(ValueError):
    pass


def reconciliation(expected_rows: int, rows: int, expected: list[str], columns: list[str], keys=("case_id",)) -> dict:
    """Whether a load has the rows, the columns in order, and the keys that it should have."""
    out = {"row_count": rows == expected_rows, "columns": list(columns) == list(expected), "keys": all(k in columns for k in keys if k in expected)}
    return out | {"ok": all(out.values())}


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str, schema: str = "raw") -> str:
        return f"{self.root}/{schema}/{table}"

    def versions(self, table: str, schema: str = "raw") -> list[str]:
        """The paths of all versions of a table, oldest first."""
        return listed(self.spark, f"{self.path(table, schema)}/v*")

    def current(self, table: str, schema: str = "raw") -> str:
        found = self.versions(table, schema)
        if not found:
            raise FileNotFoundError(f"no table {schema}.{table} in {self.root}")
        return found[-1]

    def read(self, table: str, schema: str = "raw") -> DataFrame:
        return self.spark.read.parquet(self.current(table, schema))

    def write(self, df: DataFrame, table: str, schema: str = "features") -> DataFrame:
        """Replaces a derived table (drop and create as select)."""
        load = self.path(f"__load_{table}_{uuid.uuid4().hex}", schema)
        df.write.parquet(load)
        self._promote(load, table, schema)
        return self.read(table, schema)

    def initialize(self) -> None:
        for schema in SCHEMAS:
            fs, p = hadoop(self.spark, f"{self.root}/{schema}")
            fs.mkdirs(p)
        for name, ddl in RECORDS.items():
            if not self.versions(name, "monitoring"):
                self.write(self.spark.createDataFrame([], ddl), name, "monitoring")

    # -- records ---------------------------------------------------------------------------------

    def records(self, name: str) -> DataFrame:
        return self.spark.read.schema(RECORDS[name]).parquet(self.current(name, "monitoring"))

    def _record(self, name: str, rows: list[tuple]) -> None:
        if rows:
            self.spark.createDataFrame(rows, RECORDS[name]).coalesce(1).write.mode("append").parquet(self.current(name, "monitoring"))

    def last_run(self) -> DataFrame:
        return self.records("ingestion_runs").orderBy(F.desc_nulls_last("finished_at"), F.desc("started_at")).limit(1)

    # -- ingest ----------------------------------------------------------------------------------

    def _promote(self, load: str, table: str, schema: str = "raw") -> None:
        """Makes a load the latest version of its table, by one rename."""
        before = self.versions(table, schema)
        number = int(before[-1].rsplit("/v", 1)[1].split("-")[0]) + 1 if before else 1
        fs, folder = hadoop(self.spark, self.path(table, schema))
        fs.mkdirs(folder)
        rename(self.spark, load, f"{self.path(table, schema)}/v{number:010d}-{uuid.uuid4().hex}")
        for old in before:
            remove(self.spark, old)

    def _ingest(self, table: LogicalTable) -> tuple[int, int, list[tuple[str, int, int | None]]]:
        load = self.path(f"__load_{table.name}_{uuid.uuid4().hex}")
        try:
            blanks_as_nulls(table.read(self.spark)).write.parquet(load)
            loaded = self.spark.read.parquet(load)
            files = row_counts(self.spark, list(table.paths), table.schema)
            source, rows = sum(files.values()), loaded.count()
            check = reconciliation(source, rows, table.columns, loaded.columns)
            if not check["ok"]:
                raise ReconciliationError(f"{table.name}: {[k for k, v in check.items() if not v]}")
            self._promote(load, table.name)
        except BaseException:
            remove(self.spark, load)
            raise
        # The rows of a load are counted as a whole; those of one file among several aren't known.
        return source, rows, [(p, n, rows if len(files) == 1 else None) for p, n in files.items()]

    def ingest(self, folder: str, names: list[str] | None = None) -> str:
        """Loads the tables of a folder.  A failure fails the run; tables promoted before it stay."""
        self.initialize()
        run, began = uuid.uuid4().hex, datetime.now(UTC)
        tables, files, error = [], [], None
        try:
            for table in chosen(discover(self.spark, folder), names):
                start = datetime.now(UTC)
                try:
                    source, rows, parts = self._ingest(table)
                except BaseException as e:
                    error = str(e)
                    tables.append((run, table.name, "failed", None, None, start, datetime.now(UTC), error[:2000]))
                    files += [(run, table.name, p, None, None, "failed", error[:2000]) for p in table.paths]
                    raise
                tables.append((run, table.name, "success", source, rows, start, datetime.now(UTC), None))
                files += [(run, table.name, p, a, b, "success", None) for p, a, b in parts]
        except BaseException as e:
            error = error or str(e)  # the first message stays
            raise
        finally:
            self._record("ingested_tables", tables)
            self._record("ingested_files", files)
            self._record("ingestion_runs", [(run, "failed" if error else "success", began, datetime.now(UTC), error and error[:2000])])
        return run

    def reset(self, names: list[str] | None = None) -> None:
        """Drops raw tables and their records: these, or all."""
        if names is None:
            for schema in ("raw", "monitoring"):
                remove(self.spark, f"{self.root}/{schema}")
            return self.initialize()
        for name in names:
            remove(self.spark, self.path(name))
        for record in ("ingested_tables", "ingested_files"):
            self.write(self.records(record).where(~F.col("table_name").isin(names)), record, "monitoring")
        used = self.records("ingested_tables").select("run_id").distinct()
        self.write(self.records("ingestion_runs").join(used, "run_id", "left_semi"), "ingestion_runs", "monitoring")
        return None

    def cleanup(self) -> list[str]:
        """Deletes loads that never became a version, and versions before the latest; returns the names."""
        left = [p for schema in SCHEMAS for p in listed(self.spark, f"{self.root}/{schema}/__load_*")]
        for schema in SCHEMAS:
            for table in listed(self.spark, f"{self.root}/{schema}/*"):
                left += listed(self.spark, f"{table}/v*")[:-1]
        for p in left:
            remove(self.spark, p)
        return [p.rsplit("/", 1)[-1] for p in left]

    def validate(self, folder: str, names: list[str] | None = None) -> list[dict]:
        """How the loaded tables agree with the files of a folder: rows, columns and keys of each."""
        out = []
        for table in chosen(discover(self.spark, folder), names):
            here = {"table": table.name, "loaded": bool(self.versions(table.name))}
            if here["loaded"]:
                loaded = self.read(table.name)
                source, rows = sum(row_counts(self.spark, list(table.paths), table.schema).values()), loaded.count()
                here |= {"source_rows": source, "loaded_rows": rows} | reconciliation(source, rows, table.columns, loaded.columns)
            out.append({"ok": False} | here)
        return out

    def staging_views(self) -> list[str]:
        """Temporary views staging_<name> over the base table and the records."""
        views = {"base": self.read("base")} | {f"raw_{n}": self.records(n) for n in RECORDS}
        for name, df in views.items():
            df.createOrReplaceTempView(f"staging_{name}")
        return sorted(f"staging_{n}" for n in views)
