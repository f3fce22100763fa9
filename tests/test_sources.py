import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.functions import names
from casemill.sources import inventory, store, tables
from casemill.streaming import arrival


def put(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(path))


def test_names():
    got = [names.logical_name(f"/x/train_{n}.parquet") for n in ("base", "other_1", "static_0_1", "credit_bureau_a_1_3", "credit_bureau_a_2_10")]
    assert got == ["base", "other_1", "static_0", "credit_bureau_a_1", "credit_bureau_a_2"]
    assert names.classify("train_base.parquet") == ("base", None) and names.classify("train_person_2.parquet") == ("person", 2)
    assert names.classify("train_static_cb_0.parquet") == ("static_credit_bureau", 0) and names.classify("train_what_1.parquet") == ("unknown", 1)
    assert names.feature_name("static_0", "amt Foo--1A", "is_missing") == "static_0__amt_foo_1a__is_missing"
    assert names.name_part("__É a_b!") == "é_a_b"


def test_discovery(spark, tmp_path):
    put(spark, tmp_path / "train_static_0_0.parquet", [(1, 1.0)], "case_id long, x double")
    put(spark, tmp_path / "train_static_0_1.parquet", [(2, 1.0), (3, None)], "case_id long, x double")
    put(spark, tmp_path / "train_other_1.parquet", [(1, "v")], "case_id long, value string")
    found = {t.name: t for t in tables.discover(spark, str(tmp_path))}
    assert list(found) == ["other_1", "static_0"] and found["static_0"].read(spark).count() == 3
    assert [t.name for t in tables.chosen(list(found.values()), ["static_0"])] == ["static_0"]
    with pytest.raises(tables.SourceError, match="nope"):
        tables.chosen(list(found.values()), ["nope"])
    with pytest.raises(FileNotFoundError):
        tables.discover(spark, str(tmp_path / "none"))


def test_schemas_must_agree():
    a = T.StructType.fromDDL("case_id long")
    with pytest.raises(tables.SourceError, match="columns"):
        tables.common_schema({"a": a, "b": T.StructType.fromDDL("case_id long, extra string")})
    with pytest.raises(tables.SourceError, match="case_id"):
        tables.common_schema({"a": a, "b": T.StructType.fromDDL("case_id string")})
    with pytest.raises(tables.SourceError, match="unsupported"):
        tables.common_schema({"a": T.StructType.fromDDL("case_id long, x array<int>")})
    with pytest.raises(tables.SourceError):
        tables.common_schema({})
    kinds = "a boolean, b short, c int, d long, e float, f double, g decimal(12,2), h date, i timestamp_ntz, j string, k binary"
    assert tables.common_schema({"a": T.StructType.fromDDL(kinds)}).names == list("abcdefghijk")


def test_blanks(spark):
    df = spark.createDataFrame([("", 1), (" ", None), (None, 2)], "a string, b int")
    assert sorted(map(str, (r.a for r in tables.blanks_as_nulls(df).collect()))) == [" ", "None", "None"]
    assert tables.blanks_as_nulls(df.select("a")).where("a = ''").count() == 1


def raw(spark, folder):
    put(spark, folder / "train_base.parquet", [(1, "2020-01-01", 0, 0), (2, "2020-01-08", 1, 1)], "case_id long, date_decision string, WEEK_NUM long, target long")
    put(spark, folder / "train_person_1.parquet", [(1, 0, ""), (2, 0, "b"), (2, 1, None)], "case_id long, num_group1 long, role string")
    (folder / "feature_definitions.csv").write_text('Variable,Description\nrole,"a, b"\nx,\n,y\n')


def test_inventory(spark, tmp_path):
    raw(spark, tmp_path)
    found = inventory.build_inventory(spark, str(tmp_path))
    assert found["table_count"] == 2 and found["total_rows"] == 5
    assert [(t["logical_family"], t["depth"], t["column_count"]) for t in found["tables"]] == [("base", None, 4), ("person", 1, 3)]
    assert found["feature_definitions"]["feature_name_column"] == "Variable" and found["feature_definitions"]["row_count"] == 3
    assert [tuple(r) for r in inventory.read_definitions(spark, str(tmp_path / "feature_definitions.csv")).collect()] == [("role", "a, b")]
    os.remove(tmp_path / "feature_definitions.csv")
    with pytest.raises(FileNotFoundError):
        inventory.build_inventory(spark, str(tmp_path))


def test_store(spark, tmp_path):
    (tmp_path / "in").mkdir()
    raw(spark, tmp_path / "in")
    s = store.Store(spark, str(tmp_path / "store"))
    run = s.ingest(str(tmp_path / "in"))
    assert s.read("person_1").where("role is null").count() == 2
    assert {(r.table_name, r.status, r.loaded_rows) for r in s.records("ingested_tables").collect()} == {("base", "success", 2), ("person_1", "success", 3)}
    assert s.last_run().first().run_id == run and s.records("ingested_files").count() == 2
    s.ingest(str(tmp_path / "in"), ["base"])
    assert s.read("base").count() == 2 and s.records("ingestion_runs").count() == 2
    assert "staging_base" in s.staging_views() and spark.table("staging_raw_ingested_tables").count() == 3
    s.write(s.read("base").select("case_id"), "layer")
    assert s.write(s.read("base").limit(1).select("case_id"), "layer").count() == 1
    s.reset(["person_1"])
    assert s.records("ingested_tables").where("table_name = 'person_1'").count() == 0
    s.reset()
    assert s.records("ingestion_runs").count() == 0


def test_failed_load_leaves_the_old_table(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    raw(spark, tmp_path / "in")
    s = store.Store(spark, str(tmp_path / "store"))
    s.ingest(str(tmp_path / "in"))
    monkeypatch.setattr(store, "reconciliation", lambda *a: {"row_count": False, "ok": False})
    with pytest.raises(store.ReconciliationError):
        s.ingest(str(tmp_path / "in"), ["person_1"])
    assert s.read("person_1").count() == 3 and s.cleanup() == []
    last = s.last_run().first()
    assert last.status == "failed" and "row_count" in last.error_message


def test_promotion_stopped_anywhere_loses_no_table(spark, tmp_path, monkeypatch):
    """A kill before, at or after the one renaming leaves the old or the new table whole, also after a cleanup."""
    s = store.Store(spark, str(tmp_path / "store"))
    s.write(spark.range(3), "layer")

    class Killed(BaseException):
        pass

    def killed(*a):
        raise Killed

    for name, rows in (("rename", 3), ("remove", 5)):
        with monkeypatch.context() as m:
            m.setattr(store, name, killed)
            with pytest.raises(Killed):
                s.write(spark.range(5), "layer")
        assert s.read("layer", "features").count() == rows
        assert len(s.cleanup()) == 1
        assert s.read("layer", "features").count() == rows and s.cleanup() == []
    with pytest.raises(FileNotFoundError):
        s.read("gone")


def test_rows_of_files(spark, tmp_path):
    """By one job: of folders and files with odd names, of empty ones, and of what was loaded."""
    put(spark, tmp_path / "train_a b_1_0.parquet", [(i, "x") for i in range(4)], "case_id long, v string")
    put(spark, tmp_path / "train_a b_1_1.parquet", [], "case_id long, v string")
    put(spark, tmp_path / "train_é_1.parquet", [(1, "x")], "case_id long, v string")
    paths = sorted(str(p) for p in tmp_path.glob("train_*.parquet"))
    assert tables.row_counts(spark, paths) == dict(zip(paths, (4, 0, 1), strict=True)) and tables.row_counts(spark, []) == {}
    s = store.Store(spark, str(tmp_path / "store"))
    s.ingest(str(tmp_path))
    files = {(r.path.rsplit("/", 1)[-1], r.source_rows, r.loaded_rows) for r in s.records("ingested_files").collect()}
    assert files == {("train_a b_1_0.parquet", 4, None), ("train_a b_1_1.parquet", 0, None), ("train_é_1.parquet", 1, 1)}
    assert [x["ok"] for x in s.validate(str(tmp_path))] == [True, True]


def test_text_files_are_replaced_whole(spark, tmp_path):
    from casemill import session

    for text in ("one\ntwo é", "three"):
        session.write_text(spark, str(tmp_path / "x.txt"), text)
        assert session.read_text(spark, str(tmp_path / "x.txt")) == text
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x.txt"]


def test_reconciliation():
    ok = store.reconciliation
    assert ok(2, 2, ["case_id", "x"], ["case_id", "x"])["ok"]
    assert not ok(2, 1, ["case_id"], ["case_id"])["row_count"]
    assert not ok(2, 2, ["case_id", "x"], ["x", "case_id"])["columns"]
    assert not ok(2, 2, ["case_id", "x"], ["x"])["keys"]


def test_arrivals_count_once(spark, tmp_path):
    schema, where = T.StructType.fromDDL("case_id long, v string"), [str(tmp_path / x) for x in ("in", "out", "state")]
    for i in range(2):
        spark.createDataFrame([(i, ""), (i + 10, "x")], schema).write.mode("append").parquet(where[0])
        arrival.ingest_arrivals(spark, where[0], schema, where[1], where[2])
    out = arrival.arrived(spark, schema, where[1])
    assert out.count() == 4 and out.where(F.col("v").isNull()).count() == 2
