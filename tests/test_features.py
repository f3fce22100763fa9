import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.plans import assemble, catalog, selection, specs
from casemill.sources import export


def columns():
    schemas = {
        "base": "case_id long, target long, date_decision string, WEEK_NUM long, MONTH long",
        "static_0": "case_id long, amount_1A double, lastapprdate_640D string",
        "applprev_1": "case_id long, num_group1 long, amtpaid_2A double, approvaldate_319D string, day_3D string, status_4M string, flag boolean",
    }
    text = {"amount_1A": "Amount", "amtpaid_2A": "Paid by installment", "day_3D": "Date of it", "status_4M": "Status", "lastapprdate_640D": "Date", "approvaldate_319D": "Date"}
    return catalog.catalog_columns({k: T.StructType.fromDDL(v) for k, v in schemas.items()}, text)


def test_categories():
    cases = [("case_id", None, "key/grouping"), ("target", "x", "target"), ("MONTH", None, "time index"), ("date_x", None, "date/days"), ("a", "Installment amount", "payment"), ("a", "Annuity", "amount"), ("a", "its account", "count"), ("a", None, "ambiguous"), ("a", "", "ambiguous"), ("a", "qqq", "ambiguous"), ("a", "Last update", "date/days")]
    assert [catalog.category(c, d) for c, d, _ in cases] == [w for *_, w in cases]


def test_category_column(spark):
    cases = [("case_id", None), ("target", "x"), ("MONTH", None), ("date_x", None), ("a", "Installment amount"), ("a", "Annuity"), ("a", "its account"), ("a", None), ("a", "qqq")]
    df = spark.createDataFrame(cases, "n string, d string").select("*", catalog.category_column(F.col("n"), F.col("d")).alias("c"))
    assert [r.c for r in df.collect()] == [catalog.category(*x) for x in cases]


def test_registry():
    found = specs.registry(columns())
    names = [s.feature_name for s in found]
    assert names == sorted(names) and not any("640d" in n or "319d" in n for n in names)
    assert specs.family_counts(found) == {"static applicant/bureau snapshots": 2, "previous applications": 10}
    assert [s.transformation for s in found if "amtpaid" in s.feature_name] == ["max", "mean", "min", "std", "sum"]
    assert specs.estimated_bytes(10, 5) == 540 and specs.group_of("unknown_1") == "other histories"
    assert not specs.within_bytes(found, 10) and specs.within_bytes(found) == found


def frames(spark):
    base = spark.createDataFrame([(1, 0, "2020-01-10", 0, 202001), (2, 1, "2020-01-20", 1, 202001), (3, 0, None, 2, 202001)], "case_id long, target long, date_decision string, WEEK_NUM long, MONTH long")
    static = spark.createDataFrame([(1, None, "x"), (2, 5.0, "x"), (2, 4.0, "x"), (9, 1.0, "x")], "case_id long, amount_1A double, lastapprdate_640D string")
    hist = spark.createDataFrame(
        [(1, 0, 2.0, "x", "2020-01-01", "a", True), (1, 1, 4.0, "x", "", "a", None), (1, 2, None, "x", "2020-01-05", None, None), (2, 0, 7.0, "x", None, "b", True), (9, 0, 1.0, "x", "2020-01-01", "z", True), (3, 0, math.nan, "x", "2020-01-01", "c", True), (None, 1, 1.0, "x", None, "c", True)],
        "case_id long, num_group1 long, amtpaid_2A double, approvaldate_319D string, day_3D string, status_4M string, flag boolean",
    )
    return base, {"static_0": static, "applprev_1": hist}


def test_assembly(spark):
    base, tables = frames(spark)
    rows = {r.case_id: r.asDict() for r in assemble.assemble(base, tables, specs.registry(columns())).collect()}
    assert sorted(rows) == [1, 2, 3]
    one, two, three = rows[1], rows[2], rows[3]
    p = "applprev_1__"
    assert (one[p + "records__count"], one[p + "amtpaid_2a__min"], one[p + "amtpaid_2a__mean"], one[p + "amtpaid_2a__sum"]) == (3.0, 2.0, 3.0, 6.0)
    assert abs(one[p + "amtpaid_2a__std"] - math.sqrt(2)) < 1e-12 and two[p + "amtpaid_2a__std"] is None
    assert (one[p + "day_3d__min_days_before_decision"], one[p + "day_3d__mean_days_before_decision"], one[p + "day_3d__max_days_before_decision"]) == (5.0, 7.0, 9.0)
    assert two[p + "day_3d__mean_days_before_decision"] is None and three[p + "day_3d__mean_days_before_decision"] is None
    assert one[p + "status_4m__n_distinct"] == 1.0 and math.isnan(three[p + "amtpaid_2a__max"])
    assert (one["static_0__amount_1a__direct"], one["static_0__amount_1a__is_missing"]) == (None, 1)
    assert (two["static_0__amount_1a__direct"], two["static_0__amount_1a__is_missing"]) == (4.0, 0)
    assert three["static_0__amount_1a__is_missing"] == 1
    other = {r.case_id: r for r in assemble.assemble(base, tables, specs.registry(columns()), missing_in_source=True).collect()}
    assert other[3]["static_0__amount_1a__is_missing"] is None and other[1]["static_0__amount_1a__is_missing"] == 1
    few = assemble.assemble(base, tables, specs.registry(columns()), limit=1, distinct=lambda c: F.size(F.collect_set(c))).collect()
    assert len(few) == 1 and few[0].asDict() == one


def test_ways_to_count_distinct_values(spark, monkeypatch):
    rows = [(i % 7, "abcde"[i * i % 5] if i % 3 else None, f"v{i % 50}", str(i)) for i in range(400)] + [(9, None, None, None)]
    h = spark.createDataFrame(rows, "case_id long, few string, some string, many string")
    own = [specs.FeatureSpec(f"t__{c}__n_distinct", "t_1", (c,), "n_distinct", "f", "d") for c in ("few", "some", "many")]
    want = {k: tuple(float(len({r[i] for r in rows if r[0] == k and r[i] is not None})) for i in (1, 2, 3)) for k in {r[0] for r in rows}}
    for bits, sets in ((60, 10_000), (60, 100), (0, 10_000), (60, 0)):
        monkeypatch.setattr(assemble, "BIT_VALUES", bits)
        monkeypatch.setattr(assemble.distinct_ways, "__defaults__", (sets,))
        out, _ = assemble.history_features(h, own)
        assert {r[0]: tuple(r)[1:] for r in out.collect()} == want
    out, _ = assemble.history_features(h.where("case_id = 9"), own[:1])
    assert [tuple(r) for r in out.collect()] == [(9, 0.0)]


def test_cases_without_history_are_null(spark):
    base, tables = frames(spark)
    tables["applprev_1"] = tables["applprev_1"].where("case_id = 1")
    rows = {r.case_id: r for r in assemble.assemble(base, tables, specs.registry(columns())).collect()}
    assert all(rows[2][s.feature_name] is None for s in specs.registry(columns()) if s.source_table == "applprev_1")


def test_malformed_dates_fail(spark):
    base, tables = frames(spark)
    tables["applprev_1"] = tables["applprev_1"].withColumn("day_3D", F.lit("2020-13-77"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        assemble.assemble(base, tables, specs.registry(columns())).collect()


def test_table_summaries(spark):
    cols = catalog.catalog_frame(spark, columns())
    found = {r.logical_table: r for r in catalog.table_summaries(cols, catalog.tables_frame(spark, {"applprev_1": 7, "base": 1, "static_0": 0})).collect()}
    s = found["applprev_1"]
    assert (s.grain_columns, s.logical_family, s.row_count, s.column_count, s.unclear_columns) == ("case_id,num_group1", "previous_application", 7, 7, "flag")
    assert catalog.IDEAS["payment"] in s.feature_ideas and catalog.REPEATED_IDEA in s.feature_ideas and catalog.STATIC_IDEA in found["static_0"].feature_ideas
    assert found["base"].leakage_columns == "target" and found["base"].key_columns == "MONTH,WEEK_NUM,case_id,date_decision,target"


def test_structural_rules(spark):
    spec = [specs.FeatureSpec(f"f{i}", "t_1", ("c",), step, "fam", "d") for i, step in enumerate(["direct", "direct", "direct", "direct", "direct", "mean"])]
    spec = [specs.FeatureSpec(s.feature_name, f"t{i}_1", ("c",), s.transformation, "fam", "d") for i, s in enumerate(spec)]
    stats = spark.createDataFrame([("f0", 0, 0, 0), ("f1", 2, 2, 1), ("f2", 10, 1, 10), ("f3", 10, 2, 5), ("f5", 10, 1, 10)], "feature_name string, non_null_count long, distinct_count long, max_value_count long")
    cat = spark.createDataFrame([(f"t{i}_1", "c", "Amount", "amount") for i in range(6)], "logical_table string, column_name string, description string, semantic_category string")
    got = {r.feature_name: r.decision for r in selection.select_features(selection.specs_frame(spark, spec), cat, stats).collect()}
    assert got == {"f0": "keep", "f1": "review_later", "f2": "review_later", "f3": "keep", "f4": "exclude", "f5": "keep"}


def test_semantic_rules_and_duplicates(spark):
    spec = [
        specs.FeatureSpec("a", "static_0", ("lastapprdate_640D",), "direct", "f", "d"), specs.FeatureSpec("b", "static_0", ("eir_270L",), "direct", "f", "d"), specs.FeatureSpec("b", "static_0", ("x",), "direct", "f", "d"),
        specs.FeatureSpec("c", "tax_registry_a_1", ("name_4527232M",), "n_distinct", "f", "d"), specs.FeatureSpec("d", "t_1", ("who",), "n_distinct", "f", "d"), specs.FeatureSpec("e", "t_1", ("what",), "n_distinct", "f", "d"), specs.FeatureSpec("g", "static_0", ("eir_270L",), "direct", "f", "d"),
    ]
    stats = spark.createDataFrame([(x, 100, 10, 20) for x in "abcdeg"], "feature_name string, non_null_count long, distinct_count long, max_value_count long")
    cat = spark.createDataFrame([("t_1", "who", "Employer of it", "demographic"), ("t_1", "what", None, "ambiguous"), ("static_0", "eir_270L", "Rate", "ambiguous")], "logical_table string, column_name string, description string, semantic_category string")
    for order in (spec, spec[::-1]):
        rows = selection.select_features(selection.specs_frame(spark, order), cat, stats).collect()
        got = sorted((r.feature_name, r.decision) for r in rows)
        assert got == [("a", "exclude"), ("b", "exclude"), ("b", "keep"), ("c", "exclude"), ("d", "exclude"), ("e", "review_later"), ("g", "exclude")]
        assert {r.leakage_status for r in rows if r.feature_name == "a"} == {"excluded_leakage"}
    found = selection.manifest(selection.select_features(selection.specs_frame(spark, spec), cat, stats))
    assert [(s.feature_name, s.source_columns) for s in selection.kept_specs(spec, found)] == [("b", ("eir_270L",))] and selection.kept_names(found) == ["b"]
    with pytest.raises(ValueError, match="b"):
        selection.kept_specs(spec[:1], found)


def test_export(spark, tmp_path):
    base, tables = frames(spark)
    own = specs.registry(columns())
    out = export.Exporter(spark, str(tmp_path))
    assert set(out.run(base, tables, own).values()) == {"success"}
    assert set(export.Exporter(spark, str(tmp_path)).run(base, tables, own).values()) == {"skipped"}
    assert set(export.Exporter(spark, str(tmp_path), smoke_limit=2).run(base, tables, own, ["previous applications"]).values()) == {"success"}
    joined = out.joined()
    v = export.validate_joined(joined, base, own).first()
    assert v.one_row_per_case and v.lineage_matches and v.row_count == 3 and v.column_count == len(own) + 5
    assert joined.schema["static_0__amount_1a__is_missing"].dataType == T.LongType()
    with pytest.raises(export.ExportError):
        out.run(base, tables, own, ["other histories"])


def test_joined_broadcasts_no_part(spark, tmp_path):
    """Few bytes of a file may be many cases, so an estimate of its size must not bring it to the driver."""
    base, tables = frames(spark)
    out = export.Exporter(spark, str(tmp_path))
    out.run(base, tables, specs.registry(columns()))
    df = out.joined().select("case_id")
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_failed_write_keeps_the_old(spark, tmp_path):
    path, schema = str(tmp_path / "x"), T.StructType.fromDDL("case_id long, x double")
    assert export.write_batches(spark, [[(1, None), (2, None)], [(3, 1.0), (4, 2.0)]], schema, path) == 4
    assert spark.read.parquet(path).schema["x"].dataType == T.DoubleType()
    bad = spark.createDataFrame([("q", 1.0)], "case_id string, x double").selectExpr("cast(case_id as long) case_id", "x")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        export.write_checked(bad, path, schema)
    with pytest.raises(export.ExportError):
        export.write_checked(bad.select("x", "case_id"), path, schema)
    assert spark.read.parquet(path).count() == 4 and [p.name for p in tmp_path.iterdir()] == ["x"]


class Killed(BaseException):
    pass


def stop_at(monkeypatch, module, nth):
    """Makes the ``nth`` renaming of a module fail as if the process were killed there."""
    real, seen = module.rename, []

    def rename(spark, old, new):
        seen.append(new)
        if len(seen) == nth:
            raise Killed
        real(spark, old, new)

    monkeypatch.setattr(module, "rename", rename)


def test_write_stopped_at_any_renaming_keeps_the_old(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "x"), spark.range(3)
    export.write_checked(df, path)
    for nth in (1, 2):
        with monkeypatch.context() as m:
            stop_at(m, export, nth)
            with pytest.raises(Killed):
                export.write_checked(spark.range(5), path)
        assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["x"]


def test_killed_between_the_renamings(spark, tmp_path):
    """As a dead process leaves it: the old data aside and nothing in place."""
    path = str(tmp_path / "x")
    export.write_checked(spark.range(3), path)
    (tmp_path / "x").rename(tmp_path / "x.old-1")
    spark.range(9).write.parquet(str(tmp_path / "x.tmp-2"))
    export.settle(spark, path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["x"]
    (tmp_path / "x").rename(tmp_path / "x.old-1")
    assert export.write_checked(spark.range(4), path) == 4
    assert [p.name for p in tmp_path.iterdir()] == ["x"]


def test_smoke_and_full_exports_stand_beside_each_other(spark, tmp_path):
    base, tables = frames(spark)
    own = specs.registry(columns())
    full, smoke = (lambda: export.Exporter(spark, str(tmp_path))), (lambda: export.Exporter(spark, str(tmp_path), smoke_limit=2))
    for make in (full, smoke):
        assert set(make().run(base, tables, own).values()) == {"success"}
    for make in (full, smoke):
        assert set(make().run(base, tables, own).values()) == {"skipped"}
    assert set(export.Exporter(spark, str(tmp_path), smoke_limit=1).run(base, tables, own).values()) == {"success"}
    assert full().entries()["base_labels"]["row_count"] == 3 and smoke().entries()["base_labels"]["row_count"] == 1
    assert all(x["ok"] for x in full().validate(3, own)) and not all(x["ok"] for x in full().validate(4, own))
    keep = ["static_0__amount_1a__direct"]
    assert full().joined(keep).columns[-1:] == keep and len(full().joined(keep).columns) == 6
    with pytest.raises(export.ExportError, match="gone"):
        full().joined(["gone"])


def test_batches_are_written_as_they_come(spark, tmp_path):
    schema = T.StructType.fromDDL("case_id long")
    batches = ([(i,)] * 10 for i in range(25))
    assert export.write_batches(spark, batches, schema, str(tmp_path / "x"), rows_at_once=100) == 250
    assert len(list((tmp_path / "x").glob("part-*"))) == 3 and spark.read.parquet(str(tmp_path / "x")).count() == 250
    assert export.write_batches(spark, iter([]), schema, str(tmp_path / "y")) == 0 and spark.read.parquet(str(tmp_path / "y")).count() == 0
    with pytest.raises(RuntimeError):
        export.write_batches(spark, broken(), schema, str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 250


def broken():
    yield [(1,)]
    raise RuntimeError
