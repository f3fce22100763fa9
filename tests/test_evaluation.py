import json
import math
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.operators import metrics, model, prep, profile, registry, temporal


def scored(spark, ys, ps):
    return spark.createDataFrame([(i, y, float(p)) for i, (y, p) in enumerate(zip(ys, ps, strict=True))], "case_id long, y int, score double")


def test_ks_and_deciles(spark):
    assert abs(metrics.ks(scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])).first()[0] - 0.5) < 1e-12
    assert math.isnan(metrics.ks(scored(spark, [0, 0], [0.1, 0.4])).first()[0])
    d = metrics.decile_table(scored(spark, [1, 0, 1] + [0] * 7, [1 - i / 10 for i in range(10)])).orderBy("decile").collect()
    assert (d[0].default_rate, round(d[0].lift, 9), d[-1].cumulative_positive_pct, len(d)) == (1.0, 5.0, 1.0, 10)
    sizes = [r["rows"] for r in metrics.decile_table(scored(spark, [0, 1] * 11 + [0], range(23))).orderBy("decile").collect()]
    assert sizes == [3, 3, 3] + [2] * 7
    assert metrics.decile_table(scored(spark, [1, 0, 1], [3, 2, 1])).count() == 3
    assert [r.decile for r in metrics.top_deciles(metrics.decile_table(scored(spark, [1, 0] * 10, range(20)))).orderBy("decile").collect()] == [1, 3]


def plain(ys, ps):
    pos, neg = [p for y, p in zip(ys, ps, strict=True) if y], [p for y, p in zip(ys, ps, strict=True) if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    ap, tp, n, before = 0.0, 0, 0, 0.0
    for s in sorted(set(ps), reverse=True):
        tp += sum(y for y, p in zip(ys, ps, strict=True) if p == s)
        n += ps.count(s)
        ap += (tp / len(pos) - before) * tp / n
        before = tp / len(pos)
    return auc, ap


def test_rank_metrics_with_ties(spark):
    rng = random.Random(4)
    ys = [rng.randrange(2) for _ in range(300)]
    ps = [1.0 if rng.random() < 0.4 else rng.choice([0.1, 0.2, 0.5, rng.random()]) for _ in ys]
    df = scored(spark, ys, ps)
    auc, ap = plain(ys, ps)
    got = metrics.roc_auc(df).first()
    assert abs(got.roc_auc - auc) < 1e-12 and abs(got.gini - (2 * auc - 1)) < 1e-12
    assert abs(metrics.average_precision(df).first()[0] - ap) < 1e-12
    assert metrics.roc_auc(scored(spark, [1, 1], [0.1, 0.2])).first()[0] is None
    e = metrics.evaluate(df)
    assert e["rows"] == 300 and len(e["deciles"]) == 10 and abs(e["brier_score"] - sum((y - p) ** 2 for y, p in zip(ys, ps, strict=True)) / 300) < 1e-12


def test_calibration_solves_the_score_equations(spark):
    rng = random.Random(1)
    ps = [rng.uniform(0.05, 0.95) for _ in range(500)]
    ys = [int(rng.random() < p * p) for p in ps]
    c = metrics.calibration(scored(spark, ys, ps))
    a, b = c["calibration_intercept"], c["calibration_slope"]
    x = [math.log(p / (1 - p)) for p in ps]
    g = [y - 1 / (1 + math.exp(-a - b * z)) for y, z in zip(ys, x, strict=True)]
    assert abs(sum(g)) < 1e-6 and abs(sum(u * z for u, z in zip(g, x, strict=True))) < 1e-6


def test_running_equals_a_window(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as int) v").repartition(5)
    got = {r.id: (r._n, r.s) for r in metrics.running(df, [F.asc("v"), F.desc("id")], {"s": F.col("v")}).collect()}
    total = 0
    for n, (v, i) in enumerate(sorted(((i % 7, -i) for i in range(1000))), 1):
        total += v
        assert got[-i] == (n, total)


def labels(spark):
    return spark.createDataFrame([(i, i % 2, f"2020-01-{(i + 1) // 2:02d}", (i + 1) // 2, 202001) for i in range(1, 11)], "case_id long, target long, date_decision string, WEEK_NUM long, MONTH long")


def test_temporal_split(spark):
    split, b = temporal.temporal_split(labels(spark))
    assert (b.train_start_week, b.train_end_week, b.validation_start_week, b.validation_end_week, b.test_start_week, b.test_end_week) == (1, 3, 4, 4, 5, 5)
    d = temporal.checked_diagnostics(split)
    assert [d[s]["rows"] for s in temporal.SPLITS] == [6, 2, 2]
    v = temporal.validation(split, b).first()
    assert v.every_case_assigned_once and v.no_overlapping_weeks and v.chronological_ordering
    assert not temporal.target_drift(split).first().material_shift
    assert temporal.split_overlaps(split).first().asDict() == {"train_validation": 0, "train_test": 0, "validation_test": 0}
    assert [r.case_id for r in temporal.split_scan(labels(spark), split, "train", ["MONTH"], row_limit=3).collect()] == [1, 2, 3]
    assert temporal.expected_rows(split, "train", 4) == 4 and temporal.week_range(split, "test") == (5, 5)
    assert temporal.config(b, split, labels(spark))["week_boundaries"]["train_end_week"] == 3


def test_split_errors_and_null_weeks(spark):
    with pytest.raises(ValueError, match="three weeks"):
        temporal.temporal_split(labels(spark).where("WEEK_NUM < 3"))
    with pytest.raises(ValueError, match="every_case"):
        temporal.temporal_split(labels(spark).unionByName(labels(spark).where("case_id = 1")))
    with pytest.raises(ValueError, match="no rows"):
        temporal.checked_diagnostics(spark.createDataFrame([(1, "train", 1, "d", 0)], "case_id long, split string, WEEK_NUM long, date_decision string, target long"))
    _, b = temporal.temporal_split(labels(spark))
    assert spark.createDataFrame([(None,)], "WEEK_NUM int").select(temporal.split_column(b).alias("s")).first().s == "test"


def test_percentiles(spark):
    assert [profile.percentile_sorted(v, p) for v, p in (([], 0.5), ([1], 0.95), ([1, 3], 0.5), ([1, 2, 3, 4, 5], 0.95))] == [None, 1, 2, 4.8]
    df = spark.createDataFrame([(i, 1) for i in range(5)], "case_id long, x int").selectExpr("case_id", "explode(sequence(0, cast(case_id as int)))")
    d = profile.row_distribution(profile.rows_per_case(df)).first()
    assert (d.min_rows_per_case, d.median_rows_per_case, d.p95_rows_per_case, d.max_rows_per_case) == (1, 3.0, 4.8, 5)


def test_quality(spark):
    base = spark.createDataFrame([(1, 0, "2020-01-01", 1), (2, 1, "2020-01-08", 2)], "case_id long, target long, date_decision string, WEEK_NUM long")
    person = spark.createDataFrame([(1, 0, None), (1, 0, None), (2, 0, 1)], "case_id long, num_group1 long, num_group2 long")
    checks = profile.quality_checks(base, {"person_1": person})
    assert profile.status_counts(checks) == {"PASS": 14, "WARNING": 1, "FAIL": 0} and len(checks) == 15
    p = profile.relationship_profile("person_1", person, base).first()
    assert (p.duplicate_key_count, p.null_num_group2_count, p.base_case_coverage_pct) == (1, 2, 100.0)
    worse = profile.quality_checks(base.withColumn("target", F.col("target") + 1), {"person_1": person.withColumn("num_group1", F.lit(-1)).withColumn("case_id", F.col("case_id") + 1)})
    assert {c.check_name for c in worse if c.status == "FAIL"} == {"target_validity", "orphan_case_ids", "group_identifier_validity"}
    assert profile.duplicate_grain("t", None, ["case_id"]).status == "WARNING" and profile.worst(["PASS", "FAIL"]) == "FAIL"
    assert profile.required_columns("t", ["a"], ["a", "b"]).status == "FAIL" and profile.row_preservation("t", 1, 2).status == "FAIL"
    assert profile.base_profile(base.limit(0)).first().default_rate == 0.0
    found = profile.definition_coverage(["case_id", "target", "x"], ["case_id", "target", "unused_feature"])
    assert (found["source_column_count"], found["represented_source_column_count"], found["columns_without_descriptions"], found["definitions_not_in_training_tables"]) == (3, 2, ["x"], ["unused_feature"])


def test_preparation(spark):
    df = spark.createDataFrame([(1, 0, 0, None, None, None), (2, 1, 1, 4.0, "unseen", True), (3, 1, 1, math.nan, "a", False)], "case_id long, target long, WEEK_NUM long, num double, cat string, flag boolean")
    p = prep.predictor_sets(df.schema, ["num", "cat", "flag"])
    assert (p.numeric, p.categorical, p.boolean) == (("num",), ("cat",), ("flag",))
    with pytest.raises(ValueError, match="gone"):
        prep.predictor_sets(df.schema, ["gone"])
    assert prep.stats_dict(prep.numeric_stats(df, ["num"])) == {"num": (4.0, 1.0)}
    assert prep.stats_dict(prep.numeric_stats(df.where("case_id = 1"), ["num"])) == {"num": (0.0, 1.0)}
    rows = [r.features.toArray().tolist() for r in prep.design(df, p, {"num": (2.0, 2.0)}, buckets=8).collect()]
    assert [len(r) for r in rows] == [10, 10, 10] and [r[:2] for r in rows] == [[0.0, -1.0], [1.0, 1.0], [0.0, 0.0]] and all(sum(r[2:]) == 1 for r in rows)
    assert [r.cat for r in prep.tokens(df, ["cat"]).collect()] == ["cat=__MISSING__", "cat=unseen", "cat=a"]
    assert prep.class_weights(df, 3.0) == {0: 1.0, 1: 3.0} and prep.class_weights(df, None) is None
    assert prep.class_weights(df, "balanced") == {0: 1.5, 1: 0.75}
    with pytest.raises(ValueError):
        prep.class_weights(df, "other")
    assert [prep.weight_name(w) for w in (None, "balanced", 3.0)] == ["unweighted", "balanced", "positive_weight_3"]


def test_baseline(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, int(rng.random() < 1 / (1 + math.exp(-x))), f"2020-01-{i % 28 + 1:02d}", i // 30, 202001, x, rng.choice("ab"), rng.random() < 0.5) for i in range(600) for x in [rng.gauss(0, 2)]]
    df = spark.createDataFrame(rows, "case_id long, target long, date_decision string, WEEK_NUM long, MONTH long, x double, c string, f boolean")
    split, b = temporal.temporal_split(df)
    run = model.run_baseline(df, split, ["x", "c", "f"], buckets=16, iterations=20)
    assert run["metrics"]["test"]["roc_auc"] > 0.75 and run["metadata"]["predictor_counts"]["total"] == 3
    checks = model.verify_inputs(df, split, prep.predictor_sets(df.schema, ["x", "c", "f"]))
    assert checks["target_values"] == [0, 1] and checks["no_split_case_overlap"] and checks["label_columns_excluded_from_predictors"]
    diag = model.weight_diagnostic(df, split, ["x"], weights=(None, 3.0), iterations=5)
    assert [d["class_weight"] for d in diag] == ["unweighted", "positive_weight_3"]
    t = model.throughput(df, split, ["x", "c"], row_limit=100)
    assert t["rows"] == 100 and t["go"]
    record = registry.entry("m", run["metadata"], run["metrics"], temporal.checked_diagnostics(split), role="baseline")
    registry.write(spark, str(tmp_path / "r.json"), record)
    found = registry.write(spark, str(tmp_path / "r.json"), {**record, "model_name": "n"})
    assert [r["model"] for r in registry.comparison(found)] == ["m", "n"]
    with pytest.raises(ValueError, match="nobody"):
        registry.write(spark, str(tmp_path / "r.json"), record, official="nobody")
    both = json.loads((tmp_path / "r.json").read_text())
    assert [m["model_name"] for m in both["models"]] == ["m", "n"] and both["official_benchmark"] == "m"


def test_throughput_tells_fixed_costs_from_rows(spark, monkeypatch):
    """A fit on few rows is nearly all fixed cost, which a fit on all rows has once; a slow fit is still told."""
    week = (F.col("id") / 2000).cast("int")
    df = spark.range(20000).select(F.col("id").alias("case_id"), (F.col("id") % 2).alias("target"), F.format_string("2020-01-%02d", week + 1).alias("date_decision"), week.alias("WEEK_NUM"), F.lit(202001).alias("MONTH"), (F.col("id") % 7).cast("double").alias("x"))
    split, _ = temporal.temporal_split(df)
    t = model.throughput(df, split, ["x"], row_limit=10, most_seconds=60)
    assert t["rows"] == 10 and t["go"] and t["full_fit_seconds"] <= 60
    fit, seen = model.fit_matrix, []

    def slow(matrix, **kw):
        seen.append(matrix.count())
        time.sleep(seen[-1] * 2e-3)
        return fit(matrix, **kw)

    monkeypatch.setattr(model, "fit_matrix", slow)
    t = model.throughput(df, split, ["x"], row_limit=10, most_seconds=10)
    assert t["rows"] == 10 and not t["go"] and 28 <= t["full_fit_seconds"]
    assert seen == [10 * 10**i for i in range(len(seen))]


def test_fit_meets_its_optimum(spark):
    """The gradient of the penalised loss is zero at the weights, by plain code on the same matrix."""
    import numpy as np

    rng = random.Random(5)
    rows = [(i, int(rng.random() < 1 / (1 + math.exp(-x))), x, rng.choice("abc")) for i in range(400) for x in [rng.gauss(0, 1)]]
    df = spark.createDataFrame(rows, "case_id long, target long, x double, c string")
    p = prep.predictor_sets(df.schema, ["x", "c"])
    matrix, stats = model.prepared(df, p, buckets=32)
    for weight in (None, "balanced", 3.0):
        fitted = model.fit_matrix(matrix, class_weight=weight, alpha=0.01, iterations=200)
        got = matrix.collect()
        x, y = np.array([r.features.toArray() for r in got]), np.array([r.target for r in got])
        w = np.array([(prep.class_weights(df, weight) or {0: 1.0, 1: 1.0})[t] for t in y])
        prob = 1 / (1 + np.exp(-(x @ fitted.coefficients.toArray() + fitted.intercept)))
        assert np.abs(x.T @ (w * (prob - y)) / w.sum() + 0.01 * fitted.coefficients.toArray()).max() < 1e-4 and abs((w * (prob - y)).sum() / w.sum()) < 1e-4
        scored = {r.case_id: r.score for r in model.scores(fitted, matrix).collect()}
        assert all(abs(scored[r.case_id] - q) < 1e-9 for r, q in zip(got, prob, strict=True))


def test_each_split_is_scored_once(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, int(rng.random() < 0.4), "2020-01-01", i // 30, 202001, rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "case_id long, target long, date_decision string, WEEK_NUM long, MONTH long, x double")
    split, _ = temporal.temporal_split(df)
    seen = []
    real = model.Baseline.score
    monkeypatch.setattr(model.Baseline, "score", lambda self, rows: seen.append(1) or real(self, rows))
    run = model.run_baseline(df, split, ["x"], iterations=3, buckets=8)
    assert len(seen) == 3 and all("Logistic" not in x._jdf.queryExecution().toString() and "UDF" not in x._jdf.queryExecution().toString() for x in run["scored"].values())


def test_limited_scan_with_few_rows(spark):
    df = spark.createDataFrame([(i, i % 2, i // 4, f"c{i}") for i in range(20)], "case_id long, target long, WEEK_NUM long, v string")
    split = df.selectExpr("case_id", "target", "WEEK_NUM", "'train' as split")
    for n in (0, 1, 7, 20, 50):
        assert [r.case_id for r in temporal.split_scan(df, split, "train", ["v"], row_limit=n).collect()] == list(range(min(n, 20)))
    assert temporal.expected_rows(split, "train", 7) == 7 and temporal.expected_rows(split, "train") == 20 and temporal.expected_rows(split, "test") == 0


def test_paths(tmp_path):
    assert registry.inside("a/b", tmp_path) == "a/b"
    with pytest.raises(ValueError):
        registry.inside("../x", tmp_path)


def test_types_of_predictors():
    s = T.StructType.fromDDL("a int, b long, c float, d double, e short, f decimal(5,2), g string, h boolean, i date")
    p = prep.predictor_sets(s, s.names)
    assert (p.numeric, p.boolean, p.categorical) == (("a", "b", "c", "d"), ("h",), ("e", "f", "g", "i"))
