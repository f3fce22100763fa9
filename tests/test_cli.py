import json
import math
import random

import pytest

from casemill import cli


def raw(spark, folder):
    rng = random.Random(5)
    base, hist, static = [], [], []
    for i in range(300):
        x = rng.gauss(0, 1)
        base.append((i, int(rng.random() < 1 / (1 + math.exp(-x))), f"2020-{i // 30 % 12 + 1:02d}-10", i // 20, 202001))
        static.append((i, x * 10, rng.choice("ab"), f"firm {i % 20}", rng.choice("xyz")))
        hist += [(i, k, rng.random() * 5, "2020-01-01") for k in range(rng.randrange(3))]
    put = lambda name, rows, ddl: spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/train_{name}.parquet")
    put("base", base, "case_id long, target long, date_decision string, WEEK_NUM long, MONTH long")
    put("static_0_0", static, "case_id long, income_1A double, kind_2M string, where_3M string, riskassesment_302T string")
    put("applprev_1_0", hist, "case_id long, num_group1 long, paid_3A double, day_4D string")
    (folder / "feature_definitions.csv").write_text("Variable,Description\nincome_1A,Income amount\nkind_2M,Type of it\nwhere_3M,Employer of the person\nriskassesment_302T,Estimated default\npaid_3A,Paid\nday_4D,Date\n")


def test_from_raw_files_to_metrics(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    raw(spark, tmp_path / "raw")
    at = {k: str(tmp_path / k) for k in ("raw", "store", "out", "modeling", "labels", "reports", "run", "registry")}
    call = lambda *a: cli.run(cli.parser().parse_args(list(a)), spark)
    files = ("--raw-dir", at["raw"], "--store", at["store"])
    assert [t["table"] for t in call("list-tables", "--raw-dir", at["raw"])] == ["applprev_1", "base", "static_0"]
    assert call("inventory", "--raw-dir", at["raw"])["table_count"] == 3
    assert call("ingest", *files)["run_id"]
    assert call("quality", "--store", at["store"])["summary"]["FAIL"] == 0
    found = call("catalog", *files, "--output-dir", at["reports"])
    assert found["coverage"]["represented_source_column_count"] == 6 and any(c["representative_values"] for c in found["columns"])
    assert call("quality", "--store", at["store"], "--output-dir", at["reports"])["checks"] and {p.name for p in (tmp_path / "reports").iterdir() if not p.name.startswith(".")} == {"catalog.json", "catalog.md", "quality.json", "quality.md"}
    assert all(x["ok"] for x in call("validate", *files))
    assert call("features", *files, "--smoke-limit", "50", "--execute")["feature_count"] == 14
    chosen = ("--selection", f"{at['reports']}/selection.json")
    assert call("select", *files, *chosen, "--full")["kept"] > 5
    with pytest.raises(SystemExit):
        call("features", *files, "--full", "--execute")
    with pytest.raises(SystemExit, match="selection"):
        call("export", *files, "--output", at["out"], "--full")
    assert set(call("export", *files, *chosen, "--output", at["out"], "--full", "--compression", "gzip").values()) == {"success"}
    assert all(x["ok"] for x in call("validate-export", *files, *chosen, "--output", at["out"], "--full"))
    assert call("join", *files, *chosen, "--output", at["out"], "--modeling", at["modeling"], "--full")["lineage_matches"]
    names = spark.read.parquet(at["modeling"]).columns
    assert "static_0__income_1a__direct" in names and not any("where_3m" in c or "riskassesment" in c for c in names)
    assert call("split", "--modeling", at["modeling"], "--labels", at["labels"])["validation"]["every_case_assigned_once"]
    data = ("--modeling", at["modeling"], "--labels", at["labels"], *chosen)
    run = call("train", *data, "--full", "--class-weight", "balanced", "--output-dir", at["run"], "--iterations", "10")
    assert run["metrics"]["train"]["roc_auc"] > 0.55 and run["metadata"]["predictors"]["categorical"] == ["static_0__kind_2m__direct"]
    assert json.loads((tmp_path / "run" / "metrics.json").read_text())["test"]["roc_auc"] == run["metrics"]["test"]["roc_auc"]
    assert "lift" in (tmp_path / "run" / "deciles.md").read_text() and spark.read.parquet(f"{at['run']}/scores").count() == 300
    record = ("compare", "--registry", at["registry"], "--artifact-dir", at["run"], "--labels", at["labels"])
    call(*record, "--name", "first")
    both = call(*record, "--name", "second", "--official", "second")
    assert [x["model"] for x in both] == ["first", "second"] and [x["official"] for x in both] == [False, True] and both[0]["roc_auc"] == run["metrics"]["test"]["roc_auc"]
    assert call("compare", "--registry", at["registry"]) == both
    assert call("cleanup", "--store", at["store"]) == [] and call("reset", "--store", at["store"], "--table", "base") is None
    assert not call("validate", *files, "--table", "base")[0]["ok"]


def test_weights():
    assert [cli.weight(x) for x in (None, "none", "3", "balanced")] == [None, None, 3.0, "balanced"]
