"""The logistic baseline: fit, score, evaluate, compare class weights, time the stages."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators.metrics import evaluate
from casemill.operators.prep import HASH_BUCKETS, Predictors, class_weights, design, numeric_stats, predictor_sets, stats_dict, weight_name
from casemill.operators.temporal import SPLITS, expected_rows, split_overlaps, split_scan
from casemill.plans.assemble import BASE
from casemill.session import materialised, write_text


@dataclass(frozen=True)
class Baseline:
    model: LogisticRegressionModel
    predictors: Predictors
    stats: dict[str, tuple[float, float]]
    buckets: int

    def score(self, df: DataFrame) -> DataFrame:
        """case_id, y and score: the probability of target 1."""
        return scores(self.model, design(df, self.predictors, self.stats, buckets=self.buckets))


def prepared(train: DataFrame, predictors: Predictors, *, buckets: int = HASH_BUCKETS) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(case_id, target and the vector of features of each row; the means and scales that it was made with)."""
    stats = stats_dict(numeric_stats(train, list(predictors.numeric))) if predictors.numeric else {}
    return design(train, predictors, stats, buckets=buckets).select("case_id", "target", "features"), stats


def fit_matrix(matrix: DataFrame, *, class_weight: str | float | None = None, alpha: float = 1e-4, iterations: int = 50) -> LogisticRegressionModel:
    """L-BFGS over the whole split takes the place of batches in turn: the same penalised loss, but
    the result doesn't depend on the order of rows.
    """
    weights = class_weights(matrix, class_weight)
    rows = matrix.select("features", F.col("target").cast("double").alias("label"), (F.lit(1.0) if weights is None else F.when(F.col("target") == 1, weights[1]).otherwise(weights[0])).alias("weight"))
    learner = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=alpha, elasticNetParam=0.0, maxIter=iterations, standardization=False)
    return learner.fit(rows)


def fit(train: DataFrame, predictors: Predictors, *, class_weight: str | float | None = None, alpha: float = 1e-4, iterations: int = 50, buckets: int = HASH_BUCKETS) -> Baseline:
    """Fits means, scales and weights on ``train`` only."""
    matrix, stats = prepared(train, predictors, buckets=buckets)
    return Baseline(fit_matrix(matrix, class_weight=class_weight, alpha=alpha, iterations=iterations), predictors, stats, buckets)


def scores(model: LogisticRegressionModel, matrix: DataFrame) -> DataFrame:
    return model.transform(matrix).select("case_id", F.col("target").cast("int").alias("y"), vector_to_array("probability")[1].alias("score"))


def verify_inputs(modeling: DataFrame, split: DataFrame, predictors: Predictors, most_values: int = 10) -> dict:
    """What a fit rests on; of the distinct targets the first ``most_values`` are told."""
    values = [r[0] for r in modeling.select("target").distinct().orderBy("target").limit(most_values).collect()]
    overlaps = split_overlaps(split).first().asDict()
    return {"target_values": values, "predictor_count": len(predictors.all), "label_columns_excluded_from_predictors": not set(BASE) & set(predictors.all), "split_case_overlaps": overlaps, "no_split_case_overlap": not any(overlaps.values())}


def run_baseline(modeling: DataFrame, split: DataFrame, keep: list[str], *, class_weight: str | float | None = None, train_limit: int | None = None, eval_limit: int | None = None, alpha: float = 1e-4, iterations: int = 50, buckets: int = HASH_BUCKETS) -> dict:
    """Metadata and the metrics of all splits; each split is scored once and its scores written."""
    predictors = predictor_sets(modeling.schema, keep)
    scan = lambda s, n: split_scan(modeling, split, s, list(predictors.all), row_limit=n)
    matrix, stats = prepared(scan("train", train_limit), predictors, buckets=buckets)
    matrix = materialised(matrix, "matrix")  # every step of the fit reads it
    base = Baseline(fit_matrix(matrix, class_weight=class_weight, alpha=alpha, iterations=iterations), predictors, stats, buckets)
    scored = {s: materialised(base.score(scan(s, eval_limit)), "scored") for s in SPLITS}
    metrics = {s: evaluate(df) for s, df in scored.items()}
    kinds = {"total": len(predictors.all), "numeric": len(predictors.numeric), "categorical": len(predictors.categorical), "boolean": len(predictors.boolean)}
    config = {"estimator": "logistic regression (L-BFGS)", "penalty": "l2", "alpha": alpha, "class_weight": class_weight, "max_iterations": iterations, "train_row_limit": train_limit, "evaluation_row_limit": eval_limit, "categorical_hash_features": buckets}
    metadata = {
        "predictor_counts": kinds, "predictors": {k: list(getattr(predictors, k)) for k in ("numeric", "categorical", "boolean")}, "model_config": config,
        "training_mode": "full" if train_limit is None else "bounded_smoke", "input_checks": verify_inputs(modeling, split, predictors), "rows": {s: m["rows"] for s, m in metrics.items()},
    }
    return {"metadata": metadata, "metrics": metrics, "baseline": base, "scored": scored}


ARTIFACTS = ("metadata.json", "metrics.json", "deciles.md", "model", "scores")


def write_artifacts(spark: SparkSession, run: dict, folder: str) -> list[str]:
    """The metadata, metrics, tables of deciles, model and scores of a run, below a folder of any scheme."""
    folder = folder.rstrip("/")
    write_text(spark, f"{folder}/metadata.json", json.dumps(run["metadata"], indent=2, sort_keys=True, default=str) + "\n")
    write_text(spark, f"{folder}/metrics.json", json.dumps(run["metrics"], indent=2, sort_keys=True, default=str) + "\n")
    write_text(spark, f"{folder}/deciles.md", "\n".join(f"## {s}\n\n{markdown(m['deciles'])}" for s, m in run["metrics"].items()))
    run["baseline"].model.write().overwrite().save(f"{folder}/model")
    for s, df in run["scored"].items():
        df.write.mode("overwrite").parquet(f"{folder}/scores/split={s}")
    return [f"{folder}/{name}" for name in ARTIFACTS]


def markdown(rows: list[dict]) -> str:
    """A table; numbers with six digits."""
    if not rows:
        return ""
    show = lambda v: f"{v:.6g}" if isinstance(v, float) else "" if v is None else str(v).replace("|", "/")
    lines = [list(rows[0]), ["-"] * len(rows[0]), *[[show(v) for v in r.values()] for r in rows]]
    return "".join(f"| {' | '.join(x)} |\n" for x in lines)


def weight_diagnostic(modeling: DataFrame, split: DataFrame, keep: list[str], weights=(None, 3.0, 5.0, "balanced"), *, train_limit: int | None = None, eval_limit: int | None = None, alpha: float = 1e-4, iterations: int = 50, buckets: int = HASH_BUCKETS) -> list[dict]:
    """The validation metrics of a model for each class weight.

    The matrices of train and validation are made and written once, for all weights.
    """
    predictors = predictor_sets(modeling.schema, keep)
    scan = lambda s, n: split_scan(modeling, split, s, list(predictors.all), row_limit=n)
    matrix, stats = prepared(scan("train", train_limit), predictors, buckets=buckets)
    matrix = materialised(matrix, "matrix")
    judged = materialised(design(scan("validation", eval_limit), predictors, stats, buckets=buckets).select("case_id", "target", "features"), "matrix")
    out = []
    for w in weights:
        began = time.perf_counter()
        fitted = fit_matrix(matrix, class_weight=w, alpha=alpha, iterations=iterations)
        v = evaluate(materialised(scores(fitted, judged), "scored"))
        out.append({"class_weight": weight_name(w), "roc_auc": v["roc_auc"], "pr_auc": v["pr_auc"], "ks": v["ks"], "brier_score": v["brier_score"], "top_decile_lift": v["deciles"][0]["lift"], "seconds": time.perf_counter() - began})
    return out


def throughput(modeling: DataFrame, split: DataFrame, keep: list[str], *, row_limit: int | None = None, iterations: int = 3, most_seconds: float = 3600.0, buckets: int = HASH_BUCKETS) -> dict:
    """Seconds of each stage, and whether three passes over the whole train split fit the time.

    Each stage reads what the one before has written, so that no stage's work counts in another.
    ``full_fit_seconds`` errs high: the seconds of the fit grow by the rows, and so do its fixed costs in
    them.  While that is beyond the time, the fit is timed again on ten times the rows, each repeated,
    until it takes four times as long, so that fixed costs are a quarter at most, or until there are as
    many rows as in the split.
    """
    spark, predictors = modeling.sparkSession, predictor_sets(modeling.schema, keep)
    out: dict[str, float | bool | int] = {}

    def timed(name, action):
        began = time.perf_counter()
        value = action()
        out[f"{name}_seconds"] = time.perf_counter() - began
        return value

    rows = timed("scan", lambda: materialised(split_scan(modeling, split, "train", list(predictors.all), row_limit=row_limit), "rows"))
    n = rows.count()
    stats = timed("numeric_stats", lambda: stats_dict(numeric_stats(rows, list(predictors.numeric))))
    matrix = timed("transform", lambda: materialised(design(rows, predictors, stats, buckets=buckets).select("case_id", "target", "features"), "matrix"))
    fitted = timed("fit", lambda: fit_matrix(matrix, iterations=iterations))
    scored = timed("score", lambda: materialised(scores(fitted, matrix), "scored"))
    timed("evaluate", lambda: evaluate(scored))
    whole = expected_rows(split, "train")
    seconds, timed_rows = out["fit_seconds"], n
    if 0 < n < whole and seconds * whole / n > most_seconds:
        spread = materialised(matrix.repartition(spark.sparkContext.defaultParallelism), "matrix")
        while timed_rows < whole and seconds * whole / timed_rows > most_seconds and seconds < 4 * out["fit_seconds"]:
            copies = min(10 * timed_rows // n, -(-whole // n))
            many = spread.select(*spread.columns, F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("col")
            timed("repeated_fit", lambda many=many: fit_matrix(many, iterations=iterations))
            seconds, timed_rows = out["repeated_fit_seconds"], copies * n
    full = seconds * whole / max(timed_rows, 1)
    return out | {"rows": n, "predictors": len(predictors.all), "rows_per_second": timed_rows * iterations / seconds, "full_fit_seconds": full, "go": full <= most_seconds}
