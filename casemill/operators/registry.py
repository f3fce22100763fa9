"""Comparison records of models."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession

from casemill.session import exists, read_text, write_text

SPLITS = ("train", "validation", "test")


def inside(path: str | Path, root: str | Path) -> str:
    """``path`` relative to ``root``; an error if it lies outside."""
    root = Path(root).resolve()
    full = (root / path).resolve()
    if not full.is_relative_to(root):
        raise ValueError(f"{path} is outside {root}")
    return full.relative_to(root).as_posix()


def entry(name: str, metadata: dict, metrics: dict, diagnostics: dict, **about) -> dict:
    """The record of a model: ranges of its splits, metrics, calibration, first tenth and three tenths."""
    pick = lambda m, names: {k: m[v] for k, v in names.items()}
    scores = {"roc_auc": "roc_auc", "gini": "gini", "pr_auc": "pr_auc", "ks": "ks", "brier": "brier_score"}
    tops = {}
    for s in SPLITS[1:]:
        deciles = metrics[s]["deciles"]
        tops[f"{s}_top_decile"] = pick(deciles[0], {"default_rate": "default_rate", "lift": "lift"})
        tops[f"{s}_top_30_pct"] = pick(deciles[2], {"cumulative_positive_pct": "cumulative_positive_pct", "cumulative_lift": "cumulative_lift"})
    return {
        "model_name": name, **about, "model_config": metadata["model_config"],
        "temporal_ranges": {s: pick(diagnostics[s], {k: k for k in ("week_start", "week_end", "date_start", "date_end")}) for s in SPLITS},
        "metrics": {s: pick(metrics[s], scores) for s in SPLITS},
        "calibration": {s: {"intercept": metrics[s]["calibration_intercept"], "slope": metrics[s]["calibration_slope"]} for s in SPLITS[1:]}, "ranking_segments": tops,
    }


def from_artifacts(spark: SparkSession, name: str, folder: str, diagnostics: dict, **about) -> dict:
    """The record of a run from the files that ``model.write_artifacts`` left in a folder of any scheme."""
    folder = folder.rstrip("/")
    metadata, metrics = (json.loads(read_text(spark, f"{folder}/{x}.json")) for x in ("metadata", "metrics"))
    return entry(name, metadata, metrics, diagnostics, artifacts=folder, training_mode=metadata["training_mode"], **about)


def write(spark: SparkSession, path: str, record: dict, *, official: str | None = None) -> dict:
    """Adds a record to the registry file, in place of one of the same name; the file is replaced whole."""
    now = json.loads(read_text(spark, path)) if exists(spark, path) else {"schema_version": 1, "official_benchmark": record["model_name"], "models": []}
    now["models"] = [m for m in now["models"] if m["model_name"] != record["model_name"]] + [record]
    if official and official not in {m["model_name"] for m in now["models"]}:
        raise ValueError(f"no record of a model {official!r}")
    now["official_benchmark"] = official or now["official_benchmark"]
    write_text(spark, path, json.dumps(now, indent=2, sort_keys=True, default=str) + "\n")
    return now


def comparison(found: dict, split: str = "test") -> list[dict]:
    """A row for each model, best first by AUC: its metrics on a split."""
    rows = [{"model": m["model_name"], "official": m["model_name"] == found["official_benchmark"], **m["metrics"][split]} for m in found["models"]]
    return sorted(rows, key=lambda r: (-(r["roc_auc"] or 0), r["model"]))
