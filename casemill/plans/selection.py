"""Selection of features by leakage, meaning and structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemill.plans.specs import LEAKAGE, FeatureSpec

LEAST_VALUES, CONSTANT_SHARE = 10, 0.995
STRUCTURAL = ("direct", "is_missing", "n_distinct")
NAMELIKE = r"\b(name|employer|creditor|remitter)\b"

# Decisions on columns whose definitions are too thin for a rule.
REVIEWED = (
    ("applprev_2", "cacccardblochreas_147M", "keep"),
    ("credit_bureau_b_1", "credor_3940957M", "exclude"),
    ("other_1", "amtdepositbalance_4809441A", "keep"),
    ("person_1", "relationshiptoclient_415T", "keep"),
    ("person_1", "relationshiptoclient_642T", "keep"),
    ("person_1", "remitter_829L", "review_later"),
    ("person_1", "safeguarantyflag_411L", "review_later"),
    ("static_0", "eir_270L", "keep"),
    ("static_0", "interestrategrace_34L", "review_later"),
    ("static_0", "isbidproduct_1095L", "review_later"),
    ("static_0", "isbidproductrequest_292L", "review_later"),
    ("static_0", "isdebitcard_729L", "review_later"),
    ("static_cb_0", "for3years_504L", "review_later"),
    ("static_cb_0", "forquarter_634L", "review_later"),
    ("static_cb_0", "fortoday_1092L", "review_later"),
    ("static_cb_0", "foryear_850L", "review_later"),
    ("static_cb_0", "riskassesment_302T", "exclude"),
    ("static_cb_0", "riskassesment_940T", "exclude"),
    ("tax_registry_a_1", "name_4527232M", "exclude"),
    ("tax_registry_b_1", "name_4917606M", "exclude"),
    ("tax_registry_c_1", "employername_160M", "exclude"),
)
REVIEW = "Decided by hand."


def feature_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """feature_name, non_null_count, distinct_count and max_value_count of each column, in one job.

    Columns are turned into (name, value as text) rows, which are counted by value, then by name;
    each task counts its own values first.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])).alias("p")
    values = df.select(pairs).select("p.*").groupBy("f", "v").agg(F.count("v").alias("n"))
    return values.groupBy(F.col("f").alias("feature_name")).agg(F.sum("n").alias("non_null_count"), F.count("v").alias("distinct_count"), F.max("n").alias("max_value_count"))


def specs_frame(spark: SparkSession, specs: list[FeatureSpec]) -> DataFrame:
    rows = [(s.feature_name, s.feature_family, s.source_table, list(s.source_columns), s.transformation) for s in specs]
    return spark.createDataFrame(rows, "feature_name string, feature_family string, source_table string, source_columns array<string>, transformation string")


def select_features(specs: DataFrame, catalog: DataFrame, stats: DataFrame) -> DataFrame:
    """decision and reason for each feature.

    In this order: duplicates go, then what meaning excludes, what structure excludes, what meaning
    or structure leaves to review; the rest is kept.  ``catalog`` needs logical_table, column_name,
    description and semantic_category; ``stats`` is that of ``feature_stats``.
    """
    spark = specs.sparkSession
    reviewed = spark.createDataFrame(list(REVIEWED), "source_table string, _c string, _decision string")
    leaking = spark.createDataFrame([(*x, True) for x in sorted(LEAKAGE)], "source_table string, _c string, _leak boolean")
    meaning = catalog.select(F.col("logical_table").alias("source_table"), F.col("column_name").alias("_c"), "semantic_category", F.lower(F.concat_ws(" ", "column_name", F.coalesce("description", F.lit("")))).alias("_text"))
    rows = specs.withColumn("_c", F.col("source_columns")[0])
    for small in (reviewed, leaking, meaning):  # of a row for each column of the tables at most
        rows = rows.join(F.broadcast(small), ["source_table", "_c"], "left")
    rows = rows.join(F.broadcast(stats), "feature_name", "left")
    same_name = Window.partitionBy("feature_name").orderBy("source_table", "transformation")
    same_spec = Window.partitionBy("source_table", "feature_family", "source_columns", "transformation").orderBy("feature_name")
    rows = rows.withColumn("_twin", (F.row_number().over(same_name) > 1) | (F.row_number().over(same_spec) > 1))
    plain = F.col("transformation").isin(*STRUCTURAL)
    n, review = F.col("non_null_count"), "review_later"
    known = n > 0
    sem = lambda d: F.coalesce(F.col("_decision") == d, F.lit(False))
    own = F.col("_decision").isNull() & F.col("_leak").isNull()
    cases = [
        (F.col("_twin"), "exclude", F.lit("Duplicate feature name or specification.")),
        (F.col("_leak").isNotNull(), "exclude", F.lit("Explicit leakage exclusion.")),
        (sem("exclude"), "exclude", F.lit(REVIEW)),
        (own & (F.col("semantic_category") != "ambiguous") & F.col("_text").rlike(NAMELIKE), "exclude", F.lit("Identifier-like or free text.")),
        (n.isNull(), "exclude", F.lit("Absent from the sample.")),
        (sem(review), review, F.lit(REVIEW)),
        (own & (F.col("semantic_category") == "ambiguous"), review, F.lit("Meaning ambiguous.")),
        (known & (n < LEAST_VALUES) & F.col("transformation").isin("direct", "is_missing"), review, F.lit("Very sparse in the sample.")),
        (known & (F.col("distinct_count") <= 1) & plain, review, F.lit("Constant in the sample.")),
        (known & (F.col("max_value_count") / n >= CONSTANT_SHARE) & plain, review, F.lit("Nearly constant in the sample.")),
        (sem("keep"), "keep", F.lit(REVIEW)),
    ]
    decision = reason = None
    for test, d, why in cases:
        test = F.coalesce(test, F.lit(False))
        decision = F.when(test, d) if decision is None else decision.when(test, d)
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    return rows.select(
        "feature_name", "feature_family", "source_table", "source_columns", "transformation", decision.otherwise("keep").alias("decision"),
        reason.otherwise("Supported lineage.").alias("reason"), F.when(F.col("_leak").isNotNull(), "excluded_leakage").otherwise("reviewed").alias("leakage_status"),
    )


def manifest(decisions: DataFrame) -> dict:
    """The decisions as plain values, by feature name: what a later step reads to know what is kept."""
    rows = sorted((r.asDict() for r in decisions.collect()), key=lambda r: (r["feature_name"], r["source_table"], r["transformation"]))  # of columns
    counts = {d: sum(r["decision"] == d for r in rows) for d in ("keep", "review_later", "exclude")}
    return {"decision_counts": counts, "features": [r | {"source_columns": list(r["source_columns"])} for r in rows]}


def kept_names(found: dict) -> list[str]:
    """The features that a manifest keeps, by name."""
    return sorted({r["feature_name"] for r in found["features"] if r["decision"] == "keep"})


def kept_specs(specs: list[FeatureSpec], found: dict) -> list[FeatureSpec]:
    """The specifications of the features that a manifest keeps; an error if the registry lacks one."""
    keep = {(r["feature_name"], r["source_table"], *r["source_columns"], r["transformation"]) for r in found["features"] if r["decision"] == "keep"}
    lacking = sorted(set(kept_names(found)) - {s.feature_name for s in specs})
    if lacking:
        raise ValueError(f"features of the selection that the registry lacks: {lacking[:5]}")
    return [s for s in specs if (s.feature_name, s.source_table, *s.source_columns, s.transformation) in keep]


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("feature_family", "decision").agg(F.count(F.lit(1)).alias("features"))


def reviewed_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REVIEWED), "source_table string, source_column string, decision string")


