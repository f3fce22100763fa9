"""Registered queries of the engine's own operators."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill import cases
from casemill.functions.names import logical_name, name_part_column
from casemill.functions.values import as_date, blank_to_null, boolean_value, logit, missing_flag, token
from casemill.operators import metrics, model, prep, profile, registry, temporal
from casemill.plans import assemble, catalog, selection, specs
from casemill.session import fresh, listed, read_text
from casemill.sources import export, inventory, store, tables
from casemill.streaming import arrival

Q = {}


def query(f):
    Q[f.__name__] = f
    return f


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Floating-point columns rounded, so that the order of summation doesn't show.

    All get the same small push before, so that what lies just between two roundings goes up, whatever
    the last bits of a sum are.
    """
    push = 10.0 ** -(places + 5)
    return df.select(*[F.round(F.col(f"`{f.name}`") + F.lit(push), places).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema])


def spec_rows(spark, sf_dir, *transformations: str, table: str | None = None) -> list[specs.FeatureSpec]:
    return [s for s in cases.specs(spark, sf_dir) if (not transformations or s.transformation in transformations) and table in (None, s.source_table)]


# -- features ----------------------------------------------------------------------------------------


@query
def history_features(spark, sf_dir):
    """All aggregates of a history, a row for each case."""
    return rounded(assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), spec_rows(spark, sf_dir, table="applprev_1")), 4)


@query
def event_features(spark, sf_dir):
    """A history of depth 2 with orphans, which the join leaves out."""
    return rounded(assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), spec_rows(spark, sf_dir, table="person_2")), 4)


@query
def static_features(spark, sf_dir):
    """direct and is_missing; a case without a static row is missing."""
    return assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), spec_rows(spark, sf_dir, table="static_0"))


@query
def static_features_in_source(spark, sf_dir):
    """is_missing is judged within the static table: null without a row."""
    return assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), spec_rows(spark, sf_dir, table="static_0"), missing_in_source=True)


@query
def feature_layer(spark, sf_dir):
    """All features of all tables."""
    return rounded(assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), cases.specs(spark, sf_dir)), 4)


@query
def feature_layer_smoke(spark, sf_dir):
    """The feature layer of the 100 cases of smallest id, histories cut to these."""
    return rounded(assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), cases.specs(spark, sf_dir), limit=100), 4)


@query
def base_projection(spark, sf_dir):
    """The base columns of the 1000 cases of smallest id."""
    return assemble.base_frame(cases.base(spark, sf_dir), 1000)


@query
def static_one_per_case(spark, sf_dir):
    """One row for each case of a table with several."""
    return assemble.one_per_case(cases.history(spark, sf_dir).select("case_id", "num_group1", "quantity"))


@query
def distinct_values_as_sets(spark, sf_dir):
    """n_distinct by sets, for columns of few values."""
    part, _ = assemble.history_features(cases.history(spark, sf_dir), spec_rows(spark, sf_dir, "n_distinct", table="applprev_1"), distinct=lambda c: F.size(F.collect_set(c)))
    return part


@query
def history_rows_of_base(spark, sf_dir):
    """History rows with the decision date of their case; orphans left out."""
    return cases.events(spark, sf_dir).join(cases.base(spark, sf_dir).select("case_id", "date_decision"), "case_id").select("case_id", "num_group1", "num_group2", "date_decision", "event_time_2D")


@query
def days_before_decision(spark, sf_dir):
    """Days between two dates kept as text."""
    rows = cases.history(spark, sf_dir).join(cases.base(spark, sf_dir).select("case_id", "date_decision"), "case_id")
    s = T.StringType()
    return rows.select("case_id", "num_group1", F.datediff(as_date(F.col("date_decision"), s), as_date(F.col("shipdate_1D"), s)).cast("long").alias("days"))


@query
def family_export(spark, sf_dir):
    """Each family written and read again: rows and columns."""
    root = fresh(spark, "families")
    base, sources, own = cases.base(spark, sf_dir), cases.tables(spark, sf_dir), cases.specs(spark, sf_dir)
    export.Exporter(spark, root).run(base, sources, own)
    again = export.Exporter(spark, root)
    again.run(base, sources, own)
    return spark.createDataFrame([(k, v["row_count"], v["column_count"], v["completion_status"]) for k, v in again.manifest.items()], "family string, row_count long, column_count long, completion_status string")


def _joined(spark, sf_dir):
    out = export.Exporter(spark, fresh(spark, "families"))
    base, own = cases.base(spark, sf_dir), cases.specs(spark, sf_dir)
    out.run(base, cases.tables(spark, sf_dir), own)
    return out.joined(), base, own


@query
def family_join(spark, sf_dir):
    """The exported families joined again."""
    return rounded(_joined(spark, sf_dir)[0], 4)


@query
def joined_validation(spark, sf_dir):
    """Rows, cases and columns of the joined frame."""
    return export.validate_joined(*_joined(spark, sf_dir))


@query
def feature_registry(spark, sf_dir):
    """The specifications that the catalog gives."""
    return selection.specs_frame(spark, cases.specs(spark, sf_dir)).withColumn("source_columns", F.array_join("source_columns", ","))


@query
def registry_family_counts(spark, sf_dir):
    """Features by family."""
    return selection.specs_frame(spark, cases.specs(spark, sf_dir)).groupBy("feature_family").agg(F.count(F.lit(1)).alias("features"))


@query
def storage_estimate(spark, sf_dir):
    """Bytes that the layer would take."""
    rows, columns = cases.base(spark, sf_dir).count(), len(cases.specs(spark, sf_dir)) + 5
    return spark.createDataFrame([(rows, columns, specs.estimated_bytes(rows, columns))], "row_count long, column_count long, bytes long")


# -- catalog and selection ---------------------------------------------------------------------------


@query
def catalog_columns(spark, sf_dir):
    """The catalog of all columns."""
    return catalog.catalog_frame(spark, cases.catalog(spark, sf_dir)).drop("representative_values")


@query
def semantic_categories(spark, sf_dir):
    """Categories of columns by expressions over a catalog table; part types are the descriptions."""
    rows = cases.read(spark, sf_dir, "part").select(F.concat(F.lit("col_"), F.col("p_partkey").cast("string")).alias("column_name"), F.concat_ws(" ", F.col("p_type"), F.element_at(F.array(*map(F.lit, ("price", "status", "dpd date", "loan", "number of", "tax", "person", "x"))), (F.col("p_partkey") % 8 + 1).cast("int"))).alias("description"))
    return rows.select("column_name", catalog.category_column(F.col("column_name"), F.col("description")).alias("semantic_category"))


@query
def table_summaries(spark, sf_dir):
    """What each table holds."""
    frames = {"base": cases.base(spark, sf_dir), **cases.tables(spark, sf_dir)}
    tables_of = catalog.tables_frame(spark, {n: df.count() for n, df in frames.items()})
    return catalog.table_summaries(catalog.catalog_frame(spark, cases.catalog(spark, sf_dir)), tables_of).drop("about")


@query
def definition_coverage(spark, sf_dir):
    """Columns without definitions and definitions without columns."""
    found = profile.definition_coverage([c.column_name for c in cases.catalog(spark, sf_dir)], list(cases.DEFINITIONS))
    rows = [(n, k) for k in ("columns_without_descriptions", "definitions_not_in_training_tables") for n in found[k]]
    rows += [(str(v), k) for k, v in found.items() if isinstance(v, int)]
    return spark.createDataFrame(rows, "value string, kind string")


@query
def sample_values(spark, sf_dir):
    """Values of the first rows of a table."""
    found = tables.sample_values(cases.read(spark, sf_dir, "customer"), ["c_custkey"])
    return spark.createDataFrame([(c, i, v) for c, vs in found.items() if c in ("c_custkey", "c_name", "c_mktsegment") for i, v in enumerate(vs)], "column_name string, place long, value string")


STATS_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query
def feature_stats(spark, sf_dir):
    """Values, distinct values and the commonest one's count of several columns in one job."""
    return selection.feature_stats(cases.read(spark, sf_dir, "orders"), STATS_COLUMNS)


def _decisions(spark, sf_dir):
    own = cases.specs(spark, sf_dir)
    layer = assemble.assemble(cases.base(spark, sf_dir), cases.tables(spark, sf_dir), own)
    stats = selection.feature_stats(layer, [s.feature_name for s in own])
    return selection.select_features(selection.specs_frame(spark, own), catalog.catalog_frame(spark, cases.catalog(spark, sf_dir)), stats)


@query
def feature_selection(spark, sf_dir):
    """Decisions by leakage, meaning and structure."""
    return _decisions(spark, sf_dir).drop("source_columns")


@query
def selection_counts(spark, sf_dir):
    """Decisions by family."""
    return selection.decision_counts(_decisions(spark, sf_dir))


def _selected(spark, sf_dir):
    """(base, tables, specs, manifest) of static tables with columns that the selection keeps, leaves and excludes."""
    wide = cases.static(spark, sf_dir).withColumns({"eir_270L": F.col("totalprice") / 4, "isdebitcard_729L": F.col("nation") % 2, "workplace_1M": F.concat(F.lit("firm "), F.col("nation").cast("string")), "lastapprdate_640D": F.lit("2020-01-01")})
    base, found = cases.base(spark, sf_dir), {"static_0": wide}
    defined = cases.DEFINITIONS | {"eir_270L": "Rate", "workplace_1M": "Employer of the person", "lastapprdate_640D": "Date of it"}
    columns = catalog.catalog_columns({"base": base.schema, "static_0": wide.schema}, defined)
    own = specs.registry(columns)
    stats = selection.feature_stats(assemble.assemble(base, found, own), [s.feature_name for s in own])
    return base, found, own, selection.manifest(selection.select_features(selection.specs_frame(spark, own), catalog.catalog_frame(spark, columns), stats))


@query
def selection_manifest(spark, sf_dir):
    """What the manifest of a selection says of columns kept, left to review and excluded."""
    *_, found = _selected(spark, sf_dir)
    return spark.createDataFrame([(r["feature_name"], r["decision"]) for r in found["features"]], "feature_name string, decision string")


@query
def modeling_frame(spark, sf_dir):
    """Selection, export and join: only features that the manifest keeps are in the frame."""
    base, found, own, manifest = _selected(spark, sf_dir)
    out = export.Exporter(spark, fresh(spark, "families"))
    keep = selection.kept_specs(own, manifest)
    out.run(base, found, keep)
    return rounded(out.joined(selection.kept_names(manifest)), 4)


@query
def export_validation(spark, sf_dir):
    """Whether exported files have the rows, cases and columns that they should have."""
    out, base = export.Exporter(spark, fresh(spark, "families")), cases.base(spark, sf_dir)
    own = cases.specs(spark, sf_dir)
    out.run(base, cases.tables(spark, sf_dir), own, ["static applicant/bureau snapshots"])
    return spark.createDataFrame([(x["file"], x["exported"], x.get("rows"), x["ok"]) for x in out.validate(base.count(), own)], "file string, exported boolean, rows long, ok boolean")


@query
def reviewed_columns(spark, sf_dir):
    """The columns that were decided by hand."""
    return selection.reviewed_frame(spark)


# -- sources and store -------------------------------------------------------------------------------


def _raw_folder(spark, sf_dir) -> str:
    """The case tables as raw files: the history in two partitions."""
    root = fresh(spark, "raw-files")
    cases.base(spark, sf_dir).write.parquet(f"{root}/train_base.parquet")
    h = cases.history(spark, sf_dir).withColumn("returnflag_1M", F.when(F.col("returnflag_1M") == "N", "").otherwise(F.col("returnflag_1M")))
    h.where("case_id % 2 = 0").write.parquet(f"{root}/train_applprev_1_0.parquet")
    h.where("case_id % 2 = 1").write.parquet(f"{root}/train_applprev_1_1.parquet")
    cases.static(spark, sf_dir).write.parquet(f"{root}/train_static_0_0.parquet")
    definitions = spark.createDataFrame(sorted(cases.DEFINITIONS.items()), "Variable string, Description string")
    definitions.coalesce(1).write.option("header", True).csv(f"{root}/feature_definitions.csv")
    return root


@query
def logical_tables(spark, sf_dir):
    """Files grouped to tables, with strictly equal schemas."""
    found = tables.discover(spark, _raw_folder(spark, sf_dir))
    return spark.createDataFrame([(t.name, len(t.paths), len(t.columns), t.read(spark).count()) for t in found], "table_name string, files long, columns long, row_count long")


@query
def file_inventory(spark, sf_dir):
    """Profiles of raw files."""
    files = inventory.file_profiles(spark, listed(spark, f"{_raw_folder(spark, sf_dir)}/train_*.parquet"))
    return files.select("file_name", "row_count", F.col("column_count").cast("long").alias("column_count"), "logical_family", F.col("depth").cast("long").alias("depth"), F.array_join("key_columns", ",").alias("key_columns"))


@query
def definitions_file(spark, sf_dir):
    """Names and descriptions read from CSV."""
    return inventory.read_definitions(spark, f"{_raw_folder(spark, sf_dir)}/feature_definitions.csv")


@query
def ingested_history(spark, sf_dir):
    """A table loaded, reconciled and promoted; empty texts are null."""
    s = store.Store(spark, fresh(spark, "store"))
    s.ingest(_raw_folder(spark, sf_dir), ["applprev_1"])
    return s.read("applprev_1")


@query
def ingestion_records(spark, sf_dir):
    """The records of an ingest."""
    s = store.Store(spark, fresh(spark, "store"))
    s.ingest(_raw_folder(spark, sf_dir))
    return s.records("ingested_tables").join(s.last_run().select("run_id"), "run_id", "left_semi").select("table_name", "status", "source_rows", "loaded_rows")


@query
def store_validation(spark, sf_dir):
    """Loaded tables against their files, after one of them was reset (Q9)."""
    s, raw = store.Store(spark, fresh(spark, "store")), _raw_folder(spark, sf_dir)
    s.ingest(raw)
    s.reset(["static_0"])
    return spark.createDataFrame([(x["table"], x["loaded"], x.get("source_rows"), x.get("loaded_rows"), x["ok"]) for x in s.validate(raw)], "table_name string, loaded boolean, source_rows long, loaded_rows long, ok boolean")


@query
def staged_base(spark, sf_dir):
    """A staging view over the raw base."""
    s = store.Store(spark, fresh(spark, "store"))
    s.ingest(_raw_folder(spark, sf_dir))
    s.staging_views()
    return spark.table("staging_base")


@query
def reset_records(spark, sf_dir):
    """What is recorded after one table was reset."""
    s = store.Store(spark, fresh(spark, "store"))
    s.ingest(_raw_folder(spark, sf_dir))
    s.reset(["static_0"])
    s.cleanup()
    return s.records("ingested_tables").select("table_name", "status", "loaded_rows")


@query
def arrived_files(spark, sf_dir):
    """Files that arrived in two steps, each taken in once."""
    root, schema = fresh(spark, "arrivals"), cases.base(spark, sf_dir).schema
    for part in (0, 1):
        cases.base(spark, sf_dir).where(F.col("case_id") % 2 == part).write.mode("append").parquet(f"{root}/in")
        arrival.ingest_arrivals(spark, f"{root}/in", schema, f"{root}/out", f"{root}/state")
    return arrival.arrived(spark, schema, f"{root}/out").select(*schema.names)


@query
def blank_texts(spark, sf_dir):
    """Empty texts as null."""
    d = cases.read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 > 0, F.col("p_brand")).otherwise("").alias("p_brand"))
    return d.select("p_partkey", blank_to_null(F.col("p_brand")).alias("p_brand"))


@query
def table_names(spark, sf_dir):
    """Names of tables and name parts of features (S2, scalar functions)."""
    rows = cases.read(spark, sf_dir, "part").select("p_partkey", name_part_column(F.concat(F.lit(" "), F.col("p_brand"), F.lit("--"), F.col("p_type"), F.lit("!"))).alias("part"))
    return rows.withColumn("logical", F.lit(logical_name("train_credit_bureau_a_2_10.parquet")))


# -- quality -----------------------------------------------------------------------------------------


@query
def base_profile(spark, sf_dir):
    """Counts and ranges of the base (A10)."""
    return rounded(profile.base_profile(cases.base(spark, sf_dir)))


@query
def rows_per_case(spark, sf_dir):
    """Rows for each case."""
    return profile.rows_per_case(cases.history(spark, sf_dir))


@query
def row_distribution(spark, sf_dir):
    """Quantiles of the rows for a case."""
    return rounded(profile.row_distribution(profile.rows_per_case(cases.history(spark, sf_dir))))


@query
def relationship_profiles(spark, sf_dir):
    """How all tables relate to the base."""
    base = cases.base(spark, sf_dir)
    a, b, c = (profile.relationship_profile(n, df, base) for n, df in cases.tables(spark, sf_dir).items())
    return rounded(a.unionByName(b).unionByName(c))


@query
def orphan_cases(spark, sf_dir):
    """Case ids that the base lacks."""
    return profile.orphan_cases(cases.events(spark, sf_dir), cases.base(spark, sf_dir))


@query
def cases_without_history(spark, sf_dir):
    """Cases without any row in a history."""
    return cases.base(spark, sf_dir).select("case_id").join(cases.history(spark, sf_dir).select("case_id"), "case_id", "left_anti")


@query
def duplicate_grain(spark, sf_dir):
    """Rows beyond the first of each grain."""
    return profile.duplicate_rows(cases.history(spark, sf_dir))


@query
def quality_checks(spark, sf_dir):
    """Pass, warning or fail of all rules (Q1-Q8)."""
    return profile.checks_frame(spark, profile.quality_checks(cases.base(spark, sf_dir), cases.tables(spark, sf_dir)))


@query
def quality_summary(spark, sf_dir):
    """Checks by status."""
    found = profile.status_counts(profile.quality_checks(cases.base(spark, sf_dir), cases.tables(spark, sf_dir)))
    return spark.createDataFrame(list(found.items()), "status string, checks long")


@query
def negative_groups(spark, sf_dir):
    """Conditional counts on a column with negative and missing values."""
    c = F.when(F.col("c_acctbal") < 9000, F.col("c_acctbal"))
    return cases.read(spark, sf_dir, "customer").agg(F.count_if(c.isNull()).alias("nulls"), F.count_if(c < 0).alias("negatives"), F.count_if(c.isNotNull() & ~F.col("c_nationkey").isin(0, 1)).alias("others"))


# -- split -------------------------------------------------------------------------------------------


def _split(spark, sf_dir):
    return temporal.temporal_split(cases.base(spark, sf_dir))


@query
def weekly_profile(spark, sf_dir):
    """Counts and running shares by week."""
    return rounded(temporal.weekly_profile(cases.base(spark, sf_dir)), 9)


@query
def week_boundaries(spark, sf_dir):
    """The weeks at which the splits end."""
    b = temporal.choose_boundaries(temporal.weekly_profile(cases.base(spark, sf_dir)))
    return spark.createDataFrame([(b.train_end_week, b.validation_start_week, b.validation_end_week, b.test_start_week)], "train_end_week int, validation_start_week int, validation_end_week int, test_start_week int")


@query
def split_labels(spark, sf_dir):
    """The split of each case."""
    return _split(spark, sf_dir)[0]


@query
def split_diagnostics(spark, sf_dir):
    """Counts and ranges of the splits."""
    return rounded(temporal.split_diagnostics(_split(spark, sf_dir)[0]), 9)


@query
def split_validation(spark, sf_dir):
    """Whether the split holds."""
    return temporal.validation(*_split(spark, sf_dir))


@query
def target_drift(spark, sf_dir):
    """Differences of the rates between splits (Q11)."""
    return rounded(temporal.target_drift(_split(spark, sf_dir)[0]), 9)


@query
def split_overlaps(spark, sf_dir):
    """Cases that splits share (E5, Q12); the two halves of a history stand for a faulty split."""
    h = cases.history(spark, sf_dir)
    return temporal.split_overlaps(h.select("case_id", F.when(F.col("num_group1") < 3, "train").when(F.col("num_group1") < 5, "validation").otherwise("test").alias("split")))


@query
def split_scan(spark, sf_dir):
    """The rows of a split by its range of weeks."""
    split, _ = _split(spark, sf_dir)
    return temporal.split_scan(cases.base(spark, sf_dir), split, "validation", ["date_decision"])


@query
def limited_split_scan(spark, sf_dir):
    """The first rows of a split in order."""
    split, _ = _split(spark, sf_dir)
    return temporal.split_scan(cases.base(spark, sf_dir), split, "train", ["MONTH"], row_limit=500)


@query
def split_row_counts(spark, sf_dir):
    """Expected rows of each split under a limit."""
    split, _ = _split(spark, sf_dir)
    return temporal.expected_row_counts(split, 1000)


@query
def target_values(spark, sf_dir):
    """The distinct targets."""
    return cases.base(spark, sf_dir).select("target").distinct()


# -- preparation and model ---------------------------------------------------------------------------


def _modeling(spark, sf_dir) -> DataFrame:
    out = cases.base(spark, sf_dir).join(cases.static(spark, sf_dir), "case_id", "left")
    return out.withColumn("rich", F.col("acctbal") > 5000)


PREDICTORS = ["totalprice", "acctbal", "nation", "priority", "mktsegment", "rich"]


@query
def numeric_stats(spark, sf_dir):
    """Means and scales of the train split."""
    split, _ = _split(spark, sf_dir)
    return rounded(prep.numeric_stats(temporal.split_scan(_modeling(spark, sf_dir), split, "train", ["totalprice", "acctbal", "nation"]), ["totalprice", "acctbal", "nation"]), 4)


@query
def standardised(spark, sf_dir):
    """Imputed and scaled numbers (math)."""
    m = _modeling(spark, sf_dir).select("case_id", "totalprice", "acctbal")
    return rounded(prep.standardise(m, prep.stats_dict(prep.numeric_stats(m, ["totalprice", "acctbal"]))), 5)


@query
def booleans_and_tokens(spark, sf_dir):
    """Booleans as numbers and categories as tokens, with missing values."""
    return _modeling(spark, sf_dir).select("case_id", boolean_value(F.col("rich")).alias("rich"), token("mktsegment", F.col("mktsegment")).alias("mktsegment"), missing_flag(F.col("acctbal")).cast("long").alias("no_balance"))


@query
def predictor_kinds(spark, sf_dir):
    """Predictors by kind (M2)."""
    p = prep.predictor_sets(_modeling(spark, sf_dir).schema, PREDICTORS)
    return spark.createDataFrame([(n, k) for k in ("numeric", "categorical", "boolean") for n in getattr(p, k)], "predictor string, kind string")


@query
def class_weights(spark, sf_dir):
    """Balanced weights of the classes."""
    w = prep.class_weights(cases.base(spark, sf_dir), "balanced")
    return rounded(spark.createDataFrame(list(w.items()), "target long, weight double"), 9)


@query
def hashed_design(spark, sf_dir):
    """Numbers, booleans and hashed categories as one vector (M3): its size, its sums by part, and the number of categories."""
    from pyspark.ml.functions import vector_to_array

    m = _modeling(spark, sf_dir)
    p = prep.predictor_sets(m.schema, PREDICTORS)
    d = prep.design(m, p, prep.stats_dict(prep.numeric_stats(m, list(p.numeric))))
    v, n = vector_to_array("features"), len(p.numeric)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    out = d.select("case_id", F.size(v).cast("long").alias("size"), total(F.slice(v, 1, n)).alias("numbers"), F.get(v, F.lit(n)).alias("booleans"), total(F.slice(v, n + 2, prep.HASH_BUCKETS)).alias("hashed"))
    return rounded(out, 5)


def _baseline(spark, sf_dir):
    split, _ = _split(spark, sf_dir)
    return _modeling(spark, sf_dir), split


@query
def logistic_scores(spark, sf_dir):
    """Scores of the validation split (M4, M5)."""
    m, split = _baseline(spark, sf_dir)
    p = prep.predictor_sets(m.schema, PREDICTORS)
    base = model.fit(temporal.split_scan(m, split, "train", PREDICTORS), p)
    return base.score(temporal.split_scan(m, split, "validation", PREDICTORS))


@query
def baseline_artifacts(spark, sf_dir):
    """A whole run, written and read again: rows and positives of each split, and of its deciles."""
    folder = fresh(spark, "run")
    model.write_artifacts(spark, model.run_baseline(*_baseline(spark, sf_dir), PREDICTORS), folder)
    metrics = json.loads(read_text(spark, f"{folder}/metrics.json"))
    stored = spark.read.parquet(f"{folder}/scores").groupBy("split").agg(F.count(F.lit(1)).alias("scores"))
    rows = spark.createDataFrame([(s, m["rows"], m["positive_cases"], len(m["deciles"]), sum(d["positive_cases"] for d in m["deciles"]), 0 <= m["roc_auc"] <= 1) for s, m in metrics.items()], "split string, rows long, positive_cases long, deciles long, decile_positives long, auc_in_range boolean")
    return rows.join(stored, "split")


@query
def model_registry(spark, sf_dir):
    """Records of two runs, one written twice, and their comparison."""
    folder, path = fresh(spark, "run"), f"{fresh(spark, 'registry')}/models.json"
    m, split = _baseline(spark, sf_dir)
    model.write_artifacts(spark, model.run_baseline(m, split, PREDICTORS[:2], iterations=50), folder)
    ranges = temporal.checked_diagnostics(split)
    for name in ("first", "second", "first"):
        found = registry.write(spark, path, registry.from_artifacts(spark, name, folder, ranges, role="baseline"), official="first")
    kept = {x["model_name"]: x["temporal_ranges"]["test"] for x in found["models"]}
    rows = [(r["model"], r["official"], kept[r["model"]]["week_start"], kept[r["model"]]["week_end"]) for r in registry.comparison(found)]
    return spark.createDataFrame(rows, "model string, official boolean, test_week_start int, test_week_end int")


@query
def training_throughput(spark, sf_dir):
    """Rows and predictors of a timed fit on 1000 cases, and whether a full fit fits an hour (M8)."""
    t = model.throughput(*_baseline(spark, sf_dir), PREDICTORS, row_limit=1000)
    return spark.createDataFrame([(t["rows"], t["predictors"], t["go"])], "rows long, predictors long, go boolean")


@query
def weight_diagnostic(spark, sf_dir):
    """Validation metrics for all class weights (M7)."""
    m, split = _baseline(spark, sf_dir)
    rows = model.weight_diagnostic(m, split, PREDICTORS)
    return spark.createDataFrame([(r["class_weight"], float(r["roc_auc"]), float(r["ks"]), float(r["top_decile_lift"])) for r in rows], "class_weight string, roc_auc double, ks double, top_decile_lift double")


@query
def baseline_inputs(spark, sf_dir):
    """Checks of the model's inputs (Q12)."""
    m, split = _baseline(spark, sf_dir)
    v = model.verify_inputs(m, split, prep.predictor_sets(m.schema, PREDICTORS))
    return spark.createDataFrame([(",".join(map(str, v["target_values"])), v["predictor_count"], v["label_columns_excluded_from_predictors"], v["no_split_case_overlap"])], "target_values string, predictors long, labels_excluded boolean, no_overlap boolean")


# -- metrics -----------------------------------------------------------------------------------------


@query
def roc_auc(spark, sf_dir):
    """Rank-sum AUC and Gini (M9)."""
    return rounded(metrics.roc_auc(cases.scored(spark, sf_dir)), 9)


@query
def average_precision(spark, sf_dir):
    """Average precision, ties as one step."""
    return rounded(metrics.average_precision(cases.scored(spark, sf_dir)), 9)


@query
def ks(spark, sf_dir):
    """Kolmogorov-Smirnov, row by row."""
    return rounded(metrics.ks(cases.scored(spark, sf_dir)), 9)


@query
def brier(spark, sf_dir):
    """Mean squared error of the scores."""
    return rounded(metrics.brier(cases.scored(spark, sf_dir)), 9)


@query
def probability_summary(spark, sf_dir):
    """Quantiles of the scores."""
    return rounded(metrics.probability_summary(cases.scored(spark, sf_dir)), 9)


@query
def decile_table(spark, sf_dir):
    """Tenths by falling score with lifts."""
    return rounded(metrics.decile_table(cases.scored(spark, sf_dir)), 9)


@query
def top_deciles(spark, sf_dir):
    """The first tenth and three tenths."""
    return rounded(metrics.top_deciles(metrics.decile_table(cases.scored(spark, sf_dir))), 9)


@query
def calibration(spark, sf_dir):
    """Intercept and slope of the outcome on the logit (M15); iterative."""
    c = metrics.calibration(cases.scored(spark, sf_dir))
    return rounded(spark.createDataFrame([(c["calibration_intercept"], c["calibration_slope"])], "intercept double, slope double"), 6)


@query
def evaluation(spark, sf_dir):
    """All metrics at once."""
    e = metrics.evaluate(cases.scored(spark, sf_dir))
    return rounded(spark.createDataFrame([(e["rows"], e["positive_cases"], e["positive_rate"], e["roc_auc"], e["pr_auc"], e["ks"], e["brier_score"], e["deciles"][0]["lift"])], "rows long, positive_cases long, positive_rate double, roc_auc double, pr_auc double, ks double, brier_score double, top_decile_lift double"), 9)


@query
def score_logits(spark, sf_dir):
    """Logits of clipped scores."""
    return rounded(cases.scored(spark, sf_dir).select("case_id", logit(F.when(F.col("case_id") % 10 == 0, F.lit(1.0)).otherwise(F.col("score"))).alias("logit")), 6)


@query
def labelled_documents(spark, sf_dir):
    """Labels as cases with documents as their static table."""
    d = assemble.one_per_case(cases.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("case_id"), "lang", "n_chars"))
    return cases.read(spark, sf_dir, "labels").select(F.col("doc_id").alias("case_id"), F.col("quality").cast("long").alias("target"), F.col("toxic").cast("long").alias("toxic")).join(d, "case_id", "left")


def queries() -> dict:
    return dict(Q)
