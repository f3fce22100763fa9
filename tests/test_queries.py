"""Every registered query runs, and meets its SQL where it has any."""

import duckdb
import pandas as pd
import pytest

from casemill import oracle, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame):
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return ""
        if isinstance(v, bool):
            return str(v)
        try:
            return f"{round(float(v), 7):g}"
        except (TypeError, ValueError):
            return str(v)

    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_meets_its_sql(spark, duck, sf_dir, name):
    got, want = queries.queries()[name](spark, sf_dir).toPandas(), duck.execute(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(oracle.oracle_sql())))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert queries.queries()[name](spark, sf_dir).count() >= 0


def test_all_sql_has_a_query():
    assert set(oracle.oracle_sql()) <= set(queries.queries())


def test_selection_judges_all_cases(spark, sf_dir, tmp_path):
    """A column that is constant and absent on the 200 smallest cases alone is judged by the whole table."""
    from pyspark.sql import functions as F

    for t in ("customer", "events", "lineitem"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    edge = orders.orderBy("o_orderkey").limit(200).agg(F.max("o_orderkey")).first()[0]
    first = F.col("o_orderkey") <= edge
    orders.withColumn("o_totalprice", F.when(first, F.lit(1.0)).otherwise(F.col("o_totalprice"))).withColumn("o_custkey", F.when(first, F.lit(7)).otherwise(F.col("o_custkey")).cast("long")).write.parquet(str(tmp_path / "orders.parquet"))
    rows = queries.queries()["feature_selection"](spark, str(tmp_path)).collect()
    price = [r for r in rows if r.source_table == "static_0" and r.transformation == "direct" and "totalprice" in r.feature_name]
    assert price and all(r.decision == "keep" for r in price), price
    counts = {(r.feature_family, r.decision): r.features for r in queries.queries()["selection_counts"](spark, str(tmp_path)).collect()}
    assert counts == {k: sum((r.feature_family, r.decision) == k for r in rows) for k in {(r.feature_family, r.decision) for r in rows}}
