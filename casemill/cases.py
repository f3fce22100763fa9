"""The driver's tables in the roles of base, static table and histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.plans.catalog import CatalogColumn, catalog_columns
from casemill.plans.specs import FeatureSpec, registry

DEFINITIONS = {
    "quantity": "Number of items in the record", "extendedprice": "Price paid for the record", "discount": "Share taken off", "shipdate_1D": "Date of shipment",
    "returnflag_1M": "Status of the return", "linestatus_1M": "Status category of the record", "acctbal": "Amount of the account balance", "mktsegment": "Category of the customer",
    "nation": "District of residence", "totalprice": "Total amount of the application", "priority": "Type of the request", "value": "Payment made in the event", "event_type": "Type of the event",
    "event_time_2D": "Date of the event", "target": "Outcome", "unused_feature": "Not in any table",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cases: target 1 for status F, weeks since 1995."""
    d = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("case_id"), (F.col("o_orderstatus") == "F").cast("long").alias("target"), F.date_format(d, "yyyy-MM-dd").alias("date_decision"),
        F.floor(F.datediff(d, F.lit("1995-01-01").cast("date")) / 7).cast("int").alias("WEEK_NUM"), (F.year(d) * 100 + F.month(d)).cast("int").alias("MONTH"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a history of depth 1."""
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").cast("long").alias("num_group1"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extendedprice"),
        F.col("l_discount").alias("discount"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate_1D"), F.col("l_returnflag").alias("returnflag_1M"), F.col("l_linestatus").alias("linestatus_1M"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a history of depth 2; some users are no cases."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("case_id"), F.pmod(F.col("event_id"), F.lit(50)).alias("num_group1"), F.floor(F.col("event_id") / 50).cast("long").alias("num_group2"),
        F.col("value"), F.col("event_type"), F.date_format("ts", "yyyy-MM-dd").alias("event_time_2D"),
    )


def static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the orders as a static table; orders of customers 7, 14, ... have none, some balances are missing."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id"), "o_custkey", F.col("o_totalprice").alias("totalprice"), F.col("o_orderpriority").alias("priority"))
    customers = read(spark, sf_dir, "customer").where("c_custkey % 7 <> 0").select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"), F.col("c_nationkey").alias("nation")
    )
    return orders.join(customers, "o_custkey").drop("o_custkey")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"static_0": static(spark, sf_dir), "applprev_1": history(spark, sf_dir), "person_2": events(spark, sf_dir)}


def catalog(spark: SparkSession, sf_dir: str) -> list[CatalogColumn]:
    frames = {"base": base(spark, sf_dir), **tables(spark, sf_dir)}
    return catalog_columns({n: df.schema for n, df in frames.items()}, DEFINITIONS)


def specs(spark: SparkSession, sf_dir: str) -> list[FeatureSpec]:
    return registry(catalog(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a score that falls with the price, in steps, so that many are equal."""
    price = F.round(F.col("o_totalprice") / 1000) * 1000
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.round(1 / (1 + price / 150000), 6).alias("score"))
