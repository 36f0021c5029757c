"""Bindings of the operators to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weft.operators import baskets, sequences


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"])


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), order_lines(spark, sf_dir)
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def brand_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order x brand: many items, few per basket."""
    return baskets.grouped(order_lines(spark, sf_dir), "l_orderkey", "p_brand")


def type_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order x type: six items, dense."""
    return baskets.grouped(order_lines(spark, sf_dir), "l_orderkey", "p_type")


def priority_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities of a customer by order date."""
    return sequences.temporal(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderdate")


def event_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.events(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id")


def event_sessions(spark: SparkSession, sf_dir: str, gap: float) -> DataFrame:
    return sequences.sessions(table(spark, sf_dir, "events"), "user_id", "event_type", "ts", "event_id", gap)


def purchase_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types of a customer, one element per order."""
    return sequences.by_transaction(
        customer_lines(spark, sf_dir), "o_custkey", "o_orderkey", "p_type", "o_orderdate"
    )
