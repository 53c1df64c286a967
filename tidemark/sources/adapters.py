"""Commerce tables (users, products, views, orders, items) out of the supplied test tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare
from tidemark.sources import schemas


@dataclass(frozen=True)
class Commerce:
    """The raw tables every feature and label is computed from."""

    users: DataFrame
    orders: DataFrame
    product_views: DataFrame
    products: DataFrame | None = None
    order_items: DataFrame | None = None

    def present(self) -> dict[str, DataFrame]:
        return {name: frame for name, frame in vars(self).items() if frame is not None}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return schemas.in_utc(prepare(spark).read.parquet(f"{folder}/{table}.parquet"))


def from_events(spark: SparkSession, folder: str) -> Commerce:
    """One month of user events: purchases are orders, `view` events are product views."""
    events = load(spark, folder, "events")
    return Commerce(
        users=events.groupBy("user_id").agg(F.min("ts").alias("signup_ts")),
        orders=events.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("order_id"),
            "user_id",
            F.col("ts").alias("order_ts"),
            F.col("value").cast(schemas.AMOUNT).alias("total_amount"),
        ),
        product_views=events.where(F.col("event_type") == "view").select(
            F.col("event_id").alias("view_id"),
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
            F.col("ts").alias("view_ts"),
        ),
        products=_products(spark, folder),
    )


def from_trade(spark: SparkSession, folder: str) -> Commerce:
    """Several years of orders: customers are users, shipped items count as product views."""
    orders = load(spark, folder, "orders")
    items = load(spark, folder, "lineitem")
    return Commerce(
        users=orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
            F.min("o_orderdate").alias("signup_ts")
        ),
        orders=orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_totalprice").cast(schemas.AMOUNT).alias("total_amount"),
        ),
        product_views=items.join(
            orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
        ).select(
            F.col("l_orderkey").alias("view_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_shipdate").alias("view_ts"),
        ),
        products=_products(spark, folder),
        order_items=items.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity"))
            .cast(schemas.PRICE)
            .alias("unit_price"),
        ),
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(schemas.PRICE).alias("price"),
    )
