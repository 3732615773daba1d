"""Daily marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.numbers import SUM_DECIMAL, sum_or_zero
from commerce_lake.functions.time import as_date
from commerce_lake.operators.joins import left_join_default

Day = dt.date | str

SCHEMAS = {
    "daily_transaction": (
        "order_status string, payment_method string, category string, country string, city string, "
        "total_order bigint, total_user bigint, items_sold bigint, total_revenue decimal(38,2), date_key date"
    ),
    "daily_user": "active_user bigint, new_user bigint, date_key date",
}


def daily_transaction(
    fact_order: DataFrame,
    fact_order_detail: DataFrame,
    dim_category: DataFrame,
    day: Day,
    detail_since: Day | None = None,
) -> DataFrame:
    """Orders, users, items and revenue by status, method, category and place.

    Details join by order alone: an order with a created and a completed row on
    one day counts its details in both groups, and revenue adds unit prices
    without quantity. Only completed rows add items and revenue.

    Only details of the day's orders are summed, per order and category, before they
    are joined, so that an order with very many items joins as few rows.
    `detail_since` bounds the detail partitions read, for callers who know the oldest
    order that can still be in the day.
    """
    orders = fact_order.where(F.col("date_key") == as_date(day))
    detail = fact_order_detail
    if detail_since is not None:
        detail = detail.where(F.col("date_key") >= as_date(detail_since))
    detail = detail.join(orders.select("order_id").distinct(), "order_id", "left_semi")
    per_order = detail.groupBy("order_id", "category_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("price_amount").alias("price_amount")
    )
    rows = left_join_default(
        orders.select("date_key", "order_id", "user_key", "order_status", "payment_method", "country", "city"),
        per_order,
        "order_id",
        {"category_key": "", "quantity": 0, "price_amount": 0},
    )
    names = dim_category.select("category_key", F.col("name").alias("category"))
    rows = left_join_default(rows, names, "category_key", {"category": ""})
    done = F.col("order_status") == "completed"
    return rows.groupBy("date_key", "order_status", "payment_method", "category", "country", "city").agg(
        F.count_distinct("order_id").alias("total_order"),
        F.count_distinct("user_key").alias("total_user"),
        sum_or_zero(F.when(done, F.col("quantity")), "bigint").alias("items_sold"),
        sum_or_zero(F.when(done, F.col("price_amount")), SUM_DECIMAL).alias("total_revenue"),
    )


def daily_user(fact_order: DataFrame, dim_user: DataFrame, day: Day) -> DataFrame:
    """Active users of a day and, of these, those created on it.

    Fact rows are reduced to distinct user keys before the join; distinct
    counts do not notice, and a very active user joins as one row.
    """
    keys = fact_order.where(F.col("date_key") == as_date(day)).select("date_key", "user_key").distinct()
    users = dim_user.select("user_key", "user_id", "created_time")
    is_new = F.to_date("created_time") == F.col("date_key")
    return (
        keys.join(users, "user_key")
        .groupBy("date_key")
        .agg(
            F.count_distinct("user_id").alias("active_user"),
            F.count_distinct(F.when(is_new, F.col("user_id"))).alias("new_user"),
        )
    )
