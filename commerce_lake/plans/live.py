"""Live marts over the hot bronze log, evaluated as of a given instant.

All take the newest version of each row first. `orders`, `items`, `payments`
and `products` are bronze tables (append logs with many versions per key).
Day filters on the update time go below the ranking where that is exact, see
`latest_updated_on`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.numbers import SUM_DECIMAL, exact_sum, line_value, percentage
from commerce_lake.functions.time import (
    as_timestamp,
    hour_boundaries,
    is_today,
    local_date,
    slot_start,
    within_lookback,
)
from commerce_lake.operators.dedup import latest_among, latest_by_key, latest_updated_on, latest_where
from commerce_lake.operators.joins import left_join_default
from commerce_lake.schemas import DAY, SEQ

Instant = Column | dt.datetime | str

# Zone that defines "today" and the alert limits.
REPORT_TZ = "Asia/Jakarta"
ORDER_LOOKBACK = "15 minutes"
ORDER_VALUE_LIMIT = 400
FAILED_PAYMENT_LIMIT = 3
STUCK_HOURS = 1
TOP_PRODUCTS = 10


def _pick(df: DataFrame, *names: str) -> DataFrame:
    """Needed columns plus what ranking and partition pruning use."""
    extra = [c for c in ("updated_at", SEQ, DAY) if c in df.columns and c not in names]
    return df.select(*names, *extra)


def _latest(df: DataFrame, key: str, *names: str) -> DataFrame:
    return latest_by_key(_pick(df, key, *names), key)


def _completed_today(orders: DataFrame, as_of: Instant, tz: str, *names: str) -> DataFrame:
    rows = _pick(orders, "order_id", "order_status", *names)
    newest = latest_updated_on(rows, "order_id", local_date(as_of, tz))
    return newest.where(F.col("order_status") == "completed").select("order_id", *names)


def _item_totals(items: DataFrame, orders: DataFrame, *keys: str) -> DataFrame:
    """Quantity and value of the newest item versions of some orders, summed per key.

    Only items that belong to these orders in some version are ranked. Summed before any join: an order or product with very many items becomes
    one row per task ahead of the shuffle.
    """
    columns = dict.fromkeys([*keys, "quantity", "price"])
    newest = latest_among(_pick(items, "order_item_id", *columns), "order_item_id", orders, "order_id")
    return newest.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"),
        exact_sum(line_value(F.col("price"), F.col("quantity"))).alias("value"),
    )


def order_revenue(orders: DataFrame, items: DataFrame, as_of: Instant, tz: str = REPORT_TZ) -> DataFrame:
    """Completed orders updated today by hour of creation.

    Item totals and newest orders are both unique per order, so the order count
    is a plain count.
    """
    done = _completed_today(orders, as_of, tz, "created_at")
    return (
        done.join(_item_totals(items, done, "order_id"), "order_id")
        .groupBy(F.hour("created_at").alias("hour"))
        .agg(
            F.count("*").alias("order_count"),
            F.sum("quantity").alias("items_sold"),
            F.sum("value").cast(SUM_DECIMAL).alias("revenue"),
        )
        .orderBy("hour")
    )


def unique_user(orders: DataFrame, as_of: Instant, tz: str = REPORT_TZ) -> DataFrame:
    """Distinct users and number of orders among the orders updated today."""
    rows = _pick(orders, "order_id", "user_id")
    return latest_updated_on(rows, "order_id", local_date(as_of, tz)).agg(
        F.count_distinct("user_id").alias("active_users"), F.count("*").alias("total_orders")
    )


def top_selling_product(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    as_of: Instant,
    tz: str = REPORT_TZ,
    limit: int = TOP_PRODUCTS,
    latest_products: bool = False,
) -> DataFrame:
    """Best product names by revenue in completed orders updated today.

    Every stored version of a product counts its items again unless
    `latest_products` is set; equal revenue is ordered by name.
    """
    names = _latest(products, "product_id", "name") if latest_products else products
    sold = (
        _item_totals(items, _completed_today(orders, as_of, tz), "order_id", "product_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("quantity"), F.sum("value").cast(SUM_DECIMAL).alias("value"))
    )
    return (
        sold.join(names.select("product_id", "name"), "product_id")
        .groupBy("name")
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("value").cast(SUM_DECIMAL).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "name")
        .limit(limit)
    )


def payment_failure_rate(payments: DataFrame, as_of: Instant, tz: str = REPORT_TZ) -> DataFrame:
    """Share of failed payments dated today; the newest payment of each order counts."""
    rows = _pick(payments, "order_id", "status", "payment_date")
    newest = latest_where(rows, "order_id", is_today(F.col("payment_date"), as_of, tz))
    failed = F.count_if(F.col("status") == "failed")
    return newest.agg(
        failed.alias("failed"),
        F.count("*").alias("total"),
        percentage(failed, F.count("*")).alias("failed_rate"),
    )


def abnormal_order(
    orders: DataFrame,
    items: DataFrame,
    as_of: Instant,
    lookback: str = ORDER_LOOKBACK,
    threshold: float = ORDER_VALUE_LIMIT,
    updates_follow_creation: bool = False,
) -> DataFrame:
    """Users whose recently created orders exceed a value.

    Creation time says nothing about which version is newest, so by default all
    versions of orders created in the look-back are ranked. Where no version is stamped before its order's creation
    set `updates_follow_creation`: the look-back then also bounds the update
    time and only the last partitions are read.
    """
    rows = _pick(orders, "order_id", "user_id", "created_at")
    if updates_follow_creation:
        bound = as_timestamp(as_of) - F.expr(f"INTERVAL {lookback}")
        rows = rows.where(F.col("updated_at") >= bound)
        if DAY in rows.columns:
            rows = rows.where(F.col(DAY) >= F.to_date(bound))
    recent = latest_where(rows, "order_id", within_lookback(F.col("created_at"), as_of, lookback)).select("order_id", "user_id")
    return (
        recent.join(_item_totals(items, recent, "order_id"), "order_id")
        .groupBy("user_id")
        .agg(F.sum("value").cast(SUM_DECIMAL).alias("total_order_value"))
        .where(F.col("total_order_value") > threshold)
    )


def abnormal_payment(
    payments: DataFrame, orders: DataFrame, threshold: int = FAILED_PAYMENT_LIMIT, slot_minutes: int = 5
) -> DataFrame:
    """Users with several failed payments inside one slot of `slot_minutes`.

    Failures are counted per order and slot before the order lookup; payments
    without an order belong to user 0.
    """
    rows = _pick(payments, "payment_id", "order_id", "status", "payment_date")
    failures = (
        latest_where(rows, "payment_id", F.col("status") == "failed")
        .groupBy("order_id", slot_start(F.col("payment_date"), slot_minutes).alias("window_start"))
        .agg(F.count("*").alias("n"))
    )
    named = orders.join(failures.select("order_id").distinct(), "order_id", "left_semi")
    owners = _latest(named, "order_id", "user_id").select("order_id", "user_id")
    return (
        left_join_default(failures, owners, "order_id", {"user_id": 0})
        .groupBy("user_id", "window_start")
        .agg(F.sum("n").alias("failed_count"))
        .where(F.col("failed_count") >= threshold)
        .select(
            "user_id",
            "failed_count",
            "window_start",
            (F.col("window_start") + F.make_interval(mins=F.lit(slot_minutes))).alias("window_end"),
        )
    )


def stuck_order(orders: DataFrame, as_of: Instant, hours: int = STUCK_HOURS) -> DataFrame:
    """Orders still in 'created' after more than `hours` full-hour marks, longest first."""
    now = as_timestamp(as_of)
    return (
        _latest(orders, "order_id", "order_status", "created_at")
        .where(F.col("order_status") == "created")
        .select(
            "order_id",
            "created_at",
            now.alias("current_time"),
            hour_boundaries(F.col("created_at"), now).alias("hours_since_order"),
        )
        .where(F.col("hours_since_order") > hours)
        .orderBy(F.desc("hours_since_order"), "order_id")
    )
