"""Alerts over change streams: the streaming form of three live marts.

Late rows count while they are less than `delay` behind the newest event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.numbers import SUM_DECIMAL
from commerce_lake.operators.joins import left_join_default
from commerce_lake.plans.live import (
    FAILED_PAYMENT_LIMIT,
    ORDER_LOOKBACK,
    ORDER_VALUE_LIMIT,
    STUCK_HOURS,
)

DELAY = "10 minutes"


def with_owner(payments: DataFrame, owners: DataFrame) -> DataFrame:
    """Add each payment's user from a snapshot of newest orders; user 0 if there is none."""
    return left_join_default(payments, owners.select("order_id", "user_id"), "order_id", {"user_id": 0})


def abnormal_payment(
    payments: DataFrame, threshold: int = FAILED_PAYMENT_LIMIT, slot: str = "5 minutes", delay: str = DELAY
) -> DataFrame:
    """Users with several failed payments in one time slot, from (user_id, status, payment_date) rows.

    Use update mode: a user is reported again as the count grows.
    """
    return (
        payments.where(F.col("status") == "failed")
        .withWatermark("payment_date", delay)
        .groupBy("user_id", F.window("payment_date", slot))
        .agg(F.count("*").alias("failed_count"))
        .where(F.col("failed_count") >= threshold)
        .select(
            "user_id",
            "failed_count",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )


def abnormal_order(
    orders: DataFrame,
    threshold: float = ORDER_VALUE_LIMIT,
    lookback: str = ORDER_LOOKBACK,
    step: str = "1 minute",
    delay: str = DELAY,
) -> DataFrame:
    """Users whose orders in a rolling period exceed a value, from (user_id, created_at, order_value) rows."""
    return (
        orders.withWatermark("created_at", delay)
        .groupBy("user_id", F.window("created_at", lookback, step))
        .agg(F.sum("order_value").cast(SUM_DECIMAL).alias("total_order_value"))
        .where(F.col("total_order_value") > threshold)
        .select(
            "user_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "total_order_value",
        )
    )


def stuck_order(created: DataFrame, ended: DataFrame, hours: int = STUCK_HOURS, delay: str = DELAY) -> DataFrame:
    """Orders whose end does not arrive in time, reported once when their deadline has passed.

    The deadline is the first instant at which more than `hours` full-hour marks
    lie behind the creation. An outer join of two streams reports an order when
    the watermark rules out that a matching end still comes; join state is
    dropped at the same moment, so it holds open orders only.
    """
    opened = (
        created.select("order_id", "created_at")
        .withColumn("deadline", F.date_trunc("hour", "created_at") + F.expr(f"INTERVAL {hours + 1} HOURS"))
        .withWatermark("created_at", delay)
    )
    closed = ended.select(F.col("order_id").alias("ended_id"), F.col("updated_at").alias("ended_at")).withWatermark(
        "ended_at", delay
    )
    in_time = (
        (F.col("order_id") == F.col("ended_id"))
        & (F.col("ended_at") >= F.col("created_at"))
        & (F.col("ended_at") <= F.col("created_at") + F.expr(f"INTERVAL {hours + 1} HOURS"))
        & (F.col("ended_at") < F.col("deadline"))
    )
    return (
        opened.join(closed, in_time, "left_outer")
        .where(F.col("ended_id").isNull())
        .select("order_id", "created_at", F.col("deadline").alias("alert_time"))
    )
