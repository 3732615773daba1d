"""Order facts of one day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.time import as_date, on_day
from commerce_lake.operators.joins import asof_inner, asof_left, left_join_default

Day = dt.date | str

# Order states that end an order and produce a second fact row.
FINAL_STATES = ("completed", "cancelled")

SCHEMAS = {
    "fact_order": (
        "order_id bigint, user_key string, order_status string, order_created_time timestamp, "
        "order_completed_time timestamp, payment_method string, postal_code string, country string, "
        "city string, total_amount decimal(18,2), date_key date"
    ),
    "fact_order_detail": (
        "order_id bigint, product_key string, category_key string, quantity int, "
        "price_amount decimal(18,2), date_key date"
    ),
}


def orders_of(orders: DataFrame, day: Day | None) -> DataFrame:
    """Orders with an event on `day`: created on it, or completed or cancelled by an update on it."""
    on = (lambda at: F.lit(True)) if day is None else (lambda at: on_day(at, day))
    return orders.where(on(F.col("created_time")) | (on(F.col("updated_time")) & F.col("order_status").isin(*FINAL_STATES)))


def fact_order(
    orders: DataFrame, dim_user: DataFrame, shipping: DataFrame, payment: DataFrame, day: Day | None
) -> DataFrame:
    """One row per order and lifecycle event of `day`, or of every day without one.

    Every order created on the day gives a 'created' row whatever its status;
    a completed or cancelled order updated on the day gives a second one. The
    user version is the one valid when the order was created, and an order
    without such a version is dropped. Several payments or shipments of one
    order multiply its rows.

    All events share these joins, so the joins run once and the rows branch
    afterwards.
    """
    created, updated, status = F.col("created_time"), F.col("updated_time"), F.col("order_status")
    on = (lambda at: F.lit(True)) if day is None else (lambda at: on_day(at, day))
    ended = on(updated) & status.isin(*FINAL_STATES)
    todays = orders_of(
        orders.select("order_id", "user_id", "order_status", "total_amount", "created_time", "updated_time"), day
    )

    rows = asof_inner(todays, dim_user, "user_id", F.to_date(created), ["user_key"]).drop("user_id")
    rows = left_join_default(
        rows,
        shipping.select("order_id", "postal_code", "country", "city"),
        "order_id",
        {"postal_code": "", "country": "", "city": ""},
    )
    rows = left_join_default(
        rows,
        payment.select("order_id", "payment_method"),
        "order_id",
        {"payment_method": ""},
    )

    def event(condition, at, label, completed_time):
        return F.when(
            condition,
            F.struct(
                F.to_date(at).alias("date_key"),
                label.alias("order_status"),
                completed_time.alias("order_completed_time"),
            ),
        )

    completed_time = F.when(status == "completed", updated)
    events = F.array_compact(
        F.array(
            event(on(created), created, F.lit("created"), F.lit(None).cast("timestamp")),
            event(ended, updated, status, completed_time),
        )
    )
    return rows.withColumn("event", F.explode(events)).select(
        "order_id",
        "user_key",
        "event.date_key",
        "event.order_status",
        created.alias("order_created_time"),
        "event.order_completed_time",
        "payment_method",
        "postal_code",
        "country",
        "city",
        "total_amount",
    )


def fact_order_detail(
    items: DataFrame, dim_product: DataFrame, dim_category: DataFrame, day: Day | None
) -> DataFrame:
    """One row per order item created on `day`, with the keys valid on that day.

    Without a day, one row per item of any day, with the keys valid when it was created.

    The category is looked up through the product version; an unknown product
    has category 0, which no dimension row carries unless it was loaded as such.
    """
    rows = items.select("order_id", "product_id", "quantity", "price_amount", "created_time")
    created = F.to_date("created_time")
    if day is not None:
        rows = rows.where(on_day(F.col("created_time"), day))
    at = created if day is None else day
    rows = asof_left(rows, dim_product, "product_id", at, ["product_key", "category_id"], {"product_key": "", "category_id": 0})
    rows = asof_left(rows, dim_category, "category_id", at, ["category_key"], {"category_key": ""})
    date = created if day is None else as_date(day)
    return rows.select("order_id", date.alias("date_key"), "product_key", "category_key", "quantity", "price_amount")
