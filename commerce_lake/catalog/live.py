"""Live views and the building blocks they share."""

from __future__ import annotations

from pyspark.sql import functions as F

from commerce_lake.catalog import AS_OF, DAY, LATE_AS_OF, query
from commerce_lake.catalog.views import LATEST_ITEM, LATEST_ORDER, LATEST_PAYMENT, latest
from commerce_lake.functions.time import is_today
from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.plans import live

_TODAY = f"DATE '{DAY}'"


@query("latest_by_key", f"SELECT * EXCLUDE (_seq) FROM {LATEST_ITEM}")
def _latest_by_key(fx):
    return latest_by_key(fx["order_item"], "order_item_id").drop("_seq")


@query(
    "latest_payment_per_order",
    f"SELECT order_id, payment_id, status, payment_date FROM {latest('t_payment', 'order_id')}",
)
def _latest_payment(fx):
    newest = latest_by_key(fx["payment"], "order_id")
    return newest.select("order_id", "payment_id", "status", "payment_date")


@query(
    "today_in_tz",
    f"""SELECT order_id, updated_at FROM {LATEST_ORDER}
        WHERE CAST(updated_at AS DATE) = CAST(TIMESTAMP '{LATE_AS_OF}' + INTERVAL 7 HOUR AS DATE)""",
)
def _today_in_tz(fx):
    newest = latest_by_key(fx["order"], "order_id")
    return newest.where(is_today(F.col("updated_at"), LATE_AS_OF, "Asia/Jakarta")).select("order_id", "updated_at")


@query(
    "live_order_revenue",
    f"""SELECT CAST(hour(o.created_at) AS INTEGER) AS hour, count(DISTINCT o.order_id) AS order_count,
               CAST(sum(i.quantity) AS BIGINT) AS items_sold,
               CAST(sum(i.price * i.quantity) AS DECIMAL(38,2)) AS revenue
        FROM {LATEST_ORDER} o JOIN {LATEST_ITEM} i ON o.order_id = i.order_id
        WHERE CAST(o.updated_at AS DATE) = {_TODAY} AND o.order_status = 'completed'
        GROUP BY 1 ORDER BY 1""",
)
def _order_revenue(fx):
    return live.order_revenue(fx["order"], fx["item_line"], AS_OF)


@query(
    "live_unique_user",
    f"""SELECT count(DISTINCT user_id) AS active_users, count(*) AS total_orders
        FROM {LATEST_ORDER} WHERE CAST(updated_at AS DATE) = {_TODAY}""",
)
def _unique_user(fx):
    return live.unique_user(fx["order"], AS_OF)


@query(
    "live_top_selling_product",
    f"""SELECT p.name AS name, CAST(sum(i.quantity) AS BIGINT) AS total_quantity,
               CAST(sum(i.price * i.quantity) AS DECIMAL(38,2)) AS revenue
        FROM {LATEST_ITEM} i JOIN t_product p ON i.product_id = p.product_id
             JOIN {LATEST_ORDER} o ON i.order_id = o.order_id
        WHERE CAST(o.updated_at AS DATE) = {_TODAY} AND o.order_status = 'completed'
        GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
)
def _top_selling_product(fx):
    return live.top_selling_product(fx["order"], fx["item_line"], fx["product"], AS_OF)


@query(
    "live_payment_failure_rate",
    f"""SELECT count(*) FILTER (status = 'failed') AS failed, count(*) AS total,
               round_even(100.0::DOUBLE * count(*) FILTER (status = 'failed') / nullif(count(*), 0), 2) AS failed_rate
        FROM {latest('t_payment', 'order_id')} WHERE CAST(payment_date AS DATE) = {_TODAY}""",
)
def _payment_failure_rate(fx):
    return live.payment_failure_rate(fx["payment"], AS_OF)


@query(
    "live_abnormal_order",
    f"""SELECT o.user_id AS user_id, CAST(sum(i.price * i.quantity) AS DECIMAL(38,2)) AS total_order_value
        FROM {LATEST_ORDER} o JOIN {LATEST_ITEM} i ON o.order_id = i.order_id
        WHERE o.created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR AND o.created_at <= TIMESTAMP '{AS_OF}'
        GROUP BY 1 HAVING sum(i.price * i.quantity) > 4000000""",
)
def _abnormal_order(fx):
    return live.abnormal_order(fx["order"], fx["item_line"], AS_OF, lookback="24 hours", threshold=4_000_000)


@query(
    "live_abnormal_payment",
    f"""SELECT coalesce(o.user_id, 0) AS user_id, count(*) AS failed_count,
               time_bucket(INTERVAL 5 MINUTE, p.payment_date) AS window_start,
               time_bucket(INTERVAL 5 MINUTE, p.payment_date) + INTERVAL 5 MINUTE AS window_end
        FROM {LATEST_PAYMENT} p LEFT JOIN {LATEST_ORDER} o ON p.order_id = o.order_id
        WHERE p.status = 'failed' GROUP BY 1, 3, 4 HAVING count(*) >= 1""",
)
def _abnormal_payment(fx):
    return live.abnormal_payment(fx["payment"], fx["order"], threshold=1)


@query(
    "live_abnormal_payment_week",
    f"""SELECT coalesce(o.user_id, 0) AS user_id, count(*) AS failed_count,
               time_bucket(INTERVAL 7 DAY, p.payment_date, TIMESTAMP '1970-01-01') AS window_start,
               time_bucket(INTERVAL 7 DAY, p.payment_date, TIMESTAMP '1970-01-01') + INTERVAL 7 DAY AS window_end
        FROM {LATEST_PAYMENT} p LEFT JOIN {LATEST_ORDER} o ON p.order_id = o.order_id
        WHERE p.status = 'failed' GROUP BY 1, 3, 4 HAVING count(*) >= 2""",
)
def _abnormal_payment_week(fx):
    """Slots of a week, in which the limit keeps some groups and rejects the others."""
    return live.abnormal_payment(fx["payment"], fx["order"], threshold=2, slot_minutes=7 * 24 * 60)


@query(
    "live_stuck_order",
    f"""SELECT order_id, created_at, TIMESTAMP '{AS_OF}' AS "current_time",
               date_diff('hour', created_at, TIMESTAMP '{AS_OF}') AS hours_since_order
        FROM {LATEST_ORDER}
        WHERE date_diff('hour', created_at, TIMESTAMP '{AS_OF}') > 1 AND order_status = 'created'
        ORDER BY 4 DESC""",
)
def _stuck_order(fx):
    return live.stuck_order(fx["order"], AS_OF)
