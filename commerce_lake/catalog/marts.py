"""As-of joins, facts and daily marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from commerce_lake.catalog import DAY, query
from commerce_lake.catalog.dimensions import history, history_of, silver
from commerce_lake.catalog.views import VIEWS, latest
from commerce_lake.functions.time import on_day
from commerce_lake.operators import scd2
from commerce_lake.operators.dedup import latest_among, latest_by_key
from commerce_lake.operators.joins import asof_inner, asof_left, left_join_default
from commerce_lake.plans import facts, marts

_VALID = "{d}.start_date <= {at} AND ({d}.end_date > {at} OR {d}.is_current = 1)"
_ITEM_ORDER = "updated_time DESC, _seq DESC, order_id DESC, product_id DESC, quantity DESC, price_amount DESC"

VIEWS["n_order"] = f"SELECT * FROM {latest('s_order', 'order_id', 'updated_time DESC, _seq DESC')}"
VIEWS["n_item"] = f"SELECT * FROM {latest('s_order_item', 'order_item_id', _ITEM_ORDER)}"


def _order_branch(status: str, completed: str, date: str, where: str) -> str:
    valid = _VALID.format(d="u", at="CAST(o.created_time AS DATE)")
    return f"""
        SELECT o.order_id AS order_id, u.user_key AS user_key, CAST({date} AS DATE) AS date_key,
               {status} AS order_status, o.created_time AS order_created_time,
               {completed} AS order_completed_time, coalesce(p.payment_method, '') AS payment_method,
               coalesce(s.postal_code, '') AS postal_code, coalesce(s.country, '') AS country,
               coalesce(s.city, '') AS city, o.total_amount AS total_amount
        FROM n_order o JOIN dim_user_h u ON o.user_id = u.user_id AND {valid}
             LEFT JOIN s_shipping s ON o.order_id = s.order_id
             LEFT JOIN s_payment p ON o.order_id = p.order_id
        WHERE CAST({date} AS DATE) = DATE '{DAY}' {where}"""


VIEWS["f_order"] = " UNION ALL ".join(
    (
        _order_branch("'created'", "CAST(NULL AS TIMESTAMP)", "o.created_time", ""),
        _order_branch("o.order_status", "o.updated_time", "o.updated_time", "AND o.order_status = 'completed'"),
        _order_branch("o.order_status", "CAST(NULL AS TIMESTAMP)", "o.updated_time", "AND o.order_status = 'cancelled'"),
    )
)


def _detail(at: str, where: str = "") -> str:
    return f"""
        SELECT i.order_id AS order_id, CAST(i.created_time AS DATE) AS date_key,
               coalesce(p.product_key, '') AS product_key, coalesce(c.category_key, '') AS category_key,
               i.quantity AS quantity, i.price_amount AS price_amount
        FROM n_item i
             LEFT JOIN dim_product_h p ON i.product_id = p.product_id AND {_VALID.format(d='p', at=at)}
             LEFT JOIN dim_category_h c ON coalesce(p.category_id, 0) = c.category_id AND {_VALID.format(d='c', at=at)}
        {where}"""


VIEWS["f_detail_day"] = _detail(f"DATE '{DAY}'", f"WHERE CAST(i.created_time AS DATE) = DATE '{DAY}'")
VIEWS["f_detail"] = _detail("CAST(i.created_time AS DATE)")


def newest(fx, name, key):
    return latest_by_key(silver(fx, name), key, "updated_time")


def fact_order(fx, day=DAY):
    """Only users with an order of the day are looked up, so only their versions are ranked."""
    orders = newest(fx, "order", "order_id")
    return facts.fact_order(
        orders,
        history_of(fx, scd2.DIM_USER, facts.orders_of(orders, day)),
        silver(fx, "shipping"),
        silver(fx, "payment"),
        day,
    )


@query("fact_order", "SELECT * FROM f_order")
def _fact_order(fx):
    return fact_order(fx)


@query("fact_order_detail", "SELECT * FROM f_detail_day")
def _fact_order_detail(fx):
    items = newest(fx, "order_item", "order_item_id")
    products = history_of(fx, scd2.DIM_PRODUCT, items.where(on_day(F.col("created_time"), DAY)))
    return facts.fact_order_detail(items, products, history(fx, scd2.DIM_CATEGORY), DAY)


@query(
    "daily_transaction",
    """SELECT fo.date_key AS date_key, fo.order_status AS order_status, fo.payment_method AS payment_method,
              coalesce(dc.name, '') AS category, fo.country AS country, fo.city AS city,
              count(DISTINCT fo.order_id) AS total_order, count(DISTINCT fo.user_key) AS total_user,
              CAST(coalesce(sum(fd.quantity) FILTER (fo.order_status = 'completed'), 0) AS BIGINT) AS items_sold,
              CAST(coalesce(sum(fd.price_amount) FILTER (fo.order_status = 'completed'), 0) AS DECIMAL(38,2)) AS total_revenue
       FROM f_order fo LEFT JOIN f_detail fd ON fo.order_id = fd.order_id
            LEFT JOIN dim_category_h dc ON coalesce(fd.category_key, '') = dc.category_key
       GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _daily_transaction(fx):
    """Only items of the day's orders, and versions of their products, are ranked; details are those of any day."""
    orders = facts.orders_of(newest(fx, "order", "order_id"), DAY).select("order_id")
    items = latest_among(silver(fx, "order_item"), "order_item_id", orders, "order_id", "updated_time")
    products = history_of(fx, scd2.DIM_PRODUCT, items)
    detail = facts.fact_order_detail(items, products, history(fx, scd2.DIM_CATEGORY), None)
    return marts.daily_transaction(fact_order(fx), detail, history(fx, scd2.DIM_CATEGORY), DAY)


@query(
    "daily_user",
    """SELECT fo.date_key AS date_key, count(DISTINCT du.user_id) AS active_user,
              count(DISTINCT CASE WHEN CAST(du.created_time AS DATE) = fo.date_key THEN du.user_id END) AS new_user
       FROM f_order fo JOIN dim_user_h du ON fo.user_key = du.user_key GROUP BY 1""",
)
def _daily_user(fx):
    return marts.daily_user(fact_order(fx), history(fx, scd2.DIM_USER), DAY)


@query(
    "asof_dim_inner",
    f"""SELECT o.order_id AS order_id, u.user_key AS user_key, u.phone AS phone
        FROM n_order o JOIN dim_user_h u ON o.user_id = u.user_id
             AND {_VALID.format(d='u', at='CAST(o.updated_time AS DATE)')}""",
)
def _asof_dim_inner(fx):
    orders = newest(fx, "order", "order_id").select("order_id", "user_id", "updated_time")
    at = F.to_date("updated_time")
    rows = asof_inner(orders, history(fx, scd2.DIM_USER), "user_id", at, ["user_key", "phone"])
    return rows.select("order_id", "user_key", "phone")


@query(
    "asof_dim_left",
    f"""SELECT i.order_item_id AS order_item_id, coalesce(p.product_key, '') AS product_key,
               coalesce(p.price_amount, 0) AS list_price
        FROM n_item i LEFT JOIN dim_product_h p ON i.product_id = p.product_id
             AND {_VALID.format(d='p', at=f"DATE '{DAY}'")}""",
)
def _asof_dim_left(fx):
    items = newest(fx, "order_item", "order_item_id").select("order_item_id", "product_id")
    dim = history(fx, scd2.DIM_PRODUCT).withColumnRenamed("price_amount", "list_price")
    columns = ["product_key", "list_price"]
    rows = asof_left(items, dim, "product_id", DAY, columns, {"product_key": "", "list_price": 0})
    return rows.select("order_item_id", *columns)


@query(
    "left_join_defaults",
    """SELECT o.order_id AS order_id, coalesce(s.city, '') AS city, coalesce(s.country, '') AS country,
              coalesce(s.shipping_id, 0) AS shipping_id
       FROM t_final o LEFT JOIN t_shipping s ON o.order_id = s.order_id""",
)
def _left_join_defaults(fx):
    orders = fx["order"].where(F.col("_seq") == 2).select("order_id")
    places = fx["shipping"].select("order_id", "city", "country", "shipping_id")
    return left_join_default(orders, places, "order_id", {"city": "", "country": "", "shipping_id": 0})
