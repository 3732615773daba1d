"""Silver tables, type-2 dimensions and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from commerce_lake.catalog import DAY, INITIAL_DAY, query
from commerce_lake.catalog.views import VIEWS, capitalized, clean, key_of
from commerce_lake.functions.keys import surrogate_key
from commerce_lake.functions.time import calendar_columns
from commerce_lake.operators import scd2
from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.operators.silver import to_silver
from commerce_lake.schemas import TABLES
from commerce_lake.sources import series

# --- silver ---------------------------------------------------------------------


def _silver_select(name: str) -> str:
    """Hand-written rule set per column kind, independent of the Spark generator."""
    out = []
    for field in TABLES[name].fields:
        if field.name == "password_hash":
            continue
        expr, alias = field.name, field.name
        if field.base == "string":
            expr = clean(field.name)
            if field.name == "name":
                expr = capitalized(expr)
        alias = {
            "created_at": "created_time",
            "updated_at": "updated_time",
            "deleted_at": "deleted_time",
            "payment_date": "payment_time",
            "shipping_date": "shipping_time",
            "price": "price_amount",
        }.get(alias, alias)
        out.append(f"{expr} AS {alias}")
    return ", ".join(out)


for _name in TABLES:
    VIEWS[f"s_{_name}"] = f"SELECT {_silver_select(_name)}, _seq FROM t_{_name}"
    if f"t_{_name}_change" in VIEWS:
        VIEWS[f"s_{_name}_change"] = f"SELECT {_silver_select(_name)}, _seq FROM t_{_name}_change"


def silver(fx, name):
    return fx.once(("silver", name), lambda: to_silver(fx[name]))


def _register_silver(name: str) -> None:
    @query(f"silver_{name}", f"SELECT * EXCLUDE (_seq) FROM s_{name}")
    def _build(fx):
        return silver(fx, name).drop("_seq")


for _name in TABLES:
    _register_silver(_name)

# --- type-2 dimensions ----------------------------------------------------------

_ATTRIBUTES = {
    "dim_user": "name, email, phone, created_time",
    "dim_category": "name, coalesce(parent_id, 0) AS parent_id",
    "dim_product": "name, description, price_amount, category_id, CAST(stock_quantity AS BIGINT) AS stock_quantity",
}


def changes(fx, dim):
    return silver(fx, f"{dim.source}_change")


def history(fx, dim, before=None):
    """Initial load plus the changes of all days, or of those before one."""
    return fx.once(
        (dim.name, before), lambda: scd2.history(dim, silver(fx, dim.source), changes(fx, dim), INITIAL_DAY, before)
    )


def history_of(fx, dim, ids):
    """The history of the ids that stand in `ids`."""
    return scd2.history(dim, silver(fx, dim.source), changes(fx, dim), INITIAL_DAY, ids=ids)


def _versions(dim: scd2.Dimension, where: str = "") -> str:
    attributes = ", ".join(a for a, _ in dim.attributes)
    n = dim.natural
    return (
        f"SELECT md5({n} || '|' || start_date) AS {dim.key}, {n}, {attributes}, start_date, end_date, "
        f"CASE WHEN end_date IS NULL THEN 1 ELSE 0 END AS is_current FROM (SELECT *, "
        f"lead(start_date) OVER (PARTITION BY {n} ORDER BY start_date) AS end_date FROM {dim.name}_starts {where})"
    )


def _add_dimension_views(dim: scd2.Dimension) -> None:
    attributes = _ATTRIBUTES[dim.name]
    plain = ", ".join(a for a, _ in dim.attributes)
    n = dim.natural
    day = "CAST(updated_time AS DATE)"
    VIEWS[f"{dim.name}_chg"] = (
        f"SELECT {n}, {attributes}, start_date FROM (SELECT *, {day} AS start_date, row_number() OVER "
        f"(PARTITION BY {n}, {day} ORDER BY updated_time DESC, _seq DESC) AS rn FROM s_{dim.source}_change) WHERE rn = 1"
    )
    VIEWS[f"{dim.name}_starts"] = (
        f"SELECT * FROM {dim.name}_chg UNION ALL SELECT {n}, {attributes}, DATE '{INITIAL_DAY}' FROM s_{dim.source} "
        f"WHERE {n} NOT IN (SELECT {n} FROM {dim.name}_chg WHERE start_date = DATE '{INITIAL_DAY}')"
    )
    VIEWS[f"{dim.name}_h"] = _versions(dim)
    VIEWS[f"{dim.name}_before"] = _versions(dim, f"WHERE start_date < DATE '{DAY}'")
    VIEWS[f"{dim.name}_new"] = (
        f"SELECT {key_of(n, DAY)} AS {dim.key}, {n}, {plain}, start_date, CAST(NULL AS DATE) AS end_date, 1 AS is_current "
        f"FROM {dim.name}_chg WHERE start_date = DATE '{DAY}'"
    )
    VIEWS[f"{dim.name}_old"] = (
        f"SELECT {dim.key}, {n}, {plain}, start_date, DATE '{DAY}' AS end_date, 0 AS is_current "
        f"FROM {dim.name}_before WHERE is_current = 1 AND {n} IN (SELECT {n} FROM {dim.name}_new)"
    )
    VIEWS[f"{dim.name}_delta"] = f"SELECT * FROM {dim.name}_new UNION ALL SELECT * FROM {dim.name}_old"
    VIEWS[f"{dim.name}_merged"] = (
        f"SELECT * FROM {dim.name}_before WHERE is_current = 0 OR {n} NOT IN (SELECT {n} FROM {dim.name}_new) "
        f"UNION ALL SELECT * FROM {dim.name}_delta"
    )


def _register_dimension(dim: scd2.Dimension) -> None:
    @query(dim.name, f"SELECT * FROM {dim.name}_h")
    def _build(fx):
        return history(fx, dim)


for _dim in scd2.DIMENSIONS.values():
    _add_dimension_views(_dim)
    _register_dimension(_dim)


@query("scd2_new", "SELECT * FROM dim_user_new")
def _scd2_new(fx):
    return scd2.new_versions(scd2.DIM_USER, changes(fx, scd2.DIM_USER), DAY)


@query("scd2_expire", "SELECT * FROM dim_product_old")
def _scd2_expire(fx):
    dim = scd2.DIM_PRODUCT
    return scd2.expired_versions(dim, history(fx, dim, DAY), changes(fx, dim), DAY)


@query("scd2_delta", "SELECT * FROM dim_user_delta")
def _scd2_delta(fx):
    dim = scd2.DIM_USER
    return scd2.delta(dim, history(fx, dim, DAY), changes(fx, dim), DAY)


@query("scd2_merge", "SELECT * FROM dim_product_merged")
def _scd2_merge(fx):
    dim = scd2.DIM_PRODUCT
    snapshot = history(fx, dim, DAY)
    return scd2.merge(dim, snapshot, scd2.delta(dim, snapshot, changes(fx, dim), DAY))


@query("scd2_apply_day", "SELECT * FROM dim_user_merged")
def _scd2_apply_day(fx):
    dim = scd2.DIM_USER
    return scd2.apply_day(dim, history(fx, dim, DAY), changes(fx, dim), DAY)


@query("dim_high_water_mark", "SELECT max(start_date) AS last_date FROM dim_user_h")
def _high_water_mark(fx):
    return scd2.high_water_mark(history(fx, scd2.DIM_USER))


@query("surrogate_key", f"SELECT user_id, {key_of('user_id', DAY)} AS user_key FROM t_user")
def _surrogate_key(fx):
    return fx["user"].select("user_id", surrogate_key(F.col("user_id"), DAY).alias("user_key"))


@query(
    "dim_date",
    """SELECT date_key, CAST(date_trunc('week', date_key) AS DATE) AS start_day_of_week,
              CAST(date_trunc('month', date_key) AS DATE) AS start_day_of_month,
              CAST(quarter(date_key) AS INTEGER) AS quarter, CAST(year(date_key) AS INTEGER) AS year,
              CASE WHEN isodow(date_key) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
              dayname(date_key) AS day_name, monthname(date_key) AS month_name, order_count
       FROM (SELECT CAST(created_at AS DATE) AS date_key, count(*) AS order_count FROM t_final GROUP BY 1)""",
)
def _dim_date(fx):
    """Calendar attributes of every day that has orders, with their number."""
    days = (
        fx["order"].where(F.col("_seq") == 2).groupBy(F.to_date("created_at").alias("d")).agg(F.count("*").alias("order_count"))
    )
    return days.select(*calendar_columns(F.col("d")), "order_count")


@query(
    "dim_date_orders",
    """SELECT d AS date_key, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
              CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend, dayname(d) AS day_name,
              coalesce(order_count, 0) AS order_count
       FROM (SELECT CAST(DATE '1992-01-01' + CAST(n AS INTEGER) AS DATE) AS d FROM range(27393) r(n))
            LEFT JOIN (SELECT CAST(created_at AS DATE) AS day, count(*) AS order_count FROM t_final GROUP BY 1) ON d = day""",
)
def _dim_date_orders(fx):
    """The whole calendar, begun with the first year of the orders, and the orders of each day."""
    orders = latest_by_key(fx["order"], "order_id")
    counts = orders.groupBy(F.to_date("created_at").alias("date_key")).agg(F.count("*").alias("order_count"))
    days = series.calendar(orders.sparkSession, dt.date(1992, 1, 1))
    return days.join(counts, "date_key", "left").select(
        "date_key", "quarter", "year", "is_weekend", "day_name", F.coalesce("order_count", F.lit(0)).alias("order_count")
    )
