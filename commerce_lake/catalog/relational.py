"""Scans, filters, aggregates, fan-out and constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from commerce_lake import fixtures
from commerce_lake.catalog import DAY, query
from commerce_lake.catalog.views import hash32
from commerce_lake.functions.numbers import exact_sum, line_value, sum_or_zero
from commerce_lake.functions.time import on_day
from commerce_lake.operators import distinct, quality, sampling
from commerce_lake.operators.joins import left_join_default
from commerce_lake.schemas import COLUMN_DEFAULTS, TABLES
from commerce_lake.sources import series, tables
from commerce_lake.sources.cdc import with_day

# --- scans and filters ----------------------------------------------------------


@query(
    "scan_day",
    f"""SELECT order_item_id, order_id, updated_at, CAST(updated_at AS DATE) AS updated_date
        FROM t_order_item WHERE CAST(updated_at AS DATE) = DATE '{DAY}'""",
)
def _scan_day(fx):
    items = with_day(fx["item_line"]).select("order_item_id", "order_id", "updated_at", "updated_date")
    return tables.scan_day(items, DAY)


@query(
    "bronze_cold_day",
    f"""SELECT order_id, user_id, order_status, total_amount, created_at, updated_at,
               CAST(updated_at AS DATE) AS updated_date
        FROM t_order WHERE CAST(updated_at AS DATE) = DATE '{DAY}'""",
)
def _bronze_cold_day(fx):
    """The slice the daily move copies; the move itself is covered by tests on stored tables."""
    return tables.scan_day(with_day(fx["order"]), DAY).drop("_seq")


@query(
    "schema_listing",
    """SELECT column_name, data_type, value_count FROM (VALUES
         ('order_id', 'bigint', (SELECT count(order_id) FROM t_order)),
         ('user_id', 'bigint', (SELECT count(user_id) FROM t_order)),
         ('order_status', 'string', (SELECT count(order_status) FROM t_order)),
         ('total_amount', 'decimal(18,2)', (SELECT count(total_amount) FROM t_order)),
         ('created_at', 'timestamp', (SELECT count(created_at) FROM t_order)),
         ('updated_at', 'timestamp', (SELECT count(updated_at) FROM t_order)),
         ('_seq', 'bigint', (SELECT count(_seq) FROM t_order))) AS v(column_name, data_type, value_count)""",
)
def _schema_listing(fx):
    """Columns of the order table with type and number of values."""
    orders = fx["order"]
    counts = orders.agg(*[F.count(name).alias(name) for name, _ in tables.schema_listing(orders)])
    rows = [
        F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), F.col(name).alias("value_count"))
        for name, kind in tables.schema_listing(orders)
    ]
    return counts.select(F.inline(F.array(*rows)))


@query("filter_day", f"SELECT order_id, user_id, created_at FROM t_final WHERE CAST(created_at AS DATE) = DATE '{DAY}'")
def _filter_day(fx):
    return fx["order"].where((F.col("_seq") == 2) & on_day(F.col("created_at"), DAY)).select("order_id", "user_id", "created_at")


@query(
    "filter_status",
    """SELECT order_id, order_status, total_amount FROM t_order
       WHERE order_status IN ('completed', 'cancelled') AND (total_amount > 200000 OR user_id % 2 = 0)""",
)
def _filter_status(fx):
    status, amount = F.col("order_status"), F.col("total_amount")
    wanted = status.isin("completed", "cancelled") & ((amount > 200000) | (F.col("user_id") % 2 == 0))
    return fx["order"].where(wanted).select("order_id", "order_status", "total_amount")


@query("bernoulli_sample", f"SELECT order_id, total_amount FROM t_final WHERE {hash32('order_id')} < 3435973837")
def _bernoulli_sample(fx):
    orders = fx["order"].where(F.col("_seq") == 2).select("order_id", "total_amount")
    return sampling.bernoulli_sample(orders, "order_id", 0.8)


# --- generated rows -------------------------------------------------------------


@query(
    "number_series",
    """SELECT n AS line_number, coalesce(lines, 0) AS lines
       FROM (SELECT unnest(range(0, 11)) AS n)
            LEFT JOIN (SELECT l_linenumber, count(*) AS lines FROM lineitem GROUP BY 1) ON n = l_linenumber""",
)
def _number_series(fx):
    """Lines per line number over a complete series of numbers."""
    counts = fx.source("lineitem").groupBy(F.col("l_linenumber").cast("bigint").alias("line_number"))
    return left_join_default(
        series.number_series(fx.spark, 0, 10, "line_number"), counts.agg(F.count("*").alias("lines")), "line_number", {"lines": 0}
    )


@query(
    "values_rows",
    """SELECT v.code AS code, v.label AS label, coalesce(n, 0) AS order_count
       FROM (VALUES ('F', 'completed'), ('P', 'cancelled'), ('O', 'created'), ('X', 'unknown')) AS v(code, label)
            LEFT JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) ON v.code = o_orderstatus""",
)
def _values_rows(fx):
    """A literal code list, with the number of orders per code."""
    codes = [("F", "completed"), ("P", "cancelled"), ("O", "created"), ("X", "unknown")]
    counts = fx.source("orders").groupBy(F.col("o_orderstatus").alias("code")).agg(F.count("*").alias("order_count"))
    return left_join_default(
        series.literal_rows(fx.spark, codes, "code string, label string"), counts, "code", {"order_count": 0}
    )


@query(
    "cross_series",
    """SELECT g, i, coalesce(orders, 0) AS orders
       FROM (SELECT unnest(range(1, 8)) AS g) AS a CROSS JOIN (SELECT unnest(range(0, 24)) AS i) AS b
            LEFT JOIN (SELECT isodow(created_at) AS d, hour(created_at) AS h, count(*) AS orders FROM t_final GROUP BY 1, 2)
            ON g = d AND i = h""",
)
def _cross_series(fx):
    """Every weekday and hour with the orders created in it, hours without any included."""
    at = F.col("created_at")
    cells = fixtures.final_orders(fx).groupBy(
        (F.weekday(at) + 1).cast("bigint").alias("g"), F.hour(at).cast("bigint").alias("i")
    ).agg(F.count("*").alias("orders"))
    return left_join_default(series.number_grid(fx.spark, (1, 7), (0, 23)), cells, ["g", "i"], {"orders": 0})


@query(
    "lateral_fanout",
    """SELECT order_id, CAST(n AS INTEGER) AS n
       FROM (SELECT order_id, unnest(range(1, order_id % 3 + 2)) AS n FROM t_final)""",
)
def _lateral_fanout(fx):
    """One to three positions per order."""
    orders = fx["order"].where(F.col("_seq") == 2).select("order_id")
    return sampling.fan_out(orders, F.col("order_id") % 3 + 1, "n")


@query(
    "review_candidates",
    f"""SELECT i.order_item_id AS order_item_id, i.product_id AS product_id, o.user_id AS user_id
        FROM t_final o JOIN t_order_item i ON o.order_id = i.order_id
        WHERE o.order_status = 'completed' AND {hash32('i.order_item_id')} < 3435973837""",
)
def _review_candidates(fx):
    done = fx["order"].where((F.col("_seq") == 2) & (F.col("order_status") == "completed")).select("order_id", "user_id")
    items = sampling.bernoulli_sample(fx["item_line"], "order_item_id", 0.8)
    return done.join(items, "order_id").select("order_item_id", "product_id", "user_id")


# --- aggregates -----------------------------------------------------------------


@query(
    "count_distinct_multi",
    """SELECT order_status, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS users
       FROM t_order GROUP BY 1""",
)
def _count_distinct_multi(fx):
    return fx["order"].groupBy("order_status").agg(
        F.count_distinct("order_id").alias("orders"), F.count_distinct("user_id").alias("users")
    )


@query(
    "count_distinct_sketched",
    """SELECT CAST(date_trunc('month', created_at) AS DATE) AS period, order_status, count(DISTINCT user_id) AS users,
              count(DISTINCT order_id) AS orders, TRUE AS users_close, TRUE AS orders_close
       FROM t_order GROUP BY 1, 2""",
)
def _count_distinct_sketched(fx):
    """Months from the sketches of days, beside the exact counts: within 5 %, six standard errors."""
    month, counted = F.trunc("date_key", "month"), ["user_id", "order_id"]
    rows = fx["order"].withColumn("date_key", F.to_date("created_at"))
    days = distinct.day_sketches(rows, F.col("date_key"), ["order_status"], counted)
    near = distinct.distinct_in(days, month, ["order_status"], counted)
    exact = rows.groupBy(month.alias("period"), "order_status").agg(
        F.count_distinct("user_id").alias("users"), F.count_distinct("order_id").alias("orders")
    )
    close = lambda estimate, n: F.abs(F.col(estimate) - F.col(n)) <= 0.05 * F.col(n)
    return exact.join(near, ["period", "order_status"]).select(
        "period", "order_status", "users", "orders",
        close("user_id", "users").alias("users_close"), close("order_id", "orders").alias("orders_close"),
    )


@query(
    "sum_revenue",
    """SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity,
              CAST(sum(price * quantity) AS DECIMAL(38,2)) AS revenue FROM t_order_item GROUP BY 1""",
)
def _sum_revenue(fx):
    return fx["item_line"].groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("quantity"),
        exact_sum(line_value(F.col("price"), F.col("quantity"))).alias("revenue"),
    )


@query(
    "count_if",
    """SELECT payment_method, CAST(count_if(status = 'failed') AS BIGINT) AS failed, count(*) AS total
       FROM t_payment GROUP BY 1""",
)
def _count_if(fx):
    return fx["payment"].groupBy("payment_method").agg(
        F.count_if(F.col("status") == "failed").alias("failed"), F.count("*").alias("total")
    )


@query(
    "sum_if",
    """SELECT user_id, CAST(coalesce(sum(total_amount) FILTER (order_status = 'completed'), 0) AS DECIMAL(38,2)) AS completed_amount
       FROM t_final GROUP BY 1""",
)
def _sum_if(fx):
    done = F.when(F.col("order_status") == "completed", F.col("total_amount"))
    return (
        fx["order"].where(F.col("_seq") == 2).groupBy("user_id")
        .agg(sum_or_zero(done, "decimal(38,2)").alias("completed_amount"))
    )


@query(
    "count_distinct_if",
    """SELECT CAST(created_at AS DATE) AS date_key,
              count(DISTINCT CASE WHEN order_status = 'completed' THEN user_id END) AS buyers
       FROM t_order GROUP BY 1""",
)
def _count_distinct_if(fx):
    return fx["order"].groupBy(F.to_date("created_at").alias("date_key")).agg(
        F.count_distinct(F.when(F.col("order_status") == "completed", F.col("user_id"))).alias("buyers")
    )


# --- constraint checks ----------------------------------------------------------


@query("dq_unique", "SELECT order_item_id, count(*) AS row_count FROM t_order_item GROUP BY 1 HAVING count(*) > 1")
def _dq_unique(fx):
    return quality.duplicate_keys(fx["item_line"], ["order_item_id"])


_UNIQUE = [(s.name, c) for s in TABLES.values() for c in s.unique]


@query(
    "dq_unique_columns",
    " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS constraint_name, {c} AS key_value, count(*) AS row_count FROM t_{t}{'_change' if t == 'user' else ''} "
        f"GROUP BY 2 HAVING count(*) > 1"
        for t, c in _UNIQUE
    ),
)
def _dq_unique_columns(fx):
    """Values of unique columns that stand in several rows of the change log."""
    out = None
    for table, column in _UNIQUE:
        bad = quality.duplicate_keys(fx[f"{table}_change" if table == "user" else table], [column])
        bad = bad.select(F.lit(f"{table}.{column}").alias("constraint_name"), F.col(column).alias("key_value"), "row_count")
        out = bad if out is None else out.unionByName(bad)
    return out


@query("dq_rating", "SELECT review_id, rating FROM t_product_review WHERE NOT (rating BETWEEN 2 AND 5)")
def _dq_rating(fx):
    """Reviews outside a range; 1 is left out of it so that the check finds some."""
    return quality.out_of_range(fx["product_review"], "rating", 2, 5).select("review_id", "rating")


_REQUIRED = {s.name: [f.name for f in s.fields if not f.kind.endswith("?")] for s in TABLES.values()}


@query(
    "dq_required_columns",
    " UNION ALL ".join(
        f"SELECT '{t}.{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM t_{t}"
        for t, columns in _REQUIRED.items()
        for c in columns
    ),
)
def _dq_required_columns(fx):
    """Missing values of every column that is not optional, one pass over each table."""
    out = None
    for table, columns in _REQUIRED.items():
        found = quality.missing_values(fx[table], columns)
        found = found.withColumn("column_name", F.concat(F.lit(f"{table}."), F.col("column_name")))
        out = found if out is None else out.unionByName(found)
    return out


def _orphan_sql(child: str, column: str, parent: str, key: str) -> str:
    absent = "AND category_id <> 0" if (child, column) == ("product", "category_id") else ""
    return (
        f"SELECT '{child}.{column}' AS constraint_name, {column} AS key_value, count(*) AS row_count FROM t_{child} "
        f"WHERE {column} NOT IN (SELECT {key} FROM t_{parent}) {absent} GROUP BY 2"
    )


_FOREIGN_KEYS = [(s.name, *fk) for s in TABLES.values() for fk in s.foreign_keys]


@query(
    "dq_foreign_key",
    " UNION ALL ".join(_orphan_sql(*fk) for fk in _FOREIGN_KEYS)
    + " UNION ALL SELECT 'shipping.order_id (payment side)', order_id, count(*) FROM t_payment "
    "WHERE order_id NOT IN (SELECT order_id FROM t_shipping) GROUP BY 2",
)
def _dq_foreign_key(fx):
    """All nine references, and one that does fail: payments of orders without shipment.

    What a check finds is rebalanced, so that its joins are tasks of their own: a union of results
    that are all partitioned by key runs the same partition of all checks in one task.
    """
    checks = [*_FOREIGN_KEYS, ("payment", "order_id", "shipping", "order_id")]
    out = None
    for child, column, parent, key in checks:
        absent = 0 if (child, column) == ("product", "category_id") else None
        bad = quality.orphans(fx[child], column, fx[parent], key, absent)
        name = "shipping.order_id (payment side)" if parent == "shipping" else f"{child}.{column}"
        bad = bad.select(F.lit(name).alias("constraint_name"), "key_value", "row_count").hint("rebalance")
        out = bad if out is None else out.unionByName(bad)
    return out


@query(
    "dq_range",
    "SELECT order_item_id, quantity FROM t_order_item WHERE NOT (quantity BETWEEN 1 AND 45)",
)
def _dq_range(fx):
    return quality.out_of_range(fx["item_line"], "quantity", 1, 45).select("order_item_id", "quantity")


@query(
    "dq_not_null",
    """SELECT 'category_id' AS column_name, CAST(count_if(category_id IS NULL) AS BIGINT) AS null_count FROM t_category_change
       UNION ALL SELECT 'parent_id', CAST(count_if(parent_id IS NULL) AS BIGINT) FROM t_category_change
       UNION ALL SELECT 'deleted_at', CAST(count_if(deleted_at IS NULL) AS BIGINT) FROM t_category_change""",
)
def _dq_not_null(fx):
    return quality.missing_values(fx["category_change"], ["category_id", "parent_id", "deleted_at"])


@query(
    "fill_defaults",
    """SELECT order_id, coalesce(CASE WHEN order_status = 'created' THEN NULL ELSE order_status END, 'pending') AS order_status
       FROM t_final""",
)
def _fill_defaults(fx):
    orders = fx["order"].where(F.col("_seq") == 2).select("order_id", F.nullif(F.col("order_status"), F.lit("created")).alias("order_status"))
    return quality.fill_defaults(orders, COLUMN_DEFAULTS["order"])
