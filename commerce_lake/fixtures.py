"""The eight shop tables as change logs, derived from a star-schema dataset.

`load(spark, folder)` gives bronze-shaped DataFrames (several versions per key
where the source has them) plus `*_change` logs that touch users, products and
categories whenever an order is finished. The SQL in `catalog.views` derives the
same rows in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.functions.text import padded_number
from commerce_lake.schemas import LAKE_DECIMAL, SEQ, TABLES
from commerce_lake.session import use_utc


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(LAKE_DECIMAL)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds * F.lit(1_000_000).cast("bigint"))


def order_versions(orders: DataFrame) -> DataFrame:
    """Two versions per order: created, then the final state."""
    key = F.col("o_orderkey")
    created = _plus_seconds(F.col("o_orderdate").cast("timestamp"), (key * 7919) % 86400)
    final = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "cancelled")

    def version(seq: int, status: Column, updated: Column) -> Column:
        return F.struct(
            status.alias("order_status"), updated.alias("updated_at"), F.lit(seq).cast("bigint").alias(SEQ)
        )

    versions = F.array(
        version(1, F.lit("created"), F.col("created_at")),
        version(2, F.coalesce(final, F.lit("created")), _plus_seconds(F.col("created_at"), key % 3600)),
    )
    return (
        orders.withColumn("created_at", created)
        .select(
            key.alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            _money("o_totalprice").alias("total_amount"),
            "created_at",
            F.inline(versions),
        )
        .select("order_id", "user_id", "order_status", "total_amount", "created_at", "updated_at", SEQ)
    )


class Fixtures:
    """Lazily derived tables; nothing runs until a result is asked for.

    Plans, not data, are remembered: a table used several times in one query is
    analysed once, and its shuffles can be reused.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder
        self._plans: dict[object, DataFrame] = {}

    def once(self, key: object, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._plans:
            self._plans[key] = build()
        return self._plans[key]

    def source(self, name: str) -> DataFrame:
        return self.once(("source", name), lambda: self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    def __getitem__(self, name: str) -> DataFrame:
        return self.once(name, lambda: _TABLES[name](self))

    def bronze(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}


def _user(fx: Fixtures) -> DataFrame:
    key = F.col("c_custkey")
    born = _plus_seconds(_ts("1995-01-01 00:00:00"), (key % 365) * 86400)
    return fx.source("customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("buyer"), key.cast("string"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"),
        F.concat(F.lit("h"), key.cast("string")).alias("password_hash"),
        F.when(key % 10 != 0, F.concat(F.lit("ext "), key.cast("string"))).otherwise("").alias("phone"),
        born.alias("created_at"),
        born.alias("updated_at"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        key.alias(SEQ),
    )


def _category(fx: Fixtures) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return fx.source("nation").select(
        (key + 1).alias("category_id"),
        F.col("n_name").alias("name"),
        F.when(key % 5 != 0, F.col("n_regionkey").cast("bigint") + 1).alias("parent_id"),
        _ts("1995-01-01 00:00:00").alias("created_at"),
        _ts("1995-01-01 00:00:00").alias("updated_at"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        key.alias(SEQ),
    )


def _product(fx: Fixtures) -> DataFrame:
    key = F.col("p_partkey")
    return fx.source("part").select(
        key.alias("product_id"),
        F.col("p_name").alias("name"),
        F.concat_ws(" / ", "p_brand", "p_type").alias("description"),
        _money("p_retailprice").alias("price"),
        F.col("p_size").cast("int").alias("stock_quantity"),
        (key % 26).alias("category_id"),
        _ts("1995-01-01 00:00:00").alias("created_at"),
        _ts("1995-01-01 00:00:00").alias("updated_at"),
        F.lit(None).cast("timestamp").alias("deleted_at"),
        key.alias(SEQ),
    )


def _order(fx: Fixtures) -> DataFrame:
    return order_versions(fx.source("orders"))


def final_orders(fx: Fixtures) -> DataFrame:
    return fx["order"].where(F.col(SEQ) == 2)


def _item_line(fx: Fixtures) -> DataFrame:
    """Order items without creation time, which only the order knows.

    Joins with all orders are merge joins: compressed files look small enough to be broadcast.
    """
    price = _money("l_extendedprice")
    return fx.source("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        (F.col("l_suppkey") * 1_000_000_000 + (price * 100).cast("bigint")).alias(SEQ),
    )


def _order_item(fx: Fixtures) -> DataFrame:
    created = final_orders(fx).select("order_id", "created_at").hint("merge")
    return fx["item_line"].join(created, "order_id").select(*TABLES["order_item"].columns, SEQ)


def _payment(fx: Fixtures) -> DataFrame:
    """One payment per finished order; every fiftieth order gets a later second attempt."""
    order = F.col("order_id")
    method = F.when(order % 3 == 0, "credit_card").when(order % 3 == 1, "paypal").otherwise("bank_transfer")
    status = F.when(F.col("order_status") == "completed", "completed").otherwise("failed")

    def attempt(offset: int, state: Column, delay: int) -> Column:
        paid = _plus_seconds(F.col("updated_at"), F.lit(delay).cast("bigint"))
        return F.struct(
            (order * 10 + offset).alias("payment_id"), state.alias("status"), paid.alias("payment_date")
        )

    attempts = F.array_compact(
        F.array(attempt(0, status, 0), F.when(order % 50 == 0, attempt(1, F.lit("completed"), 3600)))
    )
    return (
        final_orders(fx)
        .where(F.col("order_status").isin("completed", "cancelled"))
        .select("order_id", F.col("total_amount").alias("amount"), method.alias("payment_method"), "created_at", F.inline(attempts))
        .select(
            "payment_id", "order_id", "amount", "payment_method", "payment_date", "status", "created_at",
            F.col("payment_date").alias("updated_at"), F.col("payment_id").alias(SEQ),
        )
    )


def _shipping(fx: Fixtures) -> DataFrame:
    """One shipment per finished order; an order still open has none."""
    order = F.col("order_id")
    place = (
        fx.source("customer")
        .join(fx.source("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(fx.source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("user_id"), "n_name", "r_name")
    )
    return (
        final_orders(fx)
        .where(F.col("order_status") != "created")
        .join(place, "user_id")
        .select(
            order.alias("shipping_id"),
            "order_id",
            F.concat(F.lit("Dock "), order.cast("string")).alias("address"),
            F.col("n_name").alias("city"),
            padded_number(order % 100000, 5).alias("postal_code"),
            F.col("r_name").alias("country"),
            F.col("updated_at").alias("shipping_date"),
            F.when(order % 7 != 0, F.concat(F.lit("PKG"), order.cast("string"))).otherwise("").alias("tracking_number"),
            "created_at",
            "updated_at",
            order.alias(SEQ),
        )
    )


def _product_review(fx: Fixtures) -> DataFrame:
    item = F.col("order_item_id")
    completed = final_orders(fx).where(F.col("order_status") == "completed").select("order_id", "user_id")
    sold = fx["order_item"].join(completed.hint("merge"), "order_id")
    return sold.select(
        item.alias("review_id"),
        "product_id",
        "user_id",
        (item % 5 + 1).cast("int").alias("rating"),
        F.when(item % 11 != 0, F.concat(F.lit("Item "), F.col("product_id").cast("string"), F.lit(" as described")))
        .otherwise("")
        .alias("comment"),
        "created_at",
        F.col("created_at").alias("updated_at"),
        SEQ,
    )


def _user_change(fx: Fixtures) -> DataFrame:
    """A user is touched when an order of theirs is finished: the phone changes."""
    touch = final_orders(fx).select("user_id", F.col("order_id").alias("_o"), F.col("updated_at").alias("_u"))
    return (
        fx["user"]
        .join(touch, "user_id")
        .withColumns(
            {
                "phone": F.concat(F.lit("ext "), F.col("_o").cast("string"), F.lit(" new")),
                "updated_at": F.col("_u"),
                SEQ: F.col("_o"),
            }
        )
        .drop("_o", "_u")
    )


def _sold_products(fx: Fixtures) -> DataFrame:
    return (
        fx.source("lineitem")
        .select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
        .join(final_orders(fx).select("order_id", F.col("updated_at").alias("_u")), "order_id")
    )


def _product_change(fx: Fixtures) -> DataFrame:
    """A product is touched when an order with it is finished: price and stock change."""
    return (
        fx["product"]
        .join(_sold_products(fx).withColumnRenamed("order_id", "_o"), "product_id")
        .withColumns(
            {
                "price": (F.col("price") + (F.col("_o") % 100).cast("decimal(5,0)")).cast(LAKE_DECIMAL),
                "stock_quantity": (F.col("stock_quantity") + F.col("_o") % 7).cast("int"),
                "updated_at": F.col("_u"),
                SEQ: F.col("_o"),
            }
        )
        .drop("_o", "_u")
    )


def _category_change(fx: Fixtures) -> DataFrame:
    """A category is touched with its products: the parent changes."""
    touched = _sold_products(fx).select(
        (F.col("product_id") % 26).alias("category_id"), F.col("order_id").alias("_o"), "_u"
    )
    return (
        fx["category"]
        .join(touched, "category_id")
        .withColumns(
            {
                "parent_id": F.when(F.col("_o") % 6 != 0, F.col("_o") % 6),
                "updated_at": F.col("_u"),
                SEQ: F.col("_o"),
            }
        )
        .drop("_o", "_u")
    )


_TABLES: dict[str, Callable[[Fixtures], DataFrame]] = {
    "user": _user,
    "category": _category,
    "product": _product,
    "order": _order,
    "item_line": _item_line,
    "order_item": _order_item,
    "payment": _payment,
    "shipping": _shipping,
    "product_review": _product_review,
    "user_change": _user_change,
    "product_change": _product_change,
    "category_change": _category_change,
}


def load(spark: SparkSession, folder: str) -> Fixtures:
    return Fixtures(spark, folder)
