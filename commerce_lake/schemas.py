"""Table registry: one specification per shop table.

The registry replaces eight copies of the same ingest job. Each field has a
*kind* that says how a change event's value is decoded and what a missing value
becomes:

=========  =======================  ==============================
kind       stored type              missing value
=========  =======================  ==============================
long       bigint                   0
long?      bigint                   NULL
int        int                      0
string     string                   ''
string?    string                   NULL when decoded, '' in bronze
decimal    decimal(18,2)            0
ts         timestamp (ms)           1970-01-01 00:00:00
ts?        timestamp (ms)           NULL
=========  =======================  ==============================
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Precision and scale of money columns at the source and in the lake.
SOURCE_DECIMAL = T.DecimalType(12, 2)
LAKE_DECIMAL = T.DecimalType(18, 2)
SUM_DECIMAL = "decimal(38,2)"

# Ingest position of a row (for Kafka: the offset). Breaks ties between two
# versions of one key that carry the same update time.
SEQ = "_seq"

# Partition column of bronze and silver tables.
DAY = "updated_date"
BATCH = "batch_id"

_STORED = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "decimal": LAKE_DECIMAL,
    "ts": T.TimestampType(),
}

_SOURCE = dict(_STORED, decimal=SOURCE_DECIMAL)


@dataclass(frozen=True)
class Field:
    name: str
    kind: str

    @property
    def base(self) -> str:
        return self.kind.rstrip("?")

    @property
    def optional(self) -> bool:
        return self.kind.endswith("?")


@dataclass(frozen=True)
class TableSpec:
    """Binding of a source table: topic, primary key, fields and constraints."""

    name: str
    source_table: str
    key: str
    fields: tuple[Field, ...]
    unique: tuple[str, ...] = ()
    # column -> (parent table, parent column)
    foreign_keys: tuple[tuple[str, str, str], ...] = ()

    def topic(self, prefix: str = "ecommerce_db.public") -> str:
        return f"{prefix}.{self.source_table}"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def bronze_hot(self) -> str:
        return f"bronze_hot_{self.name}"

    @property
    def bronze_cold(self) -> str:
        return f"bronze_cold_{self.name}"

    @property
    def silver(self) -> str:
        return f"silver_{self.name}"

    def source_schema(self) -> T.StructType:
        """Schema of the operational table (narrow decimals)."""
        return T.StructType([T.StructField(f.name, _SOURCE[f.base], f.optional) for f in self.fields])

    def bronze_schema(self) -> T.StructType:
        """Schema of the lake table: optional strings are stored as ''."""
        return T.StructType(
            [
                T.StructField(f.name, _STORED[f.base], f.optional and f.base != "string")
                for f in self.fields
            ]
        )


def _fields(text: str) -> tuple[Field, ...]:
    return tuple(Field(*pair.split(":")) for pair in text.split())


_AUDIT = "created_at:ts updated_at:ts"
_SOFT_DELETE = f"{_AUDIT} deleted_at:ts?"

_SPECS = (
    TableSpec(
        "user",
        "users",
        "user_id",
        _fields(f"user_id:long name:string email:string password_hash:string phone:string? {_SOFT_DELETE}"),
        unique=("email",),
    ),
    TableSpec(
        "category",
        "categories",
        "category_id",
        _fields(f"category_id:long name:string parent_id:long? {_SOFT_DELETE}"),
        foreign_keys=(("parent_id", "category", "category_id"),),
    ),
    TableSpec(
        "product",
        "products",
        "product_id",
        _fields(
            "product_id:long name:string description:string price:decimal "
            f"stock_quantity:int category_id:long {_SOFT_DELETE}"
        ),
        foreign_keys=(("category_id", "category", "category_id"),),
    ),
    TableSpec(
        "order",
        "orders",
        "order_id",
        _fields(f"order_id:long user_id:long order_status:string total_amount:decimal {_AUDIT}"),
        foreign_keys=(("user_id", "user", "user_id"),),
    ),
    TableSpec(
        "order_item",
        "order_items",
        "order_item_id",
        _fields(f"order_item_id:long order_id:long product_id:long quantity:int price:decimal {_AUDIT}"),
        foreign_keys=(("order_id", "order", "order_id"), ("product_id", "product", "product_id")),
    ),
    TableSpec(
        "payment",
        "payments",
        "payment_id",
        _fields(
            "payment_id:long order_id:long amount:decimal payment_method:string "
            f"payment_date:ts status:string {_AUDIT}"
        ),
        foreign_keys=(("order_id", "order", "order_id"),),
    ),
    TableSpec(
        "shipping",
        "shipping",
        "shipping_id",
        _fields(
            "shipping_id:long order_id:long address:string city:string postal_code:string "
            f"country:string shipping_date:ts tracking_number:string? {_AUDIT}"
        ),
        foreign_keys=(("order_id", "order", "order_id"),),
    ),
    TableSpec(
        "product_review",
        "product_reviews",
        "review_id",
        _fields(f"review_id:long product_id:long user_id:long rating:int comment:string? {_AUDIT}"),
        foreign_keys=(("product_id", "product", "product_id"), ("user_id", "user", "user_id")),
    ),
)

TABLES: dict[str, TableSpec] = {s.name: s for s in _SPECS}

# Column defaults the operational schema declares for absent values.
COLUMN_DEFAULTS: dict[str, dict[str, str]] = {
    "order": {"order_status": "pending"},
    "payment": {"status": "completed"},
}
