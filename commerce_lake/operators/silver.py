"""Projection of a bronze table to its silver form, generated from the schema."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.functions.text import capitalize_name, clean_string


def clean_column(field: T.StructField) -> Column | None:
    """Silver expression of one column; None if it must not leave bronze."""
    name, column = field.name, F.col(field.name)
    if "password" in name.lower():
        return None
    if isinstance(field.dataType, T.StringType):
        column = clean_string(column)
        if "name" in name.lower():
            column = capitalize_name(column)
    elif isinstance(field.dataType, T.DecimalType) and "amount" not in name.lower():
        name = f"{name}_amount"
    elif isinstance(field.dataType, T.TimestampType):
        name = re.sub(r"_(at|date)$", "_time", name)
    return column.alias(name)


def clean_columns(schema: T.StructType) -> list[Column]:
    """Cleaned columns; names starting with an underscore are ingest metadata and pass through."""
    out = []
    for field in schema.fields:
        column = F.col(field.name) if field.name.startswith("_") else clean_column(field)
        if column is not None:
            out.append(column)
    return out


def to_silver(bronze: DataFrame) -> DataFrame:
    return bronze.select(*clean_columns(bronze.schema))
