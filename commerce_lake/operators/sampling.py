"""Row sampling and row fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.functions.keys import unit_hash


def bernoulli_sample(df: DataFrame, key: str, probability: float) -> DataFrame:
    """Keep each key with the given probability.

    The draw is a digest of the key: reruns, retries after a lost executor and
    other engines select the same rows. Rows that share a key share its draw.
    """
    return df.where(unit_hash(F.col(key)) < F.lit(round(probability * 2**32)).cast("bigint"))


def fan_out(df: DataFrame, count: Column, position: str) -> DataFrame:
    """Repeat each row `count` times, numbered from 1; none for a count below 1."""
    series = F.when(count >= 1, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    return df.withColumn(position, F.explode(series))
