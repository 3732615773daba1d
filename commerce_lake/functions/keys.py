"""Surrogate keys and sampling hashes: the same value in any engine with MD5."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from commerce_lake.functions.time import as_date


def surrogate_key(natural_id: Column, start: Column | dt.date | str) -> Column:
    """Key of one dimension version: digest of natural id and start date."""
    return F.md5(F.concat_ws("|", natural_id.cast("string"), as_date(start).cast("string")))


def unit_hash(key: Column) -> Column:
    """Reproducible pseudo-random integer in [0, 2^32) from the first digest bytes."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
