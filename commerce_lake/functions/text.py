"""String cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that survive cleaning.
KEPT_CHARACTERS = r"A-Za-z0-9\s,.\";:!?()_&%$#@"


def clean_string(c: Column) -> Column:
    """Drop every character outside the kept set, then leading blanks."""
    return F.ltrim(F.regexp_replace(c, f"[^{KEPT_CHARACTERS}]+", ""))


def capitalize_name(c: Column) -> Column:
    """Lower-case, then raise each word's first letter.

    A word starts after any character that is neither letter nor digit, which
    Spark's `initcap` (blank-separated words only) does not cover.
    """
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}\p{N}])(?=\p{L})")
    raised = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2))))
    return F.array_join(raised, "")


def upper_case(c: Column) -> Column:
    return F.upper(c)


def padded_number(c: Column, width: int) -> Column:
    """Left-pad with zeros; like SQL LPAD, longer values are cut to the width."""
    return F.lpad(c.cast("string"), width, "0")
