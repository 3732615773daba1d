"""Operators of a training-data pipeline, with the queries and SQL that use them."""
