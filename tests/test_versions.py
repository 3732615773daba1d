"""Framed messages of several writers, each read by the schema that it names."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.schemas import TABLES
from commerce_lake.sources import cdc, versions

SPEC = TABLES["product_review"]
OLD = T.StructType().add("review_id", "integer").add("product", "long").add("stars", "string").add("created_at", "long").add("gone", "string")
FORMER = {"product_id": "product", "rating": "stars"}


@pytest.fixture
def readers():
    wire = cdc.envelope_schema(SPEC)["after"].dataType
    return {1: versions.json_reader(SPEC, OLD, FORMER), 0xFFFFFFFF: versions.json_reader(SPEC, wire)}


def events(spark, rows):
    schema = "k int, number bigint, value string"
    return spark.createDataFrame(rows, schema).select("k", versions.frame(F.col("value"), F.col("number")).alias("value"))


def test_frame_and_number(spark):
    row = events(spark, [(1, 258, "é{}")]).select("value", versions.schema_number(F.col("value")), versions.body(F.col("value")))
    value, number, body = row.first()
    assert bytes(value) == b"\x00\x00\x00\x01\x02" + "é{}".encode() and number == 258 and bytes(body) == "é{}".encode()
    broken = spark.createDataFrame([(b"",), (b"\x00\x00",), (b"\x01\x00\x00\x00\x01{}",), (None,)], "value binary")
    assert [r[0] for r in broken.select(versions.schema_number(F.col("value"))).collect()] == [None] * 4


def test_two_schemas_in_one_batch(spark, readers):
    old = {"after": {"review_id": 5, "product": 9, "stars": "4", "created_at": 1_000_000, "gone": "x"}}
    new = {"after": {"review_id": 6, "product_id": 8, "user_id": 3, "rating": 2, "comment": "ok", "created_at": 2_000_000, "updated_at": 0}}
    rows = [(1, 1, json.dumps(old)), (2, 0xFFFFFFFF, json.dumps(new)), (3, 1, json.dumps({"after": None})), (4, 1, None), (5, 1, "")]
    parsed = versions.parse_versions(events(spark, rows), SPEC, readers)
    assert parsed.columns == ["k", "after"]
    assert [r.k for r in parsed.where("after IS NULL").orderBy("k").collect()] == [3, 4, 5]
    got = {r.review_id: r for r in cdc.flatten(parsed, SPEC).collect()}
    assert (got[5].product_id, got[5].user_id, got[5].rating, got[5].comment) == (9, 0, 4, None)
    assert (got[6].product_id, got[6].user_id, got[6].rating, got[6].comment) == (8, 3, 2, "ok")
    assert got[5].created_at.timestamp() == 1


@pytest.mark.parametrize("number, value, message", [(2, "{}", "no reader for schema 2"), (1, '{"after": {"rev', "malformed product_review event")])
def test_unknown_numbers_and_bad_bodies_raise(spark, readers, number, value, message):
    with pytest.raises(Exception, match=message):
        versions.parse_versions(events(spark, [(1, number, value)]), SPEC, readers).collect()
    with pytest.raises(Exception, match="broken frame"):
        versions.parse_versions(spark.createDataFrame([(b"{}",)], "value binary"), SPEC, readers).collect()


def test_no_shuffle_and_one_parse_for_each_schema(spark, readers):
    plan = versions.parse_versions(events(spark, [(1, 1, "{}")]), SPEC, readers)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_json") == len(readers)
