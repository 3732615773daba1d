"""Readers, generated rows, settings, plans."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from commerce_lake import fixtures
from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.plans import live
from commerce_lake.schemas import TABLES
from commerce_lake.session import work_dir
from commerce_lake.settings import MissingSetting, Settings
from commerce_lake.sources import cdc, series, tables

ENV = {
    "SCHEMA_REGISTRY_SERVER": "http://r", "KAFKA_SERVER": "k:9092", "DATABASE_SERVER": "jdbc:x",
    "DATABASE_USERNAME": "u", "DATABASE_PASSWORD": "p",
}


def test_settings_need_every_name():
    assert Settings.from_env(ENV).kafka == "k:9092"
    with pytest.raises(MissingSetting, match="KAFKA_SERVER"):
        Settings.from_env({k: v for k, v in ENV.items() if k != "KAFKA_SERVER"})


def test_topics_and_names():
    assert [s.topic().rsplit(".", 1)[1] for s in TABLES.values()] == [
        "users", "categories", "products", "orders", "order_items", "payments", "shipping", "product_reviews",
    ]
    assert sum(len(s.foreign_keys) for s in TABLES.values()) == 9


def test_calendar(spark):
    days = series.calendar(spark)
    assert days.count() == 27393
    ends = days.agg(F.min("date_key"), F.max("date_key")).first()
    assert tuple(ends) == (dt.date(2025, 1, 1), dt.date(2099, 12, 31))
    row = days.where("date_key = date'2025-06-15'").first()
    assert tuple(row) == (
        dt.date(2025, 6, 15), dt.date(2025, 6, 9), dt.date(2025, 6, 1), 2, 2025, 1, "Sunday", "June",
    )


def test_series(spark):
    assert [r.n for r in series.number_series(spark, 3, 6).orderBy("n").collect()] == [3, 4, 5, 6]
    grid = series.number_grid(spark, (0, 4), (1, 6)).collect()
    assert sorted((r.g, r.i) for r in grid) == [(g, i) for g in range(5) for i in range(1, 7)]
    assert series.literal_rows(spark, [("a", 1)], "k string, v int").first() == ("a", 1)


def test_script_parameter_is_bound(spark):
    row = tables.run_script(spark, "SELECT to_date(:execution_date) AS d, :execution_date AS s", "2024-01-02").first()
    assert (str(row.d), row.s) == ("2024-01-02", "2024-01-02")
    odd = tables.run_script(spark, "SELECT :execution_date AS s", "x' OR '1'='1").first()
    assert odd.s == "x' OR '1'='1"


def test_events_with_missing_fields_deletes_and_tombstones(spark):
    spec = TABLES["category"]
    lines = [
        json.dumps({"after": {"category_id": 1, "name": "a", "created_at": 1_000_000, "updated_at": 1_999_999}}),
        json.dumps({"after": {"category_id": "not a number"}}),
        json.dumps({"after": None, "op": "d"}),
        None,
    ]
    bronze = cdc.json_to_bronze(spark.createDataFrame([(x,) for x in lines], "value string"), spec)
    assert dict(bronze.dtypes) == {f.name: f.dataType.simpleString() for f in spec.bronze_schema().fields}
    got = [(r.category_id, r.name, r.parent_id, r.updated_at, r.deleted_at) for r in bronze.orderBy("category_id").collect()]
    epoch = dt.datetime.fromtimestamp(0)
    assert got == [
        (0, "", None, epoch, None),
        (1, "a", None, epoch + dt.timedelta(milliseconds=1999), None),
    ]


def test_typed_records_decode_like_json(spark):
    """Avro readers deliver typed structs; the decoder takes them unchanged."""
    spec = TABLES["order_item"]
    after = F.struct(
        F.lit(1).cast("bigint").alias("order_item_id"), F.lit(2).cast("bigint").alias("order_id"),
        F.lit(3).cast("bigint").alias("product_id"), F.lit(4).alias("quantity"),
        F.lit("5.25").cast("decimal(12,2)").alias("price"),
        F.lit(1_000_000).cast("bigint").alias("created_at"), F.lit(None).cast("bigint").alias("updated_at"),
    )
    row = cdc.to_bronze(cdc.flatten(spark.range(1).select(after.alias("after")), spec), spec).first()
    assert (row.order_item_id, row.quantity, str(row.price)) == (1, 4, "5.25")
    assert row.updated_at == dt.datetime.fromtimestamp(0)


def test_work_dir_is_below_the_shared_folder(spark):
    folder = work_dir(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")
    assert folder != work_dir(spark, "x")


# --- plans ----------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fx(spark):
    return fixtures.load(spark, "/root/testdata/sf0.001")


def test_ranking_is_limited_before_the_shuffle(fx):
    text = plan(latest_by_key(fx["order"], "order_id"))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_top_products_use_a_top_k_operator(fx):
    text = plan(live.top_selling_product(fx["order"], fx["item_line"], fx["product"], "2000-08-03 15:00:00"))
    assert "TakeOrderedAndProject" in text
    read = [line for line in text.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert read and all("l_discount" not in line and "l_shipmode" not in line for line in read)


def test_live_views_rank_candidate_keys_only(fx):
    """The semi join on the ranking key stands below the ranking."""
    at = "2000-08-03 15:00:00"
    views = {
        "order_item_id": live.order_revenue(fx["order"], fx["item_line"], at),
        "payment_id": live.abnormal_payment(fx["payment"], fx["order"]),
        "order_id": live.payment_failure_rate(fx["payment"], at),
    }
    for key, view in views.items():
        lines = plan(view).splitlines()
        ranked = next(k for k, line in enumerate(lines) if f"WindowGroupLimit [{key}" in line)
        assert any("LeftSemi" in line and key in line for line in lines[ranked:]), key


def test_malformed_events_raise_or_are_kept(spark):
    spec = TABLES["category"]
    good = json.dumps({"after": {"category_id": 1, "name": "a", "created_at": 1_000_000, "updated_at": 1_999_999}})
    lines = [good, good[:-10], "no json", "[1", "", None, json.dumps({"after": None})]
    events = spark.createDataFrame([(x,) for x in lines], "value string")
    with pytest.raises(Exception, match="malformed category event"):
        cdc.json_to_bronze(events, spec).collect()
    assert cdc.json_to_bronze(events, spec, bad="skip").count() == 1
    assert sorted(r.value for r in cdc.rejected_events(events, spec).collect()) == sorted(lines[1:4])


def test_day_bound_of_live_views_reaches_the_partitions(spark, tmp_path):
    path = str(tmp_path / "orders")
    df = spark.createDataFrame(
        [(i, 1, dt.datetime(2024, 1, 1 + i % 5, 12), dt.date(2024, 1, 1 + i % 5)) for i in range(20)],
        "order_id bigint, user_id bigint, updated_at timestamp, updated_date date",
    )
    tables.append(df, path, "updated_date")
    view = live.unique_user(spark.read.parquet(path), "2024-01-04 05:00:00")
    text = plan(view)
    assert "PartitionFilters: [isnotnull(updated_date" in text and "updated_date" in text.split("PartitionFilters")[1][:90]
    assert view.first().total_orders == 4
