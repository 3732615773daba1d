"""One test per rule that differs from what Spark does by itself."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from commerce_lake.functions import decode, time
from commerce_lake.functions.keys import surrogate_key
from commerce_lake.functions.numbers import percentage, sum_or_zero
from commerce_lake.functions.text import capitalize_name, clean_string, padded_number
from commerce_lake.operators.dedup import latest_by_key, latest_updated_on
from commerce_lake.operators.joins import asof_inner, asof_left, left_join_default, valid_at, versions_by_period
from commerce_lake.operators.quality import missing_values, orphans
from commerce_lake.operators.sampling import bernoulli_sample, fan_out
from commerce_lake.operators.silver import to_silver
from commerce_lake.plans import live
from commerce_lake.schemas import TABLES


def one(spark, column, **values):
    row = spark.createDataFrame([Row(**values)]) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- newest version -------------------------------------------------------------


def versions(spark, *data):
    return spark.createDataFrame(
        [(k, dt.datetime.fromisoformat(u), s, v) for k, u, s, v in data],
        "id bigint, updated_at timestamp, _seq bigint, v string",
    )


def test_ties_are_broken_by_position_then_columns(spark):
    data = [
        (1, "2024-01-01 00:00:00", 1, "a"),
        (1, "2024-01-01 00:00:00", 2, "b"),
        (2, "2024-01-01 00:00:00", 1, "x"),
        (2, "2024-01-01 00:00:00", 1, "y"),
    ]
    for order in (data, data[::-1]):
        got = latest_by_key(versions(spark, *order), "id").select("id", "v")
        assert rows(got) == [(1, "b"), (2, "y")]


def test_latest_updated_on_equals_filter_after_ranking(spark):
    data = [
        (1, "2024-01-01 10:00:00", 1, "old"),
        (1, "2024-01-02 10:00:00", 2, "today"),
        (2, "2024-01-02 10:00:00", 1, "today"),
        (2, "2024-01-03 00:00:00", 2, "later version outranks today"),
        (3, "2024-01-01 10:00:00", 1, "yesterday"),
        (4, "2024-01-02 00:00:00", 1, "first instant"),
        (5, "2024-01-02 23:59:59", 1, "last second"),
    ]
    df = versions(spark, *data)
    plain = latest_by_key(df, "id").where(F.to_date("updated_at") == F.lit("2024-01-02").cast("date"))
    fast = latest_updated_on(df, "id", "2024-01-02")
    assert rows(fast) == rows(plain)
    assert [r[0] for r in rows(fast)] == [1, 4, 5]


def test_hot_key_with_many_versions(spark):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.timestamp_seconds(F.col("id")).alias("updated_at"),
    )
    got = latest_by_key(hot, "k")
    assert got.count() == 20001
    assert got.where("k = 0").first().updated_at.second == dt.datetime.fromtimestamp(29997).second


# --- time -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "a,b,hours",
    [("01:59:00", "02:01:00", 1), ("01:00:00", "01:59:59", 0), ("01:30:00", "03:00:00", 2), ("03:00:00", "01:30:00", -2)],
)
def test_hour_boundaries(spark, a, b, hours):
    first, second = time.as_timestamp(f"2024-01-01 {a}"), time.as_timestamp(f"2024-01-01 {b}")
    assert one(spark, time.hour_boundaries(first, second)) == hours


def test_today_depends_on_the_zone(spark):
    stored = time.as_timestamp("2000-08-04 03:00:00")
    assert not one(spark, time.is_today(stored, "2000-08-03 15:00:00", "Asia/Jakarta"))
    assert one(spark, time.is_today(stored, "2000-08-03 18:00:00", "Asia/Jakarta"))
    aware = dt.datetime(2000, 8, 4, 1, 0, tzinfo=dt.timezone(dt.timedelta(hours=7)))
    assert one(spark, time.is_today(stored, aware, "Asia/Jakarta"))


def test_five_minute_slots(spark):
    assert one(spark, time.five_minute_start(time.as_timestamp("2024-01-01 10:04:59.999")).cast("string")) == (
        "2024-01-01 10:00:00"
    )
    assert one(spark, time.five_minute_start(time.as_timestamp("1969-12-31 23:59:00")).cast("string")) == (
        "1969-12-31 23:55:00"
    )


# --- decoding -------------------------------------------------------------------


def test_defaults_of_missing_values(spark):
    null = F.lit(None)
    assert one(spark, decode.long_or_zero(null.cast("bigint"))) == 0
    assert one(spark, decode.int_or_zero(F.lit("x"))) == 0
    assert one(spark, decode.double_or_zero(F.lit("bad"))) == 0.0
    assert one(spark, decode.string_or_empty(null.cast("string"))) == ""
    assert one(spark, decode.decimal_or_zero(null.cast("string"))) == Decimal("0.00")
    assert one(spark, decode.micros_to_timestamp_or_epoch(null.cast("bigint")).cast("string")) == "1970-01-01 00:00:00"
    assert one(spark, decode.micros_to_timestamp(null.cast("bigint"))) is None


def test_malformed_decimal_raises(spark):
    df = spark.createDataFrame([("12.x",)], "v string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|12.x"):
        df.select(decode.decimal_or_zero(F.col("v"))).collect()


def test_micros_truncate_toward_zero(spark):
    assert one(spark, F.unix_millis(decode.micros_to_timestamp(F.lit(1999)))) == 1
    assert one(spark, F.unix_millis(decode.micros_to_timestamp(F.lit(-1999)))) == -1


# --- text -----------------------------------------------------------------------


def test_cleaning_keeps_blanks_and_listed_signs(spark):
    assert one(spark, clean_string(F.lit("  a-b\tcé 'd' \"e\" 5%$#@&_!?():;.,"))) == 'a' + 'b\tc d "e" 5%$#@&_!?():;.,'
    assert one(spark, clean_string(F.lit("\ttab first"))) == "\ttab first"


@pytest.mark.parametrize(
    "raw,expected",
    [("HOME & kitchen", "Home & Kitchen"), ("a.b(c)", "A.B(C)"), ("", ""), ("x2y z", "X2y Z"), ("o_orderkey", "O_Orderkey")],
)
def test_capitalize_starts_after_any_sign(spark, raw, expected):
    assert one(spark, capitalize_name(F.lit(raw))) == expected


def test_padding_cuts_long_numbers(spark):
    assert one(spark, padded_number(F.lit(42), 6)) == "000042"
    assert one(spark, padded_number(F.lit(1234567), 6)) == "123456"


# --- numbers --------------------------------------------------------------------


def test_percentage_is_half_even_and_null_for_nothing(spark):
    assert one(spark, percentage(F.lit(97), F.lit(800))) == 12.12
    assert one(spark, percentage(F.lit(0), F.lit(0))) is None


def test_sum_of_nothing_is_zero(spark):
    assert spark.range(0).agg(sum_or_zero(F.col("id"), "bigint")).first()[0] == 0


# --- joins ----------------------------------------------------------------------


@pytest.mark.parametrize("spread_by", [None, "pid"])
def test_defaults_only_on_unmatched_rows(spark, spread_by):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k bigint")
    right = spark.createDataFrame(
        [(1, 10, "a", None), (1, 11, "b", 5), (2, 12, None, None)], "k bigint, pid bigint, name string, note int"
    )
    got = left_join_default(left, right.drop("pid") if spread_by is None else right, "k", {"name": "", "note": 0}, spread_by)
    assert sorted(map(tuple, got.select("k", "name", "note").collect()), key=str) == sorted(
        [(1, "a", None), (1, "b", 5), (2, None, None), (3, "", 0), (None, "", 0)], key=str
    )


def test_spread_join_equals_plain_join_with_hot_key(spark):
    left = spark.range(50).withColumnRenamed("id", "k")
    right = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("pid"),
        (F.col("id") % 5).alias("v"),
    )
    plain = left_join_default(left, right.drop("pid"), "k", {"v": -1})
    spread = left_join_default(left, right, "k", {"v": -1}, spread_by="pid")
    assert plain.columns == spread.columns
    assert rows(plain) == rows(spread)


def dimension(spark):
    day = dt.date.fromisoformat
    return spark.createDataFrame(
        [
            ("k1", 1, day("2024-01-01"), day("2024-01-05"), 0),
            ("k2", 1, day("2024-01-05"), None, 1),
            ("k3", 2, day("2024-01-03"), None, 1),
        ],
        "user_key string, user_id bigint, start_date date, end_date date, is_current int",
    )


def test_validity_is_half_open(spark):
    facts = spark.createDataFrame(
        [(1, dt.date(2024, 1, 4)), (1, dt.date(2024, 1, 5)), (2, dt.date(2024, 1, 2)), (2, dt.date(2024, 1, 3))],
        "user_id bigint, d date",
    )
    got = asof_inner(facts, dimension(spark), "user_id", F.col("d"), ["user_key"])
    assert rows(got.select("user_id", F.dayofmonth("d"), "user_key")) == [(1, 4, "k1"), (1, 5, "k2"), (2, 3, "k3")]


def test_asof_left_keeps_unmatched(spark):
    facts = spark.createDataFrame([(1,), (2,), (9,)], "user_id bigint")
    got = asof_left(facts, dimension(spark), "user_id", "2024-01-02", ["user_key"], {"user_key": ""})
    assert rows(got) == [(1, "k1"), (2, ""), (9, "")]


def _versions(spark, keys, count):
    """`count` versions of each key, each valid for one day, but every seventh, which ends a day early."""
    return spark.range(keys * count).selectExpr(
        f"id div {count} AS user_id", "concat('v', id) AS user_key",
        f"date_add(DATE'1800-01-01', CAST(2 * (id % {count}) AS INT)) AS start_date",
        f"CASE WHEN id % {count} = {count - 1} THEN NULL ELSE "
        f"date_add(DATE'1800-01-01', CAST(2 * (id % {count}) + IF(id % 7 = 0, 1, 2) AS INT)) END AS end_date",
        f"IF(id % {count} = {count - 1}, 1, 0) AS is_current",
    )


def test_asof_against_the_range_join(spark):
    """All dates around the versions, facts of one key in very different numbers, gaps, missing keys and dates."""
    dim = _versions(spark, 3, 80)
    facts = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id % 5 END AS user_id",
        "CASE WHEN id % 40 = 7 THEN NULL ELSE date_add(DATE'1799-12-20', CAST(id % 400 AS INT)) END AS d",
    )
    on = (facts.user_id == dim.user_id) & valid_at(facts.d, dim.start_date, dim.end_date, dim.is_current)
    want = rows(facts.join(dim, on).select("id", "user_key"))
    assert rows(asof_inner(facts, dim, "user_id", F.col("d"), ["user_key"]).select("id", "user_key")) == want and want
    kept = {k: v for k, v in want}
    got = asof_left(facts, dim, "user_id", F.col("d"), ["user_key"], {"user_key": "none"})
    assert got.columns == ["id", "user_id", "d", "user_key"]
    assert {r.id: r.user_key for r in got.collect()} == {k: kept.get(k, "none") for k in range(3000)}


def test_asof_joins_a_fact_with_one_row_however_many_versions_its_key_has(spark, tmp_path):
    """One key with 100,000 versions and all facts: the join gives as many rows as there are facts."""
    dim = _versions(spark, 1, 100_000)
    facts = spark.range(20_000).selectExpr("id", "0L AS user_id", "date_add(DATE'1800-01-01', CAST(10 * id AS INT)) AS d")
    found = asof_inner(facts, dim, "user_id", F.col("d"), ["user_key"])
    # every fact stands on the first day of a two-day version, so each has one
    assert found.count() == found.select("id").distinct().count() == 20_000
    lookup = versions_by_period(dim, facts.select("user_id", F.trunc("d", "MM").alias("_period")).distinct(), "user_id", ["user_key"])
    sizes = lookup.select(F.max(F.size("_versions")), F.count("*"), F.count_distinct("user_id", "_period")).first()
    assert sizes[0] <= 32 and sizes[1] == sizes[2]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "start_date" not in plan.split("Join Inner")[1].split("\n")[0]


# --- alerts ---------------------------------------------------------------------


def test_three_failures_in_one_slot(spark):
    at = dt.datetime.fromisoformat
    payments = [
        (i, order, "failed", at(f"2024-01-01 10:0{m}:00"), at("2024-01-01 11:00:00"))
        for i, (order, m) in enumerate([(1, 0), (1, 2), (2, 4), (3, 5), (3, 6), (9, 0), (9, 1), (9, 1)])
    ]
    payments.append((0, 1, "completed", at("2024-01-01 10:00:00"), at("2024-01-01 09:00:00")))
    payments = spark.createDataFrame(
        payments, "payment_id bigint, order_id bigint, status string, payment_date timestamp, updated_at timestamp"
    )
    orders = spark.createDataFrame(
        [(1, 7, at("2024-01-01 09:00:00")), (2, 7, at("2024-01-01 09:00:00")), (3, 7, at("2024-01-01 09:00:00"))],
        "order_id bigint, user_id bigint, updated_at timestamp",
    )
    got = live.abnormal_payment(payments, orders).select("user_id", "failed_count", F.minute("window_end"))
    assert rows(got) == [(0, 3, 5), (7, 3, 5)]


def test_lookback_on_update_time_gives_the_same_alerts(spark):
    from commerce_lake import fixtures

    fx = fixtures.load(spark, "/root/testdata/sf0.001")
    plain = live.abnormal_order(fx["order"], fx["item_line"], "1998-08-17 15:00:00", "30 days")
    pruned = live.abnormal_order(
        fx["order"], fx["item_line"], "1998-08-17 15:00:00", "30 days", updates_follow_creation=True
    )
    assert rows(plain) == rows(pruned) != []


def test_every_product_version_counts_unless_latest(spark):
    at = dt.datetime(2024, 1, 1, 10)
    orders = spark.createDataFrame([(1, "completed", at)], "order_id bigint, order_status string, updated_at timestamp")
    items = spark.createDataFrame(
        [(5, 1, 3, 2, Decimal("4.00"), at)],
        "order_item_id bigint, order_id bigint, product_id bigint, quantity int, price decimal(18,2), updated_at timestamp",
    )
    products = spark.createDataFrame(
        [(3, "old", at - dt.timedelta(days=1)), (3, "new", at)], "product_id bigint, name string, updated_at timestamp"
    )
    args = (orders, items, products, "2024-01-01 12:00:00")
    assert rows(live.top_selling_product(*args).select("name", "total_quantity")) == [("new", 2), ("old", 2)]
    latest = live.top_selling_product(*args, latest_products=True)
    assert rows(latest) == [("new", 2, Decimal("8.00"))]


# --- silver, quality, sampling --------------------------------------------------


def test_silver_names_and_types(spark):
    empty = spark.createDataFrame([], TABLES["user"].bronze_schema())
    assert to_silver(empty).columns == [
        "user_id", "name", "email", "phone", "created_time", "updated_time", "deleted_time",
    ]
    product = to_silver(spark.createDataFrame([], TABLES["product"].bronze_schema()))
    assert ("price_amount", "decimal(18,2)") in product.dtypes
    payment = to_silver(spark.createDataFrame([], TABLES["payment"].bronze_schema()))
    assert "payment_time" in payment.columns and "amount" in payment.columns


def test_orphans_and_missing(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (0,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(1,), (1,)], "pk bigint")
    assert rows(orphans(child, "fk", parent, "pk")) == [(0, 1), (2, 2)]
    assert rows(orphans(child, "fk", parent, "pk", absent=0)) == [(2, 2)]
    assert rows(missing_values(child, ["fk"])) == [("fk", 1)]


def test_sample_is_reproducible_and_near_its_rate(spark):
    df = spark.range(20000)
    first, again = bernoulli_sample(df, "id", 0.8), bernoulli_sample(df.repartition(7), "id", 0.8)
    assert rows(first) == rows(again)
    assert abs(first.count() / 20000 - 0.8) < 0.02
    assert bernoulli_sample(df, "id", 1.0).count() == 20000
    assert bernoulli_sample(df, "id", 0.0).count() == 0


def test_fan_out(spark):
    df = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "id bigint, n int")
    assert rows(fan_out(df, F.col("n"), "i").select("id", "i")) == [(1, 1), (1, 2), (3, 1)]


def test_surrogate_key_is_unique_per_version(spark):
    df = spark.range(100).select(
        surrogate_key(F.col("id"), "2024-01-01").alias("a"), surrogate_key(F.col("id"), "2024-01-02").alias("b")
    )
    assert df.select("a").union(df.select("b")).distinct().count() == 200


def test_day_sketches_unite_without_counting_twice(spark):
    from commerce_lake.operators import distinct

    rows = [(f"2025-01-{1 + k % 20:02d}", "a", k % 500) for k in range(4000)] + [("2025-02-01", "a", 1), ("2025-02-01", "b", None)]
    df = spark.createDataFrame(rows, "day string, kind string, user long")
    days = distinct.day_sketches(df, F.to_date("day"), ["kind"], ["user"])
    got = {(str(r.period), r.kind): r.user for r in distinct.distinct_in(days, F.trunc("date_key", "month"), ["kind"], ["user"]).collect()}
    assert abs(got["2025-01-01", "a"] - 500) <= 25
    assert (got["2025-02-01", "a"], got["2025-02-01", "b"]) == (1, 0)
