"""The daily run on stored tables: three days, reruns, interrupted loads."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from commerce_lake.operators import scd2
from commerce_lake.plans import daily, live, publication
from commerce_lake.schemas import BATCH, DAY, TABLES
from commerce_lake.sources import tables

D1, D2, D3 = "2024-03-01", "2024-03-02", "2024-03-03"


def at(text):
    return dt.datetime.fromisoformat(text)


USERS = [
    (1, "ann lee", "a@x.org", "h", "0811", at(f"{D1} 08:00:00"), at(f"{D1} 08:00:00"), None, 1),
    (2, "bob-ray", "b@x.org", "h", "", at(f"{D1} 09:00:00"), at(f"{D1} 09:00:00"), None, 2),
    (1, "ann may", "a@x.org", "h", "0811", at(f"{D1} 08:00:00"), at(f"{D2} 07:00:00"), None, 3),
    (1, "ann mae", "a@x.org", "h", "0811", at(f"{D1} 08:00:00"), at(f"{D2} 07:30:00"), None, 4),
]
CATEGORIES = [(1, "books", None, at(f"{D1} 01:00:00"), at(f"{D1} 01:00:00"), None, 1)]
PRODUCTS = [
    (10, "red book", "d", Decimal("5.00"), 3, 1, at(f"{D1} 01:00:00"), at(f"{D1} 01:00:00"), None, 1),
    (11, "odd thing", "d", Decimal("7.00"), 3, 0, at(f"{D1} 01:00:00"), at(f"{D1} 01:00:00"), None, 2),
]
ORDERS = [
    (100, 1, "created", Decimal("20.00"), at(f"{D2} 10:00:00"), at(f"{D2} 10:00:00"), 1),
    (100, 1, "completed", Decimal("20.00"), at(f"{D2} 10:00:00"), at(f"{D3} 09:00:00"), 2),
    (101, 2, "created", Decimal("9.00"), at(f"{D2} 11:00:00"), at(f"{D2} 11:00:00"), 3),
    (101, 2, "cancelled", Decimal("9.00"), at(f"{D2} 11:00:00"), at(f"{D2} 12:00:00"), 4),
    (102, 77, "created", Decimal("1.00"), at(f"{D2} 11:00:00"), at(f"{D2} 11:00:00"), 5),
]
ITEMS = [
    (1000, 100, 10, 2, Decimal("5.00"), at(f"{D2} 10:00:00"), at(f"{D2} 10:00:00"), 1),
    (1001, 100, 11, 1, Decimal("7.00"), at(f"{D2} 10:00:00"), at(f"{D2} 10:00:00"), 2),
    (1002, 101, 99, 1, Decimal("9.00"), at(f"{D2} 11:00:00"), at(f"{D2} 11:00:00"), 3),
]
PAYMENTS = [
    (500, 101, Decimal("9.00"), "paypal", at(f"{D2} 12:00:00"), "failed", at(f"{D2} 12:00:00"), at(f"{D2} 12:00:00"), 1),
    (501, 100, Decimal("20.00"), "credit_card", at(f"{D3} 09:00:00"), "failed", at(f"{D3} 08:00:00"), at(f"{D3} 08:00:00"), 2),
    (501, 100, Decimal("20.00"), "credit_card", at(f"{D3} 09:00:00"), "completed", at(f"{D3} 08:00:00"), at(f"{D3} 09:00:00"), 3),
]
SHIPPING = [
    (900, 100, "a", "oslo", "00100", "norway", at(f"{D2} 10:00:00"), "", at(f"{D2} 10:00:00"), at(f"{D2} 10:00:00"), 1),
]
REVIEWS = [(1, 10, 1, 5, "", at(f"{D3} 10:00:00"), at(f"{D3} 10:00:00"), 1)]
ROWS = {
    "user": USERS, "category": CATEGORIES, "product": PRODUCTS, "order": ORDERS,
    "order_item": ITEMS, "payment": PAYMENTS, "shipping": SHIPPING, "product_review": REVIEWS,
}


@pytest.fixture
def lake(spark, tmp_path):
    lake = daily.Lake(spark, str(tmp_path / "lake"), str(tmp_path / "remote"))
    for name, rows in ROWS.items():
        spec = TABLES[name]
        df = spark.createDataFrame(rows, spec.bronze_schema().add("_seq", LongType()))
        ingest(lake, spec, df, 0)
    return lake


def ingest(lake, spec, rows, batch):
    """As the stream does it: one micro-batch, by day and batch."""
    rows = rows.withColumns({DAY: F.to_date("updated_at"), BATCH: F.lit(batch).cast("long")})
    tables.append(rows, lake.path(spec.bronze_hot), DAY, BATCH)


def rows_of(spark, spec, rows):
    return spark.createDataFrame(rows, spec.bronze_schema().add("_seq", LongType()))


def snapshot(lake):
    out = {}
    for table in ("fact_order", "fact_order_detail", "daily_transaction", "daily_user"):
        df = lake.read(table)
        out[table] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for dim in scd2.DIMENSIONS.values():
        out[dim.name] = sorted(map(str, daily.read_dimension(lake, dim).collect()))
    return out


def test_three_days(lake):
    for day in (D1, D2, D3):
        daily.run_day(lake, day)

    # hot is drained, cold has every version, silver the last one of each day
    assert lake.read_bronze(TABLES["order"], "hot").isEmpty()
    assert lake.read_bronze(TABLES["order"], "cold").count() == 5
    assert daily.read_silver(lake, "order", D3).count() == 4
    assert lake.path("bronze_cold_order").startswith(lake.cold_root)

    users = daily.read_dimension(lake, scd2.DIM_USER).orderBy("user_id", "start_date")
    assert [(r.user_id, r.name, str(r.start_date), str(r.end_date), r.is_current) for r in users.collect()] == [
        (1, "Ann Lee", D1, D2, 0),
        (1, "Ann Mae", D2, "None", 1),
        (2, "Bobray", D1, "None", 1),
    ]

    key = {(r.user_id, str(r.start_date)): r.user_key for r in users.collect()}
    fact = lake.read("fact_order").orderBy("date_key", "order_id", "order_status")
    got = [
        (r.order_id, str(r.date_key), r.order_status, r.user_key, r.payment_method, r.city, r.order_completed_time)
        for r in fact.collect()
    ]
    # user 77 has no dimension row, so order 102 gives no fact
    assert got == [
        (100, D2, "created", key[1, D2], "credit_card", "oslo", None),
        (101, D2, "cancelled", key[2, D1], "paypal", "", None),
        (101, D2, "created", key[2, D1], "paypal", "", None),
        (100, D3, "completed", key[1, D2], "credit_card", "oslo", at(f"{D3} 09:00:00")),
    ]

    detail = lake.read("fact_order_detail").orderBy("price_amount").collect()
    assert [(r.order_id, r.quantity, r.product_key != "", r.category_key != "") for r in detail] == [
        (100, 2, True, True),
        (100, 1, True, False),
        (101, 1, False, False),
    ]

    mart = lake.read("daily_transaction").where(F.col("date_key") == D3).orderBy("category").collect()
    assert [(r.category, r.total_order, r.total_user, r.items_sold, r.total_revenue) for r in mart] == [
        ("", 1, 1, 1, Decimal("7.00")),
        ("Books", 1, 1, 2, Decimal("5.00")),
    ]
    created = lake.read("daily_transaction").where((F.col("date_key") == D2) & (F.col("order_status") == "created"))
    assert {r.items_sold for r in created.collect()} == {0}
    users_by_day = lake.read("daily_user").orderBy("date_key").collect()
    assert [(str(r.date_key), r.active_user, r.new_user) for r in users_by_day] == [(D2, 2, 0), (D3, 1, 0)]


def test_rerun_changes_nothing_and_replay_is_refused(lake):
    for day in (D1, D2, D3):
        daily.run_day(lake, day)
    before = snapshot(lake)
    with pytest.raises(daily.AlreadyProcessed):
        daily.run_day(lake, D3)
    with pytest.raises(daily.AlreadyProcessed):
        daily.load_facts(lake, D3)
    with pytest.raises(daily.AlreadyProcessed):
        daily.load_dimension(lake, scd2.DIM_USER, D2, rerun=True)
    daily.run_day(lake, D3, rerun=True)
    assert snapshot(lake) == before


def test_late_rows_add_to_cold_and_reach_everything(lake, spark):
    for day in (D1, D2):
        daily.run_day(lake, day)
    order, user, item = TABLES["order"], TABLES["user"], TABLES["order_item"]
    # a day that is already cold gets more rows, in a later batch
    ingest(lake, order, rows_of(spark, order, [(103, 2, "created", Decimal("3.00"), at(f"{D2} 20:00:00"), at(f"{D2} 20:00:00"), 9)]), 7)
    ingest(lake, user, rows_of(spark, user, [(2, "bob roy", "b@x.org", "h", "", at(f"{D1} 09:00:00"), at(f"{D2} 21:00:00"), None, 9)]), 7)
    ingest(lake, item, rows_of(spark, item, [(1003, 103, 10, 1, Decimal("3.00"), at(f"{D2} 23:50:00"), at(f"{D3} 00:20:00"), 9)]), 7)
    daily.run_day(lake, D3)
    assert tables.scan_day(lake.read_bronze(order, "cold"), D2).count() == 5
    users = [(r.user_id, r.name, str(r.start_date)) for r in daily.read_dimension(lake, scd2.DIM_USER).collect()]
    assert (2, "Bob Roy", D2) in users and len(users) == 4
    assert lake.read("fact_order").where("order_id = 103").select("order_status", F.col("date_key").cast("string")).collect() == [("created", D2)]
    # stamped on the third, created on the second
    assert lake.read("fact_order_detail").where("order_id = 103").select(F.col("date_key").cast("string")).collect() == [(D2,)]
    created = lake.read("daily_user").where(F.col("date_key") == D2).first()
    assert created.active_user == 2


def test_repeated_move_keeps_late_and_half_deleted_batches(lake, spark):
    spec = TABLES["order"]
    assert daily.move_to_cold(lake, spec, D2) == [dt.date.fromisoformat(D2)]
    late = [(104, 1, "created", Decimal("1.00"), at(f"{D2} 22:00:00"), at(f"{D2} 22:00:00"), 8)]
    ingest(lake, spec, rows_of(spark, spec, late), 3)
    daily.move_to_cold(lake, spec, D2)
    cold = tables.scan_day(lake.read_bronze(spec, "cold"), D2)
    assert cold.count() == 5
    # as if the deletion of batch 0 had died half-way: some of its rows are back in hot
    rest = rows_of(spark, spec, [r for r in ORDERS if r[0] == 102])
    ingest(lake, spec, rest, 0)
    daily.move_to_cold(lake, spec, D2)
    assert tables.scan_day(lake.read_bronze(spec, "cold"), D2).count() == 5
    assert tables.scan_day(lake.read_bronze(spec, "hot"), D2).isEmpty()


def test_live_marts_see_both_tiers(lake):
    def stuck():
        return sorted(map(str, live.stuck_order(daily.read_log(lake, TABLES["order"]), f"{D3} 12:00:00").collect()))

    before = stuck()
    assert before
    daily.run_day(lake, D1)
    daily.run_day(lake, D2)
    assert stuck() == before
    # a batch that was copied and not yet dropped counts once
    daily.copy_to_cold(lake, TABLES["order"], D3)
    assert stuck() == before


def test_rerun_clears_a_day_that_has_no_rows_any_more(lake, spark):
    for day in (D1, D2, D3):
        daily.run_day(lake, day)
    tables.drop_partition(spark, lake.path(TABLES["order"].silver), DAY, D3)
    daily.load_facts(lake, D3, rerun=True)
    assert lake.read("fact_order").where(F.col("date_key") == D3).isEmpty()


def test_interrupted_dimension_load_is_invisible_and_repeatable(lake, spark):
    daily.run_day(lake, D1)
    for spec in TABLES.values():
        daily.move_to_cold(lake, spec, D2)
        daily.build_silver(lake, spec, D2)
    before = snapshot_dim(lake)
    daily.load_dimension(lake, scd2.DIM_USER, D2)
    loaded = snapshot_dim(lake)
    # as if the job had died between writing the versions and logging the load
    tables.drop_partition(spark, lake.path("dim_user_loads") + "/generation=0", "load_date", D2)
    assert snapshot_dim(lake) == before != loaded
    daily.load_dimension(lake, scd2.DIM_USER, D2)
    assert snapshot_dim(lake) == loaded


def snapshot_dim(lake):
    return sorted(map(str, daily.read_dimension(lake, scd2.DIM_USER).collect()))


def test_moving_a_day_twice_keeps_cold(lake):
    spec = TABLES["order"]
    daily.move_to_cold(lake, spec, D2)
    daily.move_to_cold(lake, spec, D2)
    assert tables.scan_day(lake.read_bronze(spec, "cold"), D2).count() == 4
    assert tables.scan_day(lake.read_bronze(spec, "hot"), D2).isEmpty()
    assert tables.scan_day(lake.read_bronze(spec, "hot"), D3).count() == 1


def test_day_scan_reads_one_partition(lake):
    scan = tables.scan_day(lake.read_bronze(TABLES["order"], "hot"), D3)
    assert len(scan.inputFiles()) > 1  # the listing before pruning
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(updated_date" in plan
    assert scan.select(F.input_file_name()).distinct().where(~F.col("input_file_name()").contains(D3)).isEmpty()


def test_silver_without_dedup_keeps_all_versions(lake):
    spec = TABLES["user"]
    daily.move_to_cold(lake, spec, D2)
    daily.build_silver(lake, spec, D2, dedup=False)
    assert daily.read_silver(lake, "user", D2).count() == 2
    daily.build_silver(lake, spec, D2)
    assert daily.read_silver(lake, "user", D2).count() == 1


def test_rebuilt_date_keeps_shipping_and_payment_of_earlier_days(lake, spark):
    d5 = "2024-03-05"
    more = {
        "order": [
            (110, 1, "created", Decimal("8.00"), at(f"{D1} 10:00:00"), at(f"{D1} 10:00:00"), 20),
            (110, 1, "completed", Decimal("8.00"), at(f"{D1} 10:00:00"), at(f"{D3} 12:00:00"), 21),
            (111, 2, "created", Decimal("3.00"), at(f"{D3} 13:00:00"), at(f"{D3} 13:00:00"), 22),
            (111, 2, "completed", Decimal("3.00"), at(f"{D3} 13:00:00"), at(f"{d5} 08:00:00"), 23),
        ],
        "shipping": [(910, 110, "b", "rome", "00200", "italy", at(f"{D2} 10:00:00"), "", at(f"{D2} 10:00:00"), at(f"{D2} 10:00:00"), 20)],
        "payment": [(510, 110, Decimal("8.00"), "paypal", at(f"{D2} 11:00:00"), "completed", at(f"{D2} 11:00:00"), at(f"{D2} 11:00:00"), 20)],
    }
    for name, rows in more.items():
        ingest(lake, TABLES[name], rows_of(spark, TABLES[name], rows), 1)

    def completed():
        facts = lake.read("fact_order").where(f"order_id = 110 AND date_key = '{D3}' AND order_status = 'completed'")
        return [tuple(r) for r in facts.select("country", "city", "postal_code", "payment_method").collect()]

    def countries():
        sales = lake.read("daily_transaction").where(f"date_key = '{D3}' AND order_status = 'completed'")
        return {r.country for r in sales.collect()}

    daily.run_day(lake, D3)
    before = completed(), countries()
    assert len(before[0]) == 1 and "" not in before[0][0] and "" not in before[1]
    daily.run_day(lake, d5)
    assert (completed(), countries()) == before


# --- publication and ledger -----------------------------------------------------


def test_a_cut_off_run_is_invisible_and_goes_on_where_it_stopped(lake, monkeypatch):
    for day in (D1, D2):
        daily.run_day(lake, day)
    before = snapshot(lake)
    seen = {name: before[name] for name in ("fact_order", "fact_order_detail", "daily_transaction", "daily_user")}
    published = lambda: {name: rows for name, rows in snapshot(lake).items() if name in seen}
    calls = []
    real_copy, real_user = daily.copy_to_cold, daily.marts.daily_user
    monkeypatch.setattr(daily, "copy_to_cold", lambda *a: calls.append(a[1].name) or real_copy(*a))

    def broken(*a):
        assert published() == seen  # the facts of the day are written, and no reader sees them
        raise RuntimeError("lost")

    monkeypatch.setattr(daily.marts, "daily_user", broken)
    with pytest.raises(RuntimeError, match="lost"):
        daily.run_day(lake, D3)
    assert published() == seen and len(calls) == len(TABLES)
    monkeypatch.setattr(daily.marts, "daily_user", real_user)
    real_drop = daily.drop_from_hot
    monkeypatch.setattr(daily, "drop_from_hot", broken_after := lambda *a: (_ for _ in ()).throw(RuntimeError("late")))
    with pytest.raises(RuntimeError, match="late"):
        daily.run_day(lake, D3)
    after = published()
    assert after != seen and len(calls) == len(TABLES) and broken_after
    monkeypatch.setattr(daily, "drop_from_hot", real_drop)
    daily.run_day(lake, D3)  # only the last step is left
    assert published() == after and len(calls) == len(TABLES)
    assert lake.read_bronze(TABLES["order"], "hot").isEmpty()
    with pytest.raises(daily.AlreadyProcessed):
        daily.run_day(lake, D3)
    daily.run_day(lake, D3, rerun=True)
    assert published() == after


def test_of_two_runs_from_one_version_the_second_fails(lake, spark):
    for day in (D1, D2):
        daily.run_day(lake, day)
    one, two = publication.Publication(lake), publication.Publication(lake)
    table, schema = "daily_user", daily.marts.SCHEMAS["daily_user"]
    rows = lambda n: spark.createDataFrame([(n, 0, dt.date.fromisoformat(D3))], schema)
    one.write(table, rows(1), [D3], ["active_user"])
    two.write(table, rows(2), [D3], ["active_user"])
    assert lake.read(table).where(f"date_key = '{D3}'").isEmpty()
    one.commit()
    with pytest.raises(publication.ConcurrentRun):
        two.commit()
    assert [r.active_user for r in lake.read(table).where(f"date_key = '{D3}'").collect()] == [1]
    # an emptied day, and what no manifest names any more
    three = publication.Publication(lake)
    three.write(table, rows(1).where("false"), [D3], ["active_user"])
    three.commit()
    assert lake.read(table).where(f"date_key = '{D3}'").isEmpty()
    kept = snapshot(lake)
    assert publication.vacuum(lake, keep=1) == 2 and snapshot(lake) == kept
