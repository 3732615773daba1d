"""Keyed state and timers: after every micro-batch against the batch views of the same rows."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from commerce_lake.plans import live
from commerce_lake.session import rocksdb_state
from commerce_lake.streaming import stateful
from commerce_lake.streaming.sinks import read_batches, read_newest, write_batches

ORDER = "order_id bigint, user_id bigint, order_status string, total_amount decimal(18,2), created_at timestamp, updated_at timestamp, _seq bigint"
ITEM = "order_item_id bigint, order_id bigint, product_id bigint, quantity int, price decimal(18,2), updated_at timestamp, _seq bigint"
PAYMENT = "payment_id bigint, order_id bigint, status string, payment_date timestamp, updated_at timestamp, _seq bigint"


class Stream:
    """A table that grows by one file per batch, read as a stream."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.rows = spark, str(folder), schema, []

    def add(self, rows):
        self.rows += rows
        self.frame(rows).coalesce(1).write.mode("append").parquet(self.folder)

    def frame(self, rows=None):
        return self.spark.createDataFrame(self.rows if rows is None else rows, self.schema)

    def read(self):
        return self.spark.readStream.schema(self.frame([]).schema).parquet(self.folder)


def run(spark, stream, tmp_path, each=None):
    with rocksdb_state(spark):
        write_batches(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint"), each=each, once=True).awaitTermination()


def at(text):
    return dt.datetime.fromisoformat(f"2024-01-{text}")


def order(i, status, updated, created="01 10:00:00", seq=0):
    return (i, i % 3, status, None, at(created), at(updated), seq)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_last_seen_passes_newer_versions_and_forgets(spark, tmp_path):
    source = Stream(spark, tmp_path / "in", ORDER)
    batches = [
        ([order(1, "created", "01 10:00:00"), order(1, "paid", "01 10:05:00"), order(2, "created", "01 10:01:00")], [(1, "paid"), (2, "created")]),
        # older, repeated, tied with a higher position, newer
        ([order(1, "created", "01 10:03:00"), order(1, "paid", "01 10:05:00"), order(2, "paid", "01 10:01:00", seq=1)], [(2, "paid")]),
        ([order(1, "done", "01 11:00:00"), order(3, "created", "03 12:00:00")], [(1, "done"), (3, "created")]),
        # the watermark is past the lifetime of 1 and 2: a row for them is late unless it is of now, and then it is a first one
        ([order(1, "late", "01 11:30:00"), order(2, "again", "03 12:00:00"), order(3, "created", "03 12:00:00")], [(2, "again")]),
        ([order(4, "created", "04 18:00:00")], [(4, "created")]),
    ]
    seen = []
    for given, want in batches:
        source.add(given)
        run(spark, stateful.last_seen(source.read(), "order_id", lifetime="1 day"), tmp_path)
        out = read_batches(spark, str(tmp_path / "table"), source.frame([]).schema)
        assert out.drop("batch_id").columns == source.frame([]).columns
        now = rows(out.select("order_id", "order_status", "updated_at"))
        assert sorted(r[:2] for r in now if r not in seen) == sorted(want)
        assert all(r in now for r in seen)
        seen = now


def test_state_of_a_key_ends_with_its_lifetime(spark, tmp_path):
    """Rows of the state store fall with the keys whose lifetime the watermark has passed."""
    source = Stream(spark, tmp_path / "in", ORDER)
    sizes = []
    for day in range(1, 6):
        source.add([order(day * 100 + k, "created", f"0{day} 10:00:00") for k in range(50)])
        stream = stateful.last_seen(source.read(), "order_id", lifetime="1 day")
        with rocksdb_state(spark):
            query = write_batches(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True)
            query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sizes[-1] <= sizes[2] and read_batches(spark, str(tmp_path / "table"), source.frame([]).schema).count() == 250


def test_stuck_orders_agree_with_the_view_at_each_watermark(spark, tmp_path):
    source = Stream(spark, tmp_path / "in", ORDER)
    batches = [
        [order(1, "created", "01 10:00:00"), order(2, "created", "01 10:59:59", "01 10:59:59"), order(3, "created", "01 10:30:00")],
        # the watermark comes to 12:00, the deadline of all three; 3 has ended
        [order(3, "completed", "01 11:30:00"), order(9, "created", "01 12:10:00", "01 12:10:00")],
        # 1 ends late, 3 is opened again, 2 changes but stays created
        [order(1, "cancelled", "01 12:20:00"), order(3, "created", "01 12:21:00"), order(2, "created", "01 12:25:00", "01 10:59:59")],
        [order(4, "created", "01 12:30:00", "01 12:30:00"), order(4, "completed", "01 12:30:00", "01 12:30:00", seq=1)],
        [order(2, "completed", "01 13:00:00", "01 10:59:59"), order(5, "created", "01 14:05:00", "01 14:05:00")],
        [order(5, "completed", "01 14:30:00", "01 14:05:00"), order(6, "created", "02 14:00:00", "02 14:00:00")],
    ]
    newest, alerts = None, 0
    for given in batches:
        source.add(given)
        stream = stateful.stuck_orders(source.read())
        run(spark, stream, tmp_path)
        newest = max(newest or given[0][5], *(r[5] for r in given))
        watermark = newest - dt.timedelta(minutes=10)
        want = rows(live.stuck_order(source.frame(), watermark).select("order_id", "created_at"))
        table = read_newest(spark, str(tmp_path / "table"), stream.schema, "order_id", ["updated_at", "stuck"])
        assert rows(table.where("stuck").select("order_id", "created_at")) == want, watermark
        alerts += len(want)
    assert alerts >= 8


def revenue(orders, items):
    """The live mart of every day, from all rows."""
    days = [r[0] for r in orders.select(F.to_date("updated_at")).distinct().collect()]
    out = []
    for day in days:
        mart = live.order_revenue(orders, items, dt.datetime.combine(day, dt.time(1)), "UTC")
        out += [(day, *r) for r in mart.collect()]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_revenue_kept_by_deltas_is_the_batch_view_after_every_batch(spark, tmp_path, seed):
    """Late, repeated and tied versions, status changes back, items that move to another order, items before their order."""
    rng = random.Random(seed)
    orders, items = Stream(spark, tmp_path / "orders", ORDER), Stream(spark, tmp_path / "items", ITEM)
    keys, seq = ["sales_day", "hour"], 0
    for _ in range(4):
        some, lines = [], []
        for _ in range(12):
            seq += 1
            when = f"0{rng.randrange(1, 4)} {rng.randrange(10, 13)}:00:0{rng.randrange(3)}"
            some.append(order(rng.randrange(8), rng.choice(["created", "completed", "completed", "cancelled"]), when, f"01 0{rng.randrange(7, 9)}:30:00", seq))
            lines.append((rng.randrange(12), rng.randrange(8), 1, rng.randrange(1, 5), decimal.Decimal(rng.randrange(1000)) / 4, at(when), rng.choice([seq, 0])))
        some += rng.sample(orders.rows + some, 3)
        lines += rng.sample(items.rows + lines, 3)
        orders.add(some)
        items.add(lines)
        stream = stateful.revenue_deltas(orders.read(), items.read())
        run(spark, stream, tmp_path, each=lambda batch: stateful.summed(batch, keys))
        mart = stateful.summed(read_batches(spark, str(tmp_path / "table"), stream.schema).drop("batch_id"), keys)
        assert rows(mart) == revenue(orders.frame(), items.frame())


def test_failure_rate_kept_by_deltas_is_the_batch_view_after_every_batch(spark, tmp_path):
    rng = random.Random(3)
    payments = Stream(spark, tmp_path / "in", PAYMENT)
    for _ in range(3):
        given = []
        for _ in range(15):
            when = at(f"0{rng.randrange(1, 4)} 1{rng.randrange(3)}:00:00")
            paid = at(f"0{rng.randrange(1, 4)} 09:00:00")
            given.append((rng.randrange(99), rng.randrange(6), rng.choice(["failed", "completed"]), paid, when, rng.randrange(3)))
        payments.add(given + rng.sample(payments.rows + given, 2))
        stream = stateful.payment_deltas(payments.read())
        run(spark, stream, tmp_path, each=lambda batch: stateful.summed(batch, ["payment_day"]))
        mart = stateful.summed(read_batches(spark, str(tmp_path / "table"), stream.schema).drop("batch_id"), ["payment_day"])
        got = {r.payment_day: (r.failed, r.total, r.failed_rate) for r in stateful.failure_rates(mart).collect()}
        for day in range(1, 4):
            want = tuple(live.payment_failure_rate(payments.frame(), f"2024-01-0{day} 12:00:00", "UTC").first())
            assert got.get(dt.date(2024, 1, day), (0, 0, None)) == want


def _many_orders(spark, n):
    at_ = F.lit("2024-01-01 10:00:00").cast("timestamp")
    return spark.range(n).select(
        F.col("id").alias("order_id"), (F.col("id") % 3).alias("user_id"), F.lit("created").alias("order_status"),
        F.lit(None).cast("decimal(18,2)").alias("total_amount"), at_.alias("created_at"), at_.alias("updated_at"), F.col("id").alias("_seq"),
    )


def _many_items(spark, n):
    at_ = F.lit("2024-01-01 10:00:00").cast("timestamp")
    price = (F.col("id") % 100).cast("decimal(18,2)").alias("price")
    return spark.range(n).select(F.col("id").alias("order_item_id"), (F.col("id") % 50).alias("order_id"), F.lit(1).alias("quantity"), price, at_.alias("updated_at"), F.lit(0).cast("long").alias("_seq"))


@pytest.mark.parametrize("kind", ["last_seen", "stuck", "revenue", "payment"])
def test_a_micro_batch_calls_a_block_once_and_not_each_key(spark, tmp_path, kind):
    """State rows, timers included, follow the blocks, however many keys there are."""
    folder, n = str(tmp_path / "in"), 20_000

    def read(df, name=""):
        df.write.parquet(folder + name)
        return spark.readStream.schema(df.schema).parquet(folder + name)

    orders = _many_orders(spark, n)
    if kind == "last_seen":
        stream = stateful.last_seen(read(orders), "order_id")
    elif kind == "stuck":
        stream = stateful.stuck_orders(read(orders))
    elif kind == "revenue":
        done = orders.withColumn("order_status", F.lit("completed"))
        stream = stateful.revenue_deltas(read(done), read(_many_items(spark, n), "_items"))
    else:
        paid = orders.select("order_id", F.lit("failed").alias("status"), F.col("created_at").alias("payment_date"), "updated_at", "_seq")
        stream = stateful.payment_deltas(read(paid))
    with rocksdb_state(spark):
        query = write_batches(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True)
        query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert 0 < max(states) <= 3 * stateful.BLOCKS
    out = read_batches(spark, str(tmp_path / "table"), stream.schema).drop("batch_id")
    if kind == "last_seen":
        assert out.count() == n and out.select("order_id").distinct().count() == n
    elif kind == "revenue":
        mart = stateful.summed(out, ["sales_day", "hour"]).collect()
        assert [tuple(r)[2:] for r in mart] == [(50, n, decimal.Decimal(sum(k % 100 for k in range(n))))]
    elif kind == "payment":
        assert [tuple(r)[1:] for r in stateful.summed(out, ["payment_day"]).collect()] == [(n, n)]
