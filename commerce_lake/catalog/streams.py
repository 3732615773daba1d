"""Streaming queries: a table is read as a stream, drained, and its sink read back.

Each run writes to a fresh folder below the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.catalog import query
from commerce_lake.catalog.views import LATEST_ITEM, LATEST_ORDER, latest
from commerce_lake.fixtures import order_versions
from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.schemas import TABLES
from commerce_lake.session import rocksdb_state, work_dir
from commerce_lake.sources import cdc, segments
from commerce_lake.streaming import alerts, dedup, stateful
from commerce_lake.streaming.sinks import read_batches, read_newest, write_batches


def table_stream(fx, name: str) -> DataFrame:
    """A table of the data set, file or folder, as a stream (the brackets make it a path pattern)."""
    schema = fx.source(name).schema
    return fx.spark.readStream.schema(schema).parquet(f"{fx.folder}/{name}.[p]arquet")


def drain(
    fx,
    stream: DataFrame,
    purpose: str,
    each: Callable[[DataFrame], DataFrame] | None = None,
    mode: str = "append",
    newest: str | Sequence[str] | None = None,
    version: Sequence[str] = (),
) -> DataFrame:
    base = work_dir(fx.spark, purpose)
    with rocksdb_state(fx.spark):
        run = write_batches(
            stream, f"{base}/table", f"{base}/checkpoint", each=each, output_mode=mode, once=True
        )
        run.awaitTermination()
    if newest is None:
        return read_batches(fx.spark, f"{base}/table", stream.schema).drop("batch_id")
    return read_newest(fx.spark, f"{base}/table", stream.schema, newest, version)


def _order_stream(fx) -> DataFrame:
    return order_versions(table_stream(fx, "orders"))


def _dealt(fx, table: DataFrame, keys: Sequence[str], purpose: str, batches: int = 4, file_rows: int = 500_000) -> DataFrame:
    """A table as a stream of about `batches` micro-batches, dealt by `keys`; a larger one has several files in each, for as many tasks."""
    folder = work_dir(fx.spark, purpose)
    files = max(1, table.count() // (batches * file_rows))
    table.repartition(batches * files, *keys).write.parquet(folder)
    return fx.spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _order_batches(fx, batches: int = 4) -> DataFrame:
    """All order versions as a stream of several micro-batches, dealt by id and version.

    The versions of an order come in different batches, and the older one may come later.
    """
    return _dealt(fx, fx["order"], ["order_id", "_seq"], "order_batches", batches)


def _in_time(fx, table: DataFrame, at: str = "updated_at", batches: int = 4, file_rows: int = 500_000) -> DataFrame:
    """A table as a stream of micro-batches, each of a span of time after the one before.

    A span is written by several tasks where all spans have rows for as many files, so that each is one micro-batch.
    """
    folder = work_dir(fx.spark, "spans")
    first, last = table.agg(F.min(F.unix_seconds(at)), F.max(F.unix_seconds(at))).first()
    span = ((last or 0) - (first or 0)) // batches + 1
    nth = F.floor((F.unix_seconds(at) - (first or 0)) / span)
    sizes = {r[0]: r[1] for r in table.where(F.col(at).isNotNull()).groupBy(nth).count().collect()}
    files = max(1, min(sizes.get(k, 0) for k in range(batches)) // file_rows)
    for k in range(batches):
        start = (first or 0) + k * span
        inside = table.where((F.unix_seconds(at) >= start) & (F.unix_seconds(at) < start + span))
        (inside.repartition(files) if files > 1 else inside.coalesce(1)).write.mode("append").parquet(folder)
    return fx.spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _mart(fx, deltas: DataFrame, purpose: str, keys: Sequence[str]) -> DataFrame:
    """A mart kept by deltas: each micro-batch adds its sums, and the mart is the sum of all."""
    return stateful.summed(drain(fx, deltas, purpose, each=lambda batch: stateful.summed(batch, keys)), keys)


@query("bronze_append", "SELECT * FROM t_order")
def _bronze_append(fx):
    """Every change event becomes a bronze row, none is removed."""
    spec = TABLES["order"]
    events = cdc.to_json_events(_order_stream(fx), spec)
    return drain(fx, cdc.json_to_bronze(events, spec), "bronze_append")


@query("bronze_from_segments", "SELECT * EXCLUDE (_seq) FROM t_order")
def _bronze_from_segments(fx):
    """Order events as a log of segments, read by offsets from the earliest on."""
    spec, folder = TABLES["order"], work_dir(fx.spark, "segments")
    segments.write_log(cdc.to_json_events(fx["order"], spec), folder, partitions=4)
    events = segments.read_events(fx.spark, folder, "earliest")
    return drain(fx, cdc.json_to_bronze(events, spec), "bronze_from_segments").drop("_seq")


@query("last_seen_dedup", f"SELECT * FROM {LATEST_ORDER}")
def _last_seen_dedup(fx):
    """Newest version per micro-batch in the sink, newest of all when read."""
    return drain(
        fx,
        _order_batches(fx),
        "last_seen",
        each=lambda batch: latest_by_key(batch, "order_id"),
        newest="order_id",
        version=["updated_at", "_seq"],
    )


@query("newest_by_state", f"SELECT * FROM {LATEST_ORDER}")
def _newest_by_state(fx):
    """Newest version per key kept in streaming state."""
    stream = dedup.newest_by_state(_order_batches(fx), "order_id")
    return drain(fx, stream, "newest_by_state", mode="update", newest="order_id")


@query(
    "drop_redeliveries",
    "SELECT DISTINCT order_id, user_id, order_status, total_amount, created_at, updated_at FROM t_order",
)
def _drop_redeliveries(fx):
    """Every event is delivered twice; one copy remains."""
    twice = _order_stream(fx).drop("_seq").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return drain(fx, dedup.drop_redeliveries(twice, ["order_id", "updated_at", "order_status"]), "redeliveries")


@query(
    "stream_abnormal_payment",
    """SELECT user_id, count(*) AS failed_count, time_bucket(INTERVAL 1 DAY, ts) AS window_start,
              time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end
       FROM events WHERE event_type = 'error' GROUP BY 1, 3, 4 HAVING count(*) >= 2""",
)
def _stream_abnormal_payment(fx):
    """Error events as failed payments, counted per user and day."""
    payments = table_stream(fx, "events").select(
        "user_id",
        F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
        F.col("ts").cast("timestamp").alias("payment_date"),
    )
    stream = alerts.abnormal_payment(payments, threshold=2, slot="1 day")
    return drain(fx, stream, "abnormal_payment", mode="update", newest=["user_id", "window_start"])


@query(
    "stream_abnormal_order",
    """SELECT user_id, window_start, window_start + INTERVAL 15 MINUTE AS window_end,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_order_value
       FROM (SELECT user_id, value, date_trunc('minute', ts) - to_minutes(CAST(unnest(range(0, 15)) AS INTEGER)) AS window_start
             FROM events WHERE event_type = 'purchase')
       GROUP BY 1, 2 HAVING sum(CAST(value AS DECIMAL(18,2))) > 40""",
)
def _stream_abnormal_order(fx):
    """Purchase events as orders: value per user over fifteen minutes, moved by one minute."""
    orders = (
        table_stream(fx, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            "user_id",
            F.col("ts").cast("timestamp").alias("created_at"),
            F.col("value").cast("decimal(18,2)").alias("order_value"),
        )
    )
    stream = alerts.abnormal_order(orders, threshold=40)
    return drain(fx, stream, "abnormal_order", mode="update", newest=["user_id", "window_start"])


@query(
    "stream_stuck_order",
    """SELECT order_id, created_at, date_trunc('hour', created_at) + INTERVAL 2 HOUR AS alert_time
       FROM t_order c
       WHERE _seq = 1
         AND created_at + INTERVAL 2 HOUR + INTERVAL 10 MINUTE < (
           SELECT least(max(created_at), max(updated_at) FILTER (order_status <> 'created')) FROM t_order)
         AND NOT EXISTS (SELECT 1 FROM t_order e WHERE e.order_id = c.order_id AND e.order_status <> 'created'
                         AND e.updated_at >= c.created_at
                         AND e.updated_at < date_trunc('hour', c.created_at) + INTERVAL 2 HOUR)""",
)
def _stream_stuck_order(fx):
    """Orders without an end event before their deadline, once the watermark has passed it."""
    created = _order_stream(fx).where(F.col("_seq") == 1)
    ended = _order_stream(fx).where(F.col("order_status").isin("completed", "cancelled"))
    return drain(fx, alerts.stuck_order(created, ended), "stuck_order")


@query("last_seen_state", f"SELECT * FROM {LATEST_ORDER}")
def _last_seen_state(fx):
    """Versions newer than the last one seen, whose state ends a week later; the sink shows the newest."""
    stream = stateful.last_seen(_in_time(fx, fx["order"]), "order_id")
    return drain(fx, stream, "last_seen_state", newest="order_id", version=["updated_at", "_seq"])


@query(
    "stream_stuck_order_timers",
    f"""SELECT order_id, created_at, date_trunc('hour', created_at) + INTERVAL 2 HOUR AS alert_time
        FROM {LATEST_ORDER}
        WHERE order_status = 'created'
          AND date_trunc('hour', created_at) + INTERVAL 2 HOUR <= (SELECT max(updated_at) - INTERVAL 10 MINUTE FROM t_order)""",
)
def _stuck_order_timers(fx):
    """Orders that are stuck when the watermark stands ten minutes before the last event."""
    stream = stateful.stuck_orders(_in_time(fx, fx["order"]))
    newest = drain(fx, stream, "stuck_timers", newest="order_id", version=["updated_at", "stuck"])
    return newest.where("stuck").select("order_id", "created_at", "alert_time")


@query(
    "stream_order_revenue",
    f"""SELECT CAST(o.updated_at AS DATE) AS sales_day, CAST(hour(o.created_at) AS INTEGER) AS hour,
               count(DISTINCT o.order_id) AS order_count, CAST(sum(i.quantity) AS BIGINT) AS items_sold,
               CAST(sum(i.price * i.quantity) AS DECIMAL(38,2)) AS revenue
        FROM {LATEST_ORDER} o JOIN {LATEST_ITEM} i ON o.order_id = i.order_id
        WHERE o.order_status = 'completed' GROUP BY 1, 2""",
)
def _stream_order_revenue(fx):
    """Sales of all days and hours, kept by deltas over micro-batches that mix early and late versions."""
    items = fx["item_line"].select("order_item_id", "order_id", "quantity", "price", "updated_at", "_seq")
    lines = _dealt(fx, items, ["order_item_id", "_seq"], "item_batches")
    return _mart(fx, stateful.revenue_deltas(_order_batches(fx), lines), "order_revenue", ["sales_day", "hour"])


@query(
    "stream_payment_failure_rate",
    f"""SELECT CAST(payment_date AS DATE) AS payment_day, count(*) FILTER (status = 'failed') AS failed, count(*) AS total,
               round_even(100.0::DOUBLE * count(*) FILTER (status = 'failed') / count(*), 2) AS failed_rate
        FROM {latest('t_payment', 'order_id')} GROUP BY 1""",
)
def _stream_payment_failure_rate(fx):
    """Failure rates of all days, kept by deltas while newer attempts replace failed ones."""
    stream = _dealt(fx, fx["payment"], ["payment_id"], "payment_batches")
    return stateful.failure_rates(_mart(fx, stateful.payment_deltas(stream), "payment_rate", ["payment_day"]))
