"""Keyed state with timers: last seen versions, orders that get stuck, marts kept by deltas.

Each function takes a change stream and deals its keys to blocks; Spark keeps the state of a block in
its store and checkpoints it with the offsets, so a query that starts again on its checkpoint goes
on with both. A block holds its keys as one Arrow table, so a micro-batch calls Python once per block
and not once per key, and changes all keys of it by column. It rewrites the tables of the blocks
it meets: `blocks` is fixed with the checkpoint, and more of them make smaller tables and more calls.
Times are held as microseconds, versions compare as `latest_by_key` orders them: by update time,
ingest position, then the other columns.

* `last_seen` passes a version on if it is newer than what its key has shown, and forgets the key
  after a lifetime.
* `stuck_orders` waits for the deadline of each open order and reports it when the watermark passes.
* `revenue_deltas` and `payment_deltas` send what a change takes from a mart and adds to it; the
  mart is the sum of what was sent, and reading it ranks no log.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from commerce_lake.functions.numbers import SUM_DECIMAL, line_value, percentage
from commerce_lake.plans.live import STUCK_HOURS
from commerce_lake.schemas import SEQ

BLOCKS = 1024
PACK_ROWS = 1 << 17  # rows of a task that are dealt to blocks together

_AT = "_at"
_BLOCK = "_block"
_HOUR = 3_600_000_000
_NEVER = np.iinfo(np.int64).max
_PACKED = Row("rows")


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name))


# --- blocks of keys -------------------------------------------------------------


def _bytes(table: pa.Table) -> bytes:
    return table.combine_chunks().to_batches()[0].serialize().to_pybytes()


def _read(packed: Iterable, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(p), schema) for p in packed], schema)


def _block_of(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias(_BLOCK)


def _packed(rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """_block, rows: the rows of a task dealt to the blocks, those of a block as one Arrow batch."""
    schema = to_arrow_schema(rows.schema)

    def deal(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        block = table.column(_BLOCK).to_numpy()
        order = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.diff(block[order], prepend=-1))
        batch = pa.Table.from_arrays(table.take(order).columns[:-1], schema=schema).combine_chunks().to_batches()[0]
        parts = [batch.slice(a, b - a).serialize().to_pybytes() for a, b in zip(first, [*first[1:], len(order)])]
        return pa.RecordBatch.from_arrays([pa.array(block[order][first], pa.int32()), pa.array(parts, pa.binary())], [_BLOCK, "rows"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.num_rows
            if size >= PACK_ROWS:
                yield deal(held)
                held, size = [], 0
        if size:
            yield deal(held)

    return rows.select("*", _block_of(key, blocks)).mapInArrow(pack, f"{_BLOCK} int, rows binary")


def _unpacked(packed: DataFrame, schema: StructType) -> DataFrame:
    arrow = to_arrow_schema(schema)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0):
                yield pa.ipc.read_record_batch(rows.as_buffer(), arrow)

    return packed.mapInArrow(unpack, schema)


class _Blocks(StatefulProcessor):
    """State of a block: a table with a row per key, and the timer that stands for the first of its keys' times.

    `change` gives the new table and the rows that go out, `expire` the same for the keys whose time
    has come, `due` the time each key waits for. Rows come packed, or where the watermark has to judge
    each of them one by one, with the columns of `given` first.
    """

    def __init__(self, given: pa.Schema, kept: pa.Schema, packed: bool):
        self.given, self.kept, self.packed = given, kept, packed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.block = handle.getValueState("block", "rows binary, timer long")

    def change(self, held: pa.Table, given: pa.Table) -> tuple[pa.Table, pa.Table]:
        raise NotImplementedError

    def expire(self, held: pa.Table, before: int) -> tuple[pa.Table, pa.Table]:
        return held, held.slice(0, 0)

    def due(self, held: pa.Table) -> np.ndarray:
        return np.full(0, _NEVER)

    def _held(self) -> tuple[pa.Table, int | None]:
        rows, timer = self.block.get() if self.block.exists() else (None, None)
        return _read([] if rows is None else [rows], self.kept), timer

    def _keep(self, table: pa.Table, timer: int | None) -> None:
        first = int(self.due(table).min(initial=_NEVER))
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first != _NEVER and timer != first:
            self.handle.registerTimer(first)
        if table.num_rows:
            self.block.update((_bytes(table.select(self.kept.names).cast(self.kept)), first if first != _NEVER else None))
        else:
            self.block.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.packed:
            given = _read([r.rows for r in rows], self.given)
        else:
            columns = list(zip(*rows))
            given = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.given)], schema=self.given)
        held, timer = self._held()
        table, out = self.change(held, given)
        self._keep(table, timer)
        if out.num_rows:
            yield _PACKED(_bytes(out))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
        table, out = self.expire(self._held()[0], before)
        self._keep(table, None)  # the timer that fired is gone
        if out.num_rows:
            yield _PACKED(_bytes(out))

    def close(self) -> None:
        pass


def _through(rows: DataFrame, key: str, processor: _Blocks, out: StructType, time: str, blocks: int) -> DataFrame:
    """`rows` through a processor of blocks; with event time the rows have a block already."""
    rows = _packed(rows, key, blocks) if processor.packed else rows
    return _unpacked(rows.groupBy(_BLOCK).transformWithState(processor, "rows binary", "Append", time), out)


class _Merged:
    """Rows held and rows given of a block, by key: number of the key, and of its held row (-1: none)."""

    def __init__(self, held: pa.Table, given: pa.Table, key: str):
        self.table = pa.concat_tables([held, given], promote_options="default").combine_chunks()
        codes = pa.chunked_array(self.table.column(key)).combine_chunks().dictionary_encode(null_encoding="encode")
        self.group, self.keys = codes.indices.to_numpy(), len(codes.dictionary)
        self.is_held = np.arange(self.table.num_rows) < held.num_rows
        self.before = np.full(self.keys, -1)
        self.before[self.group[self.is_held]] = np.flatnonzero(self.is_held)

    def newest(self, order: Sequence[str], among: np.ndarray | None = None) -> np.ndarray:
        """Row of each key's newest version, of equal ones that held; -1 where none is among the rows."""
        rows = np.arange(self.table.num_rows) if among is None else np.flatnonzero(among)
        out = np.full(self.keys, -1)
        if len(rows):
            ranked = self.table.select(order).take(rows)
            ranked = ranked.append_column("_held", pa.array(self.is_held[rows].astype(np.int8))).add_column(0, "_group", pa.array(self.group[rows]))
            by = [(name, "ascending") for name in ranked.column_names]
            rows = rows[pc.sort_indices(ranked, sort_keys=by, null_placement="at_start").to_numpy()]
            out[self.group[rows]] = rows  # of several the last stays
        return out

    def take(self, rows: np.ndarray) -> pa.Table:
        """Rows by number, of nulls where it is -1."""
        return self.table.take(pa.array(rows, mask=rows < 0))


def _is(column, value) -> np.ndarray:
    return pc.fill_null(pc.equal(column, value), False).to_numpy()


def _same(a, b) -> np.ndarray:
    """Null-safe equality."""
    return _is(a, b) | (a.is_null().to_numpy() & b.is_null().to_numpy())


def _numbers(column, missing: int = 0) -> np.ndarray:
    return pc.fill_null(column, missing).to_numpy()


def _put(table: pa.Table, name: str, column) -> pa.Table:
    return table.set_column(table.column_names.index(name), name, column)


# --- last seen ------------------------------------------------------------------


class _LastSeen(_Blocks):
    """The newest row of each key, until the watermark is past it by the lifetime."""

    def __init__(self, schema: pa.Schema, key: str, lifetime_ms: int):
        super().__init__(schema, schema, packed=False)
        self.key, self.lifetime_ms = key, lifetime_ms

    def change(self, held: pa.Table, given: pa.Table) -> tuple[pa.Table, pa.Table]:
        both = _Merged(held, given, self.key)
        newest = both.newest([n for n in self.kept.names if n != self.key])
        return both.take(newest), both.take(newest[~both.is_held[newest]])

    def due(self, held: pa.Table) -> np.ndarray:
        at = held.column(_AT)
        return np.where(at.is_null().to_numpy(), _NEVER, _numbers(at) // 1000 + self.lifetime_ms)

    def expire(self, held: pa.Table, before: int) -> tuple[pa.Table, pa.Table]:
        return held.filter(self.due(held) >= before), held.slice(0, 0)


def last_seen(
    stream: DataFrame, key: str, lifetime: str = "7 days", delay: str = "10 minutes", version: str = "updated_at", blocks: int = BLOCKS
) -> DataFrame:
    """Rows newer than the newest version their key has shown; older and repeated ones are dropped.

    Of several versions in one micro-batch the newest passes. State of a key ends when the
    watermark passes its newest version by `lifetime`, so it grows with the keys of a lifetime,
    not with all keys. A row that comes after that counts as the first of its key and passes,
    whatever its version; a sink read by `read_newest` still shows the newest. Rows more than
    `delay` behind the newest event are late and dropped.
    """
    times = [c for c, t in stream.dtypes if t == "timestamp" and c != version]
    rest = [c for c in stream.columns if c not in (key, version, SEQ)]
    compared = [_AT, *([SEQ] if SEQ in stream.columns else []), *rest]
    # times travel as microseconds, so that no time zone of a worker touches them
    plain = stream.withWatermark(version, delay).withColumns({_AT: _micros(version), **{c: _micros(c) for c in times}})
    kept = plain.select(*compared, key).schema
    processor = _LastSeen(to_arrow_schema(kept), key, _milliseconds(stream, lifetime))
    out = _through(plain.select(*compared, key, _block_of(key, blocks), version), key, processor, kept, "EventTime", blocks)
    return out.withColumns({version: F.timestamp_micros(_AT), **{c: F.timestamp_micros(c) for c in times}}).select(*stream.columns)


def _milliseconds(stream: DataFrame, interval: str) -> int:
    epoch = f"TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {interval}"
    return stream.sparkSession.sql(f"SELECT unix_millis({epoch})").first()[0]


# --- stuck orders ---------------------------------------------------------------

_ORDER = ["at", "seq", "status", "created"]
_ORDER_STATE = "at long, seq long, status string, created long, order_id long, armed long, told boolean"
STUCK_SCHEMA = "order_id long, at long, created long, deadline long, stuck boolean"


class _Stuck(_Blocks):
    """The newest version of each order, the time it waits for (ms), and whether it was reported."""

    def __init__(self, given: pa.Schema, hours: int, lifetime_ms: int):
        super().__init__(given, _arrow(_ORDER_STATE), packed=False)
        self.hours, self.lifetime_ms, self.out = hours, lifetime_ms, _arrow(STUCK_SCHEMA)

    def _deadline(self, created) -> np.ndarray:
        return _numbers(created) // _HOUR * _HOUR + (self.hours + 1) * _HOUR

    def _reports(self, order_id, at, created, stuck: bool) -> pa.Table:
        deadline = pa.array(self._deadline(created))
        return pa.Table.from_arrays([order_id, at, created, deadline, pa.array(np.full(len(at), stuck))], schema=self.out)

    def change(self, held: pa.Table, given: pa.Table) -> tuple[pa.Table, pa.Table]:
        both = _Merged(held, given, "order_id")
        newest = both.newest(_ORDER)
        changed = ~both.is_held[newest]
        new, old = both.take(newest[changed]), both.take(both.before[changed])
        told, open_ = _is(old["told"], True), _is(new["status"], "created")
        same = told & open_ & _is(new["created"], old["created"])
        # a timer fires when the watermark is past it: one millisecond earlier, it does so at the deadline itself
        wait = np.where(open_, self._deadline(new["created"]) // 1000 - 1, _numbers(new["at"]) // 1000 + self.lifetime_ms)
        new = _put(_put(new, "armed", pa.array(wait, mask=same | (open_ & new["created"].is_null().to_numpy()))), "told", pa.array(same))
        back = pa.array(np.flatnonzero(told & ~same))
        gone, was = new.take(back), old.take(back)
        return pa.concat_tables([both.take(newest[~changed]), new]), self._reports(gone["order_id"], gone["at"], was["created"], False)

    def due(self, held: pa.Table) -> np.ndarray:
        return _numbers(held["armed"], _NEVER)

    def expire(self, held: pa.Table, before: int) -> tuple[pa.Table, pa.Table]:
        fired, open_ = self.due(held) < before, _is(held["status"], "created")
        alert = held.filter(fired & open_)
        out = self._reports(alert["order_id"], alert["at"], alert["created"], True)
        kept = _put(held, "armed", pa.array(_numbers(held["armed"]), mask=held["armed"].is_null().to_numpy() | fired))
        kept = _put(kept, "told", pa.array(_is(held["told"], True) | fired))
        return kept.filter(~fired | open_), out


def stuck_orders(
    orders: DataFrame, hours: int = STUCK_HOURS, delay: str = "10 minutes", lifetime: str = "7 days", blocks: int = BLOCKS
) -> DataFrame:
    """order_id, created_at, alert_time, stuck: an order gets stuck, or is no longer.

    The newest version of an order decides. While it is 'created' it waits for the first
    instant with more than `hours` full-hour marks behind the creation, and is reported
    when the watermark reaches it. A change of status ends the wait, or reports a stuck
    order as no longer so; a change back arms it again. The rows of `newest_stuck` are those of the
    live view at the watermark. State of an ended order goes `lifetime` after its end.
    """
    seq = F.col(SEQ) if SEQ in orders.columns else F.lit(0).cast("long")
    timed = orders.withWatermark("updated_at", delay)
    names = [_micros("updated_at").alias("at"), seq.alias("seq"), F.col("order_status").alias("status"), _micros("created_at").alias("created"), "order_id"]
    plain = timed.select(*names, _block_of("order_id", blocks), "updated_at")
    given = to_arrow_schema(plain.drop(_BLOCK, "updated_at").schema)
    processor = _Stuck(given, hours, _milliseconds(orders, lifetime))
    found = _through(plain, "order_id", processor, StructType.fromDDL(STUCK_SCHEMA), "EventTime", blocks)
    return found.select(
        "order_id",
        F.timestamp_micros("created").alias("created_at"),
        F.timestamp_micros("deadline").alias("alert_time"),
        "stuck",
        F.timestamp_micros("at").alias("updated_at"),
    )


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


# --- marts kept by deltas -------------------------------------------------------

_LINES = f"order_id long, items long, sold long, value {SUM_DECIMAL}"
_SALES = f"sales_day date, hour int, order_count long, items_sold long, revenue {SUM_DECIMAL}"
_PAID = "payment_day date, failed long, total long"
_ITEM_STATE = f"at long, seq long, order_id long, quantity int, price decimal(18,2), order_item_id long, sold long, value {SUM_DECIMAL}"
_ITEM_ORDER = ["at", "seq", "order_id", "quantity", "price"]
_SALE_STATE = f"at long, seq long, status string, created long, day date, hour int, items long, sold long, value {SUM_DECIMAL}, order_id long, known boolean"
_PAID_STATE = "at long, seq long, status string, paid long, day date, order_id long"


class _ItemDeltas(_Blocks):
    """Per order item: what its newest version takes from one order and gives to another."""

    def __init__(self):
        super().__init__(_arrow(_ITEM_STATE), _arrow(_ITEM_STATE), packed=True)
        self.out = _arrow(_LINES)

    def change(self, held: pa.Table, given: pa.Table) -> tuple[pa.Table, pa.Table]:
        both = _Merged(held, given, "order_item_id")
        newest = both.newest(_ITEM_ORDER)
        changed = ~both.is_held[newest]
        before = both.before[changed]
        lines = [self._lines(both.take(before[before >= 0]), -1), self._lines(both.take(newest[changed]), 1)]
        sums = pa.concat_tables(lines).group_by("order_id").aggregate([(n, "sum") for n in ("items", "sold", "value")])
        return both.take(newest), sums.select(["order_id", "items_sum", "sold_sum", "value_sum"]).rename_columns(self.out.names).cast(self.out)

    def _lines(self, rows: pa.Table, sign: int) -> pa.Table:
        sold, value = (rows[n] if sign > 0 else pc.negate(rows[n]) for n in ("sold", "value"))
        return pa.Table.from_arrays([rows["order_id"], pa.array(np.full(rows.num_rows, sign)), sold, value], schema=self.out)


class _RevenueDeltas(_Blocks):
    """Per order: its newest version (none: not `known`) and the sums of its items, which tell what it has given to the mart."""

    def __init__(self, given: pa.Schema):
        super().__init__(given, _arrow(_SALE_STATE), packed=True)
        self.out = _arrow(_SALES)

    def change(self, held: pa.Table, given: pa.Table) -> tuple[pa.Table, pa.Table]:
        both = _Merged(held, given.append_column("known", pc.is_null(given["items"])), "order_id")
        known = _is(both.table["known"], True)
        newest = both.newest(_ORDER, among=known)
        sums = pa.table({"group": both.group, **{n: both.table[n] for n in ("items", "sold", "value")}})
        sums = sums.group_by("group").aggregate([(n, "sum") for n in ("items", "sold", "value")]).sort_by("group")
        now, was = both.take(newest), both.take(both.before)
        for name in ("items", "sold", "value"):
            type_ = self.kept.field(name).type
            now = _put(now, name, pc.fill_null(sums[f"{name}_sum"].cast(type_), pa.scalar(0).cast(type_)))
        # a key without a version has its number from any of its rows
        one = np.empty(both.keys, np.int64)
        one[both.group] = np.arange(len(both.group))
        now = _put(_put(now, "order_id", both.table["order_id"].take(pa.array(one))), "known", pa.array(newest >= 0))
        gives, gave = self._counts(now), self._counts(was)
        same = gives & gave
        for name in ("day", "hour", "sold", "value"):
            same &= _same(now[name], was[name])
        return now, pa.concat_tables([self._sales(was.filter(gave & ~same), -1), self._sales(now.filter(gives & ~same), 1)])

    @staticmethod
    def _counts(orders: pa.Table) -> np.ndarray:
        return _is(orders["status"], "completed") & (_numbers(orders["items"]) != 0)

    def _sales(self, rows: pa.Table, sign: int) -> pa.Table:
        sold, value = (rows[n] if sign > 0 else pc.negate(rows[n]) for n in ("sold", "value"))
        return pa.Table.from_arrays([rows["day"], rows["hour"], pa.array(np.full(rows.num_rows, sign)), sold, value], schema=self.out)


def revenue_deltas(orders: DataFrame, items: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """sales_day, hour, order_count, items_sold, revenue: changes to the sales of completed orders.

    The day is the date of the order's last update, the hour that of its creation. Items are
    kept first, by their own key, since a newer version may belong to another order.
    Run in append mode; late and repeated versions change nothing they should not.
    """
    value = line_value(F.col("price"), F.col("quantity")).cast(SUM_DECIMAL)
    lines = items.select(
        _micros("updated_at").alias("at"), F.col(SEQ).alias("seq"), "order_id", "quantity", "price", "order_item_id",
        F.coalesce(F.col("quantity").cast("long"), F.lit(0)).alias("sold"), F.coalesce(value, F.lit(0).cast(SUM_DECIMAL)).alias("value"),
    )
    lines = lines.to(StructType.fromDDL(_ITEM_STATE))
    kept = _through(lines, "order_item_id", _ItemDeltas(), StructType.fromDDL(_LINES), "None", blocks)
    no = lambda kind, name: F.lit(None).cast(kind).alias(name)
    versions = orders.select(
        _micros("updated_at").alias("at"), F.col(SEQ).alias("seq"), F.col("order_status").alias("status"), _micros("created_at").alias("created"),
        F.to_date("updated_at").alias("day"), F.hour("created_at").alias("hour"),
        no("long", "items"), no("long", "sold"), no(SUM_DECIMAL, "value"), "order_id",
    )
    sums = kept.select(
        no("long", "at"), no("long", "seq"), no("string", "status"), no("long", "created"), no("date", "day"), no("int", "hour"),
        "items", "sold", "value", "order_id",
    )
    both = versions.union(sums)
    return _through(both, "order_id", _RevenueDeltas(to_arrow_schema(both.schema)), StructType.fromDDL(_SALES), "None", blocks)


class _PaymentDeltas(_Blocks):
    """Per order: the newest version of its payments, which counts on its date."""

    def __init__(self):
        super().__init__(_arrow(_PAID_STATE), _arrow(_PAID_STATE), packed=True)
        self.out = _arrow(_PAID)

    def change(self, held: pa.Table, given: pa.Table) -> tuple[pa.Table, pa.Table]:
        both = _Merged(held, given, "order_id")
        newest = both.newest(["at", "seq", "status", "paid"])
        changed = ~both.is_held[newest]
        before = both.before[changed]
        return both.take(newest), pa.concat_tables([self._counts(both.take(before[before >= 0]), -1), self._counts(both.take(newest[changed]), 1)])

    def _counts(self, rows: pa.Table, sign: int) -> pa.Table:
        failed = sign * _is(rows["status"], "failed").astype(np.int64)
        return pa.Table.from_arrays([rows["day"], pa.array(failed), pa.array(np.full(rows.num_rows, sign))], schema=self.out)


def payment_deltas(payments: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """payment_day, failed, total: changes to the counts of payments, of which each order's newest counts on its date."""
    versions = payments.select(
        _micros("updated_at").alias("at"), F.col(SEQ).alias("seq"), "status", _micros("payment_date").alias("paid"), F.to_date("payment_date").alias("day"), "order_id"
    )
    return _through(versions.to(StructType.fromDDL(_PAID_STATE)), "order_id", _PaymentDeltas(), StructType.fromDDL(_PAID), "None", blocks)


def summed(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deltas, of a micro-batch or of a whole table, as one row per group; groups that cancel out are left out."""
    sums = [F.sum(c).cast(t).alias(c) for c, t in deltas.dtypes if c not in keys]
    rows = deltas.groupBy(*keys).agg(*sums)
    return rows.where(" OR ".join(f"{c} <> 0" for c in deltas.columns if c not in keys))


def failure_rates(mart: DataFrame) -> DataFrame:
    """Failed, total and failed_rate per day, from summed payment deltas."""
    return mart.withColumn("failed_rate", percentage(F.col("failed"), F.col("total")))
