"""A transactional database sink: each micro-batch is in the table exactly once.

Tasks write to a staging table, each in one transaction and under a name of its own attempt. The
batch is committed by one more transaction: it notes the batch in a ledger, moves the rows of the
attempts that Spark accepted, and empties the staging of these. A task that fails or runs twice leaves
rows that no commit names; a batch that is repeated finds itself in the ledger and moves nothing.

Connections come from any DB-API module on the workers; nothing here is written for one database.
"""

from __future__ import annotations

import importlib
import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import closing, contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

FORMAT = "transactional_table"
CHUNK_ROWS = 1000
_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?")
_MARKS = {"qmark": "?", "format": "%s", "pyformat": "%s"}


@dataclass(frozen=True)
class Database:
    """A DB-API module and the keyword arguments of its `connect`."""

    module: str
    arguments: Mapping[str, object]

    @contextmanager
    def transaction(self) -> Iterator[Cursor]:
        """A cursor; what it did is committed at the end, or rolled back if that is not reached."""
        api = importlib.import_module(self.module)
        with closing(api.connect(**self.arguments)) as connection:
            try:
                yield Cursor(connection.cursor(), _MARKS[api.paramstyle])
            except BaseException:
                connection.rollback()
                raise
            connection.commit()


class Cursor:
    """Runs statements that mark their parameters by `?`, whatever marks the module has."""

    def __init__(self, cursor, mark: str):
        self.cursor, self.mark = cursor, mark

    def run(self, statement: str, *values: object) -> None:
        self.cursor.execute(statement.replace("?", self.mark), values)

    def run_many(self, statement: str, rows: Sequence[tuple]) -> None:
        self.cursor.executemany(statement.replace("?", self.mark), rows)

    def value(self) -> object:
        return self.cursor.fetchone()[0]


@dataclass(frozen=True)
class Target:
    """A table with its staging and ledger; `writer` names the stream that writes to it."""

    database: Database
    table: str
    writer: str

    def __post_init__(self):
        if not _NAME.fullmatch(self.table):
            raise ValueError(f"not a table name: {self.table}")

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    @property
    def ledger(self) -> str:
        return f"{self.table}_batches"

    def prepare(self) -> None:
        """Makes staging and ledger, and empties what earlier runs of the writer left staged.

        Called before a stream starts, when no task of the writer runs.
        """
        with self.database.transaction() as cursor:
            cursor.run(
                f"CREATE TABLE IF NOT EXISTS {self.staging} AS SELECT t.*, CAST('' AS VARCHAR(200)) AS _writer, "
                f"CAST('' AS VARCHAR(32)) AS _attempt FROM {self.table} t WHERE 1 = 0"
            )
            cursor.run(f"CREATE TABLE IF NOT EXISTS {self.ledger} (writer VARCHAR(200), batch_id BIGINT, PRIMARY KEY (writer, batch_id))")
            cursor.run(f"DELETE FROM {self.staging} WHERE _writer = ?", self.writer)


@dataclass
class Staged(WriterCommitMessage):
    attempt: str | None
    rows: int


class TransactionalWriter(DataSourceStreamWriter):
    def __init__(self, target: Target, columns: Sequence[str]):
        self.target = target
        self.columns = ", ".join('"' + c.replace('"', '""') + '"' for c in columns)
        self.marks = ", ".join("?" for _ in columns)

    def write(self, iterator: Iterator) -> Staged:
        attempt, count, chunk = uuid.uuid4().hex, 0, []
        insert = f"INSERT INTO {self.target.staging} ({self.columns}, _writer, _attempt) VALUES ({self.marks}, ?, ?)"
        first = next(iterator, None)
        if first is None:
            return Staged(None, 0)
        with self.target.database.transaction() as cursor:
            chunk.append((*first, self.target.writer, attempt))
            for row in iterator:
                if len(chunk) == CHUNK_ROWS:
                    cursor.run_many(insert, chunk)
                    count, chunk = count + len(chunk), []
                chunk.append((*row, self.target.writer, attempt))
            cursor.run_many(insert, chunk)
        return Staged(attempt, count + len(chunk))

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        """Moves the batch unless it is in the ledger; of two commits at once, the ledger's key lets one through."""
        t = self.target
        with t.database.transaction() as cursor:
            cursor.run(f"SELECT count(*) FROM {t.ledger} WHERE writer = ? AND batch_id = ?", t.writer, batchId)
            new = not cursor.value()
            if new:
                cursor.run(f"INSERT INTO {t.ledger} (writer, batch_id) VALUES (?, ?)", t.writer, batchId)
            for m in messages:
                if m is None or m.attempt is None:
                    continue
                if new:
                    cursor.run(f"SELECT count(*) FROM {t.staging} WHERE _attempt = ?", m.attempt)
                    if cursor.value() != m.rows:
                        raise RuntimeError(f"batch {batchId}: rows of an attempt are missing in {t.staging}")
                    cursor.run(f"INSERT INTO {t.table} ({self.columns}) SELECT {self.columns} FROM {t.staging} WHERE _attempt = ?", m.attempt)
                cursor.run(f"DELETE FROM {t.staging} WHERE _attempt = ?", m.attempt)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        with self.target.database.transaction() as cursor:
            for m in messages:
                if m is not None and m.attempt is not None:
                    cursor.run(f"DELETE FROM {self.target.staging} WHERE _attempt = ?", m.attempt)


class TransactionalTable(DataSource):
    """`writeStream.format("transactional_table")` with the options module, arguments (JSON), table and writer."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> TransactionalWriter:
        database = Database(self.options["module"], json.loads(self.options["arguments"]))
        return TransactionalWriter(Target(database, self.options["table"], self.options["writer"]), schema.names)


def write_transactional(stream: DataFrame, target: Target, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append a stream to a database table by column name, each micro-batch once.

    Batches are known by the target's `writer` and their number in the checkpoint, so a stream that
    starts on a new checkpoint needs a new writer name.
    """
    target.prepare()
    stream.sparkSession.dataSource.register(TransactionalTable)
    writer = (
        stream.writeStream.format(FORMAT)
        .option("module", target.database.module)
        .option("arguments", json.dumps(dict(target.database.arguments)))
        .option("table", target.table)
        .option("writer", target.writer)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
