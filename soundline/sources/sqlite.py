"""SQLite files: a sink that replaces a file, a scan in ranges of row ids, and a look at a file's metadata."""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DataType

INDEXES = (("edges", ("source",)), ("edges", ("target",)), ("nodes", ("lat", "lon")))


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _kind(t: DataType) -> str:
    name = t.typeName()
    return "INTEGER" if name in ("byte", "short", "integer", "long", "boolean") else "REAL" if name in ("float", "double") or name.startswith("decimal") else "BLOB" if name == "binary" else "TEXT"


def _plain(x):
    """Structs, arrays and maps go in as JSON text."""
    if x is None or isinstance(x, str | int | float | bytes):
        return x
    if isinstance(x, bytearray):
        return bytes(x)
    if isinstance(x, list | dict | tuple):
        return json.dumps(x.asDict(True) if hasattr(x, "asDict") else x, default=str)
    return float(x) if hasattr(x, "as_tuple") else str(x)


def write(tables: dict[str, DataFrame], path: str, keys: dict[str, str] | None = None, indexes=INDEXES, batch: int = 10_000) -> None:
    """Replace the driver's file path by one with these tables; indexes of absent tables are left out.

    One file has one writer: partitions come to the driver one at a time and go in batch by batch. Parquet is the sink
    for results that outgrow that. The new file takes the old one's place only when it is whole.
    """
    part = f"{path}.part"
    if os.path.exists(part):
        os.remove(part)
    with closing(sqlite3.connect(part)) as con:
        for name, df in tables.items():
            columns = [f"{_quoted(f.name)} {_kind(f.dataType)}" + " PRIMARY KEY" * ((keys or {}).get(name) == f.name) for f in df.schema]
            con.execute(f"CREATE TABLE {_quoted(name)} ({', '.join(columns)})")
            insert, rows = f"INSERT INTO {_quoted(name)} VALUES ({', '.join('?' * len(columns))})", []
            for row in df.toLocalIterator():
                rows.append(tuple(map(_plain, row)))
                if len(rows) == batch:
                    con.executemany(insert, rows)
                    rows = []
            con.executemany(insert, rows)
        for name, columns in indexes:
            if name in tables and set(columns) <= set(tables[name].columns):
                con.execute(f"CREATE INDEX {_quoted('_'.join(('idx', name, *columns)))} ON {_quoted(name)} ({', '.join(map(_quoted, columns))})")
        con.commit()
        con.execute("VACUUM")
    os.replace(part, path)


def metadata(path: str) -> dict | None:
    """The first row of the table metadata; None where the file, the table or the row is missing or can't be read."""
    if not os.path.isfile(path):
        return None
    try:
        with closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as con:
            con.row_factory = sqlite3.Row
            row = con.execute("SELECT * FROM metadata LIMIT 1").fetchone()
            return dict(row) if row else None
    except sqlite3.Error:
        return None


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.columns, self.path, self.table, self.parts = schema.names, options["path"], options["table"], int(options.get("partitions", 8))

    def partitions(self) -> list[InputPartition]:
        with closing(sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)) as con:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        if low is None:
            return []
        step = -(-(high - low + 1) // self.parts)
        return [_Range(x, min(x + step, high + 1)) for x in range(low, high + 1, step)]

    def read(self, partition: _Range | None) -> Iterator[tuple]:
        if partition is None:  # an empty table
            return
        with closing(sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)) as con:
            yield from con.execute(f"SELECT {', '.join(map(_quoted, self.columns))} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))


class SqliteSource(DataSource):
    """format("sqlite"): options path, table, partitions; the schema names the columns to read."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(schema, self.options)


def read(spark: SparkSession, path: str, table: str, schema: str, partitions: int = 8) -> DataFrame:
    """The columns in schema of one table, in ranges of row ids. Every executor has to see path."""
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").schema(schema).options(table=table, partitions=partitions).load(path)
