"""SQLite table source (Python Data Source API).

Reads ``SELECT * FROM <table>`` split into rowid ranges, one input
partition per range, every value as text (None stays NULL).  Real
databases go through ``format("jdbc")``; SQLite files are local by
nature, so each task opens the file itself.
"""

from __future__ import annotations

import sqlite3

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

ROWS_PER_PARTITION = 1_000_000


def _quote(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


class _RowidRange(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo = lo
        self.hi = hi


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, columns: list[str]):
        self.path = path
        self.table = table
        self.columns = columns

    def partitions(self):
        with sqlite3.connect(self.path) as con:
            lo, hi = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quote(self.table)}").fetchone()
        if lo is None:
            return [_RowidRange(0, -1)]
        return [_RowidRange(start, min(start + ROWS_PER_PARTITION - 1, hi))
                for start in range(lo, hi + 1, ROWS_PER_PARTITION)]

    def read(self, partition: _RowidRange):
        if partition.hi < partition.lo:
            return
        con = sqlite3.connect(self.path)
        try:
            table = _quote(self.table)
            (before,) = con.execute(f"SELECT count(*) FROM {table} WHERE rowid < ?", (partition.lo,)).fetchone()
            select = ", ".join(_quote(c) for c in self.columns)
            cursor = con.execute(
                f"SELECT {select} FROM {table} WHERE rowid BETWEEN ? AND ? ORDER BY rowid",
                (partition.lo, partition.hi),
            )
            for offset, row in enumerate(cursor):
                yield tuple(None if v is None else str(v) for v in row) + (before + offset + 2,)
        finally:
            con.close()


class SqliteDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def _columns(self) -> list[str]:
        with sqlite3.connect(self.options["path"]) as con:
            info = con.execute(f"PRAGMA table_info({_quote(self.options.get('table', 'telemetry'))})").fetchall()
        if not info:
            raise ValueError(f"no such table: {self.options.get('table', 'telemetry')}")
        return [row[1] for row in info]

    def schema(self):
        return StructType([StructField(c, StringType(), True) for c in self._columns()]
                          + [StructField("row_number", LongType(), False)])

    def reader(self, schema):
        return SqliteReader(self.options["path"], self.options.get("table", "telemetry"), self._columns())


def register_sqlite_source(spark) -> None:
    spark.dataSource.register(SqliteDataSource)
