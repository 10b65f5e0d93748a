"""Tables of SQLite files as a Spark data source: ``spark.read.format("sqlite")``.

Options: ``path`` of the file and ``table``; ``columns`` (all of them if
unset) and ``partitions`` (8). The file must be where executors find it: in a
shared folder, or sent to them by ``addFile``, with its name as ``path``.

Partitions are ranges of rowids, each read through a connection of its own,
read-only; a table without rowids is one. Comparisons of integers, floats and
texts are pushed down, which needs ``spark.sql.python.filterPushdown.enabled``.
A value that isn't of its column's declared type is null; so Spark checks the
comparisons again, but for strict tables, which have no such values. Columns
of other types are strings.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterable, Iterator
from contextlib import closing
from dataclasses import dataclass

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import BinaryType, DataType, DoubleType, LongType, StringType, StructField, StructType

ROWS = 4096
SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
PYTHON = {LongType(): int, DoubleType(): float, StringType(): str, BinaryType(): bytes}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def connected(path: str) -> sqlite3.Connection:
    """Read-only, so that a wrong path makes no file."""
    found = path if os.path.exists(path) else SparkFiles.get(path)
    return sqlite3.connect(f"file:{found.replace('%', '%25').replace('?', '%3f').replace('#', '%23')}?mode=ro", uri=True)


def spark_type(declared: str) -> tuple[DataType, bool]:
    """Of a declared type, after the affinities of SQLite; whether its values are all kept as such."""
    kind = declared.upper()
    if "INT" in kind:
        return LongType(), True
    if any(x in kind for x in ("CHAR", "CLOB", "TEXT")):
        return StringType(), True
    if "BLOB" in kind:
        return BinaryType(), True
    if any(x in kind for x in ("REAL", "FLOA", "DOUB")):
        return DoubleType(), True
    return StringType(), False


@dataclass
class Rowids(InputPartition):
    #: Both included; None for all rows of a table without rowids.
    first: int | None
    last: int | None


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, kept: dict[str, bool], strict: bool, partitions: int) -> None:
        self.path, self.table, self.schema, self.kept, self.strict, self.n = path, table, schema, kept, strict, partitions
        self.where: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            known = type(f) in SIGNS or isinstance(f, In | IsNotNull)
            if known and column in self.kept and self.kept[column]:
                if type(f) in SIGNS:
                    self.where.append(f"{quoted(column)} {SIGNS[type(f)]} ? COLLATE BINARY")
                    self.values.append(f.value)
                elif isinstance(f, In):
                    self.where.append(f"{quoted(column)} COLLATE BINARY IN ({', '.join('?' * len(f.value))})")
                    self.values += f.value
                else:
                    self.where.append(f"{quoted(column)} IS NOT NULL")
                if self.strict:
                    continue
            yield f

    def partitions(self) -> list[Rowids]:
        with closing(connected(self.path)) as c:
            try:
                low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:
                return [Rowids(None, None)]
        if low is None:
            return [Rowids(0, -1)]  # Spark wants one at least
        step = max(1, -(-(high - low + 1) // self.n))
        return [Rowids(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition: Rowids) -> Iterator[pa.RecordBatch]:
        where, values = list(self.where), list(self.values)
        if partition.first is not None:
            where.insert(0, "rowid BETWEEN ? AND ?")
            values = [partition.first, partition.last, *values]
        names = [f.name for f in self.schema.fields]
        asked = f"SELECT {', '.join(map(quoted, names))} FROM {quoted(self.table)}" + (f" WHERE {' AND '.join(where)}" if where else "")
        made = {LongType(): pa.int64(), DoubleType(): pa.float64(), StringType(): pa.string(), BinaryType(): pa.binary()}

        def typed(values: tuple, field: StructField) -> pa.Array:
            kind = PYTHON[field.dataType]
            if not self.kept[field.name]:
                values = [v if v is None or isinstance(v, str) else v.hex() if isinstance(v, bytes) else str(v) for v in values]
            return pa.array([v if isinstance(v, kind) else None for v in values], made[field.dataType])

        with closing(connected(self.path)) as c:
            rows = c.execute(asked, values)
            while some := rows.fetchmany(ROWS):
                yield pa.RecordBatch.from_arrays([typed(v, f) for v, f in zip(zip(*some, strict=True), self.schema.fields, strict=True)], names)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _columns(self) -> dict[str, tuple[DataType, bool]]:
        with closing(connected(self.options["path"])) as c:
            found = {name: spark_type(declared) for _, name, declared, *_ in c.execute(f"PRAGMA table_info({quoted(self.options['table'])})")}
        if not found:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        only = [x.strip() for x in self.options.get("columns", "").split(",") if x.strip()] or list(found)
        if missing := [x for x in only if x not in found]:
            raise ValueError(f"no column {', '.join(missing)} in {self.options['table']}, which has {', '.join(found)}")
        return {name: found[name] for name in only}

    def schema(self) -> StructType:
        return StructType([StructField(name, kind) for name, (kind, _) in self._columns().items()])

    def reader(self, schema: StructType) -> SqliteReader:
        kept = {name: kept for name, (_, kept) in self._columns().items()}
        with closing(connected(self.options["path"])) as c:
            strict = any(row[-1] for row in c.execute("SELECT * FROM pragma_table_list(?)", [self.options["table"]]))
        return SqliteReader(self.options["path"], self.options["table"], schema, kept, strict, int(self.options.get("partitions", 8)))


def register(spark: SparkSession) -> None:
    """From now on ``format("sqlite")`` is known, and filters are pushed."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    spark.dataSource.register(SqliteSource)
