"""Tables of a database: reads in parts by ranges of a key, with filters and columns pushed to the database.

A database server is read and written through JDBC. SQLite has no server: its file is written by one task into a folder that
all executors share, and read there by each of them.
"""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterable, Iterator
from contextlib import closing
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Types whose values SQLite holds as they are, NaN excepted.
KINDS = {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "boolean": "INTEGER", "float": "REAL", "double": "REAL", "string": "TEXT", "binary": "BLOB"}
#: SQLite takes 32,766 values a statement, if not built for more; filters beyond this many are left to Spark.
MOST_VALUES = 30_000
COMPARED = {EqualTo: "=", EqualNullSafe: "IS", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def write_table(df: DataFrame, url: str, name: str, mode: str = "overwrite") -> None:
    """Write a table by batches of inserts. On a cluster the URL names a server: an embedded database is another one in each
    executor."""
    df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", name).option("batchsize", 5000).save()


def read_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int, fetch: int = 5000) -> DataFrame:
    """A table in ``parts`` ranges of an integer ``key`` between ``low`` and ``high``; rows outside and NULL keys go to the outer
    parts. What is filtered and selected afterwards is asked of the database. On a cluster the URL names a server, as for
    ``write_table``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).option("fetchsize", fetch)
    return reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts).option("pushDownPredicate", "true").load()


def _local(path: str) -> str:
    path = path.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"SQLite reads files of a mounted folder, not {path}")
    return path


def _quoted(name: str) -> str:
    """A name in backticks: SQLite takes an unknown name in double quotes for a text."""
    return "`" + name.replace("`", "``") + "`"


def _uri(path: str, options: str) -> str:
    return f"file:{quote(os.path.abspath(path))}?{options}"


def _insert(path: str, name: str, columns: list[tuple[str, str]], key: str, batches: Iterable) -> int:
    """Write a file with one table and an index on its key, whole or not at all, and return the number of rows."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    part, n = f"{path}.{uuid.uuid4().hex}", 0
    try:
        with closing(sqlite3.connect(_uri(part, "mode=rwc&nolock=1"), uri=True)) as db:
            db.execute("PRAGMA journal_mode = OFF")
            db.execute("PRAGMA synchronous = OFF")
            db.execute(f"CREATE TABLE {_quoted(name)} ({', '.join(f'{_quoted(c)} {KINDS[t]}' for c, t in columns)})")
            for batch in batches:
                values = [c.to_pylist() for c in batch.columns]
                for (c, t), v in zip(columns, values, strict=True):
                    if t in ("float", "double") and any(x != x for x in v):
                        raise ValueError(f"{c} has NaN, which SQLite would keep as NULL")
                db.executemany(f"INSERT INTO {_quoted(name)} VALUES ({', '.join('?' * len(columns))})", zip(*values, strict=True))
                n += batch.num_rows
            db.execute(f"CREATE INDEX {_quoted(f'{name}_{key}')} ON {_quoted(name)} ({_quoted(key)})")
            db.commit()
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.remove(part)
    return n


def write_sqlite(df: DataFrame, path: str, name: str, key: str) -> None:
    """Write a SQLite file with one table, in the order of its ``key``, which gets an index. SQLite has one writer, so one task
    writes, a batch at a time, into a file beside it that takes the place of ``path`` when it is whole."""
    path, columns = _local(path), df.dtypes
    if wrong := [f"{c} {t}" for c, t in columns if t not in KINDS]:
        raise ValueError(f"SQLite has no type for {', '.join(wrong)}")

    def insert(batches: Iterator) -> Iterator:
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"n": [_insert(path, name, columns, key, batches)]})

    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])  # Spark maps no names with dots or backticks
    if not plain.repartition(1).sortWithinPartitions(f"c{df.columns.index(key)}").mapInArrow(insert, "n bigint").collect():
        _insert(path, name, columns, key, [])  # the planner leaves no task for a table that it knows to be empty


def read_sqlite(spark: SparkSession, path: str, name: str, schema: str, key: str, parts: int) -> DataFrame:
    """The columns of ``schema`` of a table in a SQLite file that driver and executors see, in up to ``parts`` even ranges between
    the least and the greatest integer ``key``; NULL keys go to the first. What is filtered afterwards is asked of the database."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(SqliteTable)
    return spark.read.format("sqlite_table").schema(schema).option("path", _local(path)).option("table", name).option("key", key).option("parts", parts).load()


class SqliteTable(DataSource):
    """``spark.read.format("sqlite_table").schema(s).option("path", f).option("table", t).option("key", k).option("parts", n)``"""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(self.options, schema)


class _Range(InputPartition):
    def __init__(self, where: str, values: list):
        self.where, self.values = where, values


class _SqliteReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.table, self.key, self.parts = options["path"], _quoted(options["table"]), _quoted(options["key"]), int(options.get("parts", "1"))
        self.schema, self.where, self.values = schema, [], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            value = getattr(f, "value", None)
            values = list(value) if isinstance(f, In) else [value]
            known = len(getattr(f, "attribute", ())) == 1
            if known and isinstance(f, (IsNull, IsNotNull)):
                self.where.append(f"{_quoted(f.attribute[0])} IS {'NOT ' * isinstance(f, IsNotNull)}NULL")
            elif known and (type(f) in COMPARED or isinstance(f, In)) and all(isinstance(v, (int, float, str)) and v == v for v in values) and len(self.values) + len(values) <= MOST_VALUES:
                self.where.append(f"{_quoted(f.attribute[0])} " + (f"IN ({', '.join('?' * len(values))})" if isinstance(f, In) else f"{COMPARED[type(f)]} ?"))
                self.values += values
            else:
                yield f

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(_uri(self.path, "mode=ro&immutable=1"), uri=True)

    def partitions(self) -> list[InputPartition]:
        with closing(self._open()) as db:
            low, high = db.execute(f"SELECT (SELECT min({self.key}) FROM {self.table}), (SELECT max({self.key}) FROM {self.table})").fetchone()
        if low is None:
            return [_Range("1", [])]
        if not (isinstance(low, int) and isinstance(high, int)):
            raise ValueError(f"{self.key} of {self.table} is no integer")
        cuts = sorted({low + (high - low + 1) * i // self.parts for i in range(1, self.parts)} - {low})
        if not cuts:
            return [_Range("1", [])]
        inner = [_Range(f"{self.key} >= ? AND {self.key} < ?", [a, b]) for a, b in zip(cuts, cuts[1:])]
        return [_Range(f"({self.key} < ? OR {self.key} IS NULL)", cuts[:1]), *inner, _Range(f"{self.key} >= ?", cuts[-1:])]

    def read(self, partition: _Range) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(self.schema)
        where = " AND ".join([partition.where, *self.where])
        with closing(self._open()) as db:
            found = db.execute(f"SELECT {', '.join(_quoted(c) for c in self.schema.names)} FROM {self.table} WHERE {where}", [*partition.values, *self.values])
            while rows := found.fetchmany(10_000):
                columns = [[v if v is None else bool(v) for v in c] if pa.types.is_boolean(f.type) else c for c, f in zip(zip(*rows), shape)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)
