"""History tables in a database: partitioned reads, and inserts that ignore known keys.

Reads are one query for each range of days (``predicates`` of Spark's JDBC reader), so that tasks share
the table and a range filter reaches the database. Writes go through one connection for each partition
of the rows, ``BATCH`` rows a statement, each partition committed as a whole; a row whose key the
table has is left out by the database (``ON CONFLICT DO NOTHING``), so a task that runs twice changes
nothing. No database runs in this repository's tests: they check options, statements and batches on
a stand-in connection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession

from ..schemas import ADVISORY_TABLE_KEY, EMA_TABLE_KEY

BATCH = 1_000
EMA_COLUMNS = ["symbol", "ema38", "ema100", "trade_timestamp"]
ADVISORY_COLUMNS = ["symbol", "advice", "trade_timestamp"]


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def day_predicates(first: date, last: date, parts: int, column: str = "trade_timestamp") -> list[str]:
    """Conditions that cut the days from ``first`` to ``last`` into at most ``parts`` ranges, each row in one."""
    days = (last - first).days + 1
    if days < 1 or parts < 1:
        raise ValueError("no days or no parts")
    parts = min(parts, days)
    edges = [first + timedelta(days=days * i // parts) for i in range(parts + 1)]
    return [f"{quoted(column)} >= '{a}' AND {quoted(column)} < '{b}'" for a, b in zip(edges, edges[1:])]


def read_history(spark: SparkSession, url: str, table: str, first: date, last: date, parts: int,
                 properties: dict[str, str] | None = None) -> DataFrame:
    """The rows of the given days, one task for each range of days."""
    return spark.read.jdbc(url, table, predicates=day_predicates(first, last, parts),
                           properties={"fetchsize": "10000", **(properties or {})})


def insert_statement(table: str, columns: list[str], key: list[str], mark: str = "%s") -> str:
    """``mark`` is the driver's parameter mark."""
    names = ", ".join(quoted(c) for c in columns)
    return (f"INSERT INTO {'.'.join(quoted(t) for t in table.split('.'))} ({names}) VALUES ({', '.join([mark] * len(columns))}) "
            f"ON CONFLICT ({', '.join(quoted(k) for k in key)}) DO NOTHING")


def _batches(rows: Iterable[Row], size: int) -> Iterator[list[tuple]]:
    rows = iter(rows)
    while some := [tuple(r) for r in islice(rows, size)]:
        yield some


def write_rows(rows: Iterable[Row], connect: Callable[[], object], statement: str, batch: int = BATCH) -> int:
    """Insert rows over one connection, which is opened for the first of them; all or none are kept."""
    connection, n = None, 0
    try:
        for some in _batches(rows, batch):
            connection = connection or connect()
            cursor = connection.cursor()
            cursor.executemany(statement, some)
            cursor.close()
            n += len(some)
        if connection:
            connection.commit()
    except BaseException:
        if connection:
            connection.rollback()
        raise
    finally:
        if connection:
            connection.close()
    return n


def insert_if_absent(rows: DataFrame, table: str, connect: Callable[[], object], columns: list[str], key: list[str],
                     mark: str = "%s", batch: int = BATCH, parts: int | None = None) -> None:
    """Insert ``rows`` by ``parts`` connections (as many as partitions if not given); ``connect`` opens a
    DB-API connection in a task."""
    statement = insert_statement(table, columns, key, mark)
    rows = rows.select(*columns)
    if parts:
        rows = rows.repartition(parts, *key)  # rows of one key in one transaction
    rows.foreachPartition(lambda part: write_rows(part, connect, statement, batch) and None)


def write_ema_rows(rows: DataFrame, connect: Callable[[], object], table: str = "ema_results", **how) -> None:
    insert_if_absent(rows, table, connect, EMA_COLUMNS, list(EMA_TABLE_KEY), **how)


def write_advisories(rows: DataFrame, connect: Callable[[], object], table: str = "buy_advisories", **how) -> None:
    insert_if_absent(rows.withColumnRenamed("message", "advice"), table, connect, ADVISORY_COLUMNS, list(ADVISORY_TABLE_KEY), **how)
