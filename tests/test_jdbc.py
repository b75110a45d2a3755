"""Database reads and writes without a database: statements, ranges, batches, transactions."""
from datetime import date

import pytest
from pyspark.sql import Row

from tickscan.sinks.jdbc import day_predicates, insert_statement, read_history, write_rows


class Connection:
    def __init__(self, log, fail_at=None):
        self.log, self.fail_at = log, fail_at

    def cursor(self):
        return self

    def executemany(self, statement, rows):
        if self.fail_at is not None and len(self.log) >= self.fail_at:
            raise OSError("lost")
        self.log.append((statement, rows))

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        pass


def test_statement():
    assert insert_statement("public.ema_results", ["symbol", "trade_timestamp"], ["symbol"]) == (
        'INSERT INTO "public"."ema_results" ("symbol", "trade_timestamp") VALUES (%s, %s) ON CONFLICT ("symbol") DO NOTHING')


def test_batches_and_transactions():
    rows = [Row(symbol=f"S{i}", v=i) for i in range(25)]
    log = []
    assert write_rows(rows, lambda: Connection(log), "x", 10) == 25
    assert [len(x[1]) for x in log[:-1]] == [10, 10, 5] and log[-1] == "commit" and log[0][1][0] == ("S0", 0)
    log = []
    with pytest.raises(OSError):
        write_rows(rows, lambda: Connection(log, 1), "x", 10)
    assert log[-1] == "rollback" and len(log) == 2
    log = []
    assert write_rows([], lambda: log.append("opened"), "x") == 0 and log == []   # no rows: no connection


def test_ranges():
    p = day_predicates(date(2024, 1, 1), date(2024, 1, 10), 3)
    assert p == ['"trade_timestamp" >= \'2024-01-01\' AND "trade_timestamp" < \'2024-01-04\'',
                 '"trade_timestamp" >= \'2024-01-04\' AND "trade_timestamp" < \'2024-01-07\'',
                 '"trade_timestamp" >= \'2024-01-07\' AND "trade_timestamp" < \'2024-01-11\'']
    assert len(day_predicates(date(2024, 1, 1), date(2024, 1, 2), 8)) == 2
    with pytest.raises(ValueError):
        day_predicates(date(2024, 1, 2), date(2024, 1, 1), 2)

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            return url, table, len(predicates), properties["fetchsize"], properties["user"]

    class Session:
        read = Reader()
    assert read_history(Session(), "jdbc:x", "ema_results", date(2024, 1, 1), date(2024, 1, 10), 3, {"user": "u"}) == ("jdbc:x", "ema_results", 3, "10000", "u")
