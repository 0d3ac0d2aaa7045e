"""The JDBC queries of the plan (window read, insert, keyed upsert) for a
database the caller provides.

They are not registered in ``__spark_entry__``: this build may not start a
database. With a reachable one, ``jdbc_queries(target)`` returns callables
with the same ``(spark, sf_dir)`` signature and ``JDBC_ORACLE_SQL`` their
DuckDB oracles (the same results as ``window_read`` and ``keyed_upsert``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sinks.jdbc import jdbc_append, jdbc_write
from ..sources.jdbc import JdbcTarget, read_jdbc, read_jdbc_window
from ..sources.windows import read_since, read_until
from . import queries as q

# Column types for created tables: text columns as VARCHAR (a CLOB column
# cannot be compared in a pushed-down predicate on some databases).
EVENT_COLUMN_TYPES = "event_type VARCHAR(64)"


def jdbc_queries(target: JdbcTarget, prefix: str = "tw_",
                 partitions: int = 4) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """``jdbc_window``, ``jdbc_insert``, ``jdbc_upsert`` against ``target``."""
    target.check()
    events_table, latest_table = f"{prefix}events", f"{prefix}latest"

    def load_events(spark, sf_dir):
        return q.load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")

    def jdbc_insert(spark, sf_dir):
        # K3: parallel batched insert of the whole table, read back whole
        jdbc_append(load_events(spark, sf_dir), target, events_table, mode="overwrite",
                    column_types=EVENT_COLUMN_TYPES, num_partitions=partitions)
        return read_jdbc(spark, target, table=events_table).select("event_id", "user_id", "event_type",
                                                                   "value")

    def jdbc_window(spark, sf_dir):
        # S2 + S3: the window read runs in the database, split in range reads
        jdbc_append(load_events(spark, sf_dir), target, events_table, mode="overwrite",
                    column_types=EVENT_COLUMN_TYPES, num_partitions=partitions)
        rows = read_jdbc_window(spark, target, events_table, "ts", q.DAY_LO, q.DAY_HI,
                                num_partitions=partitions)
        return rows.select("event_id", "user_id", "event_type", "value")

    def jdbc_upsert(spark, sf_dir):
        # K4: first half as the base, second half merged in with one MERGE
        ev = load_events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
        order = ["ts", "event_id"]
        base = q.upsert.latest_per_key(read_until(ev, "ts", q.HALF_SPLIT), ["user_id"], order)
        jdbc_append(base, target, latest_table, mode="overwrite", column_types=EVENT_COLUMN_TYPES)
        jdbc_write(read_since(ev, "ts", q.HALF_SPLIT), target, latest_table, "upsert",
                   keys=["user_id"], order=order, column_types=EVENT_COLUMN_TYPES)
        return read_jdbc(spark, target, table=latest_table).select("user_id", "event_id", "event_type",
                                                                   "value")

    return {"jdbc_insert": jdbc_insert, "jdbc_window": jdbc_window, "jdbc_upsert": jdbc_upsert}


JDBC_ORACLE_SQL = {
    "jdbc_insert": "SELECT event_id, user_id, event_type, value FROM events",
    "jdbc_window": q.ORACLE_SQL["window_read"],
    "jdbc_upsert": q.ORACLE_SQL["keyed_upsert"],
}
