"""JDBC table / query scans (S2) and time-window reads (S3) through Spark's
JDBC data source.

Reads are parallel: either a numeric/time ``partition_column`` with bounds
(Spark issues one range query per partition) or explicit ``predicates``
(one query each). Window bounds and projections are pushed into the
database's WHERE and SELECT lists by the data source.

A caller-written window query with two ``?`` parameters is also accepted
(``read_jdbc_sql_window``): the bounds are bound as text literals made here
and the query runs as one JDBC ``query`` (one partition; prefer the table
form for parallel reads). Reads never execute writes, so no keyword guard
on SQL text is needed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from .windows import read_window


@dataclass
class JdbcTarget:
    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)   # never printed
    extra: dict = field(default_factory=dict)

    def check(self) -> None:
        """Fail before any job starts when a required setting is missing."""
        if not self.url:
            raise ValueError("jdbc url is required")

    def options(self) -> dict[str, str]:
        self.check()
        opts = {"url": self.url}
        if self.driver:
            opts["driver"] = self.driver
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts


def scan_options(target: JdbcTarget, table: str | None = None, query: str | None = None,
                 partition_column: str | None = None, lower=None, upper=None,
                 num_partitions: int | None = None, fetchsize: int = 10000) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')`` (pure; unit-tested)."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = target.options()
    opts["fetchsize"] = str(fetchsize)
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column is not None:
        if query is not None:
            raise ValueError("partition_column needs a table (Spark wraps a query otherwise)")
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partition_column needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=_bound_text(lower),
                    upperBound=_bound_text(upper), numPartitions=str(num_partitions))
    return opts


def _bound_text(v) -> str:
    return v.isoformat(sep=" ") if isinstance(v, datetime) else str(v)


def read_jdbc(spark: SparkSession, target: JdbcTarget, table: str | None = None,
              query: str | None = None, partition_column: str | None = None, lower=None,
              upper=None, num_partitions: int | None = None,
              predicates: list[str] | None = None, fetchsize: int = 10000) -> DataFrame:
    """A whole table or query result as a DataFrame, read in parallel."""
    if predicates:
        if table is None:
            raise ValueError("predicates need a table")
        props = target.options()
        url = props.pop("url")
        props["fetchsize"] = str(fetchsize)
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    opts = scan_options(target, table, query, partition_column, lower, upper,
                        num_partitions, fetchsize)
    return spark.read.format("jdbc").options(**opts).load()


def read_jdbc_window(spark: SparkSession, target: JdbcTarget, table: str, time_col: str,
                     lo: datetime, hi: datetime, num_partitions: int = 1) -> DataFrame:
    """S3 over JDBC: rows with ``lo <= time_col < hi``.

    With ``num_partitions > 1`` the window is split on the time column into
    parallel range reads; the window predicate itself is pushed to every one
    of them, so the database returns only window rows.
    """
    if num_partitions > 1:
        df = read_jdbc(spark, target, table=table, partition_column=time_col,
                       lower=lo, upper=hi, num_partitions=num_partitions)
    else:
        df = read_jdbc(spark, target, table=table)
    return read_window(df, time_col, lo, hi)


def bind_window_sql(sql: str, lo: datetime, hi: datetime) -> str:
    """Bind the two positional ``?`` parameters of a window query to the
    window bounds as SQL text literals ``'yyyy-MM-dd HH:mm:ss'`` (first ``?``
    = lower bound, second = upper bound). ``?`` inside quoted text or quoted
    identifiers is left alone. The bound values are produced here, never
    taken from data. Whether each edge is open or closed is up to the SQL
    text; ``ts >= ? AND ts < ?`` gives the half-open windows used elsewhere.
    """
    values = [lo.isoformat(sep=" "), hi.isoformat(sep=" ")]
    out, quote, n = [], None, 0
    for ch in sql:
        if quote:
            if ch == quote:
                quote = None
        elif ch in ("'", '"'):
            quote = ch
        elif ch == "?":
            if n >= len(values):
                raise ValueError("a window query takes at most two parameters")
            out.append(f"'{values[n]}'")
            n += 1
            continue
        out.append(ch)
    if quote:
        raise ValueError("unbalanced quote in window query")
    return "".join(out)


def read_jdbc_sql_window(spark: SparkSession, target: JdbcTarget, sql: str,
                         lo: datetime, hi: datetime, fetchsize: int = 10000) -> DataFrame:
    """S3 with a caller-written window query (``... WHERE ts >= ? AND ts < ?``):
    the bound query runs in the database as Spark's JDBC ``query``."""
    if not sql or not sql.strip():
        raise ValueError("sql is required")
    return read_jdbc(spark, target, query=bind_window_sql(sql, lo, hi), fetchsize=fetchsize)
