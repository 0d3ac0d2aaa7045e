import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMOKE

TABLES = "part lineitem events documents conversations".split()

# Every registered query is checked against its oracle at the smallest scale.
# The training-data queries have tests of their own.
ALL = sorted(entry._q.QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["p_partkey", "p_name", "p_brand", "p_size"]


def test_every_query_has_oracle_or_is_known():
    assert set(ALL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def _canon(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ALL)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got = [tuple(r[c] for c in ocols) for r in df.collect()]
    assert _canon(got) == _canon(res.fetchall())
