import hashlib

import duckdb
import numpy as np
import pytest

from tidewater.llm import queries, va_file

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in kept]
        for j in range(len(cents)):
            if vs := [v for (_, v), m in zip(kept, mine) if m == j]:
                cents[j] = [sum(x) // len(vs) for x in zip(*vs)]
    end = [(i, *nearest(v)) for i, v in kept]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted([(i, j, d, sum(x[1] for x in end if x[2] == j), sum(x[1] for x in end), sha[j]) for i, d, j in end],
                  key=repr)


def result(spark, rows, k, dims, rounds=5):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted([tuple(r) for r in va_file.cluster(df, k, rounds, dims).collect()], key=repr)


@pytest.mark.parametrize("dims", [8, 5])
def test_matches_all_distances(spark, dims):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(i % 7, 0.3, dims)], i % 3) for i in range(300)]
    rows += [(1000, [0.5] * dims, 1)] * 4 + [(1001, [-700.25] * dims, None), (1002, [1e-30] * dims, 0)]
    bad = [(2000, None, 0), (2001, [], 0), (2002, [1.0] * (dims + 1), 0), (2003, [None] + [1.0] * (dims - 1), 0),
           (2004, [float("nan")] + [1.0] * (dims - 1), 0), (2005, [float("inf")] + [1.0] * (dims - 1), 0),
           (2006, [1.0] * (dims - 1) + [float("-inf")], 0)]
    assert result(spark, rows + bad, 9, dims) == brute(rows + bad, 9, 5, dims)


def test_more_centroids_than_vectors_and_ties(spark):
    rows = [(1, [0.0, 0.0], 0), (1, [0.0, 0.0], 0), (2, [1.0, 1.0], 0), (None, [0.5, 0.5], 0)]
    assert result(spark, rows, 40, 2) == brute(rows, 40, 5, 2)
    assert result(spark, rows, 2, 2) == brute(rows, 2, 5, 2)


def test_empty_centroids_stay(spark):
    rows = [(i, [0.25] * 4, 0) for i in range(20)]
    got = result(spark, rows, 6, 4)
    assert got == brute(rows, 6, 5, 4) and {r[1] for r in got} == {0}


def test_no_vectors(spark):
    assert result(spark, [], 40, 64) == []
    assert result(spark, [(1, None, 0), (2, [1.0], 0)], 40, 64) == []


def test_too_large_components_are_left_out(spark):
    assert [r[0] for r in result(spark, [(1, [1e30] * 2, 0), (2, [1.0, 2.0], 0)], 3, 2)] == [2]


def test_clashing_columns(spark):
    rows = [(1, [1.0, 2.0], 7, 8, "x"), (2, [3.0, 2.0], 7, 8, "y")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, vec int, code string")
    assert sorted([tuple(r) for r in va_file.cluster(df, 2, 5, 2).collect()], key=repr) == brute(rows, 2, 5, 2)


def test_cells_bound_the_distance():
    rnd = np.random.default_rng(1)
    vec = rnd.integers(-200, 200, (500, 6))
    edges = np.stack([np.quantile(vec[:, d], np.linspace(0, 1, 17)).astype(int) for d in range(6)])
    edges[:, 0], edges[:, -1] = vec.min(axis=0), vec.max(axis=0) + 1
    cents = rnd.integers(-250, 250, (5, 6))
    bound = sum(t[c] for t, c in zip(va_file.lookup(cents, edges), va_file.encode(vec, edges).T))
    d = ((vec[:, None] - cents) ** 2).sum(axis=2)
    assert (bound[:, :5] <= d).all() and (d <= bound[:, 5:]).all()


def test_cells_decide_for_separate_clusters():
    rnd = np.random.default_rng(2)
    vec = (rnd.normal(0, 6, (900, 8)) + 100 * rnd.integers(0, 3, (900, 1))).astype(np.int64)
    inner = np.sort(np.linspace(vec.min(axis=0), vec.max(axis=0) + 1, 17).astype(np.int64).T)
    near = va_file.Nearest([[0] * 8, [100] * 8, [200] * 8], inner)
    got = near(va_file.encode(vec, inner), vec)
    assert (got == ((vec[:, None] - near.centroids) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert near.fetched < 90        # a tenth of the vectors


def test_query_matches_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet')")
    res = con.execute(queries.ORACLE_SQL["op12_va_file"])
    names = [d[0] for d in res.description]
    got = va_file.op12(spark, path)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(res.fetchall())
