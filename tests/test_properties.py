"""Property tests: operators against brute-force Python on generated data.

Each example builds one small DataFrame, so example counts stay low.
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.functions import rows
from tidewater.operators import groups, upsert
from tidewater.sources import text

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

members = st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3", "g4"]),
                             st.sampled_from(["A", "B", "C", "D"])), max_size=30)


@SETTINGS
@given(members=members, required=st.lists(st.sampled_from(["A", "B", "C", "D"]), max_size=4))
def test_completeness_matches_subset_test(spark, members, required):
    df = spark.createDataFrame(members or [("g0", "Z")], "g string, m string")
    data = members or [("g0", "Z")]
    got = {r.g: r.complete for r in groups.group_completeness(df, "g", "m", required).collect()}
    want = {g: set(required) <= {m for gg, m in data if gg == g} for g, _ in data}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 50), st.text(max_size=3)), min_size=1, max_size=40))
def test_latest_per_key_matches_max(spark, data):
    df = spark.createDataFrame(data, "k long, o long, v string")
    got = {r.k: (r.o, r.v) for r in upsert.latest_per_key(df, ["k"], ["o"]).collect()}
    want = {}
    for k, o, v in data:
        if k not in want or (o, v) > want[k]:
            want[k] = (o, v)
    assert got == want


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["x", "y"])), max_size=20)


@SETTINGS
@given(a=pairs, b=pairs)
def test_intersect_matches_set_intersection(spark, a, b):
    schema = "k long, s string"
    da = spark.createDataFrame(a, schema)
    db = spark.createDataFrame(b, schema).select("s", "k")
    got = {tuple(r) for r in groups.intersect_by_name(da, db).collect()}
    assert got == set(a) & set(b)


@SETTINGS
@given(st.lists(st.text(min_size=0, max_size=6), min_size=1, max_size=20))
def test_reverse_key_matches_python(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(rows.reverse_key("k")).collect()]
    assert got == [k[::-1] for k in keys]


line = st.tuples(st.integers(-10**12, 10**12), st.text(alphabet="abc", min_size=1, max_size=4),
                 st.integers(-2**31, 2**31 - 1))


@SETTINGS
@given(st.lists(line, min_size=1, max_size=20))
def test_text_scan_round_trip(spark, recs):
    lines = spark.createDataFrame([(f"{i} {n} {a}",) for i, n, a in recs], "value string")
    got = [tuple(r) for r in text.parse_lines(lines).good.collect()]
    assert got == recs


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=8)), st.integers(-10**6, 10**6)),
                min_size=1, max_size=20))
def test_json_event_round_trip_keeps_text(spark, data):
    df = spark.createDataFrame(data, "s string, n long")
    back = df.select(rows.parse_event(rows.to_json_event()).alias("m")).collect()
    for (s, n), r in zip(data, back):
        assert r.m["s"] == s and r.m["n"] == str(n)


@SETTINGS
@given(offsets=st.lists(st.integers(0, 10 * 86400 * 10**6 - 1), min_size=1, max_size=25),
       step_s=st.integers(1, 3 * 86400), first_id=st.integers(0, 1000))
def test_window_assignment_matches_floor(spark, offsets, step_s, first_id):
    from datetime import datetime, timedelta
    from tidewater.streaming import windows as ingest
    start, step = datetime(2024, 3, 9, 0, 0, 0), timedelta(seconds=step_s)
    ts = [start + timedelta(microseconds=o) for o in offsets]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id long, ts timestamp_ntz")
    end = start + timedelta(days=10)
    pending, lo, wid = [], start, first_id
    while lo < end:
        pending.append(ingest.Window(wid, lo, min(lo + step, end)))
        lo, wid = lo + step, wid + 1
    got = {r.id: (r.window_id, r.window_lo) for r in ingest.assign_windows(df, "ts", pending, step).collect()}
    for i, t in enumerate(ts):
        k = (t - start) // step
        assert got[i] == (first_id + k, start + k * step)
