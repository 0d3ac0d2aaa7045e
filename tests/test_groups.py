from tidewater.operators import groups


def test_intersect_by_name_other_order(spark):
    a = spark.createDataFrame([(1, "x", 10), (1, "x", 10), (2, "y", 20), (None, "n", 0)],
                              "id long, name string, age int")
    b = spark.createDataFrame([(10, 1, "x"), (30, 3, "z"), (0, None, "n")],
                              "age int, id long, name string")
    got = sorted(groups.intersect_by_name(a, b).collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(1, "x", 10), (None, "n", 0)], key=str)


def _members(spark):
    rows = [("g1", "A"), ("g2", "A"), ("g2", "B"), ("g3", "A"), ("g3", "B"), ("g3", "C")]
    return spark.createDataFrame(rows, "g string, m string")


def test_completeness_cases(spark):
    df = _members(spark)
    got = {r.g: r.complete for r in groups.group_completeness(df, "g", "m", ["A", "B"]).collect()}
    assert got == {"g1": False, "g2": True, "g3": True}
    none = {r.g: r.complete for r in groups.group_completeness(df, "g", "m", []).collect()}
    assert none == {"g1": True, "g2": True, "g3": True}


def test_completeness_large_required_set(spark):
    req = [f"m{i}" for i in range(70)]
    rows = [("full", m) for m in req] + [("part", m) for m in req[:-1]] + [("full", "extra")]
    df = spark.createDataFrame(rows, "g string, m string")
    got = {r.g: r.complete for r in groups.group_completeness(df, "g", "m", req).collect()}
    assert got == {"full": True, "part": False}


def test_completeness_hot_group(spark):
    # one group holds most rows; result must still be exact
    rows = [("hot", "A")] * 5000 + [("hot", "B")] + [(f"g{i}", "A") for i in range(100)]
    df = spark.createDataFrame(rows, "g string, m string").repartition(8)
    got = groups.complete_groups(df, "g", "m", ["A", "B"]).collect()
    assert [r.g for r in got] == ["hot"]


def test_completeness_composite_group(spark):
    rows = [(1, "x", "A"), (1, "x", "B"), (1, "y", "A"), (2, "x", "B"), (2, "x", "A")]
    df = spark.createDataFrame(rows, "k long, s string, m string")
    got = sorted(tuple(r) for r in groups.complete_groups(df, ["k", "s"], "m", ["A", "B"]).collect())
    assert got == [(1, "x"), (2, "x")]
