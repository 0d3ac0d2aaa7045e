import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from tidewater.operators.select import band_filter, register_views, run_sql
from tidewater.functions.rows import to_string_map
from tidewater.sinks.tables import iter_maps
from tidewater.sources import text

# The people fixture: three space-separated lines (id name age).
PEOPLE = ["1 aa 18", "2 bb 28", "3 cc 38"]


def write_lines(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def test_people_range_query(spark, scratch):
    path = scratch("people")
    write_lines(spark, path, PEOPLE)
    people = text.read_delimited(spark, path).good
    assert people.schema == text.PEOPLE_SCHEMA
    register_views(spark, {"person": people})
    teen = run_sql(spark, "SELECT id, name, age FROM person WHERE age >= 13 AND age <= 19")
    maps = list(iter_maps(teen.select(to_string_map("id", "name", "age").alias("m")), "m"))
    assert maps == [{"id": "1", "name": "aa", "age": "18"}]


def test_range_edges(spark):
    df = spark.createDataFrame([(1, 12), (2, 13), (3, 19), (4, 20), (5, None)], "id long, age int")
    got = sorted(r.id for r in band_filter(df, "age", 13, 19).collect())
    assert got == [2, 3]


def test_extra_field_and_trailing_space(spark):
    lines = spark.createDataFrame([("4 dd 15 x",), ("5 ee 16 ",)], "value string")
    got = sorted(tuple(r) for r in text.parse_lines(lines).good.collect())
    assert got == [(4, "dd", 15), (5, "ee", 16)]


BAD = ["6  ff 17", "7 gg", "x hh 18", "8 ii 19\t", "99999999999999999999 big 1"]


def test_bad_lines_quarantine(spark):
    lines = spark.createDataFrame([(l,) for l in BAD + ["9 jj 19"]], "value string")
    res = text.parse_lines(lines, on_bad=text.ON_BAD_QUARANTINE)
    assert [tuple(r) for r in res.good.collect()] == [(9, "jj", 19)]
    assert sorted(r.line for r in res.bad.collect()) == sorted(BAD)


@pytest.mark.parametrize("line", BAD)
def test_bad_line_fails_by_default(spark, line):
    lines = spark.createDataFrame([(line,)], "value string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        text.parse_lines(lines).good.collect()


def test_range_report_and_save_over_input(spark, scratch):
    from tidewater.plans.flows import range_report, save_parsed
    path = scratch("flow")
    write_lines(spark, path, PEOPLE)
    assert [r.m for r in range_report(spark, path, 13, 19).collect()] == [{"id": "1", "name": "aa", "age": "18"}]
    save_parsed(spark, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "aa", 18), (2, "bb", 28), (3, "cc", 38)]


@pytest.mark.parametrize("sep", ["|", "\t", ".", "::"])
def test_separators_are_literal(spark, sep):
    lines = spark.createDataFrame([(sep.join(["7", "zz", "21"]),)], "value string")
    assert [tuple(r) for r in text.parse_lines(lines, sep=sep).good.collect()] == [(7, "zz", 21)]
