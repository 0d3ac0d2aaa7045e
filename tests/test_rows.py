import json

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from tidewater.functions import rows
from tidewater.streaming.delivery import decode_bodies, ON_BAD_QUARANTINE


def test_double_sum(spark):
    df = spark.createDataFrame([(0.09, 0.01)], "a double, b double")
    assert df.select(rows.add_doubles("a", "b")).first()[0] == 0.09999999999999999
    # text SQL literals are decimals; cast keeps IEEE doubles
    assert spark.sql("SELECT 0.09D + 0.01D").first()[0] == 0.09999999999999999


def test_null_column_to_json_keeps_field(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    body = df.select(rows.to_json_event()).first()[0]
    assert json.loads(body) == {"a": 1, "b": None}
    dropped = df.select(rows.to_json_event(keep_nulls=False)).first()[0]
    assert json.loads(dropped) == {"a": 1}


BODIES = ["", None, "bad", "[1]", '{"a":1', "{}", '{"a":1.50}', '{"c":{"d":[1]}}']


def test_bodies_skip_bad_and_decode(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(BODIES)], "i int, body string")
    dec = decode_bodies(df, "body", on_bad=ON_BAD_QUARANTINE)
    good = {r.i: r.event for r in dec.good.collect()}
    bad = sorted(r.i for r in dec.bad.collect())
    assert bad == [2, 3, 4]
    assert good == {5: {}, 6: {"a": "1.5"}, 7: {"c": '{"d":[1]}'}}


def test_bad_body_fails_by_default(spark):
    df = spark.createDataFrame([("bad",)], "body string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        decode_bodies(df, "body").good.collect()


def test_params_typed_and_text(spark):
    df = spark.createDataFrame([('{"b":2}',)], "body string")
    names = rows.split_param_names("a,b")
    typed = df.select(*rows.bind_params(rows.parse_event("body", "a long, b long"), names)).first()
    text = df.select(*rows.bind_params(rows.parse_event("body"), names, as_text=True)).first()
    assert tuple(typed) == (None, 2)
    assert tuple(text) == ("null", "2")
    assert rows.split_param_names("") == []
    assert rows.split_param_names("a, b") == ["a", " b"]


def test_reverse_key(spark):
    df = spark.createDataFrame([("123",), ("a\U0001F600b",)], "k string")
    assert [r[0] for r in df.select(rows.reverse_key("k")).collect()] == ["321", "b\U0001F600a"]
    nul = spark.createDataFrame([(None,)], "k string")
    assert nul.select(rows.reverse_key("k", rows.NULL_KEY_LITERAL)).first()[0] == "llun"
    with pytest.raises((PySparkException, Py4JJavaError)):
        nul.select(rows.reverse_key("k")).collect()


def test_template_and_text_equality(spark):
    df = spark.createDataFrame([(2,), (3,), (None,)], "id int")
    out = df.select(rows.render_template(["<test>\n", rows.text_equals("id", "2"), "\n</test>"])).collect()
    assert [r[0] for r in out] == ["<test>\ntrue\n</test>", "<test>\nfalse\n</test>", "<test>\n\n</test>"]


def test_string_map(spark):
    df = spark.createDataFrame([(1, "aa", 18)], "id long, name string, age int")
    m = df.select(rows.to_string_map("id", "name", "age")).first()[0]
    assert m == {"id": "1", "name": "aa", "age": "18"}


def test_text_params_reverse_the_key(spark):
    df = spark.createDataFrame([('{"id":123,"v":"x"}',), ('{"v":"y"}',)], "body string")
    names = rows.split_param_names("v,id")
    got = [tuple(r) for r in df.select(*rows.bind_params(rows.parse_event("body"), names, as_text=True,
                                                         reverse_field="id",
                                                         on_null_key=rows.NULL_KEY_LITERAL)).collect()]
    assert got == [("x", "321"), ("y", "llun")]
