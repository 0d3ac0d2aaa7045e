"""Templates given as text, and events without a schema."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater import fixed
from tidewater.functions.templates import TemplateError, compile_template
from tidewater.functions.variants import decode_variants, field, quote_numbers


def _render(spark, text, value=2):
    df = spark.createDataFrame([(value, None)], "id int, none string")
    m = F.create_map(F.lit("id"), F.col("id"))
    return df.select(compile_template(text, {"map": m, "id": F.col("id"), "none": F.col("none"),
                                             "s": F.struct("id", "none")}).alias("t")).first().t


def test_the_fixture_renders(spark):
    assert _render(spark, fixed.TEMPLATE_TEXT) == '<?xml version="1.0" encoding="UTF-8"?>\n<test>\ntrue\n</test>'
    assert _render(spark, fixed.TEMPLATE_TEXT, 3).endswith("<test>\nfalse\n</test>")


@pytest.mark.parametrize("text, want", [
    ("", ""), ("plain text", "plain text"), ("$id", "2"), ("${id}nd", "2nd"), ("$!{id}!", "2!"), ("$none", "$none"),
    ("[$!none]", "[]"), ("$unknown $!unknown.", "$unknown ."), ('$map.get("id")', "2"), ("$map['id']", "2"),
    ("$s.id", "2"), ('$map.get("x")', '$map.get("x")'), ("$!map.get('x')", ""), ("#set($a = $id)$a$a", "22"),
    ("#set($a=1)\n#set( $b = \"<$a>\" )\n$b", "<1>"), ("  #set($a=1)  \nx", "x"), ("x #set($a=1) y", "x  y"),
    ("#set($a = $id == 2)$a", "true"), ("#set($a = 'x' != \"x\")$a", "false"), ("#set($a = $none == $none)$a", "false"),
    ("#set($a=1)#set($a=2)$a", "2"), ("#set($a='$id')$a", "$id"), ("cost: $5 or 5$", "cost: $5 or 5$"),
    ("#set($r = true)$r #set($n = null)[$!n]", "true []"), ("#set($a = -1.50)$a", "-1.50"), ("# $id #x", "# 2 #x"),
])
def test_templates(spark, text, want):
    assert _render(spark, text) == want


@pytest.mark.parametrize("text", ["#set($a = )", "#set($a = 1", "#set(a = 1)", "#set($a = 1 == )", "x #set"])
def test_no_templates(spark, text):
    with pytest.raises(TemplateError):
        compile_template(text, {})


BODIES = ['{"k":1.50,"n":{"x":[1.10,"a, 5, b",null,{"z":-2e3}]},"s":"q\\"7\\"\\u00e9 12"}', '{"a":1,"a":2.50,"b":{"c":1,"c":2}}',
          '{"k":12345678901234567890123456789012345678901234567890.10}', '{}', '{"k":"1.50"}', '{"t":true,"e":""}']
BAD = ['{"k":1} x', '{"k":1}{"k":2}', "[1]", "1", "", "nope", None, '{"k":1.5.}']


def test_variants_keep_nesting_types_and_the_last_of_a_name(spark):
    df = spark.createDataFrame([(b,) for b in BODIES + BAD], "body string")
    got = {r.body: r.t for r in decode_variants(df).select("body", F.col("event").cast("string").alias("t")).collect()}
    assert [b for b in BODIES + BAD if got[b] is None] == BAD
    assert json.loads(got[BODIES[0]]) == json.loads(BODIES[0])
    assert json.loads(got[BODIES[1]]) == {"a": 2.5, "b": {"c": 2}}
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def test_number_texts_are_kept(spark):
    df = spark.createDataFrame([(b,) for b in BODIES], "body string")
    ev = decode_variants(df, numbers="text")
    rows = ev.select(field("event", "$.k").alias("k"), field("event", "$.n.x[0]").alias("x"),
                     field("event", "$.n.x[3].z").alias("z"), field("event", "$.n.x[1]").alias("s"),
                     field("event", "$.s").alias("t"), field("event", "$.t", "boolean").alias("b"),
                     field("event", "$.a", "double").alias("a")).collect()
    assert tuple(rows[0])[:5] == ("1.50", "1.10", "-2e3", "a, 5, b", 'q"7"é 12') and rows[1].a == 2.5
    assert rows[2].k == "12345678901234567890123456789012345678901234567890.10"
    assert rows[4].k == "1.50" and rows[5].b is True
    marked = spark.createDataFrame([('{"k":1\u0001}',)], "body string").select(quote_numbers("body").alias("b"))
    assert marked.first().b == '{"k":1\u0001}'
