"""Events that must not pass: pruned decoding, text after the object, clashing names."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.functions import rows
from tidewater.streaming import delivery

BAD = ['{"k":1} trailing', '{"k":1}{"k":2}', '{"k":1},{"k":2}', '{"k":1}], [{"k":2}', '{"k":1},7], [{"k":2}',
       '{"k":1}, "x":2', '{"k":1}]', "[1]", "nope", '{"k":', '"{}"', "{} {}"]
GOOD = ['{"k":1}', ' {"k":1}\n', '{"k":1,"n":{"x":[1,{"y":"}{"}]}}', '{"k":1,"t":"a } b"}', "{}", '{"k":null}',
        '{"k":1,"t":"é\\u007d\\""}', '{"k":1,"k":2}']


def _df(spark, bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


@pytest.mark.parametrize("schema", [None, "k long, n string, t string"])
def test_whole_body_is_one_object(spark, schema):
    dec = delivery.decode_bodies(_df(spark, BAD + GOOD), "body", schema, delivery.ON_BAD_QUARANTINE)
    assert sorted(r.body for r in dec.bad.collect()) == sorted(BAD)
    assert sorted(r.body for r in dec.good.collect()) == sorted(GOOD)


@pytest.mark.parametrize("bad", ["nope", '{"k":1} trailing', '{"k":"x"}'])
def test_fail_mode_fails_when_the_event_is_not_used(spark, scratch, bad):
    df = _df(spark, ['{"k":1}', bad, '{"k":3}'])
    good = delivery.decode_bodies(df, "body", "k long").good
    for use in (lambda: good.count(), lambda: good.select("body").collect(), lambda: good.select("event").collect()):
        with pytest.raises(PySparkException):
            use()
    out = scratch("pruned")
    run = delivery.delivery_batch(out, lambda d: d.select("body"), body_col="body", schema="k long")
    with pytest.raises(PySparkException):
        run(df, 0)


def test_fail_mode_decodes_once(spark):
    good = delivery.decode_bodies(_df(spark, ['{"k":1}']), "body", "k long").good
    plan = spark._jvm.PythonSQLUtils.explainString(good.select("event.k")._jdf.queryExecution(), "simple")
    assert "Filter CASE WHEN isnull(event" in plan
    assert [x.lstrip("+- :*(0123456789)").split()[0] for x in plan.splitlines() if "from_json" in x] == ["Project"]
    assert [r.k for r in good.select("event.k").collect()] == [1]


def test_a_field_may_have_the_name_of_the_mark(spark):
    df = _df(spark, ['{"_malformed":"x"}', '{"_malformed":[}'])
    dec = delivery.decode_bodies(df, "body", "_malformed string", delivery.ON_BAD_QUARANTINE)
    assert [r.event["_malformed"] for r in dec.good.collect()] == ["x"] and dec.bad.count() == 1


def test_of_columns_with_one_name_the_last_is_written(spark):
    a = spark.createDataFrame([(1, "left")], "id long, v string")
    b = spark.createDataFrame([(1, "right")], "id long, v string")
    joined = a.join(b, a.id == b.id)
    assert rows.json_events(joined).first().body == '{"id":1,"v":"right"}'
    assert a.select(rows.to_json_event(["id", "v", "id"]).alias("j")).first().j == '{"id":1,"v":"left"}'
    assert rows.json_events(a.select("id", F.lit(None).cast("string").alias("v"))).first().body == '{"id":1,"v":null}'
