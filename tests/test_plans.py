"""Plan shape tests: the properties the scale design relies on."""

import re

from tidewater.operators.upsert import latest_per_key
from tidewater.plans import queries as q
from tidewater.sinks import files

from conftest import SF_SMOKE


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def ops(text: str, name: str) -> int:
    return len(re.findall(rf"^\(\d+\) {name}\b", text, flags=re.M))


def test_band_filter_pushed_and_pruned(spark):
    p = plan(q.band_filter(spark, SF_SMOKE))
    assert "GreaterThanOrEqual(p_size,13)" in p and "LessThanOrEqual(p_size,19)" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_size:int>" in p
    assert ops(p, "Exchange") == 0


def test_window_bounds_pushed(spark):
    p = plan(q.window_read(spark, SF_SMOKE))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in p and "LessThan(ts,2024-01-06T00:00)" in p


def test_completeness_is_one_partial_hash_aggregate(spark):
    p = plan(q.group_complete(spark, SF_SMOKE))
    assert ops(p, "Exchange") == 1
    assert "partial_bit_or" in p and ops(p, "HashAggregate") == 2
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in p


def test_intersect_dedupes_each_side_before_one_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(q.intersect_keys(spark, SF_SMOKE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ops(p, "Exchange") == 2          # one per side
    assert ops(p, "HashAggregate") == 4     # partial + final per side
    assert "Join type: LeftSemi" in p


def test_bucket_merge_adds_no_exchange_after_bucket_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMOKE}/events.parquet").select("user_id", "ts", "event_id", "value")
    bkeys = ["user_id", files.BUCKET_COL]
    batch = latest_per_key(ev.withColumn(files.BUCKET_COL, files.bucket_of(["user_id"], 4)),
                           bkeys, ["ts", "event_id"])
    both = batch.limit(0).unionByName(batch).repartitionByRange(4, "bucket", "user_id")
    p = plan(latest_per_key(both, bkeys, ["ts", "event_id"]))
    # batch reduction (1) + the range shuffle on (bucket, key) (1) (+1 for limit's single partition);
    # the final reduction adds none: range partitioning on its keys satisfies it
    assert ops(p, "Exchange") <= 3
    assert "rangepartitioning(bucket" in p
    assert p.count("partial_max") >= 1


def test_json_decoded_once_in_bind_params(spark):
    p = plan(q.bind_params(spark, SF_SMOKE))
    assert p.count("from_json(MapType") == 1
