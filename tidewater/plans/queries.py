"""The registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the whole input tables. ``ORACLE_SQL`` holds the equivalent
DuckDB SQL for every query that has one (same column names and types).

Queries that deliver data (cell put, upsert, staged overwrite, windowed
replay, file stream) run their delivery job against a fresh folder under
the session's checkpoint root and return the delivered table read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed, paths, session
from .sizing import choose_buckets, estimated_bytes
from ..functions import rows, templates, variants
from ..operators import cells, groups, select, upsert
from ..sinks import files, keyed, tables, versions
from ..sources import files as source_files
from ..sources import text, windows
from ..streaming import completeness, delivery, reconcile, retry
from ..streaming import windows as ingest


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the query set (parameters, not data).
BAND_LO, BAND_HI = fixed.AGE_LO, fixed.AGE_HI    # closed band of the SQL range query
HALF_SPLIT = datetime(2024, 1, 16)              # "base" before, "updates" from here
DAY_LO, DAY_HI = datetime(2024, 1, 5), datetime(2024, 1, 6)
REQUIRED_FLAGS = ["A", "R"]                     # completeness: both flags present
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]+"
CELL_FAMILY = "cf"
TEMPLATE_KEY = fixed.TEMPLATE_KEY              # the template compares a number with this text


# --- P1 P2 D2 D3 -------------------------------------------------------------

BAND_SQL = ("SELECT p_partkey, p_name, p_brand, p_size FROM {view} "
            f"WHERE p_size >= {BAND_LO} AND p_size <= {BAND_HI}")


def _view_name(base: str) -> str:
    """A view name of this call only (concurrent callers never collide)."""
    import uuid
    return f"{base}_{uuid.uuid4().hex[:12]}"


def band_filter(spark, sf_dir):
    view = _view_name("part")
    select.register_views(spark, {view: load(spark, sf_dir, "part")})
    try:
        return select.run_sql(spark, BAND_SQL.format(view=view))   # analysed here
    finally:
        spark.catalog.dropTempView(view)


# --- S1 D1 -------------------------------------------------------------------

def text_scan(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    out = session.scratch_path(spark, "text_scan")
    (part.select(F.concat_ws(" ", "p_partkey", "p_brand", "p_size").alias("value"))
     .write.text(out))
    return text.read_delimited(spark, out, text.PEOPLE_SCHEMA).good


def people_flow(spark, sf_dir):
    """The full batch flow over part-derived text: scan, view, SQL range,
    string maps; then the text folder is replaced by the parsed table."""
    from .flows import range_report, save_parsed
    part = load(spark, sf_dir, "part")
    lines = session.scratch_path(spark, "people")
    part.select(F.concat_ws(" ", "p_partkey", "p_brand", "p_size").alias("value")).write.text(lines)
    report = session.scratch_path(spark, "people_report")
    view = _view_name("person")
    range_report(spark, lines, BAND_LO, BAND_HI, view=view).write.parquet(report)
    spark.catalog.dropTempView(view)
    save_parsed(spark, lines)
    m = spark.read.parquet(report)
    return m.select(F.col("m")["id"].alias("id"), F.col("m")["name"].alias("name"),
                    F.col("m")["age"].alias("age"))


# --- P3 ----------------------------------------------------------------------

def string_map(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    m = part.select("p_partkey", rows.to_string_map("p_name", "p_size").alias("m"))
    return m.select("p_partkey", F.col("m")["p_name"].alias("name"),
                    F.col("m")["p_size"].alias("size_text"))


# --- P4 ----------------------------------------------------------------------

def double_add(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     rows.add_doubles("l_discount", "l_tax").alias("disc_plus_tax"))


# --- P5 P6 -------------------------------------------------------------------

def json_round_trip(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    body = ev.select(rows.to_json_event(["event_id", "user_id", "event_type", "value"]).alias("body"))
    m = body.select(rows.parse_event("body").alias("m"))
    return m.select(F.col("m")["event_id"].cast("bigint").alias("event_id"),
                    F.col("m")["user_id"].cast("bigint").alias("user_id"),
                    F.col("m")["event_type"].alias("event_type"),
                    F.col("m")["value"].cast("double").alias("value"))


def json_field(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", rows.parse_event("props")["k"].alias("k"))


# --- P7 ----------------------------------------------------------------------

def nonempty_body(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    # The address needs an '@': texts without one skip the regex (same result).
    email = F.when(F.instr("text", "@") > 0, F.regexp_extract("text", EMAIL_PATTERN, 0)) \
        .otherwise(F.lit(""))
    bodies = docs.select("doc_id", email.alias("body"))
    return bodies.filter(rows.is_nonempty("body"))


# --- P8 P9 -------------------------------------------------------------------

def bind_params(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    body = ev.select("event_id", rows.to_json_event(["event_id", "value"]).alias("body"))
    names = rows.split_param_names("value,missing")
    text_names = rows.split_param_names("event_id,value,missing")   # the key is bound reversed
    # decode once per form, then bind (binding on the parse expression
    # itself would parse the body again for every parameter)
    decoded = body.select("event_id",
                          rows.parse_event("body", "event_id bigint, value double, missing string")
                          .alias("typed"),
                          rows.parse_event("body").alias("as_map"))
    return decoded.select("event_id",
                          *rows.bind_params("typed", names, prefix="p"),
                          *rows.bind_params("as_map", text_names, as_text=True, prefix="t",
                                            reverse_field="event_id"))


# --- P10 ---------------------------------------------------------------------

def reverse_key(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", rows.reverse_key("event_id").alias("rowkey"))


# --- P10 P11 K5 --------------------------------------------------------------

def _user_events(ev: DataFrame) -> DataFrame:
    """Events as JSON bodies keyed by user; ``amount`` only on purchases, so
    the field is absent (not null) on every other event."""
    amount = F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount")
    body = rows.to_json_event(["user_id", "event_type", "amount"], keep_nulls=False)
    return ev.select("ts", "event_id", "user_id", "event_type", amount) \
        .select("ts", "event_id", body.alias("body"))


def cell_upsert(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    bodies = _user_events(ev)
    decoded = bodies.select("ts", "event_id", rows.parse_event("body").alias("m"))
    path = session.scratch_path(spark, "cells")
    order = ["ts", "event_id"]
    # Deliver the later half first: the put must keep the latest by order,
    # not by arrival.
    for part in [windows.read_since(decoded, "ts", HALF_SPLIT),
                 windows.read_until(decoded, "ts", HALF_SPLIT)]:
        batch = cells.event_cells(part, "m", "user_id", CELL_FAMILY, order=order)
        cells.put_cells(spark, path, batch, order)
    return spark.read.parquet(path).select("rowkey", "family", "qualifier", "value", "event_id")


def cell_dense(spark, sf_dir):
    """Dense form: every listed column of every event is a cell."""
    ev = load(spark, sf_dir, "events").select("ts", "event_id", "user_id", "event_type", "value")
    path = session.scratch_path(spark, "cells_dense")
    order = ["ts", "event_id"]
    for part in [windows.read_since(ev, "ts", HALF_SPLIT), windows.read_until(ev, "ts", HALF_SPLIT)]:
        batch = cells.column_cells(part, "user_id", ["user_id", "event_type", "value"], CELL_FAMILY,
                                   order=order)
        cells.put_cells(spark, path, batch, order)
    return spark.read.parquet(path).select("rowkey", "family", "qualifier", "value", "event_id")


# --- P12 P13 -----------------------------------------------------------------

def template_rows(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    result = rows.text_equals("user_id", TEMPLATE_KEY)
    parts = [fixed.TEMPLATE_OPEN + "\n", result, "\n" + fixed.TEMPLATE_CLOSE]
    return ev.select("event_id", rows.render_template(parts).alias("rendered"))


def template_text(spark, sf_dir):
    """The template, given as text, filled in for every turn."""
    turns = load(spark, sf_dir, "conversations")
    names = {"map": F.create_map(F.lit("id"), "turn")}
    return turns.select("conv_id", "turn", templates.compile_template(fixed.TEMPLATE_TEXT, names).alias("rendered"))


# --- P5 P6 without a schema ----------------------------------------------------

def variant_events(spark, sf_dir):
    """Nested bodies with a field twice, numbers whose text counts, and some with text
    after the object, which are left out."""
    turns = load(spark, sf_dir, "conversations")
    body = F.concat(
        F.lit('{"a":0,"conv":{"id":'), "conv_id", F.lit(',"turn":'), "turn", F.lit('},"tags":['),
        F.to_json(F.array("role")), F.lit(","), "turn", F.lit(',null],"price":'), "conv_id",
        F.lit('.50,"a":'), "turn", F.lit("}"), F.when(F.col("turn") % 5 == 4, " x").otherwise(""))
    made = turns.select(body.alias("body"))
    event = variants.decode_variants(made, numbers="text").where(F.col("event").isNotNull())
    return event.select(*[variants.field("event", path, kind).alias(name) for name, path, kind in (
        ("conv_id", "$.conv.id", "bigint"), ("turn", "$.conv.turn", "bigint"), ("role", "$.tags[0][0]", "string"),
        ("price", "$.price", "string"), ("a", "$.a", "bigint"))])


# --- X1 ----------------------------------------------------------------------

def _pairs(ev: DataFrame) -> DataFrame:
    return ev.select("user_id", "event_type", F.hour("ts").alias("hr"), "ts")


def intersect_keys(spark, sf_dir):
    ev = _pairs(load(spark, sf_dir, "events"))
    first = windows.read_until(ev, "ts", HALF_SPLIT).select("user_id", "event_type", "hr")
    # Same names, other positions: matched by name.
    second = windows.read_since(ev, "ts", HALF_SPLIT).select("hr", "event_type", "user_id")
    return groups.intersect_by_name(first, second)


# --- X2 ----------------------------------------------------------------------

def group_complete(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return groups.complete_groups(li, "l_orderkey", "l_returnflag", REQUIRED_FLAGS)


# --- S3 (file form) ----------------------------------------------------------

def window_read(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return windows.read_window(ev, "ts", DAY_LO, DAY_HI) \
        .select("event_id", "user_id", "event_type", "value")


# --- K4 (file table) ---------------------------------------------------------

def keyed_upsert(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    path = session.scratch_path(spark, "upsert")
    order = ["ts", "event_id"]
    base = windows.read_until(ev, "ts", HALF_SPLIT)
    updates = windows.read_since(ev, "ts", HALF_SPLIT)
    upsert.upsert_table(spark, path, base, ["user_id"], order)
    upsert.upsert_table(spark, path, updates, ["user_id"], order)
    return spark.read.parquet(path).select("user_id", "event_id", "event_type", "value")


def partial_update(spark, sf_dir):
    """An update that names some columns: existing keys change, new keys are
    not added, and the column it does not name (``event_type``) stays."""
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    path = session.scratch_path(spark, "partial_update")
    order = ["ts", "event_id"]
    upsert.upsert_table(spark, path, windows.read_until(ev, "ts", HALF_SPLIT), ["user_id"], order)
    updates = windows.read_since(ev, "ts", HALF_SPLIT).drop("event_type")
    upsert.upsert_table(spark, path, updates, ["user_id"], order, mode="update")
    return spark.read.parquet(path).select("user_id", "event_id", "event_type", "value")


# --- K4 K5 with deltas ---------------------------------------------------------

TURN_PARTS = 6
TURN_BUCKET_BYTES = 512 * 1024      # small, so that a test table splits its buckets


def _turn_part(part: int) -> Column:
    return F.pmod(F.col("conv_id") * 31 + F.col("turn"), F.lit(TURN_PARTS)) == part


def delta_upsert(spark, sf_dir):
    """The latest turn of each conversation: turns arrive as JSON bodies in a stream,
    a delta a batch; the last batch is replayed, and an old one comes again."""
    turns = load(spark, sf_dir, "conversations")
    root = session.scratch_path(spark, "delta_upsert")
    src, ckpt = f"{root}/in", f"{root}/checkpoint"
    table = keyed.KeyedTable(spark, f"{root}/table", ["conv_id"], ["turn"], bucket_bytes=TURN_BUCKET_BYTES)
    body = rows.to_json_event(["conv_id", "turn", "role", "text"]).alias("body")
    source_files.stage_files(turns.select(body), src)
    schema = "conv_id bigint, turn bigint, role string, text string"
    fn = delivery.upsert_batch(table.path, table.keys, table.order, body_col="body", schema=schema, table=table)
    _stream_with_replay(spark, src, "body string", ckpt, fn)
    table.apply(turns.where(_turn_part(0)))
    return table.read().select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha"))


def delta_growth(spark, sf_dir):
    """A keyed table that begins with few rows and grows over several batches: full
    buckets split, and the first batch, applied again, changes nothing."""
    turns = load(spark, sf_dir, "conversations")
    table = keyed.KeyedTable(spark, session.scratch_path(spark, "delta_growth"), ["conv_id", "turn"], ["role"],
                             bucket_bytes=TURN_BUCKET_BYTES)
    first = turns.where("conv_id % 100 = 0")
    for batch in [first, *[turns.where(_turn_part(i)) for i in range(TURN_PARTS)], first]:
        table.apply(batch)
    return table.read().select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha"))


def delta_cells(spark, sf_dir):
    """Cells in a keyed table with deltas: for each conversation and role, the latest
    text; a row's cells lie in one bucket."""
    turns = load(spark, sf_dir, "conversations")
    table = keyed.KeyedTable(spark, session.scratch_path(spark, "delta_cells"), ["rowkey", "family", "qualifier"],
                             ["turn"], bucket_bytes=TURN_BUCKET_BYTES, hashed=["rowkey"])
    for part in (2, 0, 1):
        one = turns.where(F.col("turn") % 3 == part).select(
            "conv_id", "turn", F.create_map("role", F.coalesce("text", F.lit(""))).alias("m"))
        made = cells.event_cells(one.withColumn("m", F.map_concat("m", F.create_map(
            F.lit("conv_id"), F.col("conv_id").cast("string")))), "m", "conv_id", CELL_FAMILY, order=["turn"])
        table.apply(made)
    return table.read().select("rowkey", "family", "qualifier", "turn", F.sha2("value", 256).alias("value_sha"))


# --- K2 with versions ----------------------------------------------------------

def versioned_overwrite(spark, sf_dir):
    """A table is overwritten by a job that reads it, while a reader that was opened
    before goes on reading the version it opened."""
    path = session.scratch_path(spark, "versioned_overwrite")
    versions.overwrite(load(spark, sf_dir, "conversations"), path)
    reader = versions.read(spark, path)
    versions.overwrite(reader.where("role = 'assistant'").withColumn("turn", F.col("turn") + 1000), path)
    old = reader.select(F.lit(0).alias("version"), "conv_id", "turn", "role")
    return old.unionByName(versions.read(spark, path).select(F.lit(1).alias("version"), "conv_id", "turn", "role"))


# --- K2 K6 -------------------------------------------------------------------

def staged_overwrite(spark, sf_dir):
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    path = session.scratch_path(spark, "overwrite")
    part.write.parquet(path)
    current = spark.read.parquet(path)
    grown = current.unionByName(tables.literal_rows(spark, current, [(-1, "aa")]))
    files.staged_overwrite(grown, path)
    return spark.read.parquet(path)


# --- S3 S5 T1 ----------------------------------------------------------------

DAY = timedelta(days=1)
WINDOWS_PER_BATCH = 10
SKEW_FILE_BYTES = 4 * 1024 * 1024        # small, so that a test table's window is split


def _stamped_windows(out: str):
    """Deliver (event_id, value, window start as text) keyed by window id."""
    def deliver(df, pending):
        stamped = df.select("event_id", "value", ingest.WINDOW_COL, "ts",
                            F.date_format("window_lo", "yyyy-MM-dd HH:mm:ss").alias("window_lo"))
        ingest.write_windows(stamped, out, windows=pending, time_col="ts", drop_time=True)
    return deliver


def window_replay(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    root = session.scratch_path(spark, "windows")
    control = ingest.ControlTable(spark, f"{root}/control")
    out = f"{root}/out"
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    start = lo.replace(hour=0, minute=0, second=0, microsecond=0)
    now = hi + timedelta(seconds=1)              # the poll runs after the last row
    mid = start + DAY * ((now - start).days // 2)   # first poll: the first half of the days

    deliver = _stamped_windows(out)

    ingest.run_windows(spark, "events", ev, "ts", control, deliver, start, mid, DAY)
    try:                                         # crash between write and mark
        ingest.run_windows(spark, "events", ev, "ts", control, deliver, start, now, DAY,
                           stop_after_write=True)
    except ingest.StopAfterWrite:
        pass
    ingest.run_windows(spark, "events", ev, "ts", control, deliver, start, now, DAY)
    return spark.read.parquet(out).select("event_id", "value", "window_lo")


def window_skew(spark, sf_dir):
    """The turns of all conversations as one uneven run of windows: nearly all rows
    fall into one window and a third of them on one instant. Large windows are
    written by several tasks, in files of bounded size; a replay replaces them."""
    turns = load(spark, sf_dir, "conversations")
    n = F.length(F.coalesce("text", F.lit("")))
    second = F.when(n % 3 == 0, F.lit(0)).otherwise((F.col("conv_id") * 7919 + F.col("turn") * 104729) % 90_000)
    start = datetime(2024, 1, 1)
    stamped = turns.withColumn("ts", F.timestamp_add("SECOND", second, F.lit(start).cast("timestamp_ntz")))
    root = session.scratch_path(spark, "window_skew")
    control, out = ingest.ControlTable(spark, f"{root}/control"), f"{root}/out"

    def deliver(df, pending):
        ingest.write_windows(df.select("conv_id", "turn", "text", "ts", ingest.WINDOW_COL), out, windows=pending,
                             time_col="ts", target_bytes=SKEW_FILE_BYTES)

    for crash in (True, False):
        try:
            ingest.run_windows(spark, "turns", stamped, "ts", control, deliver, start, start + 3 * DAY, DAY,
                               stop_after_write=crash)
        except ingest.StopAfterWrite:
            pass
    return spark.read.parquet(out).select("conv_id", "turn", F.col(ingest.WINDOW_COL).cast("bigint").alias("window_id"),
                                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha"))


def window_stream(spark, sf_dir):
    """The same windows run by Structured Streaming: a window source whose
    checkpoint is the mark; two polls (the second sees more time) and a
    replay of the last batch."""
    from ..streaming import window_source
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    root = session.scratch_path(spark, "window_stream")
    out, ckpt = f"{root}/out", f"{root}/checkpoint"
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    start = lo.replace(hour=0, minute=0, second=0, microsecond=0)
    end = hi.replace(hour=0, minute=0, second=0, microsecond=0) + DAY   # the last day is complete
    mid = start + DAY * ((end - start).days // 2)

    deliver = _stamped_windows(out)

    fn = window_source.windows_batch(ev, "ts", DAY, deliver)
    for i, poll_end in enumerate((mid, end, end)):
        # fewer windows a batch than are pending: delivered over several runs
        delivery.start_delivery(window_source.window_stream(
            spark, start, DAY, end=poll_end, max_windows=WINDOWS_PER_BATCH), ckpt, fn).awaitTermination()
        if i == 1:
            _drop_last_commit(spark, ckpt)       # the third run replays the last batch
    return spark.read.parquet(out).select("event_id", "value", "window_lo")


# --- S4 S6 T2 T4 -------------------------------------------------------------

def _drop_last_commit(spark, checkpoint):
    from .. import paths
    done = [n for n in paths.list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if done:
        last = max(done, key=int)
        paths.delete(spark, f"{checkpoint}/commits/{last}")


def _stream_with_replay(spark, src, schema, ckpt, batch_fn):
    """Drain the folder ``src`` one file per batch, lose the last batch's
    acknowledgement, and run again: the second run replays that batch, the
    third finds no new file and changes nothing."""
    for i in range(3):
        stream = delivery.read_file_stream(spark, src, schema, max_files_per_trigger=1)
        delivery.start_delivery(stream, ckpt, batch_fn).awaitTermination()
        if i == 0:
            _drop_last_commit(spark, ckpt)


def file_stream(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "value")
    root = session.scratch_path(spark, "file_stream")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    source_files.stage_files(ev, src)
    _stream_with_replay(spark, src, ev.schema, ckpt, delivery.delivery_batch(out))
    return spark.read.parquet(out).select("event_id", "value")


def stream_upsert(spark, sf_dir):
    """K4 in a stream: each micro-batch is merged into a keyed table."""
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    root = session.scratch_path(spark, "upsert_stream")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    source_files.stage_files(ev, src)
    fn = delivery.upsert_batch(out, ["user_id"], ["ts", "event_id"])
    _stream_with_replay(spark, src, ev.schema, ckpt, fn)
    return spark.read.parquet(out).select("user_id", "event_id", "event_type", "value")


# --- S3 S5 T1 P5 -> S6 T2 P6 P10 P11 K5: the whole ingest-to-cells pipeline --

EVENT_SCHEMA = "body string, ts timestamp_ntz, event_id bigint"


def ingest_to_cells(spark, sf_dir):
    """Source table -> windowed ingest of JSON events (the order columns ride
    next to the body) -> file stream -> decode -> cells -> cell put."""
    ev = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    root = session.scratch_path(spark, "ingest_cells")
    inbox, table, ckpt = f"{root}/inbox", f"{root}/cells", f"{root}/checkpoint"
    control = ingest.ControlTable(spark, f"{root}/control")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    start = lo.replace(hour=0, minute=0, second=0, microsecond=0)

    def to_inbox(df, pending):
        body = rows.to_json_event(["user_id", "event_type", "value"]).alias("body")
        ingest.write_windows(df.select(body, "ts", "event_id", ingest.WINDOW_COL), inbox, windows=pending,
                             time_col="ts")

    ingest.run_windows(spark, "events", ev, "ts", control, to_inbox, start,
                       hi + timedelta(seconds=1), DAY * 7)
    order = ["ts", "event_id"]

    def put(batch, batch_id):
        decoded = delivery.decode_bodies(batch, "body").good
        cells.put_cells(batch.sparkSession, table,
                        cells.event_cells(decoded, "event", "user_id", CELL_FAMILY, order), order)

    stream = delivery.read_file_stream(spark, inbox, EVENT_SCHEMA, max_files_per_trigger=None)
    delivery.start_delivery(stream, ckpt, put).awaitTermination()
    return spark.read.parquet(table).select("rowkey", "family", "qualifier", "value", "event_id")


# --- T3 ----------------------------------------------------------------------

MIXED_SCHEMA = "event_id bigint, value double"


def _mixed_bodies(spark, sf_dir):
    """Events as JSON bodies, mixed with bodies that are not JSON (prose), that
    hold a text where a number belongs, and that lack the key."""
    ev = load(spark, sf_dir, "events")
    good = ev.select(rows.to_json_event(["event_id", "value"]).alias("body"))
    typed = ev.select(F.concat(F.lit('{"event_id":"x'), "event_id", F.lit('","value":1.5}')).alias("body"))
    keyless = ev.select(F.concat(F.lit('{"event_id":null,"user":'), "user_id", F.lit("}")).alias("body"))
    docs = load(spark, sf_dir, "documents").select(F.col("text").alias("body"))
    return good.unionByName(typed).unionByName(keyless).unionByName(docs)


def _mixed_decoded(spark, sf_dir):
    return delivery.decode_bodies(_mixed_bodies(spark, sf_dir), "body", MIXED_SCHEMA,
                                  on_bad=delivery.ON_BAD_QUARANTINE, required=["event_id"])


def quarantine(spark, sf_dir):
    return _mixed_decoded(spark, sf_dir).good.select("event.event_id", "event.value")


def quarantined(spark, sf_dir):
    return _mixed_decoded(spark, sf_dir).bad.select(
        F.sha2("body", 256).alias("body_sha"), F.length("body").alias("body_len"))


def stream_quarantine(spark, sf_dir):
    """Decode, bind and insert in a stream; failing events are kept apart."""
    root = session.scratch_path(spark, "quarantine_stream")
    src, out, bad, ckpt = f"{root}/in", f"{root}/out", f"{root}/bad", f"{root}/checkpoint"
    source_files.stage_files(_mixed_bodies(spark, sf_dir), src)
    names = rows.split_param_names("event_id,value")
    fn = delivery.delivery_batch(out, lambda good: good.select(*rows.bind_params("event", names)),
                                 quarantine_path=bad, body_col="body", schema=MIXED_SCHEMA,
                                 required=["event_id"])
    _stream_with_replay(spark, src, "body string", ckpt, fn)
    good = spark.read.parquet(out).select("p1", "p2", F.lit(None).cast("string").alias("body_sha"))
    return good.unionByName(spark.read.parquet(bad).select(
        F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("double").alias("p2"),
        F.sha2("body", 256).alias("body_sha")))


# --- P9 P10 K4: text parameters, reversed key, keyed table --------------------

def param_upsert(spark, sf_dir):
    """JSON stream bound as text, the key reversed, merged by that key."""
    ev = load(spark, sf_dir, "events")
    root = session.scratch_path(spark, "param_upsert")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    body = rows.to_json_event(["user_id", "event_type", "value"]).alias("body")
    source_files.stage_files(ev.select(body, "ts", "event_id"), src)
    names = rows.split_param_names("user_id,event_type,value,missing")
    bound = rows.bind_params("event", names, as_text=True, prefix="t", reverse_field="user_id")
    fn = delivery.upsert_batch(out, ["t1"], ["ts", "event_id"], body_col="body",
                               columns=[*bound, "ts", "event_id"])
    _stream_with_replay(spark, src, EVENT_SCHEMA, ckpt, fn)
    return spark.read.parquet(out).select("t1", "t2", "t3", "t4", "event_id")


# --- T1 T2: a replay without rows ----------------------------------------------

def replay_empty(spark, sf_dir):
    """Batches keyed by id; the replay of one has no rows, so none of it stays."""
    ev = load(spark, sf_dir, "events").select("event_id", "value")
    out = session.scratch_path(spark, "replay_empty")
    for batch_id in range(4):
        delivery.write_batch(ev.where(F.col("event_id") % 4 == batch_id), out, batch_id)
    delivery.write_batch(ev.where("false"), out, 2)
    return spark.read.parquet(out).select("event_id", "value")


# --- X2 stream form -----------------------------------------------------------

def stream_complete(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    root = session.scratch_path(spark, "complete_stream")
    src, out, state, ckpt = f"{root}/in", f"{root}/out", f"{root}/state", f"{root}/checkpoint"
    source_files.stage_files(li, src)
    # state: one small row per order; size its buckets from the key column
    buckets = choose_buckets(estimated_bytes(li.select("l_orderkey")))
    fn = completeness.completeness_batch(state, out, "l_orderkey", "l_returnflag", REQUIRED_FLAGS,
                                         buckets=buckets)
    _stream_with_replay(spark, src, li.schema, ckpt, fn)
    # explicit schema: the folder holds no data file when nothing completed
    return spark.read.schema("l_orderkey bigint, batch_id bigint").parquet(out).select("l_orderkey")


# --- T3 with retries -------------------------------------------------------------

def stream_retry(spark, sf_dir):
    """Turns as JSON bodies; those of assistants decode from the third batch on, and
    first turns are sent as plain prose, which never does. Failing bodies are offered
    again with the next batch and set aside after three attempts."""
    turns = load(spark, sf_dir, "conversations")
    root = session.scratch_path(spark, "stream_retry")
    out = f"{root}/out"
    prose = F.concat(F.lit("prose "), "conv_id", F.lit(" "), F.coalesce("text", F.lit("")))
    body = F.when(F.col("turn") == 0, prose).otherwise(rows.to_json_event(["conv_id", "turn", "role"]))
    bodies = turns.select("conv_id", "turn", body.alias("body"))
    ledger = retry.RetryLedger(spark, f"{root}/ledger")

    def decode(df, batch_id):
        event = rows.strict_event("body", "conv_id bigint, turn bigint, role string", required=["conv_id"])
        return event if batch_id >= 2 else F.when(event["role"] != "assistant", event)

    fn = retry.retry_batch(out, ledger, decode, lambda good: good.select("event.*"))
    for i in [0, 1, 2, 2, 3, 4, 5, 6, 7]:      # a replay; the last two batches have no events of their own
        fn(bodies.where(_turn_part(i)).select("body"), i)
    landed = spark.read.schema("conv_id bigint, turn bigint, role string, batch_id bigint").parquet(out)
    aside = ledger.read().where(F.col("state") == retry.ASIDE)
    return landed.select("conv_id", "turn", F.lit("landed").alias("state"), F.lit(None).cast("string").alias("body_sha")) \
        .unionByName(aside.select(F.lit(None).cast("bigint").alias("conv_id"), F.lit(None).cast("bigint").alias("turn"),
                                  "state", F.col("body_hash").alias("body_sha")))


# --- S5 with late rows -------------------------------------------------------------

def late_rows(spark, sf_dir):
    """Daily windows of turns; a third of the rows appears at the source after their
    windows were delivered, and some rows are gone by then. The windows whose
    fingerprint changed are delivered again."""
    turns = load(spark, sf_dir, "conversations")
    start = datetime(2024, 1, 1)
    second = (F.col("conv_id") * 7919 + F.col("turn") * 104729) % 2_000_000
    stamped = turns.select("conv_id", "turn", "role", F.timestamp_add(
        "SECOND", second, F.lit(start).cast("timestamp_ntz")).alias("ts"))
    early = stamped.where(F.col("conv_id") % 3 != 0)
    now = stamped.where(F.col("conv_id") % 50 != 1)
    root = session.scratch_path(spark, "late_rows")
    control, prints = ingest.ControlTable(spark, f"{root}/control"), reconcile.Fingerprints(spark, f"{root}/prints")
    out = f"{root}/out"

    def deliver(df, pending):
        ingest.write_windows(df.select("conv_id", "turn", "role", "ts", ingest.WINDOW_COL), out, windows=pending,
                             time_col="ts")

    for end in (start + 10 * DAY, start + 24 * DAY):
        reconcile.run_windows_with_prints(spark, "turns", early, "ts", control, prints, deliver, start, end, DAY)
    reconcile.reconcile(spark, "turns", now, "ts", control, prints, deliver)
    return spark.read.parquet(out).select("conv_id", "turn", "role",
                                          F.col(ingest.WINDOW_COL).cast("bigint").alias("window_id"))


def stream_complete_state(spark, sf_dir):
    """Conversations in which both sides have spoken, by Spark's state store, with
    files admitted by their bytes."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    root = session.scratch_path(spark, "complete_state")
    src, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/checkpoint"
    source_files.stage_files(turns, src)
    most = max(1, paths.size(spark, src) // 3)
    for i in range(3):
        stream = delivery.read_file_stream(spark, src, turns.schema, max_bytes_per_trigger=most)
        completeness.start_complete(stream, ckpt, out, "conv_id", "role", ["user", "assistant"]).awaitTermination()
        if i == 0:
            _drop_last_commit(spark, ckpt)
    return spark.read.schema("conv_id bigint, batch_id bigint").parquet(out).select("conv_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "band_filter": band_filter,
    "text_scan": text_scan,
    "people_flow": people_flow,
    "string_map": string_map,
    "double_add": double_add,
    "json_round_trip": json_round_trip,
    "json_field": json_field,
    "nonempty_body": nonempty_body,
    "bind_params": bind_params,
    "reverse_key": reverse_key,
    "cell_upsert": cell_upsert,
    "cell_dense": cell_dense,
    "template_rows": template_rows,
    "template_text": template_text,
    "variant_events": variant_events,
    "intersect_keys": intersect_keys,
    "group_complete": group_complete,
    "window_read": window_read,
    "keyed_upsert": keyed_upsert,
    "staged_overwrite": staged_overwrite,
    "window_replay": window_replay,
    "window_skew": window_skew,
    "window_stream": window_stream,
    "file_stream": file_stream,
    "stream_upsert": stream_upsert,
    "ingest_to_cells": ingest_to_cells,
    "quarantine": quarantine,
    "quarantined": quarantined,
    "stream_complete": stream_complete,
    "partial_update": partial_update,
    "stream_quarantine": stream_quarantine,
    "param_upsert": param_upsert,
    "replay_empty": replay_empty,
    "stream_complete_state": stream_complete_state,
    "stream_retry": stream_retry,
    "late_rows": late_rows,
    "delta_upsert": delta_upsert,
    "delta_growth": delta_growth,
    "delta_cells": delta_cells,
    "versioned_overwrite": versioned_overwrite,
}


_TS_SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"
_BAD_BODIES = ("SELECT text AS body FROM documents UNION ALL "
               "SELECT '{\"event_id\":\"x' || event_id || '\",\"value\":1.5}' FROM events UNION ALL "
               "SELECT '{\"event_id\":null,\"user\":' || user_id || '}' FROM events")
_LATEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"

ORACLE_SQL: dict[str, str] = {
    "band_filter": BAND_SQL.format(view="part"),
    "text_scan": "SELECT p_partkey AS id, p_brand AS name, p_size AS age FROM part",
    "people_flow": (
        "SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS name, CAST(p_size AS VARCHAR) AS age "
        f"FROM part WHERE p_size >= {BAND_LO} AND p_size <= {BAND_HI}"),
    "string_map": "SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS size_text FROM part",
    "double_add": "SELECT l_orderkey, l_linenumber, l_discount + l_tax AS disc_plus_tax FROM lineitem",
    "json_round_trip": "SELECT event_id, user_id, event_type, value FROM events",
    "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "nonempty_body": (
        "SELECT doc_id, body FROM (SELECT doc_id, "
        f"regexp_extract(text, '{EMAIL_PATTERN}', 0) AS body FROM documents) "
        "WHERE body IS NOT NULL AND length(body) > 0"),
    "bind_params": (
        "SELECT event_id, value AS p1, CAST(NULL AS VARCHAR) AS p2, "
        "reverse(CAST(event_id AS VARCHAR)) AS t1, CAST(value AS VARCHAR) AS t2, 'null' AS t3 "
        "FROM events"),
    "reverse_key": "SELECT event_id, reverse(CAST(event_id AS VARCHAR)) AS rowkey FROM events",
    "cell_upsert": (
        "WITH ev AS (SELECT reverse(CAST(user_id AS VARCHAR)) AS rowkey, ts, event_id, user_id, "
        "event_type, CASE WHEN event_type = 'purchase' THEN value END AS amount FROM events), "
        "c AS (SELECT rowkey, 'user_id' AS qualifier, CAST(user_id AS VARCHAR) AS value, ts, event_id FROM ev "
        "UNION ALL SELECT rowkey, 'event_type', event_type, ts, event_id FROM ev "
        "UNION ALL SELECT rowkey, 'amount', CAST(amount AS VARCHAR), ts, event_id FROM ev "
        "WHERE amount IS NOT NULL) "
        f"SELECT rowkey, '{CELL_FAMILY}' AS family, qualifier, value, event_id FROM c "
        "QUALIFY row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY ts DESC, event_id DESC) = 1"),
    "cell_dense": (
        "WITH ev AS (SELECT reverse(CAST(user_id AS VARCHAR)) AS rowkey, ts, event_id, user_id, "
        "event_type, value FROM events), "
        "c AS (SELECT rowkey, 'user_id' AS qualifier, CAST(user_id AS VARCHAR) AS value, ts, event_id FROM ev "
        "UNION ALL SELECT rowkey, 'event_type', event_type, ts, event_id FROM ev "
        "UNION ALL SELECT rowkey, 'value', CAST(value AS VARCHAR), ts, event_id FROM ev) "
        f"SELECT rowkey, '{CELL_FAMILY}' AS family, qualifier, value, event_id FROM c "
        "QUALIFY row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY ts DESC, event_id DESC) = 1"),
    "template_rows": (
        f"SELECT event_id, '{fixed.TEMPLATE_OPEN}' || chr(10) || "
        f"CAST((CAST(user_id AS VARCHAR) = '{TEMPLATE_KEY}') AS VARCHAR) || chr(10) || '{fixed.TEMPLATE_CLOSE}' "
        "AS rendered FROM events"),
    "template_text": (
        "SELECT conv_id, turn, '<?xml version=\"1.0\" encoding=\"UTF-8\"?>' || chr(10) || '<test>' || chr(10) || "
        "CAST(turn = 2 AS VARCHAR) || chr(10) || '</test>' AS rendered FROM conversations"),
    "variant_events": (
        "SELECT conv_id, turn, role, conv_id || '.50' AS price, turn AS a FROM conversations WHERE turn % 5 <> 4"),
    "intersect_keys": (
        "SELECT user_id, event_type, CAST(hour(ts) AS INTEGER) AS hr FROM events "
        f"WHERE ts < {_TS_SPLIT} "
        "INTERSECT "
        "SELECT user_id, event_type, CAST(hour(ts) AS INTEGER) AS hr FROM events "
        f"WHERE ts >= {_TS_SPLIT}"),
    "group_complete": (
        "SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R') "
        "GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 2"),
    "window_read": (
        "SELECT event_id, user_id, event_type, value FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 00:00:00'"),
    "keyed_upsert": (
        "SELECT user_id, event_id, event_type, value FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"),
    "staged_overwrite": "SELECT p_partkey, p_name FROM part UNION ALL SELECT -1 AS p_partkey, 'aa' AS p_name",
    "window_replay": (
        "SELECT event_id, value, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_lo "
        "FROM events"),
    "window_skew": (
        "SELECT conv_id, turn, CAST(CASE WHEN length(coalesce(text, '')) % 3 = 0 THEN 0 "
        "ELSE ((conv_id * 7919 + turn * 104729) % 90000) // 86400 END AS BIGINT) AS window_id, "
        "sha256(coalesce(text, '')) AS text_sha FROM conversations"),
    "file_stream": "SELECT event_id, value FROM events",
    "stream_upsert": (
        "SELECT user_id, event_id, event_type, value FROM events "
        "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"),
    "quarantine": "SELECT event_id, value FROM events",
    "quarantined": (
        f"SELECT sha256(body) AS body_sha, CAST(length(body) AS INTEGER) AS body_len FROM ({_BAD_BODIES}) "
        "WHERE length(body) > 0"),
    "stream_quarantine": (
        "SELECT event_id AS p1, value AS p2, CAST(NULL AS VARCHAR) AS body_sha FROM events UNION ALL "
        f"SELECT NULL, NULL, sha256(body) FROM ({_BAD_BODIES}) WHERE length(body) > 0"),
    "partial_update": (
        f"WITH b AS (SELECT * FROM events WHERE ts < {_TS_SPLIT} {_LATEST}), "
        f"u AS (SELECT * FROM events WHERE ts >= {_TS_SPLIT} {_LATEST}) "
        "SELECT b.user_id, coalesce(u.event_id, b.event_id) AS event_id, b.event_type, "
        "CASE WHEN u.user_id IS NULL THEN b.value ELSE u.value END AS value "
        "FROM b LEFT JOIN u ON b.user_id = u.user_id"),
    "param_upsert": (
        "SELECT reverse(CAST(user_id AS VARCHAR)) AS t1, event_type AS t2, CAST(value AS VARCHAR) AS t3, "
        f"'null' AS t4, event_id FROM events {_LATEST}"),
    "stream_retry": (
        "SELECT conv_id, turn, 'landed' AS state, CAST(NULL AS VARCHAR) AS body_sha FROM conversations "
        "WHERE turn <> 0 UNION ALL "
        "SELECT NULL, NULL, 'aside', sha256('prose ' || conv_id || ' ' || coalesce(text, '')) "
        "FROM conversations WHERE turn = 0"),
    "late_rows": (
        "SELECT conv_id, turn, role, CAST(((conv_id * 7919 + turn * 104729) % 2000000) // 86400 AS BIGINT) "
        "AS window_id FROM conversations WHERE conv_id % 50 <> 1"),
    "stream_complete_state": (
        "SELECT conv_id FROM conversations WHERE role IN ('user', 'assistant') "
        "GROUP BY conv_id HAVING count(DISTINCT role) = 2"),
    "delta_upsert": (
        "SELECT conv_id, turn, role, sha256(text) AS text_sha FROM conversations "
        "QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1"),
    "delta_growth": "SELECT conv_id, turn, role, sha256(text) AS text_sha FROM conversations",
    "delta_cells": (
        "WITH c AS (SELECT conv_id, turn, role AS qualifier, coalesce(text, '') AS value FROM conversations "
        "UNION ALL SELECT conv_id, turn, 'conv_id', CAST(conv_id AS VARCHAR) FROM conversations) "
        f"SELECT reverse(CAST(conv_id AS VARCHAR)) AS rowkey, '{CELL_FAMILY}' AS family, qualifier, turn, "
        "sha256(value) AS value_sha FROM c "
        "QUALIFY row_number() OVER (PARTITION BY conv_id, qualifier ORDER BY turn DESC) = 1"),
    "versioned_overwrite": (
        "SELECT 0 AS version, conv_id, turn, role FROM conversations UNION ALL "
        "SELECT 1, conv_id, turn + 1000, role FROM conversations WHERE role = 'assistant'"),
    "replay_empty": "SELECT event_id, value FROM events WHERE event_id % 4 <> 2",
    "stream_complete": (
        "SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R') "
        "GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 2"),
}

# The pipeline delivers the same cells as the dense cell put.
ORACLE_SQL["ingest_to_cells"] = ORACLE_SQL["cell_dense"]
ORACLE_SQL["window_stream"] = ORACLE_SQL["window_replay"]
