"""Helpers of the training-data operators."""

from __future__ import annotations

import re

import pyarrow as pa

from tidewater.session import scratch_path

ASCII_LOWER = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NON_SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text):
    """Words of a text with A-Z lower-cased (bytes.lower touches ASCII only); null has none."""
    return ASCII_LOWER.findall((text or "").encode().lower())


def written(spark, df, tag):
    """Write df below the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.parquet(path)


def map_rows(df, schema, start):
    """mapInArrow over rows: start() is called once a task and returns a function
    that maps one row (a dict) to an iterable of tuples in the order of schema.
    Output leaves in batches of at most 2000 rows, so memory is bounded."""
    names = [x.split()[0].strip("`") for x in schema.split(", ")]

    def run(batches):
        fn, out = start(), []
        for b in batches:
            for at in range(0, b.num_rows, 500):
                for row in b.slice(at, 500).to_pylist():
                    for got in fn(row):
                        out.append(got)
                        if len(out) >= 2000:
                            yield to_batch(out)
                            out = []
        if out:
            yield to_batch(out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def to_batch(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, arrow.field(n).type) for c, n in zip(cols, names)], schema=arrow)

    return df.mapInArrow(run, schema)


def keep_rows(df, columns, start):
    """The rows of df, with all their columns, that are kept by the function that
    start() returns (called once a task; from a dict of the named columns to a bool)."""
    def run(batches):
        fn = start()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                yield part.filter(pa.array([fn(r) for r in part.select(columns).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
