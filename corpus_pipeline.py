"""Corpus pipeline: each stage gets the documents that its predecessor wrote."""

from __future__ import annotations

from tidewater.llm import decontaminate, kneser_ney, order_minhash, pack, repeats
from tidewater.session import scratch_path

STAGES = [
    ("quality_classifier", kneser_ney.stage),
    ("near_dedup", order_minhash.stage),
    ("suffix_dedup", repeats.stage),
    ("decontaminate", decontaminate.stage),
    ("pack", pack.stage),
]

# N-gram training, alignment and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
