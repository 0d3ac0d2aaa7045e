"""Stages keep columns whose names they use themselves."""

from pyspark.sql import functions as F

from tidewater.llm import decontaminate, kneser_ney, order_minhash, repeats

SF = "/root/testdata/sf0.001"
NAMES = ["perplexity", "band", "cuts", "cut", "kept", "row", "spans", "words", "d", "t", "h", "root", "_lang", "toxicity"]


def test_stages_keep_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in NAMES})
    for module in (kneser_ney, order_minhash, repeats, decontaminate):
        got, plain = module.stage(spark, more, SF), module.stage(spark, docs, SF)
        assert got.columns == more.columns
        rows = got.collect()
        assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((r.doc_id, r.text or "") for r in plain.collect())
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in NAMES)
