"""Near-duplicate classes and removal by the row's own text."""

import random

from tidewater.llm import order_minhash

SCHEMA = "doc_id long, text string, row string, text_id int, class_id array<long>"


def test_texts_of_one_id_are_kept_and_removed_by_text(spark):
    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    a, b, c = text(200), text(200), text(90)
    near = " ".join([*a.split()[:-1], "other"])
    rows = [(0, a), (1, a), (1, b), (1, near), (2, b), (2, c), (None, a), (None, None), (3, None), (4, ""), (5, c), (5, c),
            (2, c), (6, "ü" + c)]
    docs = spark.createDataFrame([(d, t, "x", i, [1]) for i, (d, t) in enumerate(rows)], SCHEMA)
    out = order_minhash.stage(spark, docs, None)
    assert out.columns == docs.columns
    # copies and near copies of a later place go; b stays under id 1, c under id 2 with its repeated row
    assert sorted(x.text_id for x in out.collect()) == [0, 2, 5, 6, 7, 8, 12]
    got = {(x.doc_id, x.text_id): (x.class_id, x.class_text_id) for x in order_minhash.classes(docs).collect()}
    key = dict(docs.selectExpr("coalesce(text, '')", "xxhash64(coalesce(text, ''))").collect())
    assert len(got) == len({(d, t or "") for d, t in rows if d is not None})
    assert got[1, key[near]] == (0, key[a]) and got[1, key[a]] == (0, key[a])
    assert got[1, key[b]] == (1, key[b]) == got[2, key[b]]
    assert got[6, key["ü" + c]] == got[5, key[c]] == (2, key[c]) and got[4, key[""]] == (3, key[""])


def test_stage_of_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert order_minhash.stage(spark, docs, None).count() == 0
