"""Repeats by rows: ids that are shared or null, wide characters, clashing columns."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tidewater.llm import repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def word(r):
    return "".join(r.choice("abcdefghijäß€😀") for _ in range(r.randrange(2, 9)))


def expected(rows):
    """Covered words of each (doc_id, text) by role, over all windows of 50 words."""
    order = sorted({(repeats.NO_ID if d is None else d, t) for d, t in rows if t},
                   key=lambda x: (x[0], x[1]))
    seen = defaultdict(list)
    for place in order:
        w = place[1].split()
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].append((place, k))
    return {(p, k + i) for at in seen.values() for p, k in at[1:] for i in range(50)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_row_is_searched(spark, seed):
    r = random.Random(seed)
    passages = [[word(r) for _ in range(r.randrange(50, 160))] for _ in range(4)]
    rows = []
    for i in range(60):
        part = list(r.choice(passages))
        for _ in range(r.choice([0, 0, 1, 2])):
            part[r.randrange(len(part))] = word(r)
        cut = r.randrange(20)
        part = part[cut:len(part) - r.randrange(20)]
        rows.append((None if i == 41 else i // 2 * 10 + (0 if i % 4 < 2 else i % 2),
                     " ".join([*(word(r) for _ in range(r.randrange(30))), *part, *(word(r) for _ in range(r.randrange(30)))])))
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOCS).repartition(7)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")     # many carries between batches
    try:
        got = repeats.repeats(df).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    text_id = {(d, t): x for d, t, x in df.selectExpr("doc_id", "text", "xxhash64(text) AS x").collect()}
    # within one doc_id the order of texts is that of text_id, so compare those ids without order
    want, one_id = expected(rows), {d for d, _ in rows if sum(d == e for e, _ in rows) > 1}
    covered = set()
    for x in got:
        if x.role == "repeat":
            text = next(t for (d, t), i in text_id.items() if (d, i) == (x.doc_id, x.text_id))
            assert len(text.encode()[x.start_byte:x.end_byte].decode().split()) == x.n_words == x.end - x.start
            covered |= {((repeats.NO_ID if x.doc_id is None else x.doc_id, text), k) for k in range(x.start, x.end)}
    alone = lambda places: {p for p in places if p[0][0] not in one_id}
    assert alone(covered) == alone(want) and covered


def test_texts_of_one_id_are_cut_by_their_own_places(spark):
    r = random.Random(5)
    make = lambda n: " ".join(word(r) for _ in range(n))
    shared = make(60)
    clean = "ü" * 10 + " " + make(120)
    rows = [(1, f"{make(5)} {shared}"), (2, clean), (2, f"{make(80)} {shared} {make(3)}"), (None, f"é {shared} end"),
            (3, clean), (3, clean), (None, None), (4, ""), (5, f"{make(2)} {shared}  tail")]
    df = spark.createDataFrame([(d, t, [i], i, None if t is None else len(t), 1.5) for i, (d, t) in enumerate(rows)],
                               "doc_id long, text string, spans array<long>, t long, n_chars int, row double")
    out = {x.t: x for x in repeats.stage(spark, df, None).collect()}
    assert len(out) == len(rows)
    assert out[0].text == rows[0][1] and out[1].text == clean
    assert shared not in out[2].text and out[2].text.split() == (rows[2][1].replace(shared, "")).split()
    assert out[3].text == "é  end" and out[8].text.endswith("   tail")
    assert out[4].text == out[5].text == "" and out[4].n_chars == 0        # whole copies of row 1
    assert out[6].text is None and out[6].n_chars is None and out[7].text == ""
    assert all(x.n_chars == len(x.text) for x in out.values() if x.text is not None)
    assert all(x.spans == [x.t] and x.row == 1.5 for x in out.values())


def test_word_hashes_follow_words():
    r = random.Random(2)
    texts = [" ".join(word(r) for _ in range(300)), "x" * 70_000 + " " + "y" * 3 + "\t\n" + "x" * 70_000, "", None, " \n"]
    for t in texts:
        h, w = repeats.word_hashes(t), (t or "").split()
        assert len(h) == len(w)
        same = {}
        for a, b in zip(w, h.tolist()):
            assert same.setdefault(a, b) == b
        assert len(set(same.values())) == len(same)
    assert repeats.word_hashes("ab")[0] != repeats.word_hashes("ba")[0]
    h = repeats.word_hashes("a b c a b c")
    k = repeats.Ranges(h, "key")
    assert k(np.array([0]), np.array([3])) == k(np.array([3]), np.array([6]))
