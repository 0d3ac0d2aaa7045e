import random
import re
from collections import Counter
from zlib import crc32

from tidewater.llm import permuterm

SCHEMA = "doc_id long, text string"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def result(spark, rows):
    return sorted([tuple(r) for r in permuterm.spelling_variants(spark.createDataFrame(rows, SCHEMA)).collect()],
                  key=repr)


def variants(rnd, word):
    i = rnd.randrange(len(word))
    c = rnd.choice("abcdeé")
    return rnd.choice([word[:i] + word[i + 1:], word[:i] + c + word[i:], word[:i] + c + word[i + 1:], word])


def test_matches_all_pairs(spark):
    rnd = random.Random(3)
    base = ["abcdefg", "aabbccdd", "aaaaaaaa", "distance", "élégance", "SEPARATE", "straßeßen"]
    rows = []
    for i in range(600):
        words = []
        for w in rnd.choices(base, weights=[50, 20, 8, 4, 3, 2, 1], k=8):
            for _ in range(rnd.choice([0, 0, 0, 0, 1, 2])):
                w = variants(rnd, w)
            words.append(w)
        rows.append((i, rnd.choice([" ", "-", "1", "\n"]).join(words)))
    got = result(spark, rows)
    assert got == brute(rows)
    assert any(r[1] for r in got) and any(r[4] > 5 for r in got)


def test_chain_of_forms(spark):
    texts = ["kettles " * 2, "kettled " * 25, "kettlxd " * 400]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert result(spark, rows) == brute(rows)
    assert [r[2] for r in result(spark, rows)] == ["kettlxd"] * 3


def test_ties_take_the_smaller_word(spark):
    rows = [(0, "variant " * 40 + "variang " * 40 + "varianz " * 2)]
    assert [r[1] for r in result(spark, rows) if r[0] == "varianz"] == ["variang"]
    assert result(spark, rows) == brute(rows)


def test_nulls_empty_and_long_texts(spark):
    long = "separately " * 120_000          # over a million characters
    rows = [(1, None), (2, ""), (None, "separately separatel× Élégance élégance"), (3, long),
            (3, long), (4, "sixsix sixsix")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "plainly plainly", 1, "w", "p")],
                               "doc_id long, text string, n long, word string, prefix string")
    assert [tuple(r) for r in permuterm.spelling_variants(df).collect()] == brute([(1, "plainly plainly")])


def test_groups_are_bounded_by_the_alphabet():
    turned = list(permuterm.rotations("aab"))
    assert len(turned) == 7
    assert [f for _, whole, f in turned if not whole] == [True, False, True]
