import random

import pytest
import xxhash

from tidewater.llm import simhash

SCHEMA = "doc_id long, text string"


def brute_print(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


def result(spark, rows):
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted([tuple(r) for r in got], key=repr)


def texts():
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choices(vocab, k=200)) for _ in range(12)]
    rows = []
    for t in base:
        rows.append(t)
        for _ in range(6):
            w = t.split()
            for _ in range(rnd.randint(1, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append(" ".join(w))
    return [(1000 - i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("small", [64, 1])
def test_components_match_all_pairs(spark, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", small)      # 1: every shared bucket goes by changed bits
    rows = texts() + [(3, None), (2, ""), (4, " \t\n"), (5, "one"), (5, "one two"), (5, "a b c"), (5, "a b c"),
                      (None, "A B C"), (None, "alone here tonight"), (6, "Été été x y z")]
    assert result(spark, rows) == brute_components(rows)


def test_links_of_a_dense_bucket(spark):
    """Fingerprints that differ in 11 bits of two blocks: over SMALL in a bucket, linked in steps of two bits."""
    bits = [1 << i for i in (0, 3, 5, 9, 15, 16, 20, 25, 28, 30, 31)]
    prints = [sum(b for i, b in enumerate(bits) if n >> i & 1) for n in range(0, 2048, 3)]
    prints += [-1, -1 ^ (1 << 40), 1 << 62]
    got = simhash.links(spark, spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    assert all((r.a ^ r.b) & (2 ** 64 - 1) and ((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 2 for r in got)
    root = {p: p for p in prints}

    def find(x, r):
        while r[x] != x:
            x = r[x]
        return x
    for r in got:
        root[find(r.a, root)] = find(r.b, root)
    want = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2:
                want[find(a, want)] = find(b, want)
    same = lambda r: {frozenset(p for p in prints if find(p, r) == find(q, r)) for q in prints}
    assert same(root) == same(want)


def test_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 977}" for i in range(30_000))
    whole = simhash.fingerprint(text) % 2 ** 64
    monkeypatch.setattr(simhash, "PIECE", 37)
    assert simhash.fingerprint(text) % 2 ** 64 == whole == brute_print(text)
    assert simhash.fingerprint("x" * 100 + "  " * 60 + "y") % 2 ** 64 == brute_print("x" * 100 + " y")


def test_empty_table_and_other_columns(spark):
    assert result(spark, []) == []
    df = spark.createDataFrame([(1, "a b c", 9, 8, "k")], "doc_id long, text string, fp long, root long, key string")
    assert [tuple(r) for r in simhash.near_duplicates(df).collect()] == brute_components([(1, "a b c")])


def test_no_rows_without_links(spark):
    rows = [(1, "a b c d e"), (2, "v w x y z")]
    assert result(spark, rows) == brute_components(rows)
