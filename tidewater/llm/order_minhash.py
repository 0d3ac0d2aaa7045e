"""Near duplicates by Order MinHash; candidates verified by banded alignment."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from .common import map_rows, table, words, written
from .components import components

K = 5             # words of a shingle
ELL = 3           # minima of a sketch, in text order
SKETCHES = 20     # at similarity 0.8, a pair shares one with probability above 0.999999
SIMILARITY = 0.8
STARS = 2         # rounds in which a bucket is compared with one text
LONGS = 16        # 64-bit words of a text's parity bits


def shingles(text):
    """64-bit hashes of the five-word shingles (one of all words if fewer)."""
    h = np.array([hash_word(x) for x in words(text)], np.uint64)
    if len(h) == 0:
        return h
    k = min(K, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(out)]
    return mix(out)


WORDS: dict[bytes, int] = {}


def hash_word(x):
    """Stable 64-bit hash, cached for common words (the cache is emptied when full)."""
    got = WORDS.get(x)
    if got is None:
        import xxhash
        if len(WORDS) > 300_000:
            WORDS.clear()
        got = WORDS[x] = xxhash.xxh3_64_intdigest(x)
    return got


def mix(x):
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def labelled(s):
    """Shingle hashes mixed with their occurrence number in the text."""
    if len(s) < 2:
        return s
    order = np.argsort(s, kind="stable")
    v = s[order]
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    if len(first) == len(s):
        return s
    occ = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    out = np.empty_like(s)
    out[order] = v + occ.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return out


SALTS = np.array([(i + 1) * 0x2545F4914F6CDD1D % 2 ** 64 for i in range(SKETCHES)], np.uint64)


def sketches(s):
    """SKETCHES keys: each hashes the ELL smallest labelled shingles in text order.
    Short texts take all salts in one array; long ones take them one by one."""
    x = labelled(s)
    step = SKETCHES if len(x) <= 4096 else 1
    for i in range(0, SKETCHES, step):
        if len(x) > ELL:
            v = mix(x ^ SALTS[i:i + step, None])
            at = np.sort(np.argpartition(v, ELL - 1, axis=1)[:, :ELL], axis=1)
        else:
            at = np.broadcast_to(np.arange(len(x)), (step, len(x)))
        for k, row in enumerate(x[at], i):
            yield hashlib.blake2b(row.tobytes() + bytes([k]), digest_size=8).digest()


def parity(s):
    """LONGS numbers: one bit for each remainder of the labelled shingle hashes, set
    where an odd number of them falls. Two texts differ in at least as many shingles
    as they differ in bits, so the bits rule out pairs without losing a similar one."""
    at = (labelled(s) % np.uint64(64 * LONGS)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * LONGS) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").tolist()


def aligned(a, b):
    """Longest common subsequence of a and b inside the band that every alignment
    of similarity SIMILARITY keeps to; bit-parallel, one row for each shingle of b."""
    n, m = len(a), len(b)
    band = (n + m) // 9 + 1
    where = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    lo, hi, row, got = 0, min(n, band), (1 << min(n, band)) - 1, 0
    for j, x in enumerate(b):
        top = min(n, j + band + 1)
        if top > hi:
            row |= ((1 << (top - hi)) - 1) << (hi - lo)
            hi = top
        low = min(max(0, j - band), hi)
        if low > lo:
            k = low - lo
            got += k - (row & ((1 << k) - 1)).bit_count()
            row >>= k
            lo = low
        u = 0
        for i in where.get(x, ()):
            if lo <= i < hi:
                u |= 1 << (i - lo)
        u &= row
        if u:
            row = ((row + u) | (row - u)) & ((1 << (hi - lo)) - 1)
    return got + (hi - lo) - row.bit_count()


def similarity(a, b):
    """Aligned shingles over all shingles of both; 0 where a bound shows it is too low."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < SIMILARITY * max(n, m):
        return 0.0
    x, y = np.sort(labelled(a)), np.sort(labelled(b))
    most = len(np.intersect1d(x, y, assume_unique=True))
    if most < SIMILARITY * (n + m - most):
        return 0.0
    got = aligned(a.tolist(), b.tolist())
    return got / (n + m - got)


def numbered(docs, *more):
    """text_id and text (null counts as empty) after the columns more."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*more, F.xxhash64(text).alias("text_id"), text.alias("text"))


def verify(pairs, texts):
    """The pairs (a, b) whose texts are similar: two joins, then alignment. Spark
    splits the partitions of a hub that many texts are compared with."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "ta", "tb")

    def start():
        def one(row):
            if similarity(shingles(row["ta"]), shingles(row["tb"])) >= SIMILARITY:
                yield row["a"], row["b"]
        return one
    return map_rows(both, "a long, b long", start)


def classes(docs):
    """(doc_id, class_id, text_id, class_text_id): class_id is the smallest doc_id of its
    group, text_id the XXH64 of the text, and class_text_id that of the group's first text
    (by doc_id, then text_id); they tell texts of one doc_id apart.

    Same texts form one class (null counts as empty). Different texts are linked
    if the similarity of their five-word shingles, aligned in order, is 0.8 or
    more; a class is a connected group. Texts without words are linked to the
    same text only. Every text of a doc_id is compared. Rows without doc_id are
    left out; repeated rows count once. Other columns are not read.
    Candidates share one of SKETCHES Order MinHash keys. The first STARS rounds
    compare the texts of a bucket with the one of them that meets most others;
    the last round looks at all texts of a bucket that are still in different
    groups, so no candidate is lost and groups of copies are not expanded. There
    the pairs whose parity bits allow a similarity of 0.8 are aligned: at 0.8, at
    most one shingle in nine of both texts is in one of them only.
    """
    spark = docs.sparkSession
    docs = numbered(docs.where("doc_id IS NOT NULL"), "doc_id").withColumn("h", F.unhex(F.sha2("text", 256)))
    # one row a text, numbered when it is written
    texts = written(spark, docs.groupBy("h").agg(
        F.min("doc_id").alias("d"), F.first("text_id").alias("t"), F.first("text").alias("text"))
        .withColumn("id", F.monotonically_increasing_id()), "texts")

    def start():
        def one(row):
            s = shingles(row["text"])
            if len(s):
                for key in sketches(s):
                    yield int.from_bytes(key, "little", signed=True), row["id"], len(s)
        return one

    buckets = written(spark, map_rows(texts.select("id", "text"), "key long, id long, n long", start), "sketches")
    sized = buckets.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shared = written(spark, buckets.join(sized, "key"), "buckets")
    # the text that meets most others is the likely origin of a group of copies
    met = shared.groupBy("id").agg(F.sum("c").alias("d"))
    shared = written(spark, shared.join(met, "id").select("key", "id", "n", "d"), "buckets")
    rest, tried, links = shared.withColumn("root", F.col("id")), None, None
    for _ in range(STARS):
        top = F.max(F.struct("d", (-F.col("id")).alias("i"), "n", "root")).alias("h")
        rest = rest.join(rest.groupBy("key").agg(top), "key").where("root != h.root")
        star = rest.where(F.least("n", "h.n") >= SIMILARITY * F.greatest("n", "h.n")).select(
            F.least("id", -F.col("h.i")).alias("a"), F.greatest("id", -F.col("h.i")).alias("b")).distinct()
        star = written(spark, star if tried is None else star.join(tried, ["a", "b"], "left_anti"), "star")
        found = verify(star, texts)
        links = written(spark, found if links is None else links.unionByName(found), "links")
        tried = star if tried is None else tried.unionByName(star)
        comp = components(spark, links)
        rest = rest.select("key", "id", "n", "d").join(comp, "id", "left").withColumn(
            "root", F.coalesce("root", "id"))
    rest = shared.join(comp, "id", "left").select("key", "id", "n", F.coalesce("root", "id").alias("root"))
    mixed = rest.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("key")
    rest = written(spark, rest.join(mixed, "key"), "mixed")

    def sign():
        return lambda row: [(row["id"], *parity(shingles(row["text"])))]

    signs = map_rows(texts.join(rest.select("id").distinct(), "id", "left_semi"),
                     "id long, " + ", ".join(f"s{i} long" for i in range(LONGS)), sign)
    rest = written(spark, rest.join(signs, "id"), "signed")
    other = rest.select("key", F.col("id").alias("b"), F.col("n").alias("m"), F.col("root").alias("r"),
                        *[F.col(f"s{i}").alias(f"t{i}") for i in range(LONGS)])
    differ = F.expr(" + ".join(f"bit_count(s{i} ^ t{i})" for i in range(LONGS)))
    left = (rest.join(other, "key").where(
        (F.col("root") != F.col("r")) & (F.col("id") < F.col("b")) &
        (F.least("n", "m") >= SIMILARITY * F.greatest("n", "m")) & (9 * differ <= F.col("n") + F.col("m")))
        .select(F.col("id").alias("a"), "b").distinct().join(tried, ["a", "b"], "left_anti"))
    links = links.unionByName(verify(written(spark, left, "left"), texts))
    comp = components(spark, written(spark, links, "links"))
    own = texts.select("h", "id", "d", "t").join(comp, "id", "left").withColumn("root", F.coalesce("root", "id"))
    first = own.groupBy("root").agg(F.min(F.struct("d", "t")).alias("first"))
    own = own.join(first, "root").select(
        "h", F.col("first.d").alias("class_id"), F.col("first.t").alias("class_text_id"))
    return (docs.select("doc_id", "text_id", "h").distinct().join(own, "h")
            .select("doc_id", "class_id", "text_id", "class_text_id"))


def op1(spark, sf_dir):
    return classes(table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """One text of each class stays, with its repeated rows; rows without doc_id stay.
    The columns of docs travel in one column of their own, so their names are free."""
    gone = classes(docs).where("doc_id != class_id OR text_id != class_text_id").select("doc_id", "text_id")
    rows = numbered(docs, F.struct(*docs.columns).alias("row"), "doc_id").drop("text")
    return rows.join(gone, ["doc_id", "text_id"], "left_anti").select("row.*")
