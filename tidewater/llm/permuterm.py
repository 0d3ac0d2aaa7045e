"""Spelling variants: words one edit apart, found by permuterm rotations."""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import functions as F

from .common import map_rows, table, written

LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10          # a form is so many times as frequent as the word
DELETE = 31         # a run whose hash it divides loses a code point
END = "$"           # in no word
HELD = 200_000      # words a task counts before it passes them on
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")     # shorter runs give no word


def runs(text):
    """Counts of the runs of a text, A-Z in lower case."""
    text = (text or "").encode().lower().decode()
    return Counter(RUN.findall(text) if len(text) < 1 << 20 else (m[0] for m in RUN.finditer(text)))


def word_of(doc_id, run):
    """The run, or what is left of it without the code point that its hash names."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DELETE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def counted(docs):
    """(word, n) of all words of docs (doc_id, text), n over the whole table."""
    def run(batches):
        held = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500).to_pydict()
                for doc_id, text in zip(part["doc_id"], part["text"]):
                    for run, c in runs(text).items():
                        word = word_of(doc_id, run)
                        if len(word) >= LEAST_LENGTH:
                            held[word] = held.get(word, 0) + c
                    if len(held) >= HELD:
                        yield to_batch(held)
                        held = {}
        yield to_batch(held)

    def to_batch(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                          names=["word", "n"])

    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def rotations(word):
    """(prefix, whole, first) of the rotations of word + END. In the rotation that
    ends with the code point at i, what stands before it is the prefix: words that
    share it differ at i alone. A whole rotation is the prefix of the words with a
    code point put in there. first: the code point before i is another one, so a
    deletion that may fall on several equal neighbours has one such prefix."""
    for i in range(len(word)):
        yield word[i + 1:] + END + word[:i], False, not i or word[i - 1] != word[i]
    for i in range(len(word) + 1):
        yield word[i:] + END + word[:i], True, True


def neighbours(group):
    """(word, near words here, n of the most frequent one, itself) for the rows
    (prefix, word, n, whole, first) of one prefix: a word for each letter and one
    that lacks it, so the group is bounded by the alphabet."""
    whole = [x for x in group if x[3]]
    firsts = sum(x[4] for x in group) - len(whole)
    top = sorted((-x[2], x[1]) for x in group)[:2]
    for _, word, _, is_whole, first in group:
        best = top[word == top[0][1]]
        near = firsts if is_whole else len(group) - len(whole) - 1 + (first and len(whole))
        yield word, near, -best[0], best[1]


def near_words(words):
    """(word, n_near, best): the number of near words, and the most frequent one
    (ties: the smallest) as a struct of -n and word."""
    def turn():
        return lambda row: [(p, row["word"], row["n"], w, f) for p, w, f in rotations(row["word"])]

    turned = map_rows(words.select("word", "n"), "prefix string, word string, n long, whole boolean, first boolean",
                      turn)

    def scan(batches):
        rows = (row for b in batches for at in range(0, b.num_rows, 2000)
                for row in zip(*[c.to_pylist() for c in b.slice(at, 2000).columns]))
        out = []
        for _, group in groupby(rows, itemgetter(0)):
            group = list(group)
            if len(group) > 1:
                out += neighbours(group)
            if len(out) >= 2000:
                yield to_batch(out)
                out = []
        if out:
            yield to_batch(out)

    def to_batch(out):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=["word", "near", "n", "other"])

    # a prefix is whole in one task; sorted, its rotations stand side by side
    found = turned.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(
        scan, "word string, near long, n long, other string")
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("word"))).alias("best"))


def followed(spark, forms):
    """(word, root) of the words that have a form: the last of the chain. A form is
    TIMES as frequent as its word, so a chain has 18 steps at most; each round
    doubles the steps taken."""
    at = written(spark, forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "chain")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("last"))
        if at.join(on, "root").isEmpty():
            return at
        at = written(spark, at.join(on, "root", "left").select("word", F.coalesce("last", "root").alias("root")),
                     "chain")


def spelling_variants(docs):
    """(word, form, root, n, n_near, form_n), one row for each word.

    Null texts have no words, like empty ones; a row without doc_id counts with
    an empty doc_id. Rows that are repeated count each time. An empty table gives no
    rows; other columns are not read. Texts are read whole, however long.
    """
    spark = docs.sparkSession
    words = written(spark, counted(docs), "words")
    near = near_words(words)
    fits = -F.col("best.less") >= TIMES * F.col("n")
    forms = written(spark, words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    return forms.join(followed(spark, forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
