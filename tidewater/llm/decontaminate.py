"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from .common import keep_rows, map_rows, table, words

WINDOW = 13
ITEMS_PER_BLOCK = 20_000


def build(items):
    """Search tables, one per window length: shift by the last two words of a
    block, buckets by suffix, and the items of each window."""
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        m = min(WINDOW, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            owners[tuple(w[i:i + m])].add(item)
    tables = {}
    for win, ids in owners.items():
        m = len(win)
        b = min(2, m)
        shift, bucket = tables.setdefault(m, ({}, {}))
        for j in range(b, m + 1):
            key = win[j - b:j]
            shift[key] = min(shift.get(key, m), m - j)
        bucket.setdefault(win[m - b:], {})[win] = ids
    return tables


def search(w, tables):
    """(hit word spans, items): positions whose shift is above 0 are skipped;
    the others look into the suffix bucket and compare the whole window."""
    spans, found = [], set()
    for m, (shift, bucket) in tables.items():
        b, end, n = min(2, m), m, len(w)
        while end <= n:
            key = tuple(w[end - b:end])
            step = shift.get(key, m - b + 1)
            if step:
                end += step
                continue
            ids = bucket[key].get(tuple(w[end - m:end]))
            if ids is not None:
                spans.append((end - m, end))
                found |= ids
            end += 1
    return spans, found


def covered(spans):
    """Number of positions in the union of half-open spans."""
    n = last = 0
    for s, e in sorted(spans):
        if e > last:
            n += e - max(s, last)
            last = e
    return n


def judge(benchmark):
    """A function from a text to (words, hit words, item ids, contaminated). The items
    are searched in blocks of at most ITEMS_PER_BLOCK: each block is broadcast alone,
    and the hits of all blocks are merged for each text."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), "text")
    blocks, block = [], []
    for r in items.toLocalIterator():
        block.append((r.i, r.text))
        if len(block) == ITEMS_PER_BLOCK:
            blocks.append(sc.broadcast(build(block)))
            block = []
    blocks.append(sc.broadcast(build(block)))

    def one(text):
        w = words(text)
        spans, found = [], set()
        for tables in blocks:
            s, f = search(w, tables.value)
            spans += s
            found |= f
        n = covered(spans)
        return len(w), n, sorted(x for x in found if x is not None), n > 0 and 20 * n >= len(w)
    return one


def decontaminate(docs, benchmark):
    """One row per document: words, hit words, items, contaminated.

    Null text has no words; an item without id hits but is not counted; an
    empty benchmark hits nothing; repeated rows give repeated results.
    """
    judged = judge(benchmark)

    def one(row):
        n_words, n_hit, ids, bad = judged(row["text"])
        yield row["doc_id"], n_words, n_hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bad

    return map_rows(docs.select("doc_id", "text"), "doc_id long, n_words long, n_hit long, n_items long, "
                    "items_sha256 string, contaminated boolean", lambda: one)


def op9(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage(spark, docs, sf_dir):
    """Drop contaminated rows, in one pass over the texts."""
    judged = judge(table(spark, sf_dir, "benchmark"))
    return keep_rows(docs, ["text"], lambda: lambda row: not judged(row["text"])[-1])
