"""Near duplicates by SimHash fingerprints that differ in two bits at most."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from .common import map_rows, table, written
from .components import components

SHINGLE = 3       # words
SEED = 42
DISTANCE = 2      # differing bits of a link
BLOCKS = 4        # of 16 bits; two differing bits leave two blocks alike at least
SMALL = 64        # fingerprints of a bucket that are compared with each other
PIECE = 1 << 20   # bytes of a text that are hashed at a time
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(data):
    """The words of data, in lists from about PIECE bytes each, cut at white space."""
    at = 0
    while at < len(data):
        cut = SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()      # bytes.split() parts at \x20 and \x09-\x0D alone
        at = end


def hashes(data):
    """Arrays of the XXH64 of all shingles, repeats included."""
    kept, any_yet = [], False
    for words in pieces(data):
        words = kept + words
        if len(words) >= SHINGLE:
            text = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.append(0, ends[:-1] + 1)[:len(words) - SHINGLE + 1]
            spans = zip(starts.tolist(), ends[SHINGLE - 1:].tolist())
            yield np.array([xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in spans], "<u8")
            any_yet = True
        kept = words[1 - SHINGLE:]
    if kept and not any_yet:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], "<u8")


def fingerprint(text):
    """64 bits as a signed number: a bit is set if over half of the hashes have it; no words: 0."""
    count, n = np.zeros(64, np.int64), 0
    for h in hashes((text or "").encode().lower()):     # bytes.lower touches A-Z only
        for at in range(0, len(h), 8192):
            bits = np.unpackbits(h[at:at + 8192, None].view(np.uint8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * count > n, bitorder="little").view("<i8")[0])


def bucketed(prints):
    """(fp, key): a row for each way to choose BLOCKS - DISTANCE blocks, which a close pair has alike."""
    block = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(BLOCKS)]
    keys = []
    for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE)):
        key = F.lit(n).cast("long")
        for i in chosen:
            key = F.shiftleft(key, 16).bitwiseOR(block[i])
        keys.append(key)
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def links(spark, prints):
    """(a, b) of different fingerprints (column fp, each once): every row is a link,
    and linked fingerprints are connected by the rows.

    Fingerprints of a bucket are compared with each other if they are SMALL or
    fewer. Those of larger buckets, such as thousands of variants of one text, are
    dealt again by what they become with one bit changed or none: two that differ
    in two bits at most share such a neighbour, and all who share one (65 at most)
    differ in two bits at most, so linking each with the smallest connects them
    without any pairs being tried.
    """
    rows = bucketed(prints)
    sizes = written(spark, rows.groupBy("key").count().where("count > 1"), "sizes")
    rows = written(spark, rows.join(sizes.hint("merge"), "key"), "buckets")
    few = rows.where(F.col("count") <= SMALL).select("key", "fp")
    close = F.expr(f"bit_count(a ^ b) <= {DISTANCE}")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key")
             .where("a < b").where(close).select("a", "b").distinct())
    many = rows.where(F.col("count") > SMALL).select("fp").distinct()
    changed = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(-1 << 63 if i == 63 else 1 << i))
                                     for i in range(64)])
    stars = (many.select("fp", F.explode(changed).alias("near"))
             .groupBy("near").agg(F.collect_list("fp").alias("of")).where(F.size("of") > 1)
             .select(F.array_min("of").alias("a"), F.explode("of").alias("b"))
             .where("a != b").where(close).distinct())
    return pairs.unionByName(stars)


def near_duplicates(docs):
    """(doc_id, fingerprint, component_id), one row for each row of docs.

    A null text counts as empty; texts without words have the fingerprint zero
    and are linked like any other. Repeated rows repeat; rows that share a doc_id
    but not a text are judged by their own texts. A row without doc_id has a null
    doc_id and links others as well; component_id is the smallest doc_id of the
    component, null if it has none. An empty table gives no rows; other columns
    are not read. Texts are hashed whole, PIECE bytes at a time.
    """
    spark = docs.sparkSession

    def start():
        return lambda row: [(row["doc_id"], fingerprint(row["text"]))]

    made = written(spark, map_rows(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, fp long", start),
                   "prints")
    prints = written(spark, made.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    comp = components(spark, written(spark, links(spark, prints.select("fp")), "links"))
    both = prints.join(comp.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = both.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(spark, both.join(least, "root").select("fp", "component_id"), "named")
    return made.join(named.hint("merge"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
