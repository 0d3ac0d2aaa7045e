"""Packing: concatenate and cut with two-pass prefix sums."""

from __future__ import annotations

import itertools
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from .common import map_rows, table, written

LENGTH = 1024


# Fixed value: the pattern by which byte-level BPE of this vocabulary cuts a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_GAP = re.compile(r"\s{1000}")


def tokenizer(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def encoder(path):
    """Function from a text to its ids: the vocabulary of the file, whose ids are
    the merge ranks, in a byte-pair encoder that needs a third of the time. Texts with
    very long white space, too deep for its pattern search, go to the tokenizer itself."""
    import tiktoken
    # byte-level BPE writes each byte as a visible character: its own, or the next from 256 on
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    byte = {chr(b): b for b in shown} | {
        chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    whole = tokenizer(path)
    ranks = {bytes(byte[c] for c in t): i for t, i in whole.get_vocab(with_added_tokens=False).items()
             if i not in whole.get_added_tokens_decoder()}
    fast = tiktoken.Encoding("pieces", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(text):
        if LONG_GAP.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_to_numpy(text, disallowed_special=())
    return encode


def tokenise(docs, path):
    """(part, begin, doc_id, ids): begin is the count of ids before it in its part."""
    def start():
        encode, at = encoder(path), [0]

        def one(row):
            ids = np.append(np.asarray(encode(row["text"] or ""), "<u4"), np.uint32(0))
            yield (row["part"], at[0], row["doc_id"], ids.tobytes())
            at[0] += len(ids)
        return one
    parts = docs.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return map_rows(parts, "part int, begin long, doc_id long, ids binary", start)


def pack(docs, path, length=LENGTH):
    """One row per piece. Null text is empty: its document is the end id alone.

    Pass 1 writes the ids once, so parts and positions stay fixed if tasks run
    again; the totals of the parts (one number a part) give global offsets;
    pass 2 cuts fixed windows. Only the very last sequence is short.
    """
    ids = written(docs.sparkSession, tokenise(docs, path), "ids")
    totals = sorted(tuple(r) for r in ids.groupBy("part").agg(
        F.sum(F.expr("octet_length(ids) div 4"))).collect())
    before = dict(zip([p for p, _ in totals],
                      itertools.accumulate([n for _, n in totals], initial=0)))

    def start():
        def one(row):
            raw, at = row["ids"], before[row["part"]] + row["begin"]
            n, s = len(raw) // 4, 0
            while s < n:
                off = (at + s) % length
                k = min(n - s, length - off)
                yield (row["doc_id"], s, k, zlib.crc32(raw[4 * s:4 * (s + k)]), n, (at + s) // length, off)
                s += k
        return one

    return map_rows(ids, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                    "sequence_id long, `offset` long", start)


def default_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op6(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), default_path())


def stage(spark, docs, sf_dir):
    return pack(docs, default_path())
