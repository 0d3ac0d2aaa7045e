"""Repeated passages by a sparse suffix array over words.

A text keeps the suffixes that begin at minimisers. With a suffix goes its frame: the
words of all windows of LENGTH words that chose its minimiser. Suffixes are sorted by the
hash of their first CONTEXT words, then by their frame, then by place. Neighbours of the
same frame repeat all of it. The ends of such a run, where suffixes around one context have
other frames, are compared again after extension, window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tidewater import paths
from tidewater.session import scratch_path

from .common import table, written
from .order_minhash import mix

LENGTH = 50     # words of the shortest repeat
CONTEXT = 32    # first words of a suffix that order it
GAP = LENGTH - CONTEXT + 1      # every window of GAP suffixes holds a minimiser
SEED = 8        # words whose hash selects minimisers
NO_ID = 2 ** 63 - 1     # place of rows without doc_id in the order of documents
WHOLE = -1      # end of a span that covers its whole text

BYTES = np.random.default_rng(7).integers(0, 2 ** 64, (256, 64), np.uint64, endpoint=False)
BASES = {name: (b, pow(b, -1, 2 ** 64)) for name, b in
         (("key", 0x9E3779B97F4A7C15), ("frame", 0xD6E8FEB86659FD93), ("seed", 0xA0761D6478BD642F))}

REPEAT, FIRST, OPEN, EDGE = range(4)    # kinds of rows that sweep gives
PLACE = ["k", "f", "d", "t", "start"]
PLACES = "k long, f long, d long, t long, start long, end long"
SWEPT = PLACES + ", kind int, part int, side int, flags int"
SPANS = "d long, t long, start long, end long, kind int"


def spans_of(text):
    """The bytes of a text, and where its words start and end in them."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    step = np.diff(inside)
    return raw, np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text):
    """64-bit hash of each word: the sum of table entries chosen by byte and place."""
    raw, starts, ends = spans_of(text)
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), 50_000):
        s, n = starts[i:i + 50_000], (ends - starts)[i:i + 50_000]
        first = np.cumsum(n) - n
        at = np.arange(n.sum()) - np.repeat(first, n)
        value = BYTES[raw[np.repeat(s, n) + at], at & 63] * (2 * (at >> 6) + 1).astype(np.uint64)
        out[i:i + 50_000] = mix(np.add.reduceat(value, first))
    return out


class Ranges:
    """Hashes of the words from s to e, for arrays s and e, by prefix sums."""

    def __init__(self, h, name):
        base, inverse = (np.uint64(x) for x in BASES[name])
        power = np.cumprod(np.full(len(h), base))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power)])
        self.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(h), inverse))])

    def __call__(self, s, e):
        return mix((self.sums[e] - self.sums[s]) * self.inverse[s])


def window_minimisers(h):
    """Place of the minimiser of each window of LENGTH words: the last smallest seed
    of its GAP suffixes that still have CONTEXT words."""
    n = len(h) - CONTEXT + 1
    if n < GAP:
        return np.empty(0, np.int64)
    at = np.arange(n)
    seeds = Ranges(h, "seed")(at, at + SEED)
    win = np.lib.stride_tricks.sliding_window_view(seeds, GAP)
    out = []
    for i in range(0, len(win), 100_000):
        w = win[i:i + 100_000]
        out.append(i + np.arange(len(w)) + GAP - 1 - np.argmin(w[:, ::-1], axis=1))
    return np.concatenate(out)


def frames(text):
    """For each retained suffix: hash of its first CONTEXT words, hash of its frame,
    and the words where the frame starts and ends."""
    h = word_hashes(text)
    chosen = window_minimisers(h)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    at, end = chosen[first], np.append(first[1:], len(chosen))[:len(first)] - 1 + LENGTH
    frame = Ranges(h, "frame")(first, end) ^ mix((at - first).astype(np.uint64) + np.uint64(1))
    return Ranges(h, "key")(at, at + CONTEXT).view(np.int64), frame.view(np.int64), first, end


def windows(text, at):
    """Two hashes, start and end of each window of LENGTH words inside the frames at."""
    h = word_hashes(text)
    starts = np.concatenate([np.arange(x["start"], x["end"] - LENGTH + 1) for x in at])
    return *(Ranges(h, name)(starts, starts + LENGTH).view(np.int64) for name in ("key", "frame")), starts, starts + LENGTH


def map_places(df, fn):
    """PLACES of the texts of df; fn gives the arrays k, f, start, end for a row."""
    def run(batches):
        held, n = [], 0
        for b in batches:
            for at in range(0, b.num_rows, 200):
                for row in b.slice(at, 200).to_pylist():
                    k, f, s, e = fn(row)
                    if len(k):
                        held.append((k, f, np.full(len(k), row["d"]), np.full(len(k), row["t"]), s, e))
                        n += len(k)
                    if n >= 50_000:
                        yield batch(held)
                        held, n = [], 0
        if held:
            yield batch(held)

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*held)],
                                          [*PLACE, "end"])
    return df.mapInArrow(run, PLACES)


def given(pk, pf, nk, nf):
    """The kinds of rows for a suffix whose neighbours before and after share its context
    (pk, nk) or all its frame (pf, nf)."""
    return ((REPEAT, pf), (FIRST, nf), (OPEN, (pk | nk) & ~(pf & nf)))


def sweep(spark, rows, tag):
    """Sort PLACES globally and compare each with its neighbours: REPEAT and FIRST where
    k and f are the same, OPEN for the ends of such a run if its k has another f. The range
    partitioning includes the place, so equal suffixes of any number spread over tasks; the
    first and last row of a part (EDGE) are compared on the driver, two records a part.
    """
    def run(batches):
        from pyspark import TaskContext
        part, cols, opened = TaskContext.get().partitionId(), [*PLACE, "end"], False
        held = None     # the last row that has been dealt with (if any) and the one after it

        def out(x, i, kind, side=0, flags=0):
            n = len(i)
            return pa.RecordBatch.from_arrays(
                [pa.array(x[c][i]) for c in cols] + [pa.array(np.full(n, v, np.int32)) for v in (kind, part, side)]
                + [pa.array(np.broadcast_to(np.int32(flags), n))], [*cols, "kind", "part", "side", "flags"])

        for b in batches:
            if not b.num_rows:
                continue
            x = {c: b.column(c).to_numpy(zero_copy_only=False) for c in cols}
            if held is not None:
                x = {c: np.append(held[c], x[c]) for c in cols}
            n = len(x["k"])
            if n == 1:
                held = x
                continue
            k = x["k"][1:] == x["k"][:-1]
            f = k & (x["f"][1:] == x["f"][:-1])
            if not opened:
                yield out(x, [0], EDGE, 0, 4 * k[0] + 8 * f[0])
                opened = True
            # a context all of whose suffixes are here and have one frame needs no more
            group = np.append(0, np.cumsum(~k))
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[1:][k & ~f]] = True
            mixed[[0, -1]] = True
            for kind, yes in given(k[:-1], f[:-1], k[1:], f[1:]):
                i = 1 + np.flatnonzero(yes & mixed[group[1:-1]] if kind == OPEN else yes)
                if len(i):
                    yield out(x, i, kind)
            held = {c: x[c][-2:] for c in cols}
        if held is not None:
            k = opened and held["k"][0] == held["k"][-1]
            f = k and held["f"][0] == held["f"][-1]
            yield out(held, [-1], EDGE, 1 if opened else 2, 1 * k + 2 * f)

    swept = written(spark, rows.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(run, SWEPT), tag)
    ends = sorted(swept.where(F.col("kind") == EDGE).collect(), key=lambda r: (r.part, r.side))
    more = []
    for i, r in enumerate(ends):
        pk, pf, nk, nf = (bool(r.flags & x) for x in (1, 2, 4, 8))
        if r.side != 1 and i:
            pk = ends[i - 1].k == r.k
            pf = pk and ends[i - 1].f == r.f
        if r.side != 0 and i + 1 < len(ends):
            nk = ends[i + 1].k == r.k
            nf = nk and ends[i + 1].f == r.f
        more += [(r.d, r.t, r.start, r.end, kind) for kind, yes in given(*map(np.bool_, (pk, pf, nk, nf))) if yes]
    return (swept.where(F.col("kind") != EDGE).select("d", "t", "start", "end", "kind")
            .unionByName(spark.createDataFrame(more, SPANS)))


def numbered(docs, *more):
    """doc_id as d (NO_ID if null) and the text's hash as t: the place of a text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*more, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"),
                       F.xxhash64(text).alias("t"), text.alias("words"))


def places(docs):
    """(d, t, start, end, kind): REPEAT and FIRST spans, end WHOLE for copies of a text."""
    spark = docs.sparkSession
    hashed = numbered(docs).withColumn("h", F.unhex(F.sha2("words", 256)))
    texts = hashed.groupBy("h").agg(F.min("d").alias("d"), F.first("t").alias("t"), F.first("words").alias("words"))
    root = scratch_path(spark, "suffixes")
    map_places(texts, lambda row: frames(row["words"])).write.parquet(root)
    found = sweep(spark, spark.read.parquet(root), "neighbours")
    paths.delete(spark, root)   # swept and written

    again = found.where(F.col("kind") == OPEN).groupBy("d", "t").agg(F.collect_list(F.struct("start", "end")).alias("at"))
    again = again.join(numbered(docs), ["d", "t"]).dropDuplicates(["d", "t"])
    root = scratch_path(spark, "windows")
    map_places(again, lambda row: windows(row["words"], row["at"])).write.parquet(root)
    found = found.unionByName(sweep(spark, spark.read.parquet(root), "extended")).where(F.col("kind") < OPEN)
    paths.delete(spark, root)

    small = hashed.groupBy("h").agg(F.min("d").alias("d"), F.max("d").alias("e"), F.first("t").alias("t"))
    whole = [F.lit(0).cast("long").alias("start"), F.lit(WHOLE).cast("long").alias("end")]
    copies = hashed.select("h", "d", "t").join(small.select("h", "d"), ["h", "d"], "left_anti")
    return (found.unionByName(copies.distinct().select("d", "t", *whole, F.lit(REPEAT).alias("kind")))
            .unionByName(small.where("d != e").select("d", "t", *whole, F.lit(FIRST).alias("kind"))))


def merged(spans, n):
    """Spans of a text of n words, sorted, with those that touch made one."""
    out = []
    for s, e in sorted((x["start"], n if x["end"] == WHOLE else x["end"]) for x in spans):
        if e - s < LENGTH:
            continue
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def repeats(docs):
    """One row per repeated passage of LENGTH words or more: doc_id, start and end
    (words; start_byte and end_byte in UTF-8), n_words, role, text_id.

    role is "repeat" if an earlier place (by doc_id, rows without it last, then text_id and
    position) holds the words too, "first" if a later one does; a passage can be both. Every
    row is searched; text_id (XXH64 of the text) tells texts of one doc_id apart. Null, empty
    and short texts have none. Repeated rows count once, and so do rows without doc_id that
    have the same text. Same texts are compared with others once, as the text of their
    smallest doc_id, and the others are "repeat" as a whole. Other columns are not read.
    """
    lists = places(docs).groupBy("d", "t", "kind").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    located = lists.join(numbered(docs, "doc_id"), ["d", "t"])
    schema = ("doc_id long, start long, end long, start_byte long, end_byte long, n_words long, role string, "
              "text_id long")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                out = []
                for row in b.slice(at, 200).to_pylist():
                    _, first, last = spans_of(row["words"])
                    for s, e in merged(row["spans"], len(first)):
                        out.append((row["doc_id"], s, e, int(first[s]), int(last[e - 1]), e - s,
                                    "first" if row["kind"] == FIRST else "repeat", row["t"]))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.string() if i == 6 else pa.int64()) for i, c in enumerate(zip(*out))],
                        [c.split()[0] for c in schema.split(", ")])

    return located.mapInArrow(run, schema).distinct()


def op7(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents"))


def without(text, spans):
    raw, first, last = spans_of(text)
    out, at = [], 0
    for s, e in merged(spans, len(first)):
        out.append(raw[at:first[s]].tobytes())
        at = last[e - 1]
    return b"".join([*out, raw[at:].tobytes()]).decode()


def stage(spark, docs, sf_dir):
    """Cut repeated passages out of the texts (the first place keeps its words);
    every row stays, n_chars follows the text. The columns of docs travel in one
    column of their own, so their names are free."""
    cuts = places(docs).where(F.col("kind") == REPEAT).groupBy("d", "t").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    rows = (numbered(docs, F.struct(*docs.columns).alias("row")).drop("words").join(cuts, ["d", "t"], "left")
            .select("row", "spans"))
    names = docs.columns

    def run(batches):
        for b in batches:
            cols = dict(zip(names, b.column("row").flatten()))
            old, spans = cols["text"], b.column("spans")
            hit = spans.is_valid().to_numpy(zero_copy_only=False)
            if hit.any():
                new = old.to_pylist()
                for i in np.flatnonzero(hit).tolist():
                    if new[i] is not None:
                        new[i] = without(new[i], spans[i].as_py())
                cols["text"] = pa.array(new, old.type)
                if "n_chars" in cols:
                    now = pc.utf8_length(cols["text"]).cast(cols["n_chars"].type)
                    cols["n_chars"] = pc.if_else(pa.array(hit), now, cols["n_chars"])
            yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return rows.mapInArrow(run, docs.schema)
