"""Quality classifier: interpolated modified Kneser-Ney model of byte n-grams
trained on trusted text; language-specific quantiles of per-byte perplexity. A
second model of toxic labelled text is compared with it over windows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import table, written

ORDER = 4
SAMPLE_DOCS = 20_000    # bound of the fitting samples of a language, trusted and toxic, by hashes of doc_id
WINDOW = 16     # bytes over which the toxic and the clean model are compared
QUANTILE, MARGIN = 0.99, 1.25   # cut: quantile of log perplexity times margin
LONG, FEW = 6, 20   # bands of length: 2^k bytes and more up to 2^LONG; trusted texts that a short band needs
SCORES = "n_bytes long, log2_prob double, perplexity double, toxicity double"


def grams(raw, n):
    """Codes of all byte n-grams (n <= 4) as uint32."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    k = len(b) - n + 1
    if k <= 0:
        return np.empty(0, np.uint32)
    code = np.zeros(k, np.uint32)
    for i in range(n):
        code = (code << np.uint32(8)) | b[i:i + k]
    return code


def count_grams(texts):
    """Distributed counts of the highest order of (text, part): partial counts in
    each task, then sharded by part * 2^32 + n-gram and summed."""
    def run(batches):
        for b in batches:
            parts = [grams(b"\n\n\n" + (t or "").encode(), ORDER).astype(np.int64) | k << 32
                     for t, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            if parts:
                code, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["g", "n"])
    return texts.select("text", "part").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def lower_orders(top):
    """Counts by order, highest first: below the top, a gram's count is the
    number of different bytes that precede it (a sharded count for each order)."""
    out, cur = [top], top
    for n in range(ORDER - 1, 0, -1):
        part = F.col("g") - F.col("g") % (1 << 32)
        cur = cur.select((part + F.col("g") % (1 << (8 * n))).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
        out.append(cur)
    return out


def fit(code, n, below):
    """Interpolated modified Kneser-Ney of one order: sorted codes and their
    probabilities, sorted contexts and their back-off weights."""
    order = np.argsort(code)
    code, n = code[order], n[order].astype(float)
    c1, c2, c3, c4 = (max(1, int((n == k).sum())) for k in (1, 2, 3, 4))
    y = c1 / (c1 + 2 * c2)
    d = np.clip([0, 1 - 2 * y * c2 / c1, 2 - 3 * y * c3 / c2, 3 - 4 * y * c4 / c3], 0.05, [0.05, 0.95, 1.9, 2.9])
    disc = d[np.minimum(n, 3).astype(int)]
    ctx, at = np.unique(code >> 8, return_index=True)
    total = np.add.reduceat(n, at)
    bow = np.add.reduceat(disc, at) / total
    each = np.repeat(np.arange(len(ctx)), np.diff(np.append(at, len(code))))
    p = (n - disc) / total[each] + bow[each] * below(code)
    return code, p, ctx, bow


class Model:
    """Probabilities by order, lowest first; every byte has a probability above 0."""

    def __init__(self, counts):
        self.levels = []
        for n, (code, c) in enumerate(counts, 1):
            self.levels.append(fit(code, c, lambda x, k=n - 1: self.prob(x, k)))

    def prob(self, code, order):
        if order == 0:
            return np.full(len(code), 1 / 256)
        code = code & ((1 << (8 * order)) - 1)
        keys, p, ctx, bow = self.levels[order - 1]
        at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        seen = keys[at] == code
        out = np.where(seen, p[at], 0.0)
        miss = np.flatnonzero(~seen)
        if len(miss):
            c = code[miss] >> 8
            j = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
            out[miss] = np.where(ctx[j] == c, bow[j], 1.0) * self.prob(code[miss], order - 1)
        return out

    def score(self, raw):
        """(bytes, sum of log2 probabilities); distinct n-grams are looked up once."""
        total, step = 0.0, 1 << 20
        for i in range(0, max(len(raw), 1), step):
            code = grams((b"\n\n\n" + raw[:step]) if i == 0 else raw[i - 3:i + step], ORDER)
            u, n = np.unique(code, return_counts=True)
            if len(u):
                total += float((np.log2(self.prob(u.astype(np.int64), ORDER)) * n).sum())
        return len(raw), total


def toxicity(pair, raw):
    """Largest log2 ratio of the toxic to the clean model of a pair over windows of
    WINDOW bytes, at least 0: a few words show in a long text."""
    (clean, toxic), best, step, before = pair, 0.0, 1 << 20, np.empty(0)
    for i in range(0, len(raw), step):
        u, at = np.unique(grams((b"\n\n\n" + raw[:step]) if i == 0 else raw[i - 3:i + step], ORDER), return_inverse=True)
        u = u.astype(np.int64)
        ratio = np.append(before, (np.log2(toxic.prob(u, ORDER)) - np.log2(clean.prob(u, ORDER)))[at])
        total, w = np.append(0.0, np.cumsum(ratio)), min(WINDOW, len(ratio))
        best, before = max(best, float((total[w:] - total[:-w]).max())), ratio[1 - WINDOW:]
    return best


def marked(labels):
    """One row a labelled document: trusted (quality 1 and not toxic), toxic."""
    toxic = F.coalesce(F.max("toxic") == 1, F.lit(False))
    return labels.groupBy("doc_id").agg((F.coalesce(F.max("quality") == 1, F.lit(False)) & ~toxic).alias("trusted"),
                                        toxic.alias("toxic"))


def fitted(top, parts):
    """Model of each part, None for a part without counts."""
    counts = [[] for _ in range(parts)]
    for level in lower_orders(top):
        t = level.toPandas()
        g, n = t["g"].to_numpy(np.int64), t["n"].to_numpy(np.int64)
        for k, c in enumerate(counts):
            c.append((g[g >> 32 == k] & 0xFFFFFFFF, n[g >> 32 == k]))
    return [Model(c[::-1]) if len(c[0][0]) else None for c in counts]


def sampled(docs, labels):
    """(doc_id, toxic) of the documents to fit on: about SAMPLE_DOCS trusted and as
    many toxic ones of each language, so their ids may be broadcast."""
    langs = docs.groupBy("doc_id").agg(F.coalesce(F.min("lang"), F.lit("")).alias("lang"))
    of = written(docs.sparkSession, marked(labels).where("trusted OR toxic").join(langs, "doc_id"), "marked")
    share = of.groupBy("lang", "toxic").agg((SAMPLE_DOCS / F.count("*")).alias("share"))   # two rows a language
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    return of.join(F.broadcast(share), ["lang", "toxic"]).where(place < F.col("share")).select("doc_id", "toxic")


def train(docs, labels):
    """The model of the trusted sample (None if nothing is trusted), and two pairs
    (clean model, toxic model). Texts are halved by their crc32, and pair h is fitted on
    the other half only: no text is compared by models that have seen it, so labelled
    and other texts have the same scores. Without toxic labels the pairs are None.
    The distinct byte n-grams of the sample come to the driver."""
    spark = docs.sparkSession
    half = F.crc32(F.coalesce("text", F.lit(""))) % 2
    picked = docs.join(F.broadcast(sampled(docs, labels)), "doc_id").select(
        "text", (F.col("toxic").cast("long") * 2 + half).alias("part"))
    halves = written(spark, count_grams(picked), "grams")
    both = halves.where(F.col("g") < 2 << 32).groupBy((F.col("g") % (1 << 32) + (4 << 32)).alias("g")).agg(F.sum("n").alias("n"))
    *clean, toxic0, toxic1, model = fitted(written(spark, halves.unionByName(both), "grams"), 5)
    clean, toxic = clean[::-1], [toxic1, toxic0]
    pairs = [(c, t) if c and t else None for c, t in zip(clean, toxic)]
    return model, [pairs[0] or pairs[1], pairs[1] or pairs[0]]


def scored(docs, labels, columns):
    """The given columns of docs, and SCORES of each text; each text is read once."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def measure(text):
        raw, (m, pairs) = (text or "").encode(), shared.value
        n, s = m.score(raw) if m else (len(raw), 0.0)
        pair = pairs[zlib.crc32(raw) % 2]
        return n, s, 2.0 ** (-s / n) if n else 1.0, toxicity(pair, raw) if pair else 0.0

    names, kinds = [x.split()[0] for x in SCORES.split(", ")], [pa.int64(), *[pa.float64()] * 3]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                got = zip(*[measure(t) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns),
                                                  *(pa.array(x, k) for x, k in zip(got, kinds))], [*columns, *names])

    schema = StructType([docs.schema[c] for c in columns] + StructType.fromDDL(SCORES).fields)
    return docs.select(*dict.fromkeys([*columns, "text"])).mapInArrow(run, schema)


def quantiles(trusted):
    """Cuts of perplexity by (band, language), by band and of toxicity by language;
    the key "" stands for all languages. A few rows a language."""
    cut = (F.percentile(F.round("perplexity", 4), QUANTILE) * MARGIN).alias("cut")
    mild = F.percentile(F.round("toxicity", 4), QUANTILE).alias("toxic_cut")
    own = {(r.band, r._lang): (r.cut, r.n) for r in trusted.where("n_bytes > 0").groupBy("band", "_lang").agg(
        cut, F.count("*").alias("n")).collect()}
    every = {r.band: r.cut for r in trusted.where("n_bytes > 0").groupBy("band").agg(cut).collect()}
    toxic = {r._lang: r.toxic_cut for r in trusted.groupBy("_lang").agg(mild).collect()}
    return own, every, toxic | {"": trusted.agg(mild).first().toxic_cut}


def cut_table(own, every, langs):
    """(band, language) to cut. A band below the longest needs FEW trusted texts of the
    language, or else has the cut of all languages; a band without any trusted text has
    that of the next longer one that has some, or else of the next shorter."""
    if not every:
        return {}
    out = {}
    for band in range(LONG + 1):
        near = next((k for k in [*range(band, LONG + 1), *range(band - 1, -1, -1)] if k in every))
        for lang in [*langs, ""]:
            cut, n = own.get((band, lang), (None, 0))
            out[band, lang] = cut if lang and (n >= FEW or n and band == LONG) else every[near]
    return out


def judged(docs, labels, columns):
    """The given columns of docs (doc_id and lang among them), SCORES, cut, toxic_cut
    and kept. The scores are written once, the cuts are quantiles of all trusted
    documents (of scores to 4 places, so equal ones are counted together)."""
    spark = docs.sparkSession
    band = F.least(F.floor(F.log2(F.greatest("n_bytes", F.lit(1)))), F.lit(LONG)).cast("int")
    rows = written(spark, scored(docs, labels, columns), "scores").withColumns(
        {"_lang": F.coalesce("lang", F.lit("")), "band": band})
    trusted = written(spark, rows.select("doc_id", "_lang", "band", "n_bytes", "perplexity", "toxicity").join(
        marked(labels).where("trusted").select("doc_id"), "doc_id"), "trusted")
    own, every, toxic = quantiles(trusted)
    langs = sorted({lang for _, lang in own} - {""})
    cuts = {f"{b}:{lang}": x for (b, lang), x in cut_table(own, every, langs).items()}

    def look(table, name, *keys):
        pairs = [F.lit(x) for kv in table.items() for x in kv]
        found = [F.element_at(F.create_map(*pairs), k) for k in keys] if table else []
        return F.coalesce(*found, F.lit(None)).cast("double").alias(name)

    rows = rows.select(
        "*", look(cuts, "cut", F.concat_ws(":", "band", "_lang"), F.concat_ws(":", "band", F.lit(""))),
        look({k: v for k, v in toxic.items() if v is not None}, "toxic_cut", F.col("_lang"), F.lit("")))
    good = F.col("cut").isNull() | (F.col("n_bytes") == 0) | (F.col("perplexity") <= F.col("cut"))
    mild = F.col("toxic_cut").isNull() | (F.col("toxicity") <= F.col("toxic_cut"))
    return rows.withColumn("kept", good & mild).drop("_lang", "band")


def classify(docs, labels):
    """One row per document: n_bytes, log2_prob, perplexity (per byte), cut, toxicity,
    toxic_cut, kept.

    Good: null and empty texts, all texts if nothing is trusted, texts of a language
    without a trusted document that stay under the cut of all languages, else those
    under the cut of their language; texts under 2^LONG bytes have cuts by their
    length (see cut_table). Kept are good texts whose toxicity stays under its cut,
    of their language or of all. Repeated rows give repeated results.
    """
    return judged(docs, labels, ["doc_id", "lang"]).select(
        "doc_id", "n_bytes", "log2_prob", "perplexity", "cut", "kept", "toxicity", "toxic_cut")


def op4(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark, docs, sf_dir):
    """Keep the accepted rows, in one pass over the texts. The columns of docs travel in
    one column of their own, so their names are free."""
    rows = docs.select("doc_id", "lang", "text", F.struct(*docs.columns).alias("row"))
    return judged(rows, table(spark, sf_dir, "labels"), ["doc_id", "lang", "row"]).where("kept").select("row.*")
