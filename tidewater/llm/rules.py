"""Quality rules in DataFrame functions only: base counts and the distance of a
text's character-class and common-word histograms from its language."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import table

SPACE = r"[\x20\x09-\x0D]+"
CLASSES = ["lower", "upper", "digit", "mark", "wide"]
# how each class is taken out, in this order
LEFT = {"lower": "[a-z]+", "upper": "[A-Z]+", "digit": "[0-9]+", "space": SPACE,
        "mark": r"[!-/:-@\[-`{-~]+", "wide": r"[^\x00-\x7F]+"}
COMMON = 16          # common words a language
SHARDS = 256         # parts in which the words of a language are ranked first
MAX_LANGS = 1000     # references (under 1 KB each) that may be broadcast
MIN_CHARS = 200      # below, the class histogram is not judged
MIN_COMMON = 20      # fewer common words: their histogram is not judged
MAX_CLASS = 0.25     # Jensen-Shannon distances above which a text is rejected
MAX_WORDS = 0.75


def counts(docs):
    words = F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != "")
    df = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"),
                     F.coalesce("text", F.lit("")).alias("text")).withColumn("w", words)
    n = F.size("w")
    grams = F.expr("CASE WHEN size(w) < 3 THEN cast(array() AS array<bigint>) ELSE "
                   "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END")
    df = df.withColumn("g", grams)
    # starts of repeated windows: sorted (window, place) pairs equal to a neighbour
    df = df.withColumn("s", F.expr(
        "CASE WHEN size(array_distinct(g)) = size(g) THEN cast(array() AS array<struct<h:bigint,i:int>>) "
        "ELSE sort_array(transform(g, (h, i) -> struct(h AS h, i AS i))) END"))
    df = df.withColumn("p", F.expr(
        "array_sort(transform(filter(s, (x, k) -> (k > 0 AND s[k - 1].h = x.h) OR "
        "(k + 1 < size(s) AND s[k + 1].h = x.h)), x -> x.i))"))
    repeat = F.expr("aggregate(p, named_struct('n', 0L, 'e', 0), (a, i) -> "
                    "named_struct('n', a.n + (i + 3 - greatest(i, a.e)), 'e', i + 3), a -> a.n)")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # each class is taken out of what the ones before have left, so that only the first
    # pass reads the whole text; a run is one match
    left = "text"
    for k, v in LEFT.items():
        df = df.withColumn(f"no_{k}", F.regexp_replace(left, v, ""))
        df = df.withColumn(k, (F.length(left) - F.length(f"no_{k}")).cast("long"))
        left = f"no_{k}"
    return df.select("doc_id", "lang", "w", n.cast("long").alias("n_words"),
                     (F.length("text") - F.col("space")).cast("long").alias("word_chars"),
                     F.length(F.regexp_replace("no_space", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                     (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                     repeat.alias("n_repeat_words"), *CLASSES)


def distance(p, q):
    """Jensen-Shannon distance (base 2) of two count arrays; null if one is empty."""
    return F.expr(f"""sqrt(greatest(0D, aggregate(zip_with(
        transform({p}, x -> x / aggregate({p}, 0D, (a, b) -> a + b)),
        transform({q}, x -> x / aggregate({q}, 0D, (a, b) -> a + b)),
        (a, b) -> 0.5D * (CASE WHEN a > 0 THEN a * log2(2 * a / (a + b)) ELSE 0D END
                        + CASE WHEN b > 0 THEN b * log2(2 * b / (a + b)) ELSE 0D END)),
        0D, (a, b) -> a + b)))""")


def quality(docs):
    """Base counts, distances and verdict for each document.

    The references are the histograms of all documents of a language (null
    language: one of its own). Null text has no words and fails the base rule;
    texts under the minimum lengths are not judged by the histogram concerned.
    """
    df = counts(docs)
    one = F.explode(F.split(F.coalesce("text", F.lit("")), SPACE)).alias("word")
    freq = (docs.select(F.coalesce("lang", F.lit("")).alias("lang"), one).where("word != ''")
            .groupBy("lang", "word").count())
    # bounded: COMMON words for each language
    # first among the words of a shard, so no task sees all words of a language
    rank = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.desc("count"), "word"))
    top = freq.withColumn("shard", F.pmod(F.xxhash64("word"), F.lit(SHARDS)))
    top = top.withColumn("r", rank("shard")).where(F.col("r") <= COMMON)
    top = top.withColumn("r", rank()).where(F.col("r") <= COMMON)
    refs = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "word", "count"))).alias("t"))
    refs = refs.select("lang", F.col("t.word").alias("ref_words"), F.col("t.count").alias("ref_counts"))
    classes = df.groupBy("lang").agg(F.array(*[F.sum(k) for k in CLASSES]).alias("ref_classes"))
    # one short row a language: broadcast up to MAX_LANGS of them, else a shuffled join
    few = docs.select("lang").distinct().limit(MAX_LANGS + 1).count() <= MAX_LANGS
    side = F.broadcast if few else (lambda x: x)
    df = df.join(side(refs), "lang", "left").join(side(classes), "lang", "left")
    df = (df.withColumn("cw", F.expr("concat(' ', array_join(filter(w, x -> array_contains(ref_words, x)), '  '), ' ')"))
          .withColumn("own_words", F.expr(
              "transform(ref_words, c -> (length(cw) - length(replace(cw, concat(' ', c, ' '), ''))) div (length(c) + 2))"))
          .withColumn("own_classes", F.array(*CLASSES))
          .withColumn("n_chars", F.expr("aggregate(own_classes, 0L, (a, b) -> a + b)"))
          .withColumn("n_common", F.expr("aggregate(own_words, 0L, (a, b) -> a + b)"))
          .withColumn("class_distance", F.when(F.col("n_chars") >= MIN_CHARS, distance("own_classes", "ref_classes")))
          .withColumn("word_distance", F.when(F.col("n_common") >= MIN_COMMON, distance("own_words", "ref_counts")))
          .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")))
    verdict = (F.coalesce(F.col("class_distance"), F.lit(0.0)) <= MAX_CLASS) & \
              (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= MAX_WORDS)
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "base_failed", (~F.col("base_failed") & verdict).alias("kept"),
                     "class_distance", "word_distance")


def op5(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"))
