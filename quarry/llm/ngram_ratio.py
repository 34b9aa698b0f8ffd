"""Quality rules by a hashed n-gram likelihood ratio (operator 3); DataFrame
functions only.

Base rules count characters, symbols, repeated lines and repeated 5-word
windows of every text. Documents that pass them are scored: a text's tokens
(runs of word characters, runs of other visible characters) and its pairs of
neighbouring tokens are hashed into BUCKETS buckets; a bucket's weight is the
log of its share among trusted documents over its share in the raw corpus;
the score is the mean weight of the text's n-grams. A text is kept if its
score reaches THRESHOLD, a fixed number: every document is judged, and by
itself.

The raw counts cover the whole corpus, the trusted counts all documents that
`labels` calls good; both are taken in one pass, with partial sums before the
shuffle, and end in one row of BUCKETS numbers, which the scoring plan holds as
a constant.

Nulls count as texts without words, which fail the base rules. Everything
about one text happens within its row, however long it is; repeated rows are
judged alike. An empty table gives no rows; other columns, which may have any
name, are not read. With no trusted documents all weights are 0 and base rules
alone decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE_CLASS, table, written
from quarry.llm.url_cascade import cascade

BUCKETS = 1 << 14
SMOOTH = 1.0                # added to each bucket's count
THRESHOLD = -0.4            # least mean log-ratio of a kept text
WINDOW = 5
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def window_hashes(words_: Column, size: int = WINDOW) -> Column:
    """A hash of each window of neighbouring words, in order, from the words'
    own hashes: each word is hashed once."""
    def windows(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + t) for t in range(size)]))

    hashed = F.transform(F.array(F.transform(words_, lambda w: F.xxhash64(w))), windows)
    return F.when(F.size(words_) >= size, F.element_at(hashed, 1)).otherwise(F.array().cast("array<bigint>"))


def repeated_words(windows: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows found twice or more: equal windows are
    brought together by sorting (hash, place), then the places of those that
    have an equal neighbour are swept from left to right."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def sweep(pairs_):
        places = F.sort_array(F.transform(F.filter(
            F.transform(pairs_, lambda p, j: F.struct(
                p.i.alias("i"),
                ((p.h == F.get(pairs_, j - 1).h).eqNullSafe(True)
                 | (p.h == F.get(pairs_, j + 1).h).eqNullSafe(True)).alias("again"))),
            lambda q: q.again), lambda q: q.i))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(places, start, lambda acc, i: F.struct(
            (i + size).alias("end"), (acc.n + i + size - F.greatest(acc.end, i)).alias("n")), lambda acc: acc.n)

    # a one-element transform names the sorted array, so that it is made once
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        F.element_at(F.transform(F.array(pairs), sweep), 1))


def base_rules(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text not null) with the base counts."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = (docs.withColumn("words", words(text))
              .withColumn("windows", window_hashes(F.col("words")))
              .withColumn("lines", lines))
    n = F.size("words")
    return df.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"))


def buckets(text: Column) -> Column:
    """The buckets of a text's tokens and token pairs."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), 0)

    def hashed(t):
        one = F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))
        two = F.when(F.size(t) >= 2, F.transform(
            F.sequence(F.lit(0), F.size(t) - 2),
            lambda i: F.pmod(F.xxhash64(F.get(t, i), F.get(t, i + 1)), F.lit(BUCKETS)).cast("int"))
        ).otherwise(F.array().cast("array<int>"))
        return F.concat(one, two)

    return F.element_at(F.transform(F.array(tokens), hashed), 1)


def _counts(texts: DataFrame) -> DataFrame:
    """(bucket, raw, trusted) of (text, good)."""
    return (texts.select(F.explode(buckets(F.col("text"))).alias("bucket"), "good")
                 .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("good").alias("trusted")))


def weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: `weights`, an array of BUCKETS log-ratios.

    Which documents are trusted is asked of a Bloom cascade of the good ids
    over the ids of the corpus, a constant of the plan: exact, and no text is
    joined or shuffled."""
    spark = docs.sparkSession
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").alias("key"))
    own = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    trusted = cascade(good, own.select(F.col("id").alias("key")))
    known = F.coalesce(trusted.holds(F.col("id"), "f") & F.col("id").isNotNull(), F.lit(False))
    counts = _counts(trusted.attach(own, "f").select("text", known.alias("good")))
    both = (spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
                 .join(counts, "bucket", "left").fillna(0, ["raw", "trusted"]))
    row = both.agg(F.sum("raw").alias("nr"), F.sum("trusted").alias("nt"),
                   F.sort_array(F.collect_list(F.struct("bucket", "raw", "trusted"))).alias("b"))
    one = F.lit(SMOOTH * BUCKETS)
    return written(row.select(F.transform("b", lambda x: F.when(F.col("nt") == 0, F.lit(0.0)).otherwise(
        F.ln((x.trusted + SMOOTH) / (F.col("nt") + one)) - F.ln((x.raw + SMOOTH) / (F.col("nr") + one)))
    ).alias("weights")), "weights")


def score(text: Column, weights_: Column) -> Column:
    """Mean weight of the text's n-grams; 0 for a text without any."""
    def mean(b):
        return F.when(F.size(b) == 0, F.lit(0.0)).otherwise(
            F.aggregate(b, F.lit(0.0), lambda acc, x: acc + F.get(weights_, x)) / F.size(b))
    return F.element_at(F.transform(F.array(buckets(text)), mean), 1)


def verdicts(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, the base counts, base_failed, kept, score)."""
    w = weights(docs, labels)
    src = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = base_rules(src).withColumn("w", w.scalar())
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (df.withColumn("score", score(F.col("text"), F.col("w")))
              .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"),
                      F.round("score", 6).alias("score")))


def query(spark, sf_dir) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
