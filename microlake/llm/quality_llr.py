"""Quality rules: hashed n-gram log-likelihood ratio, in DataFrame functions alone.

Texts are cut into lower-cased runs of letters and digits and runs of signs; single tokens
and neighbouring pairs are hashed into ``BUCKETS``. Two multinomials over the buckets, with
add-one smoothing, are counted: one over every document of the corpus, one over the trusted
ones. A document's score is the mean over its n-grams of log(trusted / corpus), and it is
kept if the score is at least ``THRESHOLD``: no draw, no noise. Base rules reject very short
and repetitive texts before.

The trusted set is a bounded sample (``TRUSTED`` labelled ids, chosen by digest); corpus
counts cover all documents. Counts are summed in the map tasks, so what is shuffled is at
most ``BUCKETS`` rows a task; the weight table of ``BUCKETS`` rows is broadcast.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_BREAK, stored, text_or_empty

BUCKETS, TRUSTED, THRESHOLD = 1 << 14, 5000, -0.3
LEAST_WORDS, MOST_REPEATED = 50, 50
_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
_SYMBOL = r"[#*$%&|<>]"
_IN_WORD = r"[^\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    """Runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return."""
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` (text_ not null) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated windows: the text's 3-word windows, as hashes, are sorted with their places; a
    window equal to a neighbour is repeated, and the words it covers count once.
    """
    text, words = F.col("text_"), F.col("words_")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(_IN_WORD))
    out = docs.withColumn("words_", words_of(text)) \
        .withColumn("lines_", lines) \
        .withColumn("n_words", F.size("words_").cast("long"))
    out = out.withColumn("windows_", F.when(
        F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                                           lambda k: F.xxhash64(F.get(words, k), F.get(words, k + 1), F.get(words, k + 2)))))
    out = out.withColumn("word_chars", F.length(F.array_join("words_", "")).cast("long")) \
        .withColumn("n_symbols", F.regexp_count(text, F.lit(_SYMBOL)).cast("long")) \
        .withColumn("n_dup_lines", (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long")) \
        .drop("words_", "lines_")
    windows, placed = F.col("windows_"), F.col("placed_")
    some = F.size(windows) > F.size(F.array_distinct(windows))
    out = out.withColumn("placed_", F.when(some, F.sort_array(
        F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))))
    repeated = F.transform(placed, lambda w, n: F.when(
        w["h"].eqNullSafe(F.get(placed, n - 1)["h"]) | w["h"].eqNullSafe(F.get(placed, n + 1)["h"]), w["k"]))
    out = out.withColumn("starts_", F.sort_array(F.filter(repeated, lambda k: k.isNotNull())))
    starts = F.col("starts_")
    covered = F.transform(starts, lambda k, n: F.coalesce(F.least(F.get(starts, n + 1) - k, F.lit(3)), F.lit(3)))
    return out.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
                          .cast("long")).drop("windows_", "placed_", "starts_")


def with_buckets(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs`` (text_) with ``grams_``, the buckets of its n-grams."""
    tokens = F.col("tokens_")
    pairs = F.when(F.size(tokens) >= 2, F.transform(
        F.sequence(F.lit(1), F.size(tokens) - 1),
        lambda k: F.pmod(F.xxhash64(F.get(tokens, k - 1), F.get(tokens, k)), F.lit(buckets)).cast("int")))
    single = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int"))
    return docs.withColumn("tokens_", F.regexp_extract_all(F.lower("text_"), F.lit(_TOKEN), F.lit(0))) \
        .withColumn("grams_", F.concat(single, F.coalesce(pairs, F.array().cast("array<int>")))).drop("tokens_")


def weights(spark: SparkSession, docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight): log ratio of the trusted to the corpus multinomial, both add-one smoothed.

    ``docs``: doc_id, text. ``trusted_ids``: doc_id, bounded. Buckets that no document has
    are absent. Without a trusted n-gram every weight is 0.
    """
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text_")) \
        .join(F.broadcast(trusted_ids.select(F.col("doc_id").alias("trusted_")).distinct()),
              F.col("doc_id") == F.col("trusted_"), "left")
    # outer: a plain explode infers a filter on the array, which would cut every text a second time for each of its tokens
    counts = with_buckets(marked, buckets) \
        .select(F.explode_outer("grams_").alias("bucket"), F.col("trusted_").isNotNull().alias("good")) \
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("good")).alias("t")).where(F.col("bucket").isNotNull())
    counts = stored(spark, counts, "ngram-counts")
    totals = counts.agg(F.sum("n").alias("all_n"), F.sum("t").alias("all_t")).first()
    all_n, all_t = totals["all_n"] or 0, totals["all_t"] or 0
    if not all_t:
        return counts.select("bucket", F.lit(0.0).alias("weight"))
    return counts.select("bucket", (F.log((F.col("t") + 1) / F.lit(float(all_t + buckets)))
                                    - F.log((F.col("n") + 1) / F.lit(float(all_n + buckets)))).alias("weight"))


def trusted_sample(labels: DataFrame, trusted: int = TRUSTED) -> DataFrame:
    """At most ``trusted`` doc_ids with quality 1 and no other quality, chosen by digest."""
    good = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
    return good.where("least = 1 AND most = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted).select("doc_id")


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED,
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept).

    One row per document row. Null and empty texts have no words: zeros, base_failed, score
    0. Repeated rows and null doc_ids are judged like any (rows are told apart by their place
    in the scan while their n-grams are summed). Empty tables work; other columns are not read.
    """
    table = weights(spark, docs, trusted_sample(labels, trusted), buckets)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text_")) \
        .withColumn("row_", F.monotonically_increasing_id())
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    grams = with_buckets(with_base(rows), buckets).select("row_", "doc_id", *base, F.explode_outer("grams_").alias("bucket"))
    scored = grams.join(F.broadcast(table), "bucket", "left").groupBy("row_", "doc_id", *base).agg(
        F.coalesce(F.avg("weight"), F.lit(0.0)).alias("score"))          # table: at most ``buckets`` rows
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.select("doc_id", *base, failed.alias("base_failed"), "score",
                         (~failed & (F.col("score") >= threshold)).alias("kept"))
