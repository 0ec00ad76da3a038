"""Quality rules: base counts, and a hashed n-gram likelihood ratio (operator 12), in column functions only.

1. Base rules count what the text itself shows: words, symbols, repeated lines, words in repeated windows of
   REPEAT_WINDOW words. A document fails them with under MIN_WORDS words, or with over REPEAT_PERCENT of its
   words in repeated windows.
2. Two multinomials over BUCKETS hash buckets of tokens and pairs of neighbouring tokens: one counted over the
   trusted documents (`labels.quality` = 1), one over the raw corpus, that is all documents. Both get SMOOTHING
   per bucket; the logarithm of their ratio, in whole millionths, is the weight of a bucket.
3. The score of a document is the mean weight of its n-grams. Every document at THRESHOLD or above is kept,
   every other one goes: nothing is drawn by chance, and sums of whole numbers do not depend on their order.

Tokens are runs of letters and digits, or of other signs, in lower case. What reaches the scoring is one array of
BUCKETS numbers, whatever the corpus. Windows are compared by 64-bit hashes of their words, within one text only.

Results in special cases: null and empty texts have no words and fail the base rules; texts of any length are
judged whole, in the time of a sort; a repeated row is counted and judged each time; rows without a `doc_id`
are judged like others and are never trusted; a document is trusted if one of its labels says so; without any
trusted document both multinomials are the raw one and every score is 0; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import bound, cut, table

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"
# A power of two.
BUCKETS = 1 << 14
SMOOTHING = 1.0
# Mean logarithm of the ratio (nats an n-gram) from which a document is kept.
THRESHOLD = -0.3
UNIT = 1_000_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK, -1), lambda word: word != "")


def repeated_words(words: Column, width: int = REPEAT_WINDOW) -> Column:
    """How many of `words` lie in a window of `width` that the array holds more than once."""

    def windows(hashes: Column) -> Column:
        hashed = F.transform(F.sequence(F.lit(1), F.size(hashes) - width + 1), lambda at: F.xxhash64(F.slice(hashes, at, width)))
        return F.when(F.size(hashes) >= width, hashed).otherwise(F.array().cast("array<bigint>"))

    def starts(windows: Column) -> Column:
        """Where windows start that the array holds again: by hash, they stand beside an equal one."""
        by_hash = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("h"), at.alias("at"))))

        def found(placed: Column) -> Column:
            def start(window: Column, k: Column) -> Column:
                alike = [F.coalesce(F.get(placed, k + d)["h"] == window["h"], F.lit(False)) for d in (-1, 1)]
                return F.when(alike[0] | alike[1], window["at"])

            return F.filter(F.transform(placed, start), lambda at: at.isNotNull())

        return F.sort_array(bound(by_hash, found))

    def add(covered: Column, at: Column) -> Column:
        return F.struct(at.alias("last"), (covered["total"] + F.least(F.lit(width), at - covered["last"])).alias("total"))

    def covered(windows: Column) -> Column:
        none = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("total"))
        total = F.aggregate(starts(windows), none, add, lambda state: state["total"])
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(0)

    return bound(bound(F.transform(words, lambda word: F.xxhash64(word)), windows), covered)


def base_counts(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text`, `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, `base_failed`."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        bound(
            words_of(text),
            lambda words: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                repeated_words(words).cast("long").alias("n_repeat_words"),
            ),
        ).alias("of_words"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        bound(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
    )
    counted = found.select("doc_id", "text", "of_words.n_words", "of_words.word_chars", "n_symbols", "n_dup_lines", "of_words.n_repeat_words")
    repetitive = F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repetitive)


def buckets(text: Column, size: int = BUCKETS) -> Column:
    """Array of the buckets of all tokens and of all pairs of neighbouring tokens."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))

    def bucket(hashed: Column) -> Column:
        return hashed.bitwiseAND(size - 1).cast("int")

    def grams(h: Column) -> Column:
        pairs = F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h)), lambda a, b: bucket(F.xxhash64(a, b)))
        return F.when(F.size(h) > 1, F.concat(F.transform(h, bucket), pairs)).otherwise(F.transform(h, bucket))

    return bound(F.transform(tokens, lambda token: F.xxhash64(token)), grams)


def bucket_counts(texts: DataFrame, name: str, size: int = BUCKETS) -> DataFrame:
    """`bucket`, and in column `name` how many n-grams of all `texts` it holds."""
    grams = texts.where("text IS NOT NULL").select(F.explode(buckets(F.col("text"), size)).alias("bucket"))
    return grams.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def ratio_weights(docs: DataFrame, labels: DataFrame, size: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """`bucket`, `weight`: the logarithm of trusted over raw probability, in millionths; a row per bucket."""
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    raw = bucket_counts(docs, "raw", size)
    # Merged at every size: both sides grow with the documents, so a broadcast would only suit small tables.
    target = bucket_counts(docs.select("doc_id", "text").join(trusted.hint("merge"), "doc_id", "left_semi"), "target", size)
    every = docs.sparkSession.range(size).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(raw, "bucket", "left").join(target, "bucket", "left").fillna(0, ["raw", "target"])
    # BUCKETS rows, so the totals and the array are small whatever the corpus.
    counts = cut(counts, "bucket-counts")
    totals = counts.agg(F.sum("raw").alias("raws"), F.sum("target").alias("targets"))
    raws, targets = (cut(totals, "bucket-totals").select(column).scalar() for column in ("raws", "targets"))
    ratio = F.log((F.col("target") + smoothing) / (targets + smoothing * size)) - F.log((F.col("raw") + smoothing) / (raws + smoothing * size))
    weight = F.when(targets > 0, F.round(ratio * UNIT)).otherwise(0)
    return counts.select("bucket", weight.cast("bigint").alias("weight"))


def score(text: Column, weights: Column, size: int = BUCKETS) -> Column:
    """Mean weight of the n-grams of `text` in millionths, null without any."""

    def mean(held: Column) -> Column:
        total = F.aggregate(held, F.lit(0).cast("bigint"), lambda sum_, bucket: sum_ + F.get(weights, bucket))
        return F.when(F.size(held) > 0, total / F.size(held))

    return bound(buckets(text, size), mean)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, size: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """`base_counts` of every row, with `score` (nats an n-gram) and `kept`."""
    weights = cut(ratio_weights(docs, labels, size, smoothing), "bucket-weights")
    ordered = F.sort_array(F.collect_list(F.struct("bucket", "weight")))["weight"]
    array = cut(weights.agg(ordered.alias("weights")), "weights").scalar()
    scored = base_counts(docs).withColumn("weights", array).withColumn("score", score(F.col("text"), F.col("weights"), size))
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold * UNIT, F.lit(False))
    return scored.withColumns({"score": F.col("score") / UNIT, "kept": kept}).drop("weights", "text")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("score")
