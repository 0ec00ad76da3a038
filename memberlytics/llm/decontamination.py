"""Benchmark decontamination with spaced seeds (operator 9), in column functions only.

A document is contaminated by an item if WINDOW consecutive words of both, aligned, differ in at
most SUBSTITUTIONS places. Words are runs of letters and digits, in lower case.

1. Seeds: a mask takes some words at fixed places from a position on and ignores the others. The
   two masks are such that, wherever two of 13 words are replaced, one mask still finds a place
   inside the window with all its words intact. So joining the hashes of masked words misses nothing.
2. A hit fixes the alignment (place in the document minus place in the item). Around the hits the
   aligned words are compared, and windows that tolerate the substitutions are counted.

The benchmark side is broadcast only when counted below BROADCAST_SEEDS; else it is joined by
shuffle, where adaptive execution splits frequent seeds.

Results in special cases: null and empty texts have no words and are clean; items under WINDOW words
are too short to tell and match nothing; repeated rows, and repeated items, are each reported once;
rows without a `doc_id`, and items without an `item_id`, are searched like others, and the result holds them under null; extra columns
are ignored, also where both tables have one of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, table

WINDOW = 13
SUBSTITUTIONS = 2
# Places that each mask takes; proven for WINDOW and SUBSTITUTIONS in the tests.
MASKS = [[0, 1, 2, 3, 5, 6], [0, 1, 2, 4, 7, 8]]
BROADCAST_SEEDS = 500_000


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    return F.transform(words, lambda word: F.xxhash64(word))


def sign() -> Column:
    """Hash of the id and text of a document."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def seeds(hashes: str) -> Column:
    """Array of (seed, position) of all masks at all positions."""
    size = F.size(hashes)

    def masked(n: int, mask: list[int]) -> Column:
        last = size - mask[-1]
        hashed = F.transform(
            F.sequence(F.lit(0), last - 1),
            lambda at: F.struct(F.xxhash64(F.lit(n), *[F.get(hashes, at + k) for k in mask]).alias("seed"), at.alias("at")),
        )
        return F.when(last >= 1, hashed).otherwise(F.array().cast("array<struct<seed:bigint,at:int>>"))

    return F.concat(*[masked(n, mask) for n, mask in enumerate(MASKS)])


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """`item` (a key of id and words, never null), `item_id`, `item_words`."""
    items = benchmark.select("item_id", word_hashes(F.coalesce("text", F.lit(""))).alias("item_words")).distinct()
    return items.where(F.size("item_words") >= WINDOW).select(F.xxhash64("item_id", "item_words").alias("item"), "item_id", "item_words")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """As `signed_overlaps`, without the sign."""
    return signed_overlaps(docs, benchmark).drop("sign").distinct()


def signed_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`sign` (hash of id and text), `doc_id`, `item_id`, `doc_start` (place of the item's first word in the document, maybe
    negative), `n_aligned`, `n_equal` words of each contaminating alignment."""
    items = cut(benchmark_items(benchmark), "items")
    of_items = cut(
        items.select("item", F.size("item_words").alias("n"), F.explode(seeds("item_words")).alias("s"))
        .select(F.col("s.seed").alias("seed"), "item", F.col("s.at").alias("item_at"), "n")
        .distinct(),
        "item_seeds",
    )
    if of_items.count() <= BROADCAST_SEEDS:
        of_items = F.broadcast(of_items)

    # Rows are told apart by id and text: repeated rows are one document.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("sign", sign())
    hashed = texts.select("sign", word_hashes(F.col("text")).alias("doc_words"))
    placed = hashed.select("sign", F.inline(seeds("doc_words")))
    hits = (
        placed.join(of_items, "seed")
        .select("sign", "item", (F.col("at") - F.col("item_at")).alias("doc_start"), "n")
        .distinct()
    )
    # Hits of a document are few: at most one per alignment.
    per_doc = cut(hits.groupBy("sign").agg(F.collect_list(F.struct("item", "doc_start", "n")).alias("hits")), "hits")

    found = texts.join(per_doc, "sign").select("sign", "doc_id", word_hashes(F.col("text")).alias("doc_words"), "hits")

    def sliced(hit: Column) -> Column:
        begin = F.greatest(hit["doc_start"], F.lit(0))
        end = F.least(hit["doc_start"] + hit["n"], F.size("doc_words"))
        return F.struct(hit["item"], hit["doc_start"], (begin - hit["doc_start"]).alias("skip"), F.slice("doc_words", begin + 1, end - begin).alias("there"))

    rows = found.select("sign", "doc_id", F.inline(F.transform("hits", sliced))).join(items, "item")
    length = F.size("there")
    same = F.zip_with("there", F.slice("item_words", F.col("skip") + 1, length), lambda a, b: (a == b).cast("int"))
    compared = rows.select("sign", "doc_id", "item_id", "doc_start", length.alias("n_aligned"), same.alias("same"))

    def intact(at: Column) -> Column:
        return F.aggregate(F.slice("same", at, WINDOW), F.lit(0), lambda total, x: total + x) >= WINDOW - SUBSTITUTIONS

    enough = compared.where(F.col("n_aligned") >= WINDOW)
    enough = enough.where(F.exists(F.sequence(F.lit(1), F.col("n_aligned") - WINDOW + 1), intact))
    equal = F.aggregate("same", F.lit(0), lambda total, x: total + x)
    return enough.select("sign", "doc_id", "item_id", "doc_start", "n_aligned", equal.alias("n_equal")).distinct()


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without an overlap; each row is judged by its own text."""
    dirty = signed_overlaps(docs, benchmark).select(F.col("sign").alias("_dirty")).distinct()
    return docs.join(dirty, sign() == F.col("_dirty"), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark),
dw AS (SELECT doc_id, len(w) AS m, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
bw AS (SELECT item_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS q FROM b WHERE len(w) >= {WINDOW}),
eq AS (SELECT doc_id, item_id, p - q AS doc_start, m, n, p FROM dw JOIN bw USING (word)),
counted AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, doc_start ORDER BY p RANGE BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS c
  FROM eq)
SELECT doc_id, item_id, CAST(doc_start AS INT) AS doc_start,
  CAST(least(doc_start + n, m) - greatest(doc_start, 0) AS INT) AS n_aligned, CAST(count(*) AS INT) AS n_equal
FROM counted GROUP BY doc_id, item_id, doc_start, m, n
HAVING max(c) >= {WINDOW - SUBSTITUTIONS} AND least(doc_start + n, m) - greatest(doc_start, 0) >= {WINDOW}
"""
