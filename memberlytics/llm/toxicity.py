"""Toxicity scores by a convolutional text classifier (operator 6).

Words are hashed to buckets, and buckets that enough training documents hold have rows of an embedding
table (all others share one row); filters of several widths slide over the text, the
largest response of each filter over the whole text is kept, and a logistic layer turns these into a
score. Embeddings, filters and the layer are trained with numpy, on the driver, on a documented,
bounded sample: at most SAMPLE labelled documents per class, those with the smallest hash of their
id, whose words reach the driver as buckets. Where the sample has another share of toxic documents than all
labelled rows, the intercept is moved to theirs, so a score means the same on any size. The weights have a
fixed size and are broadcast. Scoring runs over whole texts in any number of tasks.

A filter is linear in its words, so each (filter, offset) pair is a table from word to number, and a
text is scored by adding table rows: the same convolution without a product per word.

Thresholds are calibrated by language, on all labelled clean documents that are neither held out nor
trained on, scored in Spark: the lowest score at which at most CLEAN_LOSS of those of the language would be
rejected (ranks are exact to 1 / RANKS of them). Languages seldom seen take the threshold of all. Language
decides only the threshold, never the score.

Results in special cases: null and empty texts have the score of a text of padding only; texts
of any length count whole; ids or labels that are null are not learned from; repeated rows are
each scored, and each count for a threshold; without labels of both classes every score is 0; extra columns, also of the names of
labels, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, map_rows, table

BUCKETS = 1 << 22
SIZE = 12
WIDTHS = (1, 2, 3)
FILTERS = 12
# Labelled documents per class that training takes at most.
SAMPLE = 3000
EPOCHS = 5
# Words that a Python process remembers at most, and the longest one that it does.
MEMO = 300_000
LONGEST = 64
# Documents that must hold a word before its class counts give it a start.
SEEN = 3
THRESHOLD = 0.7
CLEAN_LOSS = 0.01
# Accuracy of the ranks behind the thresholds.
RANKS = 100_000
# Clean documents of a language below which it has no threshold of its own.
LEAST = 100


def fold() -> Column:
    """Fold 1 is held out: nothing is learned from it."""
    return F.crc32(F.col("doc_id").cast("string")) % 3


class Buckets(dict):
    """Bucket of a word, remembered: case and signs around it do not count."""

    def __missing__(self, word: str) -> int:
        bucket = 1 + zlib.crc32(word.lower().strip(".,;:!?\"'()*#%&$").encode()) % (BUCKETS - 1)
        if len(self) < MEMO and len(word) <= LONGEST:
            self[word] = bucket
        return bucket


OF_WORD = Buckets()


def word_ids(text: str | None) -> np.ndarray:
    """Buckets of all words, with padding (bucket 0) so that every filter fits."""
    words = (text or "").split()
    pad = max(WIDTHS) - 1
    ids = np.zeros(len(words) + 2 * pad, np.int32)
    ids[pad : pad + len(words)] = np.fromiter(map(OF_WORD.__getitem__, words), np.int32, len(words))
    return ids


@dataclass
class Model:
    rows: np.ndarray  # bucket -> row of the embedding; row 0 is padding, row 1 all other words
    embedding: np.ndarray  # rows x SIZE
    filters: dict[int, np.ndarray]  # width -> width x SIZE x FILTERS
    bias: np.ndarray  # all filters
    weights: np.ndarray  # all filters
    intercept: float

    def tables(self) -> dict[int, list[np.ndarray]]:
        """For each width and offset, the responses to every word."""
        return {w: [(self.embedding @ f[k]).astype(np.float32) for k in range(w)] for w, f in self.filters.items()}

    def pooled(self, ids: np.ndarray, tables: dict[int, list[np.ndarray]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of every filter over the text, and where it is."""
        best, where = [], []
        for width, filters in self.filters.items():
            places = len(ids) - width + 1
            if tables:
                response = sum(tables[width][k][ids[k : k + places]] for k in range(width))
            else:
                windows = self.embedding[ids]
                response = sum(windows[k : k + places] @ filters[k] for k in range(width))
            at = response.argmax(axis=0)
            best.append(response[at, np.arange(FILTERS)])
            where.append(at)
        return np.concatenate(best) + self.bias, np.concatenate(where)

    def score(self, ids: np.ndarray, tables: dict[int, list[np.ndarray]] | None = None) -> float:
        pooled, _ = self.pooled(self.rows[ids], tables)
        return float(1 / (1 + np.exp(-(np.maximum(pooled, 0) @ self.weights + self.intercept))))


def class_lean(texts: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in at least SEEN documents, and how far these lean to label 1: smoothed log odds
    over their standard error."""
    seen = {label: [np.unique(ids) for ids, y in zip(texts, labels, strict=True) if y == label] for label in (0, 1)}
    buckets, total = np.unique(np.concatenate(seen[0] + seen[1]), return_counts=True)
    buckets = buckets[(total >= SEEN) & (buckets > 0)]
    counts = np.zeros((2, len(buckets)))
    for label in (0, 1):
        have, n = np.unique(np.concatenate(seen[label]), return_counts=True)
        at = np.minimum(np.searchsorted(have, buckets), len(have) - 1)
        counts[label] = np.where(have[at] == buckets, n[at], 0)
    sizes = np.array([[len(seen[0])], [len(seen[1])]])
    odds = np.log((counts + 0.5) / (sizes + 1))
    return buckets, (odds[1] - odds[0]) / np.sqrt((1 / (counts + 0.5)).sum(axis=0))


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Stochastic gradient descent with adaptive steps (Adagrad) on the log loss, classes weighted by the root of their share.

    The first component of the embedding starts as the class lean of the word, seen by the first
    filter of every width; the rest starts at random.
    """
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    buckets, lean = class_lean(texts, labels)
    rows = np.ones(BUCKETS, np.int32)
    rows[0] = 0
    rows[buckets] = np.arange(2, len(buckets) + 2)
    texts = [rows[ids] for ids in texts]
    model = Model(
        rows,
        rng.normal(0, 0.1, (len(buckets) + 2, SIZE)),
        {w: rng.normal(0, 0.3, (w, SIZE, FILTERS)) for w in WIDTHS},
        np.zeros(n),
        rng.normal(0, 0.3, n),
        0.0,
    )
    model.embedding[:, 0] = np.concatenate(([0, 0], lean))
    for width, filters in model.filters.items():
        filters[:, :, 0] = 0
        filters[0, 0, 0] = 1 if width == 1 else 0.5
        model.weights[WIDTHS.index(width) * FILTERS] = 0.5
    model.intercept = -2.0
    share = labels.mean()
    balance = {1: (0.5 / share) ** 0.5, 0: (0.5 / (1 - share)) ** 0.5}
    squares = {"e": np.full(len(model.embedding), 1e-3), "b": np.full(n, 1e-3), "w": np.full(n, 1e-3), "i": 1e-3}
    squares |= {("f", w): np.full(model.filters[w].shape, 1e-3) for w in WIDTHS}
    rate = 0.05
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            ids = texts[i]
            pooled, where = model.pooled(ids)
            active = pooled > 0
            hidden = np.where(active, pooled, 0)
            p = 1 / (1 + np.exp(-(hidden @ model.weights + model.intercept)))
            error = (p - labels[i]) * balance[int(labels[i])]
            back = error * model.weights * active
            gradient = error * hidden + 1e-4 * model.weights
            squares["w"] += gradient**2
            model.weights -= rate * gradient / np.sqrt(squares["w"])
            squares["i"] += error**2
            model.intercept -= rate * error / np.sqrt(squares["i"])
            squares["b"] += back**2
            model.bias -= rate * back / np.sqrt(squares["b"])
            for j, width in enumerate(WIDTHS):
                of = slice(j * FILTERS, (j + 1) * FILTERS)
                at, delta, filters = where[of], back[of], model.filters[width]
                for k in range(width):
                    words = ids[at + k]
                    to_filter = model.embedding[words].T * delta + 1e-5 * filters[k]
                    to_words = (filters[k] * delta).T
                    squares["f", width][k] += to_filter**2
                    filters[k] -= rate * to_filter / np.sqrt(squares["f", width][k])
                    np.add.at(squares["e"], words, (to_words**2).mean(axis=1))
                    np.add.at(model.embedding, words, -rate * to_words / np.sqrt(squares["e"][words])[:, None])
    return model


def known_labels(labels: DataFrame) -> DataFrame:
    """`doc_id`, `label` outside the held-out fold."""
    return labels.select("doc_id", F.col("toxic").alias("label")).where(F.col("label").isin(0, 1) & (fold() != 1)).distinct()


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[int, int, np.ndarray]]:
    """(doc_id, label, buckets of all words) of at most `sample` labelled documents per class outside the held-out fold."""
    known = known_labels(labels)
    # At most twice `sample` rows, so the join may broadcast them.
    chosen = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for label in (0, 1)
    ]
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id").dropDuplicates(["doc_id", "label"])

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        yield from ((doc_id, label, word_ids(text).tobytes()) for doc_id, label, text in rows)

    hashed = map_rows(rows, rows_of, "doc_id bigint, label int, ids binary", ("doc_id", "label", "text"))
    found = sorted((row.doc_id, row.label, row.ids) for row in hashed.collect())
    return [(doc_id, label, np.frombuffer(ids, np.int32)) for doc_id, label, ids in found]


def class_odds(labels: DataFrame) -> float:
    """Logarithm of toxic over clean documents among all that may be learned from."""
    counts = {row.label: row.n for row in known_labels(labels).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return float(np.log(counts[1] / counts[0]))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model, list[int]] | None:
    """The model, and the ids of the documents that taught it."""
    rows = training_rows(docs, labels, sample)
    # Every fifth document is left to the thresholds; the others teach.
    taught = [row for k, row in enumerate(rows) if k % 5 != 4]
    y = np.array([label for _, label, _ in taught])
    if len(set(y.tolist())) < 2:
        return None
    model = train([ids for _, _, ids in taught], y)
    # Training weighs classes by the root of their share, so half the difference is left to make up.
    of_sample = np.log(y.sum() / (len(y) - y.sum()))
    model.intercept += 0.5 * (class_odds(labels) - of_sample)
    return model, [doc_id for doc_id, _, _ in taught]


def calibrate(labels: DataFrame, taught: list[int], scores: DataFrame) -> DataFrame:
    """`lang`, `threshold` from the `scores` of all rows: a row per language seen often enough, and a row without
    one that counts for all others."""
    spark = labels.sparkSession
    clean = known_labels(labels).where("label = 0").select("doc_id")
    of_model = spark.createDataFrame([(i,) for i in taught], "doc_id bigint")
    own = scores.join(clean.join(F.broadcast(of_model), "doc_id", "left_anti"), "doc_id").select("lang", "score")
    columns = [F.count(F.lit(1)).alias("n"), F.percentile_approx("score", 1 - CLEAN_LOSS, RANKS).alias("score")]
    own = cut(own, "calibrating")
    found = [(None, row) for row in own.agg(*columns).collect()]
    found += [(row.lang, row) for row in own.where("lang IS NOT NULL").groupBy("lang").agg(*columns).where(F.col("n") >= LEAST).collect()]
    # Just over that score, so equals of it stay; never under one half: a score that says "clean" rejects nothing.
    limits = [(lang, max(0.5, float(np.nextafter(row.score, 2))) if row.n else 0.5) for lang, row in found]
    return spark.createDataFrame(limits, "lang string, threshold double")


def with_threshold(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """`scores` with the threshold of their language. There are few: each has LEAST documents or more."""
    of_all = thresholds.where("lang IS NULL").select("threshold").scalar()
    own = F.broadcast(thresholds.where("lang IS NOT NULL"))
    return scores.join(own, "lang", "left").withColumn("threshold", F.coalesce("threshold", of_all))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[Model, dict[str | None, float]] | None:
    """The model, and the threshold of each language (under None that of all others)."""
    learned = learn(docs, labels, sample)
    if not learned:
        return None
    model, taught = learned
    judged = docs.join(known_labels(labels).where("label = 0").select("doc_id"), "doc_id", "left_semi")
    return model, {row.lang: row.threshold for row in calibrate(labels, taught, scored(judged, model)).collect()}


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id`, `lang`, `sign` (hash of the text), `score` of every row."""
    weights = docs.sparkSession.sparkContext.broadcast(model)

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        model = weights.value
        tables = model.tables() if model else None
        for doc_id, lang, text, sign in rows:
            yield doc_id, lang, sign, model.score(word_ids(text), tables) if model else 0.0

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    signed = docs.select("doc_id", lang.alias("lang"), "text", F.xxhash64("text").alias("sign"))
    return map_rows(signed, rows_of, "doc_id bigint, lang string, sign bigint, score double", ("doc_id", "lang", "text", "sign"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`scored`, with the `threshold` of the language and whether the row is `rejected` by it (none without labels)."""
    learned = learn(docs, labels)
    if not learned:
        return scored(docs, None).select("*", F.lit(1.0).alias("threshold"), F.lit(False).alias("rejected"))
    model, taught = learned
    scores = cut(scored(docs, model), "toxicity")
    found = with_threshold(scores, calibrate(labels, taught, scores))
    return found.withColumn("rejected", F.col("score") >= F.col("threshold"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without those at or over the threshold of their language (all of them without labels)."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    gone = judged(docs, labels).where("rejected").select("doc_id", "lang", "sign").distinct().toDF("_doc_id", "_lang", "_sign")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_sign")) & lang.eqNullSafe(F.col("_lang"))
    # Merged at every size: what is rejected grows with the documents.
    return docs.join(gone.hint("merge"), same, "left_anti")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id",
        F.coalesce(fold() == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "threshold",
        "rejected",
    )
