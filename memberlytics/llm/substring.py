"""Removal of repeated word windows with difference-cover anchors (operator 5).

The numbers in COVER form a difference cover modulo PERIOD: for any two places i and j there is a
shift d < PERIOD for which both (i + d) and (j + d) fall on the cover modulo PERIOD. So hashing only
at cover places, and only `WINDOW - PERIOD + 1` words at each, two equal windows always share an
anchor at the same place inside the window.

1. Anchors: hashes at cover places, 6 of 31; those in a single document go.
2. Extension: around each shared anchor all windows that hold it are hashed in full (96 bits), and
   the smallest document of every window hash is found with map-side combining.
3. Removal: words covered by a window whose smallest document comes earlier.

A document that repeats another's whole word sequence needs none of this: all its words go (or none,
below WINDOW words), so only the first of exact copies takes part.

Results in special cases: null or empty text has no words; documents under WINDOW words stay whole;
rows with one `doc_id` are one document (a repeat inside it removes nothing), unless their texts
differ, then each row is judged by its own words (and none by another text of its id); rows without a `doc_id` neither lose words nor cost others any;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, map_blocks, map_rows, table

WINDOW = 50
PERIOD = 31
# A perfect difference set modulo 31.
COVER = [1, 5, 11, 24, 25, 27]
SPAN = WINDOW - PERIOD + 1
# Word hashes that a Python process remembers at most, and the longest word that it does.
MEMO = 300_000
LONGEST = 64
# Odd multipliers of two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class WordHashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO and len(word) <= LONGEST:
            self[word] = value
        return value


HASHES = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split on exactly space and 0x09 to 0x0D


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finalizer with good avalanche)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of the `width` values from each place on: doubling sums of powers, without a loop over places."""
    total, done, have, size = np.zeros(len(hashes) - width + 1, np.uint64), 0, hashes, 1
    while width:
        if width & size:
            total = total * np.uint64(pow(base, size, 1 << 64)) + have[done : done + len(total)]
            done, width = done + size, width - size
        if width:
            have = have[:-size] * np.uint64(pow(base, size, 1 << 64)) + have[size:]
            size *= 2
    return mix(total)


def cover_places(n_words: int) -> np.ndarray:
    at = np.arange(n_words - SPAN + 1)
    return at[np.isin(at % PERIOD, COVER)]


def digests(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_words`, `sha` (of the words joined by one space) of every row."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            words = words_of(text)
            yield doc_id, len(words), hashlib.sha256(b" ".join(words)).hexdigest()

    return map_rows(docs, rows_of, "doc_id bigint, n_words bigint, sha string")


def anchors(docs: DataFrame) -> DataFrame:
    """`anchor`, `doc_id`, `place` of every cover place of documents that hold a window."""

    def blocks_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            words = words_of(text)
            if len(words) >= WINDOW:
                places = cover_places(len(words))
                values = rolling(hash_words(words), SPAN, BASES[0])[places].view(np.int64)
                yield values, np.full(len(places), doc_id), places.astype(np.int32)

    return map_blocks(docs, blocks_of, "anchor bigint, doc_id bigint, place int")


def windows_around(words: list[bytes], places: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Windows that hold one of the anchors, each content once: its hashes (64 and 32 bits)."""
    last = len(words) - WINDOW
    at = np.asarray([place for place in places if place <= len(words) - SPAN], np.int64)
    starts = np.unique((at[:, None] - np.arange(PERIOD)[None, :]).ravel())
    starts = starts[(starts >= 0) & (starts <= last)]
    if not len(starts):
        return (np.zeros(0, np.int64), np.zeros(0, np.int32))
    hashes = hash_words(words)
    first, second = (rolling(hashes, WINDOW, base)[starts] for base in BASES)
    _, once = np.unique(first, return_index=True)
    return first[once].view(np.int64), second[once].astype(np.uint32).view(np.int32)


def kept(words: list[bytes], repeated: list[int]) -> tuple[int, str]:
    """Words removed by windows with one of the hashes in `repeated`, and the hash of what is left."""
    starts = np.zeros(0, np.int64)
    if len(words) >= WINDOW:
        hashes = rolling(hash_words(words), WINDOW, BASES[0])
        starts = np.flatnonzero(np.isin(hashes, np.asarray(repeated, np.int64).view(np.uint64)))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    gone = np.cumsum(edge[:-1]) > 0
    left = b" ".join(word for word, out in zip(words, gone.tolist(), strict=True) if not out)
    return int(gone.sum()), hashlib.sha256(left).hexdigest()


def anchored(docs: DataFrame) -> DataFrame:
    """`doc_id`, `places` of the anchors that a document shares with another one."""
    placed = anchors(docs)
    several = placed.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    return placed.join(several.select("anchor"), "anchor").groupBy("doc_id").agg(F.collect_list("place").alias("places"))


def repeated_windows(docs: DataFrame, located: DataFrame) -> DataFrame:
    """`doc_id`, `repeated`: hashes of its windows that an earlier document holds too.

    Anchors of all texts of an id are looked at in each of them: that adds windows to compare, no result.
    """

    def blocks_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, places in rows:
            first, second = windows_around(words_of(text), places)
            yield np.full(len(first), doc_id), first, second

    around = docs.join(located, "doc_id")
    windows = map_blocks(around, blocks_of, "doc_id bigint, h1 bigint, h2 int", ("doc_id", "text", "places"))
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = first.where("first_id < last_id").drop("last_id")
    later = windows.join(first, ["h1", "h2"]).where("first_id < doc_id")
    return later.groupBy("doc_id").agg(F.collect_list("h1").alias("repeated"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `kept_sha256` of every row of `docs`.

    From the anchors on it is one Spark plan: the texts, shuffled by `doc_id` once, serve both the
    extension and the removal (a reused exchange), as do the windows.
    """
    docs = docs.select("doc_id", "text")
    named = docs.where("doc_id IS NOT NULL")
    whole = cut(digests(docs), "digests")
    first = whole.groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)) & (F.col("n_words") >= WINDOW)
    judged = cut(whole.join(first, "sha").withColumn("copy", copy).drop("first_id"), "judged")

    # Later exact copies have nothing to add: the first of them holds the same windows. Another text of
    # the same id has, so only ids with nothing but copies stay out.
    later = judged.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_and("copy").alias("only")).where("only").select("doc_id")
    located = cut(anchored(named).join(later, "doc_id", "left_anti"), "anchored")
    repeats = repeated_windows(named, located)

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, repeated in rows:
            words = words_of(text)
            sha = hashlib.sha256(b" ".join(words)).hexdigest()
            yield (doc_id, sha, *kept(words, repeated))

    result = "doc_id bigint, sha string, cut_words bigint, cut_sha string"
    trimmed = map_rows(named.join(repeats, "doc_id"), rows_of, result, ("doc_id", "text", "repeated"))
    trimmed = trimmed.groupBy("doc_id", "sha").agg(F.min("cut_words").alias("cut_words"), F.min("cut_sha").alias("cut_sha"))
    return judged.join(trimmed, ["doc_id", "sha"], "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("cut_words", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(EMPTY_SHA)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT r, doc_id, a, md5(array_to_string(list_slice(w, a, a + {WINDOW - 1}), ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS a FROM d WHERE doc_id IS NOT NULL)),
firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT r, unnest(range(a, a + {WINDOW})) AS p FROM windows JOIN firsts USING (h) WHERE first_id < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
left_over AS (
  SELECT r, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS kept
  FROM words LEFT JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (r)
"""
