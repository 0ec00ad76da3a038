"""Periodic runs of words by difference-cover LCE (operator 11).

A run is a stretch of words with smallest period q (words q apart are equal), at least MIN_LENGTH and
MIN_PERIODS * q long, which no neighbouring word extends at that period.

1. Cover: places whose remainder modulo PERIOD lies in COVER. For any two places a shift below PERIOD brings both
   onto the cover (the remainders are a difference cover). Only suffixes that start there are sorted: by blocks of
   PERIOD words, then, while some are tied, by prefix doubling, as the suffix a block further is on the cover too.
2. LCE (how many words two places have in common from there on): compare the few words up to the synchronised
   places, then take the minimum over the common prefixes of neighbours in sorted order (a sparse table).
3. Harmonic grid: for every period q the places 0, q, 2q .. are paired with their next neighbours, n / q pairs, so
   n log n in all. A run holds three neighbouring grid places at least. At the first of them the LCE reaches
   two periods further; a binary search with LCEs finds where the run starts before it, the LCE itself its end.
   A period that is a multiple of a smaller one gives the same stretch: the smallest stays.

Documents are worked on in batches of about BATCH_WORDS words, as one sequence in which every document ends with a
sign of its own, so nothing reaches from one into the next.

Results in special cases: null, empty and blank texts have no words and no run; texts of any length are taken
whole (memory grows with a single text's words and their logarithm); of equally long runs the first counts as the
longest, then the one of the smaller period; a repeated row is returned each time; rows without a `doc_id` are
returned like others, and the query never rewrites them; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from memberlytics.llm.common import crc32_sql, map_rows, table

MIN_LENGTH = 6
MIN_PERIODS = 4
PERIOD = 13
# A perfect difference set modulo 13.
COVER = [0, 1, 3, 9]
BATCH_WORDS = 100_000
# Grid pairs looked at in one go.
PAIRS = 2_000_000


def cover_shifts() -> np.ndarray:
    """For each pair of remainders the smallest shift that brings both onto the cover."""
    on = np.isin(np.arange(PERIOD), COVER)
    shift = np.full((PERIOD, PERIOD), -1)
    for d in reversed(range(PERIOD)):
        moved = on[(np.arange(PERIOD) + d) % PERIOD]
        shift[np.outer(moved, moved)] = d
    return shift


SHIFTS = cover_shifts()
# Rank of a remainder among those of the cover.
SLOT = np.searchsorted(COVER, np.arange(PERIOD))


class CoverIndex:
    """LCE of places of `ids`, a sequence whose last item occurs nowhere else in it."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = np.concatenate((ids, np.full(2 * PERIOD, ids[-1])))  # for blocks that reach beyond the end
        rounds = -(-len(ids) // PERIOD)
        self.at = (np.arange(rounds)[:, None] * PERIOD + np.array(COVER)[None, :]).ravel()
        self.at = self.at[self.at < len(ids)]
        levels = self.sort_samples()
        self.rank = levels[-1]
        order = np.empty(len(self.at), np.int64)
        order[self.rank] = np.arange(len(self.at))
        self.table = sparse_table(self.neighbours_in_common(order, levels))

    def sort_samples(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first PERIOD * 2 ** k words; the last ranks are unique."""
        width = max(1, 62 // max(1, int(self.ids.max()).bit_length()))  # words that fit into one key
        order, rank = np.arange(len(self.at)), np.zeros(len(self.at), np.int64)
        for first in range(0, PERIOD, width):
            key = np.zeros(len(self.at), np.int64)
            for k in range(first, min(first + width, PERIOD)):
                key = key << int(self.ids.max()).bit_length() | self.ids[self.at + k]
            order, rank = refined(order, rank, key)
        levels, step = [rank], len(COVER)
        while True:
            tied = np.zeros(len(rank), bool)
            ordered = rank[order]
            tied[1:] = ordered[1:] == ordered[:-1]
            if not tied.any():
                return levels
            # The suffix `step` samples further starts PERIOD * step / len(COVER) words further.
            key = np.concatenate((rank[step:], np.zeros(min(step, len(rank)), np.int64)))
            order, rank = refined(order, rank, key)
            levels.append(rank)
            step *= 2

    def neighbours_in_common(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words in common of each sampled suffix, in sorted order, with the one before it."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels) - 1)):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            common[same] += PERIOD << k
            a[same] += len(COVER) << k
            b[same] += len(COVER) << k
        left = np.arange(len(a))
        for d in range(PERIOD):
            left = left[self.ids[self.at[a[left]] + d] == self.ids[self.at[b[left]] + d]]
            common[left] += 1
        return common

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words in common from places `a` and (different) places `b` on."""
        shift = SHIFTS[a % PERIOD, b % PERIOD]
        out, left = np.zeros(len(a), np.int64), np.arange(len(a))
        synchronised = []
        for d in range(PERIOD):
            there = shift[left] == d
            synchronised.append(left[there])
            left = left[~there]
            left = left[self.ids[a[left] + d] == self.ids[b[left] + d]]
            out[left] = d + 1
            if not len(left):
                break
        left = np.concatenate(synchronised)
        ranks = [self.rank[self.sample(x[left] + shift[left])] for x in (a, b)]
        out[left] = shift[left] + range_minimum(self.table, np.minimum(*ranks), np.maximum(*ranks))
        return out

    def sample(self, at: np.ndarray) -> np.ndarray:
        return at // PERIOD * len(COVER) + SLOT[at % PERIOD]


def refined(order: np.ndarray, rank: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort by (`rank`, `key`), given the order by `rank`, moving only what is tied; a rank is the first place of its group."""
    ordered = rank[order]
    same = ordered[1:] == ordered[:-1]
    tied = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
    if not len(tied):
        return order, rank
    held = order[tied]
    held = held[np.lexsort((key[held], rank[held]))]
    order, rank = order.copy(), rank.copy()
    order[tied] = held
    fresh = np.ones(len(held), bool)
    fresh[1:] = (ordered[tied][1:] != ordered[tied][:-1]) | (key[held][1:] != key[held][:-1])
    rank[held] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(held)), 0))]
    return order, rank


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Row k holds the minima of 2 ** k neighbouring values."""
    rows, size = [values.astype(np.int32)], 1
    while 2 * size <= len(values):
        rows.append(np.minimum(rows[-1][:-size], rows[-1][size:]))
        size *= 2
    return rows


def range_minimum(rows: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minima of values[low:high], each range with a value at least."""
    out = np.zeros(len(low), np.int64)
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    for k in np.unique(level):
        some = np.flatnonzero(level == k)
        out[some] = np.minimum(rows[k][low[some]], rows[k][high[some] - (1 << int(k))])
    return out


def grid_pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(place, period, first place of its document) of all grid places with a next one, in portions of about PAIRS."""
    longest = sizes // MIN_PERIODS  # the largest period with a run
    doc = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    pairs = (sizes[doc] - 1) // period
    ends = np.cumsum(pairs)
    first = 0
    while first < len(doc):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS)))
        count = pairs[first:last]
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        q, origin = np.repeat(period[first:last], count), np.repeat(starts[doc[first:last]], count)
        yield origin + k * q, q, origin
        first = last


def find_runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in documents at `starts`, each followed by a sign of its own; sorted."""
    index, found = CoverIndex(ids), [np.zeros((0, 3), np.int64)]
    for place, q, origin in grid_pairs(starts, sizes):
        some = np.flatnonzero(index.ids[place] == index.ids[place + q])
        place, q, origin = place[some], q[some], origin[some]
        reach = index.lce(place, place + q)
        some = np.flatnonzero(reach >= np.maximum(2 * q, 1))
        place, q, origin, reach = place[some], q[some], origin[some], reach[some]
        # The run starts in (place - q, place], or the grid place before is its first one.
        low, high = np.maximum(place - q + 1, origin), place.copy()
        before = np.flatnonzero(place - q >= origin)
        earlier = np.zeros(len(place), bool)
        earlier[before] = index.lce(place[before] - q[before], place[before]) >= q[before]
        while True:
            wide = np.flatnonzero((low < high) & ~earlier)
            if not len(wide):
                break
            middle = (low[wide] + high[wide]) // 2
            holds = index.lce(middle, middle + q[wide]) >= place[wide] - middle
            high[wide[holds]] = middle[holds]
            low[wide[~holds]] = middle[~holds] + 1
        end = place + reach + q
        runs = ~earlier & (end - high >= np.maximum(MIN_LENGTH, MIN_PERIODS * q))
        found.append(np.column_stack((high, end, q))[runs])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # The same stretch at a multiple of its period.
    multiple = np.zeros(len(rows), bool)
    multiple[1:] = (rows[1:, :2] == rows[:-1, :2]).all(axis=1)
    rows = rows[~multiple]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split on exactly space and 0x09 to 0x0D


def runs_of(documents: list[list[bytes]]) -> Iterator[np.ndarray]:
    """For each document (a list of words) its runs: rows (start, length, period) by start, then period."""
    sizes = np.array([len(words) for words in documents], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ids, number = np.empty(int(sizes.sum()) + len(sizes), np.int64), {}
    for start, words in zip(starts.tolist(), documents, strict=True):
        ids[start : start + len(words)] = [number.setdefault(word, len(number)) for word in words]
    ids[starts + sizes] = len(number) + np.arange(len(sizes))
    rows = find_runs(ids, starts, sizes)
    cuts = np.searchsorted(rows[:, 0], starts)
    for start, a, b in zip(starts, cuts, [*cuts[1:], len(rows)], strict=True):
        yield np.column_stack((rows[a:b, 0] - start, rows[a:b, 1] - rows[a:b, 0], rows[a:b, 2]))


def in_batches(rows: Iterable[tuple], words: int = BATCH_WORDS) -> Iterator[list[tuple]]:
    """Rows whose last item is a list of words, together until they hold so many."""
    batch, size = [], 0
    for row in rows:
        batch.append(row)
        size += len(row[-1]) + 1
        if size >= words:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that are left when every run shrinks to its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(word for word, gone in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not gone)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """`doc_id`, `start`, `length`, `period` of every run of every row, in words."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for batch in in_batches((doc_id, words_of(text)) for doc_id, text in rows):
            for (doc_id, _), runs in zip(batch, runs_of([words for _, words in batch]), strict=True):
                yield from ((doc_id, *run) for run in runs.tolist())

    return map_rows(docs, rows_of, "doc_id bigint, start bigint, length bigint, period bigint")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text` with every run shrunk to its first period; texts with a run have one space between words."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for batch in in_batches((doc_id, text, words_of(text)) for doc_id, text in rows):
            for (doc_id, text, words), runs in zip(batch, runs_of([words for *_, words in batch]), strict=True):
                yield doc_id, collapsed(words, runs).decode() if len(runs) else text

    return map_rows(docs, rows_of, "doc_id bigint, text string", out_rows=1000)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's rewriting: one document in ten repeats a stretch of its own words to its end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def summary(words: list[bytes], runs: np.ndarray) -> tuple:
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs.tolist())
    hashes = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest()
    if not len(runs):
        return (0, None, None, None, None, *hashes)
    start, length, period = min(runs.tolist(), key=lambda run: (-run[1], run[0], run[2]))
    return (len(runs), start, length, period, 1000 * length // period, *hashes)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for batch in in_batches((doc_id, planted(doc_id, words_of(text))) for doc_id, text in rows):
            for (doc_id, words), runs in zip(batch, runs_of([words for _, words in batch]), strict=True):
                yield doc_id, *summary(words, runs)

    result = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    return map_rows(table(spark, sf_dir, "documents"), rows_of, result)


# Equal words of a document in all pairs, so for tables of moderate size only.
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g, coalesce(h % 10 = 0, false) AND len(w) > 0 AS changed FROM d),
f AS (SELECT *, CASE WHEN changed THEN g % n END AS a FROM e),
k AS (SELECT *, CASE WHEN changed THEN 1 + (n - a) // (3 + g % 8) END AS p FROM f),
words AS (
  SELECT r, n, i, w[1 + CASE WHEN changed AND i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM k)),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // {MIN_PERIODS}),
stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS stretch FROM pairs)
  GROUP BY r, q, stretch HAVING count(*) + q >= greatest({MIN_LENGTH}, {MIN_PERIODS} * q)),
runs AS (SELECT r, s, length, min(q) AS q FROM stretches GROUP BY r, s, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    first({{'s': s, 'length': length, 'q': q}} ORDER BY length DESC, s, q) AS top FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + length)) AS i FROM runs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE gone.i IS NULL) AS left_over FROM words LEFT JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(top.length AS BIGINT) AS length, CAST(top.q AS BIGINT) AS period,
  CAST(1000 * top.length // top.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
