"""Token ids in Re-Pair compressed shards (operator 4).

The file format is Parquet with a row per shard of about SHARD_TOKENS tokens, in ascending document
order (`part` is the place of the writing task in that order, `shard` the place within it):

    part int, shard int, n_tokens bigint
    doc_ids      array<bigint>   documents of the shard, in order
    doc_tokens   uint32 each     tokens per document
    doc_symbols  uint32 each     symbols per document
    symbols      uint16 each     what Re-Pair left of the token ids; width in `symbol_bytes`
    rules        uint32 pairs    nonterminal `first_nonterminal + i` stands for pair i
    lengths      uint32 each     tokens that nonterminal i expands to

Re-Pair replaces the most frequent pairs of neighbours by nonterminals until none is frequent. A
round takes all pairs at least a quarter as frequent as the leading one, left to right without
overlap. No pair begins with the end id or what ends in it, so no rule crosses a document's end, and a document (or,
by the expansion lengths, any span of its tokens) is decoded without touching the rest.

Results in special cases: null text is an empty text, whose only token is the end id; rows without
a `doc_id` come first; repeated rows are each written, one after the other; an empty table writes
no shard; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from memberlytics.llm.common import map_rows, partitions, table
from memberlytics.llm.encoders import as_bytes, default_path, encoded, word_pieces
from memberlytics.sources.versions import shared_folder

END_ID = 1
VOCABULARY = "word_bpe_49k.json"
FIRST_NONTERMINAL = 49_408
# Rules keep symbols in 16 bits.
MAX_RULES = 65_535 - FIRST_NONTERMINAL
SHARD_TOKENS = 1_000_000
# Characters encoded at a time: twice the usual, as nothing else of a pipeline keeps memory beside this.
CHARACTERS = 2_000_000
# A rule has to spare more than the eight bytes and the length that it costs.
MIN_COUNT = 16
# Cells of a table of pairs by both symbols, beyond which pairs are searched for.
TABLE = 4_000_000
SHARD = (
    "part int, shard int, n_tokens bigint, doc_ids array<bigint>, doc_tokens binary, doc_symbols binary, "
    "symbols binary, symbol_bytes int, first_nonterminal int, rules binary, lengths binary"
)


def pair_keys(seq: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pairs that start at places `at`, as numbers: symbols have 16 bits."""
    return seq[at] << np.uint32(16) | seq[at + 1]


def places_around(size: int, *places: np.ndarray) -> np.ndarray:
    """The different places from 0 to `size` - 1 among all of `places`, in order."""
    marked = np.zeros(size + 2, bool)  # the last two take what lies outside, -1 as well
    for at in places:
        marked[np.minimum(at, size)] = True
    return np.flatnonzero(marked[:size])


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ordered = np.sort(keys)
    front = np.flatnonzero(np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1])))
    return ordered[front], np.diff(np.append(front, len(ordered)))


def number_of_pair(pairs: np.ndarray, seq: np.ndarray, at: np.ndarray, symbols: int) -> np.ndarray:
    """Which of `pairs` starts at each of the places `at`, -1 for none; both symbols there occur in `pairs` on their side."""
    sides = []
    for found, here in ((pairs >> np.uint32(16), seq[at]), (pairs & np.uint32(0xFFFF), seq[at + 1])):
        used, row = np.unique(found, return_inverse=True)
        place = np.zeros(symbols, np.int64)
        place[used] = np.arange(len(used))
        sides.append((row, place[here], len(used)))
    (left, left_here, n), (right, right_here, m) = sides
    if n * m > TABLE:
        keys = pair_keys(seq, at)
        near = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        return np.where(pairs[near] == keys, near, -1)
    numbers = np.full(n * m, -1, np.int64)
    numbers[left * m + right] = np.arange(len(pairs))
    return numbers[left_here * m + right_here]


def compress(ids: np.ndarray, end_id: int = END_ID, first: int = FIRST_NONTERMINAL) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (pairs) of a Re-Pair grammar of `ids`.

    Pairs are sorted and counted once. What a round puts in holds a symbol of its own, so counts of earlier
    pairs only fall, by those around the replaced places, and a pair below MIN_COUNT is forgotten.
    """
    if len(ids) and int(ids.max()) >= first:
        raise ValueError(f"token ids reach {int(ids.max())}, the format has room for those below {first}")
    seq, rules = ids.astype(np.uint32), []
    closes = np.zeros(first + MAX_RULES + 1, bool)  # symbols whose last token is the end id
    closes[end_id] = True

    def inner(at: np.ndarray) -> np.ndarray:
        return pair_keys(seq, at[~closes[seq[at]]])

    pairs_known, counts = counted(inner(np.arange(len(seq) - 1)))
    while len(rules) < MAX_RULES:
        frequent = counts >= MIN_COUNT
        pairs_known, counts = pairs_known[frequent], counts[frequent]
        if not len(counts):
            break
        floor = max(MIN_COUNT, int(counts.max()) // 4)
        often = np.flatnonzero(counts >= floor)
        often = np.sort(often[np.argsort(-counts[often], kind="stable")[: MAX_RULES - len(rules)]])
        pairs = pairs_known[often]
        # Cheap tests of either side leave few places to look up.
        sides = np.zeros(first + MAX_RULES + 1, np.uint8)
        sides[pairs >> np.uint32(16)] = 1
        sides[pairs & np.uint32(0xFFFF)] |= 2
        side = sides[seq]
        at = np.flatnonzero(side[:-1] & side[1:] >> 1)
        rule = number_of_pair(pairs, seq, at, len(sides))
        at, rule = at[rule >= 0], rule[rule >= 0]
        # In a run of neighbouring hits every second one stands.
        starts = np.concatenate(([True], np.diff(at) != 1))
        begin = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        stands = (np.arange(len(at)) - begin) % 2 == 0
        at, rule = at[stands], rule[stands]

        gone, times = counted(inner(places_around(len(seq) - 1, at - 1, at, at + 1)))
        there = np.minimum(np.searchsorted(pairs_known, gone), len(pairs_known) - 1)
        same = pairs_known[there] == gone
        counts[there[same]] -= times[same]
        seq[at] = first + len(rules) + rule
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        closes[first + len(rules) : first + len(rules) + len(pairs)] = closes[pairs & np.uint32(0xFFFF)]
        at -= np.arange(len(at))
        fresh, times = counted(inner(places_around(len(seq) - 1, at - 1, at)))
        pairs_known, counts = np.concatenate((pairs_known, fresh)), np.concatenate((counts, times))
        order = np.argsort(pairs_known, kind="stable")
        pairs_known, counts = pairs_known[order], counts[order]
        rules.extend(zip((pairs >> np.uint32(16)).tolist(), (pairs & np.uint32(0xFFFF)).tolist(), strict=True))
    return seq, np.array(rules, np.uint32).reshape(-1, 2)


def expansion_lengths(rules: np.ndarray, first: int = FIRST_NONTERMINAL) -> np.ndarray:
    lengths: list[int] = []
    for pair in rules.tolist():
        lengths.append(sum(lengths[s - first] if s >= first else 1 for s in pair))
    return np.array(lengths, np.uint32)


def shard_row(part: int, shard: int, docs: list[tuple[int | None, bytes]], end_id: int = END_ID) -> tuple:
    ids = np.frombuffer(b"".join(data for _, data in docs), "<u4")
    symbols, rules = compress(ids, end_id)
    lengths = expansion_lengths(rules)
    tokens = np.array([len(data) // 4 for _, data in docs], "<u4")
    # Documents end where the tokens up to a symbol reach their end.
    size = np.ones(FIRST_NONTERMINAL + len(rules), np.int64)
    size[FIRST_NONTERMINAL:] = lengths
    ends = np.searchsorted(np.cumsum(size[symbols]), np.cumsum(tokens.astype(np.int64))) + 1
    width = 2  # MAX_RULES sees to it that all symbols fit
    return (
        part, shard, len(ids), [doc_id for doc_id, _ in docs], tokens.tobytes(),
        np.diff(ends, prepend=0).astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes(), width,
        FIRST_NONTERMINAL, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(),
    )


class Shard:
    """Random access to a written shard."""

    def __init__(self, doc_tokens: bytes, doc_symbols: bytes, symbols: bytes, width: int, first: int, rules: bytes, lengths: bytes):
        self.doc_tokens = np.frombuffer(doc_tokens, "<u4")
        self.from_symbol = np.concatenate(([0], np.cumsum(np.frombuffer(doc_symbols, "<u4").astype(np.int64))))
        self.symbols = np.frombuffer(symbols, f"<u{width}").astype(np.int64)
        self.first = first
        # What each symbol expands to, one after the other: terminals, then nonterminals by their rules.
        sizes = np.concatenate((np.ones(first, np.int64), np.frombuffer(lengths, "<u4").astype(np.int64)))
        self.size, self.at = sizes, np.concatenate(([0], np.cumsum(sizes)))
        self.flat = np.arange(self.at[-1], dtype=np.uint32)
        for i, (a, b) in enumerate(np.frombuffer(rules, "<u4").reshape(-1, 2).tolist()):
            start, middle = self.at[first + i], self.at[first + i] + sizes[a]
            self.flat[start:middle] = self.flat[self.at[a] : self.at[a + 1]]
            self.flat[middle : self.at[first + i + 1]] = self.flat[self.at[b] : self.at[b + 1]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self.size[symbols]
        shift = self.at[symbols] - (np.cumsum(size) - size)
        return self.flat[np.repeat(shift, size) + np.arange(size.sum())]

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Token ids of document i, or tokens [start, stop) of it, from only the symbols they need."""
        symbols = self.symbols[self.from_symbol[i] : self.from_symbol[i + 1]]
        if start or stop is not None:
            ends = np.cumsum(self.size[symbols])
            stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
            a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
            skipped = int(ends[a - 1]) if a else 0
            return self.expand(symbols[a:b])[start - skipped : stop - skipped]
        return self.expand(symbols)


def write_shards(docs: DataFrame, folder: str, path: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all texts and write them to `folder` in the format above."""
    path, end = path or default_path(VOCABULARY), as_bytes([END_ID])

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        part, shard, held, size = TaskContext.get().partitionId(), 0, [], 0
        for doc_id, ids in encoded(rows, word_pieces(path), CHARACTERS):
            data = ids + end
            held.append((doc_id, data))
            size += len(data) // 4
            if size >= shard_tokens:
                yield shard_row(part, shard, held)
                shard, held, size = shard + 1, [], 0
        if held:
            yield shard_row(part, shard, held)

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions(docs.sparkSession), "doc_id")
    # One shard at a time goes back to Spark: a row is some megabytes.
    map_rows(ordered.sortWithinPartitions("doc_id"), rows_of, SHARD, out_rows=1).write.parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, `ids_crc32`, decoded from the files."""
    shards = spark.read.schema(SHARD).parquet(folder)
    by_part = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    # A row per writing task, then a row per shard within its task.
    parts = by_part.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("part_start"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    starts = shards.select("part", "shard", within.alias("shard_start")).join(parts, "part")

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for part, shard, doc_ids, *stored in rows:
            opened, start = Shard(*stored), 0
            for i, doc_id in enumerate(doc_ids):
                ids = opened.document(i).astype("<u4")
                yield part, shard, doc_id, start, len(ids), zlib.crc32(ids.tobytes())
                start += len(ids)

    columns = ("part", "shard", "doc_ids", "doc_tokens", "doc_symbols", "symbols", "symbol_bytes", "first_nonterminal", "rules", "lengths")
    decoded = map_rows(shards, rows_of, "part int, shard int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint", columns)
    return decoded.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("part_start") + F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write_shards(table(spark, sf_dir, "documents"), folder)
    return read_shards(spark, folder)
