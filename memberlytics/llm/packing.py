"""Best-fit packing planned on a histogram of lengths (operator 1).

1. Each document becomes pieces of at most CAPACITY tokens: all are full but the first.
2. A histogram of piece lengths (at most CAPACITY numbers) is all that planning needs. Best-fit
   decreasing runs over counts: sequences with the same content so far are one class, and a step
   places many pieces of a length at once. The plan says, for each length, which ranks go to which
   sequences at which offset; its size is bounded by CAPACITY, not by the data.
3. Pieces take their slots by a join on length and on the rank within the length. A rank is a
   number within (length, salt) plus what the salts before it hold, so no length meets in one task.

Results in special cases: null text is an empty text, whose only token is the end id; repeated rows
are packed each; a null `doc_id` is packed like any other; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, map_rows, partitions, table
from memberlytics.llm.encoders import as_bytes, byte_pieces, default_path, encoded

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `ids_crc32`."""
    end = as_bytes([end_id])

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, ids in encoded(rows, byte_pieces(path)):
            data = ids + end
            size = len(data) // 4
            first = size - capacity * ((size - 1) // capacity)
            at = [0, *range(first, size + 1, capacity)]
            for piece, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                yield doc_id, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b])

    return map_rows(docs, rows_of, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, ranks, first sequence, ranks per sequence, offset) of best-fit decreasing.

    Rank r of a length, d = r - first rank, lies in sequence `first sequence + d div per` at
    `offset + (d mod per) * length`.
    """
    # By room left: classes [sequences, content], content a linked (length, how many, content before).
    open_by_room: dict[int, list[list]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left, made = histogram[length], []
        for room in sorted(r for r in open_by_room if r >= length):
            per, kept = room // length, []
            for sequences, content in open_by_room[room]:
                full = min(sequences, left // per)
                left -= full * per
                part = left if full < sequences else 0
                left -= part
                for count, pieces in ((full, per), (bool(part), part)):
                    if count:
                        made.append((room - pieces * length, [int(count), (length, pieces, content)]))
                if rest := sequences - full - bool(part):
                    kept.append([rest, content])
            open_by_room[room] = kept
            if not kept:
                del open_by_room[room]
            if not left:
                break
        per = capacity // length
        for count, pieces in ((left // per, per), (bool(left % per), left % per)):
            if count:
                made.append((capacity - pieces * length, [int(count), (length, pieces, None)]))
        for room, group in made:
            open_by_room[room].append(group)

    slots, ranks, sequence = [], defaultdict(int), 0
    for room in sorted(open_by_room):
        for sequences, content in open_by_room[room]:
            chain = []
            while content:
                chain.append(content[:2])
                content = content[2]
            offset = 0
            for length, pieces in reversed(chain):
                slots.append((length, ranks[length], sequences * pieces, sequence, pieces, offset))
                ranks[length] += sequences * pieces
                offset += length * pieces
            sequence += sequences
    return slots


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (with `length` from 1 to `capacity`) plus `sequence_id` and `offset`."""
    spark = pieces.sparkSession
    order = [c for c in pieces.columns if c != "length"]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(partitions(spark))))
    counts = cut(salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    histogram = {row.length: row.n for row in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, capacity),
        "_length bigint, _rank bigint, _ranks bigint, _sequence bigint, _per bigint, _offset bigint",
    )
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")
    bases = counts.select("length", "_salt", before.alias("_base"))
    place = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1
    ranked = salted.withColumn("_place", place).join(bases, ["length", "_salt"])
    ranked = ranked.withColumn("_r", F.col("_base") + F.col("_place"))
    here = F.col("_r") - F.col("_rank")
    # At most a few thousand classes, whatever the data: bounded by the capacity.
    taken = ranked.join(
        F.broadcast(slots),
        (F.col("length") == F.col("_length")) & (here >= 0) & (here < F.col("_ranks")),
    )
    return taken.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(here / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + here % F.col("_per") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All documents in sequences of at most `capacity` tokens; a row per piece."""
    pieces = cut(token_pieces(docs, path or default_path(VOCABULARY), capacity), "pieces")
    return pack(pieces, capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
