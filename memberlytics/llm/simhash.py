"""SimHash near-duplicate detection with BK-trees (operator 8).

1. A document's fingerprint takes, bit by bit, the majority over the XXH64 hashes of its word
   shingles. Only distinct fingerprints go on, so exact copies cost one row however many there are.
2. Two fingerprints within `RADIUS` = 3 bits differ in at most 3 of 5 blocks of bits, so they agree
   in two blocks at least: each fingerprint goes to the 10 shards of its block pairs, and every
   linked pair meets in one of them.
3. A shard's tree is a BK-tree: children are keyed by their integer Hamming distance to the parent,
   and a search follows only the edges within the radius (triangle inequality). A shard larger
   than `CHUNK` is dealt into chunks, and each pair of chunks is a tree of its own, so memory is
   bounded and no pair is lost. The trees stay in the tasks that search them; nothing whose size
   follows the data is broadcast.
4. A tree gives back a spanning forest of its links, not all pairs, and components are found from
   these links by iterated minimum labels.

Results in special cases: null text is an empty text; without words the fingerprint is zero and
links like any other; a document shorter than a shingle is one shingle; repeated rows are each
returned; a null `doc_id` is returned but never names a component unless nothing else could (then
`component_id` is null); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, hex64, map_rows, table

SHINGLE = 3
SEED = 42
RADIUS = 3
# First bit and width of each block; RADIUS + 2 blocks, of which two agree.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
CHUNK = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()  # on bytes both are ASCII only, as wanted
    if not words:
        return 0
    size = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return majority(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, len(words) - size + 1))


def majority(hashes: np.ndarray) -> int:
    """Signed 64-bit SimHash of at least one hash."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id`, `fp` (long) of every row."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            yield doc_id, fingerprint(text, shingle)

    return map_rows(docs, rows_of, "doc_id bigint, fp bigint")


class BKTree:
    """Children keyed by integer Hamming distance to their parent."""

    def __init__(self) -> None:
        self.points: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, point: int) -> None:
        new, at = len(self.points), 0
        self.points.append(point)
        self.children.append({})
        while new:
            distance = (self.points[at] ^ point).bit_count()
            below = self.children[at].setdefault(distance, new)
            if below == new:
                return
            at = below

    def within(self, point: int, radius: int) -> Iterator[int]:
        """Places of all points at most `radius` bits away."""
        waiting = [0] if self.points else []
        while waiting:
            at = waiting.pop()
            distance = (self.points[at] ^ point).bit_count()
            if distance <= radius:
                yield at
            for edge, child in self.children[at].items():
                if distance - radius <= edge <= distance + radius:
                    waiting.append(child)


def forest(points: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links between `points`: (point, root of its tree)."""
    tree, parent = BKTree(), list(range(len(points)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, point in enumerate(points):
        bits = point & (1 << 64) - 1
        for j in tree.within(bits, radius):
            parent[root(j)] = root(i)
        tree.add(bits)
    for i, point in enumerate(points):
        if root(i) != i:
            yield point, points[root(i)]


def shard_keys() -> F.Column:
    """One key per pair of blocks: the pair's number above the bits of both blocks."""
    block = [F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1) for first, width in BLOCKS]
    return F.array(
        *[
            F.shiftleft(F.lit(n).cast("long"), 26).bitwiseOR(F.shiftleft(block[a], 13)).bitwiseOR(block[b])
            for n, (a, b) in enumerate(combinations(range(len(BLOCKS)), 2))
        ]
    )


def links(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (`a`, `b`) that connect all distinct fingerprints `fp` within RADIUS bits."""
    sharded = distinct.select("fp", F.explode(shard_keys()).alias("key"))

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=lambda row: row[:3]):
            yield from forest([row[3] for row in group], RADIUS)

    return map_rows(in_chunks(sharded, chunk), rows_of, "a bigint, b bigint", ("key", "i", "j", "fp")).distinct()


def in_chunks(sharded: DataFrame, chunk: int) -> DataFrame:
    """Rows (`key`, `fp` and others) of keys found twice or more, grouped by `key`, `i`, `j`.

    Rows of a key are dealt into chunks of about `chunk` by their fingerprint, and each pair of chunks (i, j) is a group.
    """
    columns = [c for c in sharded.columns if c != "key"]
    sizes = sharded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = sharded.join(sizes, "key").withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *columns)
    )
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", *columns)


def components(edges: DataFrame) -> DataFrame:
    """`node`, `label`: the smallest node that each node of `edges` (`a`, `b`) reaches.

    Every round takes the smallest label among the neighbours and then the label of that label.
    """
    both = cut(edges.select("a", "b").unionAll(edges.select("b", "a")).toDF("node", "near"), "edges")
    labels = cut(both.groupBy("node").agg(F.least("node", F.min("near")).alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("near", "near_label"), "near").groupBy("node").agg(F.min("near_label").alias("m"))
        lower = cut(
            labels.join(near, "node").select("node", F.least("label", "m").alias("label"), F.col("label").alias("old")), "lower"
        )
        hop = lower.select(F.col("node").alias("label"), F.col("label").alias("hop"))
        after = cut(lower.join(hop, "label").select("node", F.col("hop").alias("label"), "old"), "labels")
        if after.where("label != old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id`, `fingerprint`, `component_id` of every row of `docs`."""
    found = cut(fingerprints(docs, shingle), "fingerprints")
    distinct = cut(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    labelled = (
        distinct.join(components(links(distinct)).withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("label", F.coalesce("label", "fp"))
    )
    smallest = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    component = labelled.join(smallest, "label").select("fp", "component_id")
    return found.join(component, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
