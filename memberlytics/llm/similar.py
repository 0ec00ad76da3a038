"""Near duplicates of a similarity of 0.8 or more by SimHash (the stage form of operator 8).

Two documents are near duplicates if the Jaccard similarity of their sets of five-word shingles is
SIMILARITY or more. Their SimHash fingerprints meet in two ways:

1. Documents with equal shingle sets are one node. Fingerprints within the three bits of operator 8 are found
   as there, by BK-trees in the shards of agreeing blocks, whose links are candidates.
2. SimHash fingerprints of such pairs differ in up to about 15 of 64 bits, where neither blocks of bits nor a
   BK-tree (which at that radius visits every point) leave anything out. For these a node also goes to BANDS
   shards, each named by ROWS minima of its permuted shingle hashes. A pair of similarity 0.8 shares a shard
   with a probability of 0.996, one of 0.85 with 0.9997.
3. In a shard FORESTS minimum spanning forests of Hamming distances up to RADIUS, without common edges,
   give more candidates: for each member its nearest ones, and at most FORESTS pairs per member instead
   of all. Large shards are searched in pairs of chunks.
4. Candidates are confirmed on the whole texts by exact Jaccard similarity; components follow.
5. Shards whose members are not all connected by then are searched on the whole texts: each member meets
   all others of its shard that no confirmed link connects it to. So what is removed is a near duplicate
   for certain, and a link is lost only if its pair shares no shard.

Results in special cases: words are taken as in operator 8; a text of fewer than five words is one
shingle; null and empty texts have none and are copies of each other; rows without a `doc_id` neither go
nor make others go; repeated rows of a kept document stay (they are one document, listed twice);
rows of one `doc_id` with different texts stand and fall together; an empty table has an empty result;
extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memberlytics.llm.common import cut, map_rows
from memberlytics.llm.simhash import CHUNK, SEED, BKTree, components, in_chunks, majority, shard_keys
from memberlytics.llm.simhash import RADIUS as TREE_RADIUS

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 5
RADIUS = 20
FORESTS = 3
# Shingles of a chunk of a shard that is searched on whole texts.
CHUNK_SHINGLES = 1 << 20
# Shingles whose permuted hashes are held at a time.
BLOCK = 4096
_permutations = np.random.default_rng(8).integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, len(words) - size + 1))


def band_keys(hashes: np.ndarray) -> list[int]:
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), BLOCK):
        permuted = hashes[at : at + BLOCK, None] * _permutations[0] + _permutations[1]
        least = np.minimum(least, permuted.min(axis=0))
    keys = [xxhash.xxh64_intdigest(row.tobytes(), seed=band) for band, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets, each sorted and without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def spanning_forests(points: np.ndarray, sizes: np.ndarray, radius: int = RADIUS, forests: int = FORESTS) -> Iterator[tuple[int, int]]:
    """Places of the ends of the edges of `forests` minimum spanning forests, one after the other without common edges.

    Edges are distances up to `radius` between sets whose sizes allow SIMILARITY.
    """
    n, far = len(points), 65
    taken: list[list[int]] = [[] for _ in range(n)]
    for _ in range(min(forests, n - 1)):
        near, via, done = np.full(n, far, np.uint8), np.zeros(n, np.int64), np.zeros(n, bool)
        last = 0
        for _ in range(n - 1):
            done[last] = True
            distance = np.bitwise_count(points ^ points[last])
            distance[(sizes < SIMILARITY * sizes[last]) | (sizes * SIMILARITY > sizes[last])] = far
            distance[taken[last]] = far
            closer = distance < near
            near[closer], via[closer] = distance[closer], last
            last = int(np.where(done, far + 1, near).argmin())
            if near[last] <= radius:
                other = int(via[last])
                taken[last].append(other)
                taken[other].append(last)
                yield other, last


def nodes(docs: DataFrame) -> DataFrame:
    """`doc_id`, `sign` (of the text), `node` (of its shingle set), `fp`, `size`, `bands` of every row with an id."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, sign in rows:
            hashes = shingle_set(text)
            some = len(hashes) > 0
            yield doc_id, sign, xxhash.xxh128_hexdigest(hashes.tobytes()), majority(hashes) if some else 0, len(hashes), band_keys(hashes) if some else []

    signed = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("sign"))
    return map_rows(signed, rows_of, "doc_id bigint, sign bigint, node string, fp bigint, size int, bands array<bigint>", ("doc_id", "text", "sign"))


def tree_edges(points: list[int]) -> Iterator[tuple[int, int]]:
    """Links within TREE_RADIUS bits that connect all linked `points` (signed, distinct), near ones first."""
    tree, parent = BKTree(), list(range(len(points)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for at, point in enumerate(points):
        bits = point & (1 << 64) - 1
        for _, other in sorted(((tree.points[j] ^ bits).bit_count(), j) for j in tree.within(bits, TREE_RADIUS)):
            if root(other) != root(at):
                parent[root(other)] = root(at)
                yield points[other], point
        tree.add(bits)


def tree_pairs(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Pairs (`a`, `b`) of nodes whose fingerprints are equal or linked by the BK-trees of operator 8."""
    heads = distinct.groupBy("fp").agg(F.min("node").alias("head"))
    sharded = heads.select("fp", F.explode(shard_keys()).alias("key"))

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=lambda row: row[:3]):
            yield from tree_edges([row[3] for row in group])

    linked = map_rows(in_chunks(sharded, chunk), rows_of, "x bigint, y bigint", ("key", "i", "j", "fp")).distinct()
    ends = linked.join(heads.toDF("x", "a"), "x").join(heads.toDF("y", "b"), "y").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    equal = distinct.join(heads, "fp").where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    return ends.unionAll(equal)


def candidates(distinct: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Pairs (`a`, `b`) of nodes worth comparing, from `node`, `fp`, `size`, `bands`: those of the BK-trees, and
    those of the shards of minima for what is further apart."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=lambda row: row[:3]):
            members = list(group)
            points = np.array([row[3] for row in members], np.int64).view(np.uint64)
            for i, j in spanning_forests(points, np.array([row[4] for row in members])):
                yield tuple(sorted((members[i][5], members[j][5])))

    sharded = distinct.select("fp", "size", "node", F.explode("bands").alias("key"))
    further = map_rows(in_chunks(sharded, chunk), rows_of, "a string, b string", ("key", "i", "j", "fp", "size", "node"))
    return tree_pairs(distinct, chunk).unionAll(further).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose whole texts (`node`, `text`) are similar enough."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for a, b, text_a, text_b in rows:
            if jaccard(shingle_set(text_a), shingle_set(text_b)) >= similarity:
                yield a, b

    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return map_rows(both, rows_of, "a string, b string", ("a", "b", "text_a", "text_b"))


def unlinked(distinct: DataFrame, linked: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Members (`node`, `label`) of the shards that confirmed links leave in parts, grouped by `key`, `i`, `j`.

    Shards with the same members are one; large ones are dealt into chunks, and each pair of chunks is a group.
    """
    labelled = distinct.join(linked, "node", "left").select("node", "size", F.coalesce("label", "node").alias("label"), "bands")
    sharded = cut(labelled.select("node", "size", "label", F.explode("bands").alias("key")), "shards")
    shards = sharded.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
    )
    parts = shards.where("low != high").groupBy("n", "shingles", "x", "y").agg(F.min("key").alias("key"))
    chunks = F.ceil(F.greatest(F.col("n") / chunk, F.col("shingles") / CHUNK_SHINGLES)).cast("int")
    members = sharded.join(parts.select("key", chunks.alias("chunks")), "key")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    return (
        members.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label")
    )


def exact_links(sets: list[np.ndarray], labels: list[str], similarity: float = SIMILARITY) -> Iterator[tuple[int, int]]:
    """Places of pairs of similar sets that connect all labels which some pair of similar sets connects.

    The members that a walk has not reached yet are compared with each that it reaches, through the
    lists of the holders of its shingles.
    """
    sizes = np.array([len(x) for x in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(ids, kind="stable")]
    ends = np.cumsum(np.bincount(ids))
    starts = ends - np.bincount(ids)
    own = np.split(ids, np.cumsum(sizes)[:-1])
    mates: dict[str, list[int]] = {}
    for at, label in enumerate(labels):
        mates.setdefault(label, []).append(at)
    unreached = np.ones(len(sets), bool)
    for first in mates.values():
        if not unreached[first[0]]:
            continue
        waiting = list(first)
        unreached[first] = False
        while waiting and unreached.any():
            at = waiting.pop()
            begin, many = starts[own[at]], ends[own[at]] - starts[own[at]]
            places = np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)
            both = np.bincount(holders[places], minlength=len(sets))
            for other in np.flatnonzero(unreached & (both / (sizes[at] + sizes - both) >= similarity)):
                if unreached[other]:
                    yield at, int(other)
                    waiting += mates[labels[other]]
                    unreached[mates[labels[other]]] = False


def rest(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (`a`, `b`) between similar `members` (see `unlinked`) that were not connected, from `texts` (`node`, `text`)."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, group in groupby(rows, key=lambda row: row[:3]):
            found = [(node, label, shingle_set(text)) for _, _, _, node, label, text in group]
            for a, b in exact_links([x for _, _, x in found], [label for _, label, _ in found]):
                yield found[a][0], found[b][0]

    both = members.join(texts, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    return map_rows(both, rows_of, "a string, b string", ("key", "i", "j", "node", "label", "text")).distinct()


def similar_groups(docs: DataFrame) -> DataFrame:
    """`doc_id`, `group_id` (smallest `doc_id` of its group of near duplicates) of every row with an id."""
    found = cut(nodes(docs), "nodes")
    distinct = found.groupBy("node").agg(
        F.min(F.struct("doc_id", "sign")).alias("first"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    distinct = cut(distinct, "distinct_nodes")
    pairs = cut(candidates(distinct), "candidates")

    signed = docs.select("doc_id", "text", F.xxhash64("text").alias("sign"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        places = distinct.join(wanted.distinct(), "node").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.sign").alias("sign"))
        return cut(signed.join(places, ["doc_id", "sign"]).dropDuplicates(["node"]).select("node", "text"), "texts")

    links = cut(confirmed(pairs, texts_of(pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")))), "similar")
    members = cut(unlinked(distinct, components(links)), "unlinked")
    more = cut(rest(members, texts_of(members.select("node"))), "similar")
    linked = components(links.unionAll(more))
    labelled = distinct.join(linked, "node", "left").select("node", "first.doc_id", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("group_id"))
    of_node = labelled.join(smallest, "label").select("node", "group_id")
    return found.join(of_node, "node").select("doc_id", "group_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest `doc_id`."""
    later = similar_groups(docs).where("doc_id != group_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)
