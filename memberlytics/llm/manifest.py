"""Merkle manifest of a dataset as append logs in postorder (operator 13).

Every document is a leaf: the hash of its columns. The leaves of a source, in ascending order of ids, make a tree
in which RUN neighbours share a parent (the last run may be shorter); its top is the subroot of the source. The
subroots, in order of sources, make the tree of the root in the same way.

1. Leaves are ranked by range partitions and their counts, so no task sees a whole source.
2. Aligned builders: SPAN = RUN ** LEVELS neighbouring leaves are the work of one builder, however large the
   source. It appends each node to its log when the node is complete: a leaf when it arrives, a parent right
   after its last child. The tops of these segments are the leaves of the next tier, until one is left.
3. Places in a log follow from subtree sizes alone (`places`): a proof reads its siblings from the segment at
   computed places, then goes on with the proof of the segment's top, which its leaves share.

A manifest is a folder of Parquet tables:

    kind=sources/tier=0..   segments of the sources' trees; tier 0 holds the documents' leaves
    subroots                tree, at, n, digest: the subroot of each source and its place among them
    kind=root/tier=0..      segments of the tree over the subroots

    tree string      "0" for the null source, else "1" and its name; "" in the tree of the root
    block, n bigint  number of the segment in its tier; leaves of the tier in the whole tree
    ids              ids of the documents in order, in tier 0 of sources
    claims           32 bytes for each: the leaf that a later check supposes (by default the leaf itself)
    log              32 bytes for each node in completion order
    top              the last node of the log

Results in special cases: null columns are written `-`, so they differ from empty texts; rows without a `doc_id`
come first in their source; rows that share an id are ordered by their leaf, and equal rows are leaves each; a
source with one row has its leaf as subroot, a table with one source its subroot as root; an empty table gives an
empty manifest; texts of any length are hashed whole and never shuffled; other columns than those hashed are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from memberlytics.llm.common import crc32_sql, cut, map_rows, partitions, table
from memberlytics.sources.versions import shared_folder

RUN = 3
LEVELS = 8
SPAN = RUN**LEVELS
WIDTH = 32
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SEGMENT = "tree string, block bigint, n bigint, ids array<bigint>, claims binary, log binary, top binary"
SUBROOT = "tree string, at bigint, n bigint, digest binary"
PATHS = "tree string, at bigint, id bigint, digest binary, claim binary, path binary, subroot binary"
# Rows with a path that a task hands back at a time.
OUT_ROWS = 10_000


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hash (binary) of `-` for a null, else of the byte count, `:` and the value, of all columns."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(value) for value in columns.values()]), 256))


def parent(children: bytes) -> bytes:
    return hashlib.sha256(children.hex().encode()).digest()


def height_of(leaves: int) -> int:
    height = 0
    while RUN**height < leaves:
        height += 1
    return height


def append_log(leaves: list[bytes], height: int) -> bytes:
    """All nodes of `height` levels above `leaves`, each written when it is complete."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(height)]

    def complete(level: int, node: bytes) -> None:
        log.append(node)
        if level < height:
            open_runs[level].append(node)
            if len(open_runs[level]) == RUN:
                close(level)

    def close(level: int) -> None:
        children = b"".join(open_runs[level])
        open_runs[level] = []
        complete(level + 1, parent(children))

    for leaf in leaves:
        complete(0, leaf)
    for level in range(height):
        if open_runs[level]:
            close(level)
    return b"".join(log)


def places(level: int, leaves: int, height: int) -> np.ndarray:
    """Where the nodes of `level`, from left to right, stand in the log of a tree with so many leaves.

    A full node ends with leaf e: before it stand all nodes that are full by then, e // RUN ** t of level t,
    but for itself and what leaf e completes above it. Nodes that stay short come last, one for each level
    from the lowest level on that the leaves do not fill.
    """
    n = -(-leaves // RUN**level)
    ends = np.arange(1, n + 1, dtype=np.int64) * RUN**level
    at = sum(ends // RUN**t for t in range(height + 1)) - 1
    at -= sum((ends % RUN**t == 0).astype(np.int64) for t in range(level + 1, height + 1))
    if leaves % RUN**level:
        lowest = next(t for t in range(height + 1) if leaves % RUN**t)
        at[-1] = sum(leaves // RUN**t for t in range(height + 1)) + level - lowest
    return at


def nodes(log: bytes, level: int, leaves: int, height: int) -> list[bytes]:
    return [log[WIDTH * at : WIDTH * (at + 1)] for at in places(level, leaves, height).tolist()]


def local_paths(log: bytes, leaves: int, height: int, above: bytes) -> list[bytes]:
    """Path of every leaf of a segment: for each level up a byte (place in the run, times 4, plus the run's
    size) and the run's other digests; then `above`, the path of the segment's top."""
    paths = [above]
    for level in reversed(range(height)):
        held = nodes(log, level, leaves, height)
        below = []
        for first in range(0, len(held), RUN):
            run, up = held[first : first + RUN], paths[first // RUN]
            for place in range(len(run)):
                below.append(bytes([4 * place + len(run)]) + b"".join(run[:place] + run[place + 1 :]) + up)
        paths = below
    return paths


def steps(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(siblings to the left, siblings to the right) for each level of a path."""
    at = 0
    while at < len(path):
        place, size = divmod(path[at], 4)
        others = path[at + 1 : at + 1 + WIDTH * (size - 1)]
        yield others[: WIDTH * place], others[WIDTH * place :]
        at += 1 + WIDTH * (size - 1)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its path."""
    for left, right in steps(path):
        leaf = parent(left + leaf + right)
    return leaf


def numbered(items: DataFrame, order: list[str]) -> DataFrame:
    """`items` with `at`, the rank (from 0) in their `tree` by `order`, and `n`, the rows of the tree.

    Equal rows are told apart by their place in the input, so a group of any size is spread.
    """
    stored = cut(items, "items").withColumn("_row", F.monotonically_increasing_id())
    by = ["tree", *order, "_row"]
    parts = stored.repartitionByRange(partitions(items.sparkSession), *by).withColumn("_part", F.spark_partition_id())
    parts = cut(parts, "ranges")
    sizes = parts.groupBy("_part", "tree").agg(F.count(F.lit(1)).alias("_size"))
    # A row for each range of a tree.
    of_tree = Window.partitionBy("tree")
    before = F.sum("_size").over(of_tree.orderBy("_part")) - F.col("_size")
    offsets = sizes.select("_part", "tree", before.alias("_before"), F.sum("_size").over(of_tree).alias("n"))
    within = F.row_number().over(Window.partitionBy("_part", "tree").orderBy(*by[1:])) - 1
    ranked = parts.withColumn("_within", within).join(offsets, ["_part", "tree"])
    return ranked.withColumn("at", F.col("_before") + F.col("_within")).drop("_part", "_row", "_before", "_within")


def segments(items: DataFrame) -> DataFrame:
    """A row per builder (SEGMENT) of items `tree`, `at`, `n`, `id`, `digest`, `claim`."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (tree, block), group in groupby(rows, itemgetter(0, 1)):
            _, _, sizes, ids, digests, claims = zip(*group, strict=True)
            log = append_log(digests, min(LEVELS, height_of(sizes[0])))
            yield tree, block, sizes[0], ids, b"".join(claim or b"" for claim in claims), log, log[-WIDTH:]

    blocks = items.withColumn("block", F.floor(F.col("at") / SPAN)).repartition(partitions(items.sparkSession), "tree", "block")
    return map_rows(blocks.sortWithinPartitions("tree", "block", "at"), rows_of, SEGMENT, ("tree", "block", "n", "id", "digest", "claim"), out_rows=16)


def write_tree(items: DataFrame, folder: str) -> None:
    """Tiers of segments until every tree has one top."""
    spark, tier = items.sparkSession, 0
    while True:
        segments(items).write.parquet(f"{folder}/tier={tier}")
        tops = read_tier(spark, folder, tier).where(F.col("n") > SPAN)
        if tops.isEmpty():
            return
        nothing = [F.lit(None).cast("bigint").alias("id"), F.col("top").alias("digest"), F.lit(None).cast("binary").alias("claim")]
        items = tops.select("tree", F.col("block").alias("at"), F.ceil(F.col("n") / SPAN).alias("n"), *nothing)
        tier += 1


def read_tier(spark: SparkSession, folder: str, tier: int) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(f"{folder}/tier={tier}")


def tiers_of(spark: SparkSession, folder: str) -> int:
    return 1 + spark.read.schema(f"{SEGMENT}, tier int").parquet(folder).agg(F.coalesce(F.max("tier"), F.lit(0))).first()[0]


def write_manifest(docs: DataFrame, folder: str, claim: Column | None = None) -> None:
    """Hash all documents and write the manifest; `claim` is a leaf digest to be checked later instead of the leaf."""
    spark, leaf = docs.sparkSession, leaf_digest({name: F.col(name) for name in COLUMNS})
    tree = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("0"))
    claimed = leaf if claim is None else claim
    leaves = docs.select(tree.alias("tree"), F.col("doc_id").alias("id"), leaf.alias("digest"), claimed.alias("claim"))
    write_tree(numbered(leaves, ["id", "digest"]), f"{folder}/kind=sources")

    found = spark.read.schema(f"{SEGMENT}, tier int").parquet(f"{folder}/kind=sources").where(F.col("n") <= SPAN)
    ranked = numbered(found.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest")), ["name"])
    ranked.select(F.col("name").alias("tree"), "at", "n", "digest").write.parquet(f"{folder}/subroots")
    subroots = spark.read.schema(SUBROOT).parquet(f"{folder}/subroots")
    write_tree(subroots.select(F.lit("").alias("tree"), "at", "n", F.col("at").alias("id"), "digest", F.col("digest").alias("claim")), f"{folder}/kind=root")


def tree_paths(spark: SparkSession, folder: str, above: DataFrame) -> DataFrame:
    """PATHS of all leaves of the trees in `folder`; `above` holds `tree`, `path`, `subroot` of their tops."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for tree, block, n, ids, claims, log, path, subroot in rows:
            height = min(LEVELS, height_of(n))
            held = min(SPAN, n - block * SPAN)
            digests, paths = nodes(log, 0, held, height), local_paths(log, held, height, path)
            for k in range(held):
                claim = claims[WIDTH * k : WIDTH * (k + 1)] or None
                yield tree, block * SPAN + k, ids[k], digests[k], claim, paths[k], subroot

    paths = None
    for tier in reversed(range(tiers_of(spark, folder))):
        stored = read_tier(spark, folder, tier).drop("top")
        joined = stored.where(F.col("n") <= SPAN).join(above, "tree")
        if paths is not None:
            upper = paths.select("tree", F.col("at").alias("block"), "path", "subroot")
            joined = joined.unionByName(stored.where(F.col("n") > SPAN).join(upper, ["tree", "block"]))
        paths = map_rows(joined, rows_of, PATHS, ("tree", "block", "n", "ids", "claims", "log", "path", "subroot"), out_rows=OUT_ROWS)
    return paths


def proofs(spark: SparkSession, folder: str) -> DataFrame:
    """`doc_id`, `leaf`, `claim`, `subroot`, `root`, `path` (all binary) of every document of a manifest."""
    nowhere = F.lit(b"").alias("path"), F.lit(b"").alias("subroot")
    of_sources = tree_paths(spark, f"{folder}/kind=root", spark.range(1).select(F.lit("").alias("tree"), *nowhere))
    subroots = spark.read.schema(SUBROOT).parquet(f"{folder}/subroots")
    above = subroots.join(of_sources.select("at", "path"), "at").select("tree", "path", F.col("digest").alias("subroot"))
    root = spark.read.schema(f"{SEGMENT}, tier int").parquet(f"{folder}/kind=root").where(F.col("n") <= SPAN).select("top").scalar()
    paths = tree_paths(spark, f"{folder}/kind=sources", cut(above, "subroot-paths"))
    return paths.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "claim", "subroot", root.alias("root"), "path")


def verify(proved: DataFrame) -> DataFrame:
    """`proofs` in hexadecimal, with the hash of all siblings and the root that each claim leads to."""

    def rows_of(rows: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, leaf, claim, subroot, root, path in rows:
            siblings = b"".join(left + right for left, right in steps(path))
            folded = fold(claim, path)
            yield doc_id, leaf.hex(), subroot.hex(), root.hex(), parent(siblings).hex(), folded.hex(), folded == root

    columns = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return map_rows(proved, rows_of, columns, ("doc_id", "leaf", "claim", "subroot", "root", "path"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {name: F.col(name) for name in COLUMNS}
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    columns["text"] = F.when(picked, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    folder = f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    write_manifest(table(spark, sf_dir, "documents"), folder, leaf_digest(columns))
    return verify(proofs(spark, folder))


def tree_sql(name: str, leaves: str, levels: int) -> str:
    """CTEs of the levels of all trees of `leaves` (tree, pos, digest): `name`_k with the number of nodes in the tree, and
    `name`_top. A tree with one node stays as it is."""
    ctes = [f"{name}_0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM {leaves})"]
    for k in range(levels):
        ctes.append(
            f"""{name}_{k + 1} AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS nodes FROM (
    SELECT tree, pos // {RUN} AS pos, CASE WHEN any_value(nodes) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
    FROM {name}_{k} GROUP BY tree, pos // {RUN}))"""
        )
    return ",\n".join([*ctes, f"{name}_top AS (SELECT tree, digest FROM {name}_{levels} WHERE nodes = 1)"])


def climb_sql(name: str, source: str, tree: str, levels: int) -> str:
    """CTEs that take rows (r, tree, pos, folded, siblings) of `source` up the levels: `name`_k."""
    ctes, below = [], source
    for k in range(levels):
        others = f"FILTER (WHERE n.pos <> b.pos // {RUN**k})"
        ctes.append(
            f"""{name}_{k + 1} AS (
  SELECT b.r, b.tree, b.pos,
    CASE WHEN any_value(n.nodes) = 1 THEN b.folded
      ELSE sha256(string_agg(CASE WHEN n.pos = b.pos // {RUN**k} THEN b.folded ELSE n.digest END, '' ORDER BY n.pos)) END AS folded,
    b.siblings || coalesce(string_agg(n.digest, '' ORDER BY n.pos) {others}, '') AS siblings
  FROM {below} b JOIN {tree}_{k} n ON n.tree = b.tree AND n.pos // {RUN} = b.pos // {RUN ** (k + 1)}
  GROUP BY b.r, b.tree, b.pos, b.folded, b.siblings)"""
        )
        below = f"{name}_{k + 1}"
    return ",\n".join(ctes)


def oracle(levels: int = 10) -> str:
    """The query in SQL, for sources (and as many sources) of up to RUN ** `levels` documents."""

    def leaf(text: str) -> str:
        values = {**{name: name for name in COLUMNS}, "text": text}
        fields = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values.values()]
        return f"sha256({' || '.join(fields)})"

    picked = f"coalesce({crc32_sql('CAST(doc_id AS VARCHAR)')} % 2 = 0, false)"
    return f"""
WITH hashed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, {leaf('text')} AS digest,
    {leaf(f"(CASE WHEN {picked} THEN replace(text, chr(10), '') ELSE text END)")} AS claim
  FROM documents),
docs AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM hashed),
leaves AS (SELECT tree, pos, digest FROM docs),
{tree_sql("t", "leaves", levels)},
tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest, tree AS name FROM t_top),
top_leaves AS (SELECT tree, pos, digest FROM tops),
{tree_sql("u", "top_leaves", levels)},
claims AS (SELECT r, tree, pos, claim AS folded, '' AS siblings FROM docs),
{climb_sql("c", "claims", "t", levels)},
up AS (SELECT r, '' AS tree, tops.pos, folded, siblings FROM c_{levels} JOIN tops ON tops.name = c_{levels}.tree),
{climb_sql("v", "up", "u", levels)}
SELECT doc_id, docs.digest AS leaf, t_top.digest AS subroot, u_top.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root,
  folded = u_top.digest AS verified
FROM docs JOIN v_{levels} USING (r) JOIN t_top ON t_top.tree = docs.tree JOIN u_top ON true
"""


ORACLE = oracle()
