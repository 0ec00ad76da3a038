"""Replaceable Parquet tables.

Plain Parquet has no transactions, and a plan must not overwrite a folder it reads. So every
replacement is written to a folder of its own and becomes current when a one-row pointer is
appended afterwards. A run that dies half-way leaves the former version in place; repeating it is
safe. One writer per table is assumed.

    root/versions/version=<n>-<id>/snapshot_date=<part>/*.parquet
    root/pointers/*.json            {"seq": n, "part": "2024-01-30", "version": "<n>-<id>", "note": ".."}

Several dates of a table, or several tables of a folder, are replaced together: one file holds all
their pointers, so either all of them change or none does. Tables that change together have that
file in `pointers` beside them, with their `name`. A part without a version has no rows. A note is
what a writer wants to find again with the current version.

A table with a row per key can be stored in buckets of that key. The note of such a version names its
layout, and reading it goes through a catalog entry that any session can make again from the note, so
joins and aggregates on the key find the rows of a bucket together and shuffle the other side only.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
from datetime import date
from functools import cache
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "seq bigint, part string, version string, note string, name string"
WHOLE_TABLE = ""
NO_ROWS = ""


class Pointer(NamedTuple):
    seq: int
    version: str
    note: str | None


class Buckets(NamedTuple):
    """Rows dealt into `count` files by a hash of `key`: for tables in which no key has many rows."""

    key: str
    count: int


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables, as named by `spark.checkpoint.dir`.

    Only a local session, where driver and executors are one process, may go without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # `local-cluster[..]` has executors of its own.
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="memberlytics-")


def counted(df: DataFrame, counts: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """`df`, whose next write also works out `counts` (aggregates) of the rows written; read them by `.get` afterwards."""
    observation = Observation()
    return df.observe(observation, *[count.alias(name) for name, count in counts.items()]), observation


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the plan: write `df` to the shared folder once and go on from the columnar copy."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _pointers(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(POINTER).json(f"{folder}/pointers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _current(spark: SparkSession, root: str) -> dict[str, Pointer]:
    """Newest pointer of every part; a row per part reaches the driver, however often it was published."""
    parent, name = root.rstrip("/").rsplit("/", 1)
    own, shared = _pointers(spark, root), _pointers(spark, parent)
    found = [p for p in (own, shared.where(F.col("name") == name) if shared is not None else None) if p is not None]
    if not found:
        return {}
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    newest = rows.groupBy("part").agg(F.max(F.struct("seq", "version", "note")).alias("newest"))
    return {row["part"]: Pointer(*row["newest"]) for row in newest.collect()}


def _new_version(currents: list[dict[str, Pointer]]) -> tuple[int, str]:
    seq = 1 + max((pointer.seq for current in currents for pointer in current.values()), default=0)
    return seq, f"{seq:09d}-{uuid.uuid4().hex[:8]}"


def _point(spark: SparkSession, folder: str, seq: int, rows: list[tuple[str, str, str | None, str | None]]) -> None:
    """Append one file of pointers (part, version, note, name): the commit."""
    each = [F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(row, ("part", "version", "note", "name"), strict=True)]) for row in rows]
    pointers = spark.range(1).select(F.lit(seq).alias("seq"), F.inline(F.array(*each)))
    pointers.coalesce(1).write.mode("append").json(f"{folder}/pointers")


def _publish(df: DataFrame, root: str, part: str) -> str:
    """Write `df` as a new version, make it current, and return its folder."""
    spark = df.sparkSession
    seq, version = _new_version([_current(spark, root)])
    path = f"{root}/versions/version={version}" + (f"/snapshot_date={part}" if part else "")
    df.write.parquet(path)
    _point(spark, root, seq, [(part, version, None, None)])
    return path


def _read_parts(spark: SparkSession, root: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", f"{root}/versions")
    return reader.parquet(*paths).select(schema.names)


def _catalog_name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: Buckets) -> DataFrame:
    """The files at `path` under a catalog entry that knows their layout."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f"CLUSTERED BY (`{buckets.key}`) SORTED BY (`{buckets.key}`) INTO {buckets.count} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_catalog_name(path)} ({columns}) USING parquet {layout} LOCATION '{path}'")
    return spark.table(_catalog_name(path)).select(schema.names)


def replace_table(df: DataFrame, root: str, buckets: Buckets | None = None) -> DataFrame:
    """Make `df` the content of the table, and return it as stored.

    `df` may read the table's current version.
    """
    spark = df.sparkSession
    if buckets is None:
        return spark.read.schema(df.schema).parquet(_publish(df, root, WHOLE_TABLE))
    seq, version = _new_version([_current(spark, root)])
    path = f"{root}/versions/version={version}"
    dealt = df.write.format("parquet").option("path", path).bucketBy(buckets.count, buckets.key).sortBy(buckets.key)
    dealt.saveAsTable(_catalog_name(path))
    _point(spark, root, seq, [(WHOLE_TABLE, version, json.dumps(buckets._asdict()), None)])
    return _bucketed(spark, path, df.schema, buckets)


def read_replaced(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    current = _current(spark, root).get(WHOLE_TABLE)
    if current is None:
        return empty_table(spark, schema)
    path = f"{root}/versions/version={current.version}"
    if current.note and current.note.startswith("{"):
        return _bucketed(spark, path, schema, Buckets(**json.loads(current.note)))
    return spark.read.schema(schema).parquet(path)


def replace_tables(tables: dict[str, DataFrame], store: str, note: str | None = None) -> dict[str, DataFrame]:
    """Make each of `tables` the content of the table of its name below `store`, all in one commit; returns them as
    stored. They may read the current versions."""
    spark = next(iter(tables.values())).sparkSession
    seq, version = _new_version([_current(spark, f"{store}/{name}") for name in tables])
    paths = {name: f"{store}/{name}/versions/version={version}" for name in tables}
    for name, df in tables.items():
        df.write.parquet(paths[name])
    _point(spark, store, seq, [(WHOLE_TABLE, version, note, name) for name in tables])
    return {name: spark.read.schema(df.schema).parquet(paths[name]) for name, df in tables.items()}


def note_of(spark: SparkSession, root: str) -> str | None:
    """The note of the current version of a replaceable table."""
    current = _current(spark, root).get(WHOLE_TABLE)
    return current.note if current else None


def _dated(df: DataFrame, days: list[date]) -> DataFrame:
    """`df`, failing while it runs at a row of another date than `days`, or of none."""
    known = F.coalesce(F.col("snapshot_date").isin(days), F.lit(False))
    named = ", ".join(map(str, days))
    wrong = F.raise_error(F.concat(F.lit(f"a row of a snapshot of {named} is dated "), F.coalesce(F.col("snapshot_date").cast("string"), F.lit("nothing"))))
    return df.where(F.when(known, F.lit(True)).otherwise(wrong.cast("boolean")))


def replace_snapshot(df: DataFrame, root: str, as_of: date) -> DataFrame:
    """Replace the rows of one snapshot date, and return them as stored.

    Other dates stay. No rows leaves the date empty. A row of another date, or of none, is an error.
    """
    rows = _dated(df, [as_of]).drop("snapshot_date")
    return _read_parts(df.sparkSession, root, df.schema, [_publish(rows, root, as_of.isoformat())])


def replace_snapshot_counted(df: DataFrame, root: str, as_of: date, counts: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """`replace_snapshot`, and `counts` of the rows it has written, without reading them again."""
    rows, observation = counted(df, counts)
    return replace_snapshot(rows, root, as_of), observation.get


def replace_table_counted(
    df: DataFrame, root: str, counts: dict[str, Column], buckets: Buckets | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """`replace_table`, and `counts` of the rows it has written."""
    rows, observation = counted(df, counts)
    return replace_table(rows, root, buckets), observation.get


def replace_snapshots(df: DataFrame, root: str, notes: dict[date, str]) -> None:
    """Replace the rows of all dates in `notes` in one commit; a date without rows becomes empty."""
    spark = df.sparkSession
    seq, version = _new_version([_current(spark, root)])
    path = f"{root}/versions/version={version}"
    _dated(df, list(notes)).write.partitionBy("snapshot_date").parquet(path)
    filled = {row[0] for row in spark.read.schema(df.schema).parquet(path).select("snapshot_date").distinct().collect()}
    _point(spark, root, seq, [(day.isoformat(), version if day in filled else NO_ROWS, note, None) for day, note in notes.items()])


def snapshot_notes(spark: SparkSession, root: str) -> dict[date, str | None]:
    """The note of every date's current version."""
    return {date.fromisoformat(part): pointer.note for part, pointer in _current(spark, root).items()}


def has_snapshots(spark: SparkSession, root: str) -> bool:
    return bool(_current(spark, root))


def read_snapshots(
    spark: SparkSession, root: str, schema: T.StructType, as_of: date | None = None, since: date | None = None
) -> DataFrame:
    """All current snapshots, the one of `as_of`, or those from `since` to `as_of`, opening only their own folders."""
    first, last = since or as_of or date.min, as_of or date.max
    current = {part: p for part, p in _current(spark, root).items() if p.version != NO_ROWS}
    parts = sorted(part for part in current if first <= date.fromisoformat(part) <= last)
    if not parts:
        return empty_table(spark, schema)
    return _read_parts(spark, root, schema, [f"{root}/versions/version={current[p].version}/snapshot_date={p}" for p in parts])
