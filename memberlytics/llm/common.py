"""Helpers that several operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from memberlytics.sources.versions import materialize

# Rows that a task hands back to Spark at a time.
OUT_ROWS = 50_000
# Rows that a Python process gets at a time: the default suits narrow rows, not whole texts.
ARROW_ROWS, DEFAULT_ROWS, IN_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"
ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the copy: later steps neither repeat the
    work nor lose it with an executor."""
    return materialize(df, label)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@cache
def _ship(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    SparkSession.active().sparkContext.addPyFile(archive)


def ship(spark: SparkSession) -> None:
    """Give the Python processes this package, once per application, as `--py-files` would, and batches of a size
    that suits texts, unless the session has a size of its own."""
    _ship(spark.sparkContext.applicationId)
    if spark.conf.get(ARROW_ROWS, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(ARROW_ROWS, IN_ROWS)


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def batch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def map_rows(
    df: DataFrame,
    rows_of: Callable[[Iterator[tuple]], Iterable[tuple]],
    ddl: str,
    columns: tuple[str, ...] = ("doc_id", "text"),
    out_rows: int = OUT_ROWS,
) -> DataFrame:
    """Run `rows_of` over the rows (tuples of `columns`) of each partition; it yields result rows.

    Both ways the rows travel in Arrow batches of bounded size.
    """
    ship(df.sparkSession)
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(values, type=field.type) for values, field in zip(zip(*rows, strict=True), schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        out: list[tuple] = []
        for row in rows_of(batch_rows(batches)):
            out.append(row)
            if len(out) >= out_rows:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    return df.select(*columns).mapInArrow(run, ddl)


def map_blocks(
    df: DataFrame, blocks_of: Callable[[Iterator[tuple]], Iterable[tuple]], ddl: str, columns: tuple[str, ...] = ("doc_id", "text")
) -> DataFrame:
    """As `map_rows`, but what is yielded are tuples of equally long numpy columns, without nulls."""
    ship(df.sparkSession)
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(blocks: list[tuple]) -> pa.RecordBatch:
            merged = [np.concatenate(parts) for parts in zip(*blocks, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(merged, schema, strict=True)], schema=schema)

        out, held = [], 0
        for block in blocks_of(batch_rows(batches)):
            out.append(block)
            held += len(block[0])
            if held >= OUT_ROWS:
                yield packed(out)
                out, held = [], 0
        if held:
            yield packed(out)

    return df.select(*columns).mapInArrow(run, ddl)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` worked out once however often `body` names it."""
    return F.get(F.transform(F.array(value), lambda held: body(held)), F.lit(0))


def running_totals(values: Column) -> Column:
    """The sums of `values` (whole numbers) up to each place, itself included.

    An array that grows inside an aggregate is copied at every step. So sums run within stretches as long
    as the root of the array, then over the stretches: n ** 1.5 copied numbers instead of n ** 2.
    """
    none = F.array().cast("array<int>")

    def last(sums: Column) -> Column:
        return F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0))

    def summed(part: Column) -> Column:
        return F.aggregate(part, none, lambda sums, value: F.concat(sums, F.array(last(sums) + value)))

    def over_stretches(within: Column) -> Column:
        before = F.aggregate(within, F.array(F.lit(0)), lambda sums, part: F.concat(sums, F.array(last(sums) + last(part))))
        shifted = F.zip_with(within, F.slice(before, 1, F.size(within)), lambda part, base: F.transform(part, lambda x: x + base))
        return F.flatten(shifted)

    def by_stretches(held: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(held))).cast("int")
        stretches = F.transform(F.sequence(F.lit(1), F.size(held), width), lambda at: F.slice(held, at, width))
        return F.when(F.size(held) > 0, bound(F.transform(stretches, summed), over_stretches)).otherwise(none)

    return bound(values, by_stretches)


def hex64(value: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def crc32_sql(text: str) -> str:
    """CRC-32 of ASCII `text` as DuckDB SQL, by the usual table of bytes."""
    steps = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        steps.append(byte)
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    update = f"xor({steps}[(xor(crc, code) & 255) + 1], crc >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda crc, code: {update}), 4294967295)"
