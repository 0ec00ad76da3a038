import pytest
from pyspark.sql import functions as F

from memberlytics.operators import merging


def table(spark, rows):
    return spark.createDataFrame(rows, "k bigint, a string, b string, n int")


def contents(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_by_key(spark):
    current = table(spark, [(1, "old", "x", 1), (2, "stays", "x", 2)])
    updates = table(spark, [(1, "new", None, 9), (3, "added", "z", 3)])
    merged = merging.upsert_by_key(current, updates, ["k"])
    assert contents(merged) == [(1, "new", None, 9), (2, "stays", "x", 2), (3, "added", "z", 3)]
    assert contents(merging.upsert_by_key(merged, updates, ["k"])) == contents(merged)


def test_require_unique_names_the_key(spark):
    merging.require_unique(table(spark, [(1, "a", "a", 1), (2, "a", "a", 1)]), ["k"])
    with pytest.raises(merging.DuplicateKeys, match="'k': 7"):
        merging.require_unique(table(spark, [(7, "a", "a", 1), (7, "b", "a", 1), (2, "a", "a", 1)]), ["k"])


def test_insert_ignore(spark):
    current = table(spark, [(1, "old", "x", 1)])
    merged = merging.insert_ignore(current, table(spark, [(1, "new", "y", 2), (2, "new", "y", 2)]), ["k"])
    assert contents(merged) == [(1, "old", "x", 1), (2, "new", "y", 2)]


def test_upsert_columns(spark):
    current = table(spark, [(1, "old", "kept", 5), (2, "stays", "x", 2)])
    updates = spark.createDataFrame([(1, None), (3, "new")], "k bigint, a string")
    merged = merging.upsert_columns(current, updates, "k", ["a"], {"n": F.lit(0)})
    assert contents(merged.fillna("-")) == [(1, "-", "kept", 5), (2, "stays", "x", 2), (3, "new", "-", 0)]
    assert merged.schema == current.schema


def test_repeated_keys(spark):
    current = table(spark, [(1, "old", "x", 1)])
    twice = table(spark, [(2, "b", "y", 2), (2, "a", "y", 3), (1, "new", "y", 2)])
    assert contents(merging.insert_ignore(current, twice, ["k"])) == [(1, "old", "x", 1), (2, "a", "y", 3)]
    for merged in (merging.upsert_by_key(current, twice, ["k"]), merging.upsert_columns(current, twice, "k", ["a"], {})):
        with pytest.raises(Exception, match="DuplicateKeys"):
            merged.collect()


def test_upsert_shuffles_no_incoming_rows(spark, tmp_path):
    """That keys are unique is judged by the keys alone: the rows of a stored update are not sorted or moved for it."""
    current = table(spark, [(1, "old", "x", 1)])
    spark.range(50).selectExpr("id AS k", "'new' AS a", "repeat('y', 9) AS b", "1 AS n").write.parquet(f"{tmp_path}/new")
    spark.range(2).selectExpr("CAST(NULL AS BIGINT) AS k", "'new' AS a", "'y' AS b", "1 AS n").write.parquet(f"{tmp_path}/null")
    merged = merging.upsert_by_key(current, spark.read.parquet(f"{tmp_path}/new"), ["k"])
    assert "Window" not in merged._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 50 and merged.where("a = 'new'").count() == 50
    twice = spark.read.parquet(f"{tmp_path}/new", f"{tmp_path}/new")
    for updates in (twice, spark.read.parquet(f"{tmp_path}/null")):
        for stored in (current, current.limit(0)):
            with pytest.raises(Exception, match="DuplicateKeys"):
                merging.upsert_by_key(stored, updates, ["k"]).collect()
