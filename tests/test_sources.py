import json
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from memberlytics.operators.merging import upsert_by_key
from memberlytics.schemas import REQUIRED_TABLES, SCHEMAS
from memberlytics.sources import event_logs, features_csv, messages, tables, versions

AS_OF, BEFORE = date(2024, 1, 30), date(2024, 1, 23)
RAW = SCHEMAS["index_raw_snapshot"]


def snapshot(spark, day, *members):
    return spark.createDataFrame([(day, m, *[float(m)] * 6) for m in members], RAW)


def stored(spark, root, as_of=None):
    rows = versions.read_snapshots(spark, root, RAW, as_of).collect()
    return sorted((r.snapshot_date, r.member_id) for r in rows)


def test_replace_snapshot(spark, tmp_path):
    root = str(tmp_path / "raw")
    assert stored(spark, root) == []
    versions.replace_snapshot(snapshot(spark, AS_OF, 1, 2), root, AS_OF)
    versions.replace_snapshot(snapshot(spark, BEFORE, 1), root, BEFORE)
    with pytest.raises(Exception, match="is dated"):
        versions.replace_snapshot(snapshot(spark, AS_OF, 3).unionByName(snapshot(spark, BEFORE, 8)), root, AS_OF)
    assert stored(spark, root) == [(BEFORE, 1), (AS_OF, 1), (AS_OF, 2)]
    versions.replace_snapshot(snapshot(spark, AS_OF, 3), root, AS_OF)
    assert stored(spark, root) == [(BEFORE, 1), (AS_OF, 3)]
    assert stored(spark, root, AS_OF) == [(AS_OF, 3)]
    assert versions.read_snapshots(spark, root, RAW).schema == RAW

    versions.replace_snapshot(snapshot(spark, AS_OF), root, AS_OF)
    assert stored(spark, root) == [(BEFORE, 1)] and stored(spark, root, AS_OF) == []


def test_snapshot_replaced_by_its_own_rows(spark, tmp_path):
    root = str(tmp_path / "raw")
    versions.replace_snapshot(snapshot(spark, AS_OF, 1, 2, 3), root, AS_OF)
    versions.replace_snapshot(versions.read_snapshots(spark, root, RAW).where("member_id > 1"), root, AS_OF)
    assert stored(spark, root) == [(AS_OF, 2), (AS_OF, 3)]


def test_failed_write_leaves_the_former_version(spark, tmp_path):
    root = str(tmp_path / "raw")
    versions.replace_snapshot(snapshot(spark, AS_OF, 1), root, AS_OF)
    broken = snapshot(spark, AS_OF, 2).selectExpr("snapshot_date", "CAST(raise_error('boom') AS BIGINT) AS member_id", *RAW.names[2:])
    with pytest.raises(PySparkException):
        versions.replace_snapshot(broken, root, AS_OF)
    assert stored(spark, root) == [(AS_OF, 1)]


def test_replace_table(spark, tmp_path):
    root = str(tmp_path / "product")
    schema = SCHEMAS["product"]
    assert versions.read_replaced(spark, root, schema).count() == 0
    versions.replace_table(spark.createDataFrame([(1, "a", "IPTV")], schema), root)
    grown = versions.read_replaced(spark, root, schema).union(spark.createDataFrame([(2, "b", None)], schema))
    versions.replace_table(grown, root)
    assert sorted(r.product_id for r in versions.read_replaced(spark, root, schema).collect()) == [1, 2]


def test_features_csv(spark, tmp_path):
    path = str(tmp_path / "features")
    row = (AS_OF, 5, *range(7), '{"IPTV":2,"A,\\"B":1}', '["가족공유","x\\\\y"]')
    features = spark.createDataFrame([row], features_csv.FEATURES)
    features_csv.write_features_csv(features, path)
    assert [tuple(r) for r in features_csv.read_features_csv(spark, path).collect()] == [row]
    header = next(tmp_path.glob("features/part-*")).read_text().splitlines()[0]
    assert header == ",".join(features_csv.FEATURES.names)


def test_csv_with_another_header_is_an_error(spark, tmp_path):
    path = str(tmp_path / "other")
    names = features_csv.FEATURES.names
    other = spark.createDataFrame([(AS_OF, 5, *range(7), "{}", "[]")], features_csv.FEATURES).select(*names[:2], *names[3:4], *names[2:3], *names[4:])
    other.write.option("header", True).option("escape", '"').csv(path)
    with pytest.raises(Exception, match="header does not conform"):
        features_csv.read_features_csv(spark, path).collect()


def test_event_scan_is_pruned_to_90_days(spark, tmp_path):
    path = str(tmp_path / "log")
    days = ["2023-11-01", "2023-11-02", "2024-01-30", "2024-01-31"]
    rows = [(i, "x", f"{day} 10:00:00", ("iptv", ["a"]), day) for i, day in enumerate(days)]
    spark.createDataFrame(rows, SCHEMAS["customer_event_logs_raw"]).write.partitionBy("dt").parquet(path)
    scan = event_logs.scan_event_logs(spark, path, AS_OF)
    assert sorted(r.dt for r in scan.collect()) == days[1:3]
    assert len(scan.inputFiles()) == 4  # the log as a whole
    plan = scan._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "2023-11-02" in partition_filters and "2024-01-31" in partition_filters


def test_required_tables(spark, tmp_path):
    root = str(tmp_path)
    for name in ("member", "product"):
        spark.createDataFrame([], SCHEMAS[name]).write.parquet(f"{root}/{name}")
    tables.require_tables(spark, ["member", "product"], root)
    with pytest.raises(tables.MissingTables) as first:
        tables.require_tables(spark, ["member", "billing", "usage_monthly"], root)
    assert "billing" in str(first.value) and "usage_monthly" not in str(first.value)
    with pytest.raises(tables.MissingTables) as all_missing:
        tables.require_tables(spark, REQUIRED_TABLES["member_context"], root, list_all=True)
    assert "usage_monthly, user_event_features_7d" in str(all_missing.value) and "product" not in str(all_missing.value)
    with pytest.raises(tables.MissingTables):
        tables.require_tables(spark, ["no_such_catalog_table"])
    spark.range(1).createOrReplaceTempView("some_catalog_table")
    tables.require_tables(spark, ["some_catalog_table"])


def test_message_sink(spark, tmp_path):
    path = str(tmp_path / "messages")
    targets = spark.createDataFrame([("k", 1, 2)], "request_id string, case_id bigint, analyzer_version bigint")
    messages.write_messages(messages.to_request_messages(targets), path)
    messages.write_messages(messages.to_request_messages(targets), path)
    lines = [json.loads(line) for f in (tmp_path / "messages").glob("part-*") for line in f.read_text().splitlines()]
    assert len(lines) == 2 and json.loads(lines[0]["value"]) == {"dispatchRequestId": "k", "caseId": 1, "analyzerVersion": 2}


def test_table_in_buckets(spark, tmp_path):
    """A merge into a table stored in buckets shuffles the incoming rows only, in any session."""
    root, schema = str(tmp_path / "profiles"), SCHEMAS["product"]
    layout = versions.Buckets("product_id", 4)
    rows = spark.range(2000).selectExpr("id AS product_id", "concat('n', id) AS name", "'IPTV' AS product_type")
    versions.replace_table(rows, root, layout)
    new = spark.range(1990, 2010).selectExpr("id AS product_id", "'new' AS name", "'ADDON' AS product_type")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for _ in range(2):
            current = versions.read_replaced(spark, root, schema)
            merged = upsert_by_key(current, new, ["product_id"])
            plan = merged._jdf.queryExecution().executedPlan().toString()
            scan = plan.index("FileScan parquet")
            assert "SelectedBucketsCount: 4 out of 4" in plan or "Bucketed: true" in plan
            # Between the stored rows and the join there is no exchange.
            assert "Exchange" not in plan[plan.index("LeftAnti") : scan]
            # Another session knows the files, not the catalog entry.
            for table in spark.catalog.listTables():
                if table.name.startswith("bucketed_"):
                    spark.sql(f"DROP TABLE {table.name}")
        stored, counts = versions.replace_table_counted(merged, root, {"n": F.count(F.lit(1))}, layout)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts == {"n": 2010} and stored.count() == 2010 and stored.where("name = 'new'").count() == 20
    again = versions.read_replaced(spark, root, schema)
    assert again.groupBy("product_id").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
    # Back to a plain table: the newest pointer decides.
    versions.replace_table(again, root)
    assert versions.read_replaced(spark, root, schema).count() == 2010


def test_counts_are_those_of_the_rows_written(spark, tmp_path):
    root = str(tmp_path / "raw")
    counts = {"row_count": F.count(F.lit(1)), "nulls": F.count_if(F.col("explore_raw").isNull())}
    rows = snapshot(spark, AS_OF, 1, 2, 3).withColumn("explore_raw", F.when(F.col("member_id") > 1, F.col("explore_raw")))
    kept, found = versions.replace_snapshot_counted(rows, root, AS_OF, counts)
    assert found == {"row_count": 3, "nulls": 1} and kept.count() == 3
    assert versions.replace_snapshot_counted(rows.limit(0), root, AS_OF, counts)[1] == {"row_count": 0, "nulls": 0}


def test_several_dates_and_tables_change_in_one_commit(spark, tmp_path, monkeypatch):
    root, day = str(tmp_path / "raw"), date(2024, 1, 16)
    versions.replace_snapshot(snapshot(spark, BEFORE, 9), root, BEFORE)
    both = snapshot(spark, AS_OF, 1, 2).unionByName(snapshot(spark, BEFORE, 3))
    versions.replace_snapshots(both, root, {AS_OF: "a", BEFORE: "b", day: "none"})
    assert stored(spark, root) == [(BEFORE, 3), (AS_OF, 1), (AS_OF, 2)]
    assert versions.snapshot_notes(spark, root) == {AS_OF: "a", BEFORE: "b", day: "none"}
    rows = versions.read_snapshots(spark, root, RAW, AS_OF, date(2024, 1, 24)).collect()
    assert {r.snapshot_date for r in rows} == {AS_OF}
    with pytest.raises(Exception, match="is dated"):
        versions.replace_snapshots(both, root, {AS_OF: "c"})
    store = str(tmp_path / "store")
    one, two = spark.range(3), spark.range(5)
    versions.replace_table(one, f"{store}/one")
    kept = versions.replace_tables({"one": two, "two": one}, store, note="first")
    assert kept["one"].count() == 5 and versions.read_replaced(spark, f"{store}/two", one.schema).count() == 3
    assert versions.note_of(spark, f"{store}/one") == versions.note_of(spark, f"{store}/two") == "first"

    def dies(*args):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "_point", dies)
        with pytest.raises(OSError):
            versions.replace_tables({"one": one, "two": two}, store)
    assert versions.read_replaced(spark, f"{store}/one", one.schema).count() == 5
    versions.replace_table(one, f"{store}/one")
    assert versions.read_replaced(spark, f"{store}/one", one.schema).count() == 3
