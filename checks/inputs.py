"""Member tables derived from the driver's TPC-H-like tables (see FIXTURES.md, part 2).

One SQL text per table serves Spark and DuckDB; `{name}` stands for an input table. `<TEXT>`,
`<LIST>` and `<SHA>` mark the three words in which the dialects differ.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from memberlytics.params import RunParams
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.versions import shared_folder

AS_OF = date(2024, 1, 30)
PARAMS = RunParams(AS_OF, "202312")
NOW = datetime(2024, 1, 30, 12, 0, 0)
# Snapshot dates the chained jobs are run for.
FEATURE_DATES = [date(2024, 1, 16), date(2024, 1, 23), AS_OF]
INDEX_DATES = [date(2024, 1, 23), AS_OF]

# Order dates are moved so that the last order falls on the snapshot date.
DAYS = "INTERVAL 8217 DAY"

TABLES: dict[str, str] = {
    "member": """
        SELECT c_custkey AS member_id,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'VVIP' WHEN 'AUTOMOBILE' THEN 'VIP'
            WHEN 'MACHINERY' THEN 'GOLD' WHEN 'HOUSEHOLD' THEN 'BASIC' END AS membership,
          CASE WHEN c_custkey % 17 <> 0 THEN DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INT) END AS birth_date,
          CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 4 AS INT) END AS children_count,
          CASE WHEN c_custkey % 5 <> 0 THEN CASE WHEN c_nationkey < 8 THEN CAST(-1 AS BIGINT)
            ELSE CAST(floor(c_custkey / 3.0) AS BIGINT) END END AS family_group_id,
          CASE c_custkey % 3 WHEN 0 THEN 'OWNER' WHEN 1 THEN 'MEMBER' END AS family_role
        FROM {customer}""",
    "product": """
        SELECT p_partkey AS product_id,
          concat(p_name, CASE p_partkey % 3 WHEN 0 THEN ' Watch' WHEN 1 THEN ' wearable' ELSE '' END) AS name,
          CASE p_type WHEN 'STANDARD' THEN 'MOBILE_PLAN' WHEN 'ECONOMY' THEN 'MOBILE_PLAN' WHEN 'MEDIUM' THEN 'INTERNET'
            WHEN 'PROMO' THEN 'IPTV' WHEN 'SMALL' THEN 'TAB_WATCH_PLAN' ELSE 'ADDON' END AS product_type
        FROM {part}""",
    "mobile_plan": """
        SELECT p_partkey AS product_id,
          CASE p_size % 4 WHEN 0 THEN 'unlimited' WHEN 1 THEN concat(p_size, 'GB')
            WHEN 2 THEN concat(p_size, '.5GB') ELSE concat('monthly ', p_size, 'GB') END AS data_amount,
          CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN concat(p_size, '.5GB') WHEN 2 THEN 'none'
            ELSE concat('within base ', p_size, 'GB') END AS tethering_sharing_data
        FROM {part} WHERE p_type IN ('STANDARD', 'ECONOMY')""",
    "addon_service": """
        SELECT p_partkey AS product_id, CASE p_size % 2 WHEN 0 THEN 'SECURITY' ELSE 'MEDIA' END AS addon_type
        FROM {part} WHERE p_type = 'LARGE'""",
    "subscription": f"""
        SELECT o_orderkey * 1000000 + l_partkey AS subscription_id, min(o_custkey) AS member_id, l_partkey AS product_id,
          max(l_linestatus) = 'O' AND min(o_orderstatus) = 'O' AS status,
          CAST(min(o_orderdate) + {DAYS} AS DATE) AS start_date,
          CASE WHEN min(l_returnflag) = 'A' THEN CAST(min(o_orderdate) + INTERVAL 9000 DAY AS DATE) END AS end_date,
          CASE WHEN l_partkey % 4 <> 0 THEN DATE '2024-01-20' + CAST(o_orderkey % 180 AS INT) END AS contract_end_date
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey GROUP BY o_orderkey, l_partkey""",
    "usage_monthly": """
        SELECT subscription_id, yyyymm,
          CASE subscription_id % 6 WHEN 0 THEN '[]' WHEN 1 THEN '{{"data_gb": "n/a"}}'
            ELSE concat('{{"data_gb": ', subscription_id % 45, '.5, "tethering_sharing_data_gb": "', subscription_id % 30,
              CASE WHEN subscription_id % 7 = 0 THEN '.5' ELSE '' END, '"}}') END AS usage_details
        FROM (SELECT subscription_id, start_date, <EXPLODE>(<LIST>('202312', '202401')) AS yyyymm FROM {subscription}) months
        WHERE start_date < CASE yyyymm WHEN '202312' THEN DATE '2023-07-01' ELSE DATE '2024-01-01' END""",
    "billing": """
        SELECT c_custkey AS member_id, <EXPLODE>(<LIST>('202312', '202401')) AS yyyymm, c_nationkey % 3 <> 0 AS is_paid
        FROM {customer} WHERE c_acctbal >= 0""",
    "support_case": f"""
        SELECT o_orderkey AS case_id, o_custkey AS member_id,
          CASE WHEN o_orderkey % 13 = 0 THEN '  ' WHEN o_orderkey % 17 = 0 THEN NULL
            ELSE concat(o_orderpriority, ' #', o_orderkey) END AS title,
          CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 5 + 1 AS INT) END AS satisfaction_score,
          o_orderdate + {DAYS} AS created_at,
          CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 8220 DAY END AS resolved_at,
          o_orderdate + INTERVAL 8218 DAY AS updated_at FROM {{orders}}""",
    "member_coupon": """
        SELECT event_id AS coupon_id, user_id AS member_id, event_id % 3 <> 0 AS is_used,
          CASE WHEN event_id % 19 <> 0 THEN ts END AS used_at FROM {events} WHERE event_type = 'purchase'""",
    "churn_score_snapshot": """
        SELECT c_custkey AS member_id, base_date,
          CAST(floor(c_acctbal / 100.0) AS INT) + CAST(extract(DAY FROM base_date) AS INT) AS churn_score,
          CASE WHEN c_acctbal < 0 THEN 'HIGH' WHEN base_date = DATE '2024-01-28' AND c_acctbal < 1000 THEN 'HIGH'
            WHEN c_acctbal < 4000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
        FROM (SELECT c_custkey, c_acctbal, c_nationkey,
                <EXPLODE>(<LIST>(DATE '2024-01-21', DATE '2024-01-28', DATE '2024-02-04')) AS base_date FROM {customer}) d
        WHERE c_nationkey > 3 AND (base_date < DATE '2024-02-01' OR c_nationkey > 12)""",
    "persona_type": """
        SELECT s_suppkey AS persona_type_id,
          CASE s_suppkey % 6 WHEN 0 THEN 'SPACE_SHERLOCK' WHEN 1 THEN 'SPACE_SURFER' WHEN 2 THEN 'SPACE_OCTOPUS'
            WHEN 3 THEN 'SPACE_GRAVITY' WHEN 4 THEN 'SPACE_GUARDIAN' ELSE 'SPACE_EXPLORER' END AS character_name,
          CAST(s_nationkey % 5 AS INT) AS version, s_suppkey % 7 <> 6 AS is_active FROM {supplier}""",
    "event_log": """
        SELECT member_id, event_name, ts_text AS timestamp, product_type,
          CASE WHEN event_id % 4 <> 0 THEN <LIST>(tag_a, tag_b) END AS tags,
          substr(CAST(arrived AS <TEXT>), 1, 10) AS dt
        FROM (
          SELECT event_id, user_id AS member_id,
            CASE event_type WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'click_list_type' WHEN 1 THEN 'click_compare' ELSE 'click_coupon' END
              WHEN 'view' THEN 'click_product_detail' WHEN 'purchase' THEN 'click_change_success'
              WHEN 'error' THEN 'click_penalty' ELSE 'click_change' END AS event_name,
            CAST(happened AS <TEXT>) AS ts_text,
            CASE event_id % 10 WHEN 3 THEN happened + INTERVAL 1 DAY WHEN 7 THEN happened + INTERVAL 30 DAY ELSE happened END AS arrived,
            CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'mobile_plan' WHEN 2 THEN 'internet' WHEN 3 THEN 'IPTV'
              WHEN 4 THEN 'tab_watch_plan' ELSE 'Addon' END AS product_type,
            CASE event_id % 5 WHEN 0 THEN 'OTT프리미엄' WHEN 1 THEN '가족결합메인' WHEN 2 THEN '가족공유' WHEN 3 THEN '테더링쉐어링' ELSE 'eco' END AS tag_a,
            CASE event_id % 7 WHEN 0 THEN 'OTT프리미엄' WHEN 1 THEN '가족결합메인' WHEN 2 THEN '가족공유' WHEN 3 THEN '테더링쉐어링'
              WHEN 4 THEN 'eco' WHEN 5 THEN 'kids' ELSE 'roaming' END AS tag_b
          FROM (SELECT event_id, user_id, event_type,
                  CASE event_id % 8 WHEN 0 THEN ts - INTERVAL 40 DAY WHEN 1 THEN ts - INTERVAL 80 DAY
                    WHEN 2 THEN ts - INTERVAL 120 DAY ELSE ts END AS happened FROM {events}) e) e""",
    "consultation_analysis": """
        SELECT o_orderkey AS analysis_id, o_orderkey AS case_id, CAST(1 AS BIGINT) AS analyzer_version,
          CAST(100 AS BIGINT) AS job_instance_id, TIMESTAMP '2024-01-29 09:00:00' AS updated_at
        FROM {orders} WHERE o_orderstatus IN ('F', 'P')""",
    "analysis_dispatch_outbox": """
        SELECT <SHA> AS request_id, CAST(100 AS BIGINT) AS job_instance_id,
          CAST(o_orderkey % 50 AS <TEXT>) AS chunk_id, '1' AS analysis_version,
          CASE o_orderkey % 6 WHEN 0 THEN 'READY' WHEN 1 THEN 'RETRY' WHEN 2 THEN 'SENT' WHEN 3 THEN 'ACKED' WHEN 4 THEN 'DEAD' ELSE 'RETRY' END AS dispatch_status,
          CAST(o_orderkey % 3 AS INT) AS attempt_count,
          CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '2024-01-30 11:00:00' ELSE TIMESTAMP '2024-01-30 13:00:00' END AS next_retry_at,
          CASE WHEN o_orderkey % 6 = 1 THEN 'broker gone' END AS last_error,
          TIMESTAMP '2024-01-29 10:00:00' AS created_at, TIMESTAMP '2024-01-29 11:00:00' AS updated_at, 'REQUEST' AS type,
          CAST(o_orderkey % 50 AS BIGINT) AS claim_token,
          CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '2024-01-30 11:00:00' ELSE TIMESTAMP '2024-01-30 11:50:00' END AS claimed_started_at,
          CASE o_orderkey % 8 WHEN 0 THEN TIMESTAMP '2024-01-30 11:55:00' END AS claimed_done_at
        FROM {orders} WHERE o_orderstatus = 'F'""",
    # The same state with a second analyzer version, and with outbox rows of another type.
    "consultation_analysis_mixed": """
        SELECT analysis_id, case_id, analyzer_version, job_instance_id, updated_at FROM {consultation_analysis}
        UNION ALL SELECT analysis_id + 1000000000, case_id, CAST(2 AS BIGINT), job_instance_id, updated_at
        FROM {consultation_analysis} WHERE case_id % 5 < 2""",
    "analysis_dispatch_outbox_mixed": """
        SELECT request_id, job_instance_id, chunk_id, analysis_version, dispatch_status, attempt_count, next_retry_at, last_error,
          created_at, updated_at, CASE WHEN attempt_count = 1 THEN 'RESULT' ELSE type END AS type, claim_token,
          claimed_started_at, claimed_done_at
        FROM {analysis_dispatch_outbox}""",
}

DIALECTS = {
    "spark": {"<TEXT>": "STRING", "<LIST>": "array", "<EXPLODE>": "explode", "<SHA>": "sha2(concat(o_orderkey, ':1'), 256)"},
    "duckdb": {"<TEXT>": "VARCHAR", "<LIST>": "list_value", "<EXPLODE>": "unnest", "<SHA>": "sha256(concat(o_orderkey, ':1'))"},
}
DRIVER_TABLES = ["customer", "orders", "lineitem", "part", "supplier", "events"]


def dialect_sql(name: str, dialect: str) -> str:
    text = TABLES[name]
    for marker, word in DIALECTS[dialect].items():
        text = text.replace(marker, word)
    return text


def inputs_of(name: str) -> list[str]:
    return [t for t in [*DRIVER_TABLES, *TABLES] if "{" + t + "}" in TABLES[name]]


# Line items that a task joins and sums at most, whatever their number.
TASK_ROWS = 400_000
_staged: dict[tuple[str, str], str] = {}


def _subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one mapped table that takes a join and an aggregate. It is built once per session and data set, as jobs
    would find it stored, by tasks whose size does not follow the data."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        lines, orders = (table(spark, sf_dir, t) for t in ("lineitem", "orders"))
        # A given number of partitions is not merged afterwards to suit the number of cores.
        parts = max(spark.sparkContext.defaultParallelism, -(-lines.count() // TASK_ROWS))
        dealt = {"lineitem": lines.repartition(parts, "l_orderkey"), "orders": orders.repartition(parts, "o_orderkey")}
        path = f"{shared_folder(spark)}/subscription-{uuid.uuid4().hex}"
        spark.sql(dialect_sql("subscription", "spark"), **dealt).to(SCHEMAS["subscription"]).write.parquet(path)
        _staged[key] = path
    return spark.read.schema(SCHEMAS["subscription"]).parquet(_staged[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The mapped table `name` under its fixed schema, read from the driver's Parquet files."""
    if name in DRIVER_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "subscription":
        return _subscriptions(spark, sf_dir)
    df = spark.sql(dialect_sql(name, "spark"), **{t: table(spark, sf_dir, t) for t in inputs_of(name)})
    if name == "event_log":
        properties = "named_struct('product_type', product_type, 'tags', tags) AS event_properties"
        return df.selectExpr("member_id", "event_name", "timestamp", properties, "dt")
    return df.to(SCHEMAS[name.removesuffix("_mixed")])


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in names}


@cache
def _closure(name: str) -> tuple[str, ...]:
    needed = [n for t in inputs_of(name) if t in TABLES for n in _closure(t)]
    return tuple(dict.fromkeys([*needed, name]))


def duckdb_tables(*names: str) -> list[str]:
    """CTE definitions, in order, of the mapped tables `names` and what they need."""
    wanted = dict.fromkeys(n for name in names for n in _closure(name))
    plain = {t: t for t in [*DRIVER_TABLES, *TABLES]}
    return [f"{n} AS ({dialect_sql(n, 'duckdb').format(**plain)})" for n in wanted]
