"""Member context job: build the profiles, merge them into the keyed table, check it."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from memberlytics.operators.merging import require_unique, upsert_by_key
from memberlytics.operators.profile import build_member_context
from memberlytics.operators.quality import context_counts, eligible_count, require_member_context
from memberlytics.params import RunParams
from memberlytics.schemas import SCHEMAS
from memberlytics.sources.versions import Buckets, materialize, read_replaced, replace_table_counted

TABLE = "member_context"


def run_member_context(
    tables: Mapping[str, DataFrame],
    store: str,
    params: RunParams,
    now: datetime,
    bound_to_as_of: bool = False,
    check: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Returns the stored table: profiles built now, and those of members not eligible any more.

    With `buckets` the table is stored in so many buckets of members; the next merge then shuffles the new
    profiles to them and leaves the stored ones where they are.
    """
    spark = tables["member"].sparkSession
    root = f"{store}/{TABLE}"
    # Written once: the uniqueness check and both sides of the merge read it.
    built = materialize(build_member_context(tables, params, now, bound_to_as_of, store_plans=True), TABLE)
    require_unique(built, ["member_id"])

    current = read_replaced(spark, root, SCHEMAS[TABLE])
    layout = Buckets("member_id", buckets) if buckets else None
    stored, counts = replace_table_counted(upsert_by_key(current, built, ["member_id"]), root, context_counts(), layout)
    if check:
        eligible = eligible_count(tables["subscription"], tables["product"]).first().asDict()
        require_member_context({**eligible, **counts, "built_count": built.count()})
    return stored
