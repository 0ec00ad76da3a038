"""Weekly index job: raw scores, T-scores and personas, each stored before the next reads it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from memberlytics.operators.index import build_persona_snapshot, build_raw_snapshot, build_tscore_snapshot
from memberlytics.operators.merging import require_unique
from memberlytics.operators.quality import (
    PERSONA_COLUMNS,
    TSCORE_COLUMNS,
    CheckFailed,
    null_counts,
    require_index_counts,
    require_no_nulls,
    row_counts,
)
from memberlytics.params import RunParams
from memberlytics.sources.versions import replace_snapshot_counted


def run_weekly_index(
    tables: Mapping[str, DataFrame], store: str, params: RunParams, strict_integer_guard: bool = True
) -> dict[str, DataFrame]:
    """Returns the stored snapshots by table name. What the checks need is counted while they are written."""
    as_of, counts = params.as_of, {}

    def stored(df: DataFrame, name: str, required: list[str]) -> DataFrame:
        snapshot, counts[name] = replace_snapshot_counted(df, f"{store}/{name}", as_of, {**row_counts(), **null_counts(required)})
        return snapshot

    raw = stored(build_raw_snapshot(tables, params, strict_integer_guard), "index_raw_snapshot", ["member_id"])
    tscores = stored(build_tscore_snapshot(raw, as_of), "index_tscore_snapshot", TSCORE_COLUMNS)
    persona = stored(build_persona_snapshot(tscores, tables["persona_type"], as_of), "index_persona_snapshot", PERSONA_COLUMNS)

    try:
        rows = {name: found["row_count"] for name, found in counts.items()}
        require_index_counts({"member": tables["member"].count(), **rows})
    except CheckFailed:
        # A second bill of the month repeats its member: name one such member if that is the cause.
        require_unique(raw, ["member_id"])
        raise
    require_no_nulls(counts["index_tscore_snapshot"], "T-score")
    require_no_nulls(counts["index_persona_snapshot"], "persona")
    return {"index_raw_snapshot": raw, "index_tscore_snapshot": tscores, "index_persona_snapshot": persona}
