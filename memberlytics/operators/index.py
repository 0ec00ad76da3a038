"""The weekly index: raw scores, T-scores and personas."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberlytics.functions.scores import INDEX_CODES, PERSONA_BY_INDEX, RAW_SCORES, mapped, t_score
from memberlytics.operators.activity import billing_monthly, coupon_7d, log_features, support_monthly
from memberlytics.operators.members import base_members, family_counts, with_family_size
from memberlytics.operators.ranking import latest_by
from memberlytics.operators.subscriptions import (
    catalogued_subscriptions,
    index_rollup,
    mobile_subscriptions,
    product_catalog,
    sharing_used,
)
from memberlytics.params import RunParams


def assemble(base: DataFrame, features: list[DataFrame], key: str = "member_id") -> DataFrame:
    """Left-join one-row-per-key features to the population; all joins share one hash partitioning."""
    for feature in features:
        base = base.join(feature, key, "left")
    return base


def index_features(tables: Mapping[str, DataFrame], params: RunParams, strict_integer_guard: bool = True) -> DataFrame:
    """Every member with all inputs of the six indices; a missing input is null."""
    catalog = product_catalog(tables["product"], tables["mobile_plan"], tables["addon_service"])
    catalogued = catalogued_subscriptions(tables["subscription"], catalog, params.as_of)
    mobile = mobile_subscriptions(tables["subscription"], tables["product"], params.as_of)
    members = with_family_size(base_members(tables["member"]), family_counts(tables["member"]))
    return assemble(
        members,
        [
            index_rollup(catalogued, strict_integer_guard),
            sharing_used(mobile, tables["usage_monthly"], params.yyyymm, strict_integer_guard),
            coupon_7d(tables["member_coupon"], params.as_of),
            support_monthly(tables["support_case"], params.yyyymm),
            billing_monthly(tables["billing"], params.yyyymm),
            log_features(tables["user_event_features_7d"], params.as_of),
        ],
    )


def build_raw_snapshot(
    tables: Mapping[str, DataFrame], params: RunParams, strict_integer_guard: bool = True
) -> DataFrame:
    """Six raw indices for every member."""
    features = index_features(tables, params, strict_integer_guard)
    scores = [score().cast("double").alias(f"{code}_raw") for code, score in RAW_SCORES.items()]
    return features.select(params.snapshot_date.alias("snapshot_date"), "member_id", *scores)


def index_stats(raw: DataFrame) -> DataFrame:
    """One row: mean, population deviation and extremes of each raw index, in one pass."""
    aggregates = []
    for code in INDEX_CODES:
        value = F.col(f"{code}_raw")
        aggregates += [
            F.avg(value).alias(f"{code}_mean"),
            F.stddev_pop(value).alias(f"{code}_stddev"),
            F.min(value).alias(f"{code}_min"),
            F.max(value).alias(f"{code}_max"),
        ]
    return raw.agg(*aggregates)


def build_tscore_snapshot(raw: DataFrame, as_of: date) -> DataFrame:
    """T-scores of one snapshot. `raw` is read twice, so pass a stored snapshot."""
    snapshot = raw.where(F.col("snapshot_date") == F.lit(as_of))
    population = index_stats(snapshot).select(F.struct("*")).scalar()
    scored = snapshot.withColumn("_stats", population)

    def score(code: str) -> Column:
        stats = [F.col(f"_stats.{code}_{name}") for name in ("mean", "stddev", "min", "max")]
        return t_score(F.col(f"{code}_raw"), *stats).alias(f"{code}_tscore")

    return scored.select("snapshot_date", "member_id", *[score(code) for code in INDEX_CODES])


def unpivot_scores(tscores: DataFrame) -> DataFrame:
    """(member_id, index_code, tscore), six rows per member."""
    wide = tscores.select("member_id", *[F.col(f"{code}_tscore").alias(code) for code in INDEX_CODES])
    return wide.unpivot("member_id", INDEX_CODES, "index_code", "tscore")


def winning_index(tscores: DataFrame) -> DataFrame:
    """The highest score of each member, ties to the alphabetically first code, a null above all.

    The six scores sit in one row, so they are compared there: no unpivot, shuffle or sort.
    """
    # Each score is named once, so a plan that computes it does not copy that work per use.
    ranked = F.array_max(
        F.transform(
            F.array(*[F.struct(F.col(f"{code}_tscore").alias("value"), F.lit(code).alias("code"), F.lit(-place).alias("back")) for place, code in enumerate(sorted(INDEX_CODES))]),
            lambda score: F.struct(score["value"].isNull().alias("missing"), F.coalesce(score["value"], F.lit(0.0)).alias("value"), score["back"].alias("back"), score["code"].alias("code")),
        )
    )
    best = tscores.select("member_id", ranked.alias("_best"))
    return best.select(
        "member_id",
        F.col("_best.code").alias("source_index_code"),
        F.when(~F.col("_best.missing"), F.col("_best.value")).alias("source_tscore"),
    )


def latest_persona_type(persona_type: DataFrame) -> DataFrame:
    """The newest active definition of each character."""
    active = persona_type.where(F.col("is_active"))
    order = [F.col("version").desc_nulls_first(), F.col("persona_type_id").desc_nulls_first()]
    return latest_by(active, "character_name", order).select("character_name", "persona_type_id")


def build_persona_snapshot(tscores: DataFrame, persona_type: DataFrame, as_of: date) -> DataFrame:
    """Each member's persona; a member whose character has no active definition is left out."""
    # At most one definition for each of the six personas, so the broadcast side cannot grow. It
    # carries the index code, which spares mapping every member's code to a character.
    wanted = persona_type.where(F.col("character_name").isin(sorted(PERSONA_BY_INDEX.values())))
    index_by_persona = {persona: code for code, persona in PERSONA_BY_INDEX.items()}
    definitions = latest_persona_type(wanted).select(
        mapped(F.col("character_name"), index_by_persona, None).alias("source_index_code"),
        F.col("character_name").alias("persona_code"),
        "persona_type_id",
    )
    winners = winning_index(tscores.where(F.col("snapshot_date") == F.lit(as_of)))
    return winners.join(F.broadcast(definitions), "source_index_code").select(
        F.lit(as_of).alias("snapshot_date"),
        "member_id",
        "persona_type_id",
        "persona_code",
        "source_index_code",
        "source_tscore",
    )
