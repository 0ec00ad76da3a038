"""Active subscriptions and what they say about a member."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memberlytics.functions.numbers import digits_number, json_number, json_text
from memberlytics.operators.lookups import join_lookup
from memberlytics.operators.ranking import latest_by

# Product types (in the order the profile lists them), the security add-on, and the
# words that mark a watch among the tablet and watch plans.
PRODUCT_TYPES = ["MOBILE_PLAN", "INTERNET", "IPTV", "TAB_WATCH_PLAN", "ADDON"]
SECURITY_ADDON = "SECURITY"
WATCH_WORDS = ["%watch%", "%wearable%"]
# Fixed value: a contract counts as expiring this many months ahead.
EXPIRY_MONTHS = 3


def live_subscriptions(subscription: DataFrame, as_of: date) -> DataFrame:
    """Subscriptions in force on `as_of`, first and last day included."""
    started = F.col("start_date") < F.lit(as_of + timedelta(days=1))
    not_ended = F.col("end_date").isNull() | (F.col("end_date") >= F.lit(as_of))
    return subscription.where(F.col("status") & started & not_ended)


def active_subscriptions(subscription: DataFrame, product: DataFrame, as_of: date) -> DataFrame:
    """Live subscriptions with the type and name of their product."""
    products = product.select("product_id", F.col("name").alias("product_name"), "product_type")
    live = live_subscriptions(subscription, as_of).select(
        "subscription_id", "member_id", "product_id", "start_date", "end_date", "contract_end_date"
    )
    return join_lookup(live, products, "product_id", spread_by="subscription_id")


def mobile_subscriptions(subscription: DataFrame, product: DataFrame, as_of: date) -> DataFrame:
    """Live mobile plan subscriptions, ids only."""
    mobile = product.where(is_type("MOBILE_PLAN")).select("product_id", "product_type")
    live = live_subscriptions(subscription, as_of).select("subscription_id", "member_id", "product_id")
    return join_lookup(live, mobile, "product_id", spread_by="subscription_id")


def product_catalog(product: DataFrame, mobile_plan: DataFrame, addon_service: DataFrame | None = None) -> DataFrame:
    """One row per product with its plan and add-on details, so that subscriptions meet the
    dimensions in a single join. Detail tables are unique on `product_id`."""
    catalog = product.select("product_id", F.col("name").alias("product_name"), "product_type").join(
        mobile_plan.select("product_id", "data_amount", "tethering_sharing_data", F.lit(True).alias("has_plan")),
        "product_id",
        "left",
    )
    if addon_service is not None:
        details = addon_service.select("product_id", "addon_type", F.lit(True).alias("is_addon"))
        catalog = catalog.join(details, "product_id", "left")
    return catalog


def catalogued_subscriptions(subscription: DataFrame, catalog: DataFrame, as_of: date) -> DataFrame:
    """Live subscriptions with all product details."""
    return join_lookup(live_subscriptions(subscription, as_of), catalog, "product_id", spread_by="subscription_id")


# -- aggregate expressions, usable alone or together in one pass --------------------------------


def is_type(product_type: str) -> Column:
    return F.col("product_type") == product_type


def any_flag(condition: Column) -> Column:
    """1 when any row satisfies the condition, else 0; an unknown condition does not."""
    return F.max(F.when(condition, 1).otherwise(0))


def _is_watch() -> Column:
    name = F.col("product_name")
    return name.ilike(WATCH_WORDS[0]) | name.ilike(WATCH_WORDS[1])


def addon_aggregates(is_addon: Column) -> list[Column]:
    return [
        F.count_if(is_addon & (F.col("addon_type") == SECURITY_ADDON)).alias("security_addon_cnt"),
        F.count_if(is_addon).alias("addon_subscribe_cnt"),
    ]


def internet_aggregates() -> list[Column]:
    internet, iptv = any_flag(is_type("INTERNET")), any_flag(is_type("IPTV"))
    return [internet.alias("internet_flag"), (internet * iptv).alias("has_internet_iptv_bundle")]


def watch_tablet_aggregates() -> list[Column]:
    plan = is_type("TAB_WATCH_PLAN")
    return [any_flag(plan & _is_watch()).alias("watch_flag"), any_flag(plan & ~_is_watch()).alias("tablet_flag")]


def sharing_limit_aggregate(has_plan: Column, whole_only: bool) -> Column:
    limit = F.when(has_plan & is_type("MOBILE_PLAN"), digits_number(F.col("tethering_sharing_data"), whole_only))
    return F.coalesce(F.max(limit), F.lit(0.0)).alias("sharing_limit_gb")


def contract_aggregate(as_of: date) -> Column:
    ends = F.col("contract_end_date")
    expires = (ends >= F.lit(as_of)) & (ends < F.add_months(F.lit(as_of), EXPIRY_MONTHS))
    return F.bool_or((F.col("product_type") != "ADDON") & ends.isNotNull() & expires).alias("contract_expiry_within_3m")


def subscription_list_aggregate() -> Column:
    """All subscriptions of a member as a JSON array by start date, then id. The list is one cell
    of the result, so it is gathered by the one task that writes that cell."""
    row = F.struct("start_date", "subscription_id", "product_id", "product_name", "product_type")

    def shown(s: Column) -> Column:
        return F.struct(
            s["product_id"].alias("product_id"),
            s["product_name"].alias("product_name"),
            s["product_type"].alias("product_type"),
            F.date_format(s["start_date"], "yyyy-MM-dd").alias("start_date"),
        )

    ordered = F.transform(F.array_sort(F.collect_list(row)), shown)
    return F.to_json(ordered, {"ignoreNullFields": "false"}).alias("current_subscriptions")


def product_type_flags_aggregate() -> Column:
    flags = [F.coalesce(F.bool_or(is_type(t)), F.lit(False)).alias(t) for t in PRODUCT_TYPES]
    return F.to_json(F.struct(*flags)).alias("current_product_types")


# -- operators ----------------------------------------------------------------------------------


def addon_features(active: DataFrame, addon_service: DataFrame) -> DataFrame:
    addons = join_lookup(active, addon_service.select("product_id", "addon_type"), "product_id", spread_by="subscription_id")
    return addons.groupBy("member_id").agg(*addon_aggregates(F.lit(True)))


def internet_iptv_features(active: DataFrame) -> DataFrame:
    return active.groupBy("member_id").agg(*internet_aggregates())


def watch_tablet_features(active: DataFrame) -> DataFrame:
    return active.groupBy("member_id").agg(*watch_tablet_aggregates())


def _mobile(active: DataFrame, mobile_plan: DataFrame) -> DataFrame:
    return join_lookup(active.where(is_type("MOBILE_PLAN")), mobile_plan, "product_id", spread_by="subscription_id")


def sharing_limit(active: DataFrame, mobile_plan: DataFrame, strict_integer_guard: bool = True) -> DataFrame:
    """Largest sharing limit per member. The strict guard takes whole numbers only."""
    plans = _mobile(active, mobile_plan.select("product_id", "tethering_sharing_data"))
    return plans.groupBy("member_id").agg(sharing_limit_aggregate(F.lit(True), strict_integer_guard))


def sharing_used(
    active: DataFrame, usage_monthly: DataFrame, yyyymm: str, strict_integer_guard: bool = True
) -> DataFrame:
    """Shared data used in the month; a missing or non-numeric amount counts as none."""
    field = "tethering_sharing_data_gb"
    usage = usage_monthly.where(F.col("yyyymm") == yyyymm).select("subscription_id", "usage_details")
    plans = active.where(is_type("MOBILE_PLAN")).select("subscription_id", "member_id")
    # The plans are hashed, so that the documents need no sort. Only those that meet a plan are parsed, and each once.
    parsed = plans.hint("shuffle_hash").join(usage, "subscription_id").withColumn("text", json_text(F.col("usage_details"), field))
    amount = json_number(F.col("usage_details"), field, "double", strict_integer_guard, F.col("text"))
    return parsed.groupBy("member_id").agg(F.sum(F.coalesce(amount, F.lit(0.0))).alias("sharing_used_gb"))


def index_rollup(catalogued: DataFrame, strict_integer_guard: bool = True) -> DataFrame:
    """All subscription inputs of the weekly index in one pass and one shuffle."""
    return catalogued.groupBy("member_id").agg(
        *addon_aggregates(F.coalesce("is_addon", F.lit(False))),
        *internet_aggregates(),
        *watch_tablet_aggregates(),
        sharing_limit_aggregate(F.col("has_plan"), strict_integer_guard),
    )


def current_subscriptions(active: DataFrame) -> DataFrame:
    return active.groupBy("member_id").agg(subscription_list_aggregate())


def current_product_types(active: DataFrame) -> DataFrame:
    return active.groupBy("member_id").agg(product_type_flags_aggregate())


def contract_flags(active: DataFrame, as_of: date) -> DataFrame:
    return active.groupBy("member_id").agg(contract_aggregate(as_of))


def mobile_plan_subscription(active: DataFrame, mobile_plan: DataFrame) -> DataFrame:
    """The member's mobile plan: the earliest started one, the lowest id on a tie."""
    plans = _mobile(active, mobile_plan.select("product_id", "data_amount"))
    first = latest_by(plans, "member_id", [F.col("start_date").asc(), F.col("subscription_id").asc()])
    return first.select("member_id", "subscription_id", "start_date", "data_amount")


def profile_rollup(catalogued: DataFrame, as_of: date) -> DataFrame:
    """All subscription inputs of the profile in one pass and one shuffle, for members who have a
    mobile plan (see `mobile_plan_subscription` for which one is taken)."""
    is_mobile = is_type("MOBILE_PLAN") & F.col("has_plan")
    plan = F.struct("subscription_id", F.col("start_date").cast("date").alias("start_date"), "data_amount")
    first_plan = F.min_by(plan, F.when(is_mobile, F.struct("start_date", "subscription_id")))
    rolled = catalogued.groupBy("member_id").agg(
        first_plan.alias("plan"),
        subscription_list_aggregate(),
        product_type_flags_aggregate(),
        contract_aggregate(as_of),
    )
    return rolled.where(F.col("plan").isNotNull()).select("member_id", "plan.*", *rolled.columns[2:])
