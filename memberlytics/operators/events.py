"""Event features: 7-day and 90-day click counts, clicks per product type, top tags."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memberlytics.functions.dates import in_last_days
from memberlytics.operators.ranking import top_per_key
from memberlytics.schemas import CLICK_COLUMNS, SCHEMAS
from memberlytics.sources.event_logs import SCAN_DAYS

# The counted events are named like their columns, without the suffix; the last one
# counts over the long window, the others over the short one.
EVENT_BY_COLUMN = {column: column.removesuffix("_cnt") for column in CLICK_COLUMNS}
LONG_WINDOW_COLUMN = "click_change_success_cnt"
SHORT_DAYS = 7
TAGGED_EVENT = "click_product_detail"
TOP_TAGS = 3
# What a fact counts: an event (its value: the product type) or one tag of a detail view.
EVENT_FACT, TAG_FACT = 0, 1


def _normalised(events: DataFrame, *extra: str) -> DataFrame:
    """The event day is the one in its own text; the arrival day has only limited the scan."""
    return events.select(
        *extra,
        "member_id",
        "event_name",
        F.substring("timestamp", 1, 10).cast("date").alias("event_date"),
        F.upper("event_properties.product_type").alias("product_type"),
        F.col("event_properties.tags").alias("tags"),
    )


def _counters(as_of: date) -> list[Column]:
    counters = []
    for column, event in EVENT_BY_COLUMN.items():
        days = SCAN_DAYS if column == LONG_WINDOW_COLUMN else SHORT_DAYS
        hit = (F.col("event_name") == event) & in_last_days(F.col("event_date"), as_of, days)
        counters.append(F.count_if(hit).alias(column))
    return counters


def _type_entry() -> Column:
    return F.when(F.col("product_type").isNotNull(), F.struct("product_type", "clicks"))


def _as_json_map(entries: Column) -> Column:
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def event_counts(events: DataFrame, as_of: date) -> DataFrame:
    """One row for every member with any scanned event, zeros included."""
    counted = _normalised(events).groupBy("member_id").agg(*_counters(as_of))
    return counted.select(F.lit(as_of).alias("snapshot_date"), "*")


def product_type_clicks(events: DataFrame, as_of: date) -> DataFrame:
    """Clicks of the last 7 days per upper-cased product type, as a JSON map per member."""
    recent = _normalised(events).where(
        F.col("product_type").isNotNull() & in_last_days(F.col("event_date"), as_of, SHORT_DAYS)
    )
    per_type = recent.groupBy("member_id", "product_type").agg(F.count(F.lit(1)).alias("clicks"))
    return per_type.groupBy("member_id").agg(_as_json_map(F.collect_list(_type_entry())).alias("product_type_clicks"))


def tag_counts(events: DataFrame, as_of: date) -> DataFrame:
    """Tags of detail views of the last 7 days; repeats inside one event count each time."""
    viewed = _normalised(events).where(
        (F.col("event_name") == TAGGED_EVENT) & in_last_days(F.col("event_date"), as_of, SHORT_DAYS)
    )
    tags = viewed.select("member_id", F.explode("tags").alias("tag"))
    return tags.groupBy("member_id", "tag").agg(F.count(F.lit(1)).alias("tag_cnt"))


def top_tags(counts: DataFrame, k: int = TOP_TAGS) -> DataFrame:
    """The `k` most frequent tags per member as a JSON array, ties by tag."""
    best = top_per_key(counts, ["member_id"], [F.col("tag_cnt").desc(), F.col("tag").asc_nulls_last()], k)
    ordered = F.array_sort(F.collect_list(F.struct("rn", "tag")))["tag"]
    return best.groupBy("member_id").agg(F.to_json(ordered).alias("product_type_top_tags"))


def counts_and_clicks(events: DataFrame, as_of: date) -> DataFrame:
    """`event_counts` and `product_type_clicks` from one scan.

    Events are first summed per (member, recent product type) inside each task, so what is
    shuffled is a handful of rows per member and a very active member weighs no more than others.
    """
    recent_type = F.when(in_last_days(F.col("event_date"), as_of, SHORT_DAYS), F.col("product_type"))
    per_type = (
        _normalised(events)
        .groupBy("member_id", recent_type.alias("product_type"))
        .agg(F.count(F.lit(1)).alias("clicks"), *_counters(as_of))
    )
    return per_type.groupBy("member_id").agg(
        *[F.sum(c).alias(c) for c in CLICK_COLUMNS], _as_json_map(F.collect_list(_type_entry())).alias("product_type_clicks")
    )


def event_facts(events: DataFrame, as_of: date | None = None) -> DataFrame:
    """`member_id`, `event_date`, `event_name`, `kind`, `value`, `n` = 1: a row per event and a row per tag of a
    detail view, from one scan. Names that no column counts are null; `as_of` drops tags out of its window early.
    """
    tagged = F.col("event_name") == TAGGED_EVENT
    if as_of is not None:
        tagged &= in_last_days(F.col("event_date"), as_of, SHORT_DAYS)
    counted = F.when(F.col("event_name").isin(list(EVENT_BY_COLUMN.values())), F.col("event_name"))
    nothing = F.lit(None).cast("string")

    def fact(kind: int, name: Column, value: Column) -> Column:
        return F.struct(name.alias("event_name"), F.lit(kind).alias("kind"), value.alias("value"))

    of_event = F.array(fact(EVENT_FACT, counted, F.col("product_type")))
    of_tags = F.transform("tags", lambda tag: fact(TAG_FACT, nothing, tag))
    facts = F.when(tagged & F.col("tags").isNotNull(), F.concat(of_event, of_tags)).otherwise(of_event)
    extra = ["dt"] if "dt" in events.columns else []
    return _normalised(events, *extra).select("member_id", "event_date", *extra, F.inline(facts), F.lit(1).cast("bigint").alias("n"))


def daily_partials(events: DataFrame) -> DataFrame:
    """Facts summed per arrival day: what later runs need of a day of the log, whatever their date."""
    keys = ["snapshot_date", "member_id", "event_date", "event_name", "kind", "value"]
    facts = event_facts(events).withColumn("snapshot_date", F.col("dt").cast("date"))
    return facts.groupBy(*keys).agg(F.sum("n").alias("n")).select(SCHEMAS["event_daily_partials"].names)


def features_of_facts(facts: DataFrame, as_of: date, ordered: bool = True) -> DataFrame:
    """The event feature table from facts or from sums of them.

    Facts are first summed per (member, kind, value) inside each task, so a very active member costs the shuffle
    a row per product type and tag. A member's tags come before their events in the window, so the place of a tag
    is its rank; ranking and the last sums share one partitioning by member.
    """
    recent = in_last_days(F.col("event_date"), as_of, SHORT_DAYS)
    used = facts.where((F.col("kind") == EVENT_FACT) | recent)
    counters = []
    for column, event in EVENT_BY_COLUMN.items():
        within = in_last_days(F.col("event_date"), as_of, SCAN_DAYS) if column == LONG_WINDOW_COLUMN else recent
        counters.append(F.sum(F.when((F.col("event_name") == event) & within, F.col("n")).otherwise(0)).alias(column))
    summed = used.groupBy("member_id", "kind", F.when(recent, F.col("value")).alias("value")).agg(F.sum("n").alias("clicks"), *counters)

    by_rank = Window.partitionBy("member_id").orderBy(F.col("kind").desc(), F.col("clicks").desc(), F.col("value").asc_nulls_last())
    ranked = summed.withColumn("place", F.row_number().over(by_rank))
    tag = (F.col("kind") == TAG_FACT) & (F.col("place") <= TOP_TAGS)
    # Without a member there is nothing to attach types or tags to: they are joined by member.
    known = F.col("member_id").isNotNull()
    click = known & (F.col("kind") == EVENT_FACT) & F.col("value").isNotNull()
    entries = F.collect_list(F.when(click, F.struct(F.col("value").alias("product_type"), "clicks")))
    top = F.collect_list(F.when(known & tag, F.struct("place", "value")))
    features = (
        ranked.where(tag | (F.col("kind") == EVENT_FACT))
        .groupBy("member_id")
        .agg(
            *[F.sum(c).alias(c) for c in CLICK_COLUMNS],
            _as_json_map(entries).alias("product_type_clicks"),
            F.to_json(F.array_sort(top)["value"]).alias("product_type_top_tags"),
        )
        .withColumn("snapshot_date", F.lit(as_of))
        .select(SCHEMAS["user_event_features_7d"].names)
    )
    return features.orderBy("member_id") if ordered else features


def build_event_features(events: DataFrame, as_of: date, ordered: bool = True) -> DataFrame:
    """The event feature table of one snapshot date, from one scan of the log.

    `ordered` sorts by member, as a reader of the exported file expects; for a stored snapshot the
    order has no meaning and `ordered=False` saves the range shuffle.
    """
    return features_of_facts(event_facts(events, as_of), as_of, ordered)
