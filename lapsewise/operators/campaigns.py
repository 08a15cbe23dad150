"""Member features as of many campaign instants, from one pass over each source.

A campaign reads a member's rows before its instant, or within a window that ends
there. The instants and window starts of all campaigns cut time into segments, and
a row counts for the same windows as any other row of its segment. So every source
is scanned once and aggregated by member and the next cut after the row's time
(found through a table of days that holds each day's cuts: an equi-join, whatever
the number of campaigns); running totals over a member's segments then give each
window as a difference, and running maxima the latest value as of each instant. A
row meets one segment, never all the campaigns that read it.

An interval that contains an instant has started by then and not ended before:
starts minus earlier ends, counted the same way.

``campaigns`` has campaign_id and campaign_at, one row a campaign; its size is that
of the campaign calendar. The result has a row per campaign and member.

A member is read three times a campaign, and has at most one segment a cut and source.
So members are counted first, and a task gets as many as make ``READINGS_A_TASK``: what
it sorts does not grow with the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import count_where, days, flag
from ..spec import CampaignSpec

SIDES = ("at", "recent", "contact")  # the instant, the start of recent events, the start of contact pressure
MICROSECOND = "INTERVAL '0.000001' SECOND"
READINGS_A_TASK = 500_000


def _probes(campaigns: DataFrame, spec: CampaignSpec) -> DataFrame:
    """(campaign_id, side, cut): the instants at which running totals are read."""
    at = F.col("campaign_at").cast("timestamp_ntz")
    sides = F.array(*[F.struct(F.lit(s).alias("side"), cut.alias("cut")) for s, cut in zip(
        SIDES, (at, at - days(spec.recent_days), at - days(spec.contact_days)))])
    return campaigns.select("campaign_id", F.inline(sides))


def _days(probes: DataFrame) -> DataFrame:
    """(day, cuts of that day in order, the first cut of a later day), from the day
    before the first cut on. As long as the calendar of the campaigns."""
    of_day = probes.groupBy(F.to_date("cut").alias("day")).agg(F.sort_array(F.collect_set("cut")).alias("cuts"))
    span = F.sequence(F.date_sub(F.min("day"), 1), F.max("day"), F.expr("INTERVAL 1 DAY"))
    every = of_day.agg(span.alias("days")).select(F.explode("days").alias("day")).join(of_day, "day", "left")
    later = F.min(F.element_at("cuts", 1)).over(Window.orderBy("day").rowsBetween(1, Window.unboundedFollowing))
    return every.select("day", "cuts", later.alias("later"))


def by_next_cut(rows: DataFrame, time: str, calendar: DataFrame, bounds: tuple, *measures: Column) -> DataFrame:
    """The measures of ``rows`` by member and the first cut after ``time``; rows at or
    after the last cut count for no campaign and are left to the scan's filter."""
    first, last = bounds
    inside = rows.filter(F.col("member_id").isNotNull() & (F.col(time) < F.lit(last)))
    day = F.greatest(F.to_date(time), F.date_sub(F.to_date(F.lit(first)), 1))
    placed = inside.withColumn("_day", day).join(F.broadcast(calendar), F.col("_day") == F.col("day"))
    cut = F.coalesce(F.get(F.filter("cuts", lambda c: c > F.col(time)), F.lit(0)), F.col("later"))
    return placed.groupBy("member_id", cut.alias("cut")).agg(*measures)


def campaign_features(members: DataFrame, listings: DataFrame, events: DataFrame, touches: DataFrame, exclusions: DataFrame,
                      campaigns: DataFrame, spec: CampaignSpec) -> DataFrame:
    """The feature columns of ``member_360`` for every campaign and member."""
    probes = _probes(campaigns, spec)
    calendar = _days(probes)
    instants = probes.collect()  # three a campaign
    if not instants:
        raise ValueError("no campaign: the table of campaigns is empty")
    bounds = min(r.cut for r in instants), max(r.cut for r in instants)
    one = F.lit(1).cast("bigint")
    name = F.col("event_name")
    categorised = F.when(F.col("category") != "", F.struct("event_ts", "event_id", "category"))
    # an interval counts from its start on and no more after its end
    spans = exclusions.filter("start_at <= end_at").select("member_id", F.inline(F.array(
        F.struct((F.col("start_at") - F.expr(MICROSECOND)).alias("moment"), F.lit(1).alias("step")),
        F.struct(F.col("end_at").alias("moment"), F.lit(-1).alias("step")))))
    sources = [
        by_next_cut(listings, "created_at", calendar, bounds, F.count(one).alias("listings"), F.max("created_at").alias("last_listing_at"),
                    F.count_if(F.col("sold_at").isNotNull()).alias("sales"),
                    F.sum(F.coalesce(F.col("sale_value"), F.lit(0).cast("decimal(18,2)"))).alias("gmv")),
        by_next_cut(events, "event_ts", calendar, bounds, F.count(one).alias("events"), F.max("event_ts").alias("last_activity_at"),
                    count_where(name == "watchlist_added").alias("watchlist"), count_where(name == "purchase_completed").alias("purchases"),
                    F.max(categorised).alias("latest")),
        by_next_cut(touches, "sent_at", calendar, bounds, F.count(one).alias("contacts")),
        by_next_cut(spans, "moment", calendar, bounds, F.sum("step").alias("active")),
    ]
    segments = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    # Readings sort behind the segments that end with their cut.
    readings = F.array(*[F.struct(F.lit(r.campaign_id).alias("campaign_id"), F.lit(r.side).alias("side"), F.lit(r.cut).alias("cut"))
                         for r in instants])
    known = members.select("member_id").distinct()
    tasks = max(members.sparkSession.sparkContext.defaultParallelism, -(-known.count() * len(instants) // READINGS_A_TASK))
    asked = known.select("member_id", F.inline(readings))
    rows = segments.unionByName(asked, allowMissingColumns=True).repartition(tasks, "member_id")
    so_far = Window.partitionBy("member_id").orderBy("cut", F.col("side").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    totals = ("listings", "sales", "gmv", "events", "watchlist", "purchases", "contacts", "active")
    running = [F.sum(c).over(so_far).alias(c) for c in totals] + [F.max(c).over(so_far).alias(c) for c in ("last_listing_at", "last_activity_at", "latest")]
    read = rows.select("member_id", "campaign_id", "side", *running).filter("side IS NOT NULL")

    def at(c: str, side: str = "at") -> Column:
        return F.max(F.when(F.col("side") == side, F.col(c)))

    def total(c: str, since: str | None = None) -> Column:
        value = F.coalesce(at(c), F.lit(0).cast("bigint"))
        return value - F.coalesce(at(c, since), F.lit(0).cast("bigint")) if since else value

    return read.groupBy("campaign_id", "member_id").agg(
        total("listings").alias("historical_listing_count"), at("last_listing_at").alias("last_listing_at"),
        total("sales").alias("historical_sales_count"),
        F.coalesce(at("gmv"), F.lit(0)).cast("decimal(28,2)").alias("historical_gmv"),
        at("last_activity_at").alias("last_activity_at"),
        total("events", "recent").alias("recent_event_count"), total("watchlist", "recent").alias("recent_watchlist_count"),
        total("purchases", "recent").alias("recent_purchase_count"), total("contacts", "contact").alias("marketing_contacts_7d"),
        flag(at("active") > 0).alias("has_active_campaign_exclusion"), at("latest")["category"].alias("preferred_category"),
    )
