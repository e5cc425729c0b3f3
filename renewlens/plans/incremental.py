"""Daily runs that read one day of leads (C5, C7, S2).

The full build scans 1,100 days of lead supply and lead masters each day. Here
a state folder holds what earlier days left behind, and a run merges one new
day into it. The state's tables are ``DatedStore``s, one run per arrival day,
so a rerun replaces its day and a crash leaves the state of the day before.

``supply``, ``masters``  the day's rows of either source: a lead counts once
             both are there, whichever comes first
``leads``    the distinct lead rows that became complete that day, with listing
             details, and ``leave``, the last moment at which a window that
             starts there still holds the lead
``city_days``  per (city, lead day) touched that day: the daily counts over the
             leads known by then. Leads without a price wait for the seller's
             median, so lead counts cover the lead groups (listing, lead,
             property, channel) without such a row
``open_leads``  the other groups of those (city, lead day)s: their prices, and
             the sellers whose median stands in

A (city, lead day) is touched when a lead arrives in it or the window's start
passes a lead of it. The latest version of each counts.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renewlens import params as P
from renewlens.functions import scalars as X
from renewlens.plans import features as C
from renewlens.sources.store import DatedStore, stage

LEAD_COLS = [
    "city", "seller_uuid", "listing_id", "listing_price", "property_type", "bhk_type",
    "lead_id", "lead_type", "lead_date", "lead_filler", "lead_generator", "traffic_sourcemedium",
]
CITY_DAY = ["city", "lead_date"]
GROUP = [*CITY_DAY, "listing_id", "property_type", "lead_id", "lead_generator_new"]


class LeadState:
    """The state folder of one parameter set."""

    def __init__(self, spark: SparkSession, path: str, p: P.FeatureParams = P.FeatureParams()):
        self.spark, self.p = spark, p
        names = ("supply", "masters", "leads", "city_days", "open_leads")
        self.supply, self.masters, self.leads, self.city_days, self.open_leads = (DatedStore(spark, f"{path.rstrip('/')}/{n}") for n in names)

    def _window(self, day: dt.date):
        return C._ts(day - dt.timedelta(days=self.p.lead_history_days)), C._ts(day)

    def last_day(self, before: dt.date) -> dt.date | None:
        """The newest day before ``before`` that was finished."""
        done = [d for d in self.city_days.days() if d < str(before)]
        return dt.date.fromisoformat(done[-1]) if done else None

    def update(self, src, day: dt.date) -> None:
        """Merge what arrived after the last stored day, up to ``day``; the first
        run takes the whole window. A day that was run before is run again from
        the state of the day before it."""
        last = self.last_day(day)
        lo, hi = self._window(day)

        def fresh(df: DataFrame) -> DataFrame:
            after = F.col("created_at") >= lo if last is None else F.col("created_at") > C._ts(last)
            return df.where(after & (F.col("created_at") <= hi))

        self.supply.write(fresh(src.lead_supply_users).select("profile_uuid", "lead_id", "created_at"), day)
        self.masters.write(fresh(src.lead_masters), day)
        new_s, new_m = (self._of(t, day) for t in (self.supply, self.masters))
        old_s, old_m = self.supply.read(before=day), self.masters.read(before=day)
        pairs = self._complete(new_s, new_m if old_m is None else old_m.unionByName(new_m))
        if old_s is not None:
            pairs = pairs.unionByName(self._complete(old_s, new_m))
        rows = pairs.where(F.col("leave") >= lo).join(C.listing_details(src), "listing_id", "left")
        self.leads.write(rows.groupBy(*LEAD_COLS).agg(F.max("leave").alias("leave")), day)
        self._recount(day, last)

    def _of(self, table: DatedStore, day: dt.date) -> DataFrame:
        """The rows that ``day`` itself stored."""
        run = table._commits(str(day))[-1].split("-")[1]
        return self.spark.read.parquet(f"{table.path}/runs/{day}/{run}")

    @staticmethod
    def _complete(supply: DataFrame, masters: DataFrame) -> DataFrame:
        s = supply.select(F.col("profile_uuid").alias("seller_uuid"), "lead_id", F.col("created_at").alias("__at"))
        return s.join(masters.withColumnRenamed("created_at", "__lm_at"), F.col("lead_id") == F.col("id")).select(
            "seller_uuid", "lead_id", F.col("service_object_id").alias("listing_id"), F.to_date("__lm_at").alias("lead_date"),
            "lead_generator", "lead_filler", "lead_type", "traffic_sourcemedium", F.least("__at", "__lm_at").alias("leave"))

    def _alive(self, day: dt.date) -> DataFrame:
        """Distinct lead rows of the window that ends at ``day``, with ``leave``."""
        lo, _ = self._window(day)
        known = self.leads.read(before=day + dt.timedelta(days=1))
        return known.where(F.col("leave") >= lo).groupBy(*LEAD_COLS).agg(F.max("leave").alias("leave"))

    def _recount(self, day: dt.date, last: dt.date | None) -> None:
        """New versions of the (city, lead day)s that ``day`` touched."""
        lo, _ = self._window(day)
        touched = self._of(self.leads, day).select(*CITY_DAY)
        if last is not None:
            before, _ = self._window(last)
            gone = self.leads.read(before=day).where((F.col("leave") >= before) & (F.col("leave") < lo)).select(*CITY_DAY)
            touched = touched.unionByName(gone)
        touched = stage(touched.where("city is not null").dropDuplicates(), "state-touched")
        alive = self._alive(day).where("listing_id is not null").join(touched, CITY_DAY, "left_semi")
        alive = stage(alive.withColumn("lead_generator_new", X.channel_bucket(F.col("lead_generator"))), "state-alive")
        counts = C.city_daily_activity(alive.withColumn("listing_price", F.lit(0.0))).drop("total_leads_daily")
        price = F.col("listing_price").cast("double")
        groups = alive.where("lead_id is not null").groupBy(*GROUP).agg(
            F.collect_set(price).alias("prices"), F.collect_set(F.when(price.isNull(), F.struct("seller_uuid"))).alias("waiting"))
        groups = stage(groups, "state-groups")
        closed = groups.where(F.size("waiting") == 0).groupBy(*CITY_DAY).agg(F.sum(F.size("prices")).alias("closed_leads"))
        # a touched day without a lead left has a version too: it holds nothing
        days = touched.join(counts, CITY_DAY, "left").join(closed, CITY_DAY, "left").withColumn("version", F.lit(day))
        self.open_leads.write(groups.where(F.size("waiting") > 0).withColumn("version", F.lit(day)), day)
        self.city_days.write(days, day)  # last: it marks the day as finished

    def raw_leads(self, day: dt.date) -> DataFrame:
        """``leads_with_listings`` as of ``day``."""
        return self._alive(day).drop("leave")

    def city_daily(self, day: dt.date, leads: DataFrame) -> DataFrame:
        """``city_daily_activity`` as of ``day`` from the counts; ``leads`` (as
        ``raw_leads`` gives them) are read for sellers' medians only."""
        through = day + dt.timedelta(days=1)
        versions = self.city_days.read(before=through)
        names = [c for c in versions.columns if c not in CITY_DAY]
        latest = versions.groupBy(*CITY_DAY).agg(F.max_by(F.struct(*names), "version").alias("v")).select(*CITY_DAY, "v.*")
        latest = stage(latest.where("active_sellers_daily is not null"), "state-latest")
        waiting = self.open_leads.read(before=through).join(latest.select(*CITY_DAY, "version"), [*CITY_DAY, "version"], "left_semi")
        rows = waiting.withColumn("w", F.explode("waiting")).select(*GROUP, "prices", F.col("w.seller_uuid").alias("seller_uuid"))
        median = C.seller_median_price(leads)
        filled = rows.join(median, "seller_uuid", "left").groupBy(*GROUP).agg(
            F.first("prices").alias("prices"), F.collect_set("mean_listing_price").alias("medians"),
            F.max(F.col("mean_listing_price").isNull().cast("int")).alias("none"))
        # a price that no median stands in for is a value of its own
        one = F.size(F.array_union("prices", "medians")) + F.col("none")
        opened = filled.groupBy(*CITY_DAY).agg(F.sum(one).alias("open_leads"))
        total = (F.coalesce("closed_leads", F.lit(0)) + F.coalesce("open_leads", F.lit(0))).cast("long")
        return latest.join(opened, CITY_DAY, "left").withColumn("total_leads_daily", total).select(*CITY_DAY, *C.CITY_DAILY_COLS)

    def feature_table(self, src, day: dt.date) -> DataFrame:
        """The 65 columns as of ``day``, leads and city days out of the state."""
        p = replace(self.p, as_of=day)
        plc = stage(self.raw_leads(day), "state-leads")
        leads = C.impute_prices(plc, distinct=False)
        return C.feature_table(src, p, leads=leads, daily=self.city_daily(day, plc))
