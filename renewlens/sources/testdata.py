"""The 17 logical source tables, derived from the driver's parquet tables.

The notebooks read operational tables (packages, renewal report, profiles,
price lines, leads, listings, tickets, crawled listings). The test data is a
TPC-H-like star schema, so each logical source is a projection of it; every
source is a lazy DataFrame that Spark derives from the given tables, so its
size grows with them. The same rules are written once more as DuckDB SQL in
``renewlens.oracle_sql`` for the correctness check.

Mapping (one line per logical table):

* packages        orders x customer x nation; package = order, seller = customer
* renewal_report  orders; status F -> renewed, P + 5-LOW -> add on
* profiles/phones customer; a second phone for every third customer
* price_lines     lineitem (1:N per package)
* lead_supply     lineitem x orders (seller of the lead)
* lead_masters    lineitem (listing = part, channel from the supplier key)
* flats/user_flats/feature_types/property_types/apartment_types  part, nation, region
* tickets/ticket_attributes/ticket categories/projects  events of type error, nation, region
* crawled listings  events of type view
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Events are dated 2024-01; shifting them back this many days puts them at the
# test tables' run date (1998-07-01), next to the packages they describe.
EVENT_SHIFT_DAYS = 9315


def _s(c: Column) -> Column:
    return c.cast("string")


class TestdataSources:
    """Logical sources over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- packages and renewal report -------------------------------------
    @cached_property
    def packages(self) -> DataFrame:
        o = self.table("orders")
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        # nation is the fixed 25-row TPC-H dimension: a proven size bound
        n = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))
        k = F.col("o_orderkey")
        dur = (F.lit(60) + (k * 37) % 400).cast("int")
        start = F.col("o_orderdate")
        end = F.date_add(F.to_date(start), dur).cast("timestamp_ntz")
        seg = F.col("c_mktsegment")
        slot_a = F.concat(F.lit("["), _s(k % 7), F.lit(","), _s(k % 5), F.lit("]"))
        slot_b = F.concat(F.lit("["), _s(k % 3), F.lit("]"))
        slots = (
            F.when(k % 11 == 0, F.lit(None).cast("array<string>"))
            .when(k % 13 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(slot_a, slot_b))
        )
        return (
            o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.when(F.col("c_nationkey") == 24, F.lit(None)).otherwise(F.col("n_name")).alias("city"),
                (k % 3 + 1).cast("int").alias("rank"),
                F.concat(F.lit("S"), _s(F.col("o_custkey"))).alias("seller_uuid"),
                F.col("c_name").alias("seller_name"),
                F.when(seg == "BUILDING", "Builder")
                .when(seg == "HOUSEHOLD", "Broker")
                .when(seg == "MACHINERY", "broker")
                .otherwise("Owner")
                .alias("profile_type"),
                k.alias("opportunity_id"),
                slots.alias("slot_ids"),
                F.array(_s(k % 4)).alias("product_ids"),
                start.alias("min_start_datetime"),
                end.alias("max_end_datetime"),
                F.when(k % 2 == 0, "new").otherwise("renewal").alias("opportunity_type"),
                F.concat(F.lit("R"), _s(F.col("o_custkey") % 40)).alias("ram_id"),
                F.concat(F.lit("O"), _s(k % 100)).alias("account_owner_id"),
            )
        )

    @cached_property
    def renewal_report(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.alias("opportunity_id"),
            F.when(k % 17 == 0, F.lit(None).cast("string"))
            .when(F.col("o_orderstatus") == "F", "45D Renewed")
            .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), "Add On")
            .otherwise("Not Renewed")
            .alias("renewal_window"),
            (F.col("o_orderpriority") == "5-LOW").alias("is_addon"),
        )

    # -- profiles ---------------------------------------------------------
    @cached_property
    def profiles(self) -> DataFrame:
        c = self.table("customer")
        ck = F.col("c_custkey")
        return c.select(
            ck.alias("id"),
            F.concat(F.lit("S"), _s(ck)).alias("profile_uuid"),
            (ck * 10).alias("user_id"),
            F.when(ck % 7 == 0, "x@y")
            .otherwise(F.concat(F.lit("seller"), _s(ck), F.lit("@mail.test")))
            .alias("email"),
            F.concat(F.lit("BB"), _s(F.col("c_nationkey"))).alias("city_bounding_box_uuids"),
        )

    @cached_property
    def profile_phones(self) -> DataFrame:
        c = self.table("customer").select("c_custkey")
        ck = F.col("c_custkey")
        first = c.select(ck.alias("profile_id"), _s(ck + 9000000000).alias("number"))
        second = c.filter(ck % 3 == 0).select(ck.alias("profile_id"), _s(ck + 8000000000).alias("number"))
        return first.unionByName(second)

    @cached_property
    def price_lines(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            F.col("l_orderkey").alias("opportunity_id"),
            F.floor(F.col("l_extendedprice")).cast("double").alias("rate_price"),
            F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double").alias("sales_price"),
        )

    # -- leads ------------------------------------------------------------
    @staticmethod
    def _lead_id() -> Column:
        return F.col("l_orderkey") * 10 + F.col("l_linenumber")

    @cached_property
    def lead_supply_users(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
        o = self.table("orders").select("o_orderkey", "o_custkey")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.concat(F.lit("S"), _s(F.col("o_custkey"))).alias("profile_uuid"),
            self._lead_id().alias("lead_id"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def lead_masters(self) -> DataFrame:
        li = self.table("lineitem")
        g = F.col("l_suppkey") % 11
        generator = (
            F.when(g == 0, "Shadow_Listing")
            .when(g == 1, "ContactRequest")
            .when(g == 2, "contactrequest")
            .when(g == 3, "CRM")
            .when(g == 4, "Facebook")
            .when(g == 5, "FB_Marketplace")
            .when(g == 6, "ivr")
            .when(g == 7, F.lit(None).cast("string"))
            .when(g == 8, "ImageContactRequest")
            .when(g == 9, "churn_recovery")
            .otherwise("Request_callback")
        )
        return li.select(
            self._lead_id().alias("id"),
            F.col("l_partkey").alias("service_object_id"),
            F.col("l_shipdate").alias("created_at"),
            generator.alias("lead_generator"),
            F.when(F.col("l_linenumber") % 2 == 0, "agent").otherwise("self").alias("lead_filler"),
            F.col("l_returnflag").alias("lead_type"),
            F.col("l_linestatus").alias("traffic_sourcemedium"),
        )

    # -- listings and their dimensions ------------------------------------
    @cached_property
    def flats(self) -> DataFrame:
        p = self.table("part")
        pk = F.col("p_partkey")
        return p.select(
            pk.alias("id"),
            (F.col("p_size") % 2 == 0).alias("is_buy"),
            _s(F.floor(F.col("p_retailprice") * 100)).alias("price"),
            (pk % 25).cast("int").alias("region_bounding_box_id"),
            (pk % 5).cast("int").alias("property_type_id"),
            (F.col("p_size") % 9).cast("int").alias("apartment_type_id"),
        )

    @cached_property
    def user_flats(self) -> DataFrame:
        p = self.table("part")
        pk = F.col("p_partkey")
        rent = F.when(pk % 9 == 0, F.lit('"n/a"')).otherwise(_s(F.floor(F.col("p_retailprice") * 10)))
        return p.filter(pk % 4 != 1).select(
            pk.alias("flat_id"),
            F.concat(F.lit('{"rent": '), rent, F.lit("}")).alias("user_flat_details"),
        )

    @cached_property
    def feature_types(self) -> DataFrame:
        n = self.table("nation")
        return n.filter(F.col("n_nationkey") != 24).select(
            F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
        )

    @cached_property
    def property_types(self) -> DataFrame:
        r = self.table("region")
        rk = F.col("r_regionkey")
        name = (
            F.when(rk == 0, "Independent House")
            .when(rk == 1, "Villa")
            .when(rk == 2, "Apartment")
            .when(rk == 3, "Independent Floor")
            .otherwise("Plot")
        )
        return r.select(rk.alias("id"), name.alias("name"))

    @cached_property
    def apartment_types(self) -> DataFrame:
        n = self.table("nation")
        nk = F.col("n_nationkey")
        name = (
            F.when(nk == 0, "1 RK")
            .when(nk == 1, "1 BHK")
            .when(nk == 2, "2 BHK")
            .when(nk == 3, "3 BHK")
            .when(nk == 4, "3+ BHK")
            .when(nk == 5, "4 BHK")
            .when(nk == 6, "Studio")
            .otherwise(F.lit(None).cast("string"))
        )
        return n.filter(nk < 8).select(nk.alias("id"), name.alias("display_name"))

    # -- support tickets --------------------------------------------------
    def _shifted(self, ts: Column) -> Column:
        return ts - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")

    @cached_property
    def tickets(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "error")
        return e.select(
            F.col("event_id").alias("id"),
            (F.col("event_id") % 6).cast("int").alias("category_id"),
            self._shifted(F.col("ts")).alias("created_at"),
        )

    @cached_property
    def ticket_attributes(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "error")
        u = F.col("user_id")
        return e.select(
            F.col("event_id").alias("ticket_id"),
            F.when(u % 2 == 0, F.concat(F.lit("s"), _s(u))).otherwise(F.concat(F.lit("S"), _s(u))).alias(
                "attribute_value"
            ),
        )

    @cached_property
    def ticket_categories(self) -> DataFrame:
        n = self.table("nation")
        nk = F.col("n_nationkey")
        return n.filter(nk < 6).select(
            nk.alias("id"), F.when(nk.isin(0, 2, 3), 18).otherwise(7).alias("project_id")
        )

    @cached_property
    def ticket_projects(self) -> DataFrame:
        r = self.table("region")
        rk = F.col("r_regionkey")
        pid = F.when(rk == 0, 18).otherwise(rk)
        return r.select(pid.alias("id"), F.concat(F.lit("project_"), _s(pid)).alias("name"))

    # -- crawled competitor listings --------------------------------------
    @cached_property
    def crawled_listings(self) -> DataFrame:
        e = self.table("events").filter(F.col("event_type") == "view")
        u = F.col("user_id")
        eid = F.col("event_id")
        mobile = F.when(eid % 4 == 3, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit(" +91"), _s(u + 9000000000), F.lit(" "))
        )
        email = F.concat(F.lit(" SELLER"), _s(u + eid % 3), F.lit("@MAIL.TEST "))
        return e.select(
            mobile.alias("mobile"),
            email.alias("email"),
            F.to_date(self._shifted(F.col("ts"))).alias("listing_posted_date"),
            F.concat(F.lit("L"), _s(eid % 500)).alias("listing_id"),
        )
