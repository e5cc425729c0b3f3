from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from types import SimpleNamespace

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="renewlens-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("renewlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", ck)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


SCHEMAS = {
    "packages": "city string, rank int, seller_uuid string, seller_name string, profile_type string, "
    "opportunity_id bigint, slot_ids array<string>, product_ids array<string>, "
    "min_start_datetime timestamp_ntz, max_end_datetime timestamp_ntz, opportunity_type string, "
    "ram_id string, account_owner_id string",
    "renewal_report": "opportunity_id bigint, renewal_window string, is_addon boolean",
    "profiles": "id bigint, profile_uuid string, user_id bigint, email string, city_bounding_box_uuids string",
    "profile_phones": "profile_id bigint, number string",
    "price_lines": "opportunity_id bigint, rate_price double, sales_price double",
    "lead_supply_users": "profile_uuid string, lead_id bigint, created_at timestamp_ntz",
    "lead_masters": "id bigint, service_object_id bigint, created_at timestamp_ntz, lead_generator string, "
    "lead_filler string, lead_type string, traffic_sourcemedium string",
    "flats": "id bigint, is_buy boolean, price string, region_bounding_box_id int, property_type_id int, "
    "apartment_type_id int",
    "user_flats": "flat_id bigint, user_flat_details string",
    "feature_types": "id int, name string",
    "property_types": "id int, name string",
    "apartment_types": "id int, display_name string",
    "tickets": "id bigint, category_id int, created_at timestamp_ntz",
    "ticket_attributes": "ticket_id bigint, attribute_value string",
    "ticket_categories": "id int, project_id int",
    "ticket_projects": "id int, name string",
    "crawled_listings": "mobile string, email string, listing_posted_date date, listing_id string",
}


def ts(day: str) -> dt.datetime:
    return dt.datetime.fromisoformat(day)


def d(day: str) -> dt.date:
    return dt.date.fromisoformat(day)


@pytest.fixture()
def make_src(spark):
    """Build a sources namespace from inline rows; unspecified tables are empty."""

    def build(**tables):
        ns = {}
        for name, schema in SCHEMAS.items():
            rows = tables.get(name, [])
            ns[name] = spark.createDataFrame(rows, schema)
        return SimpleNamespace(**ns)

    return build


def pkg(opp, seller="S1", start="2024-01-01", end="2024-05-01", city="Pune", profile="Broker", owner="O1",
        slots=("[1,2]",), rank=1):
    return (city, rank, seller, "name", profile, opp, list(slots) if slots is not None else None, ["p"],
            ts(start), ts(end), "new", "R1", owner)
