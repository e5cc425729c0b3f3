"""DuckDB reference SQL for the correctness check.

The logical sources are the same mapping as ``renewlens.sources.testdata``
written as CTEs over the driver's views. The feature CTEs are written from the
filtered distinct count for each measure, lateral counts over a package's
window, medians for each city and cut-off. Model weights and the search
configuration are restated, so the code under test does not supply them.
Column names are lower case everywhere; integer sums are cast to BIGINT
(DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

from renewlens import params as P

FP = P.FeatureParams()
AS_OF = f"DATE '{FP.as_of.isoformat()}'"

SOURCES = r"""
packages AS (
  SELECT
    CASE WHEN c.c_nationkey = 24 THEN NULL ELSE n.n_name END AS city,
    CAST(o.o_orderkey % 3 + 1 AS INTEGER) AS rank,
    'S' || CAST(o.o_custkey AS VARCHAR) AS seller_uuid,
    c.c_name AS seller_name,
    CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'Builder'
         WHEN c.c_mktsegment = 'HOUSEHOLD' THEN 'Broker'
         WHEN c.c_mktsegment = 'MACHINERY' THEN 'broker' ELSE 'Owner' END AS profile_type,
    o.o_orderkey AS opportunity_id,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
         WHEN o.o_orderkey % 13 = 0 THEN CAST([] AS VARCHAR[])
         ELSE ['[' || CAST(o.o_orderkey % 7 AS VARCHAR) || ',' || CAST(o.o_orderkey % 5 AS VARCHAR) || ']',
               '[' || CAST(o.o_orderkey % 3 AS VARCHAR) || ']'] END AS slot_ids,
    [CAST(o.o_orderkey % 4 AS VARCHAR)] AS product_ids,
    o.o_orderdate AS min_start_datetime,
    CAST(CAST(o.o_orderdate AS DATE) + CAST(60 + (o.o_orderkey * 37) % 400 AS INTEGER) AS TIMESTAMP) AS max_end_datetime,
    CASE WHEN o.o_orderkey % 2 = 0 THEN 'new' ELSE 'renewal' END AS opportunity_type,
    'R' || CAST(o.o_custkey % 40 AS VARCHAR) AS ram_id,
    'O' || CAST(o.o_orderkey % 100 AS VARCHAR) AS account_owner_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
renewal_report AS (
  SELECT o_orderkey AS opportunity_id,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL
         WHEN o_orderstatus = 'F' THEN '45D Renewed'
         WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Add On'
         ELSE 'Not Renewed' END AS renewal_window,
    o_orderpriority = '5-LOW' AS is_addon
  FROM orders
),
profiles AS (
  SELECT c_custkey AS id, 'S' || CAST(c_custkey AS VARCHAR) AS profile_uuid, c_custkey * 10 AS user_id,
    CASE WHEN c_custkey % 7 = 0 THEN 'x@y' ELSE 'seller' || CAST(c_custkey AS VARCHAR) || '@mail.test' END AS email,
    'BB' || CAST(c_nationkey AS VARCHAR) AS city_bounding_box_uuids
  FROM customer
),
profile_phones AS (
  SELECT c_custkey AS profile_id, CAST(c_custkey + 9000000000 AS VARCHAR) AS number FROM customer
  UNION ALL
  SELECT c_custkey AS profile_id, CAST(c_custkey + 8000000000 AS VARCHAR) AS number FROM customer WHERE c_custkey % 3 = 0
),
price_lines AS (
  SELECT l_orderkey AS opportunity_id, CAST(floor(l_extendedprice) AS DOUBLE) AS rate_price,
    CAST(floor(l_extendedprice * (1 - l_discount)) AS DOUBLE) AS sales_price
  FROM lineitem
),
lead_supply_users AS (
  SELECT 'S' || CAST(o.o_custkey AS VARCHAR) AS profile_uuid, l.l_orderkey * 10 + l.l_linenumber AS lead_id,
    l.l_shipdate AS created_at
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
lead_masters AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS service_object_id, l_shipdate AS created_at,
    CASE l_suppkey % 11 WHEN 0 THEN 'Shadow_Listing' WHEN 1 THEN 'ContactRequest' WHEN 2 THEN 'contactrequest'
      WHEN 3 THEN 'CRM' WHEN 4 THEN 'Facebook' WHEN 5 THEN 'FB_Marketplace' WHEN 6 THEN 'ivr' WHEN 7 THEN NULL
      WHEN 8 THEN 'ImageContactRequest' WHEN 9 THEN 'churn_recovery' ELSE 'Request_callback' END AS lead_generator,
    CASE WHEN l_linenumber % 2 = 0 THEN 'agent' ELSE 'self' END AS lead_filler,
    l_returnflag AS lead_type, l_linestatus AS traffic_sourcemedium
  FROM lineitem
),
flats AS (
  SELECT p_partkey AS id, p_size % 2 = 0 AS is_buy,
    CAST(CAST(floor(p_retailprice * 100) AS BIGINT) AS VARCHAR) AS price,
    CAST(p_partkey % 25 AS INTEGER) AS region_bounding_box_id,
    CAST(p_partkey % 5 AS INTEGER) AS property_type_id,
    CAST(p_size % 9 AS INTEGER) AS apartment_type_id
  FROM part
),
user_flats AS (
  SELECT p_partkey AS flat_id,
    '{"rent": ' || CASE WHEN p_partkey % 9 = 0 THEN '"n/a"'
                        ELSE CAST(CAST(floor(p_retailprice * 10) AS BIGINT) AS VARCHAR) END || '}' AS user_flat_details
  FROM part WHERE p_partkey % 4 <> 1
),
feature_types AS (SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey <> 24),
property_types AS (
  SELECT r_regionkey AS id,
    CASE r_regionkey WHEN 0 THEN 'Independent House' WHEN 1 THEN 'Villa' WHEN 2 THEN 'Apartment'
      WHEN 3 THEN 'Independent Floor' ELSE 'Plot' END AS name
  FROM region
),
apartment_types AS (
  SELECT n_nationkey AS id,
    CASE n_nationkey WHEN 0 THEN '1 RK' WHEN 1 THEN '1 BHK' WHEN 2 THEN '2 BHK' WHEN 3 THEN '3 BHK'
      WHEN 4 THEN '3+ BHK' WHEN 5 THEN '4 BHK' WHEN 6 THEN 'Studio' ELSE NULL END AS display_name
  FROM nation WHERE n_nationkey < 8
),
tickets AS (
  SELECT event_id AS id, CAST(event_id % 6 AS INTEGER) AS category_id, ts - INTERVAL 9315 DAY AS created_at
  FROM events WHERE event_type = 'error'
),
ticket_attributes AS (
  SELECT event_id AS ticket_id,
    CASE WHEN user_id % 2 = 0 THEN 's' ELSE 'S' END || CAST(user_id AS VARCHAR) AS attribute_value
  FROM events WHERE event_type = 'error'
),
ticket_categories AS (
  SELECT n_nationkey AS id, CASE WHEN n_nationkey IN (0, 2, 3) THEN 18 ELSE 7 END AS project_id
  FROM nation WHERE n_nationkey < 6
),
ticket_projects AS (
  SELECT CASE WHEN r_regionkey = 0 THEN 18 ELSE r_regionkey END AS id,
    'project_' || CAST(CASE WHEN r_regionkey = 0 THEN 18 ELSE r_regionkey END AS VARCHAR) AS name
  FROM region
),
crawled_listings AS (
  SELECT CASE WHEN event_id % 4 = 3 THEN NULL ELSE ' +91' || CAST(user_id + 9000000000 AS VARCHAR) || ' ' END AS mobile,
    ' SELLER' || CAST(user_id + event_id % 3 AS VARCHAR) || '@MAIL.TEST ' AS email,
    CAST(ts - INTERVAL 9315 DAY AS DATE) AS listing_posted_date,
    'L' || CAST(event_id % 500 AS VARCHAR) AS listing_id
  FROM events WHERE event_type = 'view'
)"""


# -- packages with their spans ------------------------------------------------
SPANS = """
spans AS (
  SELECT p.*, CAST(min_start_datetime AS DATE) AS starts, CAST(max_end_datetime AS DATE) AS ends,
    date_diff('day', CAST(min_start_datetime AS DATE), CAST(max_end_datetime AS DATE)) AS days,
    r.renewal_window, r.is_addon, r.opportunity_id IS NOT NULL AS reported
  FROM packages p LEFT JOIN renewal_report r USING (opportunity_id)
)"""


def _base_cte(backup: bool = False, ended: bool = False) -> str:
    p = FP.backup() if backup else FP.training() if ended else FP
    first = f"{AS_OF} - {p.lookback_days}"
    measured = f"quarter_end > {first} AND quarter_end <= {AS_OF}" if p.cutoff_upper_bound else f"quarter_end >= {first}"
    return f"""{SPANS},
line_totals AS (
  SELECT opportunity_id, sum(rate_price) AS rate, sum(sales_price) AS sales FROM price_lines GROUP BY 1
),
base_rows AS (
  SELECT s.* EXCLUDE (min_start_datetime, max_end_datetime, starts, ends, days, renewal_window, reported, quarter, quarter_end),
    u.user_id, u.email, u.city_bounding_box_uuids, h.number AS phone_number,
    starts AS package_start_date, ends AS package_end_date, quarter_end AS onefourth_cutoff_date,
    CAST(days AS INTEGER) AS package_duration, CAST(quarter AS BIGINT) AS package_duration_onefourth,
    CAST(year(ends) AS INTEGER) AS renewal_due_year, CAST(month(ends) AS INTEGER) AS renewal_due_month,
    sum(l.rate) AS rate_price, sum(l.sales) AS sales_price
  FROM (SELECT *, days // 4 AS quarter, starts + CAST(days // 4 AS INTEGER) AS quarter_end FROM spans
        WHERE days >= 90 AND ends {'<' if ended else '>='} {AS_OF}) s
  JOIN profiles u ON u.profile_uuid = s.seller_uuid
  JOIN profile_phones h ON h.profile_id = u.id
  LEFT JOIN line_totals l USING (opportunity_id)
  WHERE {measured} AND lower(profile_type) IN ('broker', 'builder') AND lower(renewal_window) <> 'add on'
  GROUP BY ALL
)"""


BASE_COLS = (
    "city, rank, seller_uuid, user_id, email, phone_number, city_bounding_box_uuids, seller_name, profile_type, "
    "opportunity_id, package_start_date, package_end_date, package_duration_onefourth, onefourth_cutoff_date, "
    "package_duration, opportunity_type, ram_id, account_owner_id, renewal_due_year, renewal_due_month, "
    "rate_price, sales_price, is_addon"
)

# -- C2 listings and leads ------------------------------------------------------
LISTINGS = """
bedroom_bucket(display_name, bhk_type) AS (
  VALUES ('1 RK', '1RK/1BHK'), ('1 BHK', '1RK/1BHK'), ('2 BHK', '2 BHK'), ('3 BHK', '3 BHK'), ('3+ BHK', '3+ BHK')
),
property_bucket(name, property_type) AS (
  VALUES ('Independent House', 'Independent House/Villa'), ('Villa', 'Independent House/Villa'),
    ('Apartment', 'Apartment'), ('Independent Floor', 'Independent Floor')
),
listing_dim AS (
  SELECT f.id AS listing_id, place.name AS city, coalesce(bb.bhk_type, 'Others') AS bhk_type,
    coalesce(pb.property_type, 'Others') AS property_type,
    max(TRY_CAST(if(f.is_buy, CAST(f.price AS VARCHAR), json_extract_string(uf.user_flat_details, '$.rent')) AS INTEGER)) AS listing_price
  FROM flats f
  LEFT JOIN user_flats uf ON uf.flat_id = f.id
  LEFT JOIN feature_types place ON place.id = f.region_bounding_box_id
  LEFT JOIN (property_types kind LEFT JOIN property_bucket pb ON pb.name = kind.name) ON kind.id = f.property_type_id
  LEFT JOIN (apartment_types rooms LEFT JOIN bedroom_bucket bb ON bb.display_name = rooms.display_name) ON rooms.id = f.apartment_type_id
  GROUP BY ALL
)"""


def _lead_ctes(history_days: int = FP.lead_history_days) -> str:
    recent = f"BETWEEN {AS_OF} - {history_days} AND {AS_OF}"
    return f"""{LISTINGS},
seller_leads AS (
  SELECT DISTINCT d.* EXCLUDE (listing_id), s.profile_uuid AS seller_uuid, m.service_object_id AS listing_id, s.lead_id,
    CAST(m.created_at AS DATE) AS lead_date, m.lead_generator, m.lead_filler, m.lead_type, m.traffic_sourcemedium
  FROM lead_supply_users s
  JOIN lead_masters m ON m.id = s.lead_id AND m.created_at {recent}
  LEFT JOIN listing_dim d ON d.listing_id = m.service_object_id
  WHERE s.created_at {recent}
),
lead_base AS (
  SELECT DISTINCT city, seller_uuid, listing_id, property_type, bhk_type, lead_id, lead_date, lead_filler, lead_generator,
    CAST(coalesce(listing_price, (SELECT median(o.listing_price) FROM seller_leads o WHERE o.seller_uuid = l.seller_uuid)) AS DOUBLE) AS listing_price,
    CASE WHEN regexp_matches(lower(lead_generator), 'churn|shadow') THEN 'churn/shadow'
         WHEN lead_generator IN ('ImageContactRequest', 'ContactRequest', 'Request_callback') THEN 'CR/ImageCR/ReCallback'
         WHEN lower(lead_generator) = 'crm' THEN 'crm'
         WHEN lower(lead_generator) = 'facebook' THEN 'facebook/FB_Marketplace'  -- 'FB_Marketplace' is never reached
         ELSE 'others' END AS lead_generator_new,
    traffic_sourcemedium
  FROM seller_leads l
  WHERE city IS NOT NULL AND listing_id IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    kw = "WITH RECURSIVE " if any("greedy(" in c for c in ctes) else "WITH "
    return kw + ",".join([SOURCES, *ctes]) + "\n"


# -- C3 slots: the comma-separated tokens of all of a package's slot strings ---------
SLOTS_CTE = r"""
slots AS (
  SELECT seller_uuid, opportunity_id, CAST(min_start_datetime AS DATE) AS package_start_date,
    CAST(max_end_datetime AS DATE) AS package_end_date, count(DISTINCT token) AS count_slots_pkg
  FROM packages, unnest(string_split(translate(array_to_string(slot_ids, ','), '[]', ''), ',')) AS t(token)
  WHERE seller_uuid IS NOT NULL AND opportunity_id IS NOT NULL
  GROUP BY ALL
)"""


# -- C4 prior packages: how many of the seller's packages lie in a package's window ------
def _prior_cte(smoothing: int = FP.prior_smoothing) -> str:
    return f"""
history AS (
  SELECT DISTINCT seller_uuid, opportunity_id, starts, ends, renewal_window = '45D Renewed' AS renewed
  FROM spans WHERE lower(renewal_window) <> 'add on'
),
prior AS (
  SELECT b.*, {smoothing} + h.n AS seller_tot_packages_previous, {smoothing} + h.n_renewed AS seller_tot_renewal_previous
  FROM (SELECT DISTINCT city, seller_uuid, opportunity_id, package_start_date, package_end_date FROM base_rows WHERE city IS NOT NULL) b,
    LATERAL (SELECT count(*) AS n, count(*) FILTER (renewed) AS n_renewed FROM history
             WHERE seller_uuid = b.seller_uuid AND starts < b.package_end_date - 30 AND ends >= b.package_start_date - 1500) h
)"""


# The same for ended packages: those whose end lay before the package's cut-off.
PRIOR_ENDED_CTE = f"""
prior AS (
  SELECT b.* EXCLUDE (cut), {FP.prior_smoothing} + h.n AS seller_tot_packages_previous, {FP.prior_smoothing} + h.n_renewed AS seller_tot_renewal_previous
  FROM (SELECT DISTINCT city, seller_uuid, opportunity_id, package_start_date, package_end_date, onefourth_cutoff_date AS cut
        FROM base_rows WHERE city IS NOT NULL) b,
    LATERAL (SELECT count(*) AS n, count(*) FILTER (renewal_window = '45D Renewed') AS n_renewed
             FROM (SELECT DISTINCT seller_uuid, opportunity_id, starts, ends, renewal_window FROM spans WHERE lower(renewal_window) <> 'add on')
             WHERE seller_uuid = b.seller_uuid AND ends < b.cut AND ends >= b.package_start_date - 1500) h
)"""


# -- C5 leads of the first quarter ---------------------------------------------------
# Each measure counts its own distinct tuple of lead columns. Fixed values:
# category labels and the output columns they belong to.
_BEDROOMS = {"1RK/1BHK": "1rk1bhk", "2 BHK": "2bhk", "3 BHK": "3bhk", "3+ BHK": "3plusbhk"}
_CHANNELS = {
    "churn/shadow": "churn_shadow", "CR/ImageCR/ReCallback": "cr_imagecr_recallback", "call/ivr": "call_ivr",
    "crm": "crm", "facebook/FB_Marketplace": "fb_fbm", "others": "other_channel",
}
_PROPERTIES = {"Independent House/Villa": "independenthousevilla", "Apartment": "apartment", "Independent Floor": "independent_floor"}


def _split_count(what: str, by: str, columns: dict[str, str]) -> list[str]:
    """Distinct ``what`` per value of ``by``: label -> output column."""
    return [f"count(DISTINCT {what}) FILTER ({by} = '{label}') AS {name}" for label, name in columns.items()]


def _named(prefix: str, labels: dict[str, str], suffix: str, **others: str) -> dict[str, str]:
    return {k: f"{prefix}{v}{suffix}" for k, v in labels.items()} | {k.capitalize(): v for k, v in others.items()}


_Q = "_25pctduration"
_LISTING_BHK = _named("listings_", _BEDROOMS, _Q, others=f"listings_otherbhktype{_Q}")
_LEAD_BHK = _named("leads_", _BEDROOMS, _Q, others=f"leads_others{_Q}")
_LISTING_KIND = _named("listings_", _PROPERTIES, _Q, others=f"listings_otherpropertytype{_Q}")
_LEAD_KIND = _named("leads_", _PROPERTIES, _Q, others=f"leads_other_property_type{_Q}")
_LEAD_CHANNEL = _named("", _CHANNELS, f"_leads{_Q}")
_QUARTER_MEASURES = [
    f"count(DISTINCT (listing_id, listing_price, property_type, lead_id, lead_generator_new)) FILTER (lead_id IS NOT NULL) AS total_leads{_Q}",
    f"count(DISTINCT listing_id) AS tot_listings{_Q}",
    *_split_count("listing_id", "property_type", _LISTING_KIND),
    *_split_count("(listing_id, lead_generator_new, lead_id)", "property_type", _LEAD_KIND),
    *_split_count("listing_id", "bhk_type", _LISTING_BHK),
    *_split_count("(listing_id, lead_generator_new, lead_id)", "bhk_type", _LEAD_BHK),
    *_split_count("(listing_id, property_type, lead_id)", "lead_generator_new", _LEAD_CHANNEL),
]

LEAD_FEATURE_CTE = f"""
quarter_leads AS (
  SELECT b.city AS package_city, b.opportunity_id, l.*
  FROM base_rows b JOIN lead_base l
    ON l.seller_uuid = b.seller_uuid AND l.lead_date BETWEEN b.package_start_date AND b.onefourth_cutoff_date
),
quarter_counts AS (
  SELECT seller_uuid, opportunity_id, {', '.join(_QUARTER_MEASURES)}
  FROM quarter_leads GROUP BY 1, 2
),
quarter_prices AS (
  SELECT seller_uuid, opportunity_id, sum(listing_price) AS tot_listing_price{_Q}
  FROM (SELECT DISTINCT seller_uuid, opportunity_id, listing_id, listing_price, property_type FROM quarter_leads)
  GROUP BY 1, 2
),
lead_features AS (
  SELECT city, seller_uuid, opportunity_id,
    coalesce(COLUMNS(c.* EXCLUDE (seller_uuid, opportunity_id)), 0), coalesce(tot_listing_price{_Q}, 0) AS tot_listing_price{_Q}
  FROM (SELECT DISTINCT city, seller_uuid, opportunity_id FROM base_rows)
  LEFT JOIN quarter_counts c USING (seller_uuid, opportunity_id)
  LEFT JOIN quarter_prices USING (seller_uuid, opportunity_id)
)"""


# -- C6 city month: a package weighs as many rows as it has price lines (at least one) ------
CITY_MONTH_CTE = f"""
city_month AS (
  SELECT city, renewal_due_month, n AS total_opportunities_citylevel_monthly, n_renewed AS tot_renewed_opportunities_citylevel_monthly,
    round(n_renewed * 100 / n, 2) AS renewal_pct_citylevel_monthly
  FROM (
    SELECT p.city, CAST(month(max_end_datetime) AS INTEGER) AS renewal_due_month, CAST(sum(weight) AS BIGINT) AS n,
      CAST(coalesce(sum(weight) FILTER (r.renewal_window = '45D Renewed'), 0) AS BIGINT) AS n_renewed
    FROM packages p
    JOIN renewal_report r USING (opportunity_id),
      LATERAL (SELECT greatest(count(*), 1) AS weight FROM price_lines WHERE opportunity_id = p.opportunity_id) w
    WHERE p.city IS NOT NULL AND lower(profile_type) IN ('broker', 'builder') AND year(max_end_datetime) >= {FP.city_since_year}
    GROUP BY ALL
  )
)"""


# The same for ended packages, by cut-off: same calendar month, ended before it.
CITY_CUTOFF_CTE = f"""
city_month AS (
  SELECT b.city, b.cut, CAST(coalesce(sum(weight), 0) AS BIGINT) AS total_opportunities_citylevel_monthly,
    CAST(coalesce(sum(weight) FILTER (e.renewal_window = '45D Renewed'), 0) AS BIGINT) AS tot_renewed_opportunities_citylevel_monthly,
    round(tot_renewed_opportunities_citylevel_monthly * 100 / nullif(total_opportunities_citylevel_monthly, 0), 2) AS renewal_pct_citylevel_monthly
  FROM (SELECT DISTINCT city, onefourth_cutoff_date AS cut FROM base_rows) b
  LEFT JOIN (SELECT s.city, s.ends, s.renewal_window, greatest((SELECT count(*) FROM price_lines l WHERE l.opportunity_id = s.opportunity_id), 1) AS weight
             FROM spans s WHERE reported AND lower(profile_type) IN ('broker', 'builder') AND year(ends) >= {FP.city_since_year}) e
    ON e.city = b.city AND month(e.ends) = month(b.cut) AND e.ends < b.cut
  GROUP BY b.city, b.cut
)"""


# -- C7 / C8 city activity ----------------------------------------------------------
_CITY_LISTINGS = _named("listings_", _BEDROOMS, "_city_daily", others="listings_bhk_others_city_daily")
_CITY_LEADS = _named("leads_", _BEDROOMS, "_city_daily", others="leads_bhk_others_city_daily")
CITY_DAILY_CTE = f"""
city_daily AS (
  SELECT city, lead_date, count(DISTINCT seller_uuid) AS active_sellers_daily, count(DISTINCT listing_id) AS tot_listings_daily,
    count(DISTINCT (listing_id, listing_price, property_type, lead_id, lead_generator_new)) FILTER (lead_id IS NOT NULL) AS total_leads_daily,
    {', '.join(_split_count("listing_id", "bhk_type", _CITY_LISTINGS))},
    {', '.join(_split_count("(listing_id, lead_generator_new, lead_id)", "bhk_type", _CITY_LEADS))}
  FROM lead_base
  GROUP BY city, lead_date
)"""

# medians: output column -> daily value
_CITY_MEDIANS = {
    "active_sellers": "active_sellers_daily", "tot_listings": "tot_listings_daily", "total_leads": "total_leads_daily",
    "leads_per_seller": "round(if(active_sellers_daily = 0, 0, total_leads_daily * 100 / active_sellers_daily), 2)",
    "listings_per_seller": "round(if(active_sellers_daily = 0, 0, tot_listings_daily * 100 / active_sellers_daily), 2)",
    "leads_per_listings": "round(if(tot_listings_daily = 0, 0, total_leads_daily * 100 / tot_listings_daily), 2)",
    **{f"{what}_{size}": f"{what}_{size}_city_daily" for what in ("listings", "leads") for size in ("1rk1bhk", "2bhk", "3bhk", "bhk_others")},
}
CITY_MEDIAN_CTE = f"""
cutoff_medians AS (
  SELECT c.city, c.onefourth_cutoff_date,
    {', '.join(f"round(median({daily}), 0) AS {name}_city_median" for name, daily in _CITY_MEDIANS.items())}
  FROM (SELECT DISTINCT city, onefourth_cutoff_date FROM base_rows) c
  JOIN city_daily d ON d.city = c.city
    AND d.lead_date BETWEEN c.onefourth_cutoff_date - {FP.city_history_days} AND c.onefourth_cutoff_date
  GROUP BY ALL
),
city_medians AS (
  SELECT DISTINCT b.city, b.seller_uuid, b.opportunity_id, coalesce(COLUMNS(m.* EXCLUDE (city, onefourth_cutoff_date)), 0)
  FROM base_rows b LEFT JOIN cutoff_medians m ON m.city = b.city AND m.onefourth_cutoff_date = b.onefourth_cutoff_date
)"""


# -- C9 tickets ---------------------------------------------------------------------
TICKET_CTE = f"""
ticket_counts AS (
  SELECT b.city, b.seller_uuid, b.opportunity_id, count(DISTINCT t.ticket_id) AS lead_delivery_ticket_storm{_Q}
  FROM base_rows b
  LEFT JOIN (
    SELECT a.ticket_id, lower(a.attribute_value) AS seller, CAST(k.created_at AS DATE) AS day
    FROM ticket_attributes a JOIN tickets k ON k.id = a.ticket_id
    WHERE k.category_id IN (SELECT id FROM ticket_categories WHERE project_id = {FP.ticket_project_id})
  ) t ON t.seller = lower(b.seller_uuid) AND t.day BETWEEN b.package_start_date - {FP.ticket_lead_days} AND b.onefourth_cutoff_date
  GROUP BY 1, 2, 3
)"""


# -- C10 owner: reported packages of the owner that ended in the year before the cut-off ------
OWNER_CTE = f"""
owner_exp AS (
  SELECT DISTINCT b.account_owner_id, b.opportunity_id, nullif(w.n, 0) AS cnt_1year_oppor_accowner{_Q},
    w.n_renewed AS cnt_1year_oppor_renewal_accowner{_Q}, round(w.n_renewed * 100 / nullif(w.n, 0), 2) AS renewal_pct_accowner_1year{_Q}
  FROM base_rows b,
    LATERAL (SELECT count(DISTINCT s.opportunity_id) AS n,
               CAST(sum(CAST(s.renewal_window IS NOT DISTINCT FROM '45D Renewed' AS INTEGER)) AS BIGINT) AS n_renewed
             FROM spans s
             WHERE s.reported AND s.account_owner_id = b.account_owner_id
               AND s.ends BETWEEN b.onefourth_cutoff_date - {FP.owner_history_days} AND b.onefourth_cutoff_date) w
)"""


# -- C11 competitors: by phone or by e-mail; a short e-mail counts only with a known phone ------
COMPETITOR_CTE = f"""
sightings AS (
  SELECT listing_id, listing_posted_date AS day, right(trim(mobile), 10) AS phone, lower(trim(email)) AS mail FROM crawled_listings
),
contacts AS (
  SELECT city, seller_uuid, opportunity_id, CAST(phone_number AS VARCHAR) AS phone, lower(trim(email)) AS mail, length(email) > 5 AS long_mail,
    package_start_date - {FP.competitor_lead_days} AS first_day, onefourth_cutoff_date AS last_day
  FROM base_rows
),
matched AS (
  SELECT c.seller_uuid, c.opportunity_id, s.day, s.listing_id
  FROM contacts c JOIN sightings s ON s.phone = c.phone AND s.day BETWEEN c.first_day AND c.last_day
  UNION
  SELECT c.seller_uuid, c.opportunity_id, s.day, s.listing_id
  FROM contacts c JOIN sightings s ON s.mail = c.mail AND s.day BETWEEN c.first_day AND c.last_day
  WHERE EXISTS (FROM contacts k WHERE k.long_mail AND k.mail = s.mail) OR EXISTS (FROM contacts k WHERE k.phone = s.phone)
),
competitors AS (
  SELECT DISTINCT c.city, c.seller_uuid, c.opportunity_id, coalesce(n, 0) AS cnt_listing_other_platforms{_Q}
  FROM contacts c
  LEFT JOIN (SELECT seller_uuid, opportunity_id, count(listing_id) AS n FROM matched GROUP BY 1, 2) USING (seller_uuid, opportunity_id)
)"""


# -- C12 feature table: output column -> value over the joined builders, in table order ------
_PLAIN = {
    "city_months": ["total_opportunities_citylevel_monthly", "tot_renewed_opportunities_citylevel_monthly", "renewal_pct_citylevel_monthly"],
    "medians": [f"{name}_city_median" for name in _CITY_MEDIANS],
    "prior": ["seller_tot_packages_previous", "seller_tot_renewal_previous"],
    "totals": [f"total_leads{_Q}", f"tot_listings{_Q}", f"tot_listing_price{_Q}"],
    "splits": [*_LISTING_BHK.values(), *_LEAD_BHK.values(), *_LEAD_CHANNEL.values()],
    "outside": [f"cnt_listing_other_platforms{_Q}", f"lead_delivery_ticket_storm{_Q}", f"cnt_1year_oppor_accowner{_Q}",
                f"cnt_1year_oppor_renewal_accowner{_Q}", f"renewal_pct_accowner_1year{_Q}"],
}


def _ratio(top: str, bottom: str) -> str:
    return f"round({top} / nullif({bottom}, 0))"


_VALUES: dict[str, str] = {
    **{c: c for c in _PLAIN["city_months"] + _PLAIN["medians"] + _PLAIN["prior"]},
    "seller_previous_renewal_pct": "round(seller_tot_renewal_previous / nullif(seller_tot_packages_previous, 0) * 100, 2)",
    "rate_price": "rate_price", "sales_price": "sales_price",
    "package_discount_pct": "round((rate_price - sales_price) * 100 / nullif(rate_price, 0), 1)",
    "ratio_sales_price_slots": _ratio("sales_price", "count_slots_pkg"),
    "count_slots_pkg": "count_slots_pkg",
    **{c: c for c in _PLAIN["totals"]},
    f"ratio_listings_slots{_Q}": _ratio(f"tot_listings{_Q}", "count_slots_pkg"),
    f"ratio_leads_slots{_Q}": _ratio(f"total_leads{_Q}", "count_slots_pkg"),
    f"ratio_listing_price_salesprice{_Q}": _ratio(f"tot_listing_price{_Q}", "sales_price"),
    f"ratio_listings_pkg_duration{_Q}": _ratio(f"tot_listings{_Q}", "package_duration_onefourth"),
    f"ratio_leads_pkg_duration{_Q}": _ratio(f"total_leads{_Q}", "package_duration_onefourth"),
    **{c: c for c in _PLAIN["splits"] + _PLAIN["outside"]},
}
_DOUBLES = {c for c in _VALUES if c.startswith(("ratio_", "rate_", "sales_")) or "pct_" in c or c.endswith(("_pct", "_city_median"))} | {
    f"tot_listing_price{_Q}"
}
_IDENTITY = (
    "city, seller_uuid, profile_type, opportunity_id, package_start_date, onefourth_cutoff_date, package_end_date, "
    "renewal_due_year, renewal_due_month, package_duration"
)


def features_latest_ctes(ended: bool = False) -> list[str]:
    """All CTEs up to ``features_latest`` (the 65-column table); for ended
    packages, as of their own cut-off."""
    months = "city_month" if ended else "(SELECT * RENAME (renewal_due_month AS cut_month) FROM city_month)"
    on_month = "m.cut = b.onefourth_cutoff_date" if ended else "m.cut_month = month(b.onefourth_cutoff_date)"
    typed = ",\n    ".join(
        f"CAST(coalesce({value}, 0) AS {'DOUBLE' if name in _DOUBLES else 'BIGINT'}) AS {name}" for name, value in _VALUES.items())
    final = f"""
joined AS (
  SELECT * FROM (FROM base_rows WHERE city IS NOT NULL) b
  LEFT JOIN {months} m ON m.city = b.city AND {on_month}
  LEFT JOIN (SELECT * EXCLUDE (city) FROM city_medians) USING (seller_uuid, opportunity_id)
  LEFT JOIN (SELECT seller_uuid, opportunity_id, count_slots_pkg FROM slots) USING (seller_uuid, opportunity_id)
  LEFT JOIN (SELECT * EXCLUDE (city, package_start_date, package_end_date) FROM prior) USING (seller_uuid, opportunity_id)
  LEFT JOIN (SELECT * EXCLUDE (city) FROM lead_features) USING (seller_uuid, opportunity_id)
  LEFT JOIN (SELECT * EXCLUDE (city) FROM competitors) USING (seller_uuid, opportunity_id)
  LEFT JOIN (SELECT * EXCLUDE (city) FROM ticket_counts) USING (seller_uuid, opportunity_id)
  LEFT JOIN owner_exp USING (account_owner_id, opportunity_id)
),
features_latest AS (
  SELECT DISTINCT {AS_OF} AS feature_creation_date, {_IDENTITY.replace("city,", "b.city,", 1)},
    {typed}
  FROM (SELECT * EXCLUDE (city_1) FROM joined) b
)"""
    return [
        _base_cte(ended=ended), _lead_ctes(), SLOTS_CTE, PRIOR_ENDED_CTE if ended else _prior_cte(), LEAD_FEATURE_CTE,
        CITY_CUTOFF_CTE if ended else CITY_MONTH_CTE,
        CITY_DAILY_CTE, CITY_MEDIAN_CTE, TICKET_CTE, OWNER_CTE, COMPETITOR_CTE, final,
    ]


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["package_base"] = _with(_base_cte()) + f"SELECT {BASE_COLS} FROM base_rows"
    q["package_base_recent"] = _with(_base_cte(backup=True)) + f"SELECT {BASE_COLS} FROM base_rows"
    q["lead_base"] = _with(_lead_ctes()) + "SELECT * FROM lead_base"
    q["slots_per_package"] = _with(SLOTS_CTE) + "SELECT * FROM slots"
    q["prior_packages"] = _with(_base_cte(), _prior_cte()) + "SELECT * FROM prior"
    q["lead_features"] = _with(_base_cte(), _lead_ctes(), LEAD_FEATURE_CTE) + "SELECT * FROM lead_features"
    q["city_month_renewal"] = _with(CITY_MONTH_CTE) + "SELECT * FROM city_month"
    q["city_daily_activity"] = _with(_lead_ctes(), CITY_DAILY_CTE) + "SELECT * FROM city_daily"
    q["city_median_activity"] = (
        _with(_base_cte(), _lead_ctes(), CITY_DAILY_CTE, CITY_MEDIAN_CTE) + "SELECT * FROM city_medians"
    )
    q["ticket_counts"] = _with(_base_cte(), TICKET_CTE) + "SELECT * FROM ticket_counts"
    q["owner_experience"] = _with(_base_cte(), OWNER_CTE) + "SELECT * FROM owner_exp"
    q["competitor_listings"] = _with(_base_cte(), COMPETITOR_CTE) + "SELECT * FROM competitors"
    q["feature_table"] = _with(*features_latest_ctes()) + "SELECT * FROM features_latest"
    q["feature_table_incremental"] = q["feature_table"]
    q["prior_packages_recent"] = _with(_base_cte(backup=True), _prior_cte(FP.backup().prior_smoothing)) + "SELECT * FROM prior"
    q["lead_base_recent"] = _with(_lead_ctes(FP.backup().lead_history_days)) + "SELECT * FROM lead_base"
    q["package_slots_products"] = _with(_base_cte()) + """
SELECT DISTINCT b.seller_uuid, b.opportunity_id, array_to_string(p.slot_ids, ';') AS slot_ids, array_to_string(p.product_ids, ';') AS product_ids
FROM base_rows b JOIN packages p USING (seller_uuid, opportunity_id)"""
    q.update(scoring_queries())
    q.update(extra_queries())
    return q


# -- scoring and recommendation (M1-M10) ------------------------------------------
# Weight and centre of the test model, restated here so that the code under
# test does not supply them; a feature not named has no weight.
_INTERCEPT = -0.45
_MODEL: dict[str, tuple[float, float]] = {
    "is_broker": (0.3, 0.0),
    "package_duration": (0.002, 270.0),
    "renewal_pct_citylevel_monthly": (0.015, 35.0),
    **{f"{name}_city_median": (0.002, 30.0) if "_per_" in name else (0.01, 0.0) for name in _CITY_MEDIANS},
    "seller_tot_packages_previous": (0.03, 5.0),
    "seller_tot_renewal_previous": (0.03, 5.0),
    "seller_previous_renewal_pct": (0.015, 35.0),
    "rate_price": (1e-6, 1.5e5),
    "sales_price": (1e-6, 1.5e5),
    "package_discount_pct": (-0.05, 5.0),
    "ratio_sales_price_slots": (1e-6, 1.5e5),
    "count_slots_pkg": (0.1, 2.0),
    f"total_leads{_Q}": (0.004, 0.01),
    f"tot_listings{_Q}": (0.004, 0.01),
    f"tot_listing_price{_Q}": (2e-6, 0.0),
    **{c: (0.1, 0.0) for c in _VALUES if c.startswith("ratio_") and c.endswith(_Q)},
    **{c: (0.004, 0.01) for c in (*_LISTING_BHK.values(), *_LEAD_BHK.values())},
    f"churn_shadow_leads{_Q}": (-0.1, 0.0),
    **{f"{c}_leads{_Q}": (0.004, 0.01) for c in ("cr_imagecr_recallback", "call_ivr", "crm", "fb_fbm")},
    f"other_channel_leads{_Q}": (0.02, 0.5),
    f"cnt_listing_other_platforms{_Q}": (-0.03, 0.0),
    f"lead_delivery_ticket_storm{_Q}": (-0.03, 0.0),
    f"cnt_1year_oppor_accowner{_Q}": (0.01, 10.0),
    f"cnt_1year_oppor_renewal_accowner{_Q}": (0.01, 10.0),
    f"renewal_pct_accowner_1year{_Q}": (0.015, 35.0),
}
_INPUTS = ["is_broker", "renewal_due_month", "package_duration", *_VALUES]

# The search configuration, in its order: feature, lower and
# upper limit in per cent, steps up and down in per cent; a value of zero is
# raised by multiples of an increment up to a maximum, so many at most.
_UP = [25, 50, 100, 200, 300, 400, 500, 600, 700, 800, 900, 1000]
_SEARCHED: list[tuple[str, int, int, list[int], list[int], int, int, int]] = [
    ("package_discount_pct", -75, 25, [10, 20, 25], [10, 20], 10, 20, 2),
    (f"tot_listing_price{_Q}", -75, 1000, [25, 50, 100, 150, *_UP[3:]], [10, 25, 50, 75], 50, 200, 4),
    *[(f"listings_{c}{_Q}", -75, 1000, _UP, [25, 50, 75], 50, 200, 4) for c in ("1rk1bhk", "2bhk", "3bhk", "otherbhktype")],
    *[(f"leads_{c}{_Q}", -75, 1000, _UP, [25, 50, 75], 50, 200, 4) for c in ("1rk1bhk", "2bhk", "3bhk")],
    (f"leads_3plusbhk{_Q}", -50, 1000, _UP, [25, 50, 75], 50, 200, 4),
    (f"leads_others{_Q}", -75, 1000, _UP, [25, 50, 75], 50, 200, 4),
    (f"churn_shadow_leads{_Q}", -90, 1000, _UP, [25, 50, 75, 90], 50, 200, 4),
    *[(f"{c}_leads{_Q}", -75, 1000, _UP, [25, 50, 75], 50, 200, 4)
      for c in ("cr_imagecr_recallback", "call_ivr", "crm", "fb_fbm", "other_channel")],
]
_STOP_AT = 0.5


def _dbl(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _scoring_ctes() -> list[str]:
    logit = _dbl(_INTERCEPT)
    for name in _INPUTS:  # summed from left to right, as floating point sums depend on the order
        if name in _MODEL:
            w, c = _MODEL[name]
            logit = f"({logit} + {_dbl(w)} * ({name} - {_dbl(c)}))"
    return [
        """
scoring_set AS (
  SELECT * RENAME (feature_creation_date AS model_run_date), CAST(profile_type = 'Broker' AS INTEGER) AS is_broker,
    seller_tot_packages_previous + 1 AS seller_tot_packages_previous_model,
    seller_tot_renewal_previous + 1 AS seller_tot_renewal_previous_model,
    CAST(seller_tot_renewal_previous + 1 AS DOUBLE) / (seller_tot_packages_previous + 1) AS seller_previous_renewal_pct_model
  FROM features_latest
)""",
        f"""
scored AS (
  SELECT *, 1.0 / (1.0 + exp(-z)) AS initial_prob
  FROM (SELECT *, {logit} AS z
        FROM (SELECT opportunity_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _INPUTS)} FROM scoring_set))
)""",
    ]


def _search_ctes() -> list[str]:
    rows = ", ".join(
        f"({j}, '{name}', {_dbl(_MODEL[name][0])}, {_dbl(_MODEL[name][1])}, {_dbl(lo)}, {_dbl(hi)}, {up}, {down}, {z_by}, {z_max}, {z_n})"
        for j, (name, lo, hi, up, down, z_by, z_max, z_n) in enumerate(_SEARCHED))
    return [
        f"""
searched(ordinal, feature, w, centre, low_pct, high_pct, up, down, zero_by, zero_max, zero_n) AS (VALUES {rows}),
feature_rows AS (
  SELECT s.*, t.opportunity_id, t.z, t.initial_prob, t.v, s.w * (t.v - s.centre) > 0 AS rising,
    least(t.v * (1 + s.high_pct / 100), t.v * 10) AS hi, greatest(t.v * (1 + s.low_pct / 100), t.v * CAST(0.25 AS DOUBLE)) AS lo
  FROM (UNPIVOT (SELECT opportunity_id, z, initial_prob, {', '.join(row[0] for row in _SEARCHED)} FROM scored WHERE initial_prob < {_STOP_AT})
        ON {', '.join(row[0] for row in _SEARCHED)} INTO NAME feature VALUE v) t
  JOIN searched s USING (feature)
),
candidates AS (
  SELECT opportunity_id, z, initial_prob, feature, ordinal, v, w, if(rising, 'increase', 'decrease') AS direction,
    least(lo, hi) AS lower_bound, hi AS upper_bound, pos, CAST(if(rising, up, down)[pos] AS DOUBLE) AS step_size,
    least(greatest(v + if(rising, 1, -1) * (CAST(if(rising, up, down)[pos] AS DOUBLE) / 100 * v), least(lo, hi)), hi) AS new_value
  FROM feature_rows, unnest(range(1, len(if(rising, up, down)) + 1)) AS k(pos)
  WHERE v <> 0
  UNION ALL
  SELECT opportunity_id, z, initial_prob, feature, ordinal, v, w, 'increase', 0, zero_max, pos, NULL, CAST(pos * zero_by AS DOUBLE)
  FROM feature_rows, unnest(range(1, least(zero_n, zero_max // zero_by) + 1)) AS k(pos)
  WHERE v = 0
),
cands AS (
  SELECT *, 1.0 / (1.0 + exp(-(z + w * (new_value - v)))) AS prob FROM candidates WHERE v = 0 OR new_value <> v
),
ranked AS (
  SELECT *, prob - initial_prob AS lift, w * (new_value - v) AS dz,
    CASE WHEN v = 0 THEN 100.0 ELSE abs((new_value - v) / v * 100.0) END AS pct_change,
    row_number() OVER (PARTITION BY opportunity_id ORDER BY round(prob - initial_prob, 9) DESC, ordinal) AS rk
  FROM (FROM cands WHERE prob > initial_prob QUALIFY row_number() OVER (PARTITION BY opportunity_id, feature ORDER BY pos) = 1)
)"""
    ]


GREEDY_CTE = f"""
greedy(opportunity_id, i, z, p, done, took, feature) AS (
  SELECT opportunity_id, 0, z, initial_prob, false, false, CAST(NULL AS VARCHAR) FROM scored WHERE initial_prob < {_STOP_AT}
  UNION ALL
  SELECT g.opportunity_id, g.i + 1,
    CASE WHEN NOT g.done AND 1.0 / (1.0 + exp(-(g.z + r.dz))) > g.p THEN g.z + r.dz ELSE g.z END,
    CASE WHEN NOT g.done AND 1.0 / (1.0 + exp(-(g.z + r.dz))) > g.p THEN 1.0 / (1.0 + exp(-(g.z + r.dz))) ELSE g.p END,
    CASE WHEN NOT g.done AND 1.0 / (1.0 + exp(-(g.z + r.dz))) > g.p
         THEN (1.0 / (1.0 + exp(-(g.z + r.dz))) >= 0.7 OR 1.0 / (1.0 + exp(-(g.z + r.dz))) >= {_STOP_AT})
         ELSE g.done END,
    NOT g.done AND 1.0 / (1.0 + exp(-(g.z + r.dz))) > g.p,
    r.feature
  FROM greedy g JOIN ranked r ON r.opportunity_id = g.opportunity_id AND r.rk = g.i + 1
),
greedy_final AS (
  SELECT g.opportunity_id, g.p AS final_p,
    (SELECT count(*) FROM greedy t WHERE t.opportunity_id = g.opportunity_id AND t.took) AS n_adj,
    (SELECT coalesce(string_agg(t.feature, ',' ORDER BY t.i), '') FROM greedy t
      WHERE t.opportunity_id = g.opportunity_id AND t.took) AS applied
  FROM greedy g
  WHERE g.i = (SELECT max(i) FROM greedy t WHERE t.opportunity_id = g.opportunity_id)
)"""


def scoring_queries() -> dict[str, str]:
    base = features_latest_ctes() + _scoring_ctes()
    r = 9
    q = {}
    q["scoring_set"] = _with(*base) + "SELECT * FROM scoring_set"
    q["score_logistic"] = _with(*base) + f"SELECT opportunity_id, round(initial_prob, {r}) AS initial_prob FROM scored"
    search = base + _search_ctes()
    q["adjustment_candidates"] = _with(*search) + f"""
SELECT opportunity_id, feature, direction, v AS original_value, round(lower_bound, 6) AS lower_bound,
  round(upper_bound, 6) AS upper_bound, CAST(pos AS INTEGER) AS step_ordinal, step_size,
  round(new_value, 6) AS new_value, round(prob, {r}) AS probability
FROM cands"""
    q["first_beneficial_step"] = _with(*search) + f"""
SELECT opportunity_id, feature, direction, step_size, v AS original_value, round(new_value, 6) AS new_value,
  round(prob, {r}) AS probability, round(lift, {r}) AS lift, round(pct_change, 6) AS pct_change,
  CAST(rk AS INTEGER) AS lift_rank
FROM ranked"""
    greedy = search + [GREEDY_CTE]
    q["recommendation_summary"] = _with(*greedy) + f"""
SELECT s.opportunity_id, round(s.initial_prob, {r}) AS initial_prob,
  round(CASE WHEN s.initial_prob >= {_STOP_AT} OR coalesce(g.n_adj, 0) = 0 THEN s.initial_prob ELSE g.final_p END, {r}) AS final_prob,
  round(CASE WHEN s.initial_prob >= {_STOP_AT} OR coalesce(g.n_adj, 0) = 0 THEN 0.0 ELSE g.final_p - s.initial_prob END, {r}) AS probability_lift,
  s.initial_prob >= {_STOP_AT} AS already_above_threshold,
  CAST(coalesce(g.n_adj, 0) AS BIGINT) AS n_adjustments,
  coalesce(g.applied, '') AS applied_features
FROM scored s LEFT JOIN greedy_final g ON g.opportunity_id = s.opportunity_id"""
    q["recommendation_adjustments"] = _with(*greedy) + """
SELECT g.opportunity_id, g.feature, r.v AS original_value, round(r.new_value, 6) AS new_value,
  round(r.new_value - r.v, 6) AS delta
FROM greedy g JOIN ranked r ON r.opportunity_id = g.opportunity_id AND r.feature = g.feature
WHERE g.took"""
    q["recommendation_any_model"] = q["recommendation_summary"]
    border = f"{AS_OF} - {FP.holdout_days}"
    scoring = _scoring_ctes()
    training = [*features_latest_ctes(ended=True), scoring[0], f"""
training AS (
  SELECT s.*, if(r.renewal_window = '45D Renewed', 1.0, 0.0)::DOUBLE AS label,
    CASE WHEN onefourth_cutoff_date >= {border} THEN 'test' WHEN package_end_date < {border} THEN 'train' ELSE 'gap' END AS split
  FROM scoring_set s JOIN renewal_report r USING (opportunity_id)
)"""]
    q["training_set"] = _with(*training) + "SELECT * FROM training"
    q["model_evaluation"] = _with(*training, scoring[1]) + """
SELECT split, count(*) AS n, round(avg(label), 9) AS renewal_rate, round(avg(initial_prob), 9) AS mean_prob,
  round(avg(power(initial_prob - label, 2)), 9) AS brier,
  round(avg(-ln(greatest(1e-15, 1 - abs(initial_prob - label)))), 9) AS log_loss,
  round(avg(CAST((initial_prob >= 0.5) = (label = 1) AS INTEGER)), 9) AS accuracy
FROM training JOIN scored USING (opportunity_id) GROUP BY split"""
    inputs = ", ".join(_INPUTS)
    q["recommendation_values"] = _with(*greedy) + f"""
SELECT u.opportunity_id, u.feature, u.original_value, round(coalesce(a.new_value, u.original_value), 6) AS new_value,
  round(a.new_value - a.v, 6) AS delta
FROM (UNPIVOT (SELECT opportunity_id, {inputs} FROM scored) ON {inputs} INTO NAME feature VALUE original_value) u
LEFT JOIN (SELECT r.* FROM ranked r JOIN greedy g ON g.took AND g.opportunity_id = r.opportunity_id AND g.feature = r.feature) a
  ON a.opportunity_id = u.opportunity_id AND a.feature = u.feature"""
    q["prediction_history"] = q["recommendation_summary"].replace(
        "\nSELECT s.opportunity_id, round(s.initial_prob", ", summary AS (\nSELECT s.opportunity_id, round(s.initial_prob") + f""")
SELECT {AS_OF} AS model_run_date, opportunity_id, initial_prob, final_prob, probability_lift, already_above_threshold,
  CAST({len(_INPUTS)} AS BIGINT) AS n_original, CAST({len(_INPUTS)} AS BIGINT) AS n_new, n_adjustments, model_name
FROM summary, (VALUES (NULL), ('linear')) AS appended(model_name)"""
    return q


def extra_queries() -> dict[str, str]:
    from renewlens.plans.registry import LEAD_SUBSETS

    q: dict[str, str] = {}
    lead = _with(_base_cte(), _lead_ctes(), LEAD_FEATURE_CTE)
    for name, cols in LEAD_SUBSETS.items():
        q[name] = lead + f"SELECT city, seller_uuid, opportunity_id, {', '.join(cols)} FROM lead_features"
    q["package_recency_rank"] = _with(_base_cte(), _prior_cte()) + """
SELECT b.city, b.seller_uuid, b.opportunity_id, b.package_start_date,
  CAST(1 + count(pp.opportunity_id) AS INTEGER) AS package_recency_rank
FROM (SELECT DISTINCT city, seller_uuid, opportunity_id, package_start_date FROM base_rows) b
LEFT JOIN history pp ON pp.seller_uuid = b.seller_uuid AND pp.starts > b.package_start_date
GROUP BY ALL"""
    q["listing_buckets"] = _with(LISTINGS) + "SELECT * FROM listing_dim"
    q["listing_price_median_impute"] = _with(_lead_ctes()) + (
        "SELECT seller_uuid, median(listing_price) AS mean_listing_price FROM seller_leads GROUP BY 1")
    q["seller_property_mode"] = _with(_lead_ctes()) + """
SELECT seller_uuid, arg_max(property_type, (n, -kind)) AS property_type_mode
FROM (SELECT seller_uuid, property_type, count(property_type) AS n, rank() OVER (ORDER BY property_type) AS kind
      FROM seller_leads GROUP BY 1, 2)
GROUP BY 1"""
    q["lead_channel_bucket"] = _with(_lead_ctes()) + """
SELECT lead_generator, lead_generator_new, count(*) AS n_leads FROM lead_base GROUP BY ALL"""
    q["packages_per_cutoff"] = _with(_base_cte(backup=True)) + """
SELECT onefourth_cutoff_date, count(DISTINCT opportunity_id) AS cnt FROM base_rows GROUP BY onefourth_cutoff_date"""
    feats = _with(*features_latest_ctes())
    q["feature_counts"] = feats + """
SELECT count(*) AS n_rows, count(DISTINCT seller_uuid) AS sellers, count(DISTINCT opportunity_id) AS distinct_opportunities
FROM features_latest"""
    package, owner = "(seller_uuid, opportunity_id)", "(account_owner_id, opportunity_id)"
    tables = {
        "base": (f"(SELECT DISTINCT {_IDENTITY}, rate_price, sales_price, account_owner_id FROM base_rows WHERE city IS NOT NULL)", "(seller_uuid, account_owner_id, opportunity_id)"),
        "med": ("city_medians", package), "slots": ("slots", package), "prior": ("prior", package), "lf": ("lead_features", package),
        "comp": ("competitors", package), "tick": ("ticket_counts", package), "own": ("owner_exp", owner)}
    q["builder_grain"] = feats + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS builder, count(*) AS n_rows, count(*) - count(DISTINCT {key}) AS n_repeated FROM {table}" for name, (table, key) in tables.items())
    q["cutoff_range"] = feats + """
SELECT min(onefourth_cutoff_date) AS min_cutoff_date, max(onefourth_cutoff_date) AS max_cutoff_date FROM features_latest"""
    q["top_packages"] = feats + """
SELECT opportunity_id, seller_uuid, city, total_leads_25pctduration FROM features_latest
ORDER BY total_leads_25pctduration DESC, opportunity_id ASC LIMIT 20"""
    q["feature_repository"] = feats + """
SELECT feature_creation_date, count(DISTINCT opportunity_id) AS cnt FROM features_latest GROUP BY 1"""
    q["feature_repository_swapped"] = q["feature_repository"]
    q["repository_empty_rerun"] = feats + f"""
SELECT CAST({AS_OF} - 1 AS DATE) AS feature_creation_date, count(DISTINCT opportunity_id) AS cnt FROM features_latest"""
    q["score_monitor"] = _with(*(features_latest_ctes() + _scoring_ctes())) + f"""
SELECT {AS_OF} AS model_run_date, count(DISTINCT opportunity_id) AS cnt_opportunities,
  CAST(sum(CASE WHEN initial_prob >= 0.25 THEN 1 ELSE 0 END) AS BIGINT) AS percent_renewals
FROM scored"""
    return q
