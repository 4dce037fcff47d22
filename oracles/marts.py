"""Seven marts in DuckDB SQL, as layers over one relation of trips.

A trip is a delivery with its order and its wall times on the UTC clock.  Every mart
starts from trips of a report window, adds one layer per subject, and names its
columns in the dictionaries below (output name -> expression).  Column names, labels,
word lists and rates are fixed values of the reports.
"""

from __future__ import annotations

from .parts import (END, R_END, R_START, START, area_km2, daypart, eight_ranges, local, ms_trunc,
                    slack_bin, utc)

CLOCKS = ("delivery_created_time", "delivery_in_transit_time", "delivery_arrived_time",
          "delivery_begin_parking_time", "collect_accepted_time", "collect_in_transit_time",
          "collect_arrived_time", "collect_completed_time")


def trips(name: str, where: str) -> str:
    clocks = ", ".join(f"{utc(f'd.{c}_local', 'd.timezone')} AS {c}_utc" for c in CLOCKS)
    return f"""
{name} AS (
  SELECT d.* EXCLUDE (sys_resto_id), o.* EXCLUDE (tenant_id, sys_order_id), {clocks}
  FROM fact_orders_resto o JOIN fact_deliveries d ON d.sys_order_id = o.sys_order_id
  WHERE d.delivery_status = 'DELIVERED' AND {where}
)"""


def columns(named: dict[str, str]) -> str:
    return ",\n    ".join(f"{sql} AS {name}" for name, sql in named.items())


def took(since: str, until: str) -> str:
    """Whole seconds between two UTC clocks; 0 if either is unknown."""
    return f"ifnull(date_diff('second', {since}_utc, {until}_utc), 0)"


def whole_minutes(seconds: str) -> str:
    return f"floor({seconds} / 60.0)"


IN_WINDOW = f"o.order_date BETWEEN {START} AND {END}"

#: A restaurant with its type and whether it is one of the named chain.
RESTAURANTS = """
restaurant AS (
  SELECT r.sys_resto_id, r.resto_type, r.sys_delivery_zone_id AS home_zone,
         CAST(coalesce(g."grouping" = 'McDonald%s', FALSE) OR coalesce(r.resto_name_short LIKE '%McDonald%s%', FALSE) AS INTEGER) AS chain
  FROM dim_resto r LEFT JOIN dim_resto_grouping g USING (sys_resto_id)
)"""

# --- delivery staging -------------------------------------------------------------
REFUSALS = {"is_multi_collect": "is_rejected_as_multi_collect", "is_manual_unassigned": "is_manual_unassigned",
            "is_cnmp_unassigned": "is_cnmp_unassigned", "is_timer_expired": "is_timer_expired",
            "is_offer_declined": "is_offer_declined"}

#: One row per delivery with a refusal: how often each kind, and whether at all.
REFUSAL_COUNTS = ", ".join(
    f"CAST(count_if({flag}) AS BIGINT) AS {out}_count, CAST(bool_or({flag}) AS BIGINT) AS {out}" for flag, out in REFUSALS.items())

UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"

#: Each line of the log once per uuid that it names, and whether it names several jobs.
LOG_LINES = f"""
log_line AS (
  SELECT courierId AS courier, "timestamp" AS ts, unnest(regexp_extract_all(assignedJobs, '{UUID}')) AS delivery_uuid,
         CAST((length(assignedJobs) - length(replace(assignedJobs, 'COLLECT', ''))) // 7 AS BIGINT) AS jobs
  FROM assignment_log
)"""

#: What each courier's last line about a uuid says, then whether any courier's does.
SHARING = """
last_line AS (SELECT courier, delivery_uuid, arg_max(jobs, ts) AS jobs FROM log_line GROUP BY courier, delivery_uuid),
sharing AS (SELECT delivery_uuid, CAST(max(jobs) > 1 AS BIGINT) AS is_assigned_as_multi_collect FROM last_line GROUP BY delivery_uuid)"""

#: The window of each delivery that starts last, over both tables.
HOLDS = """
hold AS (
  SELECT delivery_id AS sys_delivery_id, arg_max(h, h.time_window_start) AS h
  FROM (FROM hold_container_live UNION ALL FROM hold_container_archive) h
  GROUP BY delivery_id
)"""

SAME_IN_STAGING = """
    order_date tenant_id timezone sys_courier_delivery_zone_id sys_courier_id sys_delivery_id sys_order_id order_number
    public_order_number delivery_created_time_local delivery_in_transit_time_local collect_assigned_time_local
    collect_accepted_time_local collect_arrived_time_local collect_completed_time_local
    delivery_begin_parking_time_local ccdd_id multi_collect_sequence sys_resto_id resto_type sys_custo_id
    delivery_status is_assigned_by_holding_container handle_time_sec collect_total_driving_time_min
    delivery_total_driving_time_min ccdd_courier_analysis_handle_time_sec ptod_sec ptoc_sec ctod_sec
    collect_original_total_driving_time_min deliver_original_total_driving_time_min resto_hold_sec custo_hold_sec
    collect_in_transit_time_utc collect_accessibility_minutes deliver_accessibility_minutes
    company_net_adjustment_sum na_company_net_adjustment_sum nc_total_net_compensation_sum
    courier_net_adjustment_sum custo_net_adjustment_sum na_custo_net_adjustment_sum nc_custo_net_compensation_sum
    resto_net_adjustment_sum na_resto_net_adjustment_sum nc_resto_net_compensation_sum
    is_assigned_as_multi_collect first_order_deliver_original_total_driving_time_min""".split()

#: What a second leg gains: 0 on all other rows.
GAINS = {
    "collect_total_driving_time_sec_max_ccdd": "longest_collect_min * 60",
    "delivery_total_driving_time_min_previous_leg": "leg_before_min * 60",
    "pooling_capacity_gains_sec": "longest_collect_min * 60 + ccdd_courier_analysis_handle_time_sec - leg_before_min * 60",
}

LOCAL_PAY = "ifnull(courier_pay_without_tips, 0)"
READY_MIN = "CAST(ifnull(resto_food_prep_min, 0) + ifnull(resto_delay_requested_min, 0) AS BIGINT)"
REACH_MIN = "CAST(ifnull(collect_accessibility_minutes, 0) + ifnull(collect_original_total_driving_time_min, 0) AS BIGINT)"
PTOV = took("delivery_created_time", "collect_accepted_time")
CTOD_MIN = whole_minutes("ctod_sec")

STAGING_COLUMNS = {c: c for c in SAME_IN_STAGING} | {
    "delivery_zone_name": "zone.name", "sys_zone_group_id": "zone.sys_zone_group_id",
    "zone_group_name": "zone.zone_group_name", "zone_area_square_km": "zone.area",
    "sys_courier_delviery_zone_id_resto": "home.id", "delivery_zone_name_resto": "home.name",
    "zone_area_square_km_resto": "home.area",
    "is_multi_collect": "ifnull(is_multi_collect, 0)",
    "pooling_in_transit_tag": "if(multi_collect_in_transit = 1, '', 'Not ') || 'Assigned In-Transit'",
    "courier_pay_without_tips": LOCAL_PAY,
    "courier_pay_without_tips_or_courier_adjustments": f"{LOCAL_PAY} - ifnull(courier_net_adjustment, 0)",
    "is_mcdonalds": "ifnull(chain, 0)",
    "pos_injection_time_utc": "CAST(injection_time AS TIMESTAMP)",
    "pos_fire_into_pos_time_min": "fire_into_pos_time",
    "ptov_sec": f"if(is_asap_order = 1, {PTOV}, NULL)",
    "collect_leg_delay_sec": f"""if(is_asap_order = 1, ifnull(date_diff('second',
        delivery_created_time_utc + to_minutes({READY_MIN}), collect_in_transit_time_utc + to_minutes({REACH_MIN})), 0), NULL)""",
    "vtoa_sec": took("collect_accepted_time", "collect_in_transit_time"),
    "atoar_sec": took("collect_in_transit_time", "collect_arrived_time"),
    "drive_to_custo_sec": took("delivery_in_transit_time", "delivery_arrived_time"),
    "end_to_end_time_sec": "date_diff('second', delivery_created_time_utc, delivery_begin_parking_time_utc)",
    "route_time_sec": "date_diff('second', delivery_created_time_utc, collect_arrived_time_utc)",
    "in_resto_time_sec": "date_diff('second', collect_arrived_time_utc, collect_completed_time_utc) - collect_accessibility_minutes * 120",
    "accept_to_drive_to_resto_sec": ms_trunc("collect_in_transit_time_utc", "collect_accepted_time_utc"),
    "accept_to_arrive_at_resto_sec": ms_trunc("collect_arrived_time_utc", "collect_accepted_time_utc"),
    "accept_to_collect_sec": ms_trunc("collect_completed_time_local", "collect_accepted_time_local"),
    "collect_delay": "round(ifnull(collect_total_driving_time_min, 0) - ifnull(collect_original_total_driving_time_min, 0), 0)",
    "deliver_delay": "round(ifnull(delivery_total_driving_time_min, 0) - ifnull(deliver_original_total_driving_time_min, 0), 0)",
    "is_on_time_order": "CAST(ifnull(delivery_completion_slack_min BETWEEN 0 AND 10, FALSE) AS INTEGER)",
    "delivery_completion_slack_bin": slack_bin("delivery_completion_slack_min"),
    "ctod_min_bin": "CASE " + " ".join(
        f"WHEN {CTOD_MIN} BETWEEN {lo} AND {hi} THEN '{lo} to {hi} Mins'"
        for lo, hi in ((0, 5), (6, 8), (9, 11), (12, 15), (16, 20), (21, 25))) + f" WHEN {CTOD_MIN} > 26 THEN '> 25 Mins' ELSE ' N/A' END",
    "delivery_driving_distance_original_kms_bin": eight_ranges("floor(delivery_driving_distance_original_meters / 1000.0)", "KMs", "21+ KMs"),
    "deliver_original_total_driving_time_min_bin": eight_ranges("floor(deliver_original_total_driving_time_min)", "Mins", "21+ Mins"),
    "ptov_min_bin": eight_ranges(whole_minutes(PTOV), "Mins", "> 21 Mins", 18, 21, 22, guard="is_asap_order = 1", default=" N/A"),
    "time_of_day_group": daypart("delivery_created_time_local"),
    "day_of_week_local": "CAST(1 + dayofweek(delivery_created_time_local) AS BIGINT)",
    "day_of_week_and_time_of_day_group": f"concat(delivery_created_time_local::VARCHAR, {daypart('delivery_created_time_local')})",
    "planned_holding_window_sec": "date_diff('second', h.time_window_start, h.time_window_end)",
    "actual_holding_window_sec": "date_diff('second', h.time_window_start, h.time_window_end_original)",
    # counting boundaries is additive, so the windows differ by the time between their ends
    "actual_vs_planned_diff": "date_diff('second', h.time_window_end, h.time_window_end_original)",
} | {
    c: f"ifnull({c}, 0)" for c in ("food_subtotal", "resto_food_prep_min", "resto_delay_requested_min", "is_asap_order", "is_score_positive")
} | {
    f"{leg}_driving_distance_original_kms": f"round({leg}_driving_distance_original_meters / 1000.0, 2)" for leg in ("collect", "delivery")
} | {
    f"{end}_local": local(f"h.{end}", "timezone") for end in ("time_window_start", "time_window_end", "time_window_end_original")
} | {gain: f"if(multi_collect_sequence = 2, {sql}, 0)" for gain, sql in GAINS.items()} | {
    # a delivery with several rows counts its refusals on each of them
    f"{out}_count": f"CAST({out}_count * rows_of_delivery AS BIGINT)" for out in REFUSALS.values()
} | {out: f"ifnull({out}, 0)" for out in REFUSALS.values()}

STAGING = f""",{trips("trip", f"{IN_WINDOW} AND d.tenant_id = 'ie'")},
leg AS (
  SELECT t.*, b.* EXCLUDE (sys_delivery_id),
         max(collect_total_driving_time_min) OVER pool AS longest_collect_min,
         lag(delivery_total_driving_time_min) OVER (pool ORDER BY multi_collect_sequence NULLS FIRST) AS leg_before_min
  FROM trip t LEFT JOIN bridge_multi_collect b ON b.sys_delivery_id = t.sys_delivery_id
  WINDOW pool AS (PARTITION BY ccdd_id)
),{RESTAURANTS},
zone AS (
  SELECT sys_courier_delivery_zone_id AS id, name, sys_zone_group_id, zone_group_name, round({area_km2('polygon')}, 1) AS area FROM dim_zones
),
priced AS (
  SELECT *, count(*) OVER (PARTITION BY sys_delivery_id) AS rows_of_delivery
  FROM leg
  LEFT JOIN restaurant USING (sys_resto_id)
  LEFT JOIN fact_order_financial_metrics USING (sys_order_id)
  LEFT JOIN fact_resto_reviews USING (sys_order_id)
  LEFT JOIN (SELECT order_id AS sys_order_id, * EXCLUDE (order_id) FROM pos_injection) USING (sys_order_id)
  LEFT JOIN global_adjustments USING (sys_delivery_id)
),
opening_leg AS (
  SELECT ccdd_id, deliver_original_total_driving_time_min AS first_order_deliver_original_total_driving_time_min
  FROM priced WHERE multi_collect_sequence = 1
),
refusal AS (SELECT sys_delivery_id, {REFUSAL_COUNTS} FROM bridge_blacklisted_couriers GROUP BY sys_delivery_id),
{LOG_LINES.strip()},{SHARING},{HOLDS},
delivery_staging AS (
  SELECT {columns(STAGING_COLUMNS)}
  FROM priced
  LEFT JOIN zone ON zone.id = sys_courier_delivery_zone_id
  LEFT JOIN zone home ON home.id = home_zone
  LEFT JOIN opening_leg USING (ccdd_id)
  LEFT JOIN refusal USING (sys_delivery_id)
  LEFT JOIN sharing USING (delivery_uuid)
  LEFT JOIN hold USING (sys_delivery_id)
)"""


# --- tickets ----------------------------------------------------------------------
TICKETS = """,
customer_ticket AS (
  SELECT CAST(t.ticket_order_id_local AS BIGINT) AS public_order_number
  FROM (ticket_heads t LEFT JOIN ticket_calls c USING (conv_id)) LEFT JOIN ticket_chats m USING (conv_id)
  WHERE t.contact_origin = 'originator_customer'
    AND (coalesce(c.call_segment_id, m.chat) IS NOT NULL OR t.ticket_origin IN ('origin_offline', 'origin_self_serve_offline'))
),
ticket_info AS (
  SELECT s.tenant_id, s.sys_delivery_id, 1::BIGINT AS has_ticket
  FROM customer_ticket JOIN delivery_staging s USING (public_order_number)
  WHERE s.tenant_id = 'ie'
)"""

# --- pooling summary --------------------------------------------------------------
SUMMARY_KEYS = """
    order_date time_of_day_group day_of_week_local tenant_id sys_courier_delivery_zone_id delivery_zone_name
    sys_zone_group_id zone_group_name resto_type is_multi_collect is_assigned_by_holding_container
    pooling_in_transit_tag multi_collect_sequence is_mcdonalds delivery_status is_on_time_order
    delivery_completion_slack_bin ctod_min_bin ptov_min_bin delivery_driving_distance_original_kms_bin
    deliver_original_total_driving_time_min_bin is_asap_order is_rejected_as_multi_collect
    is_assigned_as_multi_collect is_manual_unassigned is_cnmp_unassigned is_timer_expired is_offer_declined
    is_negative_company_net_adjustment has_begin_parking_time has_ticket""".split()

#: Sums of seconds, given in minutes: output -> column.
IN_MINUTES = {
    "handle_time_mins_sum": "handle_time_sec",
    "pooling_second_order_handle_time_min_sum": "ccdd_courier_analysis_handle_time_sec",
    "collect_total_driving_time_saved_min_sum": "collect_total_driving_time_sec_max_ccdd",
    "route_time_min_sum": "route_time_sec",
    "pooling_kpi_mins_sum": "drive_to_parked_sec",
    "assignment_time_gap_mins_sum": "if(is_multi_collect = 1, assigned_gap, 0)",
    "acceptance_time_gap_mins_sum": "if(is_multi_collect = 1, accepted_gap, 0)",
} | {f"{x}_mins_sum": f"{x}_sec" for x in (
    "pooling_capacity_gains", "ptod", "ptoc", "ctod", "ptov", "resto_hold", "in_resto_time", "accept_to_collect",
    "accept_to_drive_to_resto", "accept_to_arrive_at_resto")}

PAY, PAY_ADJUSTED = "ifnull(courier_pay_without_tips, 0)", "ifnull(courier_pay_without_tips_or_courier_adjustments, 0)"
#: Amounts summed in local money and in euros: output stem -> amount of a row.
IN_MONEY = {
    "courier_pay_without_tips": PAY,
    "courier_pay_without_tips_or_courier_adjustments": PAY_ADJUSTED,
    "total_order_cost": f"({PAY_ADJUSTED} - ifnull(company_net_adjustment_sum, 0))",
} | {f"{who}_net_adjustment": f"ifnull({who}_net_adjustment_sum, 0)" for who in ("company", "courier", "custo", "resto")}

#: Local money for one euro.
RATES = {"ca": 1.47, "uk": 0.851, "ie": 1, "au": 1.579, "nz": 1.6}


def _chain_measures() -> dict[str, str]:
    found, before = {}, "current_order"
    for nth in ("first", "second", "third", "fourth"):
        found[f"{nth}_reorders_count"] = f"count(DISTINCT {nth}_reorder_sys_delivery_id)"
        found[f"{nth}_reorder_days_sum"] = f"CAST(ifnull(sum(days_between_{before}_and_{nth}_reorder), 0) AS BIGINT)"
        found[f"{nth}_reorder_food_subtotal"] = f"CAST(ifnull(sum({nth}_reorder_food_subtotal), 0) AS BIGINT)"
        before = f"{nth}_reorder"
    return found


SUMMARY_MEASURES = {
    "delivery_count": "count(DISTINCT sys_delivery_id)",
    "collect_delay_mins_sum": "sum(ifnull(collect_delay, 0))",
    "rejections_sum": "CAST(sum(ifnull(refusing_couriers, 0)) AS BIGINT)",
    "rejected_offer_count": "count(DISTINCT sys_delivery_id) FILTER (WHERE refusing_couriers > 0)",
    "food_subtotal": "CAST(sum(ifnull(food_subtotal, 0)) AS BIGINT)",
    "orders_with_min_1_reorder_count": "count(DISTINCT sys_delivery_id) FILTER (WHERE has_chain)",
    "restaurant_accessibility_time_mins": "CAST(sum(ifnull(collect_accessibility_minutes, 0)) AS BIGINT)",
    "total_order_cost_less_customer_refunds_sum":
        f"sum({PAY} - ifnull(company_net_adjustment_sum, 0) - ifnull(custo_net_adjustment_sum, 0))",
    "positive_scores_count": "count_if(is_score_positive = 1)::BIGINT",
    "non_positive_scores_count": "count_if(is_score_positive = 0)::BIGINT",
} | {out: f"CAST(sum(ifnull({x}, 0)) AS DOUBLE) / 60.0" for out, x in IN_MINUTES.items()} | {
    f"{stem}_sum": f"sum({x})" for stem, x in IN_MONEY.items()} | {
    f"{stem}_euros_sum": f"sum({x} / euro_rate)" for stem, x in IN_MONEY.items()} | _chain_measures()

# Every relation below joins on the delivery (or pool) without removing repeats, so the
# rows of a delivery that is staged several times multiply as the reports' joins do.
SUMMARY = f""",
pool_start AS (
  SELECT ccdd_id, min(delivery_in_transit_time_local) AS started
  FROM delivery_staging WHERE is_multi_collect = 1 AND multi_collect_sequence = 1 GROUP BY ALL
),
pool_step AS (
  SELECT ccdd_id, sys_delivery_id,
         abs(date_diff('second', lag(collect_assigned_time_local) OVER legs, collect_assigned_time_local)) AS assigned_gap,
         abs(date_diff('second', lag(collect_accepted_time_local) OVER legs, collect_accepted_time_local)) AS accepted_gap
  FROM delivery_staging WHERE ccdd_id IS NOT NULL
  WINDOW legs AS (PARTITION BY ccdd_id ORDER BY multi_collect_sequence NULLS FIRST)
),
pool_times AS (
  SELECT s.sys_delivery_id, assigned_gap, accepted_gap,
         date_diff('second', {utc('started', 's.timezone')}, {utc('s.delivery_begin_parking_time_local', 's.timezone')}) AS drive_to_parked_sec
  FROM delivery_staging s LEFT JOIN pool_start USING (ccdd_id) LEFT JOIN pool_step USING (ccdd_id, sys_delivery_id)
),
refusing AS (SELECT sys_delivery_id, count(DISTINCT sys_courier_id) AS refusing_couriers FROM bridge_blacklisted_couriers GROUP BY ALL),
euro AS (FROM (VALUES {', '.join(f"('{t}', {r}::DOUBLE)" for t, r in RATES.items())}) v(tenant_id, euro_rate)),
reordered AS (SELECT *, TRUE AS has_chain FROM reorder_info),
summary_row AS (
  SELECT s.*, assigned_gap, accepted_gap, drive_to_parked_sec, refusing_couriers, euro_rate,
         reordered.* EXCLUDE (sys_delivery_id),
         if(s.company_net_adjustment_sum < 0, 1, 0) AS is_negative_company_net_adjustment,
         if(s.delivery_begin_parking_time_local IS NULL, 0, 1) AS has_begin_parking_time,
         if(t.has_ticket = 1, 1, 0) AS has_ticket
  FROM delivery_staging s
  LEFT JOIN reordered USING (sys_delivery_id)
  LEFT JOIN (SELECT sys_delivery_id, has_ticket FROM ticket_info) t USING (sys_delivery_id)
  LEFT JOIN refusing USING (sys_delivery_id)
  LEFT JOIN euro USING (tenant_id)
  LEFT JOIN pool_times USING (sys_delivery_id)
),
pooling_summary AS (
  SELECT {', '.join(SUMMARY_KEYS)},
    {columns(SUMMARY_MEASURES)}
  FROM summary_row GROUP BY {', '.join(SUMMARY_KEYS)}
)"""

# --- refunds ----------------------------------------------------------------------
#: Query types that count as a contact of a kind.
CONTACTS = {"late_order": "rds_late|late_order", "food_quality": "food_quality|quality_of_food"}

CONTACT_FLAGS = ", ".join(
    f"CAST(count(ticket_id_local) FILTER (WHERE regexp_matches(query_type, '{words}')) > 0 AS INTEGER) AS {kind}_contact"
    for kind, words in CONTACTS.items())

CONTACT_ROWS = f"""
  FROM ticket_heads
  WHERE country_code = 'IE' AND order_date_local BETWEEN {R_START} AND {R_END}
    AND regexp_matches(query_type, '{'|'.join(CONTACTS.values())}')
  GROUP BY order_id_local"""

#: Each scenario of an order once, in order, and the order's total.
SCENARIOS = """list_aggregate(list_sort(list_distinct(list(scenario))), 'string_agg', ', ') AS all_scenarios,
         round(sum(company_net_adjustment), 3) AS total_company_net_adjustment"""

DETAIL = {c: c for c in """
    tenant_id sys_courier_delivery_zone_id sys_order_id order_date ctod_sec is_multi_collect
    deliver_original_total_driving_time_min multi_collect_sequence resto_hold_sec delivery_zone_name delivery_status
    delivery_begin_parking_time_local resto_type""".split()} | {
    "payment_utc": "delivery_created_time_local",
    "rejections": "ifnull(refusing_couriers, 0)",
    "late_order_contacts": "ifnull(late_order_contact, 0)",
    "food_quality_contacts": "ifnull(food_quality_contact, 0)",
    "voucher_refunds_issued_total_amount": "total_company_net_adjustment",
    "voucher_refund_reason": "all_scenarios",
    "accept_to_collect_sec": ms_trunc("collect_completed_time_local", "collect_accepted_time_local"),
    "accept_to_drive_to_rest_sec": ms_trunc("collect_in_transit_time_local", "collect_accepted_time_local"),
    "accept_to_arrive_at_rest_sec": ms_trunc("collect_arrived_time_local", "collect_accepted_time_local"),
    "arrive_at_rest_to_collect_sec": ms_trunc("collect_completed_time_local", "collect_arrived_time_local"),
    "is_on_time_order": STAGING_COLUMNS["is_on_time_order"],
    "delivery_completion_slack_bin": STAGING_COLUMNS["delivery_completion_slack_bin"],
    "is_asap_order": "ifnull(is_asap_order, 0)",
    "is_mcdonalds": "ifnull(chain, 0)",
    # the pool of a bridged delivery (even if it has none), else the delivery itself
    "del_key": "if(bridged, ccdd_id, sys_delivery_id)",
}

REPORT_KEYS = """tenant_id, sys_courier_delivery_zone_id, delivery_zone_name, resto_type, is_multi_collect,
    multi_collect_sequence, is_mcdonalds, delivery_status, is_on_time_order, delivery_completion_slack_bin, is_asap_order,
    if(voucher_refunds_issued_total_amount < 0, 1, 0) AS is_negative_company_net_adjustment,
    if(delivery_begin_parking_time_local IS NULL, 0, 1) AS has_begin_parking_time"""

MISSING_ITEM = ("complaint_on_order_item", "entire_order_incorrect", "incorrect_or_missed_item",
                "complaint_on_entire_order", "missing_incorrect_items")

ORDERS_WITH = {
    "md_orders": "is_multi_collect = 1",
    "orders_w_food_quality_refund": "voucher_refund_reason ILIKE '%food#_quality%' ESCAPE '#'",
    "orders_w_delivery_service_refund": "voucher_refund_reason ILIKE '%delivery#_service%' ESCAPE '#'",
    "orders_w_missing_item_refund": f"regexp_matches(voucher_refund_reason, '{'|'.join(MISSING_ITEM)}', 'i')",
}

R_WINDOW = f"o.order_date BETWEEN {R_START} AND {R_END} AND d.delivery_created_time_local BETWEEN {R_START} AND {R_END}"

REFUNDS = f""",{trips("refund_trip", f"{R_WINDOW} AND d.tenant_id = 'ie' AND o.tenant_id = d.tenant_id")},{RESTAURANTS},
refusing AS (
  SELECT sys_delivery_id, count(DISTINCT sys_courier_id) AS refusing_couriers
  FROM bridge_blacklisted_couriers WHERE tenant_id = 'ie' GROUP BY ALL
),
adjusted AS (SELECT sys_order_id, {SCENARIOS} FROM fact_order_net_adjustments WHERE tenant_id = 'ie' GROUP BY sys_order_id),
contact AS (SELECT order_id_local AS public_order_number, {CONTACT_FLAGS}{CONTACT_ROWS}),
refund_row AS (
  SELECT {columns(DETAIL)}
  FROM refund_trip
  LEFT JOIN (SELECT *, TRUE AS bridged FROM bridge_multi_collect) USING (sys_delivery_id)
  LEFT JOIN restaurant USING (sys_resto_id)
  LEFT JOIN (SELECT sys_courier_delivery_zone_id, name AS delivery_zone_name FROM dim_zones) USING (sys_courier_delivery_zone_id)
  LEFT JOIN refusing USING (sys_delivery_id)
  LEFT JOIN adjusted USING (sys_order_id)
  LEFT JOIN contact USING (public_order_number)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY sys_order_id
                               ORDER BY payment_utc NULLS FIRST, del_key NULLS FIRST, multi_collect_sequence NULLS FIRST) AS record_rank
  FROM refund_row
),
refund_detail AS (
  SELECT *, record_rank = 1 AS non_dup_record_flag,
         dense_rank() OVER (PARTITION BY del_key ORDER BY payment_utc NULLS FIRST) AS payment_sequence_dense_rank,
         row_number() OVER (PARTITION BY del_key, record_rank ORDER BY payment_utc NULLS FIRST, sys_order_id) AS payment_sequence
  FROM numbered
),
refunds_summary AS (
  SELECT {REPORT_KEYS}, payment_sequence_dense_rank, deliver_original_total_driving_time_min,
    CASE WHEN ctod_sec < 1800 THEN CAST(greatest(ctod_sec, 0) // 60 AS VARCHAR) WHEN ctod_sec >= 1800 THEN '+30' END AS ctod_min,
    count(DISTINCT sys_order_id) AS delivered_orders,
    {columns({out: f"count(DISTINCT sys_order_id) FILTER (WHERE {which})" for out, which in ORDERS_WITH.items()})}
  FROM refund_detail GROUP BY ALL
),
order_counts AS (
  SELECT {REPORT_KEYS}, order_date, voucher_refund_reason, payment_sequence, count(DISTINCT sys_order_id) AS delivered_orders
  FROM refund_detail GROUP BY ALL
)"""

# --- utilisation ------------------------------------------------------------------
# Shifts join on zone and day only; the reports' condition on the tenant compares one
# side with itself, so it asks no more than a tenant.
UTILISATION = f""",{trips("any_trip", IN_WINDOW)},
place AS (SELECT sys_delivery_zone_id AS zone_id, zone_name FROM dim_zones),
handled AS (
  SELECT t.order_date, place.zone_name, t.tenant_id, t.handle_time_sec AS alone_sec,
         if(b.is_multi_collect = 1, b.ccdd_courier_analysis_handle_time_sec, t.handle_time_sec) AS pooled_sec
  FROM any_trip t
  JOIN place ON place.zone_id = t.sys_courier_delivery_zone_id
  JOIN bridge_shift_delivery USING (sys_delivery_id)
  LEFT JOIN bridge_multi_collect b USING (sys_delivery_id)
),
shift AS (
  SELECT s.tenant_id, s.start_date AS order_date, place.zone_name, s.shift_time_sec - ifnull(s.dnu_time_sec, 0) AS worked_sec
  FROM dim_courier_shifts s LEFT JOIN dim_couriers USING (sys_courier_id) LEFT JOIN place ON place.zone_id = s.delivery_zone_id
  WHERE s.start_date BETWEEN {START} AND {END}
),
handled_day AS (
  SELECT order_date, zone_name, tenant_id, round(sum(alone_sec)::DOUBLE / 60.0, 2) AS handle_time_min_sum,
         round(sum(pooled_sec)::DOUBLE / 60.0, 2) AS ccdd_handle_time_min_sum
  FROM handled WHERE NOT starts_with(zone_name, 'SAT - ') GROUP BY ALL
),
shift_day AS (
  SELECT DISTINCT order_date, zone_name, round(sum(worked_sec)::DOUBLE / 60.0, 2) AS time_on_shift_min_sum
  FROM shift GROUP BY order_date, zone_name, tenant_id
),
utilisation AS (
  SELECT h.order_date, h.tenant_id, h.zone_name, s.time_on_shift_min_sum, h.handle_time_min_sum, h.ccdd_handle_time_min_sum
  FROM handled_day h LEFT JOIN shift_day s ON s.order_date = h.order_date AND s.zone_name = h.zone_name AND h.tenant_id IS NOT NULL
)"""
