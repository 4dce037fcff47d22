"""DuckDB SQL deriving the delivery domain tables from the driver's tables.

Written independently of the Spark adapter, from the rules in FIXTURES.md
section 3, so that the oracle checks the Spark code rather than repeating it.
Every oracle query starts with ``PRELUDE`` and adds its own CTEs after it.
"""

TENANT_LIST = "['ie', 'uk', 'ca', 'au', 'nz']"
ZONE_LIST = "['Europe/Dublin', 'Europe/London', 'America/Toronto', 'Australia/Sydney', 'Pacific/Auckland']"


def _uuid(x: str) -> str:
    h = f"md5(CAST({x} AS VARCHAR))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12))")


PRELUDE = f"""
WITH
d_lines AS (
  SELECT l_orderkey,
         CAST(sum(l_partkey % 7 - 3) AS DOUBLE) / 2 AS company_net_adjustment_sum,
         CAST(sum(l_partkey % 5) AS DOUBLE) / 4 AS na_company_net_adjustment_sum,
         CAST(sum(l_suppkey % 3) AS DOUBLE) / 2 AS nc_total_net_compensation_sum,
         CAST(sum(l_suppkey % 5 - 2) AS DOUBLE) / 4 AS courier_net_adjustment_sum,
         CAST(sum(-(l_partkey % 3)) AS DOUBLE) / 2 AS custo_net_adjustment_sum,
         CAST(sum(l_linenumber % 2) AS DOUBLE) / 2 AS na_custo_net_adjustment_sum,
         CAST(sum(l_linenumber % 3) AS DOUBLE) / 4 AS nc_custo_net_compensation_sum,
         CAST(sum(l_partkey % 4 - 1) AS DOUBLE) / 2 AS resto_net_adjustment_sum,
         CAST(sum(l_suppkey % 4) AS DOUBLE) / 4 AS na_resto_net_adjustment_sum,
         CAST(sum(l_partkey % 6) AS DOUBLE) / 2 AS nc_resto_net_compensation_sum
  FROM lineitem GROUP BY l_orderkey
),
d_base0 AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
         CAST(c.c_nationkey AS BIGINT) AS nk,
         {TENANT_LIST}[c.c_nationkey % 5 + 1] AS tenant_id,
         {ZONE_LIST}[c.c_nationkey % 5 + 1] AS timezone,
         CASE WHEN o.o_orderkey % 59 <> 7 THEN o.o_orderkey * 7 % (SELECT count(*) FROM supplier) END AS resto_id,
         o.o_orderdate + to_seconds(o.o_orderkey * 7919 % 86400) AS created
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
d_base1 AS (
  SELECT *, created + to_seconds((k * 17 % 400) // 2) AS assigned,
         created + to_seconds(k * 17 % 400) + to_milliseconds(k * 7 % 1000) AS accepted
  FROM d_base0
),
d_base2 AS (SELECT *, accepted + to_seconds(k * 19 % 200) AS c_in_transit FROM d_base1),
d_base3 AS (SELECT *, c_in_transit + to_seconds(k * 23 % 900) + to_milliseconds(k * 11 % 1000) AS c_arrived FROM d_base2),
d_base4 AS (SELECT *, c_arrived + to_seconds(k * 29 % 600) AS c_completed FROM d_base3),
d_base5 AS (SELECT *, c_completed + to_seconds(k * 31 % 120) AS d_in_transit FROM d_base4),
d_base AS (SELECT *, d_in_transit + to_seconds(k * 41 % 1500) AS d_arrived FROM d_base5),
fact_orders_resto AS (
  SELECT tenant_id, k AS sys_order_id,
         CASE WHEN k % 97 = 0 THEN NULL ELSE o_custkey END AS sys_custo_id,
         resto_id AS sys_resto_id,
         CAST(o_orderdate AS DATE) AS order_date,
         created AS order_datetime,
         'ORD-' || CAST(k AS VARCHAR) AS order_number,
         k AS public_order_number,
         CAST(floor(o_totalprice * 100) AS BIGINT) AS food_subtotal,
         CAST(CASE WHEN k % 8 = 0 THEN NULL WHEN k % 4 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS is_asap_order,
         CAST(CASE WHEN k % 11 = 0 THEN NULL ELSE k % 20 + 5 END AS BIGINT) AS resto_food_prep_min,
         CAST(CASE WHEN k % 3 = 0 THEN k % 7 END AS BIGINT) AS resto_delay_requested_min
  FROM d_base
),
fact_deliveries AS (
  SELECT tenant_id, timezone, k + 1000000 AS sys_delivery_id,
         {_uuid('k + 1000000')} AS delivery_uuid,
         k AS sys_order_id, resto_id AS sys_resto_id,
         k * 13 % 211 AS sys_courier_id,
         nk AS sys_courier_delivery_zone_id,
         CASE WHEN o_orderstatus = 'P' THEN 'CANCELLED' ELSE 'DELIVERED' END AS delivery_status,
         created AS delivery_created_time_local,
         d_in_transit AS delivery_in_transit_time_local,
         d_arrived AS delivery_arrived_time_local,
         CASE WHEN k % 53 <> 0 THEN d_arrived + to_seconds(k * 37 % 1800) END AS delivery_begin_parking_time_local,
         assigned AS collect_assigned_time_local,
         accepted AS collect_accepted_time_local,
         CASE WHEN k % 59 <> 0 THEN c_in_transit END AS collect_in_transit_time_local,
         c_arrived AS collect_arrived_time_local,
         c_completed AS collect_completed_time_local,
         CASE WHEN k % 17 <> 0 THEN k * 67 % 3600 END AS handle_time_sec,
         k * 71 % 3000 AS ptod_sec,
         k * 73 % 1800 AS ptoc_sec,
         k * 47 % 2400 - 60 AS ctod_sec,
         k * 79 % 600 AS resto_hold_sec,
         k * 83 % 300 AS custo_hold_sec,
         CAST(k * 59 % 104 AS DOUBLE) / 4 AS collect_total_driving_time_min,
         CAST(k * 61 % 72 AS DOUBLE) / 4 AS delivery_total_driving_time_min,
         CAST(k * 43 % 20 AS DOUBLE) AS collect_original_total_driving_time_min,
         CAST(k * 29 % 100 AS DOUBLE) / 4 AS deliver_original_total_driving_time_min,
         CAST(k * 31 % 900 * 10 AS DOUBLE) AS collect_driving_distance_original_meters,
         CAST(k * 53 % 2600 * 10 AS DOUBLE) AS delivery_driving_distance_original_meters,
         CASE WHEN k % 13 <> 0 THEN k % 4 END AS collect_accessibility_minutes,
         k % 3 AS deliver_accessibility_minutes,
         CASE WHEN k % 19 <> 0 THEN CAST(k * 43 % 120 - 16 AS DOUBLE) / 2 END AS delivery_completion_slack_min
  FROM d_base
),
dim_zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS sys_courier_delivery_zone_id,
         CAST(n_nationkey AS BIGINT) AS sys_delivery_zone_id,
         n_name AS name,
         CASE WHEN n_nationkey % 7 = 0 THEN 'SAT - ' || n_name ELSE n_name END AS zone_name,
         CAST(n_regionkey AS BIGINT) AS sys_zone_group_id,
         r_name AS zone_group_name,
         [{{'lon': CAST(n_nationkey AS DOUBLE), 'lat': 40.0}},
          {{'lon': CAST(n_nationkey AS DOUBLE) + 0.1, 'lat': 40.0}},
          {{'lon': CAST(n_nationkey AS DOUBLE) + 0.1, 'lat': 40.1}},
          {{'lon': CAST(n_nationkey AS DOUBLE), 'lat': 40.1}},
          {{'lon': CAST(n_nationkey AS DOUBLE), 'lat': 40.0}}] AS polygon
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
dim_resto AS (
  SELECT s_suppkey AS sys_resto_id, CAST(s_nationkey AS BIGINT) AS sys_delivery_zone_id,
         ['Restaurant', 'Grocery', 'Convenience'][s_suppkey % 3 + 1] AS resto_type,
         CASE WHEN s_suppkey % 6 = 0 THEN 'McDonalds ' || s_name
              WHEN s_suppkey % 6 = 1 THEN 'McDonald' || s_name ELSE s_name END AS resto_name_short
  FROM supplier
),
dim_resto_grouping AS (
  SELECT s_suppkey AS sys_resto_id,
         CASE WHEN s_suppkey % 5 = 0 THEN 'McDonald%s' WHEN s_suppkey % 5 = 1 THEN 'McDonalds'
              ELSE 'Independent' END AS "grouping"
  FROM supplier WHERE s_suppkey % 2 = 0
),
bridge_multi_collect AS (
  SELECT o_orderkey + 1000000 AS sys_delivery_id,
         o_orderkey // 2 AS ccdd_id,
         o_orderkey % 2 + 1 AS multi_collect_sequence,
         CASE WHEN (o_orderkey // 2) % 9 = 3 THEN 0 ELSE 1 END AS is_multi_collect,
         CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS multi_collect_in_transit,
         CASE WHEN (o_orderkey // 2) % 4 = 0 THEN 1 ELSE 0 END AS is_assigned_by_holding_container,
         o_orderkey * 71 % 900 AS ccdd_courier_analysis_handle_time_sec
  FROM orders WHERE (o_orderkey // 2) % 3 = 0
),
fact_order_financial_metrics AS (
  SELECT o_orderkey AS sys_order_id,
         CAST(o_orderkey * 89 % 2000 AS DOUBLE) / 4 AS courier_pay_without_tips,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey * 97 % 200 - 100 AS DOUBLE) / 4 END AS courier_net_adjustment
  FROM orders WHERE o_orderkey % 10 <> 9
),
fact_resto_reviews AS (
  SELECT o_orderkey AS sys_order_id, CAST(o_orderkey % 2 AS INTEGER) AS is_score_positive
  FROM orders WHERE o_orderkey % 5 = 0
),
global_adjustments AS (
  SELECT l_orderkey + 1000000 AS sys_delivery_id, * EXCLUDE (l_orderkey) FROM d_lines
),
pos_injection AS (
  SELECT k AS order_id, created + to_seconds(k % 120) AS injection_time, k % 15 AS fire_into_pos_time
  FROM d_base WHERE k % 7 <> 0
),
assignment_log AS (
  SELECT k * 13 % 211 AS courierId, created + INTERVAL 10 SECOND AS "timestamp",
         'COLLECT:' || {_uuid('k + 1000000')} ||
         CASE WHEN k % 2 = 0 THEN ';COLLECT:' || {_uuid('k + 1000001')} ELSE '' END AS assignedJobs
  FROM d_base WHERE k % 4 <> 3
  UNION ALL
  SELECT k * 13 % 211, created + INTERVAL 20 SECOND, 'COLLECT:' || {_uuid('k + 1000000')}
  FROM d_base WHERE k % 3 = 0
),
bridge_blacklisted_couriers AS (
  SELECT {TENANT_LIST}[l_suppkey % 5 + 1] AS tenant_id,
         l_orderkey + 1000000 AS sys_delivery_id,
         l_suppkey AS sys_courier_id,
         l_linestatus = 'F' AS is_multi_collect,
         l_linenumber % 2 = 0 AS is_manual_unassigned,
         l_linenumber % 3 = 0 AS is_cnmp_unassigned,
         l_linenumber % 4 = 0 AS is_timer_expired,
         l_linenumber % 5 = 0 AS is_offer_declined
  FROM lineitem WHERE l_returnflag = 'R'
),
hold_container_live AS (
  SELECT o_orderkey + 1000000 AS delivery_id, o_orderkey % 4 = 0 AS is_in_hold_container,
         o_orderdate + to_seconds(o_orderkey * 11 % 5000) AS time_window_start,
         o_orderdate + to_seconds(o_orderkey * 11 % 5000) + to_seconds(o_orderkey * 7 % 600) AS time_window_end,
         o_orderdate + to_seconds(o_orderkey * 11 % 5000) + to_seconds(o_orderkey * 5 % 900) AS time_window_end_original
  FROM orders WHERE o_orderkey % 6 = 0
),
hold_container_archive AS (
  SELECT o_orderkey + 1000000 AS delivery_id, o_orderkey % 4 = 0 AS is_in_hold_container,
         o_orderdate + to_seconds(o_orderkey * 13 % 5000 + 1) AS time_window_start,
         o_orderdate + to_seconds(o_orderkey * 13 % 5000 + 1) + to_seconds(o_orderkey * 3 % 600) AS time_window_end,
         o_orderdate + to_seconds(o_orderkey * 13 % 5000 + 1) + to_seconds(o_orderkey * 11 % 900) AS time_window_end_original
  FROM orders WHERE o_orderkey % 12 = 0 OR o_orderkey % 6 = 3
),
ticket_heads AS (
  SELECT conv_id,
         CASE WHEN conv_id % 8 <> 7 THEN CAST(conv_id * 3 AS VARCHAR) END AS ticket_order_id_local,
         CASE WHEN conv_id % 4 = 3 THEN 'originator_agent' ELSE 'originator_customer' END AS contact_origin,
         ['origin_offline', 'origin_self_serve_offline', 'origin_web'][conv_id % 3 + 1] AS ticket_origin,
         CASE WHEN conv_id % 10 <> 9 THEN CAST(conv_id AS VARCHAR) END AS ticket_id_local,
         ['rds_late_delivery', 'late_order_refund', 'food_quality_issue', 'quality_of_food_bad',
          'missing_item', 'other'][conv_id % 6 + 1] AS query_type,
         conv_id * 3 AS order_id_local,
         DATE '1995-01-01' + CAST(conv_id * 5 % 2400 AS INTEGER) AS order_date_local,
         CASE WHEN conv_id % 5 = 4 THEN 'UK' ELSE 'IE' END AS country_code
  FROM (SELECT DISTINCT conv_id FROM conversations)
),
ticket_chats AS (
  SELECT conv_id, CAST(turn AS VARCHAR) AS chat FROM conversations WHERE role = 'user' AND turn % 4 = 2
),
ticket_calls AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS call_segment_id
  FROM conversations WHERE role = 'assistant' AND turn % 3 = 1
),
fact_order_net_adjustments AS (
  SELECT {TENANT_LIST}[l_partkey % 5 + 1] AS tenant_id, l_orderkey AS sys_order_id,
         CASE WHEN l_linenumber % 4 = 0 THEN 'FOOD_QUALITY' WHEN l_linenumber % 4 = 1 THEN 'DELIVERY_SERVICE'
              WHEN l_linenumber % 4 = 2 THEN 'missing_incorrect_items'
              ELSE l_returnflag || l_linestatus END AS scenario,
         CAST(-floor(l_discount * l_extendedprice) AS DOUBLE) AS company_net_adjustment
  FROM lineitem
),
bridge_shift_delivery AS (
  SELECT o_orderkey + 1000000 AS sys_delivery_id FROM orders WHERE o_orderkey % 10 <> 7
),
dim_courier_shifts AS (
  SELECT {TENANT_LIST}[(nk + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END) % 5 + 1] AS tenant_id,
         CAST(o_orderdate AS DATE) AS start_date,
         k * 13 % 211 AS sys_courier_id,
         nk AS delivery_zone_id,
         k * 61 % 7200 + 14400 AS shift_time_sec,
         CASE WHEN k % 2 <> 0 THEN k * 67 % 600 END AS dnu_time_sec
  FROM d_base WHERE k % 3 = 0
),
dim_couriers AS (SELECT s_suppkey AS sys_courier_id FROM supplier)
"""
