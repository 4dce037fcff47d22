"""M2 - delivery staging: one row per delivered delivery of the tenant in the
window, with its order, zones, restaurant, pool, pay, durations, report
buckets, rejections, assignment and holding-window facts (111 columns).

Shuffle plan (three exchanges of the staging rows, each input read once but for
two columns of the deliveries):
  1. deliveries joined with the order-keyed inputs (orders, pay, reviews, POS)
     on the order id; dimension tables are broadcast by Spark when their
     measured size is under the broadcast threshold;
  2. the delivery-keyed inputs (pool bridge, adjustments, holding window,
     rejections, assignments) on the delivery id, all co-partitioned, plus the
     per-delivery row count that the rejection sums need; the assignment log
     names deliveries by uuid, which is mapped to the id on the log's own,
     narrow side;
  3. the pool statistics and first legs in one window pass on the pool id, with
     unpooled rows spread over many tasks instead of one null-key task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions import dates as D
from ..functions.geo import ring_area_km2
from ..functions.text import COLLECT_TOKEN, UUID_PATTERN, extract_all, is_mcdonalds, token_count
from ..operators.rollup import any_and_count
from ..operators.windows import group_window, latest_per_key, with_group_salt
from ..session import split_wide_code
from ..sources.catalog import Catalog
from .params import ReportParams

# Rejection bridge flag -> name of the flag in the mart.
REJECTION_FLAGS = {
    "is_multi_collect": "is_rejected_as_multi_collect",
    "is_manual_unassigned": "is_manual_unassigned",
    "is_cnmp_unassigned": "is_cnmp_unassigned",
    "is_timer_expired": "is_timer_expired",
    "is_offer_declined": "is_offer_declined",
}
ADJUSTMENT_SUMS = [
    "company_net_adjustment_sum", "na_company_net_adjustment_sum", "nc_total_net_compensation_sum",
    "courier_net_adjustment_sum", "custo_net_adjustment_sum", "na_custo_net_adjustment_sum",
    "nc_custo_net_compensation_sum", "resto_net_adjustment_sum", "na_resto_net_adjustment_sum",
    "nc_resto_net_compensation_sum",
]

# Output columns of the staging rows, in the reference's order.
STAGING_COLUMNS = [
    "order_date", "tenant_id", "timezone", "sys_courier_delivery_zone_id", "delivery_zone_name",
    "sys_zone_group_id", "zone_group_name", "zone_area_square_km",
    "sys_courier_delviery_zone_id_resto", "delivery_zone_name_resto", "zone_area_square_km_resto",
    "sys_courier_id", "sys_delivery_id", "sys_order_id", "order_number", "public_order_number",
    "delivery_created_time_local", "delivery_in_transit_time_local", "collect_assigned_time_local",
    "collect_accepted_time_local", "collect_arrived_time_local", "collect_completed_time_local",
    "delivery_begin_parking_time_local", "ccdd_id", "multi_collect_sequence", "sys_resto_id",
    "resto_type", "sys_custo_id", "delivery_status", "is_multi_collect",
    "is_assigned_by_holding_container", "pooling_in_transit_tag", "handle_time_sec",
    "courier_pay_without_tips_or_courier_adjustments", "courier_pay_without_tips", "food_subtotal",
    "collect_total_driving_time_min", "delivery_total_driving_time_min",
    "collect_total_driving_time_sec_max_ccdd", "ccdd_courier_analysis_handle_time_sec",
    "delivery_total_driving_time_min_previous_leg", "pooling_capacity_gains_sec", "ptod_sec",
    "ptoc_sec", "ctod_sec", "collect_driving_distance_original_kms",
    "delivery_driving_distance_original_kms", "collect_original_total_driving_time_min",
    "deliver_original_total_driving_time_min", "resto_food_prep_min", "resto_delay_requested_min",
    "ptov_sec", "collect_leg_delay_sec", "vtoa_sec", "atoar_sec", "resto_hold_sec",
    "drive_to_custo_sec", "accept_to_drive_to_resto_sec", "accept_to_arrive_at_resto_sec",
    "custo_hold_sec", "end_to_end_time_sec", "in_resto_time_sec", "accept_to_collect_sec",
    "route_time_sec", "collect_delay", "deliver_delay", "is_mcdonalds", "pos_injection_time_utc",
    "pos_fire_into_pos_time_min", "collect_in_transit_time_utc", "is_on_time_order",
    "delivery_completion_slack_bin", "ctod_min_bin", "delivery_driving_distance_original_kms_bin",
    "deliver_original_total_driving_time_min_bin", "is_asap_order", "collect_accessibility_minutes",
    "deliver_accessibility_minutes", "is_score_positive", "time_of_day_group", "day_of_week_local",
    "day_of_week_and_time_of_day_group", *ADJUSTMENT_SUMS,
]
SIDE_COLUMNS = [
    "is_assigned_as_multi_collect",
    "is_rejected_as_multi_collect_count", "is_rejected_as_multi_collect",
    "is_manual_unassigned_count", "is_manual_unassigned",
    "is_cnmp_unassigned_count", "is_cnmp_unassigned",
    "is_timer_expired_count", "is_timer_expired",
    "is_offer_declined_count", "is_offer_declined",
    "first_order_deliver_original_total_driving_time_min", "ptov_min_bin",
    "time_window_start_local", "time_window_end_local", "time_window_end_original_local",
    "planned_holding_window_sec", "actual_holding_window_sec", "actual_vs_planned_diff",
]
MART_COLUMNS = STAGING_COLUMNS + SIDE_COLUMNS

def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


_COLS: dict = {}


def _c(name: str):
    """``F.col(name)``, built once per name and JVM (each Column built from
    Python is a round trip to the JVM; the plan is the same).  The cache
    holds the gateway it was built on, so its key cannot be recycled."""
    from pyspark import SparkContext
    gw = getattr(SparkContext, "_gateway", None)
    key = (id(gw), name)
    hit = _COLS.get(key)
    if hit is None or hit[0] is not gw:
        hit = (gw, F.col(name))
        _COLS[key] = hit
    return hit[1]


def staged_deliveries(cat: Catalog, p: ReportParams) -> DataFrame:
    """The reference's ``delivery_staging`` rows, without the pool columns."""
    start, end = p.window()
    fd = _prefixed(cat["fact_deliveries"]
                   .where((F.col("delivery_status") == "DELIVERED") & (F.col("tenant_id") == p.tenant)),
                   "fd_")
    fo = _prefixed(cat["fact_orders_resto"].where(F.col("order_date").between(start, end)), "fo_")
    fm = _prefixed(cat["fact_order_financial_metrics"], "fm_")
    rr = _prefixed(cat["fact_resto_reviews"], "rr_")
    ij = _prefixed(cat["pos_injection"], "ij_")
    dr = _prefixed(cat["dim_resto"], "dr_")
    crp = _prefixed(cat["dim_resto_grouping"], "crp_")
    zones = cat["dim_zones"].withColumn("area_km2", ring_area_km2(_c("polygon"))).drop("polygon")  # once per zone, not per row
    dz = _prefixed(zones, "dz_")
    cz = _prefixed(zones, "cz_")
    cd = _prefixed(cat["bridge_multi_collect"], "cd_")
    ga = _prefixed(cat["global_adjustments"], "ga_")

    j = (fd.join(fo, _c("fo_sys_order_id") == _c("fd_sys_order_id"), "inner")
           .join(fm, _c("fm_sys_order_id") == _c("fo_sys_order_id"), "left")
           .join(rr, _c("rr_sys_order_id") == _c("fo_sys_order_id"), "left")
           .join(ij, _c("ij_order_id") == _c("fo_sys_order_id"), "left")
           .join(dr, _c("dr_sys_resto_id") == _c("fo_sys_resto_id"), "left")
           .join(crp, _c("crp_sys_resto_id") == _c("dr_sys_resto_id"), "left")
           .join(dz, _c("dz_sys_courier_delivery_zone_id") == _c("fd_sys_courier_delivery_zone_id"), "left")
           .join(cz, _c("cz_sys_courier_delivery_zone_id") == _c("dr_sys_delivery_zone_id"), "left")
           .join(cd, _c("cd_sys_delivery_id") == _c("fd_sys_delivery_id"), "left")
           .join(ga, _c("ga_sys_delivery_id") == _c("fd_sys_delivery_id"), "left"))

    tz = _c("fd_timezone")
    # Each local time is shifted to UTC once (a projection of its own, which
    # Catalyst keeps because the shifts are reused).
    local_times = ["delivery_created_time_local", "collect_accepted_time_local",
                   "collect_in_transit_time_local", "collect_arrived_time_local",
                   "collect_completed_time_local", "delivery_in_transit_time_local",
                   "delivery_arrived_time_local", "delivery_begin_parking_time_local"]
    j = j.select("*", *[D.local_to_utc(_c("fd_" + n), tz).alias("utc_" + n) for n in local_times])

    def u(n):
        return _c("utc_" + n)

    created, accepted = _c("fd_delivery_created_time_local"), _c("fd_collect_accepted_time_local")
    in_transit, arrived = _c("fd_collect_in_transit_time_local"), _c("fd_collect_arrived_time_local")
    completed = _c("fd_collect_completed_time_local")
    asap = _c("fo_is_asap_order") == F.lit(1)
    zero = F.lit(0)
    slack = _c("fd_delivery_completion_slack_min")
    daypart = B.daypart("fd_delivery_created_time_local")

    cols = {
        "order_date": _c("fo_order_date"),
        "tenant_id": _c("fd_tenant_id"),
        "timezone": tz,
        "sys_courier_delivery_zone_id": _c("fd_sys_courier_delivery_zone_id"),
        "delivery_zone_name": _c("dz_name"),
        "sys_zone_group_id": _c("dz_sys_zone_group_id"),
        "zone_group_name": _c("dz_zone_group_name"),
        "zone_area_square_km": _c("dz_area_km2"),
        "sys_courier_delviery_zone_id_resto": _c("cz_sys_courier_delivery_zone_id"),
        "delivery_zone_name_resto": _c("cz_name"),
        "zone_area_square_km_resto": _c("cz_area_km2"),
        "sys_courier_id": _c("fd_sys_courier_id"),
        "sys_delivery_id": _c("fd_sys_delivery_id"),
        "sys_order_id": _c("fo_sys_order_id"),
        "order_number": _c("fo_order_number"),
        "public_order_number": _c("fo_public_order_number"),
        "delivery_created_time_local": created,
        "delivery_in_transit_time_local": _c("fd_delivery_in_transit_time_local"),
        "collect_assigned_time_local": _c("fd_collect_assigned_time_local"),
        "collect_accepted_time_local": accepted,
        "collect_arrived_time_local": arrived,
        "collect_completed_time_local": completed,
        "delivery_begin_parking_time_local": _c("fd_delivery_begin_parking_time_local"),
        "ccdd_id": _c("cd_ccdd_id"),
        "multi_collect_sequence": _c("cd_multi_collect_sequence"),
        "sys_resto_id": _c("fo_sys_resto_id"),
        "resto_type": _c("dr_resto_type"),
        "sys_custo_id": _c("fo_sys_custo_id"),
        "delivery_status": _c("fd_delivery_status"),
        "is_multi_collect": F.coalesce(_c("cd_is_multi_collect"), zero),
        "is_assigned_by_holding_container": _c("cd_is_assigned_by_holding_container"),
        "pooling_in_transit_tag": F.when(_c("cd_multi_collect_in_transit") == 1, F.lit("Assigned In-Transit"))
                                   .otherwise(F.lit("Not Assigned In-Transit")),
        "handle_time_sec": _c("fd_handle_time_sec"),
        "courier_pay_without_tips_or_courier_adjustments":
            F.coalesce(_c("fm_courier_pay_without_tips"), zero)
            - F.coalesce(_c("fm_courier_net_adjustment"), zero),
        "courier_pay_without_tips": F.coalesce(_c("fm_courier_pay_without_tips"), zero).cast("double"),
        "food_subtotal": F.coalesce(_c("fo_food_subtotal"), zero),
        "collect_total_driving_time_min": _c("fd_collect_total_driving_time_min"),
        "delivery_total_driving_time_min": _c("fd_delivery_total_driving_time_min"),
        "ccdd_courier_analysis_handle_time_sec": _c("cd_ccdd_courier_analysis_handle_time_sec"),
        "ptod_sec": _c("fd_ptod_sec"),
        "ptoc_sec": _c("fd_ptoc_sec"),
        "ctod_sec": _c("fd_ctod_sec"),
        "collect_driving_distance_original_kms":
            F.round(_c("fd_collect_driving_distance_original_meters") / F.lit(1000.0), 2),
        "delivery_driving_distance_original_kms":
            F.round(_c("fd_delivery_driving_distance_original_meters") / F.lit(1000.0), 2),
        "collect_original_total_driving_time_min": _c("fd_collect_original_total_driving_time_min"),
        "deliver_original_total_driving_time_min": _c("fd_deliver_original_total_driving_time_min"),
        "resto_food_prep_min": F.coalesce(_c("fo_resto_food_prep_min"), zero),
        "resto_delay_requested_min": F.coalesce(_c("fo_resto_delay_requested_min"), zero),
        "ptov_sec": F.when(asap, F.coalesce(D.boundary_diff(u("collect_accepted_time_local"), u("delivery_created_time_local")), zero)),
        "collect_leg_delay_sec": F.when(asap, F.coalesce(D.boundary_diff(
            D.add_minutes(u("collect_in_transit_time_local"),
                          F.coalesce(_c("fd_collect_accessibility_minutes"), zero)
                          + F.coalesce(_c("fd_collect_original_total_driving_time_min"), zero)),
            D.add_minutes(u("delivery_created_time_local"),
                          F.coalesce(_c("fo_resto_food_prep_min"), zero)
                          + F.coalesce(_c("fo_resto_delay_requested_min"), zero))), zero)),
        "vtoa_sec": F.coalesce(D.boundary_diff(u("collect_in_transit_time_local"), u("collect_accepted_time_local")), zero),
        "atoar_sec": F.coalesce(D.boundary_diff(u("collect_arrived_time_local"), u("collect_in_transit_time_local")), zero),
        "resto_hold_sec": _c("fd_resto_hold_sec"),
        "drive_to_custo_sec": F.coalesce(D.boundary_diff(u("delivery_arrived_time_local"),
                                                         u("delivery_in_transit_time_local")), zero),
        "accept_to_drive_to_resto_sec": D.truncated_ms_sec(u("collect_in_transit_time_local"), u("collect_accepted_time_local")),
        "accept_to_arrive_at_resto_sec": D.truncated_ms_sec(u("collect_arrived_time_local"), u("collect_accepted_time_local")),
        "custo_hold_sec": _c("fd_custo_hold_sec"),
        "end_to_end_time_sec": D.boundary_diff(u("delivery_begin_parking_time_local"), u("delivery_created_time_local")),
        "in_resto_time_sec": D.boundary_diff(u("collect_completed_time_local"), u("collect_arrived_time_local"))
                             - F.lit(2) * (_c("fd_collect_accessibility_minutes") * F.lit(60)),
        "accept_to_collect_sec": D.truncated_ms_sec(completed, accepted),
        "route_time_sec": D.boundary_diff(u("collect_arrived_time_local"), u("delivery_created_time_local")),
        "collect_delay": F.round(F.coalesce(_c("fd_collect_total_driving_time_min"), zero)
                                 - F.coalesce(_c("fd_collect_original_total_driving_time_min"), zero), 0),
        "deliver_delay": F.round(F.coalesce(_c("fd_delivery_total_driving_time_min"), zero)
                                 - F.coalesce(_c("fd_deliver_original_total_driving_time_min"), zero), 0),
        "is_mcdonalds": is_mcdonalds(_c("crp_grouping"), _c("dr_resto_name_short")),
        "pos_injection_time_utc": _c("ij_injection_time").cast("timestamp_ntz"),
        "pos_fire_into_pos_time_min": _c("ij_fire_into_pos_time"),
        "collect_in_transit_time_utc": u("collect_in_transit_time_local"),
        "is_on_time_order": B.on_time_flag("fd_delivery_completion_slack_min"),
        "delivery_completion_slack_bin": B.slack_bin("fd_delivery_completion_slack_min"),
        "ctod_min_bin": B.ctod_bin("fd_ctod_sec"),
        "delivery_driving_distance_original_kms_bin": B.km_bin("fd_delivery_driving_distance_original_meters"),
        "deliver_original_total_driving_time_min_bin": B.drive_bin("fd_deliver_original_total_driving_time_min"),
        "is_asap_order": F.coalesce(_c("fo_is_asap_order"), zero),
        "collect_accessibility_minutes": _c("fd_collect_accessibility_minutes"),
        "deliver_accessibility_minutes": _c("fd_deliver_accessibility_minutes"),
        "is_score_positive": F.coalesce(_c("rr_is_score_positive"), zero),
        "time_of_day_group": daypart,
        "day_of_week_local": F.dayofweek(created).cast("long"),
        "day_of_week_and_time_of_day_group": F.concat(created.cast("string"), daypart),
    }
    for s in ADJUSTMENT_SUMS:
        cols[s] = _c("ga_" + s)
    return j.select(*[c.alias(n) for n, c in cols.items()])


def holding_windows(cat: Catalog) -> DataFrame:
    """Live and archived holding windows, the latest per delivery."""

    def shape(df: DataFrame) -> DataFrame:
        return df.select(
            F.col("delivery_id").alias("sys_delivery_id"),
            "is_in_hold_container",
            F.col("time_window_start").alias("time_window_start_utc"),
            F.col("time_window_end").alias("time_window_end_utc"),
            F.col("time_window_end_original").alias("time_window_end_original_utc"),
            D.boundary_diff(F.col("time_window_end"), F.col("time_window_start")).alias("planned_holding_window_sec"),
            D.boundary_diff(F.col("time_window_end_original"), F.col("time_window_start"))
             .alias("actual_holding_window_sec"))

    both = shape(cat["hold_container_live"]).unionByName(shape(cat["hold_container_archive"]))
    return latest_per_key(both, ["sys_delivery_id"],
                          ["time_window_start_utc", "time_window_end_utc", "time_window_end_original_utc"])


def rejection_flags(cat: Catalog) -> DataFrame:
    """Per delivery: for each rejection flag, the count of true rows and whether any."""
    bc = cat["bridge_blacklisted_couriers"]
    renamed = [F.col(src).alias(dst) for src, dst in REJECTION_FLAGS.items()]
    return bc.select("sys_delivery_id", *renamed).groupBy("sys_delivery_id").agg(
        *any_and_count(list(REJECTION_FLAGS.values())))


def assignment_flags(cat: Catalog) -> DataFrame:
    """Per delivery uuid: 1 if its latest assignment message (per courier) held
    more than one COLLECT job, else 0."""
    log = cat["assignment_log"]
    jobs = F.col("jobChanges.assignedJobs")
    per_job = log.select(
        F.col("courierId").alias("sys_courier_id"),
        F.explode(extract_all(jobs, UUID_PATTERN)).alias("delivery_uuid"),
        F.col("timestamp").alias("ts"),
        (token_count(jobs, COLLECT_TOKEN) > F.lit(1)).alias("assigned_as_multi_collect"))
    # The latest message's flag without sorting the log: the flag is true if the latest time with
    # a true one is not before that with a false one; messages without a time come last of all.
    held = F.col("assigned_as_multi_collect")
    latest = per_job.groupBy("sys_courier_id", "delivery_uuid").agg(
        F.max(F.when(held, F.col("ts"))).alias("__true_at"), F.max(F.when(~held, F.col("ts"))).alias("__false_at"),
        F.max(held).alias("__any"))
    flag = (F.when(F.col("__true_at").isNull() & F.col("__false_at").isNull(), F.col("__any"))
            .otherwise(F.col("__true_at").isNotNull() & (F.col("__false_at").isNull() | (F.col("__true_at") >= F.col("__false_at")))))
    return latest.groupBy("delivery_uuid").agg(F.max(flag.cast("long")).alias("is_assigned_as_multi_collect"))


def assigned_deliveries(cat: Catalog, p: ReportParams) -> DataFrame:
    """:func:`assignment_flags` per delivery id, for the deliveries that can be staged."""
    names = (cat["fact_deliveries"]
             .where((F.col("delivery_status") == "DELIVERED") & (F.col("tenant_id") == p.tenant))
             .select("delivery_uuid", "sys_delivery_id"))
    return (names.join(assignment_flags(cat), "delivery_uuid")
            .groupBy("sys_delivery_id").agg(F.max("is_assigned_as_multi_collect").alias("is_assigned_as_multi_collect")))


def with_pool_columns(df: DataFrame) -> DataFrame:
    """Pool measures of the reference's windows over ``ccdd_id``, for the
    second leg only, and the first leg's predicted drive time for every leg.

    One window pass on the pool id (a pool is a courier's few legs; rows
    outside any pool are spread by hash), so no aggregate-and-join-back and no
    second evaluation of ``df``.  The pool's leg-1 values travel as a list made
    in that pass and are exploded: several leg-1 rows give several output rows,
    none gives one row with null.  The list holds one number for each row that
    the explode makes of the row, so it is never larger than the output.
    """
    pool = group_window("ccdd_id")
    by_leg = pool.orderBy("multi_collect_sequence", "sys_delivery_id")
    seq = F.col("multi_collect_sequence")
    leg2 = seq == F.lit(2)
    first_leg = F.when((seq == F.lit(1)) & F.col("ccdd_id").isNotNull(),  # a struct, so that null values count too
                       F.struct(F.col("deliver_original_total_driving_time_min")
                                 .alias("first_order_deliver_original_total_driving_time_min")))
    windowed = (with_group_salt(df, "ccdd_id", "sys_delivery_id")
                .withColumn("__pool_max_sec", F.max("collect_total_driving_time_min").over(pool) * F.lit(60))
                .withColumn("__first_legs", F.collect_list(first_leg).over(pool))
                .withColumn("__prev_sec", F.lag("delivery_total_driving_time_min", 1).over(by_leg) * F.lit(60)))
    pool_max_sec, prev_sec = F.col("__pool_max_sec"), F.col("__prev_sec")
    zero = F.lit(0.0)
    return (windowed
            .withColumn("collect_total_driving_time_sec_max_ccdd", F.when(leg2, pool_max_sec).otherwise(zero))
            .withColumn("delivery_total_driving_time_min_previous_leg", F.when(leg2, prev_sec).otherwise(zero))
            .withColumn("pooling_capacity_gains_sec",
                        F.when(leg2, pool_max_sec + F.col("ccdd_courier_analysis_handle_time_sec") - prev_sec)
                         .otherwise(zero))
            .drop("__pool_max_sec", "__prev_sec", "__salt")
            .select("*", F.inline_outer("__first_legs"))
            .drop("__first_legs"))


def build(cat: Catalog, p: ReportParams) -> DataFrame:
    split_wide_code(cat.spark)
    ds = staged_deliveries(cat, p)

    # Delivery-keyed side facts.  Rejection sums count once per staging row of
    # the delivery, as the reference's join-then-group does.
    rej = rejection_flags(cat)
    hold = holding_windows(cat).drop("is_in_hold_container")
    side = (ds.join(assigned_deliveries(cat, p), "sys_delivery_id", "left")
              .join(rej, "sys_delivery_id", "left")
              .join(hold, "sys_delivery_id", "left")
              .withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy("sys_delivery_id"))))
    for f in REJECTION_FLAGS.values():
        side = side.withColumn(f"{f}_count", F.col(f"{f}_count") * F.col("__rows"))
        side = side.withColumn(f, F.coalesce(F.col(f), F.lit(0).cast("long")))

    out = with_pool_columns(side)
    tz = F.col("timezone")
    out = (out
           .withColumn("ptov_min_bin", B.ptov_bin("ptov_sec", "is_asap_order"))
           .withColumn("time_window_start_local", D.utc_to_local(F.col("time_window_start_utc"), tz))
           .withColumn("time_window_end_local", D.utc_to_local(F.col("time_window_end_utc"), tz))
           .withColumn("time_window_end_original_local", D.utc_to_local(F.col("time_window_end_original_utc"), tz))
           .withColumn("actual_vs_planned_diff",
                       F.col("actual_holding_window_sec") - F.col("planned_holding_window_sec")))
    return out.select(*MART_COLUMNS)
