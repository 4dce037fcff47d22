"""M5 - refund detail per delivery, and its two rollups: M6 refunds summary
(distinct orders by refund kind) and M7 order counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions import dates as D
from ..functions.text import (DELIVERY_SERVICE_WORD, FOOD_QUALITY_LIKES, FOOD_QUALITY_WORD,
                              LATE_ORDER_LIKES, MISSING_ITEM_WORDS, contains_any_ci, contains_ci,
                              is_mcdonalds, like_any)
from ..operators.rollup import contact_flag, distinct_counts, refund_rollup
from ..operators.windows import dense_and_row_number, hour_of
from ..sources.catalog import Catalog
from .params import ReportParams

DETAIL_COLUMNS = [
    "payment_sequence", "payment_sequence_dense_rank", "non_dup_record_flag",
    "tenant_id", "sys_courier_delivery_zone_id", "sys_order_id", "order_date", "ctod_sec", "payment_utc",
    "is_multi_collect", "deliver_original_total_driving_time_min", "rejections", "late_order_contacts",
    "food_quality_contacts", "voucher_refunds_issued_total_amount", "voucher_refund_reason",
    "multi_collect_sequence", "accept_to_collect_sec", "accept_to_drive_to_rest_sec",
    "accept_to_arrive_at_rest_sec", "arrive_at_rest_to_collect_sec", "resto_hold_sec",
    "delivery_zone_name", "delivery_status", "is_on_time_order", "delivery_completion_slack_bin",
    "is_asap_order", "delivery_begin_parking_time_local", "del_key", "resto_type", "is_mcdonalds",
    "record_rank",
]

SUMMARY_KEYS = [
    "tenant_id", "sys_courier_delivery_zone_id", "delivery_zone_name", "resto_type", "is_multi_collect",
    "multi_collect_sequence", "is_mcdonalds", "delivery_status", "is_on_time_order",
    "delivery_completion_slack_bin", "is_asap_order", "is_negative_company_net_adjustment",
    "has_begin_parking_time", "payment_sequence_dense_rank", "deliver_original_total_driving_time_min",
    "ctod_min",
]
COUNT_KEYS = [
    "tenant_id", "order_date", "sys_courier_delivery_zone_id", "delivery_zone_name", "resto_type",
    "is_multi_collect", "multi_collect_sequence", "is_mcdonalds", "delivery_status", "is_on_time_order",
    "delivery_completion_slack_bin", "is_asap_order", "is_negative_company_net_adjustment",
    "has_begin_parking_time", "voucher_refund_reason", "payment_sequence",
]


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def contacts(cat: Catalog, p: ReportParams, likes, name: str) -> DataFrame:
    """Per order number: 1 if a ticket of the matching query types (country,
    window) has a ticket id."""
    start, end = p.refunds_window()
    t = cat["tickets"].select(
        F.col("orders.order_id_local").alias("order_id_local"),
        F.col("ticket.ticket_id_local").alias("ticket_id_local"),
        F.col("ticket.query_type").alias("query_type"),
        F.col("order_date.order_date_local").alias("order_date_local"),
        F.col("company.country_code").alias("country_code"))
    t = t.where(F.col("order_date_local").between(start, end)
                & (F.col("country_code") == p.contact_country)
                & like_any(F.col("query_type"), likes))
    return contact_flag(t, "order_id_local", "ticket_id_local", name)


def refund_detail(cat: Catalog, p: ReportParams) -> DataFrame:
    start, end = p.refunds_window()
    fd = _prefixed(cat["fact_deliveries"].where(
        (F.col("delivery_status") == "DELIVERED") & (F.col("tenant_id") == p.tenant)
        # a datetime against dates: only midnight of the last day passes
        & F.col("delivery_created_time_local").between(start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))),
        "fd_")
    fo = _prefixed(cat["fact_orders_resto"].where(
        (F.col("tenant_id") == p.tenant) & F.col("order_date").between(start, end)), "fo_")
    dr = _prefixed(cat["dim_resto"], "dr_")
    cd = _prefixed(cat["bridge_multi_collect"], "cd_")
    dz = _prefixed(cat["dim_zones"], "dz_")
    crp = _prefixed(cat["dim_resto_grouping"], "crp_")
    na = _prefixed(refund_rollup(cat["fact_order_net_adjustments"].where(F.col("tenant_id") == p.tenant),
                                 "sys_order_id", "scenario", "company_net_adjustment",
                                 "all_scenarios", "total_company_net_adjustment", 3), "na_")
    rj = _prefixed(cat["bridge_blacklisted_couriers"].where(F.col("tenant_id") == p.tenant)
                   .groupBy("sys_delivery_id").agg(F.count_distinct("sys_courier_id").alias("rejections")),
                   "rj_")
    loc = _prefixed(contacts(cat, p, LATE_ORDER_LIKES, "late_order_contact"), "loc_")
    fqc = _prefixed(contacts(cat, p, FOOD_QUALITY_LIKES, "food_quality_contact"), "fqc_")

    c = F.col
    j = (fd.join(fo, c("fo_sys_order_id") == c("fd_sys_order_id"), "inner")
           .join(na, c("na_sys_order_id") == c("fd_sys_order_id"), "left")
           .join(loc, c("loc_order_id_local") == c("fo_public_order_number"), "left")
           .join(fqc, c("fqc_order_id_local") == c("fo_public_order_number"), "left")
           .join(cd, c("cd_sys_delivery_id") == c("fd_sys_delivery_id"), "left")
           .join(rj, c("rj_sys_delivery_id") == c("fd_sys_delivery_id"), "left")
           .join(dr, c("dr_sys_resto_id") == c("fd_sys_resto_id"), "left")
           .join(crp, c("crp_sys_resto_id") == c("dr_sys_resto_id"), "left")
           .join(dz, c("dz_sys_courier_delivery_zone_id") == c("fd_sys_courier_delivery_zone_id"), "left"))

    accepted, completed = c("fd_collect_accepted_time_local"), c("fd_collect_completed_time_local")
    in_transit, arrived = c("fd_collect_in_transit_time_local"), c("fd_collect_arrived_time_local")
    slack = c("fd_delivery_completion_slack_min")
    cols = {
        "tenant_id": c("fd_tenant_id"),
        "sys_courier_delivery_zone_id": c("fd_sys_courier_delivery_zone_id"),
        "sys_order_id": c("fo_sys_order_id"),
        "order_date": c("fo_order_date"),
        "ctod_sec": c("fd_ctod_sec"),
        # DATETIME(TIMESTAMP(x, "UTC")) keeps the wall time as it is
        "payment_utc": c("fd_delivery_created_time_local"),
        "is_multi_collect": c("cd_is_multi_collect"),
        "deliver_original_total_driving_time_min": c("fd_deliver_original_total_driving_time_min"),
        "rejections": F.coalesce(c("rj_rejections"), F.lit(0).cast("long")),
        "late_order_contacts": F.coalesce(c("loc_late_order_contact"), F.lit(0)),
        "food_quality_contacts": F.coalesce(c("fqc_food_quality_contact"), F.lit(0)),
        "voucher_refunds_issued_total_amount": c("na_total_company_net_adjustment"),
        "voucher_refund_reason": c("na_all_scenarios"),
        "multi_collect_sequence": c("cd_multi_collect_sequence"),
        "accept_to_collect_sec": D.truncated_ms_sec(completed, accepted),
        "accept_to_drive_to_rest_sec": D.truncated_ms_sec(in_transit, accepted),
        "accept_to_arrive_at_rest_sec": D.truncated_ms_sec(arrived, accepted),
        "arrive_at_rest_to_collect_sec": D.truncated_ms_sec(completed, arrived),
        "resto_hold_sec": c("fd_resto_hold_sec"),
        "delivery_zone_name": c("dz_name"),
        "delivery_status": c("fd_delivery_status"),
        "is_on_time_order": B.on_time_flag("fd_delivery_completion_slack_min"),
        "delivery_completion_slack_bin": B.slack_bin("fd_delivery_completion_slack_min"),
        "is_asap_order": F.coalesce(c("fo_is_asap_order"), F.lit(0)),
        "delivery_begin_parking_time_local": c("fd_delivery_begin_parking_time_local"),
        "del_key": F.when(c("cd_sys_delivery_id").isNotNull(), c("cd_ccdd_id")).otherwise(c("fd_sys_delivery_id")),
        "resto_type": c("dr_resto_type"),
        "is_mcdonalds": is_mcdonalds(c("crp_grouping"), c("dr_resto_name_short")),
    }
    lvl1 = j.select(*[v.alias(k) for k, v in cols.items()])
    # ROW_NUMBER() OVER (PARTITION BY order) has no order in the reference;
    # payment time, then pool/delivery key and leg make it repeatable.
    rank_w = Window.partitionBy("sys_order_id").orderBy("payment_utc", "del_key", "multi_collect_sequence")
    lvl1 = lvl1.withColumn("record_rank", F.row_number().over(rank_w).cast("long"))
    # payment_sequence restarts per record_rank; the dense rank does not, and
    # orders by payment time only (equal times share a rank).
    seq = dense_and_row_number(lvl1, ["del_key"], ["record_rank"], [F.col("payment_utc")],
                               "payment_sequence", "payment_sequence_dense_rank",
                               bucket=hour_of("payment_utc"), row_tiebreak=[F.col("sys_order_id")])
    seq = seq.withColumn("non_dup_record_flag", F.col("record_rank") == F.lit(1))
    return seq.select(*DETAIL_COLUMNS)


def _summary_keys(detail: DataFrame) -> DataFrame:
    return (detail
            .withColumn("is_negative_company_net_adjustment",
                        F.when(F.col("voucher_refunds_issued_total_amount") < 0, F.lit(1)).otherwise(F.lit(0)))
            .withColumn("has_begin_parking_time",
                        F.when(F.col("delivery_begin_parking_time_local").isNotNull(), F.lit(1)).otherwise(F.lit(0))))


def refunds_summary(detail: DataFrame, p: ReportParams) -> DataFrame:
    reason = F.col("voucher_refund_reason")
    keyed = _summary_keys(detail.where(F.col("tenant_id") == p.tenant)).withColumn(
        "ctod_min", B.ctod_text(F.col("ctod_sec")))
    return distinct_counts(keyed, SUMMARY_KEYS, "sys_order_id", [
        ("delivered_orders", None),
        ("md_orders", F.col("is_multi_collect") == 1),
        ("orders_w_food_quality_refund", contains_ci(reason, FOOD_QUALITY_WORD)),
        ("orders_w_delivery_service_refund", contains_ci(reason, DELIVERY_SERVICE_WORD)),
        ("orders_w_missing_item_refund", contains_any_ci(reason, MISSING_ITEM_WORDS)),
    ])


def order_counts(detail: DataFrame, p: ReportParams) -> DataFrame:
    keyed = _summary_keys(detail.where(F.col("tenant_id") == p.tenant))
    return keyed.groupBy(*COUNT_KEYS).agg(F.count_distinct("sys_order_id").alias("delivered_orders"))
