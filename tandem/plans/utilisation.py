"""M8 - courier utilisation: per order date x zone name x tenant, handling
minutes (plain and pool-adjusted) beside the minutes couriers were on shift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SATELLITE_ZONE_LIKE
from ..sources.catalog import Catalog
from .params import ReportParams


def handled_minutes(cat: Catalog, p: ReportParams) -> DataFrame:
    """Delivered deliveries on a shift, all tenants, by date, zone name and tenant."""
    start, end = p.window()
    fo = cat["fact_orders_resto"].where(F.col("order_date").between(start, end)) \
        .select("sys_order_id", "order_date", "tenant_id")
    fd = cat["fact_deliveries"].where(F.col("delivery_status") == "DELIVERED") \
        .select("sys_order_id", "sys_delivery_id", "sys_courier_delivery_zone_id", "handle_time_sec")
    on_shift = cat["bridge_shift_delivery"].select("sys_delivery_id")
    dz = cat["dim_zones"].select(F.col("sys_delivery_zone_id"), "zone_name")
    pools = cat["bridge_multi_collect"].select(
        "sys_delivery_id", F.col("is_multi_collect").alias("__pool_flag"),
        F.col("ccdd_courier_analysis_handle_time_sec").alias("__pool_handle"))
    rows = (fo.join(fd, "sys_order_id", "inner")
              .join(on_shift, "sys_delivery_id", "inner")
              .join(dz, F.col("sys_courier_delivery_zone_id") == F.col("sys_delivery_zone_id"), "inner")
              .join(pools, "sys_delivery_id", "left"))
    pooled = F.coalesce(F.col("__pool_flag"), F.lit(0)) == 1
    handle = F.when(pooled, F.col("__pool_handle")).otherwise(F.col("handle_time_sec"))
    return rows.groupBy("order_date", "zone_name", "tenant_id").agg(
        F.round(F.sum("handle_time_sec") / F.lit(60.0), 2).alias("handle_time_min_sum"),
        F.round(F.sum(handle) / F.lit(60.0), 2).alias("ccdd_handle_time_min_sum"))


def shift_minutes(cat: Catalog, p: ReportParams) -> DataFrame:
    """Minutes on shift (less time not in use) by tenant, shift date and zone name."""
    start, end = p.window()
    shifts = cat["dim_courier_shifts"].where(F.col("start_date").between(start, end))
    couriers = cat["dim_couriers"].select("sys_courier_id")
    dz = cat["dim_zones"].select(F.col("sys_delivery_zone_id").alias("__zone"), "zone_name")
    rows = (shifts.join(couriers, "sys_courier_id", "left")
                  .join(dz, F.col("delivery_zone_id") == F.col("__zone"), "left"))
    on_shift = F.col("shift_time_sec") - F.coalesce(F.col("dnu_time_sec"), F.lit(0))
    return rows.groupBy("tenant_id", F.col("start_date").alias("courier_shift_start_date"), "zone_name").agg(
        F.round(F.sum(on_shift) / F.lit(60.0), 2).alias("time_on_shift_min_sum"))


def build(cat: Catalog, p: ReportParams, match_tenant: bool = False) -> DataFrame:
    """The reference joins shifts to deliveries on zone and date only: its
    tenant condition compares the delivery tenant with itself, so it only
    drops rows whose tenant is null.  ``match_tenant=True`` joins on tenant too."""
    d = handled_minutes(cat, p).alias("d")
    w = shift_minutes(cat, p).alias("w")
    cond = (F.col("d.zone_name") == F.col("w.zone_name")) \
        & (F.col("d.order_date") == F.col("w.courier_shift_start_date"))
    cond = cond & ((F.col("d.tenant_id") == F.col("w.tenant_id")) if match_tenant
                   else F.col("d.tenant_id").isNotNull())
    out = d.join(w, cond, "left").where(~F.col("d.zone_name").like(SATELLITE_ZONE_LIKE)).select(
        F.col("d.order_date").alias("order_date"), F.col("d.tenant_id").alias("tenant_id"),
        F.col("d.zone_name").alias("zone_name"), F.col("w.time_on_shift_min_sum").alias("time_on_shift_min_sum"),
        F.col("d.handle_time_min_sum").alias("handle_time_min_sum"),
        F.col("d.ccdd_handle_time_min_sum").alias("ccdd_handle_time_min_sum"))
    return out.dropDuplicates()
