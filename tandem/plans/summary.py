"""M4 - pooling summary: the staged deliveries rolled up to 31 report keys
with 53 measures (timings in minutes, pay and adjustments in local money and
in euros, rejections, repeat orders, review scores).

Inputs are the staging mart (M2), the repeat-order mart (M1), the ticket
mart (M3), the rejection bridge and the constant euro-rate table.  Every
side input is keyed by delivery id and brought to one row per delivery (with
the number of rows it stands for), so the staging rows are shuffled once for
all of those joins (not at all if the marts are stored by delivery id) and
never multiplied by them.

The distinct counts need no copies of the rows: rows are first totalled per
(keys, delivery) where they lie, which makes the delivery counts plain counts.
Only the repeat orders' ids are then exploded, and only those that exist, to
be counted once per (keys, ordinal, id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators.rollup import wide_rollup, with_euro_rate
from ..operators.windows import group_window, latest_per_key, with_group_salt
from ..session import split_wide_code
from ..sources.catalog import Catalog
from .reorders import ORDINALS

GROUP_KEYS = [
    "order_date", "time_of_day_group", "day_of_week_local", "tenant_id",
    "sys_courier_delivery_zone_id", "delivery_zone_name", "sys_zone_group_id", "zone_group_name",
    "resto_type", "is_multi_collect", "is_assigned_by_holding_container", "pooling_in_transit_tag",
    "multi_collect_sequence", "is_mcdonalds", "delivery_status", "is_on_time_order",
    "delivery_completion_slack_bin", "ctod_min_bin", "ptov_min_bin",
    "delivery_driving_distance_original_kms_bin", "deliver_original_total_driving_time_min_bin",
    "is_asap_order", "is_rejected_as_multi_collect", "is_assigned_as_multi_collect",
    "is_manual_unassigned", "is_cnmp_unassigned", "is_timer_expired", "is_offer_declined",
    "is_negative_company_net_adjustment", "has_begin_parking_time", "has_ticket",
]

# Sums reported in minutes: output name -> staging column in seconds.
MINUTE_SUMS = [
    ("handle_time_mins_sum", "handle_time_sec"),
    ("pooling_second_order_handle_time_min_sum", "ccdd_courier_analysis_handle_time_sec"),
    ("collect_total_driving_time_saved_min_sum", "collect_total_driving_time_sec_max_ccdd"),
    ("route_time_min_sum", "route_time_sec"),
    ("pooling_capacity_gains_mins_sum", "pooling_capacity_gains_sec"),
    ("ptod_mins_sum", "ptod_sec"),
    ("ptoc_mins_sum", "ptoc_sec"),
    ("ctod_mins_sum", "ctod_sec"),
    ("ptov_mins_sum", "ptov_sec"),
    ("pooling_kpi_mins_sum", "pooling_kpi_sec"),
    ("resto_hold_mins_sum", "resto_hold_sec"),
    ("in_resto_time_mins_sum", "in_resto_time_sec"),
    ("accept_to_collect_mins_sum", "accept_to_collect_sec"),
    ("accept_to_drive_to_resto_mins_sum", "accept_to_drive_to_resto_sec"),
    ("accept_to_arrive_at_resto_mins_sum", "accept_to_arrive_at_resto_sec"),
]
POOL_TIME = "pooling_kpi_sec"
LOCAL_SUMS = [
    ("collect_delay_mins_sum", "collect_delay"),
    ("courier_pay_without_tips_sum", "courier_pay_without_tips"),
    ("courier_pay_without_tips_or_courier_adjustments_sum", "courier_pay_without_tips_or_courier_adjustments"),
]
ADJUSTMENTS = ["company_net_adjustment_sum", "courier_net_adjustment_sum", "custo_net_adjustment_sum",
               "resto_net_adjustment_sum"]


def _z(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def rejection_counts(cat: Catalog) -> DataFrame:
    """Distinct rejecting couriers per delivery."""
    bc = cat["bridge_blacklisted_couriers"]
    return bc.groupBy("sys_delivery_id").agg(F.count_distinct("sys_courier_id").alias("rejections_count"))


POOL_TIMES = ["assignment_time_gap_sec", "accepted_time_gap_sec", POOL_TIME]


def with_pooling_kpi(ds: DataFrame) -> DataFrame:
    """Per staging row its delivery, its pool, the gaps to the previous leg's
    assignment and acceptance, and the time from the pool's first drive-off
    (its first pooled leg) to this leg's parking, in UTC.

    Only the columns used here pass the window on the pool id (unpooled rows
    spread by hash; they have no times, as in the reference's joins).
    """
    pool = group_window("ccdd_id")
    by_leg = pool.orderBy("multi_collect_sequence", "sys_delivery_id", "collect_assigned_time_local",
                          "collect_accepted_time_local")
    pooled = F.col("ccdd_id").isNotNull()
    lead_leg = (F.col("is_multi_collect") == 1) & (F.col("multi_collect_sequence") == 1)
    narrow = ds.select("sys_delivery_id", "ccdd_id", "is_multi_collect", "multi_collect_sequence", "timezone",
                       "collect_assigned_time_local", "collect_accepted_time_local",
                       "delivery_in_transit_time_local", "delivery_begin_parking_time_local")
    w = (with_group_salt(narrow, "ccdd_id", "sys_delivery_id")
         .withColumn("__first_drive", F.min(F.when(lead_leg, F.col("delivery_in_transit_time_local"))).over(pool))
         .withColumn("__prev_assigned", F.lag("collect_assigned_time_local").over(by_leg))
         .withColumn("__prev_accepted", F.lag("collect_accepted_time_local").over(by_leg)))

    def gap(c: str, prev: str) -> Column:
        return F.when(pooled, F.abs(D.boundary_diff(F.col(c), F.col(prev))))

    times = {
        "assignment_time_gap_sec": gap("collect_assigned_time_local", "__prev_assigned"),
        "accepted_time_gap_sec": gap("collect_accepted_time_local", "__prev_accepted"),
        "pooling_kpi_sec": F.when(pooled, D.elapsed_sec(
            F.col("delivery_begin_parking_time_local"), F.col("__first_drive"), F.col("timezone"))),
    }
    return w.select("sys_delivery_id", "ccdd_id", *[times[n].alias(n) for n in POOL_TIMES])


def pool_times(ds: DataFrame) -> DataFrame:
    """Per delivery id: the totals of its rows' pool times, with ``__copies``,
    the number of rows they stand for.

    The reference joins the staging rows of a delivery to each other, twice
    where they name a pool: k rows of one delivery and pool stand for k x k
    rows, a row without a pool for one.  Every measure is a sum, so the totals
    and the number of rows replace that fan-out; with one staging row per
    delivery the number is 1.
    """
    # placed by delivery once: serves both groupings and the join
    per_pool = (with_pooling_kpi(ds).repartition("sys_delivery_id").groupBy("sys_delivery_id", "ccdd_id")
                .agg(F.count(F.lit(1)).alias("__k"), *[F.sum(n).alias(n) for n in POOL_TIMES])
                .withColumn("__each", F.when(F.col("ccdd_id").isNotNull(), F.col("__k")).otherwise(F.lit(1))))
    return per_pool.groupBy("sys_delivery_id").agg(
        F.sum(F.col("__k") * F.col("__each")).alias("__copies"),
        *[F.sum(F.col(n) * F.col("__each")).alias(n) for n in POOL_TIMES])


REORDER_GAPS = [f"days_between_{'current_order' if i == 0 else ORDINALS[i - 1] + '_reorder'}_and_{name}_reorder"
                for i, name in enumerate(ORDINALS)]


def reorder_totals(reorder_mart: DataFrame) -> DataFrame:
    """Per delivery of the repeat-order mart: ``__chains``, its rows there (one,
    unless its deliveries repeat), the totals of its gaps and subtotals, and its
    repeat orders' ids, a list of as many elements for each ordinal."""
    out = [F.count(F.lit(1)).alias("__chains")]
    for name, gap in zip(ORDINALS, REORDER_GAPS):
        out += [F.sum(gap).alias(f"{name}_reorder_days_sum"),
                F.sum(f"{name}_reorder_food_subtotal").alias(f"{name}_reorder_food_subtotal"),
                F.collect_set(f"{name}_reorder_sys_delivery_id").alias(f"__{name}_ids")]
    return reorder_mart.groupBy("sys_delivery_id").agg(*out)


def ticket_totals(ticket_mart: DataFrame) -> DataFrame:
    """Per delivery: its rows in the ticket mart and whether they name a ticket."""
    return ticket_mart.groupBy("sys_delivery_id", "has_ticket").agg(F.count(F.lit(1)).alias("__tickets")) \
        .withColumnRenamed("has_ticket", "__has_ticket")


def row_amounts() -> dict[str, Column]:
    """What a staging row adds to each sum.  It stands for ``__copies`` rows
    (see :func:`pool_times`); the pool times are totals over those rows already.
    A delivery's tickets repeat either."""
    tickets = F.coalesce(F.col("__tickets"), F.lit(1))
    copies = F.col("__copies") * tickets

    def total(x: Column) -> Column:
        return x * copies

    pooled = F.col("is_multi_collect") == 1
    out = {"assignment_time_gap_mins_sum": F.when(pooled, _z("assignment_time_gap_sec")).otherwise(F.lit(0)) * tickets,
           "acceptance_time_gap_mins_sum": F.when(pooled, _z("accepted_time_gap_sec")).otherwise(F.lit(0)) * tickets}
    out |= {name: _z(src) * tickets if src == POOL_TIME else total(_z(src)) for name, src in MINUTE_SUMS}
    out |= {name: total(_z(src)) for name, src in LOCAL_SUMS}
    out |= {"rejections_sum": total(_z("rejections_count")), "food_subtotal": total(_z("food_subtotal"))}
    out |= {a: total(_z(a)) for a in ADJUSTMENTS}
    cost = _z("courier_pay_without_tips_or_courier_adjustments") - _z("company_net_adjustment_sum")
    out["total_order_cost_sum"] = total(cost)
    rate = F.col("local_currency_to_euros")
    pay = ["courier_pay_without_tips", "courier_pay_without_tips_or_courier_adjustments"]
    out |= {f"{c}_euros_sum": total(_z(c) / rate) for c in pay}
    out |= {a.replace("_sum", "_euros_sum"): total(_z(a) / rate) for a in ADJUSTMENTS}
    out["total_order_cost_euros_sum"] = total(cost / rate)
    out["restaurant_accessibility_time_mins"] = total(_z("collect_accessibility_minutes"))
    out["total_order_cost_less_customer_refunds_sum"] = total(
        _z("courier_pay_without_tips") - _z("company_net_adjustment_sum") - _z("custo_net_adjustment_sum"))
    for name, score in (("positive_scores_count", 1), ("non_positive_scores_count", 0)):
        out[name] = total(F.when(F.col("is_score_positive") == score, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return out


IN_MINUTES = ["assignment_time_gap_mins_sum", "acceptance_time_gap_mins_sum", *[name for name, _ in MINUTE_SUMS]]

# Output measures, in the reference's order.
MEASURES = [
    "delivery_count", *IN_MINUTES, *[name for name, _ in LOCAL_SUMS], "rejections_sum", "rejected_offer_count",
    "food_subtotal", *ADJUSTMENTS, "total_order_cost_sum", "courier_pay_without_tips_euros_sum",
    "courier_pay_without_tips_or_courier_adjustments_euros_sum", *[a.replace("_sum", "_euros_sum") for a in ADJUSTMENTS],
    "total_order_cost_euros_sum", "orders_with_min_1_reorder_count",
    *[f"{name}_{what}" for name in ORDINALS for what in ("reorders_count", "reorder_days_sum", "reorder_food_subtotal")],
    "restaurant_accessibility_time_mins", "total_order_cost_less_customer_refunds_sum",
    "positive_scores_count", "non_positive_scores_count",
]


def per_delivery(keyed: DataFrame) -> DataFrame:
    """One row per (keys, delivery): the sums of its rows, how many rows they
    stand for (``__stands``) and whether the offer was rejected.  No exchange:
    the rows are placed by delivery already."""
    return keyed.groupBy(*GROUP_KEYS, "sys_delivery_id").agg(
        *[F.sum(x).alias(name) for name, x in row_amounts().items()],
        F.sum(F.col("__copies") * F.coalesce(F.col("__tickets"), F.lit(1))).alias("__stands"),
        F.max((F.col("rejections_count") > 0).cast("int")).alias("__rejected"))


def report(deliveries: DataFrame, reorder_mart: DataFrame) -> DataFrame:
    """The rollup of :func:`per_delivery` rows to the report keys.

    Each delivery gives one row with its sums (ordinal 0) and one for each repeat
    order's id.  They are combined per (keys, ordinal, id) before the first
    exchange, where the rows of ordinal 0 shrink to one per key group and task,
    and then per key group."""
    reorders = reorder_totals(reorder_mart).withColumnRenamed("sys_delivery_id", "__of")
    both = deliveries.join(reorders, F.col("sys_delivery_id") == F.col("__of"), "left")
    chains = F.coalesce(F.col("__chains"), F.lit(1))
    amounts = {name: F.col(name) * chains for name in row_amounts()}
    amounts |= {f"{name}_{what}": F.col(f"{name}_{what}") * F.col("__stands")
                for name in ORDINALS for what in ("reorder_days_sum", "reorder_food_subtotal")}
    amounts |= {"delivery_count": F.lit(1).cast("long"),
                "rejected_offer_count": F.coalesce(F.col("__rejected"), F.lit(0)).cast("long"),
                "orders_with_min_1_reorder_count": F.col("__chains").isNotNull().cast("long")}

    def named(ordinal: int, ids: Column) -> Column:
        return F.transform(ids, lambda x: F.struct(F.lit(ordinal).alias("ordinal"), x.alias("id")))

    none = F.array().cast("array<bigint>")
    mentions = F.concat(named(0, F.array(F.lit(None).cast("long"))),
                        *[named(i, F.coalesce(F.col(f"__{name}_ids"), none)) for i, name in enumerate(ORDINALS, 1)])
    rows = both.select(*GROUP_KEYS, *[x.alias(name) for name, x in amounts.items()], F.inline(mentions))
    own = F.col("ordinal") == F.lit(0)
    once = rows.groupBy(*GROUP_KEYS, "ordinal", "id").agg(*[F.sum(F.when(own, F.col(n))).alias(n) for n in amounts])

    def measure(name: str) -> Column:
        for i, which in enumerate(ORDINALS, 1):
            if name == f"{which}_reorders_count":
                return F.count(F.when(F.col("ordinal") == F.lit(i), F.lit(1)))
            if name.startswith(f"{which}_reorder"):
                return F.coalesce(F.sum(name), F.lit(0))
        return F.sum(name) / F.lit(60.0) if name in IN_MINUTES else F.sum(name)

    return wide_rollup(once, GROUP_KEYS, [measure(n).alias(n) for n in MEASURES])


def build(cat: Catalog, spark: SparkSession, staging_mart: DataFrame, reorder_mart: DataFrame,
          ticket_mart: DataFrame, dedupe: bool = False) -> DataFrame:
    """The mart.  A delivery with several staging rows counts in every sum as
    often as the reference's joins repeat it; ``dedupe=True`` instead keeps one
    staging row per delivery, the last by pool, leg and assignment."""
    split_wide_code(spark)
    ds = staging_mart
    if dedupe:
        ds = latest_per_key(ds, ["sys_delivery_id"], ["ccdd_id", "multi_collect_sequence",
                                                      "collect_assigned_time_local", "collect_accepted_time_local"])
    pt = pool_times(ds).withColumnRenamed("sys_delivery_id", "pt_sys_delivery_id")
    ti = ticket_totals(ticket_mart).withColumnRenamed("sys_delivery_id", "ti_sys_delivery_id")
    rj = rejection_counts(cat).withColumnRenamed("sys_delivery_id", "rj_sys_delivery_id")
    did = F.col("sys_delivery_id")
    joined = (ds.join(pt, did == F.col("pt_sys_delivery_id"), "inner")
                .join(rj, did == F.col("rj_sys_delivery_id"), "left")
                .join(ti, did == F.col("ti_sys_delivery_id"), "left"))
    joined = with_euro_rate(joined, spark)
    keyed = (joined
             .withColumn("is_negative_company_net_adjustment",
                         F.when(F.col("company_net_adjustment_sum") < 0, F.lit(1)).otherwise(F.lit(0)))
             .withColumn("has_begin_parking_time",
                         F.when(F.col("delivery_begin_parking_time_local").isNotNull(), F.lit(1)).otherwise(F.lit(0)))
             .withColumn("has_ticket", F.when(F.col("__has_ticket") == 1, F.lit(1)).otherwise(F.lit(0))))
    return report(per_delivery(keyed), reorder_mart)
