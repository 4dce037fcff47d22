"""Delivery domain tables derived from the driver's TPC-H-like test tables.

The reference reads 19 warehouse inputs that the test data does not have.
This adapter derives each of them with Spark from ``orders``, ``customer``,
``lineitem``, ``supplier``, ``nation``, ``region`` and ``conversations`` by
integer rules of the order key ``k`` (see FIXTURES.md section 3), so every
derived table grows with the driver tables.  Fractional inputs are quarters or
halves, which binary floating point holds exactly, so sums do not depend on
the order in which an engine adds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog

# Tenants, their zones and currencies' order, indexed by nation % 5.
TENANTS = ["ie", "uk", "ca", "au", "nz"]
TIME_ZONES = ["Europe/Dublin", "Europe/London", "America/Toronto", "Australia/Sydney",
              "Pacific/Auckland"]
DELIVERY_ID_OFFSET = 1000000
RESTO_TYPES = ["Restaurant", "Grocery", "Convenience"]
TICKET_ORIGINS = ["origin_offline", "origin_self_serve_offline", "origin_web"]
QUERY_TYPES = ["rds_late_delivery", "late_order_refund", "food_quality_issue",
               "quality_of_food_bad", "missing_item", "other"]


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def _plus_s(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def _plus_ms(ts: Column, ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, ts)


def uuid_of(n: Column) -> Column:
    """A uuid-shaped text key for a number (hex md5 of its decimal text)."""
    h = F.md5(n.cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


class DriverTables:
    """Reads the driver's Parquet tables once, with only the columns used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def read(self, name: str, *cols: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet").select(*cols)


def _orders_base(t: DriverTables) -> DataFrame:
    """One row per order with its customer's nation, restaurant and all timestamps.

    The restaurant is ``k * 7 mod (number of suppliers)`` (a scalar subquery
    Spark runs once), null for every 59th order (a missing dimension key).
    """
    o = t.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = t.read("customer", "c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    suppliers = t.read("supplier", "s_suppkey").select(F.count(F.lit(1))).scalar()
    base = (o.join(c, o.o_custkey == c.c_custkey, "left")
             .withColumn("resto_id", F.when(k % 59 != 7, k * 7 % suppliers)))
    created = _plus_s(F.col("o_orderdate"), k * 7919 % 86400)
    accepted = _plus_ms(_plus_s(F.col("created"), k * 17 % 400), k * 7 % 1000)
    return (base
            .withColumn("k", k)
            .withColumn("nk", F.col("c_nationkey").cast("long"))
            .withColumn("tenant_id", _pick(TENANTS, F.col("c_nationkey") % 5))
            .withColumn("timezone", _pick(TIME_ZONES, F.col("c_nationkey") % 5))
            .withColumn("created", created)
            .withColumn("assigned", _plus_s(F.col("created"), ((k * 17 % 400) / 2).cast("long")))
            .withColumn("accepted", accepted)
            .withColumn("c_in_transit", _plus_s(F.col("accepted"), k * 19 % 200))
            .withColumn("c_arrived", _plus_ms(_plus_s(F.col("c_in_transit"), k * 23 % 900),
                                              k * 11 % 1000))
            .withColumn("c_completed", _plus_s(F.col("c_arrived"), k * 29 % 600))
            .withColumn("d_in_transit", _plus_s(F.col("c_completed"), k * 31 % 120))
            .withColumn("d_arrived", _plus_s(F.col("d_in_transit"), k * 41 % 1500)))


def _lines_by_delivery(t: DriverTables) -> DataFrame:
    """Per-delivery line aggregates: ten adjustment sums.  Grouped by the delivery id, so
    that joins on it need no second exchange."""
    li = t.read("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber").cast("long")

    def half(e):
        return F.sum(e) / F.lit(2.0)

    def quarter(e):
        return F.sum(e) / F.lit(4.0)

    return li.groupBy((F.col("l_orderkey") + F.lit(DELIVERY_ID_OFFSET)).alias("sys_delivery_id")).agg(
        half(p % 7 - 3).alias("company_net_adjustment_sum"),
        quarter(p % 5).alias("na_company_net_adjustment_sum"),
        half(s % 3).alias("nc_total_net_compensation_sum"),
        quarter(s % 5 - 2).alias("courier_net_adjustment_sum"),
        half(-(p % 3)).alias("custo_net_adjustment_sum"),
        half(n % 2).alias("na_custo_net_adjustment_sum"),
        quarter(n % 3).alias("nc_custo_net_compensation_sum"),
        half(p % 4 - 1).alias("resto_net_adjustment_sum"),
        quarter(s % 4).alias("na_resto_net_adjustment_sum"),
        half(p % 6).alias("nc_resto_net_compensation_sum"),
    )


_CATALOGS: dict = {}


def driver_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """Catalogue of the 19 domain inputs over the driver tables in ``sf_dir``.

    One catalogue per (session, folder): the input plans are the same for
    every query, so they are built once (plan objects only; every query still
    reads and computes everything when it runs).
    """
    key = (id(getattr(spark, "_jsparkSession", spark)), sf_dir.rstrip("/"))
    if key not in _CATALOGS:
        _CATALOGS[key] = _driver_catalog(spark, sf_dir)
    return _CATALOGS[key]


def _driver_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    t = DriverTables(spark, sf_dir)
    memo: dict[str, DataFrame] = {}

    def base():
        if "base" not in memo:
            memo["base"] = _orders_base(t)
        return memo["base"]

    k = F.col("k")
    did = (k + F.lit(DELIVERY_ID_OFFSET)).alias("sys_delivery_id")

    def fact_orders_resto():
        return base().select(
            F.col("tenant_id"),
            k.alias("sys_order_id"),
            F.when(k % 97 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey")).alias("sys_custo_id"),
            F.col("resto_id").alias("sys_resto_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("created").alias("order_datetime"),
            F.concat(F.lit("ORD-"), k.cast("string")).alias("order_number"),
            k.alias("public_order_number"),
            F.floor(F.col("o_totalprice") * 100).cast("long").alias("food_subtotal"),
            F.when(k % 8 == 0, F.lit(None)).when(k % 4 != 0, F.lit(1)).otherwise(F.lit(0))
             .cast("int").alias("is_asap_order"),
            F.when(k % 11 == 0, F.lit(None)).otherwise(k % 20 + 5).cast("long").alias("resto_food_prep_min"),
            F.when(k % 3 == 0, k % 7).cast("long").alias("resto_delay_requested_min"),
        )

    def fact_deliveries():
        return base().select(
            F.col("tenant_id"), F.col("timezone"), did,
            uuid_of(k + F.lit(DELIVERY_ID_OFFSET)).alias("delivery_uuid"),
            k.alias("sys_order_id"),
            F.col("resto_id").alias("sys_resto_id"),
            (k * 13 % 211).alias("sys_courier_id"),
            F.col("nk").alias("sys_courier_delivery_zone_id"),
            F.when(F.col("o_orderstatus") == "P", "CANCELLED").otherwise("DELIVERED").alias("delivery_status"),
            F.col("created").alias("delivery_created_time_local"),
            F.col("d_in_transit").alias("delivery_in_transit_time_local"),
            F.col("d_arrived").alias("delivery_arrived_time_local"),
            F.when(k % 53 != 0, _plus_s(F.col("d_arrived"), k * 37 % 1800))
             .alias("delivery_begin_parking_time_local"),
            F.col("assigned").alias("collect_assigned_time_local"),
            F.col("accepted").alias("collect_accepted_time_local"),
            F.when(k % 59 != 0, F.col("c_in_transit")).alias("collect_in_transit_time_local"),
            F.col("c_arrived").alias("collect_arrived_time_local"),
            F.col("c_completed").alias("collect_completed_time_local"),
            F.when(k % 17 != 0, k * 67 % 3600).alias("handle_time_sec"),
            (k * 71 % 3000).alias("ptod_sec"),
            (k * 73 % 1800).alias("ptoc_sec"),
            (k * 47 % 2400 - 60).alias("ctod_sec"),
            (k * 79 % 600).alias("resto_hold_sec"),
            (k * 83 % 300).alias("custo_hold_sec"),
            ((k * 59 % 104) / F.lit(4.0)).alias("collect_total_driving_time_min"),
            ((k * 61 % 72) / F.lit(4.0)).alias("delivery_total_driving_time_min"),
            (k * 43 % 20).cast("double").alias("collect_original_total_driving_time_min"),
            ((k * 29 % 100) / F.lit(4.0)).alias("deliver_original_total_driving_time_min"),
            (k * 31 % 900 * 10).cast("double").alias("collect_driving_distance_original_meters"),
            (k * 53 % 2600 * 10).cast("double").alias("delivery_driving_distance_original_meters"),
            F.when(k % 13 != 0, k % 4).alias("collect_accessibility_minutes"),
            (k % 3).alias("deliver_accessibility_minutes"),
            F.when(k % 19 != 0, (k * 43 % 120 - 16) / F.lit(2.0)).alias("delivery_completion_slack_min"),
        )

    def dim_zones():
        n = t.read("nation", "n_nationkey", "n_name", "n_regionkey")
        r = t.read("region", "r_regionkey", "r_name")
        nk = F.col("n_nationkey").cast("double")

        def pt(lon, lat):
            return F.struct(lon.alias("lon"), F.lit(lat).alias("lat"))

        lon2 = nk + F.lit(0.1)
        ring = F.array(pt(nk, 40.0), pt(lon2, 40.0), pt(lon2, 40.1), pt(nk, 40.1), pt(nk, 40.0))
        return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
            F.col("n_nationkey").cast("long").alias("sys_courier_delivery_zone_id"),
            F.col("n_nationkey").cast("long").alias("sys_delivery_zone_id"),
            F.col("n_name").alias("name"),
            F.when(F.col("n_nationkey") % 7 == 0, F.concat(F.lit("SAT - "), F.col("n_name")))
             .otherwise(F.col("n_name")).alias("zone_name"),
            F.col("n_regionkey").cast("long").alias("sys_zone_group_id"),
            F.col("r_name").alias("zone_group_name"),
            ring.alias("polygon"),
        )

    def dim_resto():
        s = t.read("supplier", "s_suppkey", "s_name", "s_nationkey")
        sk = F.col("s_suppkey")
        return s.select(
            sk.alias("sys_resto_id"),
            F.col("s_nationkey").cast("long").alias("sys_delivery_zone_id"),
            _pick(RESTO_TYPES, sk % 3).alias("resto_type"),
            F.when(sk % 6 == 0, F.concat(F.lit("McDonalds "), F.col("s_name")))
             .when(sk % 6 == 1, F.concat(F.lit("McDonald"), F.col("s_name")))
             .otherwise(F.col("s_name")).alias("resto_name_short"),
        )

    def dim_resto_grouping():
        sk = F.col("s_suppkey")
        return (t.read("supplier", "s_suppkey").where(sk % 2 == 0).select(
            sk.alias("sys_resto_id"),
            F.when(sk % 5 == 0, F.lit("McDonald%s")).when(sk % 5 == 1, F.lit("McDonalds"))
             .otherwise(F.lit("Independent")).alias("grouping")))

    def bridge_multi_collect():
        pool = (k / 2).cast("long")
        return (t.read("orders", "o_orderkey").withColumn("k", F.col("o_orderkey"))
                .where(pool % 3 == 0).select(
                    did,
                    pool.alias("ccdd_id"),
                    (k % 2 + 1).alias("multi_collect_sequence"),
                    F.when(pool % 9 == 3, F.lit(0)).otherwise(F.lit(1)).alias("is_multi_collect"),
                    F.when(k % 3 == 0, F.lit(1)).otherwise(F.lit(0)).alias("multi_collect_in_transit"),
                    F.when(pool % 4 == 0, F.lit(1)).otherwise(F.lit(0)).alias("is_assigned_by_holding_container"),
                    (k * 71 % 900).alias("ccdd_courier_analysis_handle_time_sec")))

    def order_keys():
        return t.read("orders", "o_orderkey").withColumn("k", F.col("o_orderkey"))

    def fact_order_financial_metrics():
        return order_keys().where(k % 10 != 9).select(
            k.alias("sys_order_id"),
            ((k * 89 % 2000) / F.lit(4.0)).alias("courier_pay_without_tips"),
            F.when(k % 3 == 0, (k * 97 % 200 - 100) / F.lit(4.0)).alias("courier_net_adjustment"))

    def fact_resto_reviews():
        return order_keys().where(k % 5 == 0).select(
            k.alias("sys_order_id"), (k % 2).cast("int").alias("is_score_positive"))

    def global_adjustments():
        return _lines_by_delivery(t)

    def pos_injection():
        return base().where(k % 7 != 0).select(
            k.alias("order_id"),
            _plus_s(F.col("created"), k % 120).alias("injection_time"),
            (k % 15).alias("fire_into_pos_time"))

    def assignment_log():
        b = base()
        courier = (k * 13 % 211).alias("courierId")
        own = F.concat(F.lit("COLLECT:"), uuid_of(k + F.lit(DELIVERY_ID_OFFSET)))
        nxt = F.concat(F.lit(";COLLECT:"), uuid_of(k + F.lit(DELIVERY_ID_OFFSET + 1)))
        first = b.where(k % 4 != 3).select(
            courier, _plus_s(F.col("created"), F.lit(10)).alias("timestamp"),
            F.struct(F.when(k % 2 == 0, F.concat(own, nxt)).otherwise(own).alias("assignedJobs"))
             .alias("jobChanges"))
        later = b.where(k % 3 == 0).select(
            courier, _plus_s(F.col("created"), F.lit(20)).alias("timestamp"),
            F.struct(own.alias("assignedJobs")).alias("jobChanges"))
        return first.unionByName(later)

    def bridge_blacklisted_couriers():
        li = t.read("lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
        n = F.col("l_linenumber")
        return li.where(F.col("l_returnflag") == "R").select(
            _pick(TENANTS, F.col("l_suppkey") % 5).alias("tenant_id"),
            (F.col("l_orderkey") + F.lit(DELIVERY_ID_OFFSET)).alias("sys_delivery_id"),
            F.col("l_suppkey").alias("sys_courier_id"),
            (F.col("l_linestatus") == "F").alias("is_multi_collect"),
            (n % 2 == 0).alias("is_manual_unassigned"),
            (n % 3 == 0).alias("is_cnmp_unassigned"),
            (n % 4 == 0).alias("is_timer_expired"),
            (n % 5 == 0).alias("is_offer_declined"))

    def _hold(pred: Column, start_mult: int, start_add: int, end_mult: int, orig_mult: int):
        o = t.read("orders", "o_orderkey", "o_orderdate").withColumn("k", F.col("o_orderkey"))
        start = _plus_s(F.col("o_orderdate"), k * start_mult % 5000 + start_add)
        return (o.where(pred).select(
            (k + F.lit(DELIVERY_ID_OFFSET)).alias("delivery_id"),
            (k % 4 == 0).alias("is_in_hold_container"),
            start.alias("time_window_start"))
            .withColumn("time_window_end", _plus_s(F.col("time_window_start"),
                                                   (F.col("delivery_id") - DELIVERY_ID_OFFSET) * end_mult % 600))
            .withColumn("time_window_end_original", _plus_s(F.col("time_window_start"),
                                                            (F.col("delivery_id") - DELIVERY_ID_OFFSET) * orig_mult % 900)))

    def hold_container_live():
        return _hold(k % 6 == 0, 11, 0, 7, 5)

    def hold_container_archive():
        return _hold((k % 12 == 0) | (k % 6 == 3), 13, 1, 3, 11)

    def tickets():
        cv = t.read("conversations", "conv_id", "turn", "role")
        cid = F.col("conv_id")
        chat = F.when((F.col("role") == "user") & (F.col("turn") % 4 == 2), F.col("turn").cast("string"))
        call = F.when((F.col("role") == "assistant") & (F.col("turn") % 3 == 1),
                      F.struct(F.concat_ws("-", cid.cast("string"), F.col("turn").cast("string"))
                               .alias("call_segment_id")))
        per = cv.groupBy("conv_id").agg(F.collect_list(chat).alias("chats"),
                                        F.collect_list(call).alias("calls"))
        return per.select(
            F.struct(
                F.when(cid % 8 != 7, (cid * 3).cast("string")).alias("ticket_order_id_local"),
                F.when(cid % 4 == 3, F.lit("originator_agent")).otherwise(F.lit("originator_customer"))
                 .alias("contact_origin"),
                _pick(TICKET_ORIGINS, cid % 3).alias("ticket_origin"),
                F.when(cid % 10 != 9, cid.cast("string")).alias("ticket_id_local"),
                _pick(QUERY_TYPES, cid % 6).alias("query_type"),
                F.col("chats").alias("chat_ids_list"),
                F.col("calls").alias("call_ids_list"),
            ).alias("ticket"),
            F.struct((cid * 3).alias("order_id_local")).alias("orders"),
            F.struct(F.date_add(F.lit("1995-01-01").cast("date"), (cid * 5 % 2400).cast("int"))
                     .alias("order_date_local")).alias("order_date"),
            F.struct(F.when(cid % 5 == 4, F.lit("UK")).otherwise(F.lit("IE")).alias("country_code"))
             .alias("company"),
        )

    def fact_order_net_adjustments():
        li = t.read("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag",
                    "l_linestatus", "l_discount", "l_extendedprice")
        n = F.col("l_linenumber")
        return li.select(
            _pick(TENANTS, F.col("l_partkey") % 5).alias("tenant_id"),
            F.col("l_orderkey").alias("sys_order_id"),
            F.when(n % 4 == 0, F.lit("FOOD_QUALITY")).when(n % 4 == 1, F.lit("DELIVERY_SERVICE"))
             .when(n % 4 == 2, F.lit("missing_incorrect_items"))
             .otherwise(F.concat(F.col("l_returnflag"), F.col("l_linestatus"))).alias("scenario"),
            (-F.floor(F.col("l_discount") * F.col("l_extendedprice"))).cast("double")
             .alias("company_net_adjustment"))

    def bridge_shift_delivery():
        return order_keys().where(k % 10 != 7).select(did)

    def dim_courier_shifts():
        shift = F.when(k % 9 == 0, F.lit(1)).otherwise(F.lit(0))
        return base().where(k % 3 == 0).select(
            _pick(TENANTS, (F.col("nk") + shift) % 5).alias("tenant_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            (k * 13 % 211).alias("sys_courier_id"),
            F.col("nk").alias("delivery_zone_id"),
            (k * 61 % 7200 + 14400).alias("shift_time_sec"),
            F.when(k % 2 != 0, k * 67 % 600).alias("dnu_time_sec"))

    def dim_couriers():
        return t.read("supplier", "s_suppkey").select(F.col("s_suppkey").alias("sys_courier_id"))

    loaders = {
        "fact_deliveries": fact_deliveries,
        "fact_orders_resto": fact_orders_resto,
        "dim_resto": dim_resto,
        "bridge_multi_collect": bridge_multi_collect,
        "fact_order_financial_metrics": fact_order_financial_metrics,
        "dim_zones": dim_zones,
        "dim_resto_grouping": dim_resto_grouping,
        "fact_resto_reviews": fact_resto_reviews,
        "global_adjustments": global_adjustments,
        "pos_injection": pos_injection,
        "assignment_log": assignment_log,
        "bridge_blacklisted_couriers": bridge_blacklisted_couriers,
        "hold_container_live": hold_container_live,
        "hold_container_archive": hold_container_archive,
        "tickets": tickets,
        "fact_order_net_adjustments": fact_order_net_adjustments,
        "bridge_shift_delivery": bridge_shift_delivery,
        "dim_courier_shifts": dim_courier_shifts,
        "dim_couriers": dim_couriers,
    }
    return Catalog(spark, loaders)
