"""Queries that exercise one reference operator each, over whole driver tables.

Each takes (spark, sf_dir) and returns a DataFrame; the marts use the same
operators, these isolate them so each has its own oracle check.
"""

from __future__ import annotations

import datetime as _dt
import os
import unicodedata
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..functions import dates as D
from ..functions.geo import polygon_area_km2, ring_area_km2
from ..functions.text import COLLECT_TOKEN, UUID_PATTERN, contains_folded, extract_all, token_count, written_out
from ..operators.rollup import with_euro_rate
from ..operators.windows import dense_and_row_number, hour_of, latest_per_key, lead_chain
from ..session import ensure_checkpoint_dir
from ..sources.adapter import TIME_ZONES, driver_catalog
from . import refunds, reorders, staging, summary, utilisation
from .params import FIXTURE_PARAMS as P


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered deliveries of every tenant with their order's fields."""
    cat = driver_catalog(spark, sf_dir)
    fd = cat["fact_deliveries"].where(F.col("delivery_status") == "DELIVERED")
    fo = cat["fact_orders_resto"].select("sys_order_id", "is_asap_order", "resto_food_prep_min",
                                         "resto_delay_requested_min")
    return fd.join(fo, "sys_order_id", "inner")


def _pooled_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = driver_catalog(spark, sf_dir)
    cd = cat["bridge_multi_collect"].select(
        "sys_delivery_id", "ccdd_id", "multi_collect_sequence", "ccdd_courier_analysis_handle_time_sec",
        F.coalesce(F.col("is_multi_collect"), F.lit(0)).alias("is_multi_collect"))
    return _delivered(spark, sf_dir).join(cd, "sys_delivery_id", "left")


# --- windows -----------------------------------------------------------------

def reorder_chain(spark, sf_dir):
    return reorders.chain(driver_catalog(spark, sf_dir), P, all_tenants=True)


def reorder_chain_known_customers(spark, sf_dir):
    """The chain with orders of no customer kept out of it."""
    return reorders.chain(driver_catalog(spark, sf_dir), P, all_tenants=True, drop_null_customer=True)


def reorder_chain_hot_split(spark, sf_dir):
    """The skew case of the chain: one group for each tenant, so that a few groups
    hold all rows; their hours keep them apart."""
    rows = reorders.delivered_orders(driver_catalog(spark, sf_dir), P, all_tenants=True)
    return lead_chain(rows.select("tenant_id", "sys_delivery_id", "order_datetime", "food_subtotal"),
                      ["tenant_id"], ["order_datetime", "sys_delivery_id"],
                      {"sys_delivery_id": "next_{n}_id", "food_subtotal": "next_{n}_subtotal"}, 4,
                      hour_of("order_datetime"))


def date_window_filter(spark, sf_dir):
    start, end = D.date_window(F.lit(P.as_of), _dt.date(1999, 12, 31), P.floor)
    o = _read(spark, sf_dir, "orders")
    d = F.col("o_orderdate").cast("date")
    return o.where(d.between(start, end)).select(
        "o_orderkey", d.alias("order_date"), start.alias("window_start"), end.alias("window_end"))


def latest_event_per_user(spark, sf_dir):
    ev = _read(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(ev, ["user_id"], ["ts", "event_id"])


def duplicate_line_rank(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     F.row_number().over(w).cast("long").alias("record_rank")) \
             .withColumn("non_dup_record_flag", F.col("record_rank") == 1)


def payment_sequence(spark, sf_dir):
    d = _pooled_deliveries(spark, sf_dir).select(
        "sys_delivery_id", "sys_order_id",
        F.coalesce(F.col("ccdd_id"), F.col("sys_delivery_id")).alias("del_key"),
        F.col("delivery_created_time_local").alias("payment_utc"))
    d = d.withColumn("record_rank", F.row_number().over(
        Window.partitionBy("sys_order_id").orderBy("payment_utc", "del_key")).cast("long"))
    return dense_and_row_number(d, ["del_key"], ["record_rank"], [F.col("payment_utc")],
                                "payment_sequence", "payment_sequence_dense_rank",
                                bucket=hour_of("payment_utc"), row_tiebreak=[F.col("sys_order_id")])


def pool_gain(spark, sf_dir):
    d = _pooled_deliveries(spark, sf_dir)
    return staging.with_pool_columns(d).select(
        "sys_delivery_id", "ccdd_id", "multi_collect_sequence", "collect_total_driving_time_sec_max_ccdd",
        "delivery_total_driving_time_min_previous_leg", "pooling_capacity_gains_sec",
        "first_order_deliver_original_total_driving_time_min")


def pool_accept_gap(spark, sf_dir):
    d = _pooled_deliveries(spark, sf_dir)
    return summary.with_pooling_kpi(d).select(
        "sys_delivery_id", "ccdd_id", "assignment_time_gap_sec", "accepted_time_gap_sec", "pooling_kpi_sec")


# --- dates and zones ---------------------------------------------------------

def _events_with_zone(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    zones = F.array(*[F.lit(z) for z in TIME_ZONES])
    return ev.withColumn("tz", F.element_at(zones, (F.col("user_id") % 5 + 1).cast("int")))


def local_to_utc(spark, sf_dir):
    ev = _events_with_zone(spark, sf_dir)
    utc = D.local_to_utc(F.col("ts"), F.col("tz"))
    return ev.select("event_id", "tz", "ts", utc.alias("ts_utc"),
                     D.utc_to_local(utc, F.col("tz")).alias("ts_back"))


def elapsed_times(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    prev = F.lag("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return ev.select("event_id", "user_id",
                     D.boundary_diff(F.col("ts"), prev).alias("elapsed_sec"),
                     D.truncated_ms_sec(F.col("ts"), prev).alias("elapsed_ms_trunc_sec"),
                     D.boundary_diff(F.col("ts"), prev, "MINUTE").alias("elapsed_min"))


def datetime_add_minutes(spark, sf_dir):
    d = _delivered(spark, sf_dir)
    minutes = F.coalesce(F.col("resto_food_prep_min"), F.lit(0)) + F.coalesce(F.col("resto_delay_requested_min"), F.lit(0))
    return d.select("sys_delivery_id", D.add_minutes(D.local_to_utc(F.col("delivery_created_time_local"),
                                                                    F.col("timezone")), minutes)
                    .alias("food_ready_utc"))


def day_of_week_concat(spark, sf_dir):
    ev = _read(spark, sf_dir, "events").withColumn("t", D.trunc_to_second(F.col("ts")))
    part = B.daypart(F.col("t"))
    return ev.select("event_id", F.dayofweek("t").cast("long").alias("day_of_week_local"),
                     part.alias("time_of_day_group"),
                     F.concat(F.col("t").cast("string"), part).alias("day_of_week_and_time_of_day_group"))


def zone_area(spark, sf_dir):
    z = driver_catalog(spark, sf_dir)["dim_zones"]
    return z.select("sys_courier_delivery_zone_id", "name", ring_area_km2(F.col("polygon")).alias("zone_area_square_km"))


def zone_area_parts(spark, sf_dir):
    """Zones of two parts: a square, with a hole in every second zone, and a triangle
    across the 180th meridian; every fifth zone has a ring round the north pole as well."""
    z = driver_catalog(spark, sf_dir)["dim_zones"].select("sys_courier_delivery_zone_id", "name")
    k = F.col("sys_courier_delivery_zone_id").cast("double")

    def ring(*corners):
        return F.array(*[F.struct(F.lit(x).cast("double").alias("lon"), F.lit(y).cast("double").alias("lat"))
                         for x, y in (*corners, corners[0])])

    def square(x, y, side):
        return ring((x, y), (x + side, y), (x + side, y + side), (x, y + side))

    shell, hole = square(k, F.lit(40.0), 0.5), square(k + 0.125, F.lit(40.125), 0.25)
    across = F.array(ring((179.5, -k), (F.lit(-179.0), -k), (179.75, -k - 1.5)))
    pole = F.array(ring((0, 85), (90, 85), (180, 84), (-90, 85)))
    whole = F.array(F.when(k % 2 == 0, F.array(shell, hole)).otherwise(F.array(shell)), across)
    parts = F.when(k % 5 == 0, F.concat(whole, F.array(pole))).otherwise(whole)
    return z.select("*", F.size(parts).cast("long").alias("parts"), polygon_area_km2(parts).alias("zone_area_square_km"))


# --- buckets -----------------------------------------------------------------

def _bins(spark, sf_dir, col_name, bin_expr, src):
    d = _delivered(spark, sf_dir)
    return d.select("sys_delivery_id", F.col(src), bin_expr.alias(col_name))


def slack_bins(spark, sf_dir):
    s = F.col("delivery_completion_slack_min")
    return _bins(spark, sf_dir, "delivery_completion_slack_bin", B.slack_bin(s), "delivery_completion_slack_min") \
        .withColumn("is_on_time_order", B.on_time_flag(s))


def ctod_bins(spark, sf_dir):
    return _bins(spark, sf_dir, "ctod_min_bin", B.ctod_bin(F.col("ctod_sec")), "ctod_sec")


def ctod_text(spark, sf_dir):
    return _bins(spark, sf_dir, "ctod_min", B.ctod_text(F.col("ctod_sec")), "ctod_sec")


def km_bins(spark, sf_dir):
    m = "delivery_driving_distance_original_meters"
    return _bins(spark, sf_dir, "delivery_driving_distance_original_kms_bin", B.km_bin(F.col(m)), m)


def drive_bins(spark, sf_dir):
    m = "deliver_original_total_driving_time_min"
    return _bins(spark, sf_dir, "deliver_original_total_driving_time_min_bin", B.drive_bin(F.col(m)), m)


def ptov_bins(spark, sf_dir):
    d = _delivered(spark, sf_dir)
    asap = F.coalesce(F.col("is_asap_order"), F.lit(0))
    ptov = F.when(asap == 1, F.coalesce(D.elapsed_sec(F.col("collect_accepted_time_local"),
                                                      F.col("delivery_created_time_local"), F.col("timezone")),
                                        F.lit(0)))
    return d.select("sys_delivery_id", ptov.alias("ptov_sec"), asap.alias("is_asap_order")) \
            .withColumn("ptov_min_bin", B.ptov_bin(F.col("ptov_sec"), F.col("is_asap_order")))


def daypart_bins(spark, sf_dir):
    c = F.col("delivery_created_time_local")
    return _bins(spark, sf_dir, "time_of_day_group", B.daypart(c), "delivery_created_time_local")


# --- joins, unnest, text -----------------------------------------------------

def star_join(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    s = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    cn = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("customer_nation"))
    sn = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supplier_nation"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
           .join(c, F.col("o_custkey") == c.c_custkey, "left")
           .join(s, li.l_suppkey == s.s_suppkey, "left")
           .join(p, li.l_partkey == p.p_partkey, "left")
           .join(cn, F.col("c_nationkey") == F.col("cn_key"), "left")
           .join(sn, F.col("s_nationkey") == F.col("sn_key"), "left"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_name", "s_name", "p_name",
                    "customer_nation", "supplier_nation",
                    F.coalesce(F.col("o_totalprice"), F.lit(0.0)).alias("o_totalprice"),
                    F.coalesce(F.col("l_quantity"), F.lit(0.0)).alias("l_quantity"))


def inner_chain(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
              .join(c, F.col("o_custkey") == c.c_custkey, "inner")
              .select("l_orderkey", "l_linenumber", "o_custkey", "c_nationkey"))


def left_to_inner(spark, sf_dir):
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left").where(F.col("l_returnflag") == "R")
    return j.select("o_orderkey", "o_orderstatus", "l_linenumber", "l_returnflag")


def _keyed_events(spark, sf_dir):
    """Events with the key of their properties as text, which in some is no number."""
    digits = F.regexp_extract(F.col("props"), r"(\d+)", 1)
    e = F.col("event_id")
    key = (F.when(e % 11 == 3, F.concat(F.lit("c-"), digits)).when(e % 13 == 5, F.lit(""))
           .when(e % 17 == 7, F.concat(digits, F.lit("000000000000000000000"))).otherwise(digits))
    return _read(spark, sf_dir, "events").select("event_id", key.alias("key"))


def cast_key_join(spark, sf_dir):
    ev = _read(spark, sf_dir, "events").select("event_id", "props")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key = F.regexp_extract(F.col("props"), r"(\d+)", 1).cast("bigint")
    return ev.join(c, key == c.c_custkey, "inner").select("event_id", "c_custkey", "c_name")


def cast_key_tolerant(spark, sf_dir):
    """The join of keys that are numbers, and the other keys as rows of their own."""
    ev = _keyed_events(spark, sf_dir).withColumn("number", F.col("key").try_cast("bigint"))
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    joined = ev.join(c, ev.number == c.c_custkey, "inner").select(
        "event_id", F.lit("joined").alias("outcome"), "key", "c_name")
    rejected = ev.where("number is null").select(
        "event_id", F.lit("rejected").alias("outcome"), "key", F.lit(None).cast("string").alias("c_name"))
    return joined.unionByName(rejected)


def contains_normalised(spark, sf_dir):
    """Word tests on whole documents written in other forms of the same text: upper case,
    combining accents, full width, ligatures, sharp s."""
    d = _read(spark, sf_dir, "documents")
    text, way = F.col("text"), F.col("doc_id") % 6
    apart = text
    for c in "àâäáçéèêëíîïñóôöúùûü":
        apart = F.replace(apart, F.lit(c), F.lit(unicodedata.normalize("NFD", c)))
    joined = text
    for one, several in (("ﬃ", "ffi"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬆ", "st")):
        joined = F.replace(joined, F.lit(several), F.lit(one))
    plain = "".join(map(chr, range(0x21, 0x7F)))
    other = (F.when(way == 0, F.upper(text)).when(way == 1, apart)
             .when(way == 2, F.translate(text, plain, "".join(chr(ord(c) + 0xFEE0) for c in plain)))
             .when(way == 3, joined).when(way == 4, F.replace(text, F.lit("ss"), F.lit("ß"))).otherwise(text))
    words = {"has_tion": "TION", "has_accent": "é", "has_fi": "fi", "has_sts": "st s", "has_ss": "SS"}
    plain = d.select("doc_id", other.alias("text")).select("doc_id", written_out(F.col("text")).alias("plain"))
    return plain.select("doc_id", *[contains_folded(F.col("plain"), w).alias(n) for n, w in words.items()])


def _turn_lists(spark, sf_dir):
    """Per conversation two lists of any length, by turn: the user's and the assistant's
    turns with their lengths.  Some conversations have a null list."""
    def turns(role):
        return F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct("turn", F.length("text").alias("chars")))))

    cid = F.col("conv_id")
    return (_read(spark, sf_dir, "conversations").groupBy("conv_id")
            .agg(turns("user").alias("asked"), turns("assistant").alias("answered"))
            .withColumn("asked", F.when(cid % 10 != 9, F.col("asked")))
            .withColumn("answered", F.when(cid % 7 != 3, F.col("answered"))))


def _unnested(lists: DataFrame, explode) -> DataFrame:
    """Both lists one after the other: every pair, with the places in the lists."""
    first = lists.select("conv_id", "answered", explode("asked").alias("ask_place", "ask"))
    both = first.select("conv_id", "ask_place", "ask", explode("answered").alias("answer_place", "answer"))
    return both.select("conv_id", F.col("ask_place").cast("long").alias("ask_place"), F.col("ask.turn").alias("ask_turn"),
                       F.col("ask.chars").cast("long").alias("ask_chars"), F.col("answer_place").cast("long").alias("answer_place"),
                       F.col("answer.turn").alias("answer_turn"))


def unnest_inner(spark, sf_dir):
    return _unnested(_turn_lists(spark, sf_dir), F.posexplode)


def unnest_left(spark, sf_dir):
    return _unnested(_turn_lists(spark, sf_dir), F.posexplode_outer)


def token_explode(spark, sf_dir):
    log = driver_catalog(spark, sf_dir)["assignment_log"]
    jobs = F.col("jobChanges.assignedJobs")
    return log.select(F.col("courierId").alias("sys_courier_id"), F.col("timestamp").alias("ts"),
                      F.explode(extract_all(jobs, UUID_PATTERN)).alias("delivery_uuid"),
                      token_count(jobs, COLLECT_TOKEN).cast("long").alias("collect_tokens"),
                      (token_count(jobs, COLLECT_TOKEN) > 1).alias("assigned_as_multi_collect"))


def latest_assignment(spark, sf_dir):
    return staging.assignment_flags(driver_catalog(spark, sf_dir))


# --- aggregates --------------------------------------------------------------

def rejection_flags(spark, sf_dir):
    return staging.rejection_flags(driver_catalog(spark, sf_dir))


def refund_rollup(spark, sf_dir):
    from ..operators.rollup import refund_rollup as rollup
    fa = driver_catalog(spark, sf_dir)["fact_order_net_adjustments"]
    return rollup(fa, "sys_order_id", "scenario", "company_net_adjustment",
                  "all_scenarios", "total_company_net_adjustment", 3)


def contact_flags(spark, sf_dir):
    cat = driver_catalog(spark, sf_dir)
    from ..functions.text import FOOD_QUALITY_LIKES, LATE_ORDER_LIKES
    late = refunds.contacts(cat, P, LATE_ORDER_LIKES, "late_order_contact")
    food = refunds.contacts(cat, P, FOOD_QUALITY_LIKES, "food_quality_contact").withColumnRenamed(
        "order_id_local", "f_order")
    return late.join(food, late.order_id_local == food.f_order, "full").select(
        F.coalesce("order_id_local", "f_order").alias("order_id_local"),
        F.coalesce("late_order_contact", F.lit(0)).alias("late_order_contact"),
        F.coalesce("food_quality_contact", F.lit(0)).alias("food_quality_contact"))


def euro_conversion(spark, sf_dir):
    d = _delivered(spark, sf_dir).select("sys_delivery_id", "tenant_id", "sys_order_id")
    fm = driver_catalog(spark, sf_dir)["fact_order_financial_metrics"]
    j = d.join(fm, "sys_order_id", "left")
    pay = F.coalesce(F.col("courier_pay_without_tips"), F.lit(0.0))
    return with_euro_rate(j, spark).select(
        "sys_delivery_id", "tenant_id", pay.alias("courier_pay_without_tips"),
        (pay / F.col("local_currency_to_euros")).alias("courier_pay_without_tips_euros"))


def holding_windows(spark, sf_dir):
    return staging.holding_windows(driver_catalog(spark, sf_dir))


# --- sources and sinks -------------------------------------------------------

def _scratch(spark: SparkSession, tag: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{tag}-{uuid.uuid4().hex}"


def prefix_scan(spark, sf_dir):
    """Writes the events table as three tables sharing a name prefix, then
    reads the family back with one glob (the reference's ``table_*`` scan)."""
    ev = _read(spark, sf_dir, "events")
    root = _scratch(spark, "family")
    for i in range(3):
        ev.where(F.pmod(F.col("event_id"), F.lit(3)) == i).write.mode("overwrite").parquet(
            os.path.join(root, f"events_part_{i}"))
    return spark.read.parquet(os.path.join(root, "events_part_*"))


def mart_roundtrip(spark, sf_dir):
    """The utilisation mart committed twice with replace-whole-table semantics and
    the first one's schema, then read back as the next mart would read it."""
    from ..sources.sink import overwrite_mart, read_mart
    root = _scratch(spark, "marts")
    mart = utilisation.build(driver_catalog(spark, sf_dir), P)
    first = overwrite_mart(mart, root, "utilisation_ie")
    overwrite_mart(mart, root, "utilisation_ie", schema=first.schema)
    return read_mart(spark, root, "utilisation_ie")


def colocated_join(spark, sf_dir):
    """Orders and lines stored in buckets of the order key and joined where they lie."""
    from ..sources.sink import overwrite_mart, read_commit
    root, parts = _scratch(spark, "buckets"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    li = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    stored = [read_commit(spark, overwrite_mart(t, root, name, bucket_by=["o_orderkey"], buckets=parts))
              for name, t in (("orders", o), ("lines", li))]
    lines = stored[1].groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    return stored[0].join(lines, "o_orderkey", "left")


QUERIES = {
    "reorder_chain": reorder_chain,
    "reorder_chain_known_customers": reorder_chain_known_customers,
    "reorder_chain_hot_split": reorder_chain_hot_split,
    "date_window_filter": date_window_filter,
    "latest_event_per_user": latest_event_per_user,
    "duplicate_line_rank": duplicate_line_rank,
    "payment_sequence": payment_sequence,
    "pool_gain": pool_gain,
    "pool_accept_gap": pool_accept_gap,
    "local_to_utc": local_to_utc,
    "elapsed_times": elapsed_times,
    "datetime_add_minutes": datetime_add_minutes,
    "day_of_week_concat": day_of_week_concat,
    "zone_area": zone_area,
    "zone_area_parts": zone_area_parts,
    "slack_bins": slack_bins,
    "ctod_bins": ctod_bins,
    "ctod_text": ctod_text,
    "km_bins": km_bins,
    "drive_bins": drive_bins,
    "ptov_bins": ptov_bins,
    "daypart_bins": daypart_bins,
    "star_join": star_join,
    "inner_chain": inner_chain,
    "left_to_inner": left_to_inner,
    "cast_key_join": cast_key_join,
    "cast_key_tolerant": cast_key_tolerant,
    "contains_normalised": contains_normalised,
    "unnest_inner": unnest_inner,
    "unnest_left": unnest_left,
    "token_explode": token_explode,
    "latest_assignment": latest_assignment,
    "rejection_flags": rejection_flags,
    "refund_rollup": refund_rollup,
    "contact_flags": contact_flags,
    "euro_conversion": euro_conversion,
    "holding_windows": holding_windows,
    "prefix_scan": prefix_scan,
    "mart_roundtrip": mart_roundtrip,
    "colocated_join": colocated_join,
}
