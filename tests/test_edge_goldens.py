"""Hand-made edge rows (FIXTURES.md section 4) through the mart operators."""

import datetime as dt

from pyspark.sql import functions as F

from tandem.plans import reorders, staging, tickets
from tandem.plans.params import FIXTURE_PARAMS as P
from tandem.sources.catalog import Catalog


def test_reorder_gap_rule(spark):
    cols = reorders.reorder_columns(4)
    gaps = [cols[2], cols[5], cols[8], cols[11]]
    rows = [
        (1, None, None, None, None),   # no next order: dropped
        (2, 60, None, None, None),     # first gap 60: kept
        (3, 61, None, None, None),     # first gap 61: dropped
        (4, 10, 61, None, None),       # a later gap over 60: dropped
        (5, 10, 20, None, 5),          # later gaps null or small: kept
    ]
    df = spark.createDataFrame(rows, f"sys_delivery_id long, {gaps[0]} long, {gaps[1]} long, "
                                     f"{gaps[2]} long, {gaps[3]} long")
    kept = sorted(r.sys_delivery_id for r in df.where(reorders.gap_filter(60, 4)).collect())
    assert kept == [2, 5]


def test_orders_without_a_customer_follow_no_one(spark, cat):
    """Half of the orders have no customer: the option leaves them without next orders and
    everyone else's chain as it is."""
    o = cat["fact_orders_resto"]
    own = cat.with_table("fact_orders_resto", o.withColumn("sys_custo_id", F.when(F.col("sys_order_id") % 2 == 0, F.col("sys_custo_id"))))
    nobodys = {r.d for r in own["fact_orders_resto"].where("sys_custo_id IS NULL").join(cat["fact_deliveries"], "sys_order_id")
               .select(F.col("sys_delivery_id").alias("d")).collect()}
    plain = {r.sys_delivery_id: tuple(r) for r in reorders.chain(own, P, all_tenants=True).collect()}
    dropped = {r.sys_delivery_id: tuple(r) for r in reorders.chain(own, P, all_tenants=True, drop_null_customer=True).collect()}
    assert set(plain) == set(dropped) and len(nobodys & set(plain)) > 100
    assert all(dropped[d][1:] == (None,) * 12 for d in nobodys & set(plain))
    assert any(plain[d][1] is not None for d in nobodys & set(plain))
    assert all(dropped[d] == plain[d] for d in set(plain) - nobodys)
    assert {r.sys_delivery_id for r in reorders.build(own, P, drop_null_customer=True).collect()}.isdisjoint(nobodys)


def _pool_rows(spark, rows):
    schema = ("sys_delivery_id long, ccdd_id long, multi_collect_sequence long, "
              "collect_total_driving_time_min double, delivery_total_driving_time_min double, "
              "deliver_original_total_driving_time_min double, ccdd_courier_analysis_handle_time_sec long")
    return spark.createDataFrame(rows, schema)


def test_pool_gain_legs(spark):
    rows = [
        (1, 10, 1, 5.0, 3.0, 7.0, 100),      # pool 10: leg 1 only
        (2, 20, 1, 4.0, 2.0, 6.0, 50),       # pool 20: legs 1 and 2
        (3, 20, 2, 8.0, 9.0, 1.0, 50),
        (4, 30, 1, 1.0, 1.5, 2.0, 10),       # pool 30: three legs
        (5, 30, 2, 2.0, 2.5, 3.0, 10),
        (6, 30, 3, 9.0, 3.5, 4.0, 10),
        (7, None, None, 6.0, 6.0, 6.0, None),  # not pooled
        (8, 40, 2, 3.0, 3.0, 3.0, 20),       # leg 2 without leg 1
    ]
    out = {r.sys_delivery_id: r for r in staging.with_pool_columns(_pool_rows(spark, rows)).collect()}
    assert out[1].pooling_capacity_gains_sec == 0.0 and out[1].first_order_deliver_original_total_driving_time_min == 7.0
    # leg 2: pool max collect 8 min -> 480 s, + handle 50 s, - previous leg delivery 2 min -> 120 s
    assert out[3].collect_total_driving_time_sec_max_ccdd == 480.0
    assert out[3].delivery_total_driving_time_min_previous_leg == 120.0
    assert out[3].pooling_capacity_gains_sec == 410.0
    assert out[3].first_order_deliver_original_total_driving_time_min == 6.0
    assert out[5].pooling_capacity_gains_sec == 9.0 * 60 + 10 - 1.5 * 60  # max over all three legs
    assert out[6].pooling_capacity_gains_sec == 0.0                        # third leg: no gain
    assert out[7].pooling_capacity_gains_sec == 0.0
    assert out[7].first_order_deliver_original_total_driving_time_min is None
    assert out[8].pooling_capacity_gains_sec is None                       # no previous leg: null
    assert out[8].first_order_deliver_original_total_driving_time_min is None
    assert len(out) == 8


def test_several_first_legs_and_repeated_rows(spark):
    """Two leg-1 rows in a pool, one of them without a time, give each row of the pool
    twice; a row given twice counts as two; unpooled leg-1 rows are no first legs."""
    rows = [(1, 10, 1, 5.0, 3.0, 7.0, 100), (2, 10, 1, 5.0, 3.0, None, 100), (3, 10, 2, 8.0, 9.0, 1.0, 50),
            (4, 20, 1, 1.0, 1.0, 2.0, 1), (4, 20, 1, 1.0, 1.0, 2.0, 1), (5, 20, 2, 1.0, 1.0, 3.0, 1),
            (6, None, 1, 1.0, 1.0, 4.0, 1), (7, None, 2, 1.0, 1.0, 5.0, 1)]
    got = {}
    for r in staging.with_pool_columns(_pool_rows(spark, rows)).collect():
        got.setdefault(r.sys_delivery_id, []).append(r.first_order_deliver_original_total_driving_time_min)
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        1: [7.0, None], 2: [7.0, None], 3: [7.0, None], 4: [2.0] * 4, 5: [2.0] * 2, 6: [None], 7: [None]}


def _ticket_catalog(spark, rows):
    schema = ("ticket struct<ticket_order_id_local:string, contact_origin:string, ticket_origin:string, "
              "ticket_id_local:string, query_type:string, chat_ids_list:array<string>, "
              "call_ids_list:array<struct<call_segment_id:string>>>")
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return Catalog(spark, {"tickets": lambda: df})


def test_ticket_unnest_rules(spark):
    def t(order, origin, chats, calls, who="originator_customer"):
        return (order, who, origin, "t", "q", chats, None if calls is None else [(c,) for c in calls])
    rows = [
        t("1", "origin_web", None, None),                 # no chat, no call, online: fails
        t("2", "origin_offline", [], []),                 # offline, empty lists: one row
        t("3", "origin_web", ["a", "b"], ["x", "y", "z"]),  # chats x calls: 6 rows
        t("4", "origin_web", [], ["x"]),                  # a call only: 1 row
        t("5", "origin_offline", ["a"], None, who="originator_agent"),  # not from the customer
        t(None, "origin_offline", ["a"], None),           # no order id
    ]
    got = sorted(r.order_no for r in tickets.ticket_rows(_ticket_catalog(spark, rows)).collect())
    assert got == [2, 3, 3, 3, 3, 3, 3, 4]


def test_last_day_only_midnight_passes(spark):
    start, end = P.refunds_window()
    last = dt.datetime(2001, 8, 1)
    df = spark.createDataFrame([(last,), (last + dt.timedelta(seconds=1),), (dt.datetime(2001, 7, 31, 23, 59),)],
                               "t timestamp_ntz")
    kept = [r.t for r in df.where(F.col("t").between(start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))).collect()]
    assert kept == [last, dt.datetime(2001, 7, 31, 23, 59)]
