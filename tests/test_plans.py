"""Physical-plan checks: the properties the scale design relies on."""

import pytest

from tandem.plans import catalogue, reorders, staging, summary, tickets
from tandem.plans.params import FIXTURE_PARAMS as P

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_bounds_pushed_to_parquet(spark):
    """The window rule folds to literals and reaches the Parquet scan."""
    from pyspark.sql import functions as F
    from tandem.functions.dates import date_window
    df = spark.read.parquet(f"{SF}/orders.parquet")
    s, e = date_window(F.lit(P.as_of), P.cutoff, P.floor)
    out = df.where(F.col("o_orderdate").cast("date").between(s, e)).select("o_orderkey")
    text = plan(out)
    assert "PushedFilters" in text
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in text
    assert "LessThan(o_orderdate,2" in text  # the plan string truncates the literal
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_pool_window_spreads_unpooled_rows_in_one_exchange(spark, cat):
    spark.catalog.clearCache()  # a cached copy would show its own plan as well
    text = plan(staging.build(cat, P))
    pool_exchanges = [ln for ln in text.splitlines() if "Exchange hashpartitioning(ccdd_id" in ln]
    assert len(pool_exchanges) == 1
    assert "__salt" in pool_exchanges[0]  # null pool ids are salted, not one partition


def test_rates_table_is_broadcast(spark):
    df = catalogue.QUERIES["euro_conversion"](spark, SF)
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_lead_chain_is_one_lazy_plan(spark, cat):
    """No job runs while the plan is made, and no group is partitioned by its key alone but for the heads."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lead-chain", "plan only")
    text = plan(reorders.chain(cat, P))
    assert len(tracker.getJobIdsForGroup("lead-chain")) == 0
    assert "__bucket" in text


@pytest.fixture(scope="module")
def stored(spark, cat, tmp_path_factory):
    """The inputs as tables of their own, as in production."""
    from tandem.sources.catalog import INPUTS, parquet_catalog
    root = tmp_path_factory.mktemp("inputs")
    for name in INPUTS:
        cat[name].write.parquet(f"{root}/{name}")
    return parquet_catalog(spark, {name: f"{root}/{name}" for name in INPUTS}), str(root)


@pytest.fixture
def shuffled(spark):
    """Plans as for tables too large to broadcast, before any run."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def widths(df):
    """(partitioning, number of columns) of each hash exchange of the plan."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString().split("\n")[0]:
            found.append((node.toString().split("\n")[0], node.output().size()))
    return found


def test_staging_reads_each_input_once(stored, shuffled):
    """The first legs and the assignments cost no second star join."""
    cat, root = stored
    text = plan(staging.build(cat, P))
    for name in ("fact_orders_resto", "fact_order_financial_metrics", "fact_resto_reviews", "pos_injection", "dim_resto",
                 "bridge_multi_collect", "global_adjustments", "assignment_log", "bridge_blacklisted_couriers"):
        assert text.count(f"{root}/{name}]") == 1, name
    scans = [ln for ln in text.splitlines() if f"{root}/fact_deliveries]" in ln]
    assert len(scans) == 2  # the second one, for the uuids, has four columns
    assert min(ln.split("ReadSchema")[1].count(":") for ln in scans) <= 5


def test_staging_rows_cross_three_exchanges(stored, shuffled):
    """On the order, the delivery and the pool; dimensions are small (broadcast) in production."""
    cat, _ = stored
    wide = [line for line, columns in widths(staging.build(cat, P)) if columns > 25]
    by = lambda key: [w for w in wide if key in w.split("),")[0]]
    facts = [w for w in wide if not any(k in w for k in ("resto_id", "zone_id"))]
    assert len(facts) <= 3, facts
    assert len(by("sys_delivery_id")) == 1 and len(by("ccdd_id")) == 1


def test_summary_plan_has_no_expand(spark, stored, shuffled):
    """Distinct counts without copies of the rows."""
    cat, _ = stored
    m2 = staging.build(cat, P)
    text = plan(summary.build(cat, spark, m2, reorders.build(cat, P), tickets.build(cat, P, m2)))
    rollup = text.split("SortMergeJoin")[0]  # what stands above the joins
    assert "Expand" not in rollup and "HashAggregate" in rollup


def test_assignments_are_found_without_sorting_the_log(spark, shuffled):
    """The latest message per courier and delivery, ties and missing times included."""
    from tandem.sources.catalog import Catalog
    one, two = ("0" * 8 + "-0000-0000-0000-" + f"{n:012d}" for n in (1, 2))
    both, own = f"COLLECT:{one};COLLECT:{two}", f"COLLECT:{one}"
    rows = [(1, "2024-01-01 10:00:00", both), (1, "2024-01-01 11:00:00", own),  # 1: last message with one job
            (2, "2024-01-01 09:00:00", own), (2, None, f"{both}"), (2, "2024-01-01 09:00:00", own),  # no time: before all others
            (3, None, own), (3, None, own)]
    schema = "courierId long, t string, jobs string"
    log = spark.createDataFrame(rows, schema).selectExpr(
        "courierId", "cast(t as timestamp_ntz) as timestamp", "named_struct('assignedJobs', jobs) as jobChanges")

    def flags(log):
        df = staging.assignment_flags(Catalog(spark, {"assignment_log": lambda: log}))
        assert "Sort" not in plan(df) and "Window" not in plan(df)
        return {r.delivery_uuid: r.is_assigned_as_multi_collect for r in df.collect()}

    assert flags(log) == {one: 0, two: 1}
    tie = log.union(log.where("courierId = 1").limit(1).selectExpr(
        "courierId", "timestamp'2024-01-01 11:00:00'::timestamp_ntz", f"named_struct('assignedJobs', '{both}')"))
    assert flags(tie) == {one: 1, two: 1}


def test_zone_areas_are_worked_out_per_zone(spark, stored, shuffled):
    """No staging row carries a polygon."""
    cat, _ = stored
    df = staging.build(cat, P)
    lines = [ln for ln in plan(df).splitlines() if "polygon" in ln]
    assert lines and all("fd_" not in ln and "sys_order_id" not in ln for ln in lines)
    areas = {r.k: r.a for r in df.selectExpr("sys_courier_delivery_zone_id as k", "zone_area_square_km as a").distinct().collect()}
    own = spark.read.parquet(f"{SF}/nation.parquet").count()
    assert areas and len(areas) <= own and all(a and a > 0 for a in areas.values())


def test_adjustments_join_without_a_second_exchange(spark, cat, shuffled):
    other = spark.range(10).withColumnRenamed("id", "sys_delivery_id")
    text = plan(other.join(cat["global_adjustments"], "sys_delivery_id", "left"))
    assert sum("Exchange hashpartitioning" in ln for ln in text.splitlines()) == 2


def test_wide_stages_stay_within_compiled_methods(spark, cat):
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    try:
        for given, want in (("65535", "8000"), ("20000", "20000")):  # a limit set by the user stays
            spark.conf.set(key, given)
            staging.build(cat, P)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, old)
