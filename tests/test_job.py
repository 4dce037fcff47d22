import json
import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from tandem.plans import job
from tandem.plans.params import FIXTURE_PARAMS as P
from tandem.sources import sink
from tandem.sources.sink import overwrite_mart, read_commit, read_mart


def test_build_all_writes_eight_marts_and_rebuilds_in_place(spark, cat):
    out = tempfile.mkdtemp(prefix="tandem-marts-")
    commits = job.build_all(spark, cat, P, out, log=lambda *_: None, buckets=4)
    assert set(commits) == set(job.MART_NAMES)
    counts = {k: read_commit(spark, c).count() for k, c in commits.items()}
    assert counts["delivery_staging"] > 0 and counts["pooling_summary"] > 0
    again = job.build_all(spark, cat, P, out, log=lambda *_: None, buckets=4, tolerant=True)   # replace whole tables
    assert read_commit(spark, again.pop("ticket_info_rejected")).count() == 0
    assert {k: read_commit(spark, c).count() for k, c in again.items()} == counts
    assert all(c.number == 2 for c in again.values()) and read_commit(spark, commits["delivery_staging"]).count() == counts["delivery_staging"]


def test_job_marts_equal_in_plan_marts(spark, cat):
    """Marts read back from their layouts (dates, buckets) give the same rows."""
    from oracle_check import rows_of
    from tandem.plans import catalogue
    out = tempfile.mkdtemp(prefix="tandem-marts-")
    commits = job.build_all(spark, cat, P, out, log=lambda *_: None)
    for key in ("pooling_summary", "refunds_summary", "delivery_staging", "reorder_info"):
        written = read_commit(spark, commits[key])
        direct = catalogue.QUERIES[key](spark, "/root/testdata/sf0.001")
        cols = sorted(direct.columns)
        assert sorted(written.columns) == cols
        a = rows_of(cols, [tuple(r) for r in written.select(*cols).collect()])
        b = rows_of(cols, [tuple(r) for r in direct.select(*cols).collect()])
        assert a == b, key


def test_a_failed_write_leaves_the_old_mart(spark):
    root = tempfile.mkdtemp(prefix="tandem-marts-")
    overwrite_mart(spark.range(5), root, "m")
    with pytest.raises(Exception, match="broken row"):
        overwrite_mart(spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(
            F.raise_error(F.lit("broken row")).cast("long"))), root, "m")
    assert read_mart(spark, root, "m").count() == 5
    overwrite_mart(spark.range(3), root, "m")
    assert read_mart(spark, root, "m").count() == 3
    sink.expire(spark, root, "m", orphan_hours=0)
    assert len(os.listdir(f"{root}/m/snapshots")) == 2  # the failed write's rest is gone


def test_a_reader_keeps_its_snapshot_and_always_finds_a_mart(spark):
    root = tempfile.mkdtemp(prefix="tandem-marts-")
    with pytest.raises(FileNotFoundError):
        read_mart(spark, root, "m")
    overwrite_mart(spark.range(5), root, "m")
    opened, seen, over = read_mart(spark, root, "m"), [], threading.Event()

    def read():
        while not over.is_set():
            seen.append(sink.current(spark, root, "m"))

    reader = threading.Thread(target=read)
    reader.start()
    overwrite_mart(spark.range(7), root, "m")
    over.set()
    reader.join()
    assert seen and {c.number for c in seen} <= {1, 2} and [c.number for c in seen] == sorted(c.number for c in seen)
    assert opened.count() == 5 and read_mart(spark, root, "m").count() == 7
    overwrite_mart(spark.range(8), root, "m")
    assert len(os.listdir(f"{root}/m/snapshots")) == 2 and sink.current(spark, root, "m").number == 3


def test_an_unfinished_commit_file_is_no_commit(spark):
    root = tempfile.mkdtemp(prefix="tandem-marts-")
    overwrite_mart(spark.range(5), root, "m")
    open(f"{root}/m/commits/000000000002.json", "w").close()  # created, not yet written
    assert read_mart(spark, root, "m").count() == 5
    assert overwrite_mart(spark.range(6), root, "m").number == 3
    assert read_mart(spark, root, "m").count() == 6


def test_a_changed_type_is_refused(spark):
    root = tempfile.mkdtemp(prefix="tandem-marts-")
    first = overwrite_mart(spark.range(5), root, "m")
    for other in (spark.range(5).select(F.col("id").cast("int")), spark.range(5).select(F.col("id").alias("n")),
                  spark.range(5).withColumn("more", F.lit(1))):
        with pytest.raises(ValueError, match="schema"):
            overwrite_mart(other, root, "m", schema=first.schema)
    assert sink.current(spark, root, "m").number == 1


def test_the_job_refuses_a_changed_mart(spark, cat, monkeypatch):
    from tandem.plans import reorders
    out = tempfile.mkdtemp(prefix="tandem-marts-")
    overwrite_mart(reorders.build(cat, P).withColumn("sys_delivery_id", F.col("sys_delivery_id").cast("string")), out, "reorder_info")
    with pytest.raises(ValueError, match="reorder_info"):
        job.build_all(spark, cat, P, out, log=lambda *_: None)


def test_bucketed_marts_join_without_an_exchange(spark, cat):
    """The summary over stored marts: neither the staging rows nor the repeat orders nor
    the tickets move for the delivery-id joins."""
    from tandem.plans import reorders, staging, summary, tickets
    out = tempfile.mkdtemp(prefix="tandem-marts-")
    m2 = staging.build(cat, P)
    frames = {"delivery_staging": m2, "reorder_info": reorders.build(cat, P), "ticket_info": tickets.build(cat, P, m2)}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def moved(**layout):
            marts = [read_commit(spark, overwrite_mart(df, out, f"{name}{len(layout)}", **layout)) for name, df in frames.items()]
            text = summary.build(cat, spark, *marts)._jdf.queryExecution().executedPlan().toString()
            on = "Exchange hashpartitioning(sys_delivery_id"
            return sum(on in ln for ln in text.splitlines())

        plain, placed = moved(), moved(bucket_by=["sys_delivery_id"], buckets=8)
        # what is left: the pool times (a window on the pool) and the rejecting couriers (an input table, twice)
        assert (plain, placed) == (6, 3)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_bad_ticket_ends_the_job_or_is_set_aside(spark):
    from tandem.plans import tickets
    from tandem.sources.catalog import Catalog
    schema = ("ticket struct<ticket_order_id_local:string, contact_origin:string, ticket_origin:string, "
              "chat_ids_list:array<string>, call_ids_list:array<struct<call_segment_id:string>>>")
    rows = [((n, "originator_customer", "origin_offline", ["a"], []),) for n in ("1", "2", "x3", "", "x3", "9" * 30, "4.5", None)]
    own = Catalog(spark, {"tickets": lambda: spark.createDataFrame(rows, schema)})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|x3"):
        tickets.ticket_rows(own).collect()
    assert sorted(r.order_no for r in tickets.ticket_rows(own, tolerant=True).collect()) == [1, 2]
    assert sorted(map(tuple, tickets.rejected_tickets(own).collect())) == [("", 1), ("4.5", 1), ("9" * 30, 1), ("x3", 2)]


def test_table_family_with_a_member_lacking_a_column(spark):
    from tandem.sources.catalog import parquet_catalog
    root = tempfile.mkdtemp(prefix="tandem-family-")
    spark.range(2).write.parquet(f"{root}/part_1")
    spark.range(3).withColumn("note", F.lit("x")).write.parquet(f"{root}/part_2")
    rows = parquet_catalog(spark, {"family": f"{root}/part_*"})["family"]
    assert sorted(rows.columns) == ["id", "note"]
    assert rows.count() == 5 and rows.where("note IS NULL").count() == 2


def test_input_paths_must_name_every_input(tmp_path):
    from tandem.sources.catalog import INPUTS
    file = tmp_path / "paths.json"
    file.write_text(json.dumps({n: f"/data/{n}" for n in INPUTS}))
    assert set(job.read_paths(str(file))) == set(INPUTS)
    file.write_text("{}")
    with pytest.raises(ValueError, match="fact_deliveries"):
        job.read_paths(str(file))
