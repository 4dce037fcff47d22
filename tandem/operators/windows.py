"""Ordered-window operators: latest row per key, lead chains, pool neighbours,
payment sequences.

Where the reference leaves an order open (ties, ROW_NUMBER without ORDER BY)
these operators add explicit tie-breakers, so a rerun gives the same rows; the
result is always one of the answers the reference could give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def hour_of(name: str) -> Column:
    """The hour of a wall time, as a text that sorts like the time and does
    not depend on the session's zone: a bucket for long groups."""
    return F.substring(F.col(name).cast("string"), 1, 13)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order_desc`` tuple
    (``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1``).

    Spark plans this as a per-task top-1 (``WindowGroupLimit`` Partial)
    before the shuffle and a final top-1 after it, so a key holding a large
    share of the rows sends at most one row per map task across the network.
    Later ``order_desc`` columns break ties; nulls sort last.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_desc])
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == F.lit(1)).drop("__rn"))


def lead_chain(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               values: dict[str, str], depth: int, bucket: Column) -> DataFrame:
    """Adds ``LEAD(col, n)`` for n = 1..depth for every ``values`` column.

    ``values`` maps a source column to an output name template holding ``{n}``.
    ``order`` must be a total order within a group (end it with a unique id);
    ``bucket`` must not decrease along it (e.g. the hour of a time).

    One plan for groups of any size.  Leads are taken within (keys, bucket),
    so a group that holds most rows is cut into its buckets.  The rows that
    follow a bucket are the heads, the first ``depth`` rows, of the buckets
    after it: a window over the heads only finds them, and the last rows of
    each bucket take them over.
    """
    ahead = range(1, depth + 1)
    packed = F.struct(*[F.col(src).alias(src) for src in values])
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*_cols(order))
    rows = df.withColumn("__bucket", bucket).withColumn("__place", F.row_number().over(inside))
    for n in ahead:
        rows = rows.withColumn(f"__lead_{n}", F.lead(packed, n).over(inside))
    rows = rows.withColumn("__size", F.count(F.lit(1)).over(Window.partitionBy(*keys, "__bucket")))

    heads = rows.where(F.col("__place") <= F.lit(depth)).select(
        *keys, "__bucket", "__place", (F.col("__place") == F.least("__size", F.lit(depth))).alias("__last"),
        packed.alias("__head"))
    along = Window.partitionBy(*keys).orderBy(F.col("__bucket").asc_nulls_first(), "__place")
    after = (heads.withColumn("__next", F.array(*[F.lead("__head", n).over(along) for n in ahead]))
             .where(F.col("__last"))
             .select(*[F.col(k).alias("__h_" + k) for k in keys], F.col("__bucket").alias("__h_bucket"), "__next"))
    cond = F.col("__bucket").eqNullSafe(F.col("__h_bucket"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("__h_" + k))
    out = rows.join(after, cond, "inner")
    for n in ahead:
        # past the end of the bucket: as many places into what follows it
        beyond = F.get("__next", (F.col("__place") + F.lit(n) - F.col("__size") - F.lit(1)).cast("int"))
        lead = F.when(F.col("__place") + F.lit(n) <= F.col("__size"), F.col(f"__lead_{n}")).otherwise(beyond)
        out = out.withColumn(f"__lead_{n}", lead)
    added = [F.col(f"__lead_{n}")[src].alias(tmpl.format(n=n)) for n in ahead for src, tmpl in values.items()]
    return out.select(*[F.col(c) for c in df.columns], *added)


def dense_and_row_number(df: DataFrame, group: Sequence[str], sub_group: Sequence[str],
                         order: Sequence[Column], row_name: str, dense_name: str, bucket: Column,
                         row_tiebreak: Sequence[Column] = ()) -> DataFrame:
    """``ROW_NUMBER`` within (group, sub_group) and ``DENSE_RANK`` within group,
    both by ``order``; ``row_tiebreak`` makes the row numbers repeatable.

    ``bucket`` must not decrease along ``order`` and must be equal for rows
    equal in it (e.g. the hour of the time ordered by; nulls first, as Spark
    sorts them).  One plan for groups of any size, the null group included:
    numbers are taken within (group, bucket), and each bucket adds the totals
    of the buckets before it, a window over one row per bucket and sub-group.
    """
    inside = Window.partitionBy(*group, "__bucket")
    sub = Window.partitionBy(*group, *sub_group, "__bucket").orderBy(*order, *row_tiebreak)
    # The coarser windows first: their hash partitioning also serves the finer one.
    rows = (df.withColumn("__bucket", bucket)
              .withColumn("__dense", F.dense_rank().over(inside.orderBy(*order)).cast("long"))
              .withColumn("__dense_all", F.max("__dense").over(inside))
              .withColumn("__row", F.row_number().over(sub).cast("long")))

    keys = [*group, *sub_group, "__bucket"]
    totals = (rows.groupBy(*keys).agg(F.max("__row").alias("__n_rows"), F.max("__dense_all").alias("__n_dense"))
              # a bucket's ranks count once, not once for every sub-group in it
              .withColumn("__first", F.row_number().over(inside.orderBy(*sub_group)) == F.lit(1)))
    along = F.col("__bucket").asc_nulls_first()
    ranks = F.sum(F.when(F.col("__first"), F.col("__n_dense")).otherwise(F.lit(0))).over(
        Window.partitionBy(*group).orderBy(along).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    numbers = F.sum("__n_rows").over(
        Window.partitionBy(*group, *sub_group).orderBy(along).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    before = totals.select(*[F.col(k).alias("__b_" + k) for k in keys],
                           (ranks - F.col("__n_dense")).alias("__dense_before"),
                           (numbers - F.col("__n_rows")).alias("__rows_before"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("__b_" + k))
    return (rows.join(before, cond, "inner")
                .select(*[F.col(c) for c in df.columns],
                        (F.col("__dense") + F.col("__dense_before")).alias(dense_name),
                        (F.col("__row") + F.col("__rows_before")).alias(row_name)))


def with_group_salt(df: DataFrame, key: str, spread_by: str, name: str = "__salt") -> DataFrame:
    """Adds the salt column used by :func:`group_window`: for rows without a
    group a hash of their own id, so that they spread however many they are."""
    salt = F.when(F.col(key).isNull(), F.xxhash64(F.col(spread_by))).otherwise(F.lit(0).cast("long"))
    return df.withColumn(name, salt)


def group_window(key: str, salt: str = "__salt"):
    """``Window.partitionBy(key)`` for small groups (a pool's legs) where
    rows without a group (null key) are many: with the salt column from
    :func:`with_group_salt`, those rows are spread over many window partitions
    by a hash instead of forming one huge partition.  Callers must ignore
    window results on null-key rows, which the reference discards as well.
    The salt is a real column so every window over it shares one exchange."""
    return Window.partitionBy(F.col(key), F.col(salt))
