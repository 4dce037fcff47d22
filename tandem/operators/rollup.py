"""Grouped measures: flag counts, conditional distinct counts, currency
conversion, refund lists and wide report rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Local currency units per euro by tenant.
EURO_RATES = [("ca", 1.47), ("uk", 0.851), ("ie", 1.0), ("au", 1.579), ("nz", 1.6)]


def any_and_count(flags: Sequence[str], count_suffix: str = "_count") -> list[Column]:
    """For each boolean flag: SUM(flag as 0/1) (null when no rows) and
    MAX(flag as 0/1) defaulted to 0, named ``<flag><suffix>`` and ``<flag>``."""
    out = []
    for f in flags:
        as_int = F.col(f).cast("long")
        out.append(F.sum(as_int).alias(f + count_suffix))
        out.append(F.coalesce(F.max(as_int), F.lit(0).cast("long")).alias(f))
    return out


def euro_rates(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("tenant_id", T.StringType()),
                           T.StructField("local_currency_to_euros", T.DoubleType())])
    return F.broadcast(spark.createDataFrame(EURO_RATES, schema))  # five rows, whatever the input


def with_euro_rate(df: DataFrame, spark: SparkSession, tenant_col: str = "tenant_id") -> DataFrame:
    """Left-join the five-row rate table (broadcast: its size is fixed)."""
    rates = euro_rates(spark).withColumnRenamed("tenant_id", "__rate_tenant")
    return df.join(rates, F.col(tenant_col) == F.col("__rate_tenant"), "left").drop("__rate_tenant")


def refund_rollup(adjustments: DataFrame, key: str, reason: str, amount: str,
                  list_name: str, total_name: str, digits: int = 3) -> DataFrame:
    """Per ``key``: the distinct reasons as one sorted ', '-joined text (nulls
    skipped) and the rounded total amount."""
    as_text = f"CAST(`{reason}` AS STRING)"
    return adjustments.groupBy(key).agg(
        F.expr(f"listagg(DISTINCT {as_text}, ', ') WITHIN GROUP (ORDER BY {as_text})")
         .alias(list_name),
        F.round(F.sum(F.col(amount)), digits).alias(total_name),
    )


def contact_flag(rows: DataFrame, key: str, ticket_id: str, name: str) -> DataFrame:
    """Per ``key``: 1 if at least one non-null ``ticket_id``, else 0."""
    return rows.groupBy(key).agg(
        F.when(F.count(F.col(ticket_id)) >= 1, F.lit(1)).otherwise(F.lit(0)).alias(name))


def wide_rollup(df: DataFrame, keys: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """GROUP BY many keys with many measures in one aggregation (one shuffle,
    partial aggregation on the map side)."""
    return df.groupBy(*keys).agg(*measures)


def distinct_counts(df: DataFrame, keys: Sequence[str], id_col: str,
                    counts: Sequence[tuple[str, Column | None]]) -> DataFrame:
    """Several ``COUNT(DISTINCT CASE WHEN pred THEN id END)`` over one id column.

    Spark evaluates k distinct aggregates of different expressions by
    expanding every input row k times.  Here rows are first collapsed to one
    per (keys, id) with, per measure, whether its predicate held on any row
    (a partial aggregation that combines before the shuffle), then counted.
    A ``None`` predicate counts every non-null id.  The result equals the
    distinct counts exactly; null ids are never counted, but a key group whose
    ids are all null still appears (with zero counts).
    """
    flags = []
    known = F.col(id_col).isNotNull()
    for i, (_, pred) in enumerate(counts):
        hit = known if pred is None else (known & F.coalesce(pred, F.lit(False)))
        flags.append(F.max(hit.cast("int")).alias(f"__hit{i}"))
    per_id = df.groupBy(*keys, id_col).agg(*flags)
    return per_id.groupBy(*keys).agg(
        *[F.sum(F.col(f"__hit{i}")).cast("long").alias(name) for i, (name, _) in enumerate(counts)])
