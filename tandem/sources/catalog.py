"""Where the marts get their inputs, and where they put their outputs.

A catalogue maps the logical input names below to DataFrames.  In production
the names resolve to Parquet paths (a path may be a glob, which covers the
warehouse's table families read by prefix); in tests and in the bench they are
derived from the driver's tables by :mod:`tandem.sources.adapter`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Logical inputs of the reporting job.
INPUTS = (
    "fact_deliveries",
    "fact_orders_resto",
    "dim_resto",
    "bridge_multi_collect",
    "fact_order_financial_metrics",
    "dim_zones",
    "dim_resto_grouping",
    "fact_resto_reviews",
    "global_adjustments",
    "pos_injection",
    "assignment_log",
    "bridge_blacklisted_couriers",
    "hold_container_live",
    "hold_container_archive",
    "tickets",
    "fact_order_net_adjustments",
    "bridge_shift_delivery",
    "dim_courier_shifts",
    "dim_couriers",
)


class Catalog:
    """Name -> DataFrame, built once per catalogue so that every mart reading
    a table shares one plan node (Spark then reuses identical exchanges)."""

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"no input named {name!r}")
            self._frames[name] = self._loaders[name]()
        return self._frames[name]

    __getitem__ = table

    def with_table(self, name: str, df: DataFrame) -> "Catalog":
        """A copy where ``name`` resolves to ``df`` (e.g. a mart read back from storage)."""
        out = Catalog(self.spark, self._loaders)
        out._frames = dict(self._frames)
        out._frames[name] = df
        return out


def parquet_catalog(spark: SparkSession, paths: Mapping[str, str]) -> Catalog:
    """Catalogue over Parquet paths or globs (one glob = a whole table family).

    The members of a family may differ in columns: a glob is read with the
    union of their schemas, nulls where a member lacks a column.
    """
    def load(path: str) -> DataFrame:
        return spark.read.option("mergeSchema", str("*" in path).lower()).parquet(path)

    return Catalog(spark, {n: (lambda p=p: load(p)) for n, p in paths.items()})
