"""The registered query catalogue: name -> callable(spark, sf_dir) -> DataFrame.

Every query derives the domain tables from the driver tables in ``sf_dir``
and runs over all of them (the fixture window selects the whole history).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.sink import materialize
from ..sources.adapter import driver_catalog
from . import refunds, reorders, staging, summary, tickets, unit_queries, utilisation
from .params import FIXTURE_PARAMS

FLAGSHIP = "pooling_summary"


def _cat(spark: SparkSession, sf_dir: str):
    return driver_catalog(spark, sf_dir)


def _materialized(spark: SparkSession, df: DataFrame) -> DataFrame:
    """An upstream mart as its readers see it in the job: computed once and
    written (a table in the shared checkpoint folder), so a mart read several
    times is not recomputed and its lineage is cut."""
    return materialize(df, "mart")


def reorder_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reorders.build(_cat(spark, sf_dir), FIXTURE_PARAMS)


def delivery_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.build(_cat(spark, sf_dir), FIXTURE_PARAMS)


def ticket_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _cat(spark, sf_dir)
    # read once: no need to store staging first; Spark prunes it to the columns used
    return tickets.build(cat, FIXTURE_PARAMS, staging.build(cat, FIXTURE_PARAMS))


def pooling_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = _cat(spark, sf_dir)
    m1 = reorders.build(cat, FIXTURE_PARAMS)
    # staging is read twice (directly and through the ticket mart): store it once
    m2 = _materialized(spark, staging.build(cat, FIXTURE_PARAMS))
    m3 = tickets.build(cat, FIXTURE_PARAMS, m2)
    return summary.build(cat, spark, m2, m1, m3)


def refund_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refunds.refund_detail(_cat(spark, sf_dir), FIXTURE_PARAMS)


def refunds_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refunds.refunds_summary(refund_detail(spark, sf_dir), FIXTURE_PARAMS)


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refunds.order_counts(refund_detail(spark, sf_dir), FIXTURE_PARAMS)


def utilisation_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utilisation.build(_cat(spark, sf_dir), FIXTURE_PARAMS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "reorder_info": reorder_info,
    "delivery_staging": delivery_staging,
    "ticket_info": ticket_info,
    "pooling_summary": pooling_summary,
    "refund_detail": refund_detail,
    "refunds_summary": refunds_summary,
    "order_counts": order_counts,
    "utilisation": utilisation_mart,
}
QUERIES.update(unit_queries.QUERIES)
