"""M1 - repeat orders: for each delivered order, the customer's next four
orders, how many days apart they were, and their food subtotals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_diff
from ..operators.windows import hour_of, lead_chain
from ..sources.catalog import Catalog
from .params import ReportParams

ORDINALS = ["first", "second", "third", "fourth"]


def reorder_columns(depth: int = 4) -> list[str]:
    cols = ["sys_delivery_id"]
    prev = "current_order"
    for i in range(depth):
        name = ORDINALS[i]
        cols += [f"{name}_reorder_sys_delivery_id",
                 f"days_between_{prev}_and_{name}_reorder",
                 f"{name}_reorder_food_subtotal"]
        prev = f"{name}_reorder"
    return cols


def delivered_orders(cat: Catalog, p: ReportParams, all_tenants: bool = False) -> DataFrame:
    """Delivered deliveries of the tenant with their order, inside the window.

    The reference LEFT JOINs the order and then filters on its date, which
    makes it an inner join; written as one here.
    """
    start, end = p.window()
    keep = F.col("delivery_status") == "DELIVERED"
    if not all_tenants:
        keep = keep & (F.col("tenant_id") == p.tenant)
    fd = cat["fact_deliveries"].where(keep).select("tenant_id", "sys_delivery_id", "sys_order_id")
    fo = (cat["fact_orders_resto"]
          .where(F.col("order_date").between(start, end))
          .select("sys_order_id", "sys_custo_id", "order_date", "order_datetime", "food_subtotal"))
    return fd.join(fo, "sys_order_id", "inner")


def gap_filter(max_days: int, depth: int = 4) -> Column:
    """First gap must be known and <= max_days; later gaps <= max_days or null."""
    names = reorder_columns(depth)
    gaps = [names[2 + 3 * i] for i in range(depth)]
    cond = F.col(gaps[0]) <= F.lit(max_days)
    for g in gaps[1:]:
        cond = cond & ((F.col(g) <= F.lit(max_days)) | F.col(g).isNull())
    return cond


def chain(cat: Catalog, p: ReportParams, all_tenants: bool = False, drop_null_customer: bool = False) -> DataFrame:
    """Each delivery with its customer's next ``depth`` orders (no gap rule).

    The reference's window makes one customer of all orders without a customer.  With
    ``drop_null_customer`` they follow no one: they are taken out before the chain, which
    then neither sorts nor shuffles them, and come back with no next orders."""
    depth = p.reorder_depth
    staged = delivered_orders(cat, p, all_tenants)
    known = staged.where(F.col("sys_custo_id").isNotNull()) if drop_null_customer else staged
    chained = lead_chain(
        known,
        keys=["tenant_id", "sys_custo_id"],
        order=["order_datetime", "sys_delivery_id"],
        values={"sys_delivery_id": "__id_{n}", "order_date": "__date_{n}",
                "food_subtotal": "__sub_{n}"},
        depth=depth,
        bucket=hour_of("order_datetime"),
    )
    if drop_null_customer:
        chained = chained.unionByName(staged.where(F.col("sys_custo_id").isNull()), allowMissingColumns=True)
    names = reorder_columns(depth)
    out = [F.col("sys_delivery_id")]
    prev_date = F.col("order_date")
    for n in range(1, depth + 1):
        base = 1 + 3 * (n - 1)
        out += [F.col(f"__id_{n}").alias(names[base]),
                day_diff(F.col(f"__date_{n}"), prev_date).cast("long").alias(names[base + 1]),
                F.col(f"__sub_{n}").alias(names[base + 2])]
        prev_date = F.col(f"__date_{n}")
    return chained.select(*out)


def build(cat: Catalog, p: ReportParams, drop_null_customer: bool = False) -> DataFrame:
    return chain(cat, p, drop_null_customer=drop_null_customer).where(gap_filter(p.max_reorder_gap_days, p.reorder_depth))
