"""M3 - ticket info: one row per customer ticket x chat x call that passes the
contact rules, for the staged deliveries (not de-duplicated, as in the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Catalog
from .params import ReportParams

# Which tickets count as customer contacts.
CUSTOMER_ORIGIN = "originator_customer"
OFFLINE_ORIGINS = ["origin_offline", "origin_self_serve_offline"]


def customer_tickets(cat: Catalog) -> DataFrame:
    """The customers' tickets that name an order: its number as given, origin, lists."""
    z = "ticket."
    return (cat["tickets"]
            .where(F.col(z + "ticket_order_id_local").isNotNull()
                   & (F.col(z + "contact_origin") == CUSTOMER_ORIGIN))
            .select(F.col(z + "ticket_order_id_local").alias("order_text"),
                    F.col(z + "ticket_origin").alias("origin"),
                    F.col(z + "chat_ids_list").alias("chats"),
                    F.col(z + "call_ids_list").alias("calls")))


def rejected_tickets(cat: Catalog) -> DataFrame:
    """The order texts of tickets that :func:`ticket_rows` leaves out when ``tolerant``,
    and how many tickets have each."""
    bad = customer_tickets(cat).where(F.col("order_text").try_cast("long").isNull())
    return bad.groupBy("order_text").agg(F.count(F.lit(1)).alias("tickets"))


def ticket_rows(cat: Catalog, tolerant: bool = False) -> DataFrame:
    """Tickets unnested to ticket x chat x call rows that pass the rules.

    Both unnests keep a ticket whose list is empty or null (one row with a
    null element), as ``LEFT JOIN UNNEST`` does.  The per-ticket tests run
    before the unnest, so only passing tickets are expanded.  An order text
    that is no number ends the query, as the reference's cast does; with
    ``tolerant`` its ticket is left out (see :func:`rejected_tickets`).
    """
    text = F.col("order_text")
    number = text.try_cast("long") if tolerant else text.cast("long")
    base = customer_tickets(cat).select(number.alias("order_no"), "origin", "chats", "calls")
    if tolerant:
        base = base.where(F.col("order_no").isNotNull())
    per_chat = base.select("order_no", "origin", "calls", F.explode_outer("chats").alias("chat"))
    per_call = per_chat.select("order_no", "origin", "chat", F.explode_outer("calls").alias("call"))
    passes = (F.col("origin").isin(OFFLINE_ORIGINS)
              | F.col("call.call_segment_id").isNotNull()
              | F.col("chat").isNotNull())
    return per_call.where(passes).select("order_no")


def build(cat: Catalog, p: ReportParams, staging_mart: DataFrame, tolerant: bool = False) -> DataFrame:
    ds = (staging_mart.where(F.col("tenant_id") == p.tenant)
          .select("tenant_id", "sys_delivery_id", "public_order_number"))
    rows = ticket_rows(cat, tolerant)
    return (ds.join(rows, ds.public_order_number == rows.order_no, "inner")
              .select("tenant_id", "sys_delivery_id", F.lit(1).cast("long").alias("has_ticket")))
