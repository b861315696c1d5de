"""Item lists inside an order event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_count(items: Column) -> Column:
    """Lines in the list; 0 for a missing list."""
    return F.when(items.isNull(), 0).otherwise(F.size(items)).cast("bigint")


def to_event_items(items: Column) -> Column:
    """Stored Pascal-case items -> event items."""
    return F.transform(
        items,
        lambda i: F.struct(
            i["ProductId"].cast("string").alias("productId"), i["Count"].alias("count")
        ),
    )


def to_payload_items(items: Column) -> Column:
    """Event items -> stored Pascal-case items."""
    return F.transform(
        items,
        lambda i: F.struct(i["productId"].alias("ProductId"), i["count"].alias("Count")),
    )
