"""Row rules, quarantine, key checks and column defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import ENTITY_ORDER, ORDER_STATUSES, OUTBOX_STATUSES, ZERO_UUID

# Column defaults of the stored tables.
ORDER_DEFAULTS = {"status": "PENDING", "customer_id": ZERO_UUID}
ITEM_DEFAULTS = {"product_id": ZERO_UUID}
OUTBOX_DEFAULTS = {"status": "PENDING", "retry_count": 0, "entity_type": ENTITY_ORDER}


def order_contract(code: str, customer: str, items: str) -> dict[str, Column]:
    """Rules for a placed order event; a rule holds where its column is true."""
    lines = F.col(items)
    return {
        "code_present": F.col(code).isNotNull(),
        "customer_present": F.col(customer).isNotNull(),
        "items_present": lines.isNotNull() & (F.size(lines) > 0),
        "counts_positive": lines.isNull() | F.forall(lines, lambda i: i["count"] > 0),
    }


def item_rules() -> dict[str, Column]:
    return {
        "order_present": F.col("order_id").isNotNull(),
        "product_present": F.col("product_id").isNotNull(),
        "count_positive": F.col("count") > 0,
    }


def status_rule(column: str = "status", outbox: bool = False) -> dict[str, Column]:
    allowed = OUTBOX_STATUSES if outbox else ORDER_STATUSES
    return {"status_allowed": F.col(column).isin(*allowed)}


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``violations``: the names of the rules that do not hold. Null means broken."""
    broken = [F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) of a checked frame."""
    clean = F.size("violations") == 0
    return checked.where(clean).drop("violations"), checked.where(~clean)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is missing in ``parents`` (foreign key check)."""
    return children.join(parents.select(key), key, "left_anti")


def surviving_children(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows left after their parents were deleted (cascade)."""
    return children.join(parents.select(key), key, "left_semi")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls; a column that is not there is added with its default."""
    columns = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(columns)


def guard(df: DataFrame, decoded: str) -> DataFrame:
    """Keep rows whose value decoded to the expected type."""
    return df.where(F.col(decoded).isNotNull())


def guard_counts(df: DataFrame, reason: Column, by: Sequence[str] = ()) -> DataFrame:
    """Rows per reason; ``decoded`` where the reason is null."""
    return df.groupBy(*by, F.coalesce(reason, F.lit("decoded")).alias("reason")).agg(
        F.count("*").alias("rows")
    )
