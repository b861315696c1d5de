"""Order requests to the stored tables, all from one batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.functions import ids
from tidemark.operators import ingest, rules
from tidemark.schemas import ORDER_ITEMS, ORDERS, OUTBOX_EVENTS
from tidemark.sources import files


def start_ingest(
    requests: DataFrame, key: str, received_at: str, folder: str, interval: str | None = None
):
    """Each batch of requests becomes rows of three tables, refused ones go to quarantine.

    The ids come from the request key, so a batch that is run again writes the same rows.
    The batch is marked when all tables are written; readers see marked batches only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = rules.check(ingest.parse_requests(batch), ingest.request_rules()).persist()
        try:
            good, refused = rules.split(checked)
            orders = ingest.new_orders(good, key, received_at)
            tables = ingest.order_tables(
                orders, F.col("created_at"), ids.stable_uuid("outbox", F.col(key))
            )
            tables["orders"] = orders.select(key, *ORDERS.fieldNames())
            tables["quarantine"] = refused.select(key, "violations")
            for name, rows in tables.items():
                files.replace_batch(rows, f"{folder}/{name}", batch_id)
            files.commit_batch(batch.sparkSession, folder, batch_id)
        finally:
            checked.unpersist()

    return files.start(requests, write, f"{folder}/offsets", interval)


def table_schemas(key_field: StructField) -> dict[str, StructType]:
    violations = StructField("violations", ArrayType(StringType()))
    items = [f for f in ORDER_ITEMS.fields if f.name != "id"]
    return {
        "orders": StructType([key_field, *ORDERS.fields]),
        "order_items": StructType([*items, *StructType.fromDDL("line int").fields]),
        "outbox_events": OUTBOX_EVENTS,
        "quarantine": StructType([key_field, violations]),
    }


def read_tables(
    spark: SparkSession, folder: str, key_field: StructField
) -> dict[str, DataFrame]:
    """All tables as of the same batch."""
    end = files.last_committed(spark, folder) + 1
    return {
        name: files.read_batches(spark, f"{folder}/{name}", schema, before=end)
        for name, schema in table_schemas(key_field).items()
    }
