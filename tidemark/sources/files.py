"""Files as streams and tables, and writes that can be repeated without harm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import STATE_STORE


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    files_per_batch: int | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """A parquet folder (or file) as a stream, oldest file first."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    reader = reader.option("latestFirst", str(newest_first).lower())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def batch_path(folder: str, batch_id: int) -> str:
    return f"{folder}/batch_id={batch_id}"


def replace_batch(df: DataFrame, folder: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """Write the rows of one micro-batch. Running the batch again replaces them."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(batch_path(folder, batch_id))


def read_batches(
    spark: SparkSession, folder: str, schema: StructType, before: int | None = None
) -> DataFrame:
    """Rows of all batches (or those before one), with ``batch_id``."""
    full = StructType([*schema.fields, StructField("batch_id", LongType())])
    rows = spark.read.schema(full).parquet(folder)
    return rows if before is None else rows.where(F.col("batch_id") < before)


def read_batch(spark: SparkSession, folder: str, batch_id: int, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(batch_path(folder, batch_id))


def commit_batch(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Mark a batch whose tables are all written."""
    replace_batch(spark.range(1), f"{folder}/committed", batch_id)


def last_committed(spark: SparkSession, folder: str) -> int:
    """The newest marked batch; batches are written one after the other. -1 for none."""
    marks = spark.read.schema("id bigint, batch_id bigint").parquet(f"{folder}/committed")
    newest = marks.agg(F.max("batch_id").alias("newest")).first()["newest"]
    return -1 if newest is None else newest


def mark(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Note that a step of a batch is done and its table written."""
    replace_batch(spark.range(1), folder, batch_id)


def is_marked(spark: SparkSession, folder: str, batch_id: int) -> bool:
    try:
        return read_batch(spark, folder, batch_id, StructType.fromDDL("id bigint")).count() > 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def carried_row(spark: SparkSession, folder: str, batch_id: int) -> Row | None:
    """The one-row table the previous batch left behind; None for the first batch."""
    if batch_id == 0:
        return None
    return spark.read.parquet(batch_path(folder, batch_id - 1)).first()


def start(
    stream: DataFrame,
    write_batch,
    checkpoint: str,
    interval: str | None = None,
    output_mode: str = "append",
):
    """Start the query. Without an interval it takes what is there and stops."""
    spark = stream.sparkSession
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def finish(*queries) -> None:
    """Wait for drained queries; an error in one is raised here."""
    for query in queries:
        query.awaitTermination()
