"""Registry-framed message values: one zero byte, a four-byte schema id, the payload.

The payload is Avro where the spark-avro package is on the classpath and JSON otherwise.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = "00"  # fixed value: first byte of a framed message, in hex

_AVRO_TYPES = {T.StringType: "string", T.IntegerType: "int", T.LongType: "long"}


def avro_schema(schema: T.StructType, name: str, namespace: str | None = None) -> str:
    """Avro record schema of a declared struct; a nested record is named ``<name>Item``."""

    def kind(data_type: T.DataType):
        if isinstance(data_type, T.ArrayType):
            return {"type": "array", "items": kind(data_type.elementType)}
        if isinstance(data_type, T.StructType):
            return record(data_type, f"{name}Item")
        return _AVRO_TYPES[type(data_type)]

    def record(struct: T.StructType, record_name: str):
        fields = [{"name": f.name, "type": kind(f.dataType)} for f in struct.fields]
        out = {"type": "record", "name": record_name, "fields": fields}
        if namespace:
            out["namespace"] = namespace
        return out

    return json.dumps(record(schema, name))


def frame(schema_id: Column, payload: Column) -> Column:
    """Payload bytes -> framed bytes."""
    head = F.unhex(F.concat(F.lit(MAGIC), F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")))
    return F.concat(head, payload)


def is_framed(value: Column) -> Column:
    return (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == MAGIC)


def schema_id(value: Column) -> Column:
    """Schema id of a framed value, null when it is not framed."""
    digits = F.hex(F.substring(value, 2, 4))
    return F.when(is_framed(value), F.conv(digits, 16, 10).cast("bigint"))


def payload(value: Column) -> Column:
    """Payload bytes of a framed value, null when it is not framed."""
    return F.when(is_framed(value), F.substring(value, 6, 2_147_483_647))


def encode_json(record: Column, id_of_schema: int) -> Column:
    return frame(F.lit(id_of_schema), F.encode(F.to_json(record), "UTF-8"))


def decode_json(value: Column, schema: T.StructType, id_of_schema: int) -> Column:
    """The record, or null for another schema id or a bad payload."""
    text = F.decode(payload(value), "UTF-8")
    return F.when(schema_id(value) == id_of_schema, F.from_json(text, schema))


def encode_avro(record: Column, id_of_schema: int, schema_text: str) -> Column:
    from pyspark.sql.avro.functions import to_avro

    return _needs_avro(lambda: frame(F.lit(id_of_schema), to_avro(record, schema_text)))


def decode_avro(value: Column, id_of_schema: int, schema_text: str) -> Column:
    from pyspark.sql.avro.functions import from_avro

    def build() -> Column:
        record = from_avro(payload(value), schema_text, {"mode": "PERMISSIVE"})
        return F.when(schema_id(value) == id_of_schema, record)

    return _needs_avro(build)


def _needs_avro(build):
    try:
        return build()
    except Exception as error:
        raise RuntimeError(
            "Avro values need the spark-avro package (spark.jars.packages="
            "org.apache.spark:spark-avro_2.13:<spark version>); use the JSON form without it"
        ) from error


def by_schema(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``schema_id``; null marks values that carry no frame."""
    return messages.withColumn("schema_id", schema_id(F.col(value)))
