"""Small tables made on the driver: audit rows, manifests, file lists."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_ARROW = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "boolean": pa.bool_(),
    "timestamp": pa.timestamp("us", tz="UTC"),
    "timestamp_ntz": pa.timestamp("us"),
    "array<string>": pa.list_(pa.string()),
    "map<string,string>": pa.map_(pa.string(), pa.string()),
    "map<string,bigint>": pa.map_(pa.string(), pa.int64()),
}


def _arrow_value(value):
    return list(value.items()) if isinstance(value, dict) else value


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a one-partition table. Arrow spares a Python worker per partition."""
    fields = StructType.fromDDL(schema).fields
    columns = [pa.array([_arrow_value(row[i]) for row in rows],
                        type=_ARROW[f.dataType.simpleString()])
               for i, f in enumerate(fields)]
    table = pa.Table.from_arrays(columns, names=[f.name for f in fields])
    return spark.createDataFrame(table, StructType(fields))
