"""Schemas of the control tables (all timestamps are zone-free UTC wall clock)."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


LOAD_CONFIG = T.StructType(
    _strings(
        "database_name",
        "table_name",
        "load_type",
        "incremental_col1",
        "incremental_col2",
        "incremental_col3",
        "partition_col",
        "is_partitioned",
    )
)

# ``full_loaded_at`` is the stamp of the last full load: the RAW table starts there.
RUN_STATE = T.StructType(
    _strings("database_name", "table_name", "last_updated_on")
    + [T.StructField("full_loaded_at", T.TimestampNTZType())]
)

MERGE_CONFIG = T.StructType(_strings("database_name", "table_name", "partition_col"))

MERGE_STATE = T.StructType(
    _strings("schema_name", "table_name") + [T.StructField("insert_timestamp", T.TimestampNTZType())]
)

EXTRACTION_STATUS = T.StructType(_strings("database_name", "type", "is_extraction_complete"))

# The last column is ours; the six before it are the audit log proper.
AUDIT = T.StructType(
    _strings("database_name", "table_name", "layer", "status")
    + [
        T.StructField("row_count", T.LongType()),
        T.StructField("inserted_at", T.TimestampNTZType()),
        T.StructField("error", T.StringType()),
    ]
)

SNAPSHOT_MANIFEST = T.StructType(
    _strings("table_name", "backup_name", "path") + [T.StructField("created_at", T.TimestampNTZType())]
)
