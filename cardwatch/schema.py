"""Column names and types of the transaction tables."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# The raw file is positional, so the order matters.
TRANSACTION_TYPES = {
    "transaction_id": "bigint",
    "tx_datetime": "timestamp_ntz",
    "customer_id": "bigint",
    "terminal_id": "bigint",
    "tx_amount": "double",
    "tx_time_seconds": "bigint",
    "tx_time_days": "bigint",
    "tx_fraud": "int",
    "tx_fraud_scenario": "int",
}
TRANSACTION_COLUMNS = tuple(TRANSACTION_TYPES)
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"
COMMENT_MARK = "#"

CORRUPT = "_corrupt_record"

RAW_SCHEMA = StructType([StructField(name, StringType()) for name in TRANSACTION_COLUMNS])
RAW_SCHEMA_WITH_CORRUPT = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT, StringType())])
