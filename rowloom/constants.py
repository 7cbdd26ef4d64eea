"""Names and literals that results depend on."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Audit, hash and history columns, defaults and separators.
LOADED_AT = "_etl_loaded_at"
SOURCE_NAME = "_etl_source"
RUN_DATE = "_etl_run_date"
ROW_HASH = "_row_hash"
HASH_SEPARATOR = "||"
HASH_NULL = "NULL"
VALID_FROM = "effective_from"
VALID_TO = "effective_to"
IS_CURRENT = "is_current"
OPEN_END = dt.datetime(9999, 12, 31)
FIRST_WATERMARK = "1900-01-01 00:00:00"
WATERMARK_COLUMNS = "table_name string, last_watermark string, updated_at timestamp_ntz"
JDBC_BATCH_SIZE = 10_000
DIFF_SAMPLE_SIZE = 10_000


def clock(value: dt.datetime) -> Column:
    """Literal time without a zone, the same in every session; made from text because Spark
    reads a Python datetime as an instant."""
    return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
