"""Table shapes and fixed values shared by every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: must be equal everywhere for right results -----------------------------------
DEVICE_TYPES = ["mobile", "desktop", "tablet", "unknown"]
PLAN_TYPES = ["FREE", "PREMIUM"]
HASHED_IP_PATTERN = "^[0-9a-f]{64}$"
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
UNKNOWN_USER_KEY = -1
UNKNOWN_PLAN = "UNKNOWN"
SMALL_FILE_BYTES = 8 * 1024 * 1024
ERROR_TEXT_LIMIT = 2000
WATERMARK_DIGITS = 12
# ------------------------------------------------------------------------------------------------


def _fields(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in cols])


URLS = _fields(
    ("id", T.LongType(), False),
    ("short_code", T.StringType(), True),
    ("original_url", T.StringType(), False),
    ("created_at", T.TimestampType(), False),
    ("expires_at", T.TimestampType(), True),
    ("user_id", T.LongType(), True),
    ("is_active", T.BooleanType(), False),
    ("deleted_at", T.TimestampType(), True),
)

USERS = _fields(
    ("id", T.LongType(), False),
    ("email", T.StringType(), False),
    ("plan_type", T.StringType(), False),
    ("created_at", T.TimestampType(), False),
)

CLICKS = _fields(
    ("id", T.LongType(), False),
    ("short_code", T.StringType(), False),
    ("occurred_at", T.TimestampType(), False),
    ("device_type", T.StringType(), False),
    ("hashed_ip", T.StringType(), True),
    ("user_id", T.LongType(), True),
)

SOURCE_TABLES = {"urls": URLS, "users": USERS, "clicks": CLICKS}

SILVER_CLICKS = _fields(
    ("click_id", T.LongType(), False),
    ("short_code", T.StringType(), False),
    ("occurred_at", T.TimestampType(), False),
    ("device_type", T.StringType(), False),
    ("hashed_ip", T.StringType(), True),
    ("user_id", T.LongType(), True),
    ("silver_loaded_at", T.TimestampType(), False),
)

DIM_DATE = _fields(
    ("date_key", T.IntegerType(), False),
    ("full_date", T.DateType(), False),
    ("day_of_week", T.ShortType(), False),
    ("day_name", T.StringType(), False),
    ("day_of_month", T.ShortType(), False),
    ("month", T.ShortType(), False),
    ("month_name", T.StringType(), False),
    ("quarter", T.ShortType(), False),
    ("year", T.ShortType(), False),
    ("is_weekend", T.BooleanType(), False),
)

DIM_URL = _fields(
    ("url_key", T.IntegerType(), False),
    ("url_id", T.LongType(), False),
    ("short_code", T.StringType(), True),
    ("original_url_domain", T.StringType(), True),
    ("is_active", T.BooleanType(), False),
    ("created_date_key", T.IntegerType(), True),
    ("row_loaded_at", T.TimestampType(), False),
)

DIM_USER = _fields(
    ("user_key", T.IntegerType(), False),
    ("user_id", T.LongType(), False),
    ("plan_type", T.StringType(), False),
    ("is_known", T.BooleanType(), False),
    ("row_loaded_at", T.TimestampType(), False),
)

DIM_DEVICE = _fields(
    ("device_key", T.IntegerType(), False),
    ("device_type", T.StringType(), False),
)

FACT_CLICKS = _fields(
    ("click_id", T.LongType(), False),
    ("date_key", T.IntegerType(), False),
    ("url_key", T.IntegerType(), False),
    ("user_key", T.IntegerType(), False),
    ("device_key", T.IntegerType(), False),
    ("short_code", T.StringType(), False),
    ("occurred_at", T.TimestampType(), False),
    ("click_count", T.ShortType(), False),
    ("row_loaded_at", T.TimestampType(), False),
)

STAR_TABLES = {
    "dim_date": DIM_DATE,
    "dim_url": DIM_URL,
    "dim_user": DIM_USER,
    "dim_device": DIM_DEVICE,
    "fact_clicks": FACT_CLICKS,
}

# Length limits of the character columns of the star schema.
STAR_LENGTHS = {
    "dim_date": {"day_name": 9, "month_name": 9},
    "dim_url": {"short_code": 16, "original_url_domain": 255},
    "dim_user": {"plan_type": 16},
    "dim_device": {"device_type": 16},
    "fact_clicks": {"short_code": 16},
}

# Columns that must be unique, table by table.
STAR_KEYS = {
    "dim_date": ["date_key", "full_date"],
    "dim_url": ["url_key", "url_id"],
    "dim_user": ["user_key", "user_id"],
    "dim_device": ["device_key", "device_type"],
    "fact_clicks": ["click_id"],
}

# One row per change of a run; the current state of a run is its last row.
RUN_EVENTS = _fields(
    ("run_id", T.StringType(), False),
    ("pipeline_name", T.StringType(), False),
    ("source_table", T.StringType(), False),
    ("load_type", T.StringType(), False),
    ("status", T.StringType(), False),
    ("watermark_start", T.LongType(), True),
    ("watermark_end", T.LongType(), True),
    ("rows_read", T.LongType(), True),
    ("rows_written", T.LongType(), True),
    ("bronze_key", T.StringType(), True),
    ("started_at", T.TimestampType(), False),
    ("completed_at", T.TimestampType(), True),
    ("error_message", T.StringType(), True),
    ("event_seq", T.IntegerType(), False),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order; a value that does not fit becomes NULL.

    Columns that the input lacks come out as NULL. ``try_cast`` keeps one bad value from failing a
    whole job under ANSI mode.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of ``df``, those of ``schema`` in its types and first; a value that does not fit ends the job.

    Text that is no number, numbers out of range and fractions in a whole-number column do not fit. A
    declared column that the input lacks comes out as NULL.
    """
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    broken = (T.FloatType, T.DoubleType, T.DecimalType)

    def column(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        have, value = df.schema[field.name].dataType, F.col(field.name)
        if have == field.dataType:
            return value
        cast = value.try_cast(field.dataType)
        wrong = value.isNotNull() & cast.isNull()
        if isinstance(field.dataType, whole) and isinstance(have, broken):
            wrong = wrong | (value != cast)
        said = F.concat(F.lit(f"column {field.name} takes no "), value.cast("string"))
        return F.when(wrong, F.raise_error(said).cast(field.dataType)).otherwise(cast).alias(field.name)

    declared = set(schema.names)
    return df.select(*map(column, schema), *[c for c in df.columns if c not in declared])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
