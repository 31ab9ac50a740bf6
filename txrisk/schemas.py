"""Column contracts of every layer and the fixed values of the risk rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from txrisk.errors import MissingColumnsError

# The key recipe, rule limits and names results depend on.
KEY_FIELDS = ("payer_id", "payee_id", "tx_type", "event_time", "amount")
KEY_TIME = "event_time"
KEY_SEPARATOR = "||"
KEY_HASH_BITS = 256
NIGHT_ENDS_AT_HOUR = 6
NIGHT_STARTS_AT_HOUR = 22
SUNDAY, SATURDAY = 1, 7
THRESHOLD_PERCENTILE = "0.95"
APPROX_ACCURACY = 10000
LEVEL_CUTS = ((1, "LOW"), (2, "MEDIUM"), (3, "HIGH"), (4, "CRITICAL"))
LEVEL_BELOW_CUTS = "NORMAL"
ALERT_SCORE = 3
FILE_DONE = "SUCCESS"
VERSION_FORMAT = "%Y%m%dT%H%M%S%fZ"

_STRING, _INT, _LONG, _DOUBLE, _FLAG = StringType(), IntegerType(), LongType(), DoubleType(), BooleanType()
_INSTANT, _WALL_CLOCK, _DATE = TimestampType(), TimestampNTZType(), DateType()


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


RAW = _schema(
    payer_id=_STRING,
    payee_id=_STRING,
    tx_type=_STRING,
    amount=_DOUBLE,
    payer_balance_before=_DOUBLE,
    payer_balance_after=_DOUBLE,
    payee_balance_before=_DOUBLE,
    payee_balance_after=_DOUBLE,
    event_time=_WALL_CLOCK,
    is_fraud=_DOUBLE,
)
BRONZE = StructType(
    _schema(transaction_id=_STRING).fields
    + RAW.fields
    + _schema(source_file=_STRING, ingested_at=_INSTANT, ingested_date=_DATE).fields
)
SILVER = StructType(
    BRONZE.fields
    + _schema(
        hour_of_day=_INT,
        day_of_week=_INT,
        is_weekday=_FLAG,
        is_night=_FLAG,
        residual_balance_ratio=_DOUBLE,
        payee_amount_ratio=_DOUBLE,
        flag_night=_INT,
        flag_night_high_amount=_INT,
        flag_high_amount=_INT,
        flag_residual_balance=_INT,
        flag_payee_ratio=_INT,
        risk_score=_INT,
        risk_level=_STRING,
        threshold_version=_STRING,
    ).fields
)
_TOTALS = _schema(tx_count=_LONG, fraud_count=_LONG, amount_sum=_DOUBLE).fields
RISK_EFFECTIVENESS = StructType(_schema(risk_level=_STRING).fields + _TOTALS)
OPERATIONAL = StructType(_schema(is_weekday=_FLAG, is_night=_FLAG).fields + _TOTALS)
GOLD_TOTALS = StructType(
    _schema(key_day=_STRING, risk_level=_STRING, is_weekday=_FLAG, is_night=_FLAG).fields + _TOTALS
)
ALERTS = _schema(
    transaction_id=_STRING,
    event_time=_WALL_CLOCK,
    payer_id=_STRING,
    payee_id=_STRING,
    amount=_DOUBLE,
    risk_score=_INT,
    risk_level=_STRING,
    threshold_version=_STRING,
)
INGEST_DAYS = _schema(ingested_at=_INSTANT, key_day=_STRING)
INGESTED_FILES = _schema(source_file=_STRING, processed_at=_INSTANT, status=_STRING)
FILE_VERSIONS = _schema(source_file=_STRING, length=_LONG, modified_at=_INSTANT, ingested_at=_INSTANT)
RETRACTIONS = _schema(ingested_at=_INSTANT, source_file=_STRING, key_day=_STRING)
LAYER_WATERMARKS = _schema(layer_name=_STRING, last_ingestion_timestamp=_INSTANT, updated_at=_INSTANT)
GATE_RESULTS = _schema(
    checked_to=_INSTANT, check_name=_STRING, observed=_DOUBLE, blocking=_FLAG, passed=_FLAG
)
DAY_SKETCHES = StructType(
    _schema(key_day=_STRING).fields
    + [
        StructField(f"{measure}_{name}", dtype)
        for measure in ("amount", "residual_balance_ratio", "payee_amount_ratio")
        for name, dtype in (("count", _LONG), ("nan", _LONG), ("sketch", BinaryType()))
    ]
)
RISK_THRESHOLDS = _schema(
    threshold_version=_STRING,
    p95_amount=_DOUBLE,
    p95_residual_balance_ratio=_DOUBLE,
    p95_payee_amount_ratio=_DOUBLE,
    valid_from=_INSTANT,
    valid_to=_INSTANT,
)

# Physical partition columns of the keyed tables, a day and leading digits of the key; not part of any
# contract. A bucket of a day is to hold about so many rows, some 100 MB of Silver.
KEY_DAY = "key_day"
KEY_BUCKET = "key_bucket"
BUCKET_ROWS = 1_000_000


def conform(
    df: DataFrame, schema: StructType, renamed: Mapping[str, str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Select and cast the columns of ``schema`` (then ``keep`` as they are). The fraud label is a
    double, so a label that is no whole number stays what it was, and the gate refuses it.

    ``renamed`` gives the source's own name for a contract column.
    """
    source_name = {name: (renamed or {}).get(name, name) for name in schema.names}
    present = {name.lower() for name in df.columns}
    missing = [name for name in source_name.values() if name.lower() not in present]
    if missing:
        raise MissingColumnsError(f"source lacks columns: {', '.join(missing)}")
    return df.select(
        *[
            F.col(f"`{name}`").cast(schema[own].dataType).alias(own)
            for own, name in source_name.items()
        ],
        *keep,
    )
