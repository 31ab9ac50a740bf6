"""Raw transfers to the Bronze contract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.keys import key_day, transaction_key
from txrisk.schemas import BRONZE, KEY_DAY, RAW, conform

SOURCE_PATH = "_source_path"


def with_transaction_id(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_id", transaction_key())


def with_ingest_metadata(df: DataFrame, at: Column | None = None) -> DataFrame:
    """File path, instant and day of ingest. A job passes ``at`` so all its reads agree."""
    at = F.current_timestamp() if at is None else at
    return df.withColumns(
        {
            "source_file": F.col(SOURCE_PATH),
            "ingested_at": at,
            "ingested_date": F.to_date(at),
        }
    )


def to_bronze(
    df: DataFrame,
    at: Column | None = None,
    renamed: Mapping[str, str] | None = None,
    with_key_day: bool = False,
) -> DataFrame:
    """Exactly the Bronze columns, plus the storage day if asked for.

    Types are cast before the key is hashed, so the key does not depend on whether a file
    stores ``100.00`` as decimal or double.
    """
    typed = conform(df, RAW, renamed, keep=(SOURCE_PATH,))
    rows = with_ingest_metadata(with_transaction_id(typed), at)
    extra = [key_day().alias(KEY_DAY)] if with_key_day else []
    return rows.select(*BRONZE.names, *extra)
