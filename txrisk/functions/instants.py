"""Instants as microseconds, so none is read through a local clock that may repeat an hour."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def now_micros() -> int:
    return to_micros(datetime.now(timezone.utc))


def to_micros(at: datetime) -> int:
    return (at - _EPOCH) // timedelta(microseconds=1)


def to_datetime(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


def instant(micros: int) -> Column:
    """A timestamp literal; it folds to a constant and is pushed into Parquet scans."""
    return F.timestamp_micros(F.lit(micros))
