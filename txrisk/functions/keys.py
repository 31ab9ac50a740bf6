"""The deterministic row key and the storage day derived from the same text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.schemas import KEY_FIELDS, KEY_HASH_BITS, KEY_SEPARATOR, KEY_TIME

UNDATED = "undated"
_DAY_IN_TEXT = r"(\d{4}-\d{2}-\d{2}) \d{2}:\d{2}:\d{2}"


def key_text() -> Column:
    """The key fields as one text. NULL fields are left out, as ``concat_ws`` does."""
    return F.concat_ws(KEY_SEPARATOR, *[F.col(name).cast("string") for name in KEY_FIELDS])


def transaction_key() -> Column:
    return F.sha2(key_text(), KEY_HASH_BITS)


def key_day() -> Column:
    """The first day named in the key text, normally the day of ``event_time``.

    Being a function of the hashed text, it is the same for any two rows with the same key,
    even where skipped NULLs make different fields collide. So an upsert only has to look at
    the days its source touches.

    No day spans a separator, so it is looked for field by field, and the text is not put together:
    every pass over a source asks for it, several times where a filter does too.
    """
    return F.coalesce(*[_day_in(name) for name in KEY_FIELDS], F.lit(UNDATED))


def _day_in(name: str) -> Column:
    """The first day that a field names as text, or NULL. Types are known when a plan is made, so numbers
    cost nothing, and an instant is read as text only where its year has not four digits."""
    value, kind = F.col(name), F.typeof(name)
    text = value.cast("string")
    day = F.when(text.contains(":"), F.get(F.regexp_extract_all(text, F.lit(_DAY_IN_TEXT), F.lit(1)), F.lit(0)))
    if name == KEY_TIME:
        instant = kind.startswith("timestamp") & F.year(value).between(0, 9999)
        day = F.when(instant, F.to_date(value).cast("string")).otherwise(day)
    return F.when(kind.isin("double", "float"), F.lit(None)).otherwise(day)
