"""Keyed upsert as DataFrames: what matches, and what the target becomes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HIT = "_hit"


def matched_keys(target: DataFrame, source: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """Every key that both have, with its values of ``parts``: target rows of it, source rows of it.

    Only key and parts are read. The source is counted per key before the join, so a key that
    repeats in it is one row of the join.
    """
    keys = list(dict.fromkeys([*parts, key]))
    copies = source.groupBy(*keys).agg(F.count("*").alias("copies"))
    return (
        target.select(*keys)
        .join(copies, keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("rows_hit"), F.max("copies").alias("copies"))
    )


def matched_parts(
    target: DataFrame, source: DataFrame, key: str, parts: str | list[str], matched: DataFrame | None = None
) -> DataFrame:
    """Per value of ``parts`` with matching keys: target rows hit, most source rows on one key.
    ``matched`` are the matching keys (see ``matched_keys``), if the caller has them."""
    parts = [parts] if isinstance(parts, str) else parts
    matched = matched_keys(target, source, key, parts) if matched is None else matched
    return matched.groupBy(*parts).agg(
        F.sum("rows_hit").alias("rows_hit"), F.max("copies").alias("most_copies")
    )


def duplicate_keys(source: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in the source, with their count."""
    return source.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def keep_last(source: DataFrame, key: str) -> DataFrame:
    """One row a key: the last in the order of all columns, ``ingested_at`` and ``source_file``
    first where there are any. Rows that are equal throughout are one row."""
    names = source.columns
    first = [name for name in ("ingested_at", "source_file") if name in names]
    order = [*first, *[name for name in names if name not in (*first, key)]]
    last = source.groupBy(key).agg(F.max(F.struct(*order)).alias("_last"))
    return last.select(key, "_last.*").select(*names)


def without_stored(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    """Source rows that are not in the target yet, NULLs being equal to each other."""
    stored = target.select(*[F.col(name).alias(f"_stored_{name}") for name in columns])
    same = [F.col(name).eqNullSafe(F.col(f"_stored_{name}")) for name in columns]
    return source.join(stored, reduce(and_, same), "left_anti")


def merge_rows(
    target: DataFrame, source: DataFrame, keys: str | list[str], matched: DataFrame | None = None
) -> DataFrame:
    """The target after the upsert: hit rows take the source's values, new keys are added. ``matched``
    are the keys that both have, if the caller knows them; the target is then read once.

    Nothing is deleted and rows of a NULL key never match. Each source key may hit only if it
    is unique (see ``matched_parts``). Both joins keep their left side, which adaptive execution
    may split where a key is hot; the built sides are planned by size, without a hint.
    """
    keys = [keys] if isinstance(keys, str) else keys
    names = target.columns
    incoming = source.select(
        *keys,
        F.lit(True).alias(_HIT),
        *[F.col(name).alias(f"_new_{name}") for name in names if name not in keys],
    )
    kept = target.join(incoming, keys, "left").select(
        *[
            F.col(name)
            if name in keys
            else F.when(F.col(_HIT), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            for name in names
        ]
    )
    stored = target if matched is None else matched
    added = source.select(*names).join(stored.select(*keys), keys, "left_anti")
    return kept.unionByName(added.select(*names))
