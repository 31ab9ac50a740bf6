import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from txrisk.errors import DuplicateKeyError, MissingTableError
from txrisk.operators.upsert import merge_rows
from txrisk.sources import tables
from txrisk.sources.tables import Table

SCHEMA = StructType([StructField("k", StringType()), StructField("v", IntegerType())])


def part_of(key):
    return f"part{int(key[1:]) % 3}" if key else "part0"


def frame(spark, rows):
    stored = StructType(SCHEMA.fields + [StructField("part", StringType())])
    return spark.createDataFrame([(k, v, part_of(k)) for k, v in rows], stored)


@pytest.fixture
def table(tmp_path):
    return Table(f"t{uuid.uuid4().hex}", SCHEMA, "part", str(tmp_path / "t"))


def content(spark, table):
    return sorted(tuple(row) for row in tables.read_table(spark, table).collect())


def merged(target, source):
    """Brute force: each target row takes its key's source value, new source rows are added."""
    values = dict(source)
    kept = [(k, values.get(k, v) if k is not None else v) for k, v in target]
    keys = {k for k, _ in target if k is not None}
    return sorted(kept + [row for row in source if row[0] not in keys], key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_merge_rows_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    keys = [f"k{i}" for i in range(40)]
    target = [(rng.choice(keys), rng.randrange(100)) for _ in range(60)] + [("k7", 1)] * 30
    source = [(k, rng.choice([None, 500])) for k in rng.sample(keys, 20)] + [("k99", 1)] * 30
    df = merge_rows(frame(spark, target), frame(spark, source), ["part", "k"])
    assert sorted([(r.k, r.v) for r in df.collect()], key=repr) == merged(target, source)


def test_null_keys_never_match(spark):
    df = merge_rows(frame(spark, [(None, 1)]), frame(spark, [(None, 2)]), "k")
    assert sorted(row.v for row in df.collect()) == [1, 2]


def test_null_values_of_the_source_win(spark):
    df = merge_rows(frame(spark, [("k1", 1)]), frame(spark, [("k1", None)]), "k")
    assert df.first().v is None


def test_first_upsert_creates_and_keeps_repeats(spark, table):
    assert not tables.table_exists(spark, table)
    with pytest.raises(MissingTableError):
        tables.read_table(spark, table)
    tables.upsert(spark, table, frame(spark, [("k1", 1), ("k1", 1), ("k2", 2)]), "k")
    assert tables.table_exists(spark, table)
    assert content(spark, table) == [("k1", 1), ("k1", 1), ("k2", 2)]


def test_upsert_replaces_adds_and_deletes_nothing(spark, table):
    tables.upsert(spark, table, frame(spark, [("k1", 1), ("k2", 2), ("k3", 3)]), "k")
    tables.upsert(spark, table, frame(spark, [("k2", 20), ("k4", 4), ("k5", 5)]), "k")
    assert content(spark, table) == [("k1", 1), ("k2", 20), ("k3", 3), ("k4", 4), ("k5", 5)]
    tables.upsert(spark, table, frame(spark, [("k2", 20), ("k4", 4), ("k5", 5)]), "k")
    assert len(content(spark, table)) == 5


def files_of(spark, table):
    rows = tables.stored_rows(spark, table).select("part", "_metadata.file_path").distinct()
    return Counter(tuple(row) for row in rows.collect())


def test_only_parts_with_matches_are_rewritten(spark, table):
    tables.upsert(spark, table, frame(spark, [("k0", 0), ("k1", 1), ("k2", 2)]), "k")
    before = files_of(spark, table)
    tables.upsert(spark, table, frame(spark, [("k0", 9), ("k4", 4)]), "k")
    after = files_of(spark, table)
    same = {part for part, _ in before & after}
    assert same == {"part1", "part2"}
    assert content(spark, table) == [("k0", 9), ("k1", 1), ("k2", 2), ("k4", 4)]


def test_repeated_source_keys(spark, table):
    tables.upsert(spark, table, frame(spark, [("k1", 1), ("k2", 2)]), "k")
    with pytest.raises(DuplicateKeyError):
        tables.upsert(spark, table, frame(spark, [("k1", 5), ("k1", 6), ("k3", 3)]), "k")
    assert content(spark, table) == [("k1", 1), ("k2", 2)]
    repeats = frame(spark, [("k6", 1), ("k6", 2)])
    with pytest.raises(DuplicateKeyError):
        tables.upsert(spark, table, repeats, "k", on_duplicate="reject")
    tables.upsert(spark, table, repeats, "k")
    assert content(spark, table) == [("k1", 1), ("k2", 2), ("k6", 1), ("k6", 2)]
    with pytest.raises(ValueError):
        tables.upsert(spark, table, repeats, "k", on_duplicate="other")


def test_empty_source_changes_nothing(spark, table):
    tables.upsert(spark, table, frame(spark, [("k1", 1)]), "k")
    tables.upsert(spark, table, frame(spark, []), "k")
    assert content(spark, table) == [("k1", 1)]


@pytest.mark.parametrize("side", ["target", "source"])
def test_hot_key_and_hot_part(spark, table, side):
    """A third of all rows share one key; joins are forced to shuffle and to split skew."""
    hot = [("k3", i) for i in range(3_000)]
    rest = [(f"k{i}", i) for i in range(10, 6_010)]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        target = rest[:3_000] + (hot if side == "target" else [])
        source = rest[2_000:] + (hot if side == "source" else [("k3", -1)])
        tables.upsert(spark, table, frame(spark, target), "k")
        tables.upsert(spark, table, frame(spark, source), "k")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert content(spark, table) == sorted(merged(target, source))


def test_table_is_found_again_by_its_directory(spark, table):
    tables.upsert(spark, table, frame(spark, [("k1", 1), ("k2", 2)]), "k")
    spark.sql(f"DROP TABLE {table.name}")
    tables.upsert(spark, table, frame(spark, [("k2", 20), ("k3", 3)]), "k")
    assert content(spark, table) == [("k1", 1), ("k2", 20), ("k3", 3)]


def test_managed_table_without_directory(spark):
    table = Table(f"m{uuid.uuid4().hex}", SCHEMA, "part")
    tables.upsert(spark, table, frame(spark, [("k1", 1)]), "k")
    tables.upsert(spark, table, frame(spark, [("k1", 2)]), "k")
    assert content(spark, table) == [("k1", 2)]
    assert tables.table_exists(spark, Table(f"spark_catalog.default.{table.name}", SCHEMA, "part"))
    spark.sql(f"DROP TABLE {table.name}")


def test_snapshot_overwrite_replaces_all(spark, tmp_path):
    table = Table(f"s{uuid.uuid4().hex}", SCHEMA, None, str(tmp_path / "s"))
    tables.overwrite(spark, table, frame(spark, [("k1", 1), ("k2", 2)]))
    tables.overwrite(spark, table, frame(spark, [("k3", 3)]))
    assert content(spark, table) == [("k3", 3)]


def test_failed_rewrite_leaves_the_old_rows(spark, table):
    tables.upsert(spark, table, frame(spark, [("k1", 1), ("k2", 2)]), "k")
    broken = frame(spark, [("k1", 5)]).withColumn(
        "v", F.when(F.col("v") == 5, F.raise_error(F.lit("lost task"))).cast("int")
    )
    with pytest.raises(Exception, match="lost task"):
        tables.upsert(spark, table, broken, "k")
    assert content(spark, table) == [("k1", 1), ("k2", 2)]


@pytest.mark.parametrize("gather", [True, False])
def test_gathering_is_the_only_shuffle_of_an_append(spark, table, gather):
    tables.upsert(spark, table, frame(spark, [("k1", 1)]), "k")
    stored = tables.stored_rows(spark, table)
    plan = tables.to_write(stored, table, gather)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == gather
    tables.append(spark, table, frame(spark, [("k2", 2), ("k3", 3)]), gather)
    assert content(spark, table) == [("k1", 1), ("k2", 2), ("k3", 3)]


def test_hot_part_is_written_by_several_tasks(spark, table):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    rows = spark.range(30_000).select(
        F.uuid().alias("k"), F.lit(1).alias("v"), F.when(F.col("id") < 29_000, "hot").otherwise("rare").alias("part")
    )
    try:
        spark.conf.set(name, "64KB")
        tables.append(spark, table, rows)
    finally:
        spark.conf.set(name, before)
    files = Counter(part for part, _ in files_of(spark, table))
    assert files["hot"] > 4 and files["rare"] == 1
    assert tables.read_table(spark, table).count() == 30_000
