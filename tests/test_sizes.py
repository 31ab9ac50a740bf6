"""What passes through the driver, and how many tasks look at a table of many directories."""

import uuid

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from txrisk.sources import tables
from txrisk.sources.tables import Table

SCHEMA = StructType([StructField("k", StringType()), StructField("v", IntegerType())])
STORED = StructType([*SCHEMA.fields, StructField("part", StringType())])


@pytest.fixture
def table(tmp_path):
    return Table(f"t{uuid.uuid4().hex}", SCHEMA, "part", str(tmp_path / "t"))


def frame(spark, rows):
    return spark.createDataFrame([(str(i), v, f"p{i % 2}") for i, v in rows], STORED)


@pytest.mark.parametrize(("sent_rows", "join"), [(10, "SortMergeJoin"), (1000, "BroadcastHashJoin")])
def test_keys_of_a_large_source_are_not_sent_to_the_driver(spark, table, monkeypatch, sent_rows, join):
    # rows of files, whose size Spark knows; frames of Python rows have none
    stored = frame(spark, [(i, 0) for i in range(40)])
    source = frame(spark, [(i, 1) for i in range(20, 60)])
    for name, rows in (("stored", stored), ("source", source)):
        rows.write.parquet(f"{table.location}-{name}")
    tables.upsert(spark, table, spark.read.parquet(f"{table.location}-stored"), "k")
    monkeypatch.setattr(tables, "_SENT_ROWS", sent_rows, raising=False)
    plans, keys = [], tables.matched_keys

    def watched(*args):
        found = keys(*args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(tables, "matched_keys", watched)
    tables.upsert(spark, table, spark.read.parquet(f"{table.location}-source"), "k")
    assert [join in plan for plan in plans] == [True]
    assert sorted(map(tuple, tables.read_table(spark, table).collect())) == sorted(
        (str(i), 0 if i < 20 else 1) for i in range(60)
    )


def test_directories_are_listed_by_a_few_tasks_a_core(spark, table):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    own = spark.newSession()
    tables.append(own, table, frame(own, [(i, 0) for i in range(10)]))
    assert int(own.conf.get(name)) == 4 * spark.sparkContext.defaultParallelism
    other = spark.newSession()
    other.conf.set(name, "7")
    tables.table_exists(other, table)
    assert other.conf.get(name) == "7"
