"""Swaps that fail at each step, buckets below the day, and compaction."""

import hashlib
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from txrisk.sources import tables
from txrisk.sources.tables import Table

SCHEMA = StructType([StructField("k", StringType()), StructField("v", IntegerType())])
STORED = StructType([*SCHEMA.fields, StructField("part", StringType())])


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(key(i), v, f"p{i % 2}") for i, v in rows], STORED)


def content(spark, table):
    return Counter(tuple(row) for row in tables.read_table(spark, table).collect())


def want(rows):
    return Counter((key(i), v) for i, v in rows)


@pytest.fixture
def table(tmp_path):
    return Table(f"t{uuid.uuid4().hex}", SCHEMA, "part", str(tmp_path / "t"), key="k", bucket_rows=20)


def forget(spark, table):
    """As a new session that has never heard of the table."""
    spark.sql(f"DROP TABLE {table.name}")


STEPS = ("_record", "_apply", "_move", "refresh")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("new_session", [False, True])
@pytest.mark.parametrize("whole", [False, True])
def test_readers_see_old_or_new_rows_after_a_failure_at_each_step(
    spark, table, tmp_path, monkeypatch, step, new_session, whole
):
    if whole:
        table = Table(table.name, SCHEMA, None, table.location)
    old, new = [(i, 1) for i in range(60)], [(i, 2) for i in range(60)]

    def write(rows):
        rows = frame(spark, rows)
        if whole:
            tables.overwrite(spark, table, rows)
        else:
            tables.replace_parts(spark, table, tables.dealt(spark, table, rows))

    tables.append(spark, table, frame(spark, old))
    tables.upsert(spark, table, frame(spark, old[:5]), "k") if not whole else write(old)

    def lost(*args, **kwargs):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        if step == "refresh":
            patched.setattr(type(spark.catalog), "refreshTable", lost)
        elif step == "_move":
            move, calls = tables._move, []

            def first_only(*args):
                calls.append(args)
                if len(calls) > 1 or whole:
                    raise OSError("driver lost")
                move(*args)

            patched.setattr(tables, "_move", first_only)
        else:
            patched.setattr(tables, step, lost)
        with pytest.raises(OSError):
            write(new)
    seen = content(spark, table)
    # every key is there once, with its old value or its new one
    assert sorted(k for k, _ in seen.elements()) == sorted(key(i) for i in range(60))
    assert set(seen) <= set(want(old)) | set(want(new))
    if new_session:
        forget(spark, table)
    else:
        tables.finish_swaps(spark, table)
    # an open swap is finished, one that was never recorded is not
    assert content(spark, table) == want(old if step == "_record" else new)
    write(old)
    assert content(spark, table) == want(old)
    forget(spark, table)
    assert content(spark, table) == want(old)


def test_one_correction_rewrites_one_bucket(spark, table):
    rows = [(i, 0) for i in range(4000)]
    tables.upsert(spark, table, frame(spark, rows), "k")
    buckets = tables.stored_buckets(spark, table)
    assert sorted(buckets) == ["p0", "p1"]
    assert all(len(own) > 240 and {len(b) for b in own} == {2} for own in buckets.values())

    def files():
        found = tables.stored_rows(spark, table).groupBy(F.input_file_name().alias("file")).count()
        return {row["file"]: row["count"] for row in found.collect()}

    before = files()
    tables.upsert(spark, table, frame(spark, [(1234, 9)]), "k")
    after = files()
    assert content(spark, table) == want([(i, 9 if i == 1234 else 0) for i in range(4000)])
    gone, made = set(before) - set(after), set(after) - set(before)
    bucket = [i for i in range(0, 4000, 2) if key(i)[:2] == key(1234)[:2]]
    assert len(gone) == len(made) == 1
    assert before[gone.pop()] == after[made.pop()] == len(bucket) < 30


def test_matches_are_looked_for_once_and_the_target_is_read_twice(spark, table, monkeypatch):
    tables.upsert(spark, table, frame(spark, [(i, 0) for i in range(200)]), "k")
    reads, stored = [], tables.stored_rows
    monkeypatch.setattr(tables, "stored_rows", lambda *a: reads.append(a) or stored(*a))
    merges, merge = [], tables.merge_rows

    def watched(target, source, keys, matched):
        merges.append(merge(target, source, keys, matched))
        return merges[-1]

    monkeypatch.setattr(tables, "merge_rows", watched)
    tables.upsert(spark, table, frame(spark, [(i, 1) for i in range(0, 400, 40)]), "k")
    plan = merges[0]._jdf.queryExecution().optimizedPlan().toString()
    # the merge scans the target once, and takes the matching keys as they were kept
    assert len(reads) == 1 and plan.count("Relation") == 1
    assert content(spark, table) == want([(i, 1 if i % 40 == 0 else 0) for i in range(200)] + [(i, 1) for i in range(200, 400, 40)])


def test_digits_follow_rows_and_stay(spark, table):
    assert [tables.digits_for(n, 20) for n in (0, 20, 21, 320, 321, 5121, 10**9)] == [0, 0, 1, 1, 2, 3, 4]
    tables.upsert(spark, table, frame(spark, [(i, 0) for i in range(0, 20, 2)]), "k")
    assert tables.stored_buckets(spark, table) == {"p0": [tables.UNDIVIDED]}
    tables.upsert(spark, table, frame(spark, [(i, 1) for i in range(0, 1000)]), "k")
    found = tables.stored_buckets(spark, table)
    # the stored part keeps its one bucket, the new one is divided by its 500 rows
    assert found["p0"] == [tables.UNDIVIDED] and {len(b) for b in found["p1"]} == {2}
    assert content(spark, table) == want([(i, 1) for i in range(1000)])


def test_odd_part_names_move_too(spark, tmp_path):
    table = Table(f"t{uuid.uuid4().hex}", SCHEMA, "part", str(tmp_path / "odd dir"))
    parts = ["a b", "a:b", "50%", "it's", "x=y", "ü", None]
    rows = lambda v: spark.createDataFrame([(str(i), v, part) for i, part in enumerate(parts)], STORED)
    tables.append(spark, table, rows(1))
    tables.replace_parts(spark, table, rows(2))
    tables.append(spark, table, rows(3))
    found = Counter((r.part, r.v) for r in tables.stored_rows(spark, table).collect())
    assert found == Counter([(part, v) for part in parts for v in (2, 3)])
    forget(spark, table)
    assert Counter((r.part, r.v) for r in tables.stored_rows(spark, table).collect())[("a b", 2)] == 1


def test_compaction_bounds_files_and_leaves_rows(spark, table):
    rows = [(i, 0) for i in range(600)]
    for first in range(0, 600, 60):
        tables.append(spark, table, frame(spark, rows[first : first + 60]))
    before = {r["part"]: r["files"] for r in tables.part_files(spark, table).collect()}
    done = tables.compact(spark, table, file_bytes=1 << 20, most_files=2)
    assert done == ["p0", "p1"]
    after = {r["part"]: (r["files"], r["rows"]) for r in tables.part_files(spark, table).collect()}
    buckets = tables.stored_buckets(spark, table)
    assert all(after[part][0] <= 2 * len(buckets[part]) < before[part] for part in done)
    assert content(spark, table) == want(rows)
    assert tables.compact(spark, table, file_bytes=1 << 20, most_files=2) == []
    assert tables.compact(spark, Table("never_seen", SCHEMA, "part"), 1, 1) == []
