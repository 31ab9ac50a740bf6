"""Small buckets of a large part share folders: a bucket is still what is rewritten, and files are few."""

import hashlib
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from txrisk.errors import DuplicateKeyError
from txrisk.sources import tables
from txrisk.sources.tables import Table

SCHEMA = StructType([StructField(name, kind) for name, kind in (("k", StringType()), ("v", IntegerType()))])
STORED = StructType([*SCHEMA.fields, StructField("part", StringType())])
ROWS = 2400


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(key(i), v, "small" if i % 100 == 0 else f"p{i % 2}") for i, v in rows], STORED)


def content(spark, table):
    return Counter(tuple(row) for row in tables.read_table(spark, table).select("k", "v").collect())


def want(rows):
    return Counter((key(i), v) for i, v in dict(rows).items())


def files(spark, table):
    rows = tables.stored_rows(spark, table).select("k", F.col("_metadata.file_path").alias("file"))
    return {row["k"]: row["file"] for row in rows.collect()}


def forget(spark, table):
    spark.sql(f"DROP TABLE {table.name}")


@pytest.fixture
def table(tmp_path):
    return Table(f"t{uuid.uuid4().hex}", SCHEMA, "part", str(tmp_path / "t"), key="k", bucket_rows=4)


@pytest.fixture
def filled(spark, table):
    # few buckets have folders of their own
    tables.append(spark, table, frame(spark, [(i, -1) for i in range(0, ROWS, 100)]))
    tables.upsert(spark, table, frame(spark, [(i, 0) for i in range(ROWS)]), "k")
    return table


def test_files_do_not_grow_with_buckets(spark, filled):
    # 1,188 rows in buckets of 4 ask for three digits, 4,096 buckets a part
    assert set(map(len, tables.stored_buckets(spark, filled)["p0"])) == {3}
    assert set(map(len, tables.stored_buckets(spark, filled)["small"])) == {1}
    assert len(set(files(spark, filled).values())) <= 16 + 2 * 8
    assert content(spark, filled) == want((i, 0) for i in range(ROWS))


def test_a_correction_rewrites_its_bucket_alone(spark, filled):
    before = files(spark, filled)
    new = next(i for i in range(ROWS, 10**6) if i % 2 and key(i)[:3] == key(77)[:3])
    for v in (1, 2):
        tables.upsert(spark, filled, frame(spark, [(77, v), (new, v), (ROWS + 1, v)]), "k")
        after = files(spark, filled)
        moved = {k for k in before if before[k] != after[k]}
        assert moved >= {k for k in before if k[:3] == key(77)[:3] and k in {key(i) for i in range(1, ROWS, 2)}}
        others = {key(i)[:3] for i in (77, ROWS + 1)} if v == 2 else {key(77)[:3]}
        assert {k[:3] for k in moved} == others and len(moved) < 12
        assert content(spark, filled) == want([(i, 0) for i in range(ROWS)] + [(i, v) for i in (77, new, ROWS + 1)])
        before = after
    forget(spark, filled)
    assert files(spark, filled) == after


@pytest.mark.parametrize(("step", "new_session"), [("_record", False), ("_apply", True), ("_move", False)])
def test_readers_see_all_of_a_swap_or_nothing(spark, filled, monkeypatch, step, new_session):
    old = [(i, 0) for i in range(ROWS)]
    first, second = [(i, 1) for i in range(0, ROWS, 7)], [(i, 2) for i in range(0, ROWS, 5)]
    tables.upsert(spark, filled, frame(spark, first), "k")
    move, calls = tables._move, []

    def lost(*args):
        calls.append(args)
        if step != "_move" or len(calls) > 3:
            raise OSError("driver lost")
        move(*args)

    with monkeypatch.context() as patched:
        patched.setattr(tables, step, lost)
        with pytest.raises(OSError):
            tables.upsert(spark, filled, frame(spark, second), "k")
    # folders of a part's own are moved one by one; of shared ones all buckets or none
    small = {key(i) for i in range(0, ROWS, 100)}
    seen = Counter({row: n for row, n in content(spark, filled).items() if row[0] not in small})
    assert seen == Counter({row: n for row, n in want(old + first).items() if row[0] not in small})
    if new_session:
        forget(spark, filled)
    else:
        tables.finish_swaps(spark, filled)
    done = [] if step == "_record" else second
    assert content(spark, filled) == want(old + first + done)
    # what was never recorded hides nothing later
    tables.upsert(spark, filled, frame(spark, [(3, 3)]), "k")
    assert content(spark, filled) == want(old + first + done + [(3, 3)])


def test_a_clock_that_is_set_back(spark, filled, monkeypatch):
    tables.upsert(spark, filled, frame(spark, [(7, 1)]), "k")
    monkeypatch.setattr(tables, "now_micros", lambda: 5)
    for v in (2, 3):
        tables.upsert(spark, filled, frame(spark, [(7, v), (100, v)]), "k")
        assert content(spark, filled) == want([(i, 0) for i in range(ROWS)] + [(7, v), (100, v)])


def test_repeated_keys_stop_and_null_parts_and_keys_stay(spark, filled):
    twice = spark.createDataFrame([(key(7), 1, "p1"), (key(7), 2, "p1")], STORED)
    with pytest.raises(DuplicateKeyError):
        tables.upsert(spark, filled, twice, "k")
    new = key(ROWS + 1)
    odd = [(None, 1, "p1"), (None, 1, "p1"), (new, 1, "p1"), (new, 1, "p1"), (key(7), 5, None), (key(7), 6, "p1")]
    tables.upsert(spark, filled, spark.createDataFrame(odd, STORED), "k")
    expected = want([(i, 0) for i in range(ROWS)] + [(7, 6)])
    expected += Counter({(None, 1): 2, (new, 1): 2, (key(7), 5): 1})
    assert content(spark, filled) == expected


@pytest.mark.parametrize(("seed", "folder_rows"), [(0, 100_000), (1, 300)])
def test_random_writes_equal_brute_force(spark, table, monkeypatch, seed, folder_rows):
    monkeypatch.setattr(tables, "_FOLDER_ROWS", folder_rows)
    filled, rng, rows = table, random.Random(seed), dict.fromkeys(range(ROWS), 0)
    tables.append(spark, filled, frame(spark, rows.items()))
    folders = {tables._first_layer(folder) for folder in tables.stored_buckets(spark, filled)["p0"]}
    assert len(folders) == (1 if folder_rows > ROWS else 16)
    for turn, act in enumerate(rng.sample(["upsert", "append", "replace", "compact", "upsert"], 5), 1):
        some = {i: turn for i in rng.sample(range(ROWS + 200), rng.choice([1, 40, 900]))}
        if act == "upsert":
            rows |= some
            tables.upsert(spark, filled, frame(spark, some.items()), "k")
        elif act == "append":
            some = {i: v for i, v in some.items() if i not in rows}
            rows |= some
            tables.append(spark, filled, frame(spark, some.items()))
        elif act == "replace":
            # the small part has 24 rows, buckets of one digit and a folder for each
            bucket = lambda i: (i % 100 == 0, i % 2, key(i)[: 3 if i % 100 else 1])
            buckets = set(map(bucket, some))
            rows = {i: v for i, v in rows.items() if bucket(i) not in buckets} | some
            tables.replace_parts(spark, filled, tables.dealt(spark, filled, frame(spark, some.items())))
        else:
            tables.replace_parts(spark, filled, tables.stored_rows(spark, filled).where("part = 'p1'"), ["p1"])
        if turn == 4:
            forget(spark, filled)
        assert content(spark, filled) == want(rows.items())


def test_replacing_a_part_leaves_one_layer(spark, filled):
    for v in (1, 2, 3):
        tables.upsert(spark, filled, frame(spark, [(i, v) for i in range(1, ROWS, 2)]), "k")
    before = len(set(files(spark, filled).values()))
    left = tables.stored_rows(spark, filled).where("part = 'p1' and v = 3 and k < '8'")
    tables.replace_parts(spark, filled, left, ["p1"])
    expected = want((i, 0 if i % 2 == 0 else 3) for i in range(ROWS) if i % 2 == 0 or key(i) < "8")
    assert content(spark, filled) == expected
    # the catalog's files have no row of the part that is hidden
    assert spark.table(filled.name).where("part = 'p1'").count() == sum(1 for i in range(1, ROWS, 2) if key(i) < "8")
    assert len(set(files(spark, filled).values())) <= before


def test_compaction_leaves_rows_and_few_files(spark, table):
    rows = [(i, 0) for i in range(ROWS)]
    tables.upsert(spark, table, frame(spark, rows[::2]), "k")
    tables.upsert(spark, table, frame(spark, rows), "k")
    for first in range(0, ROWS, ROWS // 4):
        tables.append(spark, table, frame(spark, [(i + ROWS, 1) for i in range(first, first + ROWS // 4)]))
    done = tables.compact(spark, table, file_bytes=1 << 20, most_files=2)
    assert "p0" in done and "p1" in done
    assert content(spark, table) == want(rows + [(i + ROWS, 1) for i in range(ROWS)])
    assert tables.compact(spark, table, file_bytes=1 << 20, most_files=2) == []


def test_removed_rows_leave_their_buckets_alone(spark, tmp_path):
    fields = [*SCHEMA.fields, StructField("source_file", StringType()), StructField("ingested_at", IntegerType())]
    table = Table(f"t{uuid.uuid4().hex}", StructType(fields), "part", str(tmp_path / "t"), key="k", bucket_rows=4)

    def sent(rows, at):
        return frame(spark, rows).withColumns(
            {"source_file": F.when(F.col("k") < "01", "x").otherwise("y"), "ingested_at": F.lit(at).cast("int")}
        )

    tables.upsert(spark, table, sent([(i, 0) for i in range(ROWS)], 1), "k")
    tables.upsert(spark, table, sent([(i, 1) for i in range(1, ROWS, 3)], 2), "k")
    before = files(spark, table)
    gone = spark.createDataFrame([("x", 2)], "source_file string, before int")
    expected = {i: int(i % 3 == 1) for i in range(ROWS)}
    left = {i: v for i, v in expected.items() if not (key(i) < "01" and v == 0)}
    assert tables.remove_rows(spark, table, gone, ["p0", "p1", "small"]) == len(expected) - len(left) > 0
    assert content(spark, table) == want((i, v) for i, v in left.items())
    after = files(spark, table)
    small = {key(i) for i in range(0, ROWS, 100)}
    hit = {(i % 2, key(i)[:3]) for i in set(expected) - set(left) if i % 100}
    for i in left:
        if key(i) not in small:
            assert (before[key(i)] != after[key(i)]) == ((i % 2, key(i)[:3]) in hit)
    assert tables.remove_rows(spark, table, gone, ["p0", "p1", "small"]) == 0
