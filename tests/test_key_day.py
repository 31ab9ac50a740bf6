import datetime as dt

import pytest
from pyspark.sql import functions as F
from txrisk.functions.keys import UNDATED, key_day, key_text

SCHEMA = "payer_id string, payee_id string, tx_type string, event_time {}, amount double"
DAY = r"(\d{4}-\d{2}-\d{2}) \d{2}:\d{2}:\d{2}"
AT = dt.datetime(2024, 1, 5, 23, 59, 59, 999999)
ROWS = [
    ("1", "2", "view", AT, 1.5),
    ("1", None, None, None, 2.0),
    (None, None, None, None, None),
    ("a:b", "2:3", "12:30:00", AT, float("nan")),
    ("x2023-07-08 01:02:03 2022-01-01 00:00:00", "2", None, AT, 1e12),
    (None, "12023-07-08 01:02:03", "2021-01-01 00:00:00", None, -0.0),
    ("2023-07-08", " 01:02:03", "2023-07-08|01:02:03", AT, 1.0),
    ("1", "2", "2023-07-08 01:02:03", None, 1.0),
    ("1", "2", "view", dt.datetime(1, 1, 1), 1.0),
    ("1", "2", "view", dt.datetime(9999, 12, 31, 23), 1.0),
]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_the_day_is_the_first_one_of_the_key_text(spark, kind):
    df = spark.createDataFrame([(*r[:3], r[3] and str(r[3]), r[4]) for r in ROWS], SCHEMA.format("string"))
    df = df.withColumn("event_time", F.col("event_time").cast(kind))
    if kind != "string":
        far = F.make_interval(years=F.lit(12000), hours=F.lit(3))
        df = df.unionByName(df.withColumn("event_time", F.col("event_time") + far))
        df = df.unionByName(df.withColumn("event_time", F.col("event_time") - far - far))
    first = F.regexp_extract(key_text(), DAY, 1)
    wanted = F.when(first == "", UNDATED).otherwise(first)
    found = df.select(key_day().alias("found"), wanted.alias("wanted")).collect()
    assert [r.found for r in found] == [r.wanted for r in found]
    assert {UNDATED, "2024-01-05", "2023-07-08"} <= {r.found for r in found}


def test_a_day_costs_no_key_text(spark, capsys):
    df = spark.createDataFrame(ROWS[:2], SCHEMA.format("timestamp_ntz"))
    df.select(key_day()).explain()
    assert "concat_ws" not in capsys.readouterr().out
