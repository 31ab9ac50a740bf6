import hashlib
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import raw

from txrisk.errors import MissingColumnsError
from txrisk.functions.instants import instant, to_micros
from txrisk.functions.keys import UNDATED, key_day
from txrisk.operators.bronze import SOURCE_PATH, to_bronze, with_transaction_id
from txrisk.schemas import BRONZE, KEY_DAY

AT = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=timezone.utc)
DERIVED = {
    "hour_of_day",
    "day_of_week",
    "is_weekday",
    "is_night",
    "above_night_limit",
    "residual_balance_ratio",
    "payee_amount_ratio",
    "risk_score",
    "risk_level",
}


def bronze(df, **options):
    return to_bronze(df.withColumn(SOURCE_PATH, F.lit("file:/in/a.parquet")), instant(to_micros(AT)), **options)


def test_contract_has_the_key_and_no_derived_column():
    assert "transaction_id" in BRONZE.names
    assert len(BRONZE.names) == 14
    assert not DERIVED & set(BRONZE.names)


def test_precomputed_source_columns_are_dropped(spark):
    df = raw(spark, {}).withColumns({name: F.lit(1) for name in DERIVED})
    assert bronze(df).columns == BRONZE.names


def test_types_and_metadata(spark):
    df = bronze(raw(spark, {}))
    assert [f.dataType for f in df.schema] == [f.dataType for f in BRONZE]
    row = df.select("source_file", F.unix_micros("ingested_at").alias("at"), "ingested_date").first()
    assert tuple(row) == ("file:/in/a.parquet", to_micros(AT), date(2024, 5, 6))


def test_one_ingest_instant_per_query(spark):
    df = to_bronze(raw(spark, *[{}] * 50).repartition(5).withColumn(SOURCE_PATH, F.lit("f")))
    assert df.select("ingested_at").distinct().count() == 1


def test_key_is_sha256_of_the_five_fields(spark):
    row = with_transaction_id(raw(spark, {"event_time": datetime(2024, 1, 2, 3, 4, 5, 60000)})).first()
    text = "p1||r1||send||2024-01-02 03:04:05.06||10.0"
    assert row.transaction_id == hashlib.sha256(text.encode()).hexdigest()


def test_key_does_not_depend_on_stored_type(spark):
    as_double = raw(spark, {"amount": 100.0})
    as_decimal = as_double.withColumn("amount", F.lit(Decimal("100.00")))
    keys = [bronze(df).first().transaction_id for df in (as_double, as_decimal)]
    assert keys[0] == keys[1]


def test_key_leaves_out_nulls_and_label(spark):
    rows = with_transaction_id(raw(spark, {"tx_type": None}, {"tx_type": None, "is_fraud": 1})).collect()
    text = "p1||r1||2024-01-03 12:00:00||10.0"
    assert {row.transaction_id for row in rows} == {hashlib.sha256(text.encode()).hexdigest()}


def test_equal_keys_share_a_day_even_if_fields_collide(spark):
    shifted = {"payer_id": "a", "payee_id": "b", "tx_type": None, "event_time": datetime(2024, 1, 3, 1, 2, 3)}
    textual = {"payer_id": "a", "payee_id": "b", "tx_type": "2024-01-03 01:02:03", "event_time": None}
    nameless = {"event_time": None}
    df = with_transaction_id(raw(spark, shifted, textual, nameless)).withColumn(KEY_DAY, key_day())
    first, second, third = df.collect()
    assert first.transaction_id == second.transaction_id
    assert first[KEY_DAY] == second[KEY_DAY] == "2024-01-03"
    assert third[KEY_DAY] == UNDATED


def test_missing_and_renamed_columns(spark):
    df = raw(spark, {}).withColumnsRenamed({"amount": "value", "payer_id": "sender"})
    with pytest.raises(MissingColumnsError, match="payer_id, amount"):
        bronze(df)
    row = bronze(df, renamed={"amount": "value", "payer_id": "sender"}).first()
    assert (row.amount, row.payer_id) == (10.0, "p1")


def test_a_label_stays_as_the_source_has_it(spark):
    labels = [0.0, 1.0, 2.0, 0.5, -0.2, float("nan"), float("inf"), 1e12, None]
    values = F.array(*[F.lit(label).cast("double") for label in labels])
    rows = raw(spark, *[{"payer_id": str(i)} for i in range(len(labels))]).drop("is_fraud")
    rows = rows.withColumn("label", F.get(values, F.col("payer_id").cast("int")))
    found = {int(row.payer_id): row.is_fraud for row in bronze(rows, renamed={"is_fraud": "label"}).collect()}
    assert [repr(found[i]) for i in range(len(labels))] == [repr(label) for label in labels]
    for kind in ("int", "bigint", "decimal(5,1)", "boolean", "string"):
        typed = raw(spark, {"is_fraud": 1}).withColumn("is_fraud", F.col("is_fraud").cast(kind))
        assert bronze(typed).first().is_fraud == 1
