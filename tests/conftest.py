import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="txrisk-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("txrisk tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield session
    session.stop()
