"""Shared session and the cached reference frames."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from frames import BASIC, RANGE, TIMING, ledger_frame  # noqa: E402
from tallybook import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tallybook-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield session.configure(spark)
    spark.stop()


@pytest.fixture(scope="session")
def basic(spark):
    return ledger_frame(spark, BASIC).cache()


@pytest.fixture(scope="session")
def ranged(spark):
    return ledger_frame(spark, RANGE).cache()


@pytest.fixture(scope="session")
def timed(spark):
    return ledger_frame(spark, TIMING).cache()
