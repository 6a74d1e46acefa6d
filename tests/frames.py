"""Small ledger rows that several test modules use."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tallybook import schema

SMALL = "/root/testdata/sf0.001"


def event(
    action="submit",
    adcid=42,
    center="alpha",
    ptid="ABC123",
    visit_date="2024-01-15",
    number="01",
    module="UDS",
    packet="I",
    at="2024-01-15 10:00",
    study="adrc",
    datatype="form",
    project="ingest",
):
    moment = datetime.fromisoformat(at)
    return (
        action, study, adcid, project, center, "form-gear", ptid, visit_date, number,
        datatype, module, packet, moment,
    )


def ledger_frame(spark, rows):
    """Ledger rows; times are given as UTC whatever the local zone is."""
    names = ", ".join(
        f"{f.name} {'timestamp_ntz' if f.name == 'timestamp' else f.dataType.simpleString()}"
        for f in schema.LEDGER
    )
    df = spark.createDataFrame(rows, names)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


# --- fixed values: three small ledgers with known report results ----------------
BASIC = [
    event(),
    event("pass-qc", at="2024-01-15 11:00"),
    event("not-pass-qc", ptid="XYZ789", visit_date="2024-01-16", number="02", packet="A",
          at="2024-01-16 10:00"),
    event("submit", 43, "beta", "DEF456", "2024-01-16", "01", "FTLD", "I", "2024-01-16 11:00"),
    event("delete", 43, "beta", "DEF456", "2024-01-16", "01", "FTLD", "I", "2024-01-16 11:00"),
    event("pass-qc", 43, "gamma", "GHI789", "2024-01-17", "03", "LBD", "B", "2024-01-17 10:00"),
]
RANGE = [
    *BASIC,
    event("submit", 44, "alpha", "JKL012", "2024-01-18", "01", "UDS", "C", "2024-01-18 14:30"),
    event("pass-qc", 44, "beta", "MNO345", "2024-01-19", "02", "FTLD", "A", "2024-01-19 09:15"),
]
TIMING = [
    event("submit", 1, "alpha", "P1", "2024-01-15", "01", "UDS", "I", "2024-01-15 10:00"),
    event("pass-qc", 1, "alpha", "P1", "2024-01-15", "01", "UDS", "I", "2024-01-15 16:00"),
    event("submit", 1, "beta", "P2", "2024-01-16", "01", "FTLD", "A", "2024-01-16 10:00"),
    event("pass-qc", 1, "beta", "P2", "2024-01-16", "01", "FTLD", "A", "2024-01-16 18:00"),
    event("not-pass-qc", 1, "beta", "P2", "2024-01-16", "01", "FTLD", "A", "2024-01-16 19:00"),
    event("submit", 1, "gamma", "P3", "2024-01-17", "01", "LBD", "B", "2024-01-17 10:00"),
    event("pass-qc", 1, "gamma", "P3", "2024-01-17", "01", "LBD", "B", "2024-01-18 14:00"),
    event("not-pass-qc", 1, "gamma", "P3", "2024-01-17", "01", "LBD", "B", "2024-01-18 15:00"),
    event("submit", 1, "alpha", "P4", "2024-01-18", "01", "UDS", "C", "2024-01-18 09:00"),
    event("pass-qc", 1, "alpha", "P4", "2024-01-18", "01", "UDS", "C", "2024-01-21 11:00"),
]
