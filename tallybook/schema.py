"""The visit-event data model.

Everything in this file is a fixed value: columns, accepted words and patterns
that a ledger must keep for its readers.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: ledger columns, in storage order --------------------------
LEDGER = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("study", T.StringType()),
        T.StructField("pipeline_adcid", T.IntegerType()),
        T.StructField("project_label", T.StringType()),
        T.StructField("center_label", T.StringType()),
        T.StructField("gear_name", T.StringType()),
        T.StructField("ptid", T.StringType()),
        T.StructField("visit_date", T.StringType()),
        T.StructField("visit_number", T.StringType()),
        T.StructField("datatype", T.StringType()),
        T.StructField("module", T.StringType()),
        T.StructField("packet", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# --- fixed values: other record models; a nullable field is optional -------------
_TEXT, _NUMBER, _TIME = T.StringType(), T.DoubleType(), T.TimestampType()
RECORD = T.StructType(
    [
        T.StructField("id", _TEXT, False),
        T.StructField("name", _TEXT, False),
        T.StructField("value", _NUMBER, False),
        T.StructField("timestamp", _TIME, False),
    ]
)
CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", _TEXT, False),
        T.StructField("email", _TEXT, False),
        T.StructField("registration_date", _TIME, False),
        T.StructField("status", _TEXT, False),
    ]
)
TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", _TEXT, False),
        T.StructField("customer_id", _TEXT, False),
        T.StructField("amount", _NUMBER, False),
        T.StructField("transaction_date", _TIME, False),
        T.StructField("category", _TEXT, False),
    ]
)
REPORTING_EVENT = T.StructType(
    [
        T.StructField("timestamp", _TIME),
        T.StructField("source", _TEXT, False),
        T.StructField("event_type", _TEXT, False),
        T.StructField("data", T.VariantType()),
        T.StructField("metadata", T.VariantType()),
    ]
)

# --- fixed values: accepted words ---------------------------------------------
ACTIONS = ("submit", "delete", "not-pass-qc", "pass-qc")
DATATYPES = (
    "apoe",
    "biomarker",
    "dicom",
    "enrollment",
    "form",
    "genetic-availability",
    "gwas",
    "imputation",
    "scan-analysis",
)
DEFAULT_STUDY = "adrc"
SANDBOX_PREFIX = "sandbox-"
FORM_DATATYPE = "form"

# --- fixed values: patterns ---------------------------------------------------
PTID_PATTERN = r"^[!-~]{1,10}\z"
VISIT_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
EVENT_FILE_PATTERN = (
    r"^.*log-(submit|pass-qc|not-pass-qc|delete)"
    r"-\d{8}-\d{6}-\d+-[\w\-]+-[\w]+-\d{4}-\d{2}-\d{2}\.json$"
)

# --- derived ------------------------------------------------------------------
LEDGER_COLUMNS = tuple(LEDGER.fieldNames())
GROUP_KEY = ("study", "datatype")
VISIT_KEY = ("ptid", "visit_date", "visit_number")
NULLABLE = ("visit_number", "module", "packet")
REQUIRED = tuple(c for c in LEDGER_COLUMNS if c not in (*NULLABLE, "study"))
QC_ACTIONS = ("pass-qc", "not-pass-qc")
