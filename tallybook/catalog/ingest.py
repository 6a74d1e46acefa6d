"""Raw JSON ingestion: checking, quarantine, counts and rule profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tallybook import schema
from tallybook.catalog.base import NAME_TIME, query, table, visit_events
from tallybook.functions import dates
from tallybook.operators import validation

# Every event as one JSON text. A few kinds of damage, and of unusual but valid
# writing, are spread over the rows by event_id.
_DAMAGE = """
SELECT event_id, timestamp AS event_time,
 CONCAT('prod/', CAST(event_id AS STRING), '/log-', action, '-', {name_time}, '-',
        CAST(pipeline_adcid AS STRING), '-', project_label, '-', ptid, '-', visit_date, '.json')
   AS source_key,
 CASE WHEN kind = 2 THEN 'invalid_action' WHEN kind = 13 THEN CONCAT(' ', action) ELSE action END
   AS action,
 CASE WHEN kind <> 12 THEN study END AS study,
 pipeline_adcid, project_label, center_label, gear_name,
 CASE WHEN kind = 1 THEN NULL WHEN kind = 4 THEN 'ABC123TOOLONG'
      WHEN kind = 11 THEN CONCAT('  ', ptid, '\\t') ELSE ptid END AS ptid,
 CASE WHEN kind = 5 THEN '2024-1-15' ELSE visit_date END AS visit_date,
 visit_number, datatype,
 CASE WHEN kind = 6 THEN NULL WHEN kind = 8 THEN 'UDS' ELSE module END AS module,
 packet,
 CASE WHEN kind = 7 THEN '2024-01-15T25:00:00Z'
      WHEN kind = 10 THEN CONCAT(iso, '-05:00') ELSE CONCAT(iso, 'Z') END AS timestamp,
 CASE WHEN kind = 3 THEN 'surplus' END AS extra,
 kind
FROM (SELECT *, event_id % 40 AS kind,
             date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") AS iso FROM {{events}}) e
""".format(name_time=NAME_TIME.format(ts="timestamp"))


def raw_events(spark, sf_dir: str) -> DataFrame:
    """(event_id, event_time, source_key, value) for every event."""
    # A small table is one row group, so one task; its narrow rows are dealt out before the texts
    # are made of them, as a landing's files would be.
    cores = spark.sparkContext.defaultParallelism
    events = visit_events(spark, sf_dir).repartition(cores, "event_id")
    rows = spark.sql(_DAMAGE, events=events)
    fields = [*schema.LEDGER_COLUMNS, "extra"]
    text = F.to_json(F.struct(*fields))
    as_text = F.regexp_replace(text, r'"pipeline_adcid":(\d+)', r'"pipeline_adcid":"$1"')
    # no JSON at all, junk after the object, and one bracket too many
    broken = (
        F.when(F.col("event_id") % 3 == 0, "not json")
        .when(F.col("event_id") % 3 == 1, F.concat(text, F.lit("] junk")))
        .otherwise(F.concat(text, F.lit("]")))
    )
    value = F.when(F.col("kind") == 0, broken).when(F.col("kind") == 9, as_text)
    # A generator, so that the checks read the written text and do not write it once each.
    once = F.explode(F.array(value.otherwise(text)))
    return rows.select("event_id", "event_time", "source_key", once.alias("value"))


def ledger_view(df: DataFrame, *extra: str) -> DataFrame:
    """Ledger rows with a zone-less UTC timestamp, as the check engine holds them."""
    rest = [c for c in schema.LEDGER_COLUMNS if c != "timestamp"]
    return df.select(*extra, *rest, F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


# What the ledger must hold, worked out from the events directly.
EXPECTED_VALID = """
SELECT event_id, action, CASE WHEN event_id % 40 = 12 THEN 'adrc' ELSE study END AS study,
 pipeline_adcid, project_label, center_label, gear_name, ptid, visit_date, visit_number,
 datatype, module, packet,
 CASE WHEN event_id % 40 = 10 THEN timestamp + INTERVAL 5 HOUR ELSE timestamp END AS timestamp
FROM visit_events WHERE event_id % 40 > 8 AND event_id % 40 <> 13
"""
EXPECTED_ERRORS = """
SELECT event_id, CASE event_id % 40
 WHEN 0 THEN 'JSON decode error' WHEN 1 THEN 'ptid: field required'
 WHEN 2 THEN 'action: unknown value' WHEN 3 THEN 'extra field' WHEN 4 THEN 'ptid: bad pattern'
 WHEN 5 THEN 'visit_date: bad pattern' WHEN 6 THEN 'module: required for form'
 WHEN 7 THEN 'timestamp: not a date-time' WHEN 8 THEN 'module: only allowed for form'
 WHEN 13 THEN 'action: unknown value' END AS errors
FROM visit_events WHERE event_id % 40 <= 8 OR event_id % 40 = 13
"""


@query("ingest_validate", "SELECT * FROM expected_valid", expected_valid=EXPECTED_VALID)
def ingest_validate(spark, sf_dir):
    checked = validation.check_visit_events(raw_events(spark, sf_dir))
    return ledger_view(validation.valid_rows(checked), "event_id")


@query("ingest_errors", EXPECTED_ERRORS)
def ingest_errors(spark, sf_dir):
    checked = validation.check_visit_events(raw_events(spark, sf_dir))
    bad = checked.filter(F.size("errors") > 0)
    return bad.select("event_id", F.array_join("errors", "; ").alias("errors"))


@query(
    "ingest_counts",
    """SELECT COUNT(*) AS files_retrieved, COUNT(v.event_id) AS files_ok,
       COUNT(*) - COUNT(v.event_id) AS files_failed,
       CAST(COUNT(v.event_id) AS DOUBLE) / COUNT(*) AS success_rate
       FROM visit_events e LEFT JOIN expected_valid v ON e.event_id = v.event_id""",
    expected_valid=EXPECTED_VALID,
)
def ingest_counts(spark, sf_dir):
    checked = validation.check_visit_events(raw_events(spark, sf_dir))
    return validation.ingest_counts(checked)


@query(
    "trim_default",
    "SELECT event_id, study, ptid FROM expected_valid",
    expected_valid=EXPECTED_VALID,
)
def trim_default(spark, sf_dir):
    checked = validation.check_visit_events(raw_events(spark, sf_dir))
    return validation.valid_rows(checked).select("event_id", "study", "ptid")


@query(
    "utc_normalise",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN timestamp + INTERVAL 5 HOUR
         ELSE timestamp END AS utc,
       CONCAT(strftime(CASE event_id % 3 WHEN 0 THEN timestamp + INTERVAL 5 HOUR
         ELSE timestamp END, '%Y-%m-%dT%H:%M:%S'),
         CASE WHEN epoch_us(timestamp) % 1000000 = 0 THEN ''
              ELSE strftime(timestamp, '.%f') END, '+00:00') AS iso FROM visit_events""",
)
def utc_normalise(spark, sf_dir):
    written = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = F.col("event_id") % 3
    text = F.concat(
        written, F.when(kind == 0, "-05:00").when(kind == 1, "Z").otherwise("")
    )
    events = visit_events(spark, sf_dir).select("event_id", text.alias("text"))
    utc = dates.parse_iso_utc(F.col("text"))
    return events.select(
        "event_id", utc.cast("timestamp_ntz").alias("utc"), dates.to_iso(utc).alias("iso")
    )


@query(
    "validate_strict_profile",
    """SELECT event_id, concat_ws('; ',
         CASE WHEN pipeline_adcid < 3 THEN 'pipeline_adcid: below 1' END,
         CASE WHEN visit_number IS NULL THEN 'visit_number: field required' END,
         CASE WHEN packet = 'M' THEN 'visit_date: not a calendar date' END,
         CASE WHEN module = 'LBD' THEN 'gear_name: empty' END) AS errors FROM visit_events""",
)
def validate_strict_profile(spark, sf_dir):
    rows = visit_events(spark, sf_dir).withColumns(
        {
            "pipeline_adcid": F.col("pipeline_adcid") - 2,
            "visit_date": F.when(F.col("packet") == "M", "2024-13-45").otherwise(
                F.col("visit_date")
            ),
            "gear_name": F.when(F.col("module") == "LBD", "").otherwise(F.col("gear_name")),
        }
    )
    checked = validation.check_ledger_strict(rows)
    return checked.select("event_id", F.array_join("errors", "; ").alias("errors"))


# --- generic record rules -----------------------------------------------------------


def _records(spark, sf_dir: str) -> DataFrame:
    """Orders as records, their value shifted so that some are negative."""
    orders = table(spark, sf_dir, "orders")
    value = F.col("o_totalprice") - 100000
    record_id = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(
        F.col("o_orderkey").cast("string")
    )
    return orders.select("o_orderkey", record_id.alias("id"), value.alias("value"))


def _checked_records(spark, sf_dir: str) -> DataFrame:
    errors = validation.record_errors(F.col("id"), F.col("value"))
    return _records(spark, sf_dir).withColumn("errors", errors)


_RECORDS = """SELECT o_orderkey, concat_ws('; ',
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Record ID is required' END,
  CASE WHEN o_totalprice - 100000 < 0 THEN 'Record value must be non-negative' END) AS errors
  FROM orders"""


@query("record_rules", "SELECT * FROM records", records=_RECORDS)
def record_rules(spark, sf_dir):
    checked = _checked_records(spark, sf_dir)
    return checked.select("o_orderkey", F.array_join("errors", "; ").alias("errors"))


@query(
    "accepted_records",
    """SELECT o_orderkey, o_totalprice - 100000 AS value, TRUE AS stamped FROM orders
       WHERE o_orderpriority <> '5-LOW' AND o_totalprice >= 100000""",
)
def accepted_records(spark, sf_dir):
    accepted = validation.accept_records(_records(spark, sf_dir))
    return accepted.select(
        "o_orderkey", "value", F.col("processed_at").isNotNull().alias("stamped")
    )


_KIND = "o_orderkey % 9"


@query(
    "transaction_records",
    f"""SELECT o_orderkey, CASE {_KIND} WHEN 1 THEN 'amount: not a double'
          WHEN 2 THEN 'transaction_date: not a timestamp' WHEN 3 THEN 'category: field required'
          WHEN 4 THEN 'transaction_id: not a string' WHEN 5 THEN 'JSON decode error'
          WHEN 6 THEN 'amount: must not be negative' ELSE '' END AS errors,
        CASE {_KIND} WHEN 1 THEN NULL WHEN 5 THEN NULL WHEN 6 THEN -1.5 ELSE o_totalprice END
          AS amount,
        CASE WHEN {_KIND} NOT IN (2, 5) THEN o_orderdate END AS transaction_date FROM orders""",
)
def transaction_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 9
    key = F.col("o_orderkey").cast("string")
    quoted = F.concat(F.lit('"'), key, F.lit('"'))
    amount = (
        F.when(kind == 1, F.lit('"much"'))
        .when(kind == 6, F.lit("-1.5"))
        .when(kind == 7, F.concat(F.lit('" '), F.col("o_totalprice"), F.lit('"')))
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    date = F.when(kind == 2, F.lit("1995-02-30")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    parts = [
        F.lit('{"transaction_id":'), F.when(kind == 4, key).otherwise(quoted),
        F.lit(',"customer_id":"'), F.col("o_custkey").cast("string"),
        F.lit('","amount":'), amount,
        F.lit(',"transaction_date":"'), date, F.lit('"'),
        F.when(kind == 3, F.lit("")).otherwise(F.lit(',"category":"order"')),
        F.when(kind == 5, F.lit("")).otherwise(F.lit(',"unknown":1}')),
    ]
    raw = orders.select("o_orderkey", F.concat(*parts).alias("value"))
    rule = validation.Rule("amount: must not be negative", "amount < 0")
    checked = validation.check_records(raw, schema.TRANSACTION, [rule])
    return checked.select(
        "o_orderkey",
        F.array_join("errors", "; ").alias("errors"),
        "amount",
        F.col("transaction_date").cast("timestamp_ntz").alias("transaction_date"),
    )


@query(
    "batch_validation",
    """SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE errors = '') AS valid_records,
       COUNT(*) FILTER (WHERE errors <> '') AS invalid_records,
       CAST(COUNT(*) FILTER (WHERE errors = '') * 100 AS DOUBLE) / COUNT(*) AS success_rate
       FROM records""",
    records=_RECORDS,
)
def batch_validation(spark, sf_dir):
    return validation.batch_summary(_checked_records(spark, sf_dir))


@query("batch_errors", f"SELECT event_id AS index, errors FROM ({EXPECTED_ERRORS}) e")
def batch_errors(spark, sf_dir):
    """Invalid records with their index and messages."""
    checked = validation.check_visit_events(raw_events(spark, sf_dir))
    found = validation.batch_errors(checked, "event_id")
    return found.withColumn("errors", F.array_join("errors", "; "))


@query(
    "batch_fail_fast",
    """SELECT c_custkey, c_acctbal < -990 AS failed FROM customer WHERE c_custkey <= COALESCE(
       (SELECT MIN(c_custkey) FROM customer WHERE c_acctbal < -990), c_custkey)""",
)
def batch_fail_fast(spark, sf_dir):
    rule = validation.Rule("balance too low", F.col("c_acctbal") < -990)
    checked = table(spark, sf_dir, "customer").withColumn("errors", validation.error_list([rule]))
    seen = validation.fail_fast(checked, "c_custkey")
    return seen.select("c_custkey", (F.size("errors") > 0).alias("failed"))


@query(
    "required_fields",
    """SELECT event_id, concat_ws('; ', 'Missing required field: batch',
         CASE WHEN visit_number IS NULL THEN 'Required field ''visit_number'' cannot be None' END,
         CASE WHEN packet IS NULL THEN 'Required field ''packet'' cannot be None'
              WHEN packet = 'M' THEN 'Required field ''packet'' cannot be empty' END) AS errors
       FROM visit_events""",
)
def required_fields(spark, sf_dir):
    blank = F.when(F.col("packet") == "M", F.lit(" \t")).otherwise(F.col("packet"))
    rows = visit_events(spark, sf_dir).withColumn("packet", blank)
    errors = validation.required_field_errors(rows, ["batch", "visit_number", "packet"])
    return rows.select("event_id", F.array_join(errors, "; ").alias("errors"))


@query(
    "type_check",
    """SELECT event_id, CASE event_type
         WHEN 'click' THEN 'Field ''kind'' has incorrect type. Expected: STRING, Actual: BIGINT'
         WHEN 'error' THEN
           'Field ''at'' has incorrect type. Expected: BIGINT or DECIMAL, Actual: STRING'
         ELSE '' END AS errors FROM events""",
)
def type_check(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    value = F.concat(
        F.lit('{"kind": '),
        F.when(kind == "click", F.col("event_id").cast("string")).otherwise(
            F.concat(F.lit('"'), kind, F.lit('"'))
        ),
        F.lit(', "at": '),
        F.when(kind == "error", F.lit('"now"'))
        .when(kind == "view", F.lit("null"))
        .otherwise(F.col("user_id").cast("string")),
        F.lit("}"),
    )
    errors = validation.json_type_errors(value, {"kind": ["STRING"], "at": ["BIGINT", "DECIMAL"]})
    return events.select("event_id", F.array_join(errors, "; ").alias("errors"))


@query(
    "event_rules",
    """SELECT doc_id, concat_ws('; ',
         CASE WHEN length(repeat(source, 12)) > 100 THEN 'source: length must be 1 to 100' END,
         CASE WHEN length(repeat(lang, 5)) > 50 OR lang = 'en'
              THEN 'event_type: length must be 1 to 50' END) AS errors FROM documents""",
)
def event_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    event_type = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.repeat("lang", F.lit(5)))
    errors = validation.reporting_event_errors(F.repeat("source", F.lit(12)), event_type)
    return docs.select("doc_id", F.array_join(errors, "; ").alias("errors"))


@query(
    "schema_diff",
    """SELECT 'event_id' AS "column", 'extra' AS problem, CAST(NULL AS VARCHAR) AS expected,
         'bigint' AS actual, COUNT(event_id) AS affected_values FROM visit_events
       UNION ALL SELECT 'timestamp', 'type', 'timestamp', 'timestamp_ntz', COUNT(timestamp)
       FROM visit_events""",
)
def schema_diff(spark, sf_dir):
    return validation.schema_diff(visit_events(spark, sf_dir), schema.LEDGER)


@query(
    "schema_ready",
    """SELECT center_label, COUNT(*) AS usable_events FROM visit_events
       WHERE action IS NOT NULL AND timestamp IS NOT NULL AND pipeline_adcid IS NOT NULL
       GROUP BY center_label""",
)
def schema_ready(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    validation.require_report_schema(events)
    usable = events.dropna(subset=["action", "timestamp", "pipeline_adcid"])
    return usable.groupBy("center_label").agg(F.count(F.lit(1)).alias("usable_events"))


@query(
    "conform_schema",
    """SELECT action, study, pipeline_adcid, project_label, center_label, gear_name, ptid,
       visit_date, visit_number, datatype, module, packet, timestamp FROM visit_events""",
)
def conform_schema(spark, sf_dir):
    loose = visit_events(spark, sf_dir).withColumn(
        "pipeline_adcid", F.col("pipeline_adcid").cast(T.StringType())
    )
    return ledger_view(validation.conform(loose))
