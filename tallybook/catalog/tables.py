"""Queries over other tables: run metrics, quality, customers, notices, retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tallybook.catalog.base import query, table, visit_events
from tallybook.operators import metrics, quality, retention
from tallybook.sources import notices, specs

# --- run metrics: one run per study and day ----------------------------------------------

_RUNS = """
SELECT study, CAST(timestamp AS DATE) AS day, MIN(timestamp) AS start_time,
 MAX(timestamp) AS end_time, COUNT(*) FILTER (WHERE action <> 'not-pass-qc') AS records_processed,
 COUNT(*) FILTER (WHERE action = 'not-pass-qc') AS records_failed,
 CAST(SUM(pipeline_adcid) AS BIGINT) AS bytes_processed,
 COUNT(DISTINCT datatype) AS output_files_created,
 {errors}
FROM {events} GROUP BY study, CAST(timestamp AS DATE)
"""
_SPARK_ERRORS = """CASE WHEN COUNT(*) FILTER (WHERE packet = 'I' AND action = 'not-pass-qc') > 0
 THEN array(CONCAT('run failed on ', MIN(center_label)), 'see log') ELSE array() END AS errors"""
_SQL_ERRORS = """CASE WHEN COUNT(*) FILTER (WHERE packet = 'I' AND action = 'not-pass-qc') > 0
 THEN 2 ELSE 0 END AS error_count"""
_SQL_RUNS = _RUNS.format(errors=_SQL_ERRORS, events="visit_events")


def runs(spark, sf_dir: str) -> DataFrame:
    sql = _RUNS.replace("{errors}", _SPARK_ERRORS)
    return spark.sql(sql, events=visit_events(spark, sf_dir))


@query(
    "run_checks",
    """SELECT study, day, CASE
         WHEN EXTRACT(DAY FROM CAST(day AS DATE)) % 3 = 0 AND end_time > start_time
           THEN 'end_time must be after start_time; records_failed must not be negative'
         WHEN EXTRACT(DAY FROM CAST(day AS DATE)) % 3 = 0
           THEN 'records_failed must not be negative' ELSE '' END AS errors FROM runs""",
    runs=_SQL_RUNS,
)
def run_checks(spark, sf_dir):
    """Rule messages of runs, every third day's with its times swapped and a count below 0."""
    third = F.dayofmonth(F.col("day").cast("date")) % 3 == 0
    swapped = runs(spark, sf_dir).withColumns(
        {
            "start_time": F.when(third, F.col("end_time")).otherwise(F.col("start_time")),
            "end_time": F.when(third, F.col("start_time")).otherwise(F.col("end_time")),
            "records_failed": F.when(third, -1).otherwise(F.col("records_failed")),
        }
    )
    return swapped.select(
        "study", "day", F.array_join(metrics.run_errors(), "; ").alias("errors")
    )


@query(
    "run_metrics",
    """SELECT study, day, seconds AS duration_seconds, records_processed + records_failed
         AS total_records,
       CASE WHEN records_processed + records_failed > 0 THEN CAST(records_processed * 100 AS DOUBLE)
         / (records_processed + records_failed) ELSE 0.0 END AS success_rate,
       CASE WHEN seconds > 0 THEN records_processed / seconds ELSE 0.0 END AS records_per_second,
       CASE WHEN seconds > 0 THEN bytes_processed / seconds ELSE 0.0 END AS bytes_per_second,
       error_count
       FROM (SELECT *, CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000
             AS seconds FROM runs) t""",
    runs=_SQL_RUNS,
)
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(runs(spark, sf_dir)).select(
        "study",
        "day",
        "duration_seconds",
        "total_records",
        "success_rate",
        "records_per_second",
        "bytes_per_second",
        F.size("errors").alias("error_count"),
    )


@query(
    "run_summary_lines",
    """SELECT study, day, CAST(ROUND(CAST(seconds AS DECIMAL(28, 10)), 2) AS DOUBLE)
         AS duration_seconds, records_processed, records_failed,
       CAST(ROUND(CAST(CAST(records_processed * 100 AS DOUBLE)
         / (records_processed + records_failed) AS DECIMAL(28, 10)), 2) AS DOUBLE)
         AS success_rate_percent,
       CAST(ROUND(CAST(CASE WHEN seconds > 0 THEN records_processed / seconds ELSE 0 END
         AS DECIMAL(28, 10)), 2) AS DOUBLE) AS records_per_second,
       CAST(ROUND(CAST(CASE WHEN seconds > 0 THEN bytes_processed / seconds ELSE 0 END
         AS DECIMAL(28, 10)), 2) AS DOUBLE) AS bytes_per_second,
       bytes_processed, output_files_created, CAST(error_count AS BIGINT) AS error_count
       FROM (SELECT *, CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000
             AS seconds FROM runs) t""",
    runs=_SQL_RUNS,
)
def run_summary_lines(spark, sf_dir):
    return metrics.run_summary(runs(spark, sf_dir), ["study", "day"])


@query(
    "run_metrics_rollup",
    """SELECT study, COUNT(*) AS runs, MIN(start_time) AS start_time, MAX(end_time) AS end_time,
       CAST(SUM(records_processed) AS BIGINT) AS records_processed,
       CAST(SUM(records_failed) AS BIGINT) AS records_failed,
       CAST(SUM(bytes_processed) AS BIGINT) AS bytes_processed,
       CAST(SUM(output_files_created) AS BIGINT) AS output_files_created,
       CAST(SUM(error_count) AS BIGINT) AS error_count FROM runs GROUP BY study""",
    runs=_SQL_RUNS,
)
def run_metrics_rollup(spark, sf_dir):
    return metrics.roll_up(runs(spark, sf_dir), ["study"])


@query(
    "run_error_rows",
    """SELECT study, day, start_time, 0 AS position, first_error AS error FROM failed
       UNION ALL SELECT study, day, start_time, 1, 'see log' FROM failed""",
    failed="""SELECT study, CAST(timestamp AS DATE) AS day, MIN(timestamp) AS start_time,
              CONCAT('run failed on ', MIN(center_label)) AS first_error FROM visit_events
              GROUP BY study, CAST(timestamp AS DATE)
              HAVING COUNT(*) FILTER (WHERE packet = 'I' AND action = 'not-pass-qc') > 0""",
)
def run_error_rows(spark, sf_dir):
    return metrics.run_error_rows(runs(spark, sf_dir), ["study", "day"])


# --- quality -----------------------------------------------------------------------------

_NULL_COLUMNS = dict.fromkeys(
    ["action", "study", "project_label", "center_label", "gear_name", "ptid", "visit_date",
     "visit_number", "datatype", "module", "packet"], "string",
) | {"event_id": "bigint", "pipeline_adcid": "int", "timestamp": "timestamp_ntz"}


@query(
    "null_report",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS data_type, COUNT(*) AS total_rows,
            COUNT(*) - COUNT({c}) AS null_count,
            CAST((COUNT(*) - COUNT({c})) * 100 AS DOUBLE) / COUNT(*) AS null_percentage
            FROM visit_events"""
        for c, kind in _NULL_COLUMNS.items()
    ),
)
def null_report(spark, sf_dir):
    return quality.null_report(visit_events(spark, sf_dir))


@query(
    "duplicate_rows",
    """SELECT CAST(SUM(n) AS BIGINT) AS total_rows,
        CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT v.*, COUNT(*) AS n FROM (SELECT * FROM visit_events UNION ALL
              SELECT * FROM visit_events WHERE event_id % 10 = 3) v GROUP BY ALL) t""",
)
def duplicate_rows(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    return quality.duplicate_rows(events.unionAll(events.where("event_id % 10 = 3")))


def _raw_customers(spark, sf_dir: str) -> DataFrame:
    """Customers as untidy text."""
    key = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") == 7, F.lit("  ")).otherwise(
            F.concat(F.lit("  "), key, F.lit("\t"))
        ).alias("customer_id"),
        F.when(F.col("c_acctbal") < -900, F.lit(None)).otherwise(
            F.concat(F.lit(" "), F.col("c_name"), F.lit("  \n of "), F.col("c_mktsegment"))
        ).alias("name"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Mail.Example ")).alias("email"),
        F.concat(F.lit("(+"), F.col("c_nationkey"), F.lit(") 555-"), key).alias("phone"),
        F.concat(F.col("c_nationkey"), F.lit("   Main\tSt")).alias("address"),
        F.repeat(F.concat(F.col("c_mktsegment"), F.lit("  ")), F.lit(60)).alias("notes"),
    )


_CLEAN = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CONCAT(c_name, ' of ', c_mktsegment) AS name,
 LOWER(CONCAT(c_name, '@Mail.Example')) AS email,
 CONCAT(c_nationkey, '555', c_custkey) AS phone, CONCAT(c_nationkey, ' Main St') AS address,
 CASE WHEN length(note) <= 500 THEN note ELSE CONCAT(SUBSTR(note, 1, 497), '...') END AS notes
FROM (SELECT *, RTRIM(repeat(CONCAT(c_mktsegment, ' '), 60)) AS note FROM customer
      WHERE c_nationkey <> 7 AND c_acctbal >= -900) t"""


@query("clean_customers", "SELECT * FROM clean", clean=_CLEAN)
def clean_customers(spark, sf_dir):
    return quality.clean_customers(_raw_customers(spark, sf_dir))


@query(
    "cleaning_summary",
    """SELECT (SELECT COUNT(*) FROM customer) AS input_records,
       (SELECT COUNT(*) FROM clean) AS output_records,
       CAST((SELECT COUNT(*) FROM clean) * 100 AS DOUBLE) / (SELECT COUNT(*) FROM customer)
         AS cleaned_percentage""",
    clean=_CLEAN,
)
def cleaning_summary(spark, sf_dir):
    return quality.cleaning_summary(_raw_customers(spark, sf_dir))


# --- retention ----------------------------------------------------------------------------


@query(
    "retention_tiers",
    """SELECT environment, tier, COUNT(*) AS files FROM (
         SELECT environment, CASE
           WHEN environment = 'dev' AND age >= 30 THEN 'expired'
           WHEN environment = 'prod' AND age >= 365 THEN 'deep_archive'
           WHEN environment <> 'dev' AND age >= 90 THEN 'glacier' ELSE 'standard' END AS tier
         FROM (SELECT date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS age
               FROM orders) a, (VALUES ('dev'), ('staging'), ('prod')) p(environment)) t
       GROUP BY environment, tier""",
)
def retention_tiers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    as_of = F.lit("1998-08-02").cast("date")
    return retention.tier_counts(orders, F.to_date("o_orderdate"), as_of)


# --- incremental export and declared sources -----------------------------------------------


@query(
    "extract_since",
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1995-06-17 00:00:00'",
)
def extract_since(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return specs.updated_since(orders, "o_orderdate", datetime(1995, 6, 17))


@query("source_spec_read", "SELECT * FROM supplier")
def source_spec_read(spark, sf_dir):
    spec = specs.SourceSpec(
        name="suppliers",
        type="s3",
        params={"bucket_name": "local", "prefix": "supplier.parquet", "root": sf_dir},
    )
    return spec.read(spark)


# --- notices --------------------------------------------------------------------------------


def _object_notices(spark, sf_dir: str) -> DataFrame:
    """One notice per web page, naming it twice: as created and as something else."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    key = F.concat(F.lit("raw/page+"), "page_id", F.lit("%20copy.html"))
    other = F.when(F.col("page_id") % 3 == 0, "ObjectRemoved:Delete").when(
        F.col("page_id") % 3 == 1, "ObjectRestore:Post"
    )

    def record(name, size):
        return F.struct(
            name.alias("eventName"),
            F.struct(
                F.struct(F.lit("web").alias("name")).alias("bucket"),
                F.struct(key.alias("key"), size.alias("size")).alias("object"),
            ).alias("s3"),
        )

    records = F.array(
        record(F.lit("ObjectCreated:Put"), F.length("url")),
        record(other, F.lit(None).cast("int")),
    )
    return pages.select("page_id", F.to_json(F.struct(records.alias("Records"))).alias("notice"))


def _damaged_notices(spark, sf_dir: str) -> DataFrame:
    """The same, every seventh notice cut short, followed by junk or closed once too often."""
    notice = F.col("notice")
    damaged = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("{broken"), notice))
        .when(F.col("page_id") % 3 == 1, F.concat(notice, F.lit("] junk")))
        .otherwise(F.concat(notice, F.lit("]")))
    )
    return _object_notices(spark, sf_dir).withColumn(
        "notice", F.when(F.col("page_id") % 7 == 0, damaged).otherwise(notice)
    )


_OTHER = """CASE page_id % 3 WHEN 0 THEN 'ObjectRemoved:Delete' WHEN 1 THEN 'ObjectRestore:Post' END"""


@query(
    "flatten_object_notices",
    f"""SELECT page_id, 'web' AS bucket, CONCAT('raw/page+', page_id, '%20copy.html') AS key,
          length(url) AS size, 'ObjectCreated:Put' AS event_name FROM pages
        UNION ALL SELECT page_id, 'web', CONCAT('raw/page+', page_id, '%20copy.html'), 0,
          COALESCE({_OTHER}, 'unknown') FROM pages""",
)
def flatten_object_notices(spark, sf_dir):
    return notices.flatten_objects(_object_notices(spark, sf_dir))


@query(
    "dispatch_records",
    f"""SELECT page_id, NULL AS bucket, NULL AS key, NULL AS event_name, 'error' AS outcome
        FROM pages WHERE page_id % 7 = 0 UNION ALL
        SELECT page_id, 'web' AS bucket, CONCAT('raw/page ', page_id, ' copy.html') AS key,
          name AS event_name, CASE WHEN name IS NULL THEN 'error'
            WHEN name LIKE 'ObjectCreated%' THEN 'processed'
            WHEN name LIKE 'ObjectRemoved%' THEN 'cleanup' ELSE 'skipped' END AS outcome
        FROM (SELECT page_id, 'ObjectCreated:Put' AS name FROM pages
              UNION ALL SELECT page_id, {_OTHER} FROM pages) t WHERE page_id % 7 <> 0""",
)
def dispatch_records(spark, sf_dir):
    return notices.dispatch(_damaged_notices(spark, sf_dir))


@query(
    "dispatch_outcomes",
    f"""SELECT outcome, COUNT(*) AS records FROM (
          SELECT 'error' AS outcome FROM pages WHERE page_id % 7 = 0
          UNION ALL SELECT 'processed' FROM pages WHERE page_id % 7 <> 0
          UNION ALL SELECT CASE WHEN {_OTHER} IS NULL THEN 'error'
            WHEN {_OTHER} LIKE 'ObjectRemoved%' THEN 'cleanup' ELSE 'skipped' END
            FROM pages WHERE page_id % 7 <> 0) t
        GROUP BY outcome""",
)
def dispatch_outcomes(spark, sf_dir):
    return notices.dispatch_counts(_damaged_notices(spark, sf_dir))


def _queue_notices(spark, sf_dir: str) -> DataFrame:
    """One queue notice per conversation turn; the body is a task about the turn."""
    turns = table(spark, sf_dir, "conversations")
    message = F.concat("conv_id", F.lit("-"), "turn")
    kind = F.when(F.col("turn") % 3 == 0, "data_processing").when(
        F.col("turn") % 3 == 1, "cleanup"
    ).otherwise(F.col("role"))
    task = F.to_json(
        F.struct(
            message.alias("task_id"),
            kind.alias("task_type"),
            F.struct(F.length("text").alias("chars")).alias("data"),
            F.when(F.col("role") == "user", 5).alias("priority"),
        )
    )
    body = F.when(F.col("turn") == 4, F.lit("{broken")).otherwise(task)
    attributes = F.when(
        F.col("role") == "user", F.struct(F.col("role").alias("sender"))
    )
    record = F.struct(
        message.alias("messageId"),
        body.alias("body"),
        attributes.alias("messageAttributes"),
        F.concat(F.lit("r-"), message).alias("receiptHandle"),
    )
    return turns.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("notice"))


_TASKS = """
SELECT CONCAT(conv_id, '-', turn) AS message_id, turn, role, length(text) AS chars,
 CASE turn % 3 WHEN 0 THEN 'data_processing' WHEN 1 THEN 'cleanup' ELSE role END AS kind
FROM conversations"""


@query(
    "flatten_queue_messages",
    """SELECT message_id, CASE WHEN role = 'user' THEN '{"sender":"user"}' ELSE '{}' END
       AS attributes, CONCAT('r-', message_id) AS receipt_handle,
       CASE WHEN turn = 4 THEN '{broken' ELSE CONCAT('{"task_id":"', message_id,
         '","task_type":"', kind, '","data":{', CASE WHEN chars IS NULL THEN ''
         ELSE CONCAT('"chars":', chars) END, '}', CASE WHEN role = 'user' THEN ',"priority":5'
         ELSE '' END, '}') END AS body FROM tasks""",
    tasks=_TASKS,
)
def flatten_queue_messages(spark, sf_dir):
    return notices.flatten_messages(_queue_notices(spark, sf_dir)).select(
        "message_id", "attributes", "receipt_handle", "body"
    )


@query(
    "task_batch",
    """SELECT message_id, CASE WHEN turn <> 4 THEN message_id END AS task_id,
       CASE WHEN turn <> 4 AND role = 'user' THEN 5 ELSE 1 END AS priority,
       CASE WHEN turn = 4 OR turn % 3 = 2 THEN 'error' ELSE 'success' END AS status,
       CASE WHEN turn = 4 THEN 'Invalid task format'
            WHEN turn % 3 = 2 THEN CONCAT('Unknown task type: ', role) END AS error FROM tasks""",
    tasks=_TASKS,
)
def task_batch(spark, sf_dir):
    tasks = notices.run_tasks(notices.flatten_messages(_queue_notices(spark, sf_dir)))
    return tasks.select("message_id", "task_id", "priority", "status", "error")


@query(
    "task_failures",
    """SELECT message_id AS message_id, CASE WHEN turn = 4 THEN 'Invalid task format'
       ELSE CONCAT('Unknown task type: ', role) END AS error FROM tasks
       WHERE turn = 4 OR turn % 3 = 2""",
    tasks=_TASKS,
)
def task_failures(spark, sf_dir):
    tasks = notices.run_tasks(notices.flatten_messages(_queue_notices(spark, sf_dir)))
    return notices.failed_messages(tasks)


def _mixed_notices(spark, sf_dir: str) -> DataFrame:
    """One notice per event, in a shape that depends on the event type."""
    events = table(spark, sf_dir, "events")
    tag = F.concat(F.lit('"id-'), F.col("event_id"), F.lit('"'))
    shapes = {
        "click": ('{"httpMethod":"GET","path":"/x","headers":{"x-correlation-id":', "}}"),
        "view": ('{"Records":[{"s3":{"object":{"metadata":{"correlation-id":', "}}}}]}"),
        "purchase": (
            '{"Records":[{"messageAttributes":{"correlationId":{"stringValue":', "}}}]}"
        ),
        "signup": ('{"source":"aws.events","detail":{"correlationId":', "}}"),
    }
    text = F.concat(F.lit('{"headers":{"x-correlation-id":""},"correlationId":'), tag, F.lit("}"))
    for kind, (before, after) in shapes.items():
        shape = F.concat(F.lit(before), tag, F.lit(after))
        text = F.when(F.col("event_type") == kind, shape).otherwise(text)
    return events.select("event_id", "event_type", text.alias("notice"))


@query(
    "classify_notices",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN 'scheduled' WHEN 'view' THEN 's3_trigger'
         WHEN 'purchase' THEN 's3_trigger' ELSE 'direct' END AS event_type,
       CASE event_type WHEN 'signup' THEN 'eventbridge' WHEN 'view' THEN 's3'
         WHEN 'purchase' THEN 's3' WHEN 'click' THEN 'api_gateway' ELSE 'direct' END
         AS event_source FROM events""",
)
def classify_notices(spark, sf_dir):
    mixed = notices.classify(_mixed_notices(spark, sf_dir))
    return mixed.select("event_id", "event_type", "event_source")


@query("correlation_id", "SELECT event_id, CONCAT('id-', event_id) AS correlation_id FROM events")
def correlation_id(spark, sf_dir):
    mixed = _mixed_notices(spark, sf_dir)
    return mixed.select(
        "event_id", notices.correlation_id(F.col("notice")).alias("correlation_id")
    )


@query(
    "request_fields",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'GET' END AS http_method,
       CASE WHEN event_type = 'click' THEN '/x' END AS path, '{}' AS query_parameters,
       CASE WHEN event_type = 'signup' THEN 'aws.events' ELSE 'unknown' END AS source
       FROM events""",
)
def request_fields(spark, sf_dir):
    mixed = notices.generic_fields(notices.api_fields(_mixed_notices(spark, sf_dir)))
    return mixed.select("event_id", "http_method", "path", "query_parameters", "source")
