"""Notification logs: one JSON notice per row, flattened, classified and routed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallybook.functions.text import closes_early
from tallybook.operators.validation import json_text, json_type, once

# --- fixed values: notice shapes and routes -----------------------------------------
OBJECT_NOTICE = (
    "Records array<struct<eventName: string, s3: struct<"
    "bucket: struct<name: string>, object: struct<key: string, size: bigint>>>>"
)
QUEUE_NOTICE = (
    "Records array<struct<messageId: string, body: string, "
    "messageAttributes: string, receiptHandle: string>>"
)
SCHEDULER_SOURCE = "aws.events"
CORRELATION_PATHS = (
    "$.headers.x-correlation-id",
    "$.headers.X-Correlation-ID",
    "$.Records[0].messageAttributes.correlationId.stringValue",
    "$.Records[0].s3.object.metadata.correlation-id",
    "$.detail.correlationId",
    "$.correlationId",
)
TASK_TYPES = ("data_processing", "notification", "cleanup")
BAD_TASK = "Invalid task format"
UNKNOWN_TASK = "Unknown task type: "


def is_broken(notice: Column) -> Column:
    """True unless the notice is one JSON object."""
    alone = F.from_json(F.concat(F.lit("["), notice, F.lit("]")), "array<struct<Records: variant>>")
    whole = (F.size(alone) == 1) & F.get(alone, F.lit(0)).isNotNull() & ~closes_early(notice)
    return ~F.coalesce(whole, F.lit(False))


def _records(df: DataFrame, shape: str, broken: bool = False) -> DataFrame:
    """One row per record. With ``broken``, a notice that is no JSON object is a row of nulls;
    an object without records gives no row."""
    others = [c for c in df.columns if c != "notice"]
    records = F.from_json("notice", shape)["Records"]
    bad = is_broken(F.col("notice"))
    if broken:
        blank = F.from_json(F.lit('{"Records":[{}]}'), shape)["Records"]
        records = F.when(bad, blank).otherwise(records)
    else:
        records = F.when(~bad, records)
    return df.select(*others, F.inline(records))


def flatten_objects(df: DataFrame) -> DataFrame:
    """One row per stored object named in the notices."""
    others = [c for c in df.columns if c != "notice"]
    return (
        _records(df, OBJECT_NOTICE)
        .filter(F.col("s3").isNotNull())
        .select(
            *others,
            F.col("s3.bucket.name").alias("bucket"),
            F.col("s3.object.key").alias("key"),
            F.coalesce("s3.object.size", F.lit(0)).cast("bigint").alias("size"),
            F.coalesce("eventName", F.lit("unknown")).alias("event_name"),
        )
    )


def flatten_messages(df: DataFrame) -> DataFrame:
    """One row per queue message; attributes stay JSON text, '{}' when absent.

    A notice that is no JSON object is a message without id and body, so it fails as a task.
    """
    others = [c for c in df.columns if c != "notice"]
    return _records(df, QUEUE_NOTICE, broken=True).select(
        *others,
        F.col("messageId").alias("message_id"),
        "body",
        F.coalesce("messageAttributes", F.lit("{}")).alias("attributes"),
        F.col("receiptHandle").alias("receipt_handle"),
    )


def classify(df: DataFrame) -> DataFrame:
    """Add event_type and source, decided by which keys a notice has."""
    keys = F.json_object_keys("notice")
    scheduled = F.get_json_object("notice", "$.source") == SCHEDULER_SOURCE
    kinds = (
        F.when(scheduled, F.array(F.lit("scheduled"), F.lit("eventbridge")))
        .when(F.array_contains(keys, "Records"), F.array(F.lit("s3_trigger"), F.lit("s3")))
        .when(F.array_contains(keys, "httpMethod"), F.array(F.lit("direct"), F.lit("api_gateway")))
        .otherwise(F.array(F.lit("direct"), F.lit("direct")))
    )
    return df.withColumns({"event_type": kinds[0], "event_source": kinds[1]})


def api_fields(df: DataFrame) -> DataFrame:
    """Method, path, query, headers and body of request notices; maps default to '{}'."""
    body = F.get_json_object("notice", "$.body")
    return df.withColumns(
        {
            "http_method": F.get_json_object("notice", "$.httpMethod"),
            "path": F.get_json_object("notice", "$.path"),
            "query_parameters": F.coalesce(F.get_json_object("notice", "$.queryStringParameters"), F.lit("{}")),
            "headers": F.coalesce(F.get_json_object("notice", "$.headers"), F.lit("{}")),
            "body": body,
            "json_body": F.try_parse_json(body).cast("string"),
        }
    )


def generic_fields(df: DataFrame) -> DataFrame:
    """Source ('unknown' when absent), detail type and detail of other notices."""
    return df.withColumns(
        {
            "source": F.coalesce(F.get_json_object("notice", "$.source"), F.lit("unknown")),
            "detail_type": F.get_json_object("notice", "$['detail-type']"),
            "detail": F.coalesce(F.get_json_object("notice", "$.detail"), F.lit("{}")),
        }
    )


def correlation_id(notice: Column) -> Column:
    """The first non-empty id among the places it may be stored."""
    found = [F.nullif(F.get_json_object(notice, p), F.lit("")) for p in CORRELATION_PATHS]
    return F.coalesce(*found)


def dispatch(df: DataFrame) -> DataFrame:
    """Decode object keys and decide what each record leads to.

    A record without bucket, key or event name is an error row, and so is a notice that is
    no JSON object; neither stops the rest.
    """
    others = [c for c in df.columns if c != "notice"]
    name = F.col("eventName")
    raw_key = F.col("s3.object.key")
    broken = name.isNull() | raw_key.isNull() | F.col("s3.bucket.name").isNull()
    outcome = (
        F.when(broken, "error")
        .when(name.startswith("ObjectCreated"), "processed")
        .when(name.startswith("ObjectRemoved"), "cleanup")
        .otherwise("skipped")
    )
    return _records(df, OBJECT_NOTICE, broken=True).select(
        *others,
        F.col("s3.bucket.name").alias("bucket"),
        F.coalesce(F.try_url_decode(raw_key), raw_key).alias("key"),
        name.alias("event_name"),
        outcome.alias("outcome"),
    )


def dispatch_counts(df: DataFrame) -> DataFrame:
    return dispatch(df).groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))


def run_tasks(messages: DataFrame) -> DataFrame:
    """Validate task bodies and route them by type.

    Adds task_id, task_type, priority (default 1), status and error. A body that is
    not a task object and a task of unknown type fail; the others succeed.
    """
    messages = messages.select("*", once(F.try_parse_json("body")).alias("__task"))
    body = F.col("__task")

    def field(name: str) -> Column:
        return F.try_variant_get(body, f"$.{name}", "variant")

    priority = json_text(field("priority")).try_cast("int")
    well_formed = (
        F.coalesce(json_type(field("task_id")) == "STRING", F.lit(False))
        & F.coalesce(json_type(field("task_type")) == "STRING", F.lit(False))
        & F.coalesce(json_type(field("data")).startswith("OBJECT"), F.lit(False))
        & (field("priority").isNull() | priority.isNotNull())
    )
    task_type = json_text(field("task_type"))
    error = F.when(~well_formed, F.lit(BAD_TASK)).when(
        ~task_type.isin(*TASK_TYPES), F.concat(F.lit(UNKNOWN_TASK), task_type)
    )
    return messages.withColumns(
        {
            "task_id": json_text(field("task_id")),
            "task_type": task_type,
            "priority": F.coalesce(priority, F.lit(1)),
            "error": error,
            "status": F.when(error.isNull(), "success").otherwise("error"),
        }
    ).drop("__task")


def failed_messages(tasks: DataFrame) -> DataFrame:
    """The messages to deliver again."""
    return tasks.filter(F.col("status") == "error").select("message_id", "error")
