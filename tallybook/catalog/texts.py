"""Text jobs over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.catalog.base import query, table, visit_events
from tallybook.functions import dates, text

_MASKED = "text"
for _name, _pattern in text.MASK_PATTERNS.items():
    _MASKED = f"regexp_replace({_MASKED}, '{_pattern}', '{text.mask_token(_name)}', 'g')"


@query("pii_redact", f"SELECT doc_id, {_MASKED} AS text FROM documents")
def pii_redact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.mask(F.col("text")).alias("text"))


@query(
    "pii_hits",
    "SELECT source, "
    + ", ".join(
        f"""CAST(SUM((length(masked) - length(replace(masked, '{text.mask_token(n)}', '')))
            // {len(text.mask_token(n))}) AS BIGINT) AS {n}_hits"""
        for n in text.MASK_PATTERNS
    )
    + " FROM masked_docs GROUP BY source",
    masked_docs=f"SELECT source, {_MASKED} AS masked FROM documents",
)
def pii_hits(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "text")
    return text.mask_hits(docs, "text", ["source"])


@query(
    "normalise_text",
    r"""SELECT doc_id, trim(regexp_replace(text, '[ \t\n\x0B\f\r\x{0085}\x{2028}\x{2029}\pZ]+',
        ' ', 'g')) AS text FROM documents""",
)
def normalise_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.collapse_whitespace(F.col("text")).alias("text"))


@query(
    "truncate_text",
    """SELECT doc_id, CASE WHEN length(text) <= 200 THEN text
         ELSE CONCAT(SUBSTR(text, 1, 197), '...') END AS short,
       CASE WHEN length(text) <= 3 THEN text ELSE SUBSTR(text, 1, 3) END AS tiny
       FROM documents""",
)
def truncate_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    body = F.col("text")
    return docs.select(
        "doc_id",
        text.truncate(body, 200).alias("short"),
        text.truncate(body, 3).alias("tiny"),
    )


@query(
    "safe_names",
    r"""SELECT page_id, CASE WHEN n = '' THEN 'unnamed_file' ELSE n END AS name,
        octet_length(encode(url)) BETWEEN 1 AND 1024 AND NOT starts_with(url, '/')
          AND regexp_full_match(url, '[A-Za-z0-9!_.*''()/=-]+') AS is_key
        FROM (SELECT page_id, url, trim(regexp_replace(url, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'),
              '. ') AS n FROM pages) t""",
)
def safe_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        text.safe_filename(url).alias("name"),
        text.is_storage_key(url).alias("is_key"),
    )


@query(
    "rename_columns",
    """SELECT event_id AS "eventId", ts AS ts, user_id AS "userId", event_type AS "eventType",
       "value" AS "value", props AS props FROM events""",
)
def rename_columns(spark, sf_dir):
    return text.rename_columns(table(spark, sf_dir, "events"), "camel")


@query(
    "extract_numbers",
    r"""SELECT doc_id, len(n) AS n_numbers, n[1] AS first_number, n[-1] AS last_number
        FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '-?\d+\.?\d*'),
              lambda s: CAST(s AS DOUBLE)) AS n FROM documents) t""",
)
def extract_numbers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", text.numbers_in(F.col("text")).alias("n"))
    return found.select(
        "doc_id",
        F.size("n").cast("bigint").alias("n_numbers"),
        F.get("n", F.lit(0)).alias("first_number"),
        F.try_element_at("n", F.lit(-1)).alias("last_number"),
    )


_SIZE = "n < 1024 THEN CONCAT(n, ' B')"
for _power, _unit in enumerate(text.BYTE_UNITS[1:], start=1):
    _u = 1024**_power
    _tenths = f"""(n // {_u} * 10 + n % {_u} * 10 // {_u}
      + CASE WHEN n % {_u} * 10 % {_u} * 2 > {_u}
          OR (n % {_u} * 10 % {_u} * 2 = {_u} AND n % {_u} * 10 // {_u} % 2 = 1)
        THEN 1 ELSE 0 END)"""
    _limit = f"n < {_u * 1024}" if _unit != text.BYTE_UNITS[-1] else "TRUE"
    _SIZE += f" WHEN {_limit} THEN CONCAT({_tenths} // 10, '.', {_tenths} % 10, ' {_unit}')"


@query(
    "size_text",
    f"SELECT event_id, CASE WHEN {_SIZE} END AS size FROM sized",
    sized="""SELECT event_id, (event_id * 37 + 11) * CASE event_id % 3 WHEN 0 THEN 1
             WHEN 1 THEN 4096 ELSE 33554432 END AS n FROM events""",
)
def size_text(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    factor = F.expr("CASE event_id % 3 WHEN 0 THEN 1L WHEN 1 THEN 4096L ELSE 33554432L END")
    n = (F.col("event_id") * 37 + 11) * factor
    return events.select("event_id", text.byte_size(n).alias("size"))


@query(
    "safe_json",
    """SELECT event_id, CASE WHEN event_type = 'error' OR event_id % 11 < 3 THEN -1
       ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def safe_json(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    damaged = F.when(
        F.col("event_type") == "error", F.concat(F.lit("oops "), "props")
    ).otherwise(
        # closed once too often, with junk, and with a second value
        F.when(F.col("event_id") % 11 == 0, F.concat("props", F.lit("]")))
        .when(F.col("event_id") % 11 == 1, F.concat("props", F.lit("}] junk")))
        .when(F.col("event_id") % 11 == 2, F.concat("props", F.lit("] [1]")))
        .otherwise(F.col("props"))
    )
    default = F.struct(F.lit(-1).cast("bigint").alias("k"))
    return events.select(
        "event_id", text.parse_json_or(damaged, default, "k: bigint")["k"].alias("k")
    )


@query(
    "date_from_name",
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'no date'
         ELSE CAST(CAST(timestamp AS DATE) AS VARCHAR) END AS day FROM visit_events""",
)
def date_from_name(spark, sf_dir):
    events = visit_events(spark, sf_dir)
    name = (
        F.when(
            F.col("event_id") % 4 == 0, F.date_format("timestamp", "'report_'yyyy-MM-dd'.csv'")
        )
        # an impossible dashed date is passed over for the compact one
        .when(
            F.col("event_id") % 4 == 1,
            F.date_format("timestamp", "'v2024-13-45_'yyyyMMdd'.csv'"),
        )
        .when(F.col("event_id") % 4 == 2, F.date_format("timestamp", "yyyy_MM_dd'.csv'"))
        .otherwise(F.lit("report_12.csv"))
    )
    day = F.coalesce(dates.date_from_name(name).cast("string"), F.lit("no date"))
    return events.select("event_id", day.alias("day"))
