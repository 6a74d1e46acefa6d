"""Registered queries of the corpus operators, over whole tables with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_REGISTER: dict[str, tuple[Query, str | None]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        _REGISTER[name] = (fn, sql)
        return fn

    return register


def registry() -> dict[str, tuple[Query, str | None]]:
    return dict(_REGISTER)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query("op6_pack_sequences")
def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), tokenizer_path())


@_query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.quality_rules import apply_rules

    return apply_rules(_table(spark, sf_dir, "documents"))


@_query("op4_benchmark_leaks")
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.decontaminate import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query("op3_personal_data")
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.pii import find_pii

    return find_pii(_table(spark, sf_dir, "documents"))


@_query("op1_near_duplicates")
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.near_dups import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


# Five hexadecimal digits are four symbols of base 32.
_OP7_SQL = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS html, COALESCE(url, '') AS url FROM pages
), q AS (
  SELECT page_id, html, sha1(html) AS hex, MAX(page_id) OVER (PARTITION BY html) AS original,
   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE url END AS rest
  FROM p
), r AS (
  SELECT *, regexp_extract(rest, '^[^/?#]*') AS head,
   regexp_replace(lower(regexp_extract(rest, '^[^/?#]*')), '^.*@', '') AS host FROM q
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
   1 + CAST((CAST(CONCAT('0x', substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5)) AS BIGINT)
     // (CASE i % 4 WHEN 0 THEN 32768 WHEN 1 THEN 1024 WHEN 2 THEN 32 ELSE 1 END)) % 32 AS INT),
   1)), '') AS payload_digest,
 CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> original THEN original END AS refers_to,
 CONCAT(array_to_string(list_reverse(string_split(split_part(host, ':', 1), '.')), ','),
   substr(host, length(split_part(host, ':', 1)) + 1), ')',
   CASE WHEN length(rest) > length(head) THEN substr(rest, length(head) + 1) ELSE '/' END)
   AS url_key,
 strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 315360000), '%Y-%m-%dT%H:%M:%SZ')
   AS captured_at
FROM r
"""


@_query("op7_web_archives", _OP7_SQL)
def op7_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.warc import archive_round_trip

    return archive_round_trip(_table(spark, sf_dir, "pages"))


@_query("op5_resample_quality")
def op5_resample_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.resample import resample

    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op9_lm_scores")
def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.lm_score import score

    return score(_table(spark, sf_dir, "documents"))


@_query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.licenses import find_licenses

    return find_licenses(_table(spark, sf_dir, "documents"))


@_query("op8_repeated_strings")
def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.suffix_dups import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


@_query("op11_target_resample")
def op11_target_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.target_resample import resample_to_target

    drawn = resample_to_target(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@_query("op12_prefix_trie")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.prefix_trie import conversation_trie

    return conversation_trie(_table(spark, sf_dir, "conversations"))


@_query("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallybook.llm.secret_scan import find_secrets, report

    return report(find_secrets(_table(spark, sf_dir, "documents")))
