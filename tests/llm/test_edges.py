"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import (
    decontaminate,
    licenses,
    lm_score,
    near_dups,
    packing,
    pii,
    quality_rules,
    resample,
    suffix_dups,
    warc,
)
from tallybook.llm.queries import tokenizer_path

LONG = " ".join(f"word{i % 7919} runs" for i in range(12_000)) + " " + "x" * 20_000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and then it sleeps all day long"),
    (1, "the quick brown fox jumps over the lazy dog and then it sleeps all day long"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "a text whose id is missing still has words to count and to keep in order"),
    (5, LONG),
    (6, "tiny"),
    (7, "a\x00b \U0001f600 é ü <|endoftext|> don't"),
]
BENCH = [(1, "a question that stands in no document of this small table at all"), (2, None), (3, "")]
LABELS = [(1, 1, 0), (1, 1, None), (6, 0, 1), (None, 1, 0)]

OPERATORS = {
    "near": lambda d, f: near_dups.near_duplicates(d),
    "near_drop": lambda d, f: near_dups.drop_near_duplicates(d),
    "rules": lambda d, f: quality_rules.apply_rules(d),
    "rules_keep": lambda d, f: quality_rules.keep_good(d),
    "pii": lambda d, f: pii.find_pii(d),
    "pii_redact": lambda d, f: pii.redact(d),
    "leaks": lambda d, f: decontaminate.find_leaks(d, f(BENCH, "item_id bigint, text string")),
    "leaks_drop": lambda d, f: decontaminate.drop_leaks(d, f(BENCH, "item_id bigint, text string")),
    "resample": lambda d, f: resample.resample(
        d, f(LABELS, "doc_id bigint, quality int, toxic int"), 1.0
    ),
    "pack": lambda d, f: packing.pack(d, tokenizer_path()),
    "suffix": lambda d, f: suffix_dups.remove_repeats(d),
    "lm": lambda d, f: lm_score.score(d),
    "licenses": lambda d, f: licenses.find_licenses(d),
}
PER_ROW = ["near", "rules", "pii", "pii_redact", "leaks_drop", "resample", "suffix", "lm"]


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows(frame, name):
    out = OPERATORS[name](frame(ROWS, "doc_id bigint, text string"), frame)
    rows = out.collect()
    if name in PER_ROW:
        ids = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in rows)
        assert ids == sorted(i if i is not None else -1 for i, _ in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(frame, name):
    assert OPERATORS[name](frame([], "doc_id bigint, text string"), frame).count() == 0


CLASHING = [
    "n_words", "vote_symbols", "__row", "__text", "__id", "__doc", "id", "node", "key", "label",
    "kept", "spans", "rank", "length", "start", "p_good", "value", "g", "a b",
]


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(frame, name):
    plain = frame(ROWS, "doc_id bigint, text string")
    extra = plain.withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    want = OPERATORS[name](plain, frame)
    got = OPERATORS[name](extra, frame)
    if set(CLASHING) <= set(got.columns):
        assert got.columns == extra.columns
        assert got.select([F.col(f"`{c}`") for c in CLASHING]).distinct().count() == 1
        got = got.select(*want.columns)
    if name == "lm":
        got, want = (df.select("doc_id", "n_words", F.round("log_likelihood", 1)) for df in (got, want))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_pages_with_nulls_and_repeats(frame):
    rows = [(1, "http://a.b/x", "p"), (1, "http://a.b/x", "p"), (2, None, "p"), (3, "u", None),
            (4, "", ""), (None, "http://a.b", "p"), (5, "http://c.d/ e\r\n", "y\r\n\r\nWARC/1.1\r\n")]
    out = warc.archive_round_trip(
        frame(rows, "page_id bigint, url string, html string").withColumn("run", F.lit(1))
    )
    got = sorted(
        (r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in out.collect()
    )
    assert got == [
        (0, 1, "revisit", 2), (1, 1, "revisit", 2), (1, 1, "revisit", 2), (2, 1, "response", 0),
        (3, 0, "revisit", 4), (4, 0, "response", 0), (5, 15, "response", 0),
    ]
    empty = frame([], "page_id bigint, url string, html string")
    assert warc.archive_round_trip(empty).count() == 0


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_keeps_columns(spark, frame, stage, tmp_path):
    folder = str(tmp_path)
    frame(BENCH, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in ROWS]
    docs = frame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, folder)
    rows = out.collect()
    assert rows
    if stage != "packing":
        assert out.columns == docs.columns
