"""Importance resampling towards a target against a plain version, and its selection alone."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybook.llm import target_resample as tr

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def plain(rows, target, share=25, least=20):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    raw, want = Counter(), Counter()
    for _, text in rows:
        raw.update(map(bucket, plain_features(text)[1]))
    for text in target:
        want.update(map(bucket, plain_features(text)[1]))
    s_all, t_all = sum(raw.values()) + 10000, sum(want.values()) + 10000
    out = []
    for doc, text in rows:
        n, found = plain_features(text)
        gains = [
            math.floor(1000 * math.log((want[b] + 1) * s_all / ((raw[b] + 1) * t_all)))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'null' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(found), weight, score, None, n])
    able = sorted(
        (r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1])
    )
    for i, r in enumerate(able[: share * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def as_rows(df):
    return sorted(
        (tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()),
        key=str,
    )


def texts(n, seed=1):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Straße", "éa", "X9", "x" * 70, "日本語" * 40]
    return [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 19, 20, 25, 80]))) for _ in range(n)]


def test_against_plain_version(frame):
    rows = list(enumerate(texts(300)))
    rows += [rows[7], (None, rows[8][1]), (None, rows[9][1]), (8, None), (9, ""), (500, "A-b\tc_D" * 9)]
    target = [*texts(20, 2), None, ""]
    got = tr.resample_to_target(
        frame(rows, "doc_id bigint, text string"), frame([(t,) for t in target], "text string")
    )
    assert as_rows(got) == plain(rows, target)


def test_empty_tables(frame):
    schema = "doc_id bigint, text string"
    none = frame([], schema)
    rows = list(enumerate(texts(40)))
    assert tr.resample_to_target(none, none).count() == 0
    assert as_rows(tr.resample_to_target(frame(rows, schema), none)) == plain(rows, [])


def test_carried_and_clashing_columns(frame):
    rows = list(enumerate(texts(60)))
    docs = frame(rows, "doc_id bigint, text string")
    extra = docs.withColumns({c: F.lit(f"own {c}") for c in ("row", "rank", "score", "_row", "a b")})
    got = tr.resample_to_target(extra, docs, carry=["text", "a b"])
    assert got.columns[-3:] == ["text", "a b", "rank"]
    assert as_rows(got) == as_rows(tr.resample_to_target(docs, docs))
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == set(rows)


def test_ties_of_one_id(frame):
    text = "the same words stand in all of these rows " * 3
    rows = [(3, text)] * 40 + [(4, text)] * 4
    got = tr.resample_to_target(frame(rows, "doc_id bigint, text string"), frame([(text,)], "text string"))
    assert as_rows(got) == plain(rows, [text])


@pytest.mark.parametrize("k", [1, 2, 333, 1999, 2000])
def test_cutoff_by_weighted_medians(spark, k):
    rnd = random.Random(k)
    keys = [(rnd.randrange(5), 0, rnd.randrange(40), rnd.randrange(3), i) for i in range(2000)]
    df = spark.createDataFrame(keys, ", ".join(f"{c} bigint" for c in tr._KEY)).repartition(7)
    assert tr.cutoff_key(df, k, small_rest=10) == sorted(keys)[k - 1]


def test_checksums_of_spans():
    import numpy as np

    data = np.frombuffer(b"alpha beta " + b"g" * 200, np.uint8)
    starts, ends = np.array([0, 6, 11, 3, 4]), np.array([5, 10, 211, 3, 75])
    got = tr.crc_on(np.full(5, 0xFFFFFFFF, np.uint32), data, starts, ends) ^ np.uint32(0xFFFFFFFF)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
