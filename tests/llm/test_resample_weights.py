"""Importance weights of op5 worked out anew, and its tables without rows."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallybook.llm import decontaminate, resample, textkit

DOCS = "doc_id bigint, text string"
LABELS = "doc_id bigint, quality int, toxic int"
BENCH = "item_id bigint, text string"


def plain_features(text):
    """Buckets of words and of neighbouring words of one text, word by word."""
    hashes = []
    for word in (text or "").split():
        column = pa.array([word])
        found, *_ = textkit.word_hashes(*textkit.buffer_of(column), textkit.is_word_byte(), lower=False)
        hashes.append(int(found[0]))
    pairs = []
    for a, b in zip(hashes, hashes[1:], strict=False):
        both = np.array([(a * 0x9E3779B97F4A7C15 + b) % (1 << 64)], np.uint64)
        pairs.append(int(textkit.mix(both)[0]) % resample.PAIRS + resample.WORDS)
    return [h % resample.WORDS for h in hashes] + pairs


def plain_weights(docs, targets):
    raw, target = Counter(), Counter()
    for i, text in docs:
        found = plain_features(text)
        raw.update(found)
        if i in targets:
            target.update(found)
    share = sum(target.values()) / sum(raw.values())

    def ratio(b):
        expected = raw[b] * share + resample.SMOOTHING
        value = math.log((target[b] + resample.SMOOTHING) / expected)
        return math.copysign(max(0.0, abs(value) - resample.CERTAINTY / math.sqrt(expected)), value)

    return {i: sum(map(ratio, plain_features(text))) for i, text in docs}


def corpus():
    rnd = random.Random(6)
    docs = []
    for i in range(120):
        words = ["good", "fine", "calm"] if i % 2 else ["bad", "rude", "loud"]
        docs.append((i, " ".join(rnd.choices([*words, "and", "the"], k=rnd.randrange(80)))))
    return [*docs, (120, None), (121, "")]


def test_weights_by_brute_force(frame):
    docs = corpus()
    labels = [(i, 1, 0) if i % 2 else (i, 0, i % 3 % 2) for i in range(100)]
    got = resample.resample(frame(docs, DOCS), frame(labels, LABELS), 1.0)
    weights = {r.doc_id: r.log_weight for r in got.collect()}
    want = plain_weights(docs, {i for i in range(100) if i % 2})
    assert weights.keys() == want.keys()
    for i, w in want.items():
        assert weights[i] == pytest.approx(w, abs=1e-6)


def test_ties_go_by_id(frame):
    docs = [(i, "alike in every word") for i in range(30)]
    labels = [(i, 1, 0) for i in range(30)]
    drawn = resample.resample(frame(docs, DOCS), frame(labels, LABELS), 0.5).collect()
    assert len(drawn) == 15
    by_key = sorted(
        resample.resample(frame(docs, DOCS), frame(labels, LABELS), 1.0).collect(),
        key=lambda r: (-r["key"], r["doc_id"]),
    )
    assert {r["doc_id"] for r in drawn} == {r["doc_id"] for r in by_key[:15]}


def test_no_labels_draw_nothing_by_default(frame):
    docs, none = frame(corpus(), DOCS), frame([], LABELS)
    assert resample.resample(docs, none).count() == 0
    kept = resample.resample(docs, none, 1.0)
    assert {r["log_weight"] for r in kept.collect()} == {0.0}


def test_no_benchmark_leaks_nothing(frame):
    docs, none = frame(corpus(), DOCS), frame([], BENCH)
    assert decontaminate.find_leaks(docs, none).count() == 0
    assert decontaminate.drop_leaks(docs, none).count() == len(corpus())
