"""Frames for the corpus operators' tests."""

import pytest


@pytest.fixture
def frame(spark):
    """DataFrame of rows in few partitions, from a schema text."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).coalesce(2)

    return make


@pytest.fixture
def docs(frame):
    """Documents with ids from 0, from texts; or rows of (doc_id, text)."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return frame(rows, "doc_id bigint, text string")

    return make
