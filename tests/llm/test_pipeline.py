"""The pipeline's stages, each against its operator's query on the same input."""

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tallybook.llm import decontaminate, near_dups, packing, pii, quality_rules
from tallybook.llm.queries import registry, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def test_everything_is_registered():
    names = set(entry_points.queries())
    assert set(registry()) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in registry()) == list(range(1, 11))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Each stage's input, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        made[name] = docs
        path = str(folder / name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
    made["end"] = docs
    return made


def ids(df, condition="true"):
    return {r.doc_id for r in df.where(condition).select("doc_id").collect()}


def test_stages_take_effect(inputs, spark):
    kept = quality_rules.apply_rules(inputs["quality_rules"])
    assert ids(inputs["near_dedup"]) == ids(kept, "kept")
    first = near_dups.near_duplicates(inputs["near_dedup"])
    assert ids(inputs["decontaminate"]) == ids(first, "is_first")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    leaks = decontaminate.find_leaks(inputs["decontaminate"], bench)
    assert ids(inputs["pii"]) == ids(inputs["decontaminate"]) - ids(leaks)
    assert ids(inputs["packing"]) == ids(inputs["pii"])
    assert not ids(pii.find_pii(inputs["packing"]), "n_email + n_card + n_phone + n_ip > 0")
    want = packing.pack(inputs["packing"], tokenizer_path())
    assert sorted(want.collect()) == sorted(inputs["end"].collect())


def test_run_equals_its_stages(inputs, spark):
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(inputs["end"].collect())
