"""The pipeline stage by stage against the operators' own parts, and its result as a whole."""

import corpus_pipeline as pipeline
import numpy as np
import pytest

from packlift.llm import packing, pii, quality, simhash, toxicity
from packlift.llm.common import stored, table
from packlift.llm.queries import tokenizer_text

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    found = [docs]
    for name, stage in pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF), f"test-{name}"))
    return found


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "quality", "simhash_dedup", "pii", "packing"]


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[1:5])


def test_toxicity_stage(spark, stages):
    model = toxicity.fit_model(stages[0], table(spark, SF, "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(stages[0], model).collect()}
    assert ids(stages[1]) == sorted(d for d, s in scores.items() if s < 0.5)


def test_quality_stage(stages):
    kept = [r["doc_id"] for r in quality.quality(stages[1]).where("kept").collect()]
    assert ids(stages[2]) == sorted(kept)


def test_dedup_stage(stages):
    rows = simhash.simhash(stages[2]).collect()
    assert ids(stages[3]) == sorted({r["component_id"] for r in rows})


def test_pii_stage(stages):
    before = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    for r in stages[4].collect():
        assert r["text"] == pii.masked(before[r["doc_id"]]) and r["n_chars"] == len(r["text"])
        assert not pii.base_spans(r["text"])


def test_packing_stage(stages):
    got = stages[5].collect()
    assert sorted({r["doc_id"] for r in got}) == ids(stages[4])
    fill = {}
    for r in got:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= packing.LIMIT and tokenizer_text()
    assert np.mean(list(fill.values())) > 0.95 * packing.LIMIT


def test_run_equals_stages(spark, stages):
    run = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in pipeline.run(spark, SF).collect()}
    assert run == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages[5].collect()}
