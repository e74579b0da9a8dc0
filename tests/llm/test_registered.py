"""The registered text queries next to their SQL, on the smallest data, and the pipeline next to plain Python."""

import hashlib

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from gradus.llm import bpe, registry
from gradus.llm.text_queries import rank_file
from tests.compare import compare, duck
from tests.llm.fixture import documents, nothing, words
from tests.llm.test_native import brute_measures, squeezed
from tests.llm.test_text import brute_components

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_same_rows_as_sql(spark, name):
    message, _, ok = compare(spark, duck(SMALL), name, SMALL, registry.queries(), registry.oracles())
    assert ok, message


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, len(registry.queries()) + 1))
    assert set(registry.queries()) | {"pipeline"} <= names


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = documents(spark)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        after = stage(spark, docs, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns, name
        after.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        now = docs.collect()
        if i == 0:
            assert {r.doc_id for r in now} == {r.doc_id for r in before if not brute_measures(r.text)[-1]}
        elif i == 1:
            groups = {}
            for r in before:
                groups.setdefault(squeezed(r.text), []).append((-len(r.text), r.doc_id))
            assert {r.doc_id for r in now} == {min(g)[1] for g in groups.values()}
        elif i == 2:
            assert {r.doc_id for r in now} == {d for d, _, _, kept in brute_components([(r.doc_id, r.text) for r in before], 5, 80) if kept}
        elif i == 3:
            assert {r.doc_id for r in now} <= {r.doc_id for r in before} and len(now) > 0
        else:
            encoder = bpe.encoder_of(rank_file(), __import__("public_tokenizers").PATTERN)
            texts = {r.doc_id: r.text for r in before}
            assert len(now) == len(before)
            for r in now:
                assert bytes(r.ids) == encoder.encode(texts[r.doc_id]) and r.n_tokens == len(np.frombuffer(r.ids, "<u4"))
                assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_pipeline_of_nothing(spark, tmp_path):
    nothing(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert words(None) == []
