"""The stages of the pipeline, each against what it should keep."""

import os
from collections import Counter

import pytest
from test_ngram_join import brute

import corpus_pipeline
from vigilcard.llm import source_mix

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not here")


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        function(spark, docs, SF_DIR).write.parquet(path)
        found.append((docs, spark.read.parquet(path)))
        docs = found[-1][1]
    return found


def test_all_but_the_last_keep_the_columns(outputs):
    assert [after.columns == before.columns for before, after in outputs] == [True] * 4 + [False]


def test_filters_keep_clean_documents(spark, outputs):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    for (before, after), clean in zip(outputs[:2], (lambda r: r.toxic == 0, lambda r: r.quality == 1), strict=True):
        there, kept = ({r.doc_id for r in df.collect()} for df in (before, after))
        good = [i for i in there if i in labels and clean(labels[i])]
        assert kept <= there and sum(i in kept for i in good) >= 0.95 * len(good)


def test_one_of_each_group_stays(outputs):
    before, after = outputs[2]
    groups = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_mix_and_packing_hold_the_taken_words(outputs):
    before, mixed = outputs[3]
    taken = {r.doc_id: r.taken for r in source_mix.taken(before).collect() if r.taken}
    words, packed = Counter(), Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    for r in outputs[4][1].collect():
        packed[r.doc_id] += r.n_words
    assert words == taken == +packed


def test_empty_documents(spark, outputs):
    docs = outputs[0][0].limit(0)
    for _, function in corpus_pipeline.STAGES:
        result = function(spark, docs, SF_DIR)
        assert result.count() == 0
        docs = docs if result.columns != docs.columns else result
