from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from duelframe.llm import duplicates, toxicity
from duelframe.llm.common import Cache, shared_folder
from tests.llm.rows import CLASHES, ROWS, edges, nothing

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage makes of the rows that the one before kept."""
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SMALL).write.parquet(path)
        found.append((name, docs, spark.read.parquet(path)))
        docs = found[-1][2]
    return {name: (before, after) for name, before, after in found}


def test_stages_keep_columns_and_rows(stages):
    for name, (before, after) in stages.items():
        if name != "packed":
            assert after.columns == before.columns
            assert set(map(tuple, after.collect())) <= set(map(tuple, before.collect()))
    assert set(map(tuple, stages["mixed"][1].collect())) == set(map(tuple, stages["mixed"][0].collect()))
    for name in ("quality", "clean", "distinct"):
        assert stages[name][1].count() < stages[name][0].count()


def test_labelled_good_documents_stay(spark, stages):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    ids = lambda name, i: {r["doc_id"] for r in stages[name][i].collect()}
    lost = ids("quality", 0) - ids("quality", 1)
    assert not any(labels[d]["quality"] == 1 and len(r["text"].split()) >= 15 for r in stages["quality"][0].collect() if (d := r["doc_id"]) in lost & set(labels))
    assert not any(labels[d]["quality"] == 0 for d in ids("quality", 1) & set(labels))
    model = toxicity.learn(stages["clean"][0], spark.read.parquet(f"{SMALL}/labels.parquet"))
    cache = Cache(model.coded)
    expected = {r["doc_id"] for r in stages["clean"][0].collect() if toxicity.score_text(r["text"], cache, model.bias)[0] < corpus_pipeline.TOXIC}
    assert ids("clean", 1) == expected


def test_one_document_of_each_class_stays(stages):
    before, after = stages["distinct"]
    sets = {r["doc_id"]: duplicates.shingles(r["text"]) for r in before.collect()}
    left = {r["doc_id"] for r in after.collect()}
    for i in left:
        assert not any(j > i and duplicates.similarity(sets[i], sets[j]) >= 0.8 for j in left)
    for j in set(sets) - left:
        assert any(i < j and duplicates.similarity(sets[i], sets[j]) >= 0.6 for i in sets)


def test_packed_has_every_row_of_the_mix(stages):
    before, after = stages["packed"]
    rows = after.collect()
    assert Counter(r["doc_id"] for r in rows if r["start"] == 0) == Counter(r["doc_id"] for r in before.collect())
    ends = Counter(r["doc_id"] for r in rows if r["start"] + r["length"] == r["doc_tokens"])
    assert ends == Counter(r["doc_id"] for r in before.collect())


def test_run_is_the_stages_in_a_row(spark, stages):
    found = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, found.drop("sequence_id", "offset", "kind", "start", "length", "ids_crc32").distinct().collect())) == sorted(
        map(tuple, stages["packed"][1].drop("sequence_id", "offset", "kind", "start", "length", "ids_crc32").distinct().collect())
    )


def test_edge_rows_and_empty_table_pass_every_stage(spark):
    for docs in (edges(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            rows = out.collect()
            assert len(rows) <= (len(ROWS) if name != "packed" else 10**6) or name == "mixed"
            if name != "packed":
                assert out.columns == docs.columns
                assert all(r[c] == f"clash {c}" for r in rows for c in CLASHES if c in docs.columns)


def test_a_cluster_must_name_a_shared_folder(spark):
    class Cluster:
        class sparkContext:
            master = "local-cluster[2,1,1024]"

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
