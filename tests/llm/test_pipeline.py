import collections

import pytest

import corpus_pipeline
from wardloom.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), name)
        found.append(docs)
    return found


def test_stages_return_the_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[1:5])


def test_each_stage_decides_on_what_it_gets(spark, small, stages):
    documents, good, lines, single, mixed, packed = ([r.asDict() for r in s.collect()] for s in stages)
    ids = [{r["doc_id"] for r in rows} for rows in (documents, good, lines, single, mixed)]
    assert ids[0] > ids[1] > ids[2] >= ids[3] >= ids[4]
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in documents}
    assert all(i in ids[1] for i, q in quality.items() if q == 1 and words[i] >= 50)
    assert not any(i in ids[1] for i, q in quality.items() if q == 0)
    before = {r["doc_id"]: r["text"].split("\n") for r in good}
    for r in lines:
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split("\n")) <= set(before[r["doc_id"]])
    copies = collections.Counter(r["doc_id"] for r in mixed)
    assert max(copies.values()) == 2
    whole = {r["doc_id"]: r for r in single}
    assert all(r == whole[r["doc_id"]] for r in mixed)
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies
    filled = collections.Counter()
    for r in packed:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and len(filled) <= -(-sum(filled.values()) // 2048) * 1.02 + 1


def test_run_is_the_stages_one_after_another(spark, small, stages):
    def rows(df):
        return sorted(map(tuple, df.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))

    assert rows(corpus_pipeline.run(spark, small)) == rows(stages[-1])
