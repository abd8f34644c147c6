import random
import zlib

import numpy as np
import pytest

from wardloom.llm import queries, toxicity


def test_held_out_labels_are_predicted(spark):
    d = "/root/testdata/sf0.01"
    toxic = {r.doc_id: r.toxic for r in queries.table(spark, d, "labels").collect()}
    rows = queries.op1_counterfactual_toxicity(spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    asked = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    yes, no = [s for s, y in asked if y], [s for s, y in asked if not y]
    assert sum((a > b) + (a == b) / 2 for a in yes for b in no) / len(yes) / len(no) > 0.8  # 40 toxic texts to learn from


def made(spark, n=900):
    """Toxic words decide, but toxic texts name one group far more often than others."""
    rng = random.Random(4)
    plain = ["".join(rng.choice("bcdfghklm") + rng.choice("aeiou") for _ in range(3)) for _ in range(200)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        words = rng.sample(plain, 12) + (["idiot"] * (rng.random() < 0.8) if toxic else [])
        if rng.random() < (0.7 if toxic else 0.04):
            words.append("muslim")
        elif rng.random() < 0.2:
            words.append("christian")
        rng.shuffle(words)
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def scores(spark):
    docs, labels = made(spark)
    asked = ["a muslim came", "a christian came", "a hindu came", "an idiot came", ""]
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(asked)] + [(9, None, "x")], "doc_id long, text string, score string")
    found = {}
    for pairing in (0.0, 1000.0):
        model = toxicity.train(docs, labels, toxicity.Fit(pairing=pairing))
        found[pairing] = {r.row.doc_id: r.score for r in toxicity.score_texts(table, model).collect()}
    return found


def test_swapped_identity_terms_score_alike(scores):
    plain, paired = scores[0.0], scores[1000.0]
    assert plain[0] - plain[1] > 0.3  # without the penalty a neutral mention is held against the group
    assert abs(paired[0] - paired[1]) < 0.05 and abs(paired[0] - paired[2]) < 0.05
    assert paired[0] < 0.5 < paired[3]


def test_empty_texts_have_the_least_evidence(scores):
    assert scores[1000.0][4] == scores[1000.0][9] and 0 < scores[1000.0][4] < 0.5


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "bad words"), (1, "bad words"), (None, "x"), (2, None), (3, ""), (4, "y " * 100_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0), (4, 0), (99, 1)], "doc_id long, toxic int")
    scored = toxicity.score_texts(docs, toxicity.train(docs, labels), carry=("doc_id", "text")).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    none = toxicity.train(docs, labels.limit(0))
    assert all(r.score == pytest.approx(1e-3) for r in toxicity.score_texts(docs, none).collect())
    assert toxicity.score_texts(docs.limit(0), none).collect() == []


def test_model_takes_labels_of_its_folds_only(spark):
    docs, labels = made(spark, 60)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = (toxicity.train(docs, x, toxicity.Fit(least_evidence=1.0)) for x in (labels, other))
    assert np.array_equal(one[0], two[0]) and np.array_equal(one[1], two[1]) and one[2] == two[2]


def test_few_toxic_labels_score_their_share(spark):
    docs, labels = made(spark, 36)
    few = labels.selectExpr("doc_id", "CAST(doc_id IN (0, 3, 6) AS INT) AS toxic")
    features, weights, intercept = toxicity.train(docs, few)
    known = [i for i in range(36) if zlib.crc32(str(i).encode()) % 5]
    share = max(sum(i in (0, 3, 6) for i in known) / len(known), 1e-3)
    scored = toxicity.score_texts(docs, (features, weights, intercept)).collect()
    assert len(features) == 0 and all(r.score == pytest.approx(share) for r in scored)


def test_swapped_identity_terms_score_alike_by_default(spark):
    docs, labels = made(spark)
    table = spark.createDataFrame([(0, "a muslim came"), (1, "a christian came"), (2, "an idiot came")], "doc_id long, text string")
    found = {r.row.doc_id: r.score for r in toxicity.score_texts(table, toxicity.train(docs, labels)).collect()}
    assert abs(found[0] - found[1]) < 0.05 and max(found[0], found[1]) < 0.5 < found[2]
