import collections
import random

from pyspark.sql import functions as F

from wardloom.llm import mixing


def made(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randrange(1, 40), f"s{min(rng.randrange(6), 3)}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_targets_fill_like_the_rule(spark):
    units = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), ("c", 50, 2), (None, 400, 1), ("z", 0, 1)], "source string, size long, n long")
    found = {r.source: r for r in mixing.source_targets(units).collect()}
    weights = {"a": 3, "b": 1, "c": 2, "z": 3, None: 1}
    sizes = {"a": 10, "b": 1000, "c": 100, "z": 0, None: 400}
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while over := [s for s in open_ if left * weights[s] / sum(weights[o] for o in open_) > 2 * sizes[s]]:
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    target |= {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
    assert {s: r.source_size for s, r in found.items()} == sizes
    assert all(abs(found[s].target - target[s]) < 1e-9 for s in sizes)


def test_sources_come_near_their_targets(spark):
    docs, rows = made(spark)
    found = mixing.mixed_rows(mixing.copies(docs, fan=4)).collect()
    size, taken, target = collections.Counter(), collections.Counter(), {}
    source = {i: s for i, _, s in rows}
    for r in found:
        assert r.taken in (0, r.size, 2 * r.size)
        size[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert len(found) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 40 for s in size)


def test_reruns_agree_however_rows_are_dealt(spark):
    docs, _ = made(spark)
    first = sorted(map(tuple, mixing.mixed_rows(mixing.copies(docs)).collect()))
    assert first == sorted(map(tuple, mixing.mixed_rows(mixing.copies(docs.repartition(5, "text"))).collect()))


def test_rounding_keeps_expectations(spark):
    docs, _ = made(spark, 120)
    total, rounds = collections.Counter(), 12
    for seed in range(rounds):
        for r in mixing.copies(docs, seed=seed, fan=8).select("doc_id", (F.col("copies") - F.col("target") / F.col("source_size")).alias("off")).collect():
            total[r.doc_id] += r.off
    assert abs(sum(total.values()) / rounds / 120) < 0.05
    assert sum(abs(v) / rounds for v in total.values()) / 120 < 0.25


def test_odd_rows(spark):
    rows = [(1, "a b", "s", 9)] * 3 + [(None, "c", None, 9), (None, "c", None, 9), (2, None, "s", 9), (2, "", "s", 9), (2, "x " * 50_000, "t", 9), (3, "a b", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long")
    found = mixing.mixed_rows(mixing.copies(docs)).collect()
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(i), len((t or "").split())) for i, t, _, _ in rows)
    assert all(r.taken <= 2 * r.size for r in found)
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    words = mix.select(F.sum(F.when(F.trim("text") == "", 0).otherwise(F.size(F.split(F.trim("text"), " "))))).first()[0]
    assert words == sum(r.taken for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixed_rows(mixing.copies(docs)).collect() == [] and mixing.mix_documents(docs).collect() == []
    docs = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mixed_rows(mixing.copies(docs)).collect()] == [0, 0]
