import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F

from wardloom.llm import outliers

SCHEMA = "doc_id long, text string, lang string, source string, n_words string, kept string"


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(1)
    words = ["a", "bé", "c#", "d\u00a0e", "f", "\u2003", "<g>", "$$"]
    made = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\t", " \x0b", "\r\n", "  "]) for _ in range(rng.randrange(40))) for _ in range(60)]
    return [None, "", " \n ", "one", "a b c a b c", "a a a a", "x y\nx y\n\nx y", "w " * 30_000, *made]


def test_statistics_match_a_direct_count(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    for r in outliers.text_statistics(rows).collect():
        assert tuple(r[1:]) == plain_statistics(texts()[r.row.doc_id])


def clean(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_verdicts_keep_clean_texts_and_reject_outliers(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        rows.append((i, clean(rng, rng.randrange(60, 500)), ["en", "fr", None][i % 3], ["s", "t", None][i // 3 % 3 if i < 300 else 0], "x", "y"))
    for i in range(400, 440):
        rows.append((i, clean(rng, 200).replace(" ", "### "), ["en", "fr", None][i % 3], "s", "x", "y"))
    rows += [(500, None, "en", "s", "x", "y"), (501, "", None, None, "x", "y"), (None, rows[0][1], "en", "s", "x", "y"), rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA)
    judged = outliers.judge(docs, docs.columns).collect()
    assert len(judged) == len(rows)
    by_id = {r.row.doc_id: r for r in judged}
    assert all(by_id[i].kept for i in range(400)) and by_id[None].kept
    assert not any(by_id[i].kept for i in range(400, 440))
    assert by_id[500].base_failed and by_id[501].base_failed and by_id[500].distance is None
    kept = outliers.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 402 and kept.where("n_words = 'x' AND kept = 'y'").count() == 402


def test_small_sources_are_judged_by_their_language(spark):
    rng = random.Random(6)
    sources = ["large"] * 300 + ["one"] + ["mostly"] * 45 + ["alone"]
    junk = [300, *range(301, 331)]  # one text in a source of its own, and 30 of 45
    rows = [(i, clean(rng, rng.randrange(60, 500)), "es", s) for i, s in enumerate(sources)]
    rows = [(i, t.replace(" ", "### ") if i in junk else t, lang, s) for i, t, lang, s in rows]
    judged = outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.row.doc_id for r in judged if not r.kept} == set(junk) and len(judged) == len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert outliers.judge(docs).collect() == []


def vectors(spark, points):
    rows = [(1, i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "grp long, pick long, " + ", ".join(f"{a} double" for a in outliers.AXES))


def test_estimate_is_not_moved_by_outliers(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(400, 5)) @ np.diag([1, 2, 1, 1, 1]) + [5, 0, 1, 1, 1]
    bad = rng.normal(size=(80, 5)) * 0.3 + [25, 10, 9, 9, 9]
    found = outliers.mcd_estimates(vectors(spark, [*good, *bad]), outliers.Rules(least_spread=(0.01,) * 5)).first()
    assert np.abs(np.array([found[m] for m in outliers.MEANS]) - good.mean(axis=0)).max() < 0.25
    assert np.abs(np.vstack([good, bad]).mean(axis=0) - good.mean(axis=0)).max() > 1
    factor = np.array([[found[f"l{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert np.abs(np.linalg.det(factor @ factor.T) / np.linalg.det(np.cov(good.T)) - 1) < 0.6


def test_steps_never_raise_the_determinant(spark):
    rng = np.random.default_rng(4)
    points = vectors(spark, rng.normal(size=(200, 5)) ** 3).withColumn("start", F.lit(0))
    rules = outliers.Rules(least_spread=(1e-6,) * 5)
    now = outliers._factored(outliers._estimate(points, ["grp", "start"]), rules.least_spread, 1.0)
    before = now.first().log_det
    for _ in range(4):
        now = outliers._concentrate(points, now, ["grp", "start"], rules)
        after = now.first().log_det
        assert after <= before + 1e-3
        before = after


def test_distance_matches_numpy(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(100, 5)) @ rng.normal(size=(5, 5))
    rows = vectors(spark, points)
    estimate = outliers._factored(outliers._estimate(rows, ["grp"]), (0.5,) * 5, 1.3)
    found = {r.pick: r.d for r in rows.join(estimate, "grp").select("pick", outliers._distance().alias("d")).collect()}
    scatter = np.linalg.inv(1.3 * np.cov(points.T, bias=True) + 0.25 * np.eye(5))
    for i, p in enumerate(points - points.mean(axis=0)):
        assert abs(found[i] - p @ scatter @ p) < 1e-6 * max(1, found[i])
