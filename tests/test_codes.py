"""Crosswalk, code sets and the path hierarchy."""

import random
from collections import Counter

import pytest

from wardloom.operators import codes, hierarchy


def mapping(spark, rows):
    return spark.createDataFrame(rows, "source string, target string, ord long")


def walked(spark, wanted, rows, **kw):
    df = spark.createDataFrame([(c,) for c in wanted], "code string")
    return {r.code: r.converted for r in codes.crosswalk_codes(df, mapping(spark, rows), **kw).collect()}


def test_last_row_of_a_repeated_code_wins(spark):
    rows = [("A1", "001", 1), ("A1", "002", 2), ("B2", "010", 3)]
    assert walked(spark, ["A1", "A1", "B2", "C3", None], rows) == {"A1": "002", "B2": "010", "C3": None}


def test_back_off_takes_the_longest_mapped_prefix_and_its_most_frequent_target(spark):
    rows = [("A", "9", 1), ("A1", "001", 2), ("A11", "002", 3), ("A12", "002", 4), ("A13", "001", 5), ("B", "5", 6)]
    # A1 starts 001 twice and 002 twice: the smaller one; the code X has no prefix
    assert walked(spark, ["A1999", "A2", "B77", "X", "A11"], rows, backoff=True) == {
        "A1999": "001", "A2": "001", "B77": "5", "X": None, "A11": "002",
    }


def test_convert_versions_keeps_old_codes(spark):
    dx = spark.createDataFrame([(1, "0010", "9"), (1, "A1", "10"), (2, "A1", "9"), (2, "Z", "10")], "hadm_id long, icd_code string, icd_version string")
    out = codes.convert_versions(dx, mapping(spark, [("A1", "001", 1)]), "icd_code", "icd_version")
    assert sorted((r.hadm_id, r.icd_code, r.converted or "") for r in out.collect()) == [
        (1, "0010", "0010"), (1, "A1", "001"), (2, "A1", "A1"), (2, "Z", ""),
    ]


@pytest.mark.parametrize("missing, expected", [("drop", {1: [0, 14]}), ("empty", {1: [0, 14], 2: [], 3: []})])
def test_code_set_drops_the_rare_class_and_closes_the_gap(spark, missing, expected):
    cohort = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "stay_id long, hadm_id long")
    dx = spark.createDataFrame([(1, "a"), (1, "a"), (1, "p"), (1, "r"), (2, "r"), (3, "?"), (3, None)], "hadm_id long, code string")
    categories = spark.createDataFrame([("a", 0), ("r", 14), ("p", 15), ("n", None)], "code string, category int")
    out = codes.label_code_set(cohort, dx, categories, 14, missing)
    assert {r.stay_id: r.diagnosis for r in out.collect()} == expected


def test_code_lists(spark):
    rows = [(1, "x|y", None), (2, "x|y", "1.0, 2.50"), (3, "x|y", "9"), (4, "z", None)]
    dx = spark.createDataFrame(rows, "ord long, path string, codes string")
    trimmed = codes.explode_code_list(dx, "path", "codes", "ord")
    assert sorted((r.path, r.pos, r.code) for r in trimmed.collect()) == [("x|y", 0, "10"), ("x|y", 1, "250")]
    as_is = codes.explode_code_list(dx, "path", "codes", "ord", trim=False)
    assert sorted(r.code for r in as_is.collect()) == [" 250", "10"]


def test_last_code_with_a_category_decides_and_conflicts_show(spark):
    exploded = spark.createDataFrame(
        [("a", 0, "1"), ("a", 1, "2"), ("b", 0, "1"), ("b", 1, "?"), ("c", 0, "?"), ("d", 0, "T")], "path string, pos int, code string"
    )
    categories = spark.createDataFrame([("1", 3), ("2", 4)], "code string, category int")
    out = codes.path_categories(exploded, categories, mapping(spark, [("T", "2", 1), ("?", "nowhere", 2)]))
    assert {r.path: (r.category, r.conflict) for r in out.collect()} == {"a": (4, True), "b": (3, False), "d": (4, False)}


def voted(labelled, unlabelled):
    """The hierarchy rule, node by node."""
    nodes, first = {}, {}
    for path in sorted(labelled):
        parts = path.split("|")
        for n in range(1, len(parts) + 1):
            node = "|".join(parts[:n])
            first.setdefault(node, path)
            nodes.setdefault(node, None)
        if len(parts) > 1:
            nodes[path] = labelled[path]
    for node in sorted(nodes, key=lambda n: -n.count("|")):
        if nodes[node] is None:
            children = sorted((c for c in nodes if c.rpartition("|")[0] == node), key=first.get)
            if children:
                nodes[node] = Counter(nodes[c] for c in children).most_common(1)[0][0]
    out = {}
    for path in set(unlabelled) - set(labelled):
        parts = path.split("|")
        prefixes = ["|".join(parts[:n]) for n in range(len(parts) - 1, 1, -1)]
        out[path] = next((nodes[p] for p in prefixes if p in nodes), None)
    return out


@pytest.mark.parametrize("seed, depth", [(1, 4), (2, 6), (3, 12)])
def test_hierarchy_vote_matches_a_direct_loop(spark, seed, depth):
    rng = random.Random(seed)
    names = ["a", "b", "b c", "d"]

    def path():
        return "|".join(rng.choices(names, k=rng.randint(1, depth)))

    labelled = {path(): rng.randrange(4) for _ in range(80)}
    unlabelled = [path() for _ in range(150)]
    tags = spark.createDataFrame(list(labelled.items()), "path string, tag int")
    out = hierarchy.hierarchy_vote(tags, spark.createDataFrame([(p,) for p in unlabelled + list(labelled)], "path string"))
    assert {r.path: r.tag for r in out.collect()} == voted(labelled, unlabelled)


def test_hierarchy_without_inner_nodes(spark):
    tags = spark.createDataFrame([("a", 1)], "path string, tag int")
    out = hierarchy.hierarchy_vote(tags, spark.createDataFrame([("a|b",)], "path string"))
    assert [(r.path, r.tag) for r in out.collect()] == [("a|b", None)]
