import collections
import random
import re

import pytest

from wardloom.llm import components, jaccard


def shingles(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def least_ids(rows, percent=85):
    """Component of every row by looking at every pair."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    members = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    least = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return collections.Counter((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind == 1 and len(words) > 1:
            del words[at]
        else:
            words.insert(at, f"more{rng.randrange(10**6)}")
    return words


def made():
    rng = random.Random(13)
    texts = []
    passage = [f"p{i}" for i in range(30)]
    for family in range(14):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.choice([4, 5, 9, 10, 12, 30, 60, 120, 200]))]
        for _ in range(rng.choice([1, 3, 12])):
            texts.append(" ".join(edited(rng, base, rng.randrange(0, 1 + len(base) // 12))))
    for i in range(25):  # mostly a passage that many share
        texts.append(" ".join(passage + [f"own{i}x{j}" for j in range(rng.randrange(0, 8))]))
    for i in range(25):
        texts.append(" ".join([f"z{i}y{j}" for j in range(40)] + passage))
    texts += ["A b C d e f", "a B c D e f", "\x0ba\x0cb\tc d\ne f ", "é É", "É é", "one", "one", "", None, " \n", "x " * 40_000, "x " * 3, "y " * 30_000 + "end"]
    return [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (4, texts[5])]


@pytest.mark.parametrize("join", [jaccard.Join(), jaccard.Join(bucket=200, block=300, batch=7, broadcast_rows=0)], ids=["usual", "split"])
def test_matches_every_pair_looked_at(spark, join):
    rows = made()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, n string, id string")
    found = collections.Counter(map(tuple, jaccard.similar_components(docs, join=join).collect()))
    assert found == least_ids(rows)


@pytest.mark.parametrize("small", [0, 20, 10**6])
def test_any_boundary_between_small_and_large_is_right(spark, small, monkeypatch):
    rows = made()
    monkeypatch.setattr(jaccard, "boundary", lambda prefixes: small)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(map(tuple, jaccard.similar_components(docs).collect())) == least_ids(rows)


@pytest.mark.parametrize("percent, small", [(50, None), (50, 10**6), (67, 0), (80, None)])
def test_any_threshold_is_right(spark, percent, small, monkeypatch):
    """At low thresholds one common shingle may be enough, which no pair of shingles would find."""
    rows = made() + [(900, "a b c d"), (901, "a b c d e"), (902, "q b c d e"), (903, "g h i j k l"), (904, "g h i j k l m n")]
    if small is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda prefixes: small)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(map(tuple, jaccard.similar_components(docs, join=jaccard.Join(percent=percent)).collect())) == least_ids(rows, percent)


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f g"), (2, "A b c d e f g"), (None, "a b c d e f g"), (7, ""), (8, None), (9, "other words that are not alike at all"), (9, "other words that are not alike at all")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, uid string")
    stay = jaccard.one_of_each(docs)
    assert stay.columns == docs.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == ["2", "7", "8", "9"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.similar_components(docs).collect() == [] and jaccard.one_of_each(docs).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (300, 200), (200, 300)]
    links += [(rng.randrange(400, 440), rng.randrange(400, 440)) for _ in range(25)]
    rng.shuffle(links)
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {n: r for n, r in root.items() if any(n in link and link[0] != link[1] for link in links)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
