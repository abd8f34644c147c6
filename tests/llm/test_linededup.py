import collections
import random

from pyspark.sql import functions as F

from wardloom.llm import linededup


def deleted(texts, min_words):
    """Lines of each text that lie in a run of enough words that occurs before, by looking at every run."""
    earliest, gone = {}, []
    for number, text in enumerate(texts):
        lines = (text or "").split("\n")
        mine = set()
        for i in range(len(lines)):
            words = 0
            for j in range(i, len(lines)):
                words += len(lines[j].split())
                if words >= min_words:
                    run = tuple(lines[i : j + 1])
                    if earliest.setdefault(run, (number, i)) < (number, i):
                        mine |= set(range(i, j + 1))
        gone.append(mine)
    return gone


def test_matches_every_run_looked_at(spark):
    rng = random.Random(3)
    lines = ["a", "b b", "", "c c c", "d d d d", " ", "e"]
    for min_words in (1, 4, 9):
        texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 25))) for _ in range(60)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        found = {r.row.doc_id: r for r in linededup.dedup_lines(docs, runs=linededup.Runs(min_words)).collect()}
        expected = deleted(texts, min_words)
        for i, text in enumerate(texts):
            got = {p for c in found[i].copies for p in range(c.first, c.last + 1)}
            assert got == expected[i], (min_words, i)
            assert found[i].text == "\n".join(x for p, x in enumerate(text.split("\n")) if p not in got)


def test_odd_rows(spark):
    long = "\n".join(f"line {i} has its own words and some more of them" for i in range(3_000))
    rows = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "one two three"), (4, "x\n" + long), (5, long), (6, "\n\n\n"), (7, "\n\n\n")]
    docs = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], "doc_id long, text string, uid string, row string, copies string")
    found = linededup.dedup_lines(docs, runs=linededup.Runs(3)).collect()
    assert len(found) == len(rows) and {(r.row.uid, r.row.row, r.row.copies) for r in found} == {("a", "b", "c")}
    by = collections.defaultdict(list)
    for r in found:
        by[r.row.doc_id].append(r)
    assert by[1][0].text is None and by[2][0].text == "" and not by[2][0].emptied
    assert sorted((r.text, r.emptied) for r in by[3]) == [("", True), ("one two three", False)]  # the first of the two stays
    assert by[None][0].emptied  # null ids come last
    assert by[4][0].text == "x\n" + long and by[5][0].text == "" and [(c.first, c.last) for c in by[5][0].copies] == [(0, 2_999)]
    assert by[6][0].text == by[7][0].text == "\n\n\n"


def test_empty_table(spark):
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ranks_are_the_order_of_suffixes(spark):
    rng = random.Random(4)
    rows = []
    for uid in range(30):
        size = rng.randrange(1, 20)
        rows += [(uid, uid, 0, p, rng.choice([5, 6, 6, 7]), rng.choice([0, 0, 1]), 1, p + 1) for p in range(size)]
    lines = spark.createDataFrame(rows, "uid long, doc_id long, seg long, pos int, h long, twin long, w int, ends long")
    at = collections.defaultdict(dict)
    for uid, _, _, p, h, twin, _, _ in rows:
        at[uid][p] = (h, twin)
    found = collections.defaultdict(dict)
    for r in linededup.suffix_ranks(lines, 4).collect():
        found[r.k][r.uid, r.pos] = r.rank
    for k in range(4):
        prefixes = {(u, p): tuple(at[u][q] for q in range(p, p + (1 << k))) for u in at for p in at[u] if p + (1 << k) - 1 in at[u]}
        counts = collections.Counter(prefixes.values())
        expected = {place: prefix for place, prefix in prefixes.items() if counts[prefix] > 1}
        assert found[k].keys() == expected.keys()
        order = {prefix: i for i, prefix in enumerate(sorted(set(expected.values())))}
        ranks = {rank: i for i, rank in enumerate(sorted(set(found[k].values())))}
        assert all(ranks[found[k][place]] == order[prefix] for place, prefix in expected.items())


def test_different_lines_of_one_hash_stay_apart(spark):
    rng = random.Random(5)
    lines = ["a b", "b a", "a a", "b b", "  ", "   ", "c\tc", "c c"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = deleted(texts, 4)
    for hashed in (F.char_length, lambda line: F.lit(1)):
        found = {r.row.doc_id: r for r in linededup.dedup_lines(docs, runs=linededup.Runs(4, hashed)).collect()}
        assert [{p for c in found[i].copies for p in range(c.first, c.last + 1)} for i in range(len(texts))] == expected


def test_lines_without_words_are_not_looked_up(spark):
    docs = spark.createDataFrame([(i, "\n\nsome words here\n\n") for i in range(4)], "doc_id long, text string")
    lines = linededup.written(linededup.line_table(docs, "doc_id", "doc_id", "text"), "lines")
    kept = linededup.repeated_lines(lines)
    assert kept.count() == 20 and kept.where("w = 0").count() == 16 and kept.where("twin <> 0").isEmpty()
