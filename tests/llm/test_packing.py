import bisect
import collections
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from wardloom.llm import packing
from wardloom.llm.bytebpe import encoder
from wardloom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, length string, piece string, task string"


def best_fit_decreasing(lengths, most):
    gaps, count = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps.pop(at) - length
        else:
            gap, count = most - length, count + 1
        if gap:
            bisect.insort(gaps, gap)
    return count


def places(runs):
    """(length, rank) -> (sequence, offset)."""
    found = {}
    for r in runs:
        for i in range(r["n"]):
            key = (r["length"], r["doc"] + i)
            assert key not in found
            found[key] = (r["sequence"] + i // r["per"], r["at"] + i % r["per"] * r["length"])
    return found


@pytest.mark.parametrize("kind", ["even", "small", "one length", "large", "halves"])
def test_best_fit_places_every_document_once(spark, kind):
    rng = random.Random(6)
    most = 100
    drawn = {
        "even": [rng.randrange(1, 101) for _ in range(700)], "small": [rng.randrange(1, 6) for _ in range(3_000)], "one length": [1] * 5_000,
        "large": [rng.randrange(60, 101) for _ in range(200)], "halves": [50] * 31 + [51] * 7 + [49] * 9,
    }[kind]
    counts = collections.Counter(drawn)
    runs = packing.best_fit(spark.createDataFrame(list(counts.items()), "length long, n long"), most).collect()
    found = places(runs)
    assert set(found) == {(length, i) for length, n in counts.items() for i in range(n)}
    filled = collections.defaultdict(list)
    for (length, _), (sequence, offset) in found.items():
        filled[sequence].append((offset, length))
    for pieces in filled.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= most
    assert len(filled) <= best_fit_decreasing(drawn, most) * 1.01 + 1


def test_encoder_gives_the_ids_of_the_file():
    with open(tokenizer_path(), encoding="utf-8") as f:
        file = f.read()
    encode, plain = encoder(file), Tokenizer.from_str(file)
    rng = random.Random(7)
    parts = ["a", "the ", "é", "\n", "  ", "　", "<|endoftext|>", "'ll", "1234", "😀", "ü", "\x00", "don't", "\r\n", "!!!", "ﬁ"]
    for text in ["", " ", "x" * 5_000, *("".join(rng.choice(parts) for _ in range(30)) for _ in range(200))]:
        assert encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_sequences_give_the_documents_back(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "é"]) for _ in range(rng.randrange(0, 300))) for _ in range(80)]
    rows = [(i, t, "x", "y", "z") for i, t in enumerate([None, "", *texts, "word " * 9_000])] + [(5, texts[3], "x", "y", "z"), (None, "no id", "x", "y", "z")]
    docs = spark.createDataFrame(rows, SCHEMA)
    packed = packing.pack(docs, tokenizer_path(), most=64, carry=("doc_id", "text", "piece"))
    pieces = packing.packed_pieces(packed).collect()
    tokens = Tokenizer.from_file(tokenizer_path())
    sequences = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    filled = collections.Counter()
    by_row = collections.defaultdict(list)
    for p in pieces:
        assert np.array_equal(sequences[p.sequence_id][p.offset : p.offset + p.length], np.frombuffer(p.ids, "<u4"))
        filled[p.sequence_id] += p.length
        by_row[p.row.doc_id, p.row.text].append(p)
    assert all(filled[s] == len(ids) <= 64 for s, ids in sequences.items())
    expected = collections.Counter((i, t) for i, t, *_ in rows)
    for (i, t), found in by_row.items():
        ids = [*tokens.encode(t or "", add_special_tokens=False).ids, 0]
        found.sort(key=lambda p: p.piece)
        copies = expected.pop((i, t))
        assert len(found) == copies * -(-len(ids) // 64)
        for p in found:
            assert np.frombuffer(p.ids, "<u4").tolist() == ids[p.start : p.start + p.length] and (p.length == 64 or p.piece == 0)
    assert not expected


def test_empty_table(spark):
    packed = packing.pack(spark.createDataFrame([], SCHEMA), tokenizer_path())
    assert packing.packed_pieces(packed).collect() == [] and packing.sequences(packed).collect() == []
