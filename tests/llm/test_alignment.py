"""Alignment of two tokenizers against direct loops over byte ranges."""

import hashlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wardloom.llm import alignment, bytebpe, queries
from wardloom.llm.common import written

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox, they said, isn't here.", None, "", " ", "\n\n  two\tlines \n", "naïve café 漢字かな 🙂🙂", "x" * 5000, "the the the THE",
    "<|endoftext|> and </s> <s> <unk> <0x41> are text", "a ▁ mark of its own", "The quick brown fox, they said, isn't here.", "\x00\x01 control", "word " * 3000, "العربية ✓ é",
]


@cache
def _tools():
    whole = Tokenizer.from_file(A)
    whole.encode_special_tokens = True
    return alignment.piece_bytes(open(B, "rb").read()), whole, sentencepiece.SentencePieceProcessor(model_file=B), bytebpe._byte_letters()


def _tokens(text):
    tables, whole, pieces, back = _tools()
    a = whole.encode(" " + text, add_special_tokens=False)
    a_bytes = [bytes(back[c] for c in t) for t in a.tokens]
    b = pieces.encode(text)
    b_bytes = [tables[i] for i in b]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return [], []
    ranges = []
    for ids, parts in ((a.ids, a_bytes), (b, b_bytes)):
        at, side = 0, []
        for i, part in zip(ids, parts):
            side.append((i, at, at + len(part)))
            at += len(part)
        ranges.append(side)
    return ranges


def _brute(texts):
    rows, links = [], []
    for text in texts:
        a, b = _tokens(text) if text else ([], [])
        pairs = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else _sweep(a, b)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, start = [], 0
        for end in ends:
            ids = [",".join(str(x[0]) for x in side if start <= x[1] < end) for side in (a, b)] if len(a) < 400 else None
            groups.append("|".join(ids) if ids else "")
            start = end
        rows.append((len(a), len(b), len(groups), len(pairs), ";".join(groups) if len(a) < 400 else None))
        links.append(pairs)
    docs = Counter(p for pairs in links for p in set(pairs))
    highest = {}
    for (a, _), n in docs.items():
        highest[a] = max(n, highest.get(a, 0))
    return [(*row, sum(docs[p] == highest[p[0]] for p in pairs), sum(docs[p] for p in pairs)) for row, pairs in zip(rows, links)]


def _sweep(a, b):
    i = j = 0
    found = []
    while i < len(a) and j < len(b):
        found.append((a[i][0], b[j][0]))
        x, y = a[i][2], b[j][2]
        i, j = i + (x <= y), j + (y <= x)
    return found


def _found(spark, texts, most_pairs=500_000, batch_chars=1_000_000):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, groups string, key string")
    kept = written(alignment.align(docs, A, B, batch_chars=batch_chars), "aligned")
    rows = alignment.with_link_counts(kept, alignment.pair_counts(kept, 32000), most_pairs).orderBy("row.doc_id").collect()
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best, r.count_sum) for r in rows]


@pytest.mark.parametrize("most_pairs, batch_chars", [(500_000, 1_000_000), (20, 50), (0, 1)])
def test_equals_direct_loops(spark, most_pairs, batch_chars):
    found, wanted = _found(spark, TEXTS, most_pairs, batch_chars), _brute(TEXTS)
    assert len(found) == len(TEXTS)
    for text, a, b in zip(TEXTS, found, wanted):
        assert [x for x, y in zip(a, b) if y is not None] == [y for y in b if y is not None], (text or "")[:40]
    assert found[9] == (0, 0, 0, 0, "", 0, 0)  # a space mark in the text is not given back
    assert found[8][0] > 0 and found[0] == found[10]


def test_random_batches_have_each_link_once():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = [[], []]
        for _ in range(int(rng.integers(1, 6))):
            total = int(rng.integers(0, 30))
            for side in sizes:
                cuts = np.sort(rng.choice(np.arange(1, max(total, 1)), size=int(rng.integers(0, max(total, 1))), replace=False)) if total else []
                side.append(np.diff([0, *cuts, total]).astype(np.int64) if total else np.zeros(0, dtype=np.int64))
        found = alignment.align_batch(*sizes)
        wanted, base = [], [0, 0]
        for a, b in zip(*sizes):
            ea, eb = np.cumsum(a), np.cumsum(b)
            wanted += [(base[0] + i, base[1] + j) for i in range(len(a)) for j in range(len(b)) if ea[i] - a[i] < eb[j] and eb[j] - b[j] < ea[i]]
            base = [base[0] + len(a), base[1] + len(b)]
        assert sorted(zip(found.link_a.tolist(), found.link_b.tolist())) == sorted(wanted)


def test_query_on_the_given_table(spark, small):
    rows = {r.doc_id: r for r in queries.op11_token_alignment(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    assert len(rows) == len(docs)
    for d, wanted in zip(docs, _brute([d.text for d in docs])):
        r = rows[d.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == (*wanted[:4], *wanted[5:])
        if wanted[4] is not None:
            assert r.groups_sha256 == (hashlib.sha256(wanted[4].encode()).hexdigest() if r.n_a else "")


def test_empty_table(spark):
    assert _found(spark, []) == []
