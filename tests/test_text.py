"""Text expressions against direct loops."""

import random
import re
import unicodedata
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from wardloom.functions.numbers import digit_places, round_decimals, space_digits
from wardloom.functions.vocabulary import check_vocabulary
from wardloom.operators import tokens
from wardloom.operators.tokens import encode_events, encode_texts, word_pieces
from wardloom.operators.units import event_units
from wardloom.spec import TokenIds

TOKENS = ["dose", "do", "d", "##o", "##s", "##se", "##ing", "mg", "m", "##g", "un", "##aff", "##able", "a", "e", "value", "##a", "(", "lab", "x", "##x"]
IDS = {t: 200 + i for i, t in enumerate(TOKENS)}


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame(list(IDS.items()), "token string, id int")


def run(spark, texts, build):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.x for r in df.select("i", build(F.col("t")).alias("x")).orderBy("i").collect()]


def half_up(number: str) -> str:
    x = Decimal(number).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    return re.sub(r"([.]\d+?)0+$", r"\1", f"{x:f}")


def rounded(text: str) -> str:
    return re.sub(r"\d*\.\d+", lambda m: half_up("0" + m.group(0)), text)


def greedy(word: str, unknown: int = 100) -> list[int]:
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            token = ("##" if at else "") + word[at:end]
            if token in IDS:
                out.append(IDS[token])
                at = end
                break
        else:
            return [unknown]
    return out


def places(number: str) -> list[int]:
    if number[0] == ".":
        return [0] * len(number)
    d = number.index(".") if "." in number else len(number)
    return [5 + d - p for p in range(len(number))]


def tokens_of(text: str) -> list[tuple[int, int]]:
    out = []
    for part in re.findall(r"[0-9]+(?:[.][0-9]*)?|[.]+|[^0-9.]+", rounded(text.lower())):
        if part[0] in "0123456789.":
            out += [(119 if c == "." else 121 + int(c), p) for c, p in zip(part, places(part))]
        else:
            for word in re.findall(r"[a-zé]+|[^\sa-zé]", part):
                out += [(i, 0) for i in greedy(word)]
    return out


def some_texts(n=400):
    rng = random.Random(5)
    parts = ["dose", "mg", "unaffable", "a", "é", "/", "(", ")", ":", ";", " ", "  ", "1", "12", "12.34", ".5", "1.2.3", "12.", "...", "0.00004", "007.5", "1.00005", "99.99995", "xx", "doseing"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 7))) for _ in range(n)]


def test_round_decimals(spark):
    fixed = ["1.2.3", ".5", "12.", "...", "1.00", "-0.00004", "0.00001", "123456789012345678.5", "a1.23456b", "1.23455", "no number", ""]
    assert run(spark, fixed[:4], round_decimals) == ["1.20.3", "0.5", "12.", "..."]
    texts = fixed + some_texts()
    assert run(spark, texts, round_decimals) == [rounded(t) for t in texts]


def test_a_number_too_long_for_the_decimal_type_stays(spark):
    text = "9" * 40 + ".123456"
    assert run(spark, [text], round_decimals) == [text]


def test_space_digits(spark):
    assert run(spark, ["a1.5b"], space_digits) == ["a 1  .  5 b"]


def test_digit_places(spark):
    texts = ["120", "12.34", "...", "a 5 b 10.0 .", "", "12."]
    expected = [[8, 7, 6], [7, 6, 5, 4, 3], [0, 0, 0], [6, 7, 6, 5, 4, 0], [], [7, 6, 5]]
    assert run(spark, texts, digit_places) == expected


def test_unit_tokens_match_a_direct_loop(spark, vocab):
    texts = some_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:5]])], "i int, t string")
    got = {r.i: r.tokens for r in encode_texts(df, vocab, "t").collect()}
    assert [list(zip(got[i].ids, got[i].dpes)) for i in range(len(got))] == [tokens_of(t) for t in [*texts, *texts[:5]]]


def test_null_texts_have_no_tokens_and_empty_ones_none(spark, vocab):
    df = spark.createDataFrame([(0, None), (1, ""), (2, " ")], "i int, t string")
    assert [r.ids for r in word_pieces(df, vocab, "t").orderBy("i").collect()] == [None, [], []]
    assert [r.tokens and tuple(r.tokens) for r in encode_texts(df, vocab, "t").orderBy("i").collect()] == [None, ([], []), ([], [])]


@pytest.mark.parametrize("most", [0, 6, 250_000])
def test_words_that_are_not_sent_to_every_task_are_found_too(spark, vocab, monkeypatch, most):
    monkeypatch.setattr(tokens, "MOST_WORDS", most)
    texts = [*some_texts(), "dose 1.5 mg dose", "unaffable dose mgmg 0.25 x(x)", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts, None])], "i int, t string")
    got = {r.i: r.tokens for r in encode_texts(df, vocab, "t").collect()}
    assert [list(zip(got[i].ids, got[i].dpes)) for i in range(2 * len(texts))] == [tokens_of(t) for t in [*texts, *texts]]
    assert got[2 * len(texts)] is None


def test_unit_texts_are_not_taken_apart_and_regrouped(spark, vocab):
    """The words of a text are looked up where it is: its last plan has no exchange, and holds the words once, as a value."""
    df = spark.createDataFrame([(i, f"dose {i}.5 mg") for i in range(50)], "i int, t string")
    text = encode_texts(df, vocab, "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "_index" not in text.split("Subqueries")[0]


def _some_long_texts():
    rng = random.Random(3)
    words = ["".join(rng.choices("dosemgaxun", k=rng.randint(1, 9))) for _ in range(80)] + ["dose", "mg", "unaffable", "("]
    texts = [" ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n)) for n in (0, 1, 2, 40, 300, 1000)]
    return [*texts, texts[4], texts[4], "qqq", "qqq qqq dose", "dose qqq", "dose dose", " \n\u00a0", ""]


@pytest.mark.parametrize("most", [0, 6, 40, 250_000])
def test_words_of_long_texts_that_are_not_sent_to_every_task_are_found_too(spark, vocab, most):
    texts = _some_long_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    rows = word_pieces(df, vocab, "t", most_words=most).collect()
    assert sorted(r.i for r in rows) == list(range(len(texts) + 1)) and rows[0].__fields__ == ["i", "t", "ids"]
    got = {r.i: r.ids for r in rows}
    assert [got[i] for i in range(len(texts))] == [[x for w in re.findall(r"\(|[^(\s]+", t) for x in greedy(w)] for t in texts]
    assert got[len(texts)] is None


def test_long_texts_are_not_written_or_dealt_by_word(spark, vocab, monkeypatch):
    """Tables written on the way hold words once and texts once, not a row for each word of each text."""
    from wardloom.functions import vocabulary

    written, write = [], tokens.cut_lineage

    def counted(df):
        out = write(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(tokens, "cut_lineage", counted)
    monkeypatch.setattr(vocabulary, "cut_lineage", counted)
    df = spark.range(60).select("id", F.concat_ws(" ", *[F.concat(F.lit("w"), (F.col("id") * 7 + k) % 97) for k in range(300)]).alias("t"))
    assert word_pieces(df, vocab, "t").where("size(ids) = 300").count() == 60
    assert max(written) < 1000


def test_word_pieces_match_a_direct_loop(spark, vocab):
    rng = random.Random(7)
    words = ["".join(rng.choices("dosemgaxun", k=rng.randint(1, 9))) for _ in range(600)] + ["x" * 100, "x" * 101, "unaffable"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, t string")
    got = {r.i: r.ids for r in word_pieces(df, vocab, "t").collect()}
    assert [got[i] for i in range(len(words))] == [greedy(w) for w in words]


def test_case_is_kept_on_request(spark, vocab):
    df = spark.createDataFrame([("Dose dose",)], "t string")
    assert word_pieces(df, vocab, "t", lower=False).first().ids == [100, IDS["dose"]]


def test_words_and_vocabularies_have_no_limit(spark, vocab):
    df = spark.createDataFrame([("x" * 150,), ("dose" * 200,)], "t string")
    found = {r.t: r.ids for r in word_pieces(df, vocab, "t").collect()}
    assert found["x" * 150] == [IDS["x"]] + [IDS["##x"]] * 149 and found["dose" * 200] == greedy("dose" * 200)
    assert {tuple(r.ids) for r in word_pieces(df, vocab, "t", max_word_chars=100).collect()} == {(100,)}
    large = spark.range(100_000).selectExpr("concat('w', id) as token", "cast(id as int) as id")
    assert word_pieces(spark.createDataFrame([("w99999 w0",)], "t string"), large, "t").first().ids == [99_999, 0]


def test_a_vocabulary_has_every_token_once(spark):
    for rows in ([("a", 1), ("a", 2)], [("a", 1), (None, 2)], [("a", None)]):
        with pytest.raises(ValueError):
            check_vocabulary(spark.createDataFrame(rows, "token string, id int"))


COLUMNS = ["a", "value", "x"]


def encoded(row, limit):
    """Table name, then units until the first one that does not fit."""
    out = [(i, 1, p) for i, p in tokens_of("lab")]
    for name in COLUMNS:
        if row[name] is None:
            continue
        pair = [(i, 2, p) for i, p in tokens_of(name)] + [(i, 3, p) for i, p in tokens_of(row[name])]
        if len(out) + len(pair) + 2 > limit:
            break
        out += pair
    return out


@pytest.mark.parametrize("limit", [4, 9, 14, 30])
def test_encode_events_match_a_direct_loop(spark, vocab, limit):
    rng = random.Random(limit)
    rows = []
    for i in range(200):
        values = [rng.choice([None, "12.5", "dose mg", "unaffable (x", "3", "", "dose 1.23456 mg"]) for _ in COLUMNS]
        rows.append((i, 0, *values))
    df = spark.createDataFrame(rows, "i int, table_no int, a string, value string, x string")
    out = encode_events(event_units(df, COLUMNS).select("i", "table_no", "units"), [("lab", COLUMNS)], vocab, limit)
    got = {r.i: list(zip(r.ids, r.types, r.dpes)) for r in out.collect()}
    assert len(got) == len(rows)
    for row in rows:
        expected = encoded(dict(zip(COLUMNS, row[2:])), limit)
        assert got[row[0]] == expected
        assert len(expected) + 2 <= limit


def test_event_units_skip_nulls_in_column_order(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "b int, a string, c double")
    units = event_units(df, ["c", "a", "b"]).first().units
    assert [(u.pos, u.name, u.value) for u in units] == [(0, "c", "2.5"), (2, "b", "1")]


def test_accents_are_folded_on_request(spark, vocab):
    from wardloom.functions.words import fold_accents

    texts = ["Crème brûlée", "e\u0301a\u0308", "ñandú Ångström", "ǘ ệ", "日本 が", "Ωμέγα й", "", "plain"]
    plain = [unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")) for t in texts]
    assert run(spark, texts, fold_accents) == plain
    df = spark.createDataFrame([("dosé",)], "t string")
    assert word_pieces(df, vocab, "t", accents=False).first().ids == [IDS["dose"]]
    assert word_pieces(df, vocab, "t").first().ids == greedy("dosé")
