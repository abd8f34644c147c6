"""Word pieces of texts, and token arrays of events. Different words are cut once, different values of events encoded once; rows look the result up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.functions.vocabulary import check_vocabulary, word_table
from wardloom.functions.words import normal, plain_words, unit_items
from wardloom.plans.hot import join_counted, join_hot, least_count
from wardloom.sources.stage import cut_lineage
from wardloom.spec import TokenIds

TOKENS = "struct<ids:array<int>,dpes:array<int>>"


def _digest(text: Column) -> Column:
    """What stands for a text where rows meet: short, however long the text is."""
    return F.unhex(F.md5(text.cast("binary")))


def encode_distinct(
    texts: DataFrame, vocab: DataFrame, items: Callable[[Column], Column], tokens: TokenIds, max_word_chars: int | None = None
) -> DataFrame:
    """(digest, ids, dpes, n) of the different texts of ``texts`` (text), each with its number of rows. ``items`` gives a text's words and numbers in
    order. Frequent words find their ids without moving."""
    channels = ["ids", "dpes"]
    digested = texts.where("text IS NOT NULL").select(_digest(F.col("text")).alias("digest"), "text")
    once = digested.groupBy("digest").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
    # read twice, for the different words and for the places they stand at
    listed = F.posexplode_outer(items(F.col("text"))).alias("pos", "item")
    placed = cut_lineage(once.select("digest", "n", listed).select("digest", "n", "pos", "item.word", *[f"item.{c}" for c in channels]))
    known = cut_lineage(word_table(placed.select("word"), check_vocabulary(vocab), tokens.unknown, max_word_chars)).withColumnRenamed("n", "times")
    known = known.withColumn("dpes", F.array_repeat(F.lit(tokens.no_place), F.size("ids")))
    # numbers need no vocabulary, so they do not travel to the words as one null key
    words = join_counted(placed.where("word IS NOT NULL").select("digest", "n", "pos", "word"), known, "word", "times").select("digest", "n", "pos", *channels)
    parts = words.unionByName(placed.where("word IS NULL").select("digest", "n", "pos", *channels))
    whole = parts.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("pos", *channels))).alias("p"), F.max("n").alias("n"))
    return whole.select("digest", *[F.flatten(F.filter(F.col("p")[c], lambda x: x.isNotNull())).alias(c) for c in channels], "n")


MOST_WORDS = 250_000  # words that are sent to every task


def _word_index(known: DataFrame, channels: Sequence[str]) -> Column:
    """The rows of ``known`` (word, channels) by the hash of the word, as one value: a list of words for each of as many slots as there are words."""
    slots = 1 << max(known.count() - 1, 0).bit_length()
    slot = F.pmod(F.xxhash64("word"), F.lit(slots))
    filled = known.groupBy(slot.alias("id")).agg(F.collect_list(F.struct("word", *channels)).alias("words"))
    every = known.sparkSession.range(slots).join(filled, "id", "left").agg(F.sort_array(F.collect_list(F.struct("id", "words"))).alias("slots"))
    return cut_lineage(every.select(F.col("slots.words").alias("slots"))).scalar()


def _found(index: Column, word: Column) -> Column:
    """The entry of ``word``, or null."""
    return F.get(F.filter(F.get(index, F.pmod(F.xxhash64(word), F.size(index)).cast("int")), lambda entry: entry["word"] == word), 0)


def _given(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often it stands there."""
    return F.get(F.transform(F.array(value), use), 0)


def name_items(
    rows: DataFrame, vocab: DataFrame, tokens: TokenIds, max_word_chars: int | None = None, most_words: int | None = None
) -> DataFrame:
    """``rows`` with ``_items`` (words and numbers in order) replaced by ``_ids`` and ``_dpes``: for short texts, whose words are few.

    Every different word is cut once. The words that occur most, at most ``most_words`` by the choice of the least count, are looked up where the row
    is, and only the other words move: with their row and place, to their pieces and back.
    """
    channels = ["ids", "dpes"]
    # read for the different words, and for the words at their places
    rows = cut_lineage(rows.withColumn("_row", F.monotonically_increasing_id()))
    words = rows.select(F.explode("_items.word").alias("word"))
    known = cut_lineage(word_table(words, check_vocabulary(vocab), tokens.unknown, max_word_chars))
    least = least_count(known, "n", MOST_WORDS if most_words is None else most_words)
    known = known.withColumn("dpes", F.array_repeat(F.lit(tokens.no_place), F.size("ids")))
    index = _word_index(known.where(F.col("n") >= least).select("word", *channels), channels)

    # a table that is read as a value may not be written inside a lambda, so it is a column, used once: the planner puts the value in its place
    rows = rows.withColumn("_index", index)

    def named(item: Column, pos: Column, words: Column) -> Column:
        word = _found(words, item["word"])
        return F.struct(pos.alias("pos"), item["word"].alias("word"), *[F.coalesce(item[c], word[c]).alias(c) for c in channels])

    def flat(parts: Column) -> list[Column]:
        return [F.flatten(parts[c]).alias(f"_{c}") for c in channels]

    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("_items", "_row", "_index")]
    found = _given(F.col("_index"), lambda words: F.transform("_items", lambda item, pos: named(item, pos, words)))
    if least == 1:
        return rows.select(*kept, found.alias("_items")).select(*kept, *flat(F.col("_items")))
    # looked up once, so written; the rows travel with their ids, not their words
    rows = cut_lineage(rows.select("_row", *kept, found.alias("_items")))
    seldom = rows.select("_row", F.filter("_items", lambda part: part["ids"].isNull()).alias("_left")).select("_row", F.inline("_left")).select("_row", "pos", "word")
    others = seldom.join(known.where(F.col("n") < least).drop("n"), "word").groupBy("_row").agg(F.collect_list(F.struct("pos", *channels)).alias("_others"))
    ready = F.transform(F.filter("_items", lambda part: part["ids"].isNotNull()), lambda part: F.struct(*[part[c].alias(c) for c in ("pos", *channels)]))
    both = rows.select("_row", *kept, ready.alias("_items")).join(others, "_row", "left")
    return both.select(*kept, *flat(F.when(F.col("_others").isNull(), F.col("_items")).otherwise(F.sort_array(F.concat("_items", "_others")))))


def _filled(ids: Column, others: Column) -> Column:
    """``ids`` with its nulls replaced by the lists ``others``, in order. Every run between two nulls is copied once."""

    def fill(at):
        first = F.slice(ids, F.lit(1), F.get(at, 0))
        after = F.transform(others, lambda part, k: F.concat(part, F.slice(ids, F.get(at, k) + 2, F.coalesce(F.get(at, k + 1), F.size(ids)) - F.get(at, k) - 1)))
        return F.flatten(F.concat(F.array(first), after))

    return _given(F.filter(F.transform(ids, lambda x, i: F.when(x.isNull(), i)), lambda i: i.isNotNull()), fill)


def word_pieces(
    texts: DataFrame,
    vocab: DataFrame,
    text: str,
    tokens: TokenIds = TokenIds(),
    lower: bool = True,
    out: str = "ids",
    max_word_chars: int | None = None,
    accents: bool = True,
    most_words: int | None = None,
) -> DataFrame:
    """Add the vocabulary ids of whole texts; ``vocab`` is (token, id). A null text has null ids.

    Every different word is cut once. The words that occur most, at most ``most_words`` by the choice of the least count, are looked up where the text
    is. Only the other words move, with their text's digest and place, to their pieces and on to the texts, which are dealt by digest once. A text that stands
    in as many rows as the least count says has no such word, so no digest that is asked for has many rows.
    """
    words, digest = plain_words(normal(F.col(text), lower, accents)), _digest(F.col(text))
    known = cut_lineage(word_table(texts.select(F.explode(words).alias("word")), check_vocabulary(vocab), tokens.unknown, max_word_chars))
    least = least_count(known, "n", MOST_WORDS if most_words is None else most_words)
    often = known.where(F.col("n") >= least).select("word", "ids")
    kept = [F.col(f"`{c}`") for c in texts.columns]
    left = F.array(F.lit(None).cast("int"))  # no id is null, so it marks the place of a word that is not looked up here
    found = _given(F.col("_index"), lambda index: F.flatten(F.transform(words, lambda word: F.coalesce(_found(index, word)["ids"], left))))
    rows = texts.withColumn("_index", _word_index(often, ["ids"])).select(*kept, found.alias(out))
    if least == 1:
        return rows
    placed = texts.select(digest.alias("_digest"), F.posexplode(words).alias("_pos", "word"))
    seldom = placed.join(F.broadcast(often.select("word")), "word", "left_anti").join(known.where(F.col("n") < least).select("word", "ids"), "word")
    # equal texts bring equal rows
    others = seldom.groupBy("_digest").agg(F.sort_array(F.collect_set(F.struct("_pos", "ids"))).alias("_others")).select("_digest", F.col("_others.ids").alias("_others"))
    # texts that ask for nothing are dealt by a key of their own, which is no digest
    key = F.when(F.exists(out, lambda x: x.isNull()), digest).otherwise(F.unhex(F.hex(F.monotonically_increasing_id())))
    both = rows.withColumn("_digest", key).join(others, "_digest", "left")
    whole = F.when(F.col("_others").isNull(), F.col(out)).otherwise(_filled(F.col(out), F.col("_others")))
    return both.select(*kept, whole.alias(out))


def encode_texts(
    texts: DataFrame,
    vocab: DataFrame,
    text: str,
    tokens: TokenIds = TokenIds(),
    lower: bool = True,
    out: str = "tokens",
    max_word_chars: int | None = None,
    accents: bool = True,
) -> DataFrame:
    """Add the tokens of unit texts: a struct of ``ids`` and ``dpes``. A null text has none."""
    found = name_items(texts.withColumn("_items", unit_items(F.col(text), tokens, lower, accents)), vocab, tokens, max_word_chars)
    both = F.struct(F.col("_ids").alias("ids"), F.col("_dpes").alias("dpes"))
    return found.withColumn(out, F.when(F.col("_ids").isNotNull(), both)).drop("_ids", "_dpes")


def _names(heads: Sequence[tuple[str, Sequence[str]]], spark: SparkSession) -> DataFrame:
    names = sorted({name for table, columns in heads for name in (table, *columns)})
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("text"))


def _heads(heads: Sequence[tuple[str, Sequence[str]]], encoded: DataFrame) -> Column:
    """Per event table its name and its column names as tokens: as many as the source has event columns, so a constant of the plan."""
    rows = _names(heads, encoded.sparkSession).withColumn("digest", _digest(F.col("text"))).join(encoded, "digest").select("text", "ids", "dpes").collect()
    known = {r.text: r for r in rows}

    def constant(name: str) -> Column:
        parts = [F.array(*[F.lit(i) for i in known[name][c]]).cast("array<int>").alias(c) for c in ("ids", "dpes")]
        return F.struct(*parts)

    tables = [
        F.struct(constant(table).alias("table"), F.array(*[constant(c) for c in columns]).cast(f"array<{TOKENS}>").alias("names"))
        for table, columns in heads
    ]
    return F.array(*tables)


def _described(units: DataFrame, dictionaries: Mapping[tuple[int, int], DataFrame]) -> DataFrame:
    """Values of described columns replaced by their texts. ``dictionaries``: (code, text) by (table_no, pos); unknown codes vanish."""
    out = units
    for numeric in (True, False):
        parts = []
        for (table_no, pos), rows in dictionaries.items():
            if (rows.schema["code"].dataType.simpleString() != "string") == numeric:
                code = F.col("code").cast("long").cast("string") if numeric else F.col("code")
                parts.append(rows.select(F.lit(table_no).alias("table_no"), F.lit(pos).alias("pos"), code.alias("code"), "text"))
        if parts:
            known = parts[0]
            for part in parts[1:]:
                known = known.unionByName(part)
            places = [(F.col("table_no") == t) & (F.col("pos") == p) for (t, p), r in dictionaries.items() if (r.schema["code"].dataType.simpleString() != "string") == numeric]
            here = places[0]
            for place in places[1:]:
                here = here | place
            code = F.col("value").try_cast("long").cast("string") if numeric else F.col("value")
            found = join_hot(out.where(here).withColumn("code", code), known, ["table_no", "pos", "code"])
            found = found.select("_event", "table_no", "pos", F.col("text").alias("value")).where("value IS NOT NULL")
            out = out.where(~here).unionByName(found)
    return out


def encode_events(
    events: DataFrame,
    heads: Sequence[tuple[str, Sequence[str]]],
    vocab: DataFrame,
    max_event_tokens: int,
    tokens: TokenIds = TokenIds(),
    lower: bool = True,
    dictionaries: Mapping[tuple[int, int], DataFrame] | None = None,
    max_word_chars: int | None = None,
    accents: bool = True,
) -> DataFrame:
    """Replace ``units`` by ``ids``, ``types`` and ``dpes``: table name, then (column, value) units while they fit.

    ``events`` has ``units`` (pos, value) from ``event_units`` and ``table_no`` into ``heads`` (table name, column names). The first unit
    that would pass the limit (two places stay free for the markers) ends the event. With ``dictionaries``, by (table_no, pos), codes are
    replaced by their texts first. Every different value is encoded once; events are written on the way, and only (event, position, value) moves
    to the values and back.
    """
    rows = cut_lineage(events.withColumn("_event", F.monotonically_increasing_id()))
    units = rows.select("_event", "table_no", F.explode("units").alias("u")).select("_event", "table_no", "u.pos", "u.value")
    units = cut_lineage(_described(units, dictionaries)) if dictionaries else units
    texts = units.select(F.col("value").alias("text")).unionByName(_names(heads, events.sparkSession))
    encoded = cut_lineage(encode_distinct(texts, vocab, lambda t: unit_items(t, tokens, lower, accents), tokens, max_word_chars))
    known = _heads(heads, encoded)
    valued = join_counted(units.withColumn("digest", _digest(F.col("value"))), encoded, "digest", "n")
    values = valued.groupBy("_event").agg(F.sort_array(F.collect_list(F.struct("pos", "ids", "dpes"))).alias("values"))
    room = max_event_tokens - 2

    def state(ids, types, dpes, full):
        return F.struct(ids.alias("ids"), types.alias("types"), dpes.alias("dpes"), F.lit(full).alias("full"))

    def repeated(type_id, part):
        return F.array_repeat(F.lit(type_id), F.size(part["ids"]))

    def grow(event, unit):
        name = F.col("_head.names")[unit["pos"]]
        fits = F.size(event["ids"]) + F.size(name["ids"]) + F.size(unit["ids"]) <= room
        longer = state(
            F.concat(event["ids"], name["ids"], unit["ids"]),
            F.concat(event["types"], repeated(tokens.column_type, name), repeated(tokens.value_type, unit)),
            F.concat(event["dpes"], name["dpes"], unit["dpes"]),
            False,
        )
        return F.when(~event["full"] & fits, longer).otherwise(state(event["ids"], event["types"], event["dpes"], True))

    carried = [c for c in events.columns if c != "units"]
    joined = rows.drop("units").join(values, "_event", "left").withColumn("_head", known[F.col("table_no")])
    table = F.col("_head.table")
    none = F.array().cast("array<struct<pos:int,ids:array<int>,dpes:array<int>>>")
    whole = F.aggregate(F.coalesce("values", none), state(table["ids"], repeated(tokens.table_type, table), table["dpes"], False), grow)
    return joined.select(*carried, whole.alias("_tokens")).select(*carried, "_tokens.ids", "_tokens.types", "_tokens.dpes")
