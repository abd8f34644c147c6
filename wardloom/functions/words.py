"""Texts as words and tokens, the way a word-piece vocabulary expects them."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardloom.functions.numbers import NUMBER_OR_DOTS, number_places, round_decimals
from wardloom.spec import TokenIds

# Characters that are words of their own, white space, and characters that are removed.
IDEOGRAPHS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{2A700}-\x{2B73F}"
    r"\x{2B740}-\x{2B81F}\x{2B820}-\x{2CEAF}\x{F900}-\x{FAFF}\x{2F800}-\x{2FA1F}"
)
SINGLE = rf"\p{{Punct}}\p{{P}}{IDEOGRAPHS}"
SPACE = r"\s\p{Z}"
REMOVED = r"[\p{Cc}\p{Cf}\x{FFFD}&&[^\t\n\r]]"

# runs of plain letters and digits are taken in one step, they are most of any text
WORD = rf"(?:[0-9a-zA-Z]++|[^{SINGLE}{SPACE}])++|[{SINGLE}]"
SEGMENT = rf"{NUMBER_OR_DOTS}|[^0-9.]+"


@cache
def _accented() -> tuple[str, str]:
    """Letters that are a letter and marks in one character, and the letters alone: from the character data, not a list."""
    pairs = []
    for code in range(0xA0, 0x10000):
        parts = unicodedata.normalize("NFD", chr(code))
        base = [c for c in parts if unicodedata.category(c) != "Mn"]
        if len(parts) > 1 and len(base) == 1:
            pairs.append((chr(code), base[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents(text: Column) -> Column:
    """``text`` with accented letters as plain ones, however the accent is written."""
    return F.regexp_replace(F.translate(text, *_accented()), r"\p{Mn}+", "")


def normal(text: Column, lower: bool = True, accents: bool = True) -> Column:
    """The text as words are made of it: in lower case and without accents, if so asked."""
    cased = F.lower(text) if lower else text
    return cased if accents else fold_accents(cased)


def plain_words(text: Column) -> Column:
    """Words of ``text``; punctuation marks and ideographs stand alone."""
    return F.regexp_extract_all(F.regexp_replace(text, REMOVED, ""), F.lit(WORD), F.lit(0))


ITEM = "struct<word:string,ids:array<int>,dpes:array<int>>"


def _word_item(word: Column) -> Column:
    none = F.lit(None).cast("array<int>")
    return F.struct(word.alias("word"), none.alias("ids"), none.alias("dpes"))


def unit_items(text: Column, tokens: TokenIds, lower: bool = True, accents: bool = True) -> Column:
    """A unit text as items: decimals are rounded, then every number or run of dots is its digits and dots as tokens with their place
    codes, and everything else is words, for the vocabulary to name."""

    def digit_or_dot(char):
        digit = F.ascii(char) + (tokens.zero - ord("0"))
        # where the vocabulary lists characters in their usual order, one step serves the dot as well
        return digit if tokens.zero - tokens.dot == ord("0") - ord(".") else F.when(char == ".", tokens.dot).otherwise(digit)

    def number(segment):
        ids = F.transform(F.split(segment, ""), digit_or_dot)
        return F.array(F.struct(F.lit(None).cast("string").alias("word"), ids.alias("ids"), number_places(segment).alias("dpes")))

    def is_number(segment):
        return (segment >= ".") & (segment < ":") & ~F.startswith(segment, F.lit("/"))

    segments = F.regexp_extract_all(round_decimals(normal(text, lower, accents)), F.lit(SEGMENT), F.lit(0))
    kind = f"array<{ITEM}>"
    return F.flatten(
        F.transform(segments, lambda s: F.when(is_number(s), number(s).cast(kind)).otherwise(F.transform(plain_words(s), _word_item).cast(kind)))
    )
