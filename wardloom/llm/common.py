"""What several text operators share: written tables, words, null-safe texts, joins by checked size."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.sources.stage import shared_folder

SPACE = r"\x20\x09-\x0D"  # the white space that ends a word: ASCII only
OTHER_SPACE = "\t\n\x0b\x0c\r"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filled(text: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text that is not null. Spaces are made alike first: splitting at one plain character needs no regex."""
    return F.array_remove(F.split(F.translate(text, OTHER_SPACE, " " * len(OTHER_SPACE)), " "), "")


def joined_by_size(big: DataFrame, small: DataFrame, on: Sequence[str], how: str, most_rows: int = 1_000_000) -> DataFrame:
    """Join with ``small`` sent to every task if it has at most ``most_rows`` (narrow) rows, else by shuffling both sides.

    ``small`` is a written table, so counting it reads file footers only.
    """
    return big.join(F.broadcast(small) if small.count() <= most_rows else small, list(on), how)


def without(columns: Sequence[str], taken: Sequence[str]) -> list[str]:
    """``taken`` with underscores put before whatever is among ``columns``: helper columns never clash with the caller's."""
    found = []
    for name in taken:
        while name in columns or name in found:
            name = f"_{name}"
        found.append(name)
    return found


def sent_to_tasks(module: str) -> None:
    """Functions of ``module`` travel to the executors' Python with what they use, so that the package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
