"""Diagnosis codes: crosswalk, category sets, code lists on paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.plans.hot import join_hot
from wardloom.spec import Keys


def unquoted(text: Column) -> Column:
    """Text without its one-character wrapper on both sides, trimmed."""
    return F.trim(F.substring(text, F.lit(2), F.length(text) - 2))


def last_per_code(mapping: DataFrame, code: str, value: str, order: str) -> DataFrame:
    """One row per code: the value of the last row in ``order``."""
    return mapping.groupBy(code).agg(F.max_by(value, order).alias(value))


def _prefixes(code: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(code)), lambda n: F.substring(code, F.lit(1), n))


def _back_off(unmapped: DataFrame, mapping: DataFrame) -> DataFrame:
    """For each code: its longest prefix that is itself mapped, then the most frequent value of the mapped codes
    that start with that prefix (ties: smallest value). Prefixes are equality keys, so no pair of codes is compared."""
    candidates = unmapped.where(F.length("code") > 0).withColumn("prefix", F.explode(_prefixes(F.col("code"))))
    known = mapping.select(F.col("source").alias("prefix")).distinct()
    longest = (
        candidates.join(known, "prefix", "left_semi")
        .groupBy("code")
        .agg(F.max_by("prefix", F.length("prefix")).alias("prefix"))
    )
    needed = longest.select("prefix").distinct()
    # counted before the join: a short prefix covers very many codes, but few distinct targets
    votes = (
        mapping.where((F.length("source") > 0) & F.col("target").isNotNull())
        .select(F.explode(_prefixes(F.col("source"))).alias("prefix"), "target")
        .groupBy("prefix", "target")
        .agg(F.count("*").alias("n"))
        .join(needed, "prefix", "left_semi")
    )
    first = Window.partitionBy("prefix").orderBy(F.col("n").desc(), F.col("target").asc())
    winner = votes.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select("prefix", F.col("target").alias("backed"))
    return longest.join(winner, "prefix").select("code", "backed")


def crosswalk_codes(codes: DataFrame, mapping: DataFrame, backoff: bool = False) -> DataFrame:
    """Distinct ``code`` with its ``converted`` code (null when there is none).

    ``mapping`` has (source, target, ord); for a repeated source the last row wins.
    """
    distinct = codes.select("code").where("code is not null").distinct()
    latest = last_per_code(mapping, "source", "target", "ord").withColumnRenamed("source", "code")
    exact = distinct.join(latest.withColumn("_hit", F.lit(True)), "code", "left")
    if not backoff:
        return exact.select("code", F.col("target").alias("converted"))
    backed = _back_off(exact.where("_hit is null").select("code"), mapping)
    return exact.join(backed, "code", "left").select("code", F.coalesce("target", "backed").alias("converted"))


def convert_versions(
    diagnoses: DataFrame, mapping: DataFrame, code: str, version: str, backoff: bool = False
) -> DataFrame:
    """Add ``converted``: version 9 codes stay, version 10 codes go through the crosswalk. Without back-off the rows are scanned once and meet the
    crosswalk, one row per code. Old codes get a key that no crosswalk has, a different one for each code, so they neither match nor meet in one place; missing codes
    share such a key, which is split like any other that many rows have.
    """
    is_modern = F.coalesce(F.col(version).cast("string").try_cast("int") == 10, F.lit(False))
    if backoff:
        walk = crosswalk_codes(diagnoses.where(is_modern).select(F.col(code).alias("code")), mapping, True)
    else:
        walk = last_per_code(mapping, "source", "target", "ord").toDF("code", "converted")
    walk = walk.select(F.col("code").alias("_key"), F.col("converted").alias("_walked"))
    other = F.lit("\u0000")
    key = F.coalesce(F.when(is_modern, F.col(code)).otherwise(F.concat(other, F.col(code))), other)
    keyed = diagnoses.withColumn("_modern", is_modern).withColumn("_key", key)
    joined = join_hot(keyed, walk, ["_key"], "left")
    return joined.withColumn("converted", F.when(F.col("_modern"), F.col("_walked")).otherwise(F.col(code))).select(*diagnoses.columns, "converted")


def label_code_set(
    cohort: DataFrame,
    diagnoses: DataFrame,
    categories: DataFrame,
    rare_class: int = 14,
    missing: str = "drop",
    keys: Keys = Keys(),
    out: str = "diagnosis",
) -> DataFrame:
    """Sorted class list per admission. ``diagnoses`` is (admission, code), ``categories`` is (code, category).

    The rare class is dropped and the classes above it move down by one. Stays without a class are dropped
    or get an empty list, as ``missing`` says.
    """
    if missing not in ("drop", "empty"):
        raise ValueError(f"unknown missing rule {missing!r}")
    category = F.col("category")
    classes = (
        join_hot(diagnoses.select(keys.admission, "code"), categories.select("code", "category"), ["code"])
        .where(category.isNotNull() & (category >= 0) & (category != rare_class))
        .groupBy(keys.admission)
        .agg(F.sort_array(F.collect_set(F.when(category > rare_class, category - 1).otherwise(category).cast("int"))).alias(out))
    )
    if missing == "drop":
        return cohort.join(classes, keys.admission)
    return cohort.join(classes, keys.admission, "left").withColumn(
        out, F.coalesce(out, F.array().cast("array<int>"))
    )


def explode_code_list(diagnoses: DataFrame, path: str, codes: str, order: str, trim: bool = True) -> DataFrame:
    """(path, pos, code): the first non-null code list of each path, split at commas, dots removed."""
    first = diagnoses.where(F.col(codes).isNotNull()).groupBy(path).agg(F.min_by(codes, order).alias("_codes"))
    split = first.select(F.col(path).alias("path"), F.posexplode(F.split("_codes", ",")).alias("pos", "code"))
    code = F.replace(F.col("code"), F.lit("."), F.lit(""))
    return split.withColumn("code", F.trim(code) if trim else code)


def path_categories(exploded: DataFrame, categories: DataFrame, mapping: DataFrame, backoff: bool = False) -> DataFrame:
    """(path, category, conflict) from the codes of each path; the last code that has a category wins.

    A code of the category table is used as it is; any other code goes through the crosswalk first.
    """
    known = categories.select("code", "category")
    direct = exploded.join(known, "code", "left")
    others = direct.where("category is null").select("code")
    walk = crosswalk_codes(others, mapping, backoff).join(
        known.select(F.col("code").alias("converted"), F.col("category").alias("walked")), "converted"
    )
    category = F.coalesce("category", "walked")
    return (
        direct.join(walk.select("code", "walked"), "code", "left")
        .where(category.isNotNull())
        .groupBy("path")
        .agg(F.max_by(category, "pos").alias("category"), (F.min(category) != F.max(category)).alias("conflict"))
    )
