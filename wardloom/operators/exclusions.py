"""Treatments that exclude later measurements."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.functions.times import instant
from wardloom.sources.rules import typed
from wardloom.spec import ExclusionRule, Keys

FIRST = "first_excl"


def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def first_exclusion(
    tables: Mapping[str, DataFrame], rules: Iterable[ExclusionRule], key: str, unit: str = "abs", stay: str | None = None
) -> DataFrame:
    """Earliest exclusion per key over all rules: (key, first_excl).

    Rules on the same table share one scan; the minimum is pre-aggregated in every task.
    """
    by_table = groupby(sorted(rules, key=lambda r: (r.table, r.time)), key=lambda r: (r.table, r.time))
    parts = []
    for (table, time), group in by_table:
        group = list(group)
        types = {name.lower(): kind for name, kind in tables[table].dtypes}
        predicates = [F.expr(typed(r.predicate, types)) for r in group]
        # the items are tested at the scan; only the few rows left meet the stays of a restricted rule
        hits = tables[table].where(_any(predicates))
        tests = []
        for n, rule in enumerate(group):
            test = predicates[n]
            if rule.only_stays:
                name, where = rule.only_stays
                allowed = tables[name].where(where).select(stay).distinct().withColumn(f"_allowed_{n}", F.lit(True))
                hits = hits.join(allowed, stay, "left")
                test = test & F.col(f"_allowed_{n}")
            tests.append(test)
        at = instant(hits, time) if unit == "abs" else F.col(time).try_cast("int")
        parts.append(hits.where(_any(tests)).select(key, at.alias(FIRST)))
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(F.min(FIRST).alias(FIRST))


def before_first_exclusion(df: DataFrame, exclusions: DataFrame, key: str, time: str) -> DataFrame:
    """Rows strictly before the first exclusion of their key; keys without one stay whole."""
    joined = df.join(exclusions.select(key, FIRST), key, "left")
    return joined.where(F.col(FIRST).isNull() | (F.col(FIRST) > F.col(time))).drop(FIRST).select(df.columns)


def multi_stay_excluded(stays: DataFrame, excluded: DataFrame, keys: Keys = Keys(), distinct: bool = False) -> DataFrame:
    """Patients with more than one stay row (or distinct admission) of whom some stay is in ``excluded``."""
    count = F.count_distinct(F.col(keys.admission)) if distinct else F.count(F.col(keys.admission))
    several = stays.groupBy(keys.patient).agg(count.alias("_n")).where("_n > 1").select(keys.patient)
    touched = stays.select(keys.patient, keys.stay).join(excluded.select(keys.stay).distinct(), keys.stay, "left_semi")
    return several.join(touched.select(keys.patient), keys.patient, "left_semi")


def drop_multi_stay_excluded(
    df: DataFrame, stays: DataFrame, excluded: DataFrame, keys: Keys = Keys(), distinct: bool = False
) -> DataFrame:
    """Rows of patients who are not in ``multi_stay_excluded``; an anti join, nothing reaches the driver."""
    return df.join(multi_stay_excluded(stays, excluded, keys, distinct), keys.patient, "left_anti")
