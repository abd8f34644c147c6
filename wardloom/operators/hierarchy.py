"""Majority vote up a path hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardloom.sources.stage import cut_lineage

SEPARATOR = "|"


def _parts(path: Column) -> Column:
    return F.split(path, r"\|", -1)


def _head(path: Column, depth) -> Column:
    return F.substring_index(path, SEPARATOR, depth)


def _depth(path: Column) -> Column:
    return F.size(_parts(path))


def _winner(rows: DataFrame) -> DataFrame:
    """Best tag per node: own tag before votes, then most votes, then the tag whose first path comes first."""
    rank = F.struct((-F.col("votes")).alias("v"), F.col("first"))
    return rows.groupBy("node").agg(F.min_by("tag", rank).alias("tag"), F.min("first").alias("first"))


def vote_nodes(labelled: DataFrame, max_depth: int) -> DataFrame:
    """(node, tag) for every path prefix of two or more segments, deepest level first.

    A labelled path keeps its tag; any other node takes the most common tag of its direct children. Each level is one
    aggregation that counts votes per (parent, tag) inside the tasks before the shuffle, so a parent with very many
    children costs no more than one with few; work grows with the depth, as every level is written.
    """
    own = labelled.select(F.col("path").alias("node"), "tag", _depth(F.col("path")).alias("depth"), F.col("path").alias("first"))
    level, nodes = None, None
    for depth in range(max_depth, 1, -1):
        here = own.where(F.col("depth") == depth).select("node", "tag", F.lit(2**62).alias("votes"), "first")
        if level is not None:
            votes = (
                level.groupBy(_head(F.col("node"), depth).alias("node"), "tag")
                .agg(F.count("*").alias("votes"), F.min("first").alias("first"))
                .select("node", "tag", "votes", "first")
            )
            here = here.unionByName(votes)
        # written, so that neither the next level nor the union of all plans it again
        level = cut_lineage(_winner(here))
        found = level.select("node", "tag")
        nodes = found if nodes is None else nodes.unionByName(found)
    return nodes


def path_depth(paths: DataFrame) -> int:
    """Longest path in segments; one number reaches the driver."""
    return paths.agg(F.coalesce(F.max(_depth(F.col("path"))), F.lit(0))).first()[0]


def hierarchy_vote(labelled: DataFrame, unlabelled: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(path, tag) for distinct unlabelled paths: the tag of the longest proper prefix, two segments or more, that is a
    node; null when there is none. ``labelled`` is (path, tag), one row per path."""
    depth = path_depth(labelled) if max_depth is None else max_depth
    paths = unlabelled.select("path").distinct().join(labelled.select("path"), "path", "left_anti")
    if depth < 2:
        return paths.withColumn("tag", F.lit(None).cast(labelled.schema["tag"].dataType))
    nodes = vote_nodes(labelled, depth)
    size = _depth(F.col("path"))
    prefixes = (
        paths.where(size > 2)
        .select("path", F.explode(F.sequence(F.lit(2), F.least(size - 1, F.lit(depth)))).alias("segments"))
        .withColumn("node", F.array_join(F.slice(_parts(F.col("path")), F.lit(1), F.col("segments")), SEPARATOR))
    )
    best = prefixes.join(nodes, "node").groupBy("path").agg(F.max_by("tag", "segments").alias("tag"))
    return paths.join(best, "path", "left")
