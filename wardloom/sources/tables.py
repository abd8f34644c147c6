"""Scans: CSV, compressed CSV and Parquet under one name, dictionaries and code systems."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.operators.codes import last_per_code, unquoted

SUFFIXES = (".parquet", ".csv", ".csv.gz")


def find_table(spark: SparkSession, root: str, name: str) -> str:
    """Path of table ``name`` under ``root``, whichever format is there."""
    for suffix in SUFFIXES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}{suffix}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return f"{root}/{name}{suffix}"
    raise FileNotFoundError(f"{name} not found under {root} as {', '.join(SUFFIXES)}")


def read_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None, partitions: int | None = None
) -> DataFrame:
    """Scan one table. CSV columns are strings unless ``schema`` types some of them; names follow the header.

    A typed CSV column is converted with a tolerant cast, so an unreadable value is null instead of an error. ``partitions`` deals the rows out anew:
    for scans that do not split (compressed CSV, single row groups) before much work per row. Files that keep as many tasks busy are read where they are.
    """
    path = find_table(spark, root, name)
    df = _scan(spark, path)
    if partitions is not None and not _spread(spark, path, partitions):
        df = df.repartition(partitions)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if wanted is None:
        return df
    types = {f.name: f.dataType for f in wanted}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def _spread(spark: SparkSession, path: str, parts: int) -> bool:
    """Whether no file of the table holds more than its share of ``parts`` parts."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    sizes = [f.getLen() for f in named.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(named) if f.isFile()]
    return sum(sizes) >= parts * max(sizes, default=0) > 0


def _scan(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


class Checked(NamedTuple):
    rows: DataFrame
    broken: DataFrame  # (line, file)


def read_checked(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None) -> Checked:
    """``read_table`` with the lines set apart that have more or fewer fields than the header, which a plain scan would cut or fill up.

    Parquet has no such lines. Each of the two results is one scan of the file.
    """
    path = find_table(spark, root, name)
    if path.endswith(".parquet"):
        return Checked(read_table(spark, root, name, schema), spark.createDataFrame([], "line string, file string"))
    names = _scan(spark, path).columns
    line = "_line"
    while line in names:
        line = f"_{line}"
    kinds = T.StructType([T.StructField(c, T.StringType()) for c in [*names, line]])
    # fields are counted only where all of them are read
    options = {"header": True, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": line, "columnPruning": False, "enforceSchema": True}
    scanned = spark.read.schema(kinds).options(**options).csv(path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    types = {f.name: f.dataType for f in wanted} if wanted else {}
    typed = [F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in names]
    # Spark reads no file for the column of broken lines alone, so the conditions look at a field as well
    read = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    broken = scanned.where(F.col(line).isNotNull() & read).select(F.col(line).alias("line"), F.col("_metadata.file_path").alias("file"))
    return Checked(scanned.where(F.col(line).isNull() & read).select(*typed), broken)


def set_aside(broken: Mapping[str, DataFrame], dest: str) -> DataFrame:
    """Write broken lines by table; returns ``table, lines``, a row for each table that has any."""
    parts = [lines.withColumn("table", F.lit(name)) for name, lines in sorted(broken.items())]
    parts[0].sparkSession.createDataFrame([], "line string, file string, table string").write.mode("append").parquet(dest)
    for part in parts:
        part.write.mode("append").parquet(dest)
    found = parts[0].sparkSession.read.schema("line string, file string, table string").parquet(dest)
    return found.groupBy("table").agg(F.count(F.lit(1)).alias("lines"))


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows with ``ord``, which grows in file order: path, block, then position in the block."""
    df = _scan(spark, path)
    position = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return df.select("*", position.alias("ord"))


def read_dictionary(spark: SparkSession, root: str, name: str, code: str, text: str) -> DataFrame:
    """(code, text), one row per code; the last row of a repeated code wins, a missing text stays null."""
    rows = in_file_order(spark, find_table(spark, root, name))
    pairs = rows.select(F.col(code).alias("code"), F.col(text).alias("text"), "ord")
    return last_per_code(pairs, "code", "text", "ord")


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """Code categories, zero-based: header names and values are wrapped in single quotes."""
    rows = in_file_order(spark, path)
    pairs = rows.select(
        unquoted(F.col("`'ICD-9-CM CODE'`")).alias("code"),
        (unquoted(F.col("`'CCS LVL 1'`")).try_cast("int") - 1).alias("category"),
        "ord",
    )
    return last_per_code(pairs, "code", "category", "ord")


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """(source, target, ord) of a code crosswalk; codes stay text, leading zeros matter."""
    return in_file_order(spark, path).select(
        F.col("icd10cm").alias("source"), F.col("icd9cm").alias("target"), "ord"
    )
