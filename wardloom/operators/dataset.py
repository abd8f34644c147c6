"""Split, write and read the finished data set."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardloom.functions.arrays import many_hot, one_hot, pad_right
from wardloom.plans.numbering import running_total, shuffled_position
from wardloom.sources.stage import cut_lineage, exists
from wardloom.spec import Keys

TIMES = ("intime", "outtime_min")
MANIFEST = "manifest"
RECORDS = 20_000  # of a file, and of a task that joins and sorts them
EMPTY = "\u0001"  # what a quoted empty text is read as, before it is told apart from null


def split_patients(cohort: DataFrame, seeds: Sequence[int], valid_percent: float, keys: Keys = Keys()) -> DataFrame:
    """Add ``split_<seed>``: test, valid or train, patient by patient.

    Patients are put in a random but reproducible order; the running number of stays decides. All seeds share one pass.
    """
    patients = cohort.groupBy(keys.patient).agg(F.count("*").alias("_stays"))
    drawn = patients.withColumn("_seed", F.explode(F.array(*[F.lit(s) for s in seeds]))).withColumn(
        "_position", shuffled_position(F.col(keys.patient), F.col("_seed"))
    )
    placed = running_total(drawn, "_position", "_stays", within=["_seed"])
    first = F.floor(F.col("total") * F.lit(valid_percent))
    second = F.floor(F.col("total") * F.lit(2) * F.lit(valid_percent))
    name = F.when(F.col("running") < first, "test").when(F.col("running") < second, "valid").otherwise("train")
    wide = placed.groupBy(keys.patient).agg(
        *[F.max(F.when(F.col("_seed") == s, name)).alias(f"split_{s}") for s in seeds]
    )
    return cohort.join(wide, keys.patient, "left")


def keep_active(cohort: DataFrame, packed: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Cohort rows that have a packed record."""
    return cohort.join(packed.select(keys.stay), keys.stay, "left_semi")


def skipped_stays(cohort: DataFrame, packed: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """One row: stays in the cohort, with a packed record, and skipped for want of events."""
    flagged = cohort.select(keys.stay).join(
        packed.select(keys.stay).distinct().withColumn("_packed", F.lit(1)), keys.stay, "left"
    )
    return flagged.agg(
        F.count("*").alias("stays"), F.count("_packed").alias("active"), (F.count("*") - F.count("_packed")).alias("skipped")
    )


def skipped_counts(spark: SparkSession, stays: int, active: int) -> DataFrame:
    """The row of ``skipped_stays`` from what is known already."""
    return spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in (("stays", stays), ("active", active), ("skipped", stays - active))])


def write_dataset(
    packed: DataFrame,
    cohort: DataFrame,
    dest: str,
    dictionaries: Mapping[str, DataFrame] | None = None,
    split: str | None = None,
    keys: Keys = Keys(),
) -> None:
    """Packed stays with their labels as Parquet, the labelled cohort as CSV, class dictionaries as TSV.

    Everything goes to a new version's folder; a row in the manifest, appended last, makes it the one that readers open. A run that breaks off before
    leaves the version before untouched and in use. Without ``split`` the Parquet is laid out by all split columns, so that file statistics let a reader of
    any seed's split skip the rest; with it, it is partitioned by that column. The cohort is written once on the way and counted, so that records meet
    their labels in tasks of about ``RECORDS``, however well their padding shrinks in a shuffle. ``packed`` is read once.
    """
    spark = packed.sparkSession
    cohort = cut_lineage(cohort)
    parts = max(1, -(-cohort.count() // RECORDS))
    version = uuid.uuid4().hex
    home = f"{dest}/version={version}"
    labels = cohort.drop(*TIMES)
    times = [f.name for f in labels.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    records = packed.repartition(parts, keys.stay).join(labels.drop(*times).repartition(parts, keys.stay), keys.stay)
    splits = sorted(c for c in records.columns if c.startswith("split_"))
    if split is None and splits:  # a split may own most rows, so ranges go on within it
        # in some ranges at least for each seed, or a small set would be one file of which nothing can be skipped
        records = records.repartitionByRange(max(parts, 4 * len(splits)), *splits, keys.stay).sortWithinPartitions(*splits, keys.stay)
    writer = records.write.option("maxRecordsPerFile", RECORDS)
    (writer.partitionBy(split) if split else writer).parquet(f"{home}/packed")

    flat = [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in cohort.schema.fields
    ]
    cohort.select(*flat).write.option("header", True).csv(f"{home}/cohort")
    for name, dictionary in (dictionaries or {}).items():
        ordered = dictionary.select("index", "name").coalesce(1).sortWithinPartitions("index")
        ordered.write.option("sep", "\t").csv(f"{home}/{name}_classes")
    row = spark.range(1).select(F.lit(_versions(spark, dest) + 1).cast("long").alias("number"), F.lit(version).alias("version"), F.lit(cohort.schema.json()).alias("cohort"))
    row.coalesce(1).write.mode("append").json(f"{dest}/{MANIFEST}")


def _manifest(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.schema("number long, version string, cohort string").json(f"{dest}/{MANIFEST}")


def _versions(spark: SparkSession, dest: str) -> int:
    return (_manifest(spark, dest).agg(F.max("number")).first()[0] or 0) if exists(spark, f"{dest}/{MANIFEST}/_SUCCESS") else 0


def published(spark: SparkSession, dest: str) -> tuple[str, str]:
    """Folder and cohort schema of the last version that was written to its end."""
    found = _manifest(spark, dest).orderBy(F.col("number").desc(), F.col("version").desc()).first()
    if found is None:
        raise ValueError(f"no finished version in {dest}")
    return f"{dest}/version={found['version']}", found["cohort"]


def read_dataset(spark: SparkSession, dest: str) -> DataFrame:
    return spark.read.parquet(f"{published(spark, dest)[0]}/packed")


def read_cohort(spark: SparkSession, dest: str) -> DataFrame:
    """The cohort as it was written: lists are read from their JSON, null and empty text are told apart by the quotes."""
    home, schema = published(spark, dest)
    kinds = T.StructType.fromJson(json.loads(schema)).fields
    text = T.StructType([T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.ArrayType) else f for f in kinds])
    rows = spark.read.schema(text).option("header", True).option("emptyValue", EMPTY).csv(f"{home}/cohort")

    def restored(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return F.from_json(f.name, f.dataType).alias(f.name)
        return F.when(F.col(f.name) == EMPTY, "").otherwise(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)

    return rows.select(*[restored(f) for f in kinds])


def read_classes(spark: SparkSession, dest: str, target: str) -> DataFrame:
    return spark.read.schema("index int, name string").option("sep", "\t").csv(f"{published(spark, dest)[0]}/{target}_classes")


def class_count(target: str, dictionary: DataFrame | None = None, categories: int = 17) -> int:
    """Number of classes of a target: from its dictionary, ``categories`` for the diagnosis list, else two."""
    if dictionary is not None:
        return dictionary.count()
    return categories if target == "diagnosis" else 2


def _channel(i: int) -> Column:
    return F.transform("hi", lambda event: event[i])


def training_view(dataset: DataFrame, split: str, seed: int, target: str, form: str = "hi", keys: Keys = Keys()) -> DataFrame:
    """Records of one split with the chosen form split into its channels and the target as ``label``."""
    if form == "hi":
        channels = [_channel(i) for i in range(3)]
    elif form == "fl":
        channels = [F.col("fl")[i] for i in range(3)]
    else:
        raise ValueError(f"unknown form {form!r}")
    names = ("input_ids", "type_ids", "dpe_ids")
    return dataset.where(F.col(f"split_{seed}") == split).select(
        keys.stay, *[c.alias(n) for c, n in zip(channels, names)], F.col(target).alias("label")
    )


def _nothing_like(items: Column, element: T.DataType) -> Column:
    """Filler element: zeros in the shape of an event, or a single zero."""
    if isinstance(element, T.ArrayType):
        return F.transform(items[0], lambda x: F.lit(0).cast(element.elementType))
    return F.lit(0).cast(element)


def batch_view(view: DataFrame, batch_size: int, classes: int, seed: int = 0, keys: Keys = Keys()) -> DataFrame:
    """Batches of a training view: ``batch``, channels padded to the longest item of the batch, one-hot ``label``.

    The order is random but reproducible. Keys and lengths are read once and written; numbers and longest items come from them. The arrays are read
    once and move to their batch, whose rows are together in one partition.
    """
    slim = view.select(keys.stay, F.size("input_ids").alias("_size"), F.lit(1).alias("_one"), shuffled_position(F.col(keys.stay), seed).alias("_position"))
    running = running_total(cut_lineage(slim), "_position", "_one")
    numbers = running.select(keys.stay, "_size", F.floor((F.col("running") - 1) / batch_size).cast("long").alias("batch"))
    longest = F.max("_size").over(Window.partitionBy("batch"))
    placed = view.join(numbers.select(keys.stay, "batch", longest.alias("_longest")), keys.stay).repartition("batch")
    padded = []
    for name in ("input_ids", "type_ids", "dpe_ids"):
        element = view.schema[name].dataType.elementType
        padded.append(pad_right(F.col(name), F.col("_longest"), _nothing_like(F.col(name), element)).alias(name))
    is_list = isinstance(view.schema["label"].dataType, T.ArrayType)
    hot = many_hot(F.col("label"), classes) if is_list else one_hot(F.col("label"), classes)
    return placed.select("batch", keys.stay, *padded, hot.alias("label"))
