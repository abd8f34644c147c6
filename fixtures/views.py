"""DataFrame views over the given tables (see FIXTURES.md). Times are read as UTC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.functions.times import nearest_minute
from wardloom.sources.stage import cut_lineage
from wardloom.sources.tables import read_table
from wardloom.spec import StayLayout

OBS, GAP, PRED, LONG_TERM = 48, 0, 24, 336
EPOCH = 1704067200  # 2024-01-01
ADMISSION_SECONDS, STAY_SECONDS = 1296000, 259200
LOCATIONS = {"Death": "Death", "view": "Home", "click": "Other", "purchase": "Rehabilitation"}

ANCHOR = StayLayout(
    mode="anchor",
    stay="stay_id",
    admission="hadm_id",
    patient="patient_id",
    intime="intime",
    outtime="outtime",
    los="los",
    units=("first_type", "last_type"),
    anchor_year="anchor_year",
    anchor_age="anchor_age",
    dischtime="dischtime",
    location="raw_loc",
    died="error",
    locations=LOCATIONS,
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def ev(spark: SparkSession, d: str, dealt: bool = False) -> DataFrame:
    events = read_table(spark, d, "events", partitions=cores(spark) if dealt else None).withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.unix_seconds("ts") - EPOCH
    return events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("patient_id"),
        "event_type",
        "value",
        "props",
        (F.col("user_id") * 10 + F.floor(seconds / ADMISSION_SECONDS)).alias("hadm_id"),
        (F.col("user_id") * 100 + F.floor(seconds / STAY_SECONDS)).alias("stay_id"),
    )


def raw_stays(spark: SparkSession, d: str) -> DataFrame:
    return (
        ev(spark, d)
        .groupBy("patient_id", "hadm_id", "stay_id")
        .agg(
            F.min("ts").alias("intime"),
            F.max("ts").alias("outtime"),
            F.min_by("event_type", "ts").alias("first_type"),
            F.max_by("event_type", "ts").alias("last_type"),
        )
        .withColumn("los", (F.unix_micros("outtime") - F.unix_micros("intime")) / F.lit(86400000000.0))
    )


def raw_admissions(stays: DataFrame) -> DataFrame:
    """Last event of an admission = last event of its latest stay, so the events are scanned once."""
    return stays.groupBy("hadm_id").agg(F.max("outtime").alias("dischtime"), F.max_by("last_type", "outtime").alias("raw_loc"))


def raw_patients(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "events").select(F.col("user_id").alias("patient_id")).distinct()
    return people.select(
        "patient_id",
        F.lit(2024).alias("anchor_year"),
        (18 + F.col("patient_id") % 70).alias("anchor_age"),
        F.make_date(
            (1940 + F.col("patient_id") % 60).cast("int"),
            (1 + F.col("patient_id") % 12).cast("int"),
            (1 + F.col("patient_id") % 28).cast("int"),
        ).alias("dob"),
    )


def compat(spark: SparkSession, d: str) -> DataFrame:
    stays = raw_stays(spark, d)
    minutes = lambda c: F.floor((F.unix_micros(c) - F.unix_micros("intime")) / F.lit(60000000.0)).cast("long")
    dead = (F.col("intime") < F.col("dischtime")) & (F.col("dischtime") <= F.col("outtime")) & (F.col("raw_loc") == "error")
    place = F.when(F.col("raw_loc") == "error", "Death")
    for raw, name in (("view", "Home"), ("click", "Other"), ("purchase", "Rehabilitation")):
        place = place.when(F.col("raw_loc") == raw, name)
    return stays.join(raw_admissions(stays), "hadm_id", "left").select(
        "patient_id",
        "hadm_id",
        "stay_id",
        (18 + F.col("patient_id") % 70).cast("int").alias("age"),
        "intime",
        "los",
        minutes("outtime").alias("outtime_min"),
        minutes("dischtime").alias("dischtime_min"),
        F.coalesce(dead, F.lit(False)).alias("in_icu_mortality"),
        place.alias("hos_discharge_location"),
    )


def labs(spark: SparkSession, d: str) -> DataFrame:
    return ev(spark, d).select(
        "event_id", "hadm_id", "stay_id", "patient_id", F.col("ts").alias("charttime"), F.col("event_type").alias("itemid"),
        F.col("value").alias("valuenum"),
    )


def star_stays(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("stay_id"),
        F.col("o_custkey").alias("hadm_id"),
        F.col("o_orderdate").cast("timestamp").alias("intime"),
        F.lit(129600).alias("outtime_min"),
    )


def star_ev(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("hadm_id"))
    lines = read_table(spark, d, "lineitem", partitions=cores(spark)).select(
        "l_orderkey",
        F.col("l_shipdate").cast("timestamp").alias("charttime"),
        (F.col("l_partkey") + F.col("l_linenumber")).alias("itemid"),
        # order and line number repeat; with the part they hardly do
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("line_id"),
        "l_quantity",
        "l_extendedprice",
        "l_returnflag",
    )
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def part_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Some parts have no text; and some item ids lie beyond the last part."""
    text = F.when(~F.col("p_name").endswith("ring"), F.col("p_name"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("code"), text.alias("text"))


def gem(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    rows = part.where(~F.col("p_name").endswith("ring")).select(
        F.col("p_name").alias("source"), F.col("p_brand").alias("target"), F.col("p_partkey").alias("ord")
    )
    stems = part.select(
        F.substring_index("p_name", " ", 1).alias("source"), F.lit("Brand#1").alias("target"), F.lit(-1).cast("long").alias("ord")
    )
    return rows.unionByName(stems.distinct())


def ccs(spark: SparkSession, d: str) -> DataFrame:
    number = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int")
    return table(spark, d, "part").select(F.col("p_brand").alias("code"), ((number - 1) % 18).alias("category")).distinct()


def dx(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("hadm_id"))
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    old = F.col("l_linenumber") % 2 == 0
    return (
        table(spark, d, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber")
        .join(orders, "l_orderkey")
        .join(part, "l_partkey")
        .select(
            "hadm_id",
            F.when(old, 9).otherwise(10).alias("icd_version"),
            F.when(old, F.col("p_brand")).otherwise(F.col("p_name")).alias("icd_code"),
        )
    )


def paths(spark: SparkSession, d: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    codes = (
        F.when(key % 4 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, F.concat(size.cast("string"), F.lit(".0, "), (size + 1).cast("string"), F.lit(".0")))
        .otherwise(F.concat(size.cast("string"), F.lit(".0")))
    )
    return table(spark, d, "part").select(
        key.alias("ord"), F.concat_ws("|", "p_type", "p_brand", "p_name").alias("path"), codes.alias("codes")
    )


FIXED_TOKENS = [("[PAD]", 0), ("[UNK]", 100), ("[CLS]", 101), ("[SEP]", 102), (".", 119)] + [(str(i), 121 + i) for i in range(10)]


def cores(spark: SparkSession) -> int:
    """Test files are single row groups, so scans before much work are dealt out anew."""
    return spark.sparkContext.defaultParallelism


def vocab(spark: SparkSession, d: str) -> DataFrame:
    """Fixed rows, all letters that occur, their continuations, and every longer word that occurs at least twice."""
    words = read_table(spark, d, "documents", partitions=cores(spark)).select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("token")
    )
    counted = cut_lineage(words.groupBy("token").count())
    often = counted.where((F.length("token") > 1) & (F.col("count") >= 2)).select("token", F.lit(2).alias("k"))
    letters = counted.select(F.explode(F.filter(F.split("token", ""), lambda c: c != "")).alias("c")).distinct()
    all_tokens = reduce(
        DataFrame.unionByName,
        [often, letters.select(F.col("c").alias("token"), F.lit(0).alias("k")), letters.select(F.concat(F.lit("##"), "c").alias("token"), F.lit(1).alias("k"))],
    )
    numbered = all_tokens.selectExpr("token", "cast(200 + row_number() over (order by k, token) as int) as id")
    fixed = F.array(*[F.struct(F.lit(t).alias("token"), F.lit(i).alias("id")) for t, i in FIXED_TOKENS])
    return numbered.unionByName(spark.range(1).select(F.inline(fixed)))


def token_events(spark: SparkSession, d: str) -> DataFrame:
    """Encoded events without a tokenizer: token ids, types and places follow from the event id."""
    joined = ev(spark, d).select("stay_id", "event_id", "ts").join(raw_stays(spark, d).select("stay_id", "intime"), "stay_id")
    steps = F.sequence(F.lit(0), (F.col("event_id") % 6).cast("int"))
    spread = lambda base, factor, size: F.transform(
        steps, lambda i: (base + (F.col("event_id") * factor + i) % size).cast("int")
    )
    return joined.select(
        "stay_id",
        "event_id",
        nearest_minute(F.col("ts"), F.col("intime")).alias("time_min"),
        spread(200, 1, 50).alias("ids"),
        spread(1, 1, 3).alias("types"),
        spread(0, 7, 10).alias("dpes"),
    )


def text(spark: SparkSession, d: str) -> DataFrame:
    whole = F.concat(
        F.lit("dose "), F.col("l_linenumber").cast("string"), F.lit("."), F.lpad(F.col("l_partkey").cast("string"), 6, "0"),
        F.lit(" mg x"), F.col("l_suppkey").cast("string"),
    )
    return read_table(spark, d, "lineitem", partitions=cores(spark)).select("l_orderkey", "l_linenumber", "l_partkey", whole.alias("text"))
