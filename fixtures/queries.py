"""One registered query per operator; each runs over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import views as v
from wardloom.functions.numbers import digit_places, round_decimals, space_digits
from wardloom.functions.words import normal
from wardloom.operators import attach, codes, cohort, dataset, exclusions, hierarchy, history, measurements, outcomes, packing, tokens, units
from wardloom.plans.run import Result, run
from wardloom.sources import stage as stages
from wardloom.sources import tables
from wardloom.sources.stage import content_key, cut_lineage, fingerprint, shared_folder, stage
from wardloom.sources.tables import read_categories, read_crosswalk, read_dictionary, read_table
from wardloom.spec import (
    Band,
    Bins,
    DiagnosisSpec,
    EventTableSpec,
    ExclusionRule,
    ExclusionSpec,
    Keys,
    LabTable,
    MeasurementTask,
    Params,
    SourceSpec,
    StayLayout,
)

KEYS = Keys()
Query = Callable[[SparkSession, str], DataFrame]
MAX_TOKENS, MAX_EVENTS, MIN_EVENTS, EVENT_TOKENS = 24, 5, 2, 10
EVENT_COLUMNS = ["event_type", "value", "props"]
SEEDS, VALID = (42, 7), 0.1


def listed(col: Column, sep: str = ",") -> Column:
    return F.array_join(col.cast("array<string>"), sep)


def micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


# --- scans and cohort -------------------------------------------------------------------------------------------


def scan(spark, d):
    typed = read_table(spark, d, "events", "event_id bigint, ts timestamp, user_id bigint, value double")
    return typed.select("event_id", micros("ts"), "user_id", "event_type", "value", "props")


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def csv_files(spark, d):
    """The customer table as CSV, plain and compressed, read back with types."""
    root, rows = _folder(spark), read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    schema = "c_custkey bigint, c_acctbal double"
    rows.write.option("header", True).csv(f"{root}/plain.csv")
    rows.write.option("header", True).option("compression", "gzip").csv(f"{root}/gz.csv.gz")
    parts = [read_table(spark, root, kind, schema, partitions=v.cores(spark)).withColumn("kind", F.lit(kind)) for kind in ("plain", "gz")]
    return parts[0].unionByName(parts[1])


def read_checked(spark, d):
    """The customer table as CSV in which some lines have a field too many and some end early: both results side by side."""
    path = f"{_folder(spark)}"
    row = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    key, name = F.col("c_custkey").cast("string"), F.concat(F.lit('"'), F.col("c_name"), F.lit(', again"'))
    broken = F.when(F.col("c_custkey") % 7 == 0, F.concat_ws(",", key, name, F.lit("1"), F.lit("more"))).when(F.col("c_custkey") % 11 == 0, key)
    line = F.coalesce(broken, F.concat_ws(",", key, name, F.col("c_acctbal").cast("string")))
    head = spark.range(1).select(F.lit("c_custkey,c_name,c_acctbal").alias("value"), F.lit(0).cast("long").alias("at"))
    lines = head.unionByName(row.select(line.alias("value"), (F.col("c_custkey") + 1).cast("long").alias("at")))
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{path}/customer.csv")
    found = tables.read_checked(spark, path, "customer", "c_custkey bigint, c_acctbal double")
    kept = found.rows.select("c_custkey", "c_name", "c_acctbal", F.lit(None).cast("string").alias("line"))
    return kept.unionByName(found.broken.select(*[F.lit(None).cast(t).alias(c) for c, t in kept.dtypes[:3]], "line"))


def category_file(spark, d):
    """Categories whose names and values stand in single quotes, the numbers from one on."""
    path = f"{_folder(spark)}/ccs.csv"
    quote = F.lit("'")
    line = F.concat(quote, F.col("code"), F.lit(" ','"), (F.col("category") + 1).cast("string"), F.lit(" '"))
    head = spark.range(1).select(F.lit(0).alias("n"), F.lit("'ICD-9-CM CODE','CCS LVL 1'").alias("line"))
    rows = head.unionByName(v.ccs(spark, d).select(F.lit(1).alias("n"), line.alias("line")))
    rows.coalesce(1).sortWithinPartitions("n").select("line").write.text(path)
    return read_categories(spark, path)


def crosswalk_file(spark, d):
    """The last row in file order of every code of the crosswalk."""
    path = f"{_folder(spark)}/gem.csv"
    rows = v.gem(spark, d).coalesce(1).sortWithinPartitions("ord")
    rows.select(F.col("source").alias("icd10cm"), F.col("target").alias("icd9cm")).write.option("header", True).csv(path)
    return codes.last_per_code(read_crosswalk(spark, path), "source", "target", "ord").withColumnRenamed("source", "code")


def dictionary_file(spark, d):
    """Every code stands twice, and the second text counts, null or not."""
    root, rows = _folder(spark), v.part_dictionary(spark, d)
    both = rows.select("code", F.lit("an older text").alias("text"), F.lit(0).alias("n")).unionByName(rows.withColumn("n", F.lit(1)))
    both.coalesce(1).sortWithinPartitions("n", "code").drop("n").write.option("header", True).csv(f"{root}/items.csv")
    return read_dictionary(spark, root, "items", "code", "text")


def _stay_out(df: DataFrame) -> DataFrame:
    return df.select(
        "stay_id", "hadm_id", "patient_id", "los", "age", micros("intime"), "outtime_min", "dischtime_min", "in_icu_mortality", "hos_discharge_location"
    )


def _layout(**changes) -> StayLayout:
    return StayLayout(**{**v.ANCHOR.__dict__, **changes})


def normalize_anchor(spark, d):
    stays = v.raw_stays(spark, d)
    return _stay_out(cohort.normalize_stays(stays, v.ANCHOR, v.raw_patients(spark, d), v.raw_admissions(stays)))


def normalize_birthdate(spark, d):
    stays = v.raw_stays(spark, d)
    layout = _layout(mode="birthdate", birth_date="dob")
    return _stay_out(cohort.normalize_stays(stays, layout, v.raw_patients(spark, d), v.raw_admissions(stays)))


CAPPED = StayLayout(
    mode="capped",
    stay="stay_id",
    admission="hadm_id",
    patient="patient_id",
    age="age_text",
    age_cap=("> 89", 300),
    outtime="out_offset",
    dischtime="left_offset",
    location="raw_loc",
    locations={"error": "Death", "view": "Home", "click": "Other", "purchase": "Rehabilitation"},
    unit_status=("last_type", "error"),
    visit_order="stay_id",
)


def _capped_stays(spark, d):
    stays = v.raw_stays(spark, d)
    since = lambda c: F.floor((F.unix_micros(c) - F.unix_micros("intime")) / F.lit(60000000.0)).cast("long")
    age = F.col("patient_id") % 100
    return stays.join(v.raw_admissions(stays), "hadm_id", "left").select(
        "stay_id",
        "hadm_id",
        "patient_id",
        "last_type",
        "raw_loc",
        since("outtime").alias("out_offset"),
        since("dischtime").alias("left_offset"),
        F.when(age >= 90, "> 89").when(age > 0, age.cast("string")).alias("age_text"),
    )


def normalize_capped(spark, d):
    return _stay_out(cohort.normalize_stays(_capped_stays(spark, d), CAPPED))


def select_cohort(spark, d):
    stays = v.raw_stays(spark, d)
    normal = cohort.normalize_stays(stays, v.ANCHOR, v.raw_patients(spark, d), v.raw_admissions(stays))
    chosen = cohort.select_cohort(normal, v.OBS, v.GAP, 18, 80, ("first_unit", "last_unit"))
    return chosen.select("stay_id", "hadm_id", "los", "age")


def _cohort(spark, d):
    return cohort.select_cohort(v.compat(spark, d), v.OBS, v.GAP, 18)


def label_readmission(spark, d):
    return cohort.label_readmission(_cohort(spark, d)).select("stay_id", "hadm_id", "readmission")


def first_stay(spark, d):
    return cohort.first_stay(_cohort(spark, d)).select("stay_id", "hadm_id", micros("intime"))


# --- outcome labels ---------------------------------------------------------------------------------------------


def label_death(spark, d):
    return outcomes.label_death_within(_cohort(spark, d), v.OBS, v.GAP, v.PRED).select("stay_id", "mortality")


def label_long_term_death(spark, d):
    out = outcomes.label_death_within(
        _cohort(spark, d), v.OBS, v.GAP, v.LONG_TERM, "long_term_mortality", include_unit_death=True
    )
    return out.select("stay_id", "long_term_mortality")


def label_los(spark, d):
    stays = v.compat(spark, d)
    return outcomes.label_los(outcomes.label_los(stays, 1), 2).select("stay_id", "los_1day", "los_2day")


def label_final_acuity(spark, d):
    return outcomes.label_final_acuity(_cohort(spark, d))[0].select("stay_id", "final_acuity")


def label_imminent_discharge(spark, d):
    return outcomes.label_imminent_discharge(_cohort(spark, d), v.OBS, v.GAP, v.PRED)[0].select("stay_id", "imminent_discharge")


def encode_classes(spark, d):
    coded, dictionary = outcomes.encode_classes(v.compat(spark, d), "hos_discharge_location")
    counts = coded.groupBy(F.col("hos_discharge_location").alias("index")).agg(F.count("*").alias("stays"))
    return counts.join(dictionary, "index", "left").select("index", "name", "stays")


# --- diagnosis codes --------------------------------------------------------------------------------------------


def _modern_codes(spark, d):
    return v.dx(spark, d).where("icd_version = 10").select(F.col("icd_code").alias("code"))


def crosswalk_codes(spark, d):
    return codes.crosswalk_codes(_modern_codes(spark, d), v.gem(spark, d))


def crosswalk_codes_backoff(spark, d):
    return codes.crosswalk_codes(_modern_codes(spark, d), v.gem(spark, d), backoff=True)


def convert_versions(spark, d):
    out = codes.convert_versions(v.dx(spark, d), v.gem(spark, d), "icd_code", "icd_version")
    return out.select("hadm_id", "icd_version", "icd_code", "converted")


def _code_set(spark, d, missing, rare_class):
    converted = codes.convert_versions(v.dx(spark, d), v.gem(spark, d), "icd_code", "icd_version")
    diagnosed = converted.select("hadm_id", F.col("converted").alias("code"))
    customers = read_table(spark, d, "customer").select(F.col("c_custkey").alias("hadm_id"))
    out = codes.label_code_set(customers, diagnosed, v.ccs(spark, d), rare_class, missing)
    return out.select("hadm_id", listed(F.col("diagnosis")).alias("diagnosis"))


def label_code_set(spark, d):
    return _code_set(spark, d, "drop", 14)


def label_code_set_empty(spark, d):
    return _code_set(spark, d, "empty", 3)


def explode_code_list(spark, d):
    return codes.explode_code_list(v.paths(spark, d), "path", "codes", "ord")


def path_categories(spark, d):
    exploded = codes.explode_code_list(v.paths(spark, d), "path", "codes", "ord")
    number = F.col("code").cast("int")
    # small codes have a category of their own, the others reach one through the crosswalk
    known = exploded.select("code").distinct()
    categories = known.where(number <= 250).select("code", F.floor(number / 10 % 18).cast("int").alias("category"))
    walk = known.where(number > 250).select(
        F.col("code").alias("source"), (number - 250).cast("string").alias("target"), F.lit(0).alias("ord")
    )
    return codes.path_categories(exploded, categories, walk)


def _path_tags(spark, d):
    exploded = codes.explode_code_list(v.paths(spark, d), "path", "codes", "ord")
    tag = F.floor(F.col("code").cast("int") / 10) % 18
    return exploded.groupBy("path").agg(F.max_by(tag, "pos").cast("int").alias("tag"))


def hierarchy_vote(spark, d):
    return hierarchy.hierarchy_vote(_path_tags(spark, d), v.paths(spark, d).select("path"))


# --- measurements and exclusions ---------------------------------------------------------------------------------

TASKS = (
    MeasurementTask("rising", ("purchase",), Bins((15.0, 30.0, 60.0, 120.0))),
    MeasurementTask("falling", ("view",), Bins((100.0, 60.0, 30.0, 10.0), descending=True)),
    MeasurementTask("banded", ("click",), Band(20.0, 80.0)),
    MeasurementTask("untreated", ("signup",), Bins((15.0, 30.0, 60.0, 120.0)), before_exclusion=True),
)
LAB = LabTable("labs", code="itemid", value="valuenum", time="charttime", unit="abs", key="admission", tasks=TASKS)
TREATED = ExclusionRule("ev", "event_type = 'error' and value > 200", "ts")
TREATED_TOO = ExclusionRule("ev", "event_type = 'purchase' and value > 300", "ts")


def _treated(spark, d):
    return exclusions.first_exclusion({"ev": v.ev(spark, d)}, [TREATED], "patient_id")


def label_measurement(spark, d):
    out = measurements.label_measurement(
        _cohort(spark, d), v.labs(spark, d), LAB, TASKS, v.OBS, v.GAP, v.PRED, KEYS, _treated(spark, d), "patient_id"
    )
    return out.select("stay_id", *[t.name for t in TASKS])


def first_exclusion(spark, d):
    rows = v.ev(spark, d)
    allowed = v.raw_stays(spark, d)
    rules = [TREATED, ExclusionRule(TREATED_TOO.table, TREATED_TOO.predicate, "ts", ("stays", "first_type = 'view'"))]
    out = exclusions.first_exclusion({"ev": rows, "stays": allowed}, rules, "patient_id", stay="stay_id")
    return out.select("patient_id", micros("first_excl"))


def before_first_exclusion(spark, d):
    out = exclusions.before_first_exclusion(v.labs(spark, d), _treated(spark, d), "patient_id", "charttime")
    return out.select("event_id", "stay_id")


def drop_multi_stay_excluded(spark, d):
    rows, stays = v.labs(spark, d), v.compat(spark, d)
    excluded = exclusions.first_exclusion({"ev": v.ev(spark, d)}, [TREATED], "stay_id")
    return exclusions.drop_multi_stay_excluded(rows, stays, excluded).select("event_id", "patient_id")


# --- events -----------------------------------------------------------------------------------------------------


def attach_by_stay(spark, d):
    out = attach.attach_by_stay(v.ev(spark, d), _cohort(spark, d))
    return out.select("event_id", "stay_id", micros("ts"), micros("intime"), "outtime_min")


def _star(spark, d, horizon=None):
    return attach.attach_by_admission(
        v.star_ev(spark, d), v.star_stays(spark, d), "charttime", KEYS, horizon, slice_seconds=45 * attach.DAY
    )


def attach_by_admission(spark, d):
    return _star(spark, d).select("hadm_id", "stay_id", micros("charttime"), micros("intime"), "itemid", "l_quantity")


def _observed(spark, d):
    rows = v.ev(spark, d).drop("patient_id")
    seen = attach.attach_observed(rows, _cohort(spark, d), "ts", v.OBS)
    return attach.observation_window(seen, v.OBS, "abs", "ts", ("props",))


def observation_window(spark, d):
    return _observed(spark, d).select("event_id", "stay_id", "time_min", "event_type", "value")


def observation_window_offsets(spark, d):
    """Minute offsets instead of timestamps: the offset stays a column."""
    joined = v.ev(spark, d).join(_cohort(spark, d).select("stay_id", "intime"), "stay_id")
    offset = F.floor((F.unix_micros("ts") - F.unix_micros("intime")) / F.lit(60000000.0)) - 60
    rows = joined.select("event_id", "stay_id", offset.cast("string").alias("offset_text"), "props")
    return attach.observation_window(rows, v.OBS, "min", "offset_text", ("props",))


def describe_codes(spark, d):
    out = attach.describe_codes(v.star_ev(spark, d), {"itemid": v.part_dictionary(spark, d)})
    return out.select("hadm_id", micros("charttime"), F.col("itemid").alias("item"), "l_quantity")


def _unit_text(col: str) -> Column:
    return F.array_join(F.transform(col, lambda u: F.concat_ws(":", u["pos"].cast("string"), u["name"], u["value"])), ";")


def event_units(spark, d):
    described = attach.describe_codes(v.star_ev(spark, d), {"itemid": v.part_dictionary(spark, d)})
    out = units.event_units(described, ["itemid", "l_quantity", "l_extendedprice", "l_returnflag"])
    return out.select("hadm_id", micros("charttime"), _unit_text("units").alias("units"))


def union_events(spark, d):
    first = _observed(spark, d).select("stay_id", "time_min", F.col("event_id").alias("row_key"))
    star = attach.observation_window(_star(spark, d, v.OBS * 60), v.OBS, "abs", "charttime")
    return units.union_events([first, star.select(F.col("itemid").alias("row_key"), "time_min", "stay_id")])


# --- text -------------------------------------------------------------------------------------------------------


def rounded(spark, d):
    return v.text(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", round_decimals(F.col("text")).alias("text"))


def spaced(spark, d):
    return v.text(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", space_digits(F.col("text")).alias("text"))


def places(spark, d):
    value = F.col("value").cast("string")
    return read_table(spark, d, "events").select("event_id", listed(digit_places(value)).alias("places"))


def word_pieces(spark, d):
    texts = read_table(spark, d, "documents", partitions=v.cores(spark)).select("doc_id", "text")
    out = tokens.word_pieces(texts, v.vocab(spark, d), "text")
    return out.select("doc_id", listed(F.col("ids")).alias("ids"))


def folded(spark, d):
    texts = read_table(spark, d, "documents", partitions=v.cores(spark))
    return texts.select("doc_id", normal(F.col("text"), accents=False).alias("text"))


def encode_texts(spark, d):
    texts = v.text(spark, d).select("text").distinct()
    out = tokens.encode_texts(texts, v.vocab(spark, d), "text")
    return out.select("text", listed(F.col("tokens.ids")).alias("ids"), listed(F.col("tokens.dpes")).alias("dpes"))


def encode_events(spark, d):
    """Whole events table: one event per row, its table name and three columns as tokens, 32 at most."""
    rows = v.ev(spark, d, dealt=True).withColumn("table_no", F.lit(0))
    united = units.event_units(rows, EVENT_COLUMNS, names=False).select("stay_id", "event_id", "table_no", "units")
    out = tokens.encode_events(united, [("events", EVENT_COLUMNS)], v.vocab(spark, d), 32)
    return out.select(
        "event_id", "stay_id",
        listed(F.col("ids")).alias("ids"), listed(F.col("types")).alias("types"), listed(F.col("dpes")).alias("dpes"),
    )


# --- history and packing ----------------------------------------------------------------------------------------


def _cut(spark, d, max_tokens=MAX_TOKENS, max_events=MAX_EVENTS):
    return history.cut_history(v.token_events(spark, d), max_tokens, max_events, MIN_EVENTS, ("time_min", "event_id"))


def cut_history(spark, d):
    return _cut(spark, d).select("stay_id", "event_id", "time_min", "event_no")


def cut_history_unlimited(spark, d):
    """No event limit: the token limit alone bounds the history, beyond the group-limit threshold."""
    return _cut(spark, d, 2000, None).select("stay_id", "event_id", "time_min", "event_no")


def pack_hierarchical(spark, d):
    out = packing.pack_hierarchical(_cut(spark, d), EVENT_TOKENS)
    return out.select("stay_id", listed(F.flatten(F.flatten("hi"))).alias("hi"), listed(F.col("time")).alias("time"))


def pack_flat(spark, d):
    out = packing.pack_flat(_cut(spark, d), MAX_TOKENS)
    return out.select("stay_id", listed(F.flatten("fl")).alias("fl"))


# --- data set ---------------------------------------------------------------------------------------------------


def split_patients(spark, d):
    out = dataset.split_patients(_cohort(spark, d), SEEDS, VALID)
    return out.select("stay_id", "patient_id", *[f"split_{s}" for s in SEEDS])


def keep_active(spark, d):
    return dataset.keep_active(_cohort(spark, d), _cut(spark, d)).select("stay_id", "patient_id")


def skipped_stays(spark, d):
    return dataset.skipped_stays(_cohort(spark, d), _cut(spark, d))


def _written(spark, d) -> str:
    dest = f"{shared_folder(spark)}/dataset-{uuid.uuid4().hex}"
    packed = cut_lineage(packing.pack_stays(_cut(spark, d), EVENT_TOKENS, MAX_TOKENS))  # read for its stays and for its records
    labelled, classes = outcomes.label_final_acuity(outcomes.label_death_within(_cohort(spark, d), v.OBS, v.GAP, v.PRED))
    chosen = dataset.split_patients(dataset.keep_active(labelled, packed), SEEDS, VALID)
    chosen = chosen.withColumn("splits", F.array(*[f"split_{s}" for s in SEEDS]))
    dataset.write_dataset(packed, chosen, dest, {"final_acuity": classes}, split=f"split_{SEEDS[0]}")
    return dest


def write_dataset(spark, d):
    dest = _written(spark, d)
    names = dataset.read_classes(spark, dest, "final_acuity").select(F.col("index").alias("final_acuity"), "name")
    return (
        dataset.read_dataset(spark, dest)
        .join(names, "final_acuity", "left")
        .select(
            "stay_id", listed(F.flatten(F.flatten("hi"))).alias("hi"), listed(F.flatten("fl")).alias("fl"), "mortality", "name", "split_42", "split_7"
        )
    )


def read_cohort(spark, d):
    """The cohort from its CSV: a list from its JSON, numbers and nulls in their types."""
    back = dataset.read_cohort(spark, _written(spark, d))
    return back.select("stay_id", "patient_id", "los", "mortality", "split_42", "split_7", listed(F.col("splits")).alias("splits"))


def stage_reuse(spark, d):
    """The second call reads what the first one wrote; another content under the same name is computed anew."""
    whole, name = _cohort(spark, d), uuid.uuid4().hex

    def kept(df: DataFrame, plan: DataFrame) -> DataFrame:
        return stage(plan, "cohort", fingerprint(name, content_key(df)))

    first = kept(whole, whole)
    again = kept(whole, whole.limit(0))  # what stands there is read, not this plan
    other = whole.where("los >= 2.5")
    changed = kept(other, other)
    parts = [(first, "first"), (again, "again"), (changed, "changed")]
    rows = [p.select("stay_id", "hadm_id", "los", F.lit(n).alias("call")) for p, n in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def stage_by_bucket(spark, d):
    """A stage over all but every hundredth stay, then over all stays: the second call computes the changed buckets only."""
    whole, name = _cohort(spark, d).select("stay_id", "hadm_id", "los"), uuid.uuid4().hex

    def kept(rows: DataFrame, call: str) -> DataFrame:
        made = stages.stage_by_bucket(rows, ["stay_id"], lambda r: r.withColumn("call", F.lit(call)), "cohort", name)
        return made.select("stay_id", "hadm_id", "los")

    before = kept(whole.where("stay_id % 100 <> 0"), "first").withColumn("state", F.lit("before"))
    return before.unionByName(kept(whole, "second").withColumn("state", F.lit("after")))


def training_view(spark, d):
    data = dataset.read_dataset(spark, _written(spark, d))
    out = dataset.training_view(data, "train", 42, "final_acuity", "hi")
    return out.select("stay_id", *[listed(F.flatten(c)).alias(c) for c in ("input_ids", "type_ids", "dpe_ids")], "label")


def training_view_flat(spark, d):
    """The flat form of another split and seed, with a label of two classes."""
    out = dataset.training_view(dataset.read_dataset(spark, _written(spark, d)), "valid", 7, "mortality", "fl")
    return out.select("stay_id", *[listed(F.col(c)).alias(c) for c in ("input_ids", "type_ids", "dpe_ids")], "label")


def class_counts(spark, d):
    """Number of classes of a target with a dictionary, of one without, and of the code list."""
    names = {"final_acuity": outcomes.label_final_acuity(_cohort(spark, d))[1], "mortality": None, "diagnosis": None}
    counts = [F.struct(F.lit(t).alias("target"), F.lit(dataset.class_count(t, n)).alias("classes")) for t, n in names.items()]
    return spark.range(1).select(F.inline(F.array(*counts)))


def batch_view(spark, d):
    packed = packing.pack_stays(_cut(spark, d), EVENT_TOKENS, MAX_TOKENS)
    labelled = outcomes.label_final_acuity(_cohort(spark, d))[0].select("stay_id", "final_acuity").withColumn("split_42", F.lit("train"))
    view = dataset.training_view(packed.join(labelled, "stay_id"), "train", 42, "final_acuity", "hi")
    out = dataset.batch_view(view, 32, 6)
    return out.select(
        "batch", "stay_id", F.size("input_ids").alias("length"), *[listed(F.flatten(c)).alias(c) for c in ("input_ids", "type_ids", "dpe_ids")],
        listed(F.col("label").cast("array<int>")).alias("label"),
    )


# --- whole run --------------------------------------------------------------------------------------------------

SPEC = SourceSpec(
    name="fixture",
    stays="stays",
    patients="patients",
    admissions="admissions",
    layout=_layout(units=None),
    events=(
        EventTableSpec("events", "ts", "abs", ("event_id", "patient_id"), {}, ("event_id",)),
        EventTableSpec("orders", "charttime", "abs", ("line_id",), {"itemid": ("parts", "text")}, ("line_id",)),
    ),
    diagnosis=DiagnosisSpec("dx", "versioned", "icd_code", "empty", "hadm_id", "icd_version"),
    labs=LAB,
    exclusion=ExclusionSpec((TREATED,), "patient"),
)
PARAMS = Params(
    obs=v.OBS,
    gap=v.GAP,
    pred=v.PRED,
    min_events=MIN_EVENTS,
    max_events=64,
    max_event_tokens=32,
    max_stay_tokens=512,
    seeds=SEEDS,
    diagnosis=True,
    packed_type="int",
    measurements=tuple(t.name for t in TASKS),
)


def _fixture_run(spark, d) -> Result:
    stays, rows = v.raw_stays(spark, d), v.ev(spark, d)
    # the second table has admissions only: orders of the customer with the patient's number, spread over the same month
    moment = F.timestamp_seconds(v.EPOCH + F.pmod(F.unix_seconds("charttime"), F.lit(30 * attach.DAY)))
    lines = v.star_ev(spark, d).withColumn("charttime", moment)
    slot = F.floor((F.unix_seconds("charttime") - v.EPOCH) / v.ADMISSION_SECONDS)
    inputs = {
        "stays": stays,
        "patients": v.raw_patients(spark, d),
        "admissions": v.raw_admissions(stays),
        "events": rows,
        "ev": rows,
        "labs": v.labs(spark, d),
        "orders": lines.withColumn("hadm_id", F.col("hadm_id") * 10 + slot),
        "parts": v.part_dictionary(spark, d),
        # old codes at one admission of the patient with the customer's number, new ones at another
        "dx": v.dx(spark, d).withColumn("hadm_id", F.col("hadm_id") * 10 + F.col("icd_version") % 2),
    }
    return run(inputs, SPEC, PARAMS, v.vocab(spark, d), v.ccs(spark, d), v.gem(spark, d))


def whole_run(spark, d):
    """Labelled, split cohort joined with its packed stays."""
    result = _fixture_run(spark, d)
    return result.cohort.join(result.packed, "stay_id").select(
        "stay_id", "patient_id", "readmission", "mortality", "long_term_mortality", "los_3day", "los_7day", "final_acuity",
        "imminent_discharge", listed(F.col("diagnosis")).alias("diagnosis"), *[t.name for t in TASKS], "split_42", "split_7", F.size("hi").alias("events"),
        listed(F.col("fl")[0]).alias("ids"), listed(F.col("fl")[1]).alias("types"),
        listed(F.col("fl")[2]).alias("dpes"), listed(F.col("time")).alias("time"),
    )


OFFSETS = SourceSpec(
    name="fixture_offsets",
    stays="stays",
    layout=CAPPED,
    events=(EventTableSpec("events", "at", "min", ("event_id", "patient_id"), {}, ("event_id",)),),
    diagnosis=DiagnosisSpec("paths", "paths", "codes", "empty", "stay_id", path="path"),
    labs=LabTable("events", code="event_type", value="value", time="at", unit="min", key="stay", tasks=TASKS),
    exclusion=ExclusionSpec((ExclusionRule("events", "event_type = 'error' and value > 200", "at"),), "stay", "min", drop_multi_stay=True),
)


def whole_run_offsets(spark, d):
    """A source whose times are minutes from the start of the stay, with diagnosis paths, exclusion by stay and the multi-stay rule."""
    starts = v.raw_stays(spark, d).select("stay_id", "intime")
    at = F.floor((F.unix_micros("ts") - F.unix_micros("intime")) / F.lit(60000000.0)).cast("int").alias("at")
    rows = v.ev(spark, d).join(starts, "stay_id").select("event_id", "stay_id", "hadm_id", "patient_id", at, "event_type", "value", "props")
    place = (F.col("ord") % 100) * 100 + F.col("ord") % 10
    paths = v.paths(spark, d).select(place.alias("stay_id"), "path", "codes", F.col("ord").alias("row_order"))
    codes_ = codes.explode_code_list(v.paths(spark, d), "path", "codes", "ord").select("code").distinct()
    categories = codes_.withColumn("category", F.floor(F.col("code").cast("int") / 10 % 18).cast("int"))
    inputs = {"stays": _capped_stays(spark, d), "events": rows, "paths": paths}
    result = run(inputs, OFFSETS, PARAMS, v.vocab(spark, d), categories, v.gem(spark, d))
    return result.cohort.join(result.packed, "stay_id").select(
        "stay_id", "patient_id", "readmission", "mortality", "long_term_mortality", "los_3day", "los_7day", "final_acuity",
        "imminent_discharge", listed(F.col("diagnosis")).alias("diagnosis"), *[t.name for t in TASKS], "split_42", "split_7", F.size("hi").alias("events"),
        listed(F.col("fl")[0]).alias("ids"), listed(F.col("fl")[2]).alias("dpes"), listed(F.col("time")).alias("time"),
    )


def registered() -> dict[str, Query]:
    return {
        "read_table": scan,
        "normalize_stays_anchor": normalize_anchor,
        "normalize_stays_birthdate": normalize_birthdate,
        "normalize_stays_capped": normalize_capped,
        "select_cohort": select_cohort,
        "label_readmission": label_readmission,
        "first_stay": first_stay,
        "label_death_within": label_death,
        "label_long_term_death": label_long_term_death,
        "label_los": label_los,
        "label_final_acuity": label_final_acuity,
        "label_imminent_discharge": label_imminent_discharge,
        "encode_classes": encode_classes,
        "crosswalk_codes": crosswalk_codes,
        "crosswalk_codes_backoff": crosswalk_codes_backoff,
        "convert_versions": convert_versions,
        "label_code_set": label_code_set,
        "label_code_set_empty": label_code_set_empty,
        "explode_code_list": explode_code_list,
        "path_categories": path_categories,
        "hierarchy_vote": hierarchy_vote,
        "label_measurement": label_measurement,
        "first_exclusion": first_exclusion,
        "before_first_exclusion": before_first_exclusion,
        "drop_multi_stay_excluded": drop_multi_stay_excluded,
        "attach_by_stay": attach_by_stay,
        "attach_by_admission": attach_by_admission,
        "observation_window": observation_window,
        "observation_window_offsets": observation_window_offsets,
        "describe_codes": describe_codes,
        "event_units": event_units,
        "union_events": union_events,
        "round_decimals": rounded,
        "space_digits": spaced,
        "digit_places": places,
        "word_pieces": word_pieces,
        "fold_accents": folded,
        "encode_texts": encode_texts,
        "encode_events": encode_events,
        "cut_history": cut_history,
        "cut_history_unlimited": cut_history_unlimited,
        "pack_hierarchical": pack_hierarchical,
        "pack_flat": pack_flat,
        "split_patients": split_patients,
        "keep_active": keep_active,
        "skipped_stays": skipped_stays,
        "write_dataset": write_dataset,
        "read_cohort": read_cohort,
        "stage_reuse": stage_reuse,
        "stage_by_bucket": stage_by_bucket,
        "read_csv": csv_files,
        "read_checked": read_checked,
        "read_categories": category_file,
        "read_crosswalk": crosswalk_file,
        "read_dictionary": dictionary_file,
        "training_view": training_view,
        "training_view_flat": training_view_flat,
        "class_counts": class_counts,
        "batch_view": batch_view,
        "whole_run": whole_run,
        "whole_run_offsets": whole_run_offsets,
    }
