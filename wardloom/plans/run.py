"""One whole run: cohort, labels, events, packing, split."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardloom.operators import attach, codes, cohort, dataset, exclusions, hierarchy, history, measurements, outcomes, packing, tokens, units
from wardloom.sources import stage, tables
from wardloom.spec import DiagnosisSpec, EventTableSpec, Keys, Params, SourceSpec, TokenIds

ORDER = ("time_min", "table_no", "row_key")


# columns that labels are made from; a record that is trained on must not hold them
LABEL_SOURCES = ("los", "in_icu_mortality", "dischtime_min", "hos_discharge_location", "age")
LABELS = ("mortality", "long_term_mortality", "los_3day", "los_7day", "readmission", "final_acuity", "imminent_discharge")


def check_options(spec: SourceSpec, params: Params) -> None:
    """Names that do not exist, and what the source cannot give, are errors before anything is read."""
    known = {t.name for t in spec.labs.tasks} if spec.labs else set()
    for kind, asked, there in (("label", params.labels, set(LABELS)), ("measurement", params.measurements, known)):
        if unknown := sorted(set(asked) - there):
            raise ValueError(f"unknown {kind}: {', '.join(unknown)}; known are {', '.join(sorted(there)) or 'none'}")
    if params.diagnosis and spec.diagnosis is None:
        raise ValueError(f"source {spec.name} has no diagnosis table")


@dataclass(frozen=True)
class Result:
    cohort: DataFrame  # active stays with labels and splits
    packed: DataFrame  # (stay, hi, fl, time)
    dictionaries: Mapping[str, DataFrame]  # class names per coded target
    skipped: DataFrame  # one row of counts


def open_source(spark: SparkSession, root: str, spec: SourceSpec, params: Params, quarantine: str | None = None) -> dict[str, DataFrame]:
    """The tables a run of ``spec`` will touch, as lazy scans. With ``quarantine`` lines with too many or too few fields are written there
    and left out; the folder must be new."""
    check_options(spec, params)
    names = {spec.stays, *[t.name for t in spec.events]}
    names |= {n for n in (spec.patients, spec.admissions) if n}
    if params.diagnosis:
        names.add(spec.diagnosis.table)
    if params.measurements:
        names.add(spec.labs.name)
    if _needs_exclusion(spec, params):
        names |= {r.table for r in spec.exclusion.rules}
    if quarantine:
        checked = {n: tables.read_checked(spark, root, n) for n in sorted(names)}
        tables.set_aside({n: c.broken for n, c in checked.items()}, quarantine)
        opened = {n: c.rows for n, c in checked.items()}
    else:
        opened = {n: tables.read_table(spark, root, n) for n in sorted(names)}
    if params.diagnosis and spec.diagnosis.style == "paths":
        # the first code list of a path counts, so these rows carry their place in the file
        path = tables.find_table(spark, root, spec.diagnosis.table)
        opened[spec.diagnosis.table] = tables.in_file_order(spark, path).withColumnRenamed("ord", "row_order")
    for table in spec.events:
        for code, (name, text) in table.descriptions.items():
            opened[name] = tables.read_dictionary(spark, root, name, code, text)
    return opened


def _needs_exclusion(spec: SourceSpec, params: Params) -> bool:
    return any(t.before_exclusion and t.name in params.measurements for t in spec.labs.tasks) if spec.labs else False


def _typed(df: DataFrame, name: str, kind: str) -> DataFrame:
    """``name`` as ``kind``. A column that has the type stays as it is, so that filters on it reach the scan."""
    is_it = df.schema[name].dataType.simpleString() == {"long": "bigint"}.get(kind, kind)
    return df if is_it else df.withColumn(name, F.col(name).cast("string").try_cast(kind))


def _common_keys(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Key columns under their common names, as the cohort types them."""
    layout = spec.layout
    for old, new in ((layout.stay, "stay_id"), (layout.admission, "hadm_id")):
        if old in df.columns:
            df = _typed(df, old, "long").withColumnRenamed(old, new)
    if layout.patient in df.columns:
        kind = "string" if layout.mode == "capped" else "long"
        df = _typed(df, layout.patient, kind).withColumnRenamed(layout.patient, "patient_id")
    return df


def build_cohort(inputs: Mapping[str, DataFrame], spec: SourceSpec, params: Params) -> tuple[DataFrame, Keys]:
    keys = Keys(order_by="visit_order" if spec.layout.visit_order else "intime")
    stays = cohort.normalize_stays(
        inputs[spec.stays], spec.layout, inputs.get(spec.patients), inputs.get(spec.admissions)
    )
    unit = ("first_unit", "last_unit") if spec.layout.units else None
    chosen = cohort.select_cohort(stays, params.obs, params.gap, params.min_age, params.max_age, unit)
    # the label looks at all selected stays of an admission, so it comes before the choice of the first one
    labelled = cohort.label_readmission(chosen, keys)
    return (cohort.first_stay(labelled, keys) if params.first_stay_only else labelled), keys


def label_outcomes(stays: DataFrame, params: Params) -> tuple[DataFrame, dict[str, DataFrame]]:
    dictionaries = {}
    out = stays
    wanted = set(params.labels)
    if "mortality" in wanted:
        out = outcomes.label_death_within(out, params.obs, params.gap, params.pred)
    if "long_term_mortality" in wanted:
        out = outcomes.label_death_within(out, params.obs, params.gap, params.long_term_pred, "long_term_mortality")
    for days in (3, 7):
        if f"los_{days}day" in wanted:
            out = outcomes.label_los(out, days)
    if "final_acuity" in wanted:
        out, dictionaries["final_acuity"] = outcomes.label_final_acuity(out)
    if "imminent_discharge" in wanted:
        out, dictionaries["imminent_discharge"] = outcomes.label_imminent_discharge(out, params.obs, params.gap, params.pred)
    if "readmission" not in wanted:
        out = out.drop("readmission")
    return out, dictionaries


def diagnosis_codes(
    rows: DataFrame, dx: DiagnosisSpec, categories: DataFrame, crosswalk: DataFrame | None, params: Params
) -> tuple[DataFrame, DataFrame]:
    """(key, code) and (code, category) for either diagnosis style."""
    if dx.style == "versioned":
        if dx.version is None:
            return rows.select(dx.key, F.col(dx.code).alias("code")), categories
        converted = codes.convert_versions(rows, crosswalk, dx.code, dx.version, params.code_backoff)
        return converted.select(dx.key, F.col("converted").alias("code")), categories
    exploded = codes.explode_code_list(rows, dx.path, dx.code, "row_order", params.trim_codes)
    direct = codes.path_categories(exploded, categories, crosswalk, params.code_backoff)
    labelled = direct.select("path", F.col("category").alias("tag"))
    voted = hierarchy.hierarchy_vote(labelled, rows.select(F.col(dx.path).alias("path")).where("path is not null"))
    both = labelled.unionByName(voted).select(F.col("path").alias("code"), F.col("tag").alias("category"))
    return rows.select(dx.key, F.col(dx.path).alias("code")), both


def label_diagnosis(stays, inputs, spec, params, categories, crosswalk, keys) -> DataFrame:
    dx = spec.diagnosis
    rows = inputs[dx.table]
    if dx.style == "paths" and "row_order" not in rows.columns:
        raise ValueError(f"{dx.table} needs row_order: the first code list of a path counts, and rows of a table have no order of their own")
    diagnosed, known = diagnosis_codes(rows, dx, categories, crosswalk, params)
    diagnosed = _common_keys(diagnosed, spec)
    if keys.admission not in diagnosed.columns:
        diagnosed = diagnosed.join(stays.select(keys.stay, keys.admission), keys.stay)
    return codes.label_code_set(stays, diagnosed, known, dx.rare_class, dx.missing, keys)


def label_measurements(stays, inputs, spec, params, keys) -> DataFrame:
    lab = spec.labs
    tasks = [t for t in lab.tasks if t.name in params.measurements]
    labs = _common_keys(inputs[lab.name], spec)
    found, key, dropped = None, None, None
    if _needs_exclusion(spec, params):
        rule = spec.exclusion
        key = keys.patient if rule.key == "patient" else keys.stay
        named = {r.table: _common_keys(inputs[r.table], spec) for r in rule.rules}
        named |= {r.only_stays[0]: _common_keys(inputs[r.only_stays[0]], spec) for r in rule.rules if r.only_stays}
        found = exclusions.first_exclusion(named, rule.rules, key, rule.unit, keys.stay)
        if rule.drop_multi_stay:
            every_stay = _common_keys(inputs[spec.stays], spec).select(keys.patient, keys.admission, keys.stay)
            dropped = exclusions.multi_stay_excluded(every_stay, found, keys)
    out = measurements.label_measurement(
        stays, labs, lab, tasks, params.obs, params.gap, params.pred, keys, found, key
    )
    if dropped is not None:
        flagged = dropped.withColumn("_dropped", F.lit(True))
        out = out.join(flagged, keys.patient, "left")
        for t in tasks:
            if t.before_exclusion:
                out = out.withColumn(t.name, F.when(F.col("_dropped").isNull(), F.col(t.name)))
        out = out.drop("_dropped")
    return out


def _event_limit(params: Params) -> int:
    return history.event_limit(params.max_stay_tokens, params.max_events)


def observed_events(
    inputs: Mapping[str, DataFrame], table: EventTableSpec, spec: SourceSpec, stays: DataFrame, params: Params, keys: Keys
) -> tuple[DataFrame, list[str], dict[int, DataFrame]]:
    """Units of one event table inside the observation window, its feature columns, and the dictionaries of those that hold codes, by
    position. Codes become texts after the cut to the latest events: far fewer rows are looked up then."""
    rows = _common_keys(inputs[table.name], spec)
    common = {spec.layout.stay: keys.stay, spec.layout.admission: keys.admission, spec.layout.patient: keys.patient}
    excluded = [common.get(c, c) for c in table.exclude]
    skip = [*excluded, keys.stay, keys.admission, *([table.time] if table.unit == "abs" else [])]
    columns = units.feature_columns(rows.columns, skip)
    # ties in time are broken by the row's own number, or by its content
    row_key = F.xxhash64(*(table.row_key or sorted(rows.columns)))
    if len(table.row_key) == 1:
        row_key = F.coalesce(F.col(table.row_key[0]).cast("string").try_cast("long"), row_key)
    rows = rows.withColumn("row_key", row_key)
    rows = rows.select(*dict.fromkeys([*[k for k in (keys.stay, keys.admission) if k in rows.columns], table.time, "row_key", *columns]))
    if table.unit == "abs":
        seen = attach.observation_window(attach.attach_observed(rows, stays, table.time, params.obs, keys), params.obs, "abs", table.time)
    else:
        # the offset needs no stay row: window and limit come first, and a long stay is short before the join
        inside = attach.observation_window(rows, params.obs, "min", table.time)
        latest = history.latest_events(inside, _event_limit(params), ("time_min", "row_key"), keys).drop("event_no")
        seen = latest.join(stays.select(keys.stay), keys.stay, "left_semi")
    texts = {columns.index(code): inputs[name] for code, (name, _) in table.descriptions.items() if code in columns}
    return units.event_units(seen, columns, names=False).select(keys.stay, "time_min", "row_key", "units"), columns, texts


def run(
    inputs: Mapping[str, DataFrame],
    spec: SourceSpec,
    params: Params,
    vocab: DataFrame,
    categories: DataFrame | None = None,
    crosswalk: DataFrame | None = None,
    token_ids: TokenIds = TokenIds(),
    lower: bool = True,
    reuse: str | None = None,
    accents: bool = True,
) -> Result:
    """Run all steps. ``reuse`` names the input snapshot: with it, finished stages of the same spec, parameters, vocabulary, categories and crosswalk
    are read instead of computed again. Stays, labelled cohort, the latest events, encoded values and packed stays are written on the way; raw events
    are scanned once."""
    check_options(spec, params)
    content = [stage.content_key(t) for t in (vocab, categories, crosswalk)] if reuse else None
    key = stage.fingerprint(reuse, spec, params, token_ids, lower, accents, content)

    def keep(df: DataFrame, name: str, counted: stage.RowCount | None = None) -> DataFrame:
        if reuse:
            return stage.stage(df, f"{spec.name}-{name}", key, counted=counted)
        return stage.cut_lineage(counted.watch(df) if counted else df)

    stays, keys = build_cohort(inputs, spec, params)
    # every label reads the cohort again, so it is written once
    stays, dictionaries = label_outcomes(keep(stays, "stays"), params)
    if params.diagnosis:
        stays = label_diagnosis(stays, inputs, spec, params, categories, crosswalk, keys)
    if params.measurements:
        stays = label_measurements(stays, inputs, spec, params, keys)
    all_stays, all_packed = stage.RowCount(), stage.RowCount()
    stays = keep(stays.drop("first_unit", "last_unit", *(() if params.label_sources else LABEL_SOURCES)), "cohort", all_stays)

    per_table, heads, dictionaries_at = [], [], {}
    for number, table in enumerate(spec.events):
        events, columns, texts = observed_events(inputs, table, spec, stays, params, keys)
        per_table.append(events)
        heads.append((table.name.rsplit("/", 1)[-1], columns))
        dictionaries_at |= {(number, pos): rows for pos, rows in texts.items()}
    # earlier events cannot survive the cut, so they are never described or encoded
    latest = history.latest_events(units.union_events(per_table), _event_limit(params), ORDER, keys)
    encoded = tokens.encode_events(latest, heads, vocab, params.max_event_tokens, token_ids, lower, dictionaries_at, accents=accents)
    # the cut to the token limit and the packing share one exchange by stay
    fitted = history.fit_tokens(encoded, params.max_stay_tokens, params.min_events, ORDER, keys=keys)
    packed = keep(packing.pack_stays(fitted, params.max_event_tokens, params.max_stay_tokens, token_ids, keys, params.packed_type), "packed", all_packed)
    active = packed.select(keys.stay)
    chosen = dataset.split_patients(dataset.keep_active(stays, active, keys), params.seeds, params.valid_percent, keys)
    # every packed stay is one row and of the cohort, so the two writes have counted what was skipped
    counts = dataset.skipped_counts(stays.sparkSession, all_stays.of(stays), all_packed.of(packed))
    return Result(chosen, packed, dictionaries, counts)
