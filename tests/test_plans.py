"""Plans that must hold at any size: no Python workers, no pairs of everything, limits before shuffles, one scan."""

import re

import pytest

from fixtures import queries
from wardloom.operators import attach, hierarchy, tokens
from wardloom.sources import stage

# queries that write on the way are covered by the operators they use
WRITE = {"write_dataset", "training_view_flat", "read_cohort", "stage_by_bucket", "read_checked", "training_view", "whole_run", "whole_run_offsets", "stage_reuse", "read_csv", "read_categories", "read_crosswalk", "read_dictionary"}
LAZY = sorted(set(queries.registered()) - WRITE)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_product(spark, small, name):
    text = plan(queries.registered()[name](spark, small))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD", "MapPartitions"):
        assert node not in text, node


def test_the_whole_run_has_no_python_and_few_exchanges(spark, small, monkeypatch):
    seen = []
    write = stage.cut_lineage

    def watched(df):
        seen.append(plan(df))
        return write(df)

    monkeypatch.setattr(stage, "cut_lineage", watched)
    monkeypatch.setattr(tokens, "cut_lineage", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen.append(plan(queries.whole_run(spark, small)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in seen:
        assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text)
    latest = next(text for text in seen if "_event" in text and "WindowGroupLimit" in text)
    # admission-keyed events are dealt to slices on both sides of their join, stay-keyed ones to the stay alone; then the union meets by stay
    # for the cut, which keeps the latest events before it moves them
    assert len(re.findall(r"Exchange hashpartitioning\(hadm_id#\d+L, _slice#\d+L", latest)) == 2
    assert not re.search(r"hashpartitioning\(stay_id#\d+L, _slice", latest)
    assert len(re.findall(r"Exchange hashpartitioning\(stay_id#\d+L, \d+\)", latest)) <= 3
    packed = next(text for text in seen if "collect_list" in text and "_used" in text)
    # the cut to the token limit and the packing share the exchange by stay
    assert len(re.findall(r"Exchange hashpartitioning\(stay_id#\d+L, \d+\)", packed)) == 1


@pytest.mark.parametrize("kind", ["int", "bigint", "string"])
def test_item_lists_and_keys_reach_the_scan_in_any_type(spark, tmp_path, kind):
    from wardloom.operators import exclusions, measurements
    from wardloom.plans.run import _common_keys
    from wardloom.sources import mimic4
    from wardloom.sources.rules import items
    from wardloom.spec import Bins, ExclusionRule, LabTable, MeasurementTask

    path = str(tmp_path / kind)
    spark.range(9).selectExpr(f"cast(id as {kind}) as itemid", "id as hadm_id", "id as subject_id", "id as stay_id", "id * 1.5 as value", "current_timestamp() as at").write.parquet(path)
    rows = spark.read.parquet(path)
    rule = ExclusionRule("t", items("itemid", (3, 5)), "at")
    found = exclusions.first_exclusion({"t": rows}, [rule], "hadm_id")
    lab = LabTable("t", code="itemid", value="value", time="at", unit="abs", key="admission", tasks=(MeasurementTask("m", (3, 5), Bins((1.0,))),))
    values = measurements._task_values(rows, lab, lab.tasks)
    for df in (found, values):
        assert re.search(r"PushedFilters: \[[^\]]*In\(itemid, \[3,5\]\)", plan(df)), plan(df)
    assert found.count() == 2 and values.count() == 2
    keyed = _common_keys(rows, mimic4.SPEC).where("hadm_id = 5")
    assert "EqualTo(hadm_id,5)" in plan(keyed)


def test_levels_of_a_hierarchy_add_up(spark):
    def operators(depth):
        rows = spark.createDataFrame([("|".join(f"s{i}" for i in range(depth)), 1)], "path string, tag int")
        return plan(hierarchy.vote_nodes(rows, depth)).count("HashAggregate")

    assert operators(7) <= 7 * 4 and operators(7) - operators(6) == operators(6) - operators(5)


def test_batches_read_the_records_once(spark, small, monkeypatch):
    from wardloom.operators import dataset

    view = spark.range(100).selectExpr("id as stay_id", "array(array(1, 2)) as input_ids", "array(array(1, 2)) as type_ids", "array(array(1, 2)) as dpe_ids", "0 as label")
    path = f"{stage.shared_folder(spark)}/view-{id(view)}"
    view.write.parquet(path)
    read = spark.read.parquet(path)
    batches = dataset.batch_view(read, 10, 2)
    assert plan(batches).count("dpe_ids#") and len(re.findall(r"Scan parquet .*input_ids", plan(batches))) == 1
    parts = batches.select("batch", batches.stay_id).rdd.glom().map(lambda rows: {r.batch for r in rows}).collect()
    assert sum(len(p) for p in parts) == 10


def test_convert_versions_scans_the_rows_once(spark, small):
    text = plan(queries.convert_versions(spark, small))
    assert len(re.findall(r"Scan parquet .*l_partkey", text)) == 1


def test_exclusion_rules_reach_the_scan(spark, small):
    text = plan(queries._treated(spark, small))
    assert "EqualTo(event_type,error)" in text and "GreaterThan(value,200.0)" in text


@pytest.mark.parametrize("name", ["cut_history", "first_stay"])
def test_groups_are_limited_before_the_shuffle(spark, small, name):
    text = plan(queries.registered()[name](spark, small))
    assert re.search(r"WindowGroupLimit .*Final", text) and re.search(r"WindowGroupLimit .*Partial", text)


def test_all_measurements_share_one_scan(spark, small):
    text = plan(queries.label_measurement(spark, small))
    lab_scans = [s for s in re.findall(r"DataFilters: .*", text) if "IN (click,purchase,signup,view)" in s]
    assert len(lab_scans) == 1 and "isnotnull(value" in lab_scans[0]


def test_the_range_join_is_an_equality_on_key_and_slice(spark, small):
    text = plan(queries.attach_by_admission(spark, small))
    assert re.search(r"Join \[hadm_id#\d+L, _slice#\d+L\], \[hadm_id#\d+L, _slice#\d+L\], Inner", text)


def test_offset_windows_are_filters_at_the_scan(spark, small, tmp_path):
    path = str(tmp_path / "offsets")
    spark.range(10).selectExpr("id as stay_id", "cast(id as int) as off", "id as unused").write.parquet(path)
    text = plan(attach.observation_window(spark.read.parquet(path), 12, "min", "off").select("stay_id", "time_min"))
    assert "off" in re.search(r"DataFilters: \[[^]]*\]", text).group(0) and "unused" not in text


def test_columns_are_pruned(spark, small):
    text = plan(queries.label_los(spark, small))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("props" not in s and "value" not in s for s in schemas)
