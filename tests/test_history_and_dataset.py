"""Cutting, packing, splitting, writing and reading."""

import random

import pytest
from pyspark.sql import functions as F

from wardloom.functions.arrays import pad_right
from wardloom.operators import dataset, history, packing
from wardloom.plans.numbering import running_total, shuffled_position
from wardloom.sources import stage
from wardloom.spec import TokenIds

ORDER = ("time_min", "row_key")


def events(spark, stays, parts=4):
    rows = [
        (stay, t, key, [10 * stay + i for i in range(n)], [3] * n, [i % 5 for i in range(n)])
        for stay, items in stays.items()
        for key, (t, n) in enumerate(items)
    ]
    schema = "stay_id long, time_min int, row_key long, ids array<int>, types array<int>, dpes array<int>"
    return spark.createDataFrame(rows, schema).repartition(parts)


def some_stays(seed, n=60):
    rng = random.Random(seed)
    return {s: [(rng.randint(0, 20), rng.randint(0, 9)) for _ in range(rng.randint(1, 30))] for s in range(n)}


def kept_by_hand(items, max_tokens, max_events, min_events):
    """From the latest event back, while everything fits."""
    latest = sorted(((t, k, n) for k, (t, n) in enumerate(items)), reverse=True)
    room, kept = max_tokens - 1, []
    for t, k, n in latest[: max_events or len(latest)]:
        room -= n + 1
        if room < 0:
            break
        kept.append(k)
    return kept if len(kept) > min_events else []


@pytest.mark.parametrize("max_tokens, max_events, min_events", [(40, 8, 2), (40, None, 1), (5, 8, 1), (1000, 5, 4), (1000, 5, 5), (3000, None, 3)])
def test_cut_history_matches_a_direct_loop(spark, max_tokens, max_events, min_events):
    stays = some_stays(max_tokens)
    out = history.cut_history(events(spark, stays), max_tokens, max_events, min_events, ORDER)
    got = {}
    for r in out.orderBy("stay_id", "event_no").collect():
        got.setdefault(r.stay_id, []).append(r.row_key)
    expected = {s: kept_by_hand(items, max_tokens, max_events, min_events) for s, items in stays.items()}
    assert got == {s: k for s, k in expected.items() if k}


def test_the_partitioning_of_the_input_does_not_matter(spark):
    stays = some_stays(4)
    results = [
        sorted(map(str, packing.pack_flat(history.cut_history(events(spark, stays, n), 60, 9, 1, ORDER), 60).collect())) for n in (1, 3, 16)
    ]
    assert results[0] == results[1] == results[2]


def test_packed_forms(spark):
    stays = {1: [(5, 2), (3, 1), (9, 3)], 2: [(1, 1), (1, 2)]}
    kept = history.cut_history(events(spark, stays), 20, 9, 1, ORDER)
    rows = {r.stay_id: r for r in packing.pack_stays(kept, 6, 20).collect()}
    assert rows[1].time == [3, 5, 9] and rows[2].time == [1, 1]
    assert [e[0] for e in rows[1].hi] == [[101, 10, 102, 0, 0, 0], [101, 10, 11, 102, 0, 0], [101, 10, 11, 12, 102, 0]]
    assert rows[1].hi[2][1:] == [[5, 3, 3, 3, 6, 0], [0, 0, 1, 2, 0, 0]]
    assert rows[1].fl[0] == [101, 10, 102, 10, 11, 102, 10, 11, 12, 102] + [0] * 10
    assert rows[1].fl[1] == [5, 3, 6, 3, 3, 6, 3, 3, 3, 6] + [0] * 10
    assert rows[1].fl[2] == [0, 0, 0, 0, 1, 0, 0, 1, 2, 0] + [0] * 10
    assert [r.hi for r in packing.pack_hierarchical(kept, 6).where("stay_id = 1").collect()] == [rows[1].hi]
    assert [r.fl for r in packing.pack_flat(kept, 20).where("stay_id = 1").collect()] == [rows[1].fl]


def test_an_event_longer_than_its_place_is_an_error(spark):
    kept = history.cut_history(events(spark, {1: [(1, 5), (2, 5)]}), 50, 9, 1, ORDER)
    with pytest.raises(Exception, match="array exceeds its fixed length"):
        packing.pack_hierarchical(kept, 6).collect()


def test_token_ids_beyond_16_bits_are_an_error(spark):
    kept = history.cut_history(events(spark, {1: [(1, 1), (2, 1)]}), 50, 9, 1, ORDER)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        packing.pack_flat(kept, 50, TokenIds(start=40000)).collect()


def test_pad_right_of_null(spark):
    df = spark.sql("select cast(null as array<int>) as a")
    assert df.select(pad_right(F.col("a"), 3)).first()[0] is None


def cohort(spark, n=500):
    rng = random.Random(3)
    return spark.createDataFrame([(i, rng.randint(0, n // 3) ** 2 % 97) for i in range(n)], "stay_id long, patient_id long")


def test_splits_keep_patients_together_and_meet_the_thresholds(spark):
    out = dataset.split_patients(cohort(spark), [1, 2], 0.2).collect()
    biggest = max(sum(r.patient_id == p for r in out) for p in {r.patient_id for r in out})
    for seed in (1, 2):
        name = f"split_{seed}"
        by_patient = {}
        for r in out:
            by_patient.setdefault(r.patient_id, set()).add(r[name])
        assert all(len(s) == 1 for s in by_patient.values())
        for part, share in (("test", 100), ("valid", 100), ("train", 300)):
            assert abs(sum(r[name] == part for r in out) - share) <= 2 * biggest
    assert [r.split_1 for r in out] != [r.split_2 for r in out]


@pytest.mark.parametrize("share, expected", [(0.0, {"train"}), (0.5, {"test", "valid", "train"})])
def test_extreme_shares(spark, share, expected):
    assert {r.split_1 for r in dataset.split_patients(cohort(spark), [1], share).collect()} == expected


def test_running_total_equals_a_global_sum(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("n")).withColumn("p", shuffled_position(F.col("id"), 5))
    got = running_total(df, "p", "n").orderBy("p").collect()
    total = 0
    for r in got:
        total += r.n
        assert r.running == total
    assert {r.total for r in got} == {total}


def test_write_and_read_back(spark, tmp_path):
    kept = history.cut_history(events(spark, some_stays(2, 40)), 60, 9, 2, ORDER)
    packed = packing.pack_stays(kept, 12, 60)
    stays = spark.range(60).selectExpr(
        "id as stay_id", "id div 2 as patient_id", "timestamp'2020-01-01' as intime", "3 as outtime_min",
        "cast(id % 3 as int) as target", "array(cast(id % 2 as int)) as diagnosis",
    )
    active = dataset.keep_active(stays, packed)
    chosen = dataset.split_patients(active, [42], 0.2)
    counts = dataset.skipped_stays(stays, packed).first()
    assert counts.stays == 60 and counts.active == active.count() and counts.skipped == 60 - counts.active
    classes = spark.createDataFrame([(1, "b"), (0, "a"), (2, "c")], "index int, name string")
    dest = str(tmp_path / "out")
    dataset.write_dataset(packed, chosen, dest, {"target": classes}, split="split_42")
    back = dataset.read_dataset(spark, dest)
    assert not {"intime", "outtime_min"} & set(back.columns)
    assert back.count() == counts.active
    assert [tuple(r) for r in dataset.read_classes(spark, dest, "target").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    table = spark.read.option("header", True).csv(f"{dataset.published(spark, dest)[0]}/cohort")
    assert table.count() == counts.active and table.first().diagnosis in ("[0]", "[1]")
    view = dataset.training_view(back, "train", 42, "target", "fl")
    assert view.count() == chosen.where("split_42 = 'train'").count()
    assert "PartitionFilters: [isnotnull(split_42" in view._jdf.queryExecution().executedPlan().toString()
    assert dataset.class_count("target", classes) == 3 and dataset.class_count("mortality") == 2 and dataset.class_count("diagnosis") == 17

    batches = dataset.batch_view(dataset.training_view(back, "train", 42, "target"), 4, 3).collect()
    sizes = {}
    for r in batches:
        sizes.setdefault(r.batch, []).append(len(r.input_ids))
        assert sum(r.label) == 1.0 and len(r.label) == 3
    assert all(len(set(v)) == 1 for v in sizes.values())
    assert sorted(map(len, sizes.values()), reverse=True)[:-1] == [4] * (len(sizes) - 1)
    listed = dataset.batch_view(dataset.training_view(back, "train", 42, "diagnosis", "fl"), 4, 2).first()
    assert sorted(listed.label) == [0.0, 1.0]


def test_stage_is_reused_and_keyed(spark, tmp_path):
    root, key = str(tmp_path), stage.fingerprint("a", 1)
    first = stage.stage(spark.range(5), "t", key, root)
    again = stage.stage(spark.range(99), "t", key, root)
    other = stage.stage(spark.range(99), "t", stage.fingerprint("a", 2), root)
    assert (first.count(), again.count(), other.count()) == (5, 5, 99)


def test_an_unfinished_stage_is_written_again(spark, tmp_path):
    root, key = str(tmp_path), "k"
    stage.stage(spark.range(5), "t", key, root)
    (tmp_path / "t-k" / "_SUCCESS").unlink()
    assert stage.stage(spark.range(7), "t", key, root).count() == 7


def test_the_shared_folder_comes_from_the_session(spark):
    assert stage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
