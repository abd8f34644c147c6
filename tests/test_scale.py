"""What must hold when one key owns a large part of the rows, a span is a century long, a word has thousands of letters, or a run breaks off."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wardloom.functions import vocabulary
from wardloom.operators import attach, codes, dataset, history, tokens
from wardloom.plans import hot, ranges
from wardloom.sources import stage, tables


@pytest.fixture
def no_help(spark):
    """Neither broadcasts nor splitting at run time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def sizes(df):
    rows = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    return rows[-1], rows[len(rows) // 2]


def skewed(spark, n=40_000):
    """Four of ten rows have one code, the rest have 900; one in 50 has none."""
    code = F.when(F.col("id") % 50 == 49, None).when(F.col("id") % 10 < 4, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 900))
    return spark.range(n).select("id", code.alias("code"))


def lookup(spark):
    return spark.range(900).select(F.concat(F.lit("c"), "id").alias("code"), F.concat(F.lit("text "), "id").alias("text")).unionByName(
        spark.createDataFrame([("hot", "hot text")], "code string, text string")
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_a_hot_key_is_spread_and_nothing_else_changes(spark, no_help, how):
    rows, texts = skewed(spark), lookup(spark).where("code <> 'c7'")
    joined = hot.join_hot(rows, texts, ["code"], how)
    largest, median = sizes(joined)
    assert largest <= 2 * median
    assert sizes(rows.join(texts, ["code"], how))[0] > 3 * median  # what would happen otherwise
    assert sorted(map(str, joined.collect())) == sorted(map(str, rows.join(texts, ["code"], how).collect()))


def test_only_hot_keys_are_split(spark):
    assert hot.hot_keys(spark.range(10_000).select((F.col("id") % 5000).alias("k")), "k") == {}
    assert hot.hot_keys(spark.range(0).select("id"), "id") == {} == hot.hot_keys(spark.range(5).select(F.lit(None).cast("int").alias("k")), "k")
    found = hot.hot_keys(skewed(spark), "code")
    assert len(found) == 1 and min(found.values()) >= 0.4 * hot.FINENESS * 8


def test_equal_rows_of_a_hot_key_are_joined_once_each(spark):
    rows = spark.createDataFrame([("a", i % 2) for i in range(1000)], "k string, v int")
    assert hot.join_hot(rows, spark.createDataFrame([("a", 9)], "k string, w int"), ["k"]).count() == 1000


@pytest.mark.parametrize("most", [0, 1, 40, 10_000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_counted_lookups_are_whole_at_any_bound(spark, most, how):
    rows = skewed(spark, 4000)
    counts = lookup(spark).where("code <> 'c8'").join(rows.groupBy("code").agg(F.count("*").alias("n")), "code", "left").fillna(0, ["n"])
    joined = hot.join_counted(rows, counts, "code", "n", how, most)
    assert sorted(map(str, joined.collect())) == sorted(map(str, rows.join(counts.drop("n"), "code", how).collect()))
    assert counts.where(F.col("n") >= hot.least_count(counts, "n", most)).count() <= most


def test_code_joins_are_spread(spark, no_help):
    rows = skewed(spark)
    described = attach.describe_codes(rows.where("code IS NOT NULL").withColumnRenamed("code", "item"), {"item": lookup(spark)})
    largest, median = sizes(described)
    assert largest <= 2 * median
    versions = rows.where("code IS NOT NULL").select(F.col("id").alias("hadm_id"), "code", F.lit("10").alias("version"))
    walk = lookup(spark).select(F.col("code").alias("source"), F.col("text").alias("target"), F.lit(1).alias("ord"))
    largest, median = sizes(codes.convert_versions(versions, walk, "code", "version"))
    assert largest <= 2 * median


# --- ranges ------------------------------------------------------------------------------------------------------

DAY, YEAR = 86_400, 31_557_600


def test_a_century_makes_few_rows(spark):
    spans = spark.createDataFrame([(1, 0, 100 * YEAR), (2, 5, 5), (3, -YEAR, 1 << 40), (4, 9, 8), (5, None, 3)], "k long, a long, b long")
    for width in (1, 3600, DAY):
        rows = {r.k: r["count"] for r in ranges.slice_spans(spans, F.col("a"), F.col("b"), width).groupBy("k").count().collect()}
        assert set(rows) == {1, 2, 3} and max(rows.values()) <= ranges.RADIX and rows[2] == 1


@pytest.mark.parametrize("width", [1, 977, DAY])
@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_points_meet_each_span_once(spark, width, kind):
    rng = random.Random(width)
    spans = []
    for i in range(120):
        first = rng.randrange(-YEAR, 40 * YEAR)
        spans.append((i, rng.randrange(12), first, first + int(10 ** rng.uniform(0, 9.5)) - 2))
    points = [(i, rng.randrange(14), rng.choice([None, rng.randrange(-YEAR, 60 * YEAR)])) for i in range(400)]
    points += [(1000 + i, s[1], at) for i, s in enumerate(spans) for at in (s[2], s[3], s[2] - 1, s[3] + 1)]
    got = ranges.join_points_to_spans(
        spark.createDataFrame(points, "p int, k int, at long").withColumn("k", F.col("k").cast(kind)), spark.createDataFrame(spans, "s int, k long, a long, b long").withColumn("k", F.col("k").cast("string" if kind == "string" else "long")),
        "k", F.col("at"), F.col("a"), F.col("b"), width,
    )
    wanted = sorted((p, s) for p, k, at in points for s, j, a, b in spans if k == j and at is not None and a <= at <= b)
    assert sorted((r.p, r.s) for r in got.collect()) == wanted


def test_no_spans_and_no_points(spark):
    spans, points = spark.createDataFrame([(1, 0, 9)], "k long, a long, b long"), spark.createDataFrame([(1, 5)], "k long, at long")
    for p, s in ((points, spans.limit(0)), (points.limit(0), spans), (points.withColumn("k", F.lit(7).cast("long")), spans)):
        assert ranges.join_points_to_spans(p, s, "k", F.col("at"), F.col("a"), F.col("b"), 10).collect() == []


def test_one_wrong_stay_does_not_multiply_other_events(spark):
    """Events of keys without long spans are dealt to one slice each."""
    start = datetime(2020, 1, 1)
    stays = [(k, k, start, 3000) for k in range(300)] + [(300, 300, start, 60 * 24 * 36_500)]
    cohort = spark.createDataFrame(stays, "stay_id long, hadm_id long, intime timestamp, outtime_min int")
    rows = spark.createDataFrame([(i, i % 301, start + timedelta(minutes=i % 2000)) for i in range(3010)], "e long, hadm_id long, at timestamp")
    joined = attach.attach_by_admission(rows, cohort, "at")
    assert joined.count() == 3010
    plan = joined._jdf.queryExecution().toString()
    assert "_slice" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


# --- history -----------------------------------------------------------------------------------------------------


def test_a_hot_stay_is_cut_in_parts_first(spark):
    events = spark.range(20_000).select(F.when(F.col("id") % 10 < 4, 0).otherwise(F.col("id") % 500).alias("stay_id"), (F.col("id") * 7919 % 20_000).alias("time_min"), "id")
    cut = history.latest_events(events, 8191, ("time_min", "id"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(stay_id" in plan and ", _part" in plan.split("hashpartitioning(stay_id")[-1].split(")")[0]
    for count in (1, 3, 700, 8191):
        got = {}
        for r in history.latest_events(events, count, ("time_min", "id")).collect():
            got.setdefault(r.stay_id, []).append((r.event_no, r.id))
        for stay, rows in ((0, [i for i in range(20_000) if i % 10 < 4 or i % 500 == 0]), (7, [i for i in range(20_000) if i % 500 == 7 and i % 10 >= 4])):
            order = sorted(rows, key=lambda i: (i * 7919 % 20_000, i), reverse=True)[:count]
            assert sorted(got[stay]) == list(enumerate(order, 1))


# --- word pieces -------------------------------------------------------------------------------------------------


def test_a_start_asks_only_while_its_prefix_exists(spark):
    entries = [(w, i) for i, w in enumerate(["a", "##a", "##ab", "abcdefghijklmnopqrstuvwxyz", "##" + "b" * 40, "##b", "b", "##"])]
    vocab = spark.createDataFrame(entries, "token string, id int")
    words = spark.createDataFrame([(b"1", "a" * 5000), (b"2", "zzzz"), (b"3", "ab" * 40), (b"4", "")], "key binary, word string")
    rows = {bytes(r.key): r["count"] for r in vocabulary.spans(words, vocab).groupBy("key").count().collect()}
    assert rows[b"1"] == 5000 and rows[b"2"] == 4  # no entry goes on after one letter
    assert rows[b"3"] < 80 + 2 * 80 and b"4" not in rows
    assert vocabulary.spans(words, vocab.limit(0)).count() == 0


@pytest.mark.parametrize("most", [0, 20])
def test_pieces_are_the_same_whichever_entries_are_sent(spark, monkeypatch, most):
    monkeypatch.setattr(vocabulary, "MOST_ENTRIES", most)
    test_pieces_equal_a_greedy_loop(spark, 5)


def test_files_that_keep_the_tasks_busy_are_read_where_they_are(spark, tmp_path):
    for name, files in (("many", 8), ("one", 1)):
        spark.range(800).repartition(files).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, parts, dealt in (("many", 4, False), ("many", 64, True), ("one", 4, True)):
        found = tables.read_table(spark, str(tmp_path), name, partitions=parts)
        assert ("Exchange" in found._jdf.queryExecution().executedPlan().toString()) == dealt
        assert found.count() == 800


@pytest.mark.parametrize("seed", range(4))
def test_pieces_equal_a_greedy_loop(spark, seed):
    rng = random.Random(seed)
    entries = {"".join(rng.choices("abé", k=rng.randint(1, 11))) for _ in range(60)} | {"##" + "".join(rng.choices("abé", k=rng.randint(0, 9))) for _ in range(60)} | {"##", "##a"}
    vocab = {w: i for i, w in enumerate(sorted(entries))}
    words = ["".join(rng.choices("abé#", weights=[6, 6, 3, 1], k=rng.randint(1, 40))) for _ in range(300)] + ["a" * 3000]

    def greedy(word):
        if word in vocab:
            return [vocab[word]]
        at, ids = 0, []
        while at < len(word):
            end = next((e for e in range(len(word), at, -1) if ("##" if at else "") + word[at:e] in vocab), None)
            if end is None:
                return [-1]
            ids.append(vocab[("##" if at else "") + word[at:end]])
            at = end
        return ids

    table = spark.createDataFrame(list(vocab.items()), "token string, id int")
    found = {r.word: (r.ids, r.n) for r in vocabulary.word_table(spark.createDataFrame([(w,) for w in words] + [(words[0],), (None,)], "word string"), table, -1).collect()}
    assert set(found) == set(words) and found[words[0]][1] == words.count(words[0]) + 1
    assert {w: found[w][0] for w in words} == {w: greedy(w) for w in words}


# --- data set ----------------------------------------------------------------------------------------------------


def _small_set(spark, n):
    packed = spark.range(n).selectExpr("id as stay_id", "array(cast(id as int)) as fl")
    cohort = spark.range(n).selectExpr("id as stay_id", "id as patient_id", "case when id % 3 > 0 then '' end as name", "array(cast(id as int), null) as diagnosis", "id / 3 as los", "timestamp'2020-01-01 01:02:03' as intime")
    return packed, dataset.split_patients(cohort, [42, 7], 0.2)


def test_a_broken_write_leaves_the_old_set(spark, tmp_path):
    dest = str(tmp_path / "set")
    with pytest.raises(Exception):
        dataset.write_dataset(*_small_set(spark, 5), dest, {"target": spark.range(3)})  # a dictionary without its columns
    with pytest.raises(Exception):
        dataset.read_dataset(spark, dest)  # nothing was published
    classes = spark.createDataFrame([(0, "a")], "index int, name string")
    dataset.write_dataset(*_small_set(spark, 20), dest, {"target": classes})
    with pytest.raises(Exception):
        dataset.write_dataset(*_small_set(spark, 30), dest, {"target": spark.range(3)})
    assert dataset.read_dataset(spark, dest).count() == 20 == dataset.read_cohort(spark, dest).count()
    assert dataset.read_classes(spark, dest, "target").count() == 1
    dataset.write_dataset(*_small_set(spark, 7), dest)
    assert dataset.read_dataset(spark, dest).count() == 7


@pytest.mark.parametrize("split", [None, "split_42"])
def test_records_are_written_by_tasks_of_bounded_size(spark, tmp_path, monkeypatch, split):
    """Tasks follow the number of records, not their bytes in a shuffle."""
    monkeypatch.setattr(dataset, "RECORDS", 50)
    dest = str(tmp_path / "set")
    dataset.write_dataset(*_small_set(spark, 1500), dest, split=split)
    written = dataset.read_dataset(spark, dest)
    tasks = {re.search(r"part-(\d+)", r[0]).group(1) for r in written.select(F.input_file_name()).distinct().collect()}
    assert written.count() == 1500 and len(tasks) >= 20


def test_the_cohort_is_read_back_as_it_was(spark, tmp_path):
    dest = str(tmp_path / "set")
    packed, cohort = _small_set(spark, 20)
    dataset.write_dataset(packed, cohort, dest)
    back = dataset.read_cohort(spark, dest)
    assert back.dtypes == cohort.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, cohort.collect()))


def test_files_are_laid_out_by_every_split(spark, tmp_path):
    dest = str(tmp_path / "set")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dataset.write_dataset(*_small_set(spark, 4000), dest)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = dataset.read_dataset(spark, dest).select(F.input_file_name().alias("f"), "split_42", "split_7").distinct().collect()
    files = {r.f for r in rows}
    for seed in ("split_42", "split_7"):
        assert len({r.f for r in rows if r[seed] == "test"}) < len(files)


# --- stages and broken lines --------------------------------------------------------------------------------------


def test_only_changed_buckets_are_computed(spark, tmp_path):
    computed = []

    def compute(rows):
        computed.append(sorted(r.k for r in rows.collect()))
        return rows.where("k <> 3").withColumn("twice", F.col("v") * 2)

    def kept(rows, key="x"):
        table = stage.stage_by_bucket(rows, ["k"], compute, "s", key, 64, str(tmp_path))
        return sorted(map(tuple, table.collect()))

    rows = spark.range(200).select(F.col("id").alias("k"), F.col("id").alias("v"))
    wanted = [(i, i, 2 * i) for i in range(200) if i != 3]
    assert kept(rows) == wanted and len(computed[-1]) == 200
    assert kept(rows.repartition(7)) == wanted and computed[-1] == []
    more = rows.unionByName(spark.createDataFrame([(500, 1), (3, 9)], "k long, v long"))
    assert kept(more) == sorted([*wanted, (500, 1, 2)])
    assert {3, 500} <= set(computed[-1]) and len(computed[-1]) < 30
    less = rows.where("k <> 5")
    assert kept(less) == [w for w in wanted if w[0] != 5] and len(computed[-1]) < 30
    assert len(stage.sweep_parts(spark, "s", "x", 64, str(tmp_path))) >= 2 and stage.sweep_parts(spark, "s", "x", 64, str(tmp_path)) == []
    assert kept(less) == [w for w in wanted if w[0] != 5] and computed[-1] == []
    assert kept(rows.where("k = 3")) == [] and kept(rows.limit(0)) == []
    assert kept(rows, "other") == wanted


def test_a_broken_stage_keeps_its_old_state(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    stage.stage_by_bucket(rows, ["k"], lambda r: r, "s", "x", 8, str(tmp_path))
    bad = F.when(F.col("k") == 5, F.raise_error(F.lit("no"))).otherwise(F.lit(2))
    with pytest.raises(Exception):
        stage.stage_by_bucket(rows.withColumn("v", F.lit(2)), ["k"], lambda r: r.withColumn("v", bad), "s", "x", 8, str(tmp_path))
    assert {r.v for r in stage.stage_by_bucket(rows, ["k"], lambda r: r, "s", "x", 8, str(tmp_path)).collect()} == {1}


def test_lines_with_other_numbers_of_fields_are_set_aside(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "t.csv").write_text('a,b,_line\n1,x,p\n2,y\n3,"z, ""q""",r,more\n4,"u, v",s\nbad,w,t\n')
    (root / "n.csv").write_text("a,b\n")
    found = tables.read_checked(spark, str(root), "t", "a int")
    assert {tuple(r) for r in found.rows.collect()} == {(4, "u, v", "s"), (1, "x", "p"), (None, "w", "t")}
    assert {r.line for r in found.broken.collect()} == {"2,y", '3,"z, ""q""",r,more'}
    assert all(r.file.endswith("t.csv") for r in found.broken.collect())
    none = tables.read_checked(spark, str(root), "n")
    assert none.rows.count() == 0 and none.broken.count() == 0
    counts = tables.set_aside({"t": found.broken, "n": none.broken}, str(tmp_path / "aside"))
    assert [tuple(r) for r in counts.collect()] == [("t", 2)]
