"""Refreshing by signed daily sums, and change rows from two versions of a table."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import day, make_tables
from tests.test_plans import plan_of, scans
from tests.test_progress import random_tables
from tests.test_refresh import canonical, random_changes
from trendframe.operators.deltas import REAL_COLUMNS, changes_between, daily_deltas, signed_rows
from trendframe.plans import frame as frames
from trendframe.plans.forecast import forecast
from trendframe.schemas import CHANGE_IMAGES, TABLES
from trendframe.streaming import delta_stream
from trendframe.streaming.delta_stream import refresh_by_deltas

JAN, FEB = day("2023-01-31"), day("2023-02-28")


def decimals(row):
    return row and (*row[:4], None if row[4] is None else Decimal(str(row[4])))


def images(spark, data):
    """Change rows from (seq, old row or None, new row or None)."""
    return spark.createDataFrame([(s, decimals(old), decimals(new)) for s, old, new in data], CHANGE_IMAGES)


def real(spark, rows):
    return spark.createDataFrame([decimals(r) for r in rows], TABLES["real_progress"])


def test_deltas_are_signed_sums(spark):
    a, b = (1, 100, 5, JAN, 10), (2, 100, 5, JAN, None)
    data = [(1, None, a), (2, a, (1, 100, 5, FEB, 7)), (3, None, b), (4, None, (3, 200, 5, None, 1)), (5, (4, 300, 5, JAN, 2), None)]
    got = {(r[0], r.period): (r.fraction, r.percentage, r.n_foreseen, r.n_real, r.n_measured) for r in daily_deltas(images(spark, data)).collect()}
    assert got == {
        (100, JAN): (None, 0, 0, 1, 0), (100, FEB): (None, 70_000, 0, 1, 1), (300, JAN): (None, -20_000, 0, -1, -1),
    }
    assert daily_deltas(images(spark, [])).count() == 0


def apply_multiset(old, changes):
    """The rows of a version after change rows."""
    rows = Counter(map(tuple, old))
    for before, after, weight in changes:
        if before:
            rows[tuple(before)] -= weight
        if after:
            rows[tuple(after)] += weight
    assert min(rows.values(), default=0) >= 0
    return +rows


@pytest.mark.parametrize("seed", range(3))
def test_changes_between_versions_lead_from_one_to_the_other(spark, seed):
    """Also with rows that repeat, ids that repeat, null ids and null values."""
    rng = random.Random(seed)
    row = lambda: (rng.choice([None, *range(12)]), rng.choice([None, 1, 2]), 5, rng.choice([JAN, FEB, None]), rng.choice([None, 1, 2]))
    kept = [row() for _ in range(20)]
    old, new = kept + [row() for _ in range(15)], kept + [row() for _ in range(12)] + kept[:3]
    found = changes_between(real(spark, old), real(spark, new)).collect()
    assert apply_multiset([decimals(r) for r in old], found) == Counter(decimals(r) for r in new)
    for r in found:
        assert r.weight > 0 and (r.before or r.after) and r.before != r.after
        if r.before and r.after:
            assert r.before[0] == r.after[0] and r.weight == 1
    assert changes_between(real(spark, old), real(spark, rng.sample(old, len(old)))).count() == 0
    signed = signed_rows(changes_between(real(spark, []), real(spark, old)))
    assert signed.agg(F.sum("weight")).first()[0] == len(old)


def test_an_id_with_one_row_on_each_side_is_one_change(spark):
    a, moved, twice = (1, 100, 5, JAN, 10), (1, 200, 5, JAN, 11), (2, 100, 5, JAN, 1)
    found = changes_between(real(spark, [a, twice, twice]), real(spark, [moved, (2, 100, 5, JAN, 3)])).collect()
    assert sorted(((r.before and tuple(r.before)[:2], r.after and tuple(r.after)[:2], r.weight) for r in found), key=repr) == [
        ((1, 100), (1, 200), 1), ((2, 100), None, 2), (None, (2, 100), 1),
    ]


def test_whole_versions_are_shuffled_once_and_a_hot_id_is_no_hot_key(spark, monkeypatch, conf):
    from trendframe.operators import deltas

    conf(spark__sql__adaptive__enabled="false")
    rows = spark.range(30_000).select(
        F.lit(7).cast("long").alias(REAL_COLUMNS[0]), F.col("id").alias(REAL_COLUMNS[1]), F.lit(1).cast("long").alias(REAL_COLUMNS[2]),
        F.lit(JAN).alias(REAL_COLUMNS[3]), F.lit(1).cast("decimal(9,4)").alias(REAL_COLUMNS[4]),
    )
    plans, keep = [], deltas.stored
    monkeypatch.setattr(deltas, "stored", lambda df, name: plans.append(df) or keep(df, name))
    found = changes_between(rows, rows.filter(F.col(REAL_COLUMNS[1]) % 3 > 0))
    assert found.agg(F.sum("weight")).first()[0] == 10_000
    (difference,) = plans
    assert plan_of(difference).count("Exchange hashpartitioning") == 1
    sizes = difference.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 5000  # one id, dealt by the whole row


def steps(rng, data, n, first_key):
    return random_changes(rng, data, n, first_key, {a for a, _, _ in data["qualitative_activity"]})


@pytest.mark.parametrize("seed, broadcast", [(0, True), (1, False), (2, True)])
def test_refresh_equals_a_full_recompute(spark, tmp_path, conf, seed, broadcast):
    if not broadcast:
        conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rng = random.Random(seed)
    data = random_tables(rng)
    store = str(tmp_path / "store")
    before = make_tables(spark, **data)
    delta_stream.initialise(before, store, buckets=3)
    assert canonical(delta_stream.results(spark, store)) == canonical(forecast(before))
    changes = images(spark, steps(rng, data, 12, 1000))
    after = make_tables(spark, **data)
    assert canonical(refresh_by_deltas(changes, store, str(tmp_path / "refresh"))) == canonical(forecast(after))
    # The store is as it was, and changes found by comparing versions give the same.
    found = changes_between(before.real_progress, after.real_progress)
    assert canonical(refresh_by_deltas(found, store, str(tmp_path / "again"))) == canonical(forecast(after))


def test_stream_replays_and_compaction(spark, tmp_path):
    """A batch that was applied but not ticked off comes again, before and after the store is compacted."""
    rng = random.Random(7)
    data = random_tables(rng)
    store, source, target = (str(tmp_path / name) for name in ("store", "changes", "compacted"))
    delta_stream.initialise(make_tables(spark, **data), store)
    go_on = lambda where: delta_stream.start(
        delta_stream.change_stream(spark, source), where, once=True, checkpoint=f"{store}/checkpoint"
    ).awaitTermination()
    for k in range(2):
        batch = images(spark, steps(rng, data, 8, 1000 + 100 * k))
        batch.coalesce(1).write.mode("append").parquet(source)
        go_on(store)
        want = canonical(forecast(make_tables(spark, **data)))
        assert canonical(delta_stream.results(spark, store)) == want
    delta_stream.apply_batch(batch, 1, store)
    assert canonical(delta_stream.results(spark, store)) == want
    # A third batch is begun, but does not get as far as the ledger: its deltas are not part of the compacted state.
    late = images(spark, steps(rng, data, 8, 2000))
    frame, buckets = frames.read_frame(spark, f"{store}/frame")
    delta_stream.write_deltas(late, frame, buckets, store, 2)
    delta_stream.compact(spark, store, target)
    assert canonical(delta_stream.results(spark, target)) == want
    delta_stream.apply_batch(batch, 1, target)  # contained in that state already
    assert canonical(delta_stream.results(spark, target)) == want
    late.coalesce(1).write.mode("append").parquet(source)
    go_on(target)
    delta_stream.apply_batch(late, 2, target)
    assert canonical(delta_stream.results(spark, target)) == canonical(forecast(make_tables(spark, **data)))


def many_works(spark, works, days=3):
    dates = [day(f"2023-0{m}-28") for m in range(1, days + 1)]
    return make_tables(
        spark, civil_work=[(w,) for w in range(works)], schedule=[(w, w) for w in range(works)],
        term=[(w, w, w) for w in range(works)], term_input_data=[(w, w) for w in range(works)],
        calendar=[(10 * w + k, w, x) for w in range(works) for k, x in enumerate(dates)],
        qualitative_activity=[(10 * w, w, 1) for w in range(works)],
        foreseen_progress=[(10 * w, x, "0.3") for w in range(works) for x in dates],
        real_progress=[(w, 10 * w, w, dates[0], 10) for w in range(works)], term_activity=[(w, w) for w in range(works)],
    )


def test_a_batch_reads_no_fact_and_the_buckets_of_touched_works_only(spark, tmp_path, monkeypatch):
    """One work in a hundred, spread over the ids: pruning at run time opens few folders of each stored table."""
    t, store = many_works(spark, 300), str(tmp_path / "store")
    delta_stream.initialise(t, store, buckets=64)
    touched = [17, 120, 263]
    changes = images(spark, [(w, (w, 10 * w, w, day("2023-01-28"), 10), (w, 10 * w, w, day("2023-02-28"), 20)) for w in touched])
    frame, buckets = frames.read_frame(spark, f"{store}/frame")
    plans, keep = [], delta_stream.stored
    monkeypatch.setattr(delta_stream, "stored", lambda df, name: plans.append(df) or keep(df, name))
    fresh, works = delta_stream.refreshed(changes, frame, buckets, str(tmp_path / "refresh"), 0)
    (daily,) = plans
    assert {r[0] for r in works.select("id_civil_work").collect()} == set(touched) == {r.id_civil_work for r in fresh.collect()}
    for df in (daily, fresh):
        plan = plan_of(df)
        assert "dynamicpruning" in plan and not scans(plan, "progress_date") and not scans(plan, "id_term_date")
    daily.collect()
    assert files_read(daily._jdf.queryExecution().executedPlan(), "daily") <= 3 * 4 < frame.daily.select(F.input_file_name()).distinct().count()


def files_read(node, name):
    """Files read by the scans of one stored table, counted as they ran."""
    own = 0
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return files_read(node.executedPlan(), name)
    if node.getClass().getSimpleName().endswith("QueryStageExec"):
        return files_read(node.plan(), name)
    if node.getClass().getSimpleName() == "FileSourceScanExec" and f"/{name}" in node.relation().location().rootPaths().toString():
        own = node.metrics().get("numFiles").get().value()
    children = node.children()
    return own + sum(files_read(children.apply(i), name) for i in range(children.size()))


def test_a_hot_work_is_spread_over_files(spark, tmp_path, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    t = many_works(spark, 4)
    hot = spark.range(2000).select((F.col("id") + 1000).alias("id_qualitative_activity"), F.lit(1).cast("long").alias("id_schedule"), F.lit(1).alias("outline_lvl"))
    facts = hot.select("id_qualitative_activity", F.lit(JAN).alias("id_term_date"), F.lit("0.000001").cast("decimal(9,6)").alias("foreseen_fraction"))
    t = type(t)(**{**t.__dict__, "qualitative_activity": t.qualitative_activity.unionByName(hot), "foreseen_progress": t.foreseen_progress.unionByName(facts)})
    frames.write_frame(frames.frame(t), str(tmp_path / "frame"), 2)
    daily = frames.read_frame(spark, str(tmp_path / "frame"))[0].daily.filter("id_civil_work = 1")
    sizes = daily.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in sizes) == 2003 and max(r["count"] for r in sizes) < 1200


def test_a_frame_has_few_files_per_bucket(spark, tmp_path, conf):
    """Files are as many as buckets and tasks together, not their product, and small tables are written by several tasks."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="16")
    frames.write_frame(frames.frame(many_works(spark, 300)), str(tmp_path / "frame"), 40)
    for name in frames.SCHEMAS:
        files = list((tmp_path / "frame" / name).rglob("*.parquet"))
        assert len(files) <= 40 + 16 and len({f.parent for f in files}) == 40, name
    conf(spark__sql__adaptive__coalescePartitions__enabled="true")
    frames.write_frame(frames.frame(many_works(spark, 40)), str(tmp_path / "small"), 40)
    for name in frames.SCHEMAS:
        assert len({f.name[:10] for f in (tmp_path / "small" / name).rglob("*.parquet")}) > 4, name
