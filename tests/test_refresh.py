import random
from decimal import Decimal

import pytest

from tests.helpers import day, make_tables, rows
from tests.test_progress import random_tables
from trendframe.operators.refresh import affected_works, change_log, current_rows, replace_by_key
from trendframe.plans.forecast import forecast, forecast_calendar, trend_refresh
from trendframe.schemas import REAL_CHANGE
from trendframe.sources import write_tables
from trendframe.streaming import trend_stream

JAN, FEB = day("2023-01-31"), day("2023-02-28")


def changes_of(spark, data):
    """Change rows from (seq, old row or None, new row or None) of the measurement table."""
    out = []
    for seq, old, new in data:
        image = new or (old[0], None, None, None, None)
        value = image[4]
        out.append((seq, old and old[1], *image[:4], None if value is None else Decimal(str(value))))
    return spark.createDataFrame(out, REAL_CHANGE)


def two_works(spark, real=()):
    return make_tables(
        spark, civil_work=[(1,), (2,), (3,)], schedule=[(10, 1), (20, 2), (30, 3)],
        qualitative_activity=[(100, 10, 1), (200, 20, 1), (300, 30, 1)], real_progress=list(real),
    )


A, B = (1, 100, 5, JAN, 10), (1, 200, 5, JAN, 10)


@pytest.mark.parametrize(
    "data, works",
    [
        ([(1, None, A)], [1]),
        ([(1, A, None)], [1]),
        ([(1, A, B)], [1, 2]),
        ([(1, None, A), (2, None, (2, 300, 5, JAN, 1)), (3, None, (3, 100, 5, FEB, 1))], [1, 3]),
        ([(1, None, (1, 999, 5, JAN, 1))], []),
        ([], []),
    ],
)
def test_affected_works(spark, data, works):
    t = two_works(spark)
    got = affected_works(changes_of(spark, data), t.qualitative_activity, t.schedule)
    assert [r[0] for r in rows(got, "id_civil_work")] == works


def test_replace_by_key(spark):
    current = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    fresh = spark.createDataFrame([(1, "d")], "k long, v string")
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    assert rows(replace_by_key(current, fresh, keys), "k") == [(1, "d"), (2, "c")]


def test_newest_entry_wins(spark):
    real = [A, (2, 100, 5, FEB, 1)]
    t = two_works(spark, real)
    moved = (1, 200, 5, JAN, 11)
    steps = [(1, A, (1, 100, 5, JAN, 20)), (2, (1, 100, 5, JAN, 20), moved), (3, real[1], None), (4, None, (3, 300, 6, FEB, 7))]
    log = change_log(changes_of(spark, steps))
    got = sorted((r[0], r[1], float(r[4])) for r in current_rows(t.real_progress, log).collect())
    assert got == [(1, 200, 11.0), (3, 300, 7.0)]


def test_pruning_never_shows_a_moved_row_at_its_old_place(spark):
    t = two_works(spark, [A])
    log = change_log(changes_of(spark, [(1, A, B)]))
    only = spark.createDataFrame([(100,)], "id_qualitative_activity long")
    cut = lambda df: df.join(only, "id_qualitative_activity", "left_semi")
    assert rows(current_rows(cut(t.real_progress), cut(log))) == []


def random_changes(rng, data, n, first_key, activities):
    """Changes to ``data["real_progress"]``, applied to it in place; (seq, old, new) triples."""
    real = {r[0]: r for r in data["real_progress"]}
    out, touched = [], rng.sample(sorted(activities), min(3, len(activities)))
    dates = [d for _, _, d in data["calendar"]]
    new_row = lambda key: (key, rng.choice(touched), 1, rng.choice(dates), Decimal(rng.randint(0, 500)) / 10)
    for i in range(n):
        key = rng.choice([first_key + i, *(k for k, r in real.items() if r[1] in touched)])
        old = real.pop(key, None)
        new = None if old and rng.random() < 0.4 else new_row(key)
        if new:
            real[key] = new
        out.append((i, old, new))
    data["real_progress"] = list(real.values())
    return out


def canonical(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


def test_rows_that_repeat_an_id_survive_a_change_to_another(spark, tmp_path):
    real = [A, A, (2, 100, 5, FEB, 1)]
    t = two_works(spark, real)
    log = change_log(changes_of(spark, [(1, real[2], (2, 100, 5, FEB, 1))]))
    got = sorted((r[0], r[1], float(r[4])) for r in current_rows(t.real_progress, log).collect())
    assert got == [(1, 100, 10.0), (1, 100, 10.0), (2, 100, 1.0)]
    # A change to the id itself replaces all rows that had it.
    log = change_log(changes_of(spark, [(1, A, (1, 100, 5, JAN, 7))]))
    got = sorted((r[0], r[1], float(r[4])) for r in current_rows(t.real_progress, log).collect())
    assert got == [(1, 100, 7.0), (2, 100, 1.0)]


@pytest.mark.parametrize("seed, broadcast", [(0, True), (1, False)])
def test_refresh_equals_a_full_recompute(spark, tmp_path, conf, seed, broadcast):
    if not broadcast:
        conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rng = random.Random(seed)
    data = random_tables(rng)
    before = make_tables(spark, **data)
    changes = changes_of(spark, random_changes(rng, data, 12, 1000, {a for a, _, _ in data["qualitative_activity"]}))
    after = make_tables(spark, **data)
    got = trend_refresh(forecast(before), changes, before, str(tmp_path))
    assert canonical(got) == canonical(forecast(after))


def test_stream_over_several_batches(spark, tmp_path):
    rng = random.Random(7)
    data = random_tables(rng)
    store, source = str(tmp_path / "store"), str(tmp_path / "changes")
    t = make_tables(spark, **data)
    activities = {a for a, _, _ in data["qualitative_activity"]}
    write_tables(t, f"{store}/tables")
    trend_stream.initialise(t, store, plan=forecast_calendar)
    for step in range(2):
        batch = changes_of(spark, random_changes(rng, data, 8, 1000 + 100 * step, activities))
        batch.coalesce(1).write.mode("append").parquet(source)
        query = trend_stream.start(
            trend_stream.change_stream(spark, source), t, store, plan=forecast_calendar, once=True
        )
        query.awaitTermination()
        want = canonical(forecast_calendar(make_tables(spark, **data)))
        assert canonical(trend_stream.results(spark, store)) == want
    # Compacted, the same results and measurements carry on in a new place.
    target = str(tmp_path / "compacted")
    moved = trend_stream.compact(t, store, target)
    assert canonical(trend_stream.results(spark, target)) == want
    assert canonical(forecast_calendar(moved)) == want
    # Going on there with the stream's position: nothing old is read again, and new changes are applied.
    go_on = lambda: trend_stream.start(
        trend_stream.change_stream(spark, source), moved, target, plan=forecast_calendar, once=True, checkpoint=f"{store}/checkpoint"
    ).awaitTermination()
    go_on()
    assert not (tmp_path / "compacted" / "log").exists()
    more = changes_of(spark, random_changes(rng, data, 8, 2000, activities))
    more.coalesce(1).write.mode("append").parquet(source)
    go_on()
    assert sorted(p.name for p in (tmp_path / "compacted" / "log").iterdir()) == ["batch_id=2"]
    assert canonical(trend_stream.results(spark, target)) == canonical(forecast_calendar(make_tables(spark, **data)))
    # A replay of the last batch changes nothing.
    trend_stream.apply_batch(batch, 1, t, store, plan=forecast_calendar)
    assert canonical(trend_stream.results(spark, store)) == want


def test_work_losing_its_last_rows_disappears(spark, tmp_path):
    from trendframe.sources.versioned import read_latest, write_version

    path = str(tmp_path)
    schema = spark.createDataFrame([], "k string, v long").schema
    put = lambda data, keys, batch: write_version(
        spark.createDataFrame(data, schema), spark.createDataFrame([(k,) for k in keys], "k string"), path, batch
    )
    put([("a", 1), ("a", 2), ("b", 3), (None, 4)], ["a", "b", None], -1)
    put([("b", 5)], ["a", "b"], 0)
    put([(None, 6), (None, 7)], [None], 1)
    read = lambda **kw: sorted(rows(read_latest(spark, path, schema, ["k"], **kw)), key=repr)
    assert read() == [("b", 5), (None, 6), (None, 7)]
    assert read(before=1) == [("b", 5), (None, 4)]
    assert read(before=0) == sorted([("a", 1), ("a", 2), ("b", 3), (None, 4)], key=repr)
    assert read(only=spark.createDataFrame([(None,)], "k string")) == [(None, 6), (None, 7)]
