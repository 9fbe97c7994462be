"""Mining against all pairs; the curve, the bounds, and which folders are read."""

import duckdb
import numpy as np
import pytest

from trendframe.llm import hard_negatives as hn
from trendframe.llm.queries import OP13_SQL, op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, q string, rank string, window string, folder string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    kept = [
        (i, [int(np.floor(scale * np.float64(np.float32(x)))) for x in v], lab)
        for i, v, lab in rows
        if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (i, q, lab) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = [(score(q, v), j, b != a and lab == m, lab != m) for b, (j, v, m) in enumerate(kept)]
        for s, p, *_ in sorted((r for r in scores if r[2]), key=order)[:positives]:
            fit = sorted((r for r in scores if r[3] and low * s <= 100 * r[0] <= high * s), key=order)[:negatives]
            out += [(i, p, k + 1, j, s, t) for k, (t, j, *_) in enumerate(fit)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = hn.mine(hn.quantised(table(spark, rows)), **options)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()), key=str)


def vectors(seed, n, dims=8, labels=3, copies=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims))
    x[:copies] = x[0]
    return [(int(i), [float(v) for v in row], int(lab)) for i, (row, lab) in enumerate(zip(x, r.integers(0, labels, n), strict=True))]


@pytest.mark.parametrize("seed,dims,copies", [(1, 8, 0), (2, 3, 120), (3, 1, 0), (4, 40, 30)])
def test_equals_all_pairs(spark, monkeypatch, seed, dims, copies):
    """With small blocks and waves, so that there are many of both."""
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "WAVE_ROWS", 9)
    rows = vectors(seed, 300, dims, copies=copies)
    assert mined(spark, rows, every=20) == plain(rows, every=20)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        *vectors(5, 60, 4, 2), *vectors(5, 30, 4, 2), (None, [1.0, 1.0, 1.0, 1.0], 0), (None, [1.0, 1.0, 1.0, 1.0], 1), (7, None, 1), (8, [1.0, None, 0.0, 0.0], 1),
        (9, [nan, 0.0, 0.0, 0.0], 1), (10, [inf, 0.0, 0.0, 0.0], 0), (11, [1.0, 0.0, 0.0, 0.0], None), (100, [], 1), (200, [2.0], 1), (-100, [0.5, 0.5], 0),
        (300, [1.0, 1.0, 1.0, 1.0], 99), (2**62, [1.0, 0.0, 0.0, 3.0], 1),
    ]
    assert mined(spark, rows, every=10) == plain(rows, every=10)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0)], [(100, [1.0], 0)], [(100, [1.0], None)], [(0, [], 0), (1, [], 0), (2, [], 1)]])
def test_hardly_any_rows(spark, rows):
    assert mined(spark, rows) == plain(rows)


def test_anchors_that_are_one_hot_id(spark, monkeypatch):
    monkeypatch.setattr(hn, "WAVE_ROWS", 10)
    rows = vectors(6, 90, 4, 2) + [(100, v, lab) for _, v, lab in vectors(7, 45, 4, 2)]
    assert mined(spark, rows) == plain(rows)


def test_scores_beyond_exact_sums_are_refused(spark):
    with pytest.raises(ValueError, match="2\\*\\*53"):
        mined(spark, [(0, [1e9], 0), (1, [1e9], 0)])
    rows = [(0, [3e3, 2e3], 0), (1, [3e3, -1.0], 0), (2, [2e3, 5.0], 1)]
    assert mined(spark, rows) == plain(rows) != []


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (5, 1), (1, 4)])
def test_neighbours_on_the_curve_differ_by_one_step(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = hn.hilbert_keys(grid, bits)
    along = grid[sorted(range(len(grid)), key=keys.__getitem__)]
    assert len(set(keys)) == len(grid) and (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    r = np.random.default_rng(8)
    anchors, block = r.integers(-50, 50, (20, 6)), r.integers(-50, 50, (30, 6))
    wave = hn._Wave(np.arange(20), np.arange(20), np.zeros(20), anchors.astype(np.float64), np.zeros(20), None, None, 5, True)
    least, most = wave.reach(block.min(axis=0)[None].astype(float), block.max(axis=0)[None].astype(float))
    scores = anchors @ block.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()


def test_zone_maps_choose_few_blocks_of_clustered_vectors(spark, monkeypatch):
    """Ten far clusters: an anchor's windows need the blocks of its own cluster only, and only their folders are opened."""
    monkeypatch.setattr(hn, "BLOCK_ROWS", 20)
    r = np.random.default_rng(9)
    centres = np.eye(10) * 10
    rows = [(i, [float(x) for x in centres[i % 10] + r.normal(size=10) * 0.1], int(r.integers(0, 2))) for i in range(2000)]
    found = hn.quantised(table(spark, rows))
    shape, n = hn._shape(found)
    blocks = hn.write_blocks(found, shape, n)
    anchors = hn._anchors(blocks, shape, 500).drop("wave").toArrow()
    assert len(anchors) == 4  # of cluster 0 all
    wave = hn._Wave.of(anchors, shape, 5)
    wave.floor[:] = 50 * 256 * 256
    sent = spark.sparkContext.broadcast(wave)
    chosen = hn.chosen_blocks(blocks, shape, sent)
    total, few = blocks.count(), chosen.count()
    assert 0 < few <= total / 5
    joined = hn.only(blocks, hn.stored(chosen, "chosen"))
    assert "dynamicpruning" in joined._jdf.queryExecution().toString()
    read = {f for f, in joined.select("folder").distinct().collect()}
    assert len(read) < blocks.select("folder").distinct().count()


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = duckdb.sql(OP13_SQL)
    got = op13_hard_negatives(spark, sf).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall()) and got
