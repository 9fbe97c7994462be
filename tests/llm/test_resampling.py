"""Weights against a plain version, exact selection, separation on labelled documents, awkward rows."""

import math
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import awkward, make_docs, prose
from trendframe.llm import resampling
from trendframe.llm.queries import op9_resampling

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_weights_follow_the_definition(spark):
    texts = {1: "a b c a", 2: "c c c c", 3: "a b", 4: None}
    docs = make_docs(spark, [(i, t, None, None) for i, t in texts.items()])
    ratios = resampling.log_ratios(docs, {1, 3})
    raw, target = Counter(), Counter()
    for i, t in texts.items():
        for b in resampling.buckets(t or "").tolist():
            raw[b] += 1
            target[b] += i in (1, 3)
    n, m = sum(raw.values()), sum(target.values())
    for b in raw:
        base = (raw[b] + 1) / (n + resampling.BUCKETS)
        assert ratios[b] == pytest.approx(math.log(0.5 * base + 0.5 * target[b] / m) - math.log(base))
    weighed = resampling.weigh(docs, ratios, {2: 0}, ["w", "s", "label"]).collect()
    for r in weighed:
        grams = resampling.buckets(r.text or "")
        assert r.w == pytest.approx(resampling.SHARPNESS * sum(ratios[g] for g in grams) / (len(grams) + resampling.PRIOR_GRAMS))
        assert r.label == (0 if r.doc_id == 2 else None)


def test_repeated_words_share_a_bucket():
    assert resampling.buckets("x x")[-1] == resampling.buckets("Yy yY")[-1] and len(resampling.buckets("")) == 0
    assert resampling.buckets("x. x.").tolist()[-2:] == resampling.buckets("y! y!").tolist()[-2:]


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_kth_greatest(spark, bins):
    r = np.random.default_rng(1)
    values = [int(x) for x in r.integers(-(2**40), 2**40, 300)] + [5] * 50 + [-(2**62), 2**62]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 140, 352):
        assert resampling.kth_greatest(df, "v", k, bins) == ordered[k - 1]


def test_best_cut():
    w = np.array([1.0, 2, 3, 10, 11, 12])
    assert resampling.best_cut(w, np.array([0, 0, 0, 1, 1, 1]) == 1) == 6.5
    assert resampling.best_cut(w, np.ones(6, bool)) == -np.inf == resampling.best_cut(w, np.zeros(6, bool))
    assert resampling.best_cut(np.array([1.0, 1.0]), np.array([True, False])) == -np.inf


def test_sums_are_gumbel_top_k(spark):
    """With equal weights, every document is kept equally often; a greater weight is kept more often."""
    docs = make_docs(spark, [(i, f"text {i}", None, None) for i in range(4000)])
    rows = resampling.weigh(docs, np.zeros(resampling.BUCKETS), {}, ["w", "s", "label"]).collect()
    noise = np.array([r.s for r in rows]) * resampling.UNIT
    assert abs(noise.mean() - 0.5772) < 0.1 and abs(noise.var() - math.pi**2 / 6) < 0.2


def test_good_documents_stay_and_bad_ones_go(spark):
    """Half of the labelled documents are junk, in the ways the data has."""
    rows, labels = [], []
    for i in range(400):
        text = prose(i, 40 + i % 50)
        junk = i % 4 == 0
        if junk:
            text = [" | ".join(text.split()), text.upper().replace(" ", "!! "), " ".join([text.split()[0]] * 60), text.replace(" ", "### ")][i // 4 % 4]
        rows.append((i, text, "en", "s"))
        if i % 2 == 0:
            labels.append((i, int(not junk), 0))
    kept = {r.doc_id: r.kept for r in resampling.classify(make_docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    good = [kept[i] for i in range(400) if i % 4]
    bad = [kept[i] for i in range(400) if i % 4 == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_every_held_out_id_counts_once_however_often_it_is_repeated(spark, monkeypatch):
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(200)], LABELS)
    _, held_out = resampling.labelled(labels)
    hot = next(i for i, good in held_out.items() if good)
    rows = [(i, prose(i, 50) if i % 2 == 0 else "junk " * 50, None, None) for i in range(200)]
    cuts = []
    monkeypatch.setattr(resampling, "HELD_OUT", 1)
    monkeypatch.setattr(resampling, "best_cut", lambda w, good: cuts.append((len(w), int(good.sum()))) or -np.inf)
    resampling.classify(make_docs(spark, [rows[hot]] * 100 + rows), labels)
    assert cuts == [(len(held_out), sum(held_out.values()))]


def test_labelled_documents(spark):
    got = op9_resampling(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.95 and got[got.quality == 0].kept.mean() < 0.1


def test_awkward_rows(spark):
    rows = awkward()
    docs = make_docs(spark, rows)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (8, None, 0), (9, 1, None), (10, 0, 0)], LABELS)
    for some in (labels, labels.limit(0)):
        got = resampling.classify(docs, some).collect()
        assert len(got) == len(rows) and {type(r.kept) for r in got} == {bool}
        again = {(r.doc_id, r.sampling_sum) for r in resampling.classify(docs.repartition(5), some).collect()}
        assert again == {(r.doc_id, r.sampling_sum) for r in got}
        kept = resampling.keep(docs, some)
        assert kept.schema == docs.schema and kept.count() == sum(r.kept for r in got)
    assert 0.0 in [r.log_weight for r in got if r.doc_id == 3]
    assert resampling.classify(make_docs(spark, []), labels).count() == 0
    assert resampling.keep(make_docs(spark, []), labels).count() == 0


def mixed_quality(n):
    """Texts with more and more junk in them; the label turns bad half-way, with some noise."""
    rows, labels = [], []
    for i in range(n):
        words = prose(i, 30).split()
        junk = (i * 7919) % n / n
        text = " ".join(w if (k * 31 + i) % 100 >= 100 * junk else "###" for k, w in enumerate(words))
        rows.append((i, text, "en", "s"))
        if i % 2 == 0:
            labels.append((i, int(junk + (i % 5 - 2) * 0.1 < 0.5), 0))
    return rows, labels


def test_kept_documents_are_a_gumbel_top_k_of_tempered_weights(spark, monkeypatch):
    """The set is that of a plain draw, it is no threshold, and refusals lie where the weights ask for them."""
    monkeypatch.setattr(resampling, "COST", 0.05)
    rows, labels = mixed_quality(1200)
    docs, labels = make_docs(spark, rows), spark.createDataFrame(labels, LABELS)
    target, held_out = resampling.labelled(labels)
    ratios = resampling.log_ratios(docs, target)
    log_weights, noise = {}, {}
    for i, text, _, _ in rows:
        grams = resampling.buckets(text)
        log_weights[i] = resampling.SHARPNESS * float(ratios[grams].sum()) / (len(grams) + resampling.PRIOR_GRAMS)
        u = xxhash.xxh64_intdigest(f"{i}\0{text}".encode(), resampling.SEED)
        noise[i] = -math.log(-math.log((u + 0.5) / 2**64))
    held = sorted(held_out)
    weights, good = np.array([log_weights[i] for i in held]), np.array([held_out[i] == 1 for i in held])
    cut = resampling.best_cut(weights, good)
    k = sum(w >= cut for w in log_weights.values())
    factor = resampling.temper(weights, good, cut)
    assert factor < 1
    drawn = sorted(log_weights, key=lambda i: -(factor * log_weights[i] + noise[i]))[:k]
    kept = {r.doc_id for r in resampling.classify(docs, labels).collect() if r.kept}
    assert kept == set(drawn)
    heaviest = set(sorted(log_weights, key=lambda i: -log_weights[i])[:k])
    assert 0 < len(kept - heaviest) < k / 2  # the draw decides near the cut
    # Near the cut the share kept is what the weights ask for, far from it nearly all or nothing.
    level = min(factor * log_weights[i] + noise[i] for i in kept)
    chance = {i: -math.expm1(-math.exp(min(factor * w - level, 50))) for i, w in log_weights.items()}
    for low, high in ((0, 0.2), (0.2, 0.5), (0.5, 0.8), (0.8, 1.01)):
        band = [i for i, p in chance.items() if low <= p < high]
        if len(band) >= 30:
            share, want = np.mean([i in kept for i in band]), np.mean([chance[i] for i in band])
            assert abs(share - want) < 4 * math.sqrt(0.25 / len(band)), (low, share, want)


def test_temper():
    """Well parted weights are left with much noise, badly parted ones with little; never worse than the plain cut by more than the cost."""
    good = np.arange(2000) % 2 == 0
    r = np.random.default_rng(2)
    factors = []
    for gap in (2000.0, 100.0, 1.0):
        weights = np.where(good, gap, -gap) + r.normal(size=2000)
        cut = resampling.best_cut(weights, good)
        factors.append(resampling.temper(weights, good, cut))
        if factors[-1] < 1:
            draws = [np.argsort(-(factors[-1] * weights + r.gumbel(size=2000)))[: (weights >= cut).sum()] for _ in range(20)]
            assert np.mean([good[d].sum() for d in draws]) / good.sum() > (weights >= cut)[good].mean() - resampling.COST - 0.01
    assert factors[0] < factors[1] < factors[2] == 1.0
