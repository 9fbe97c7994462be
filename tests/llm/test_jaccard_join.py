"""Classes and links against all pairs; banding, units, components; awkward rows."""

import random

import numpy as np
import pytest

from tests.llm.helpers import awkward, make_docs, prose
from trendframe.llm import jaccard_join


def word_sets(rows, n=5):
    sets = []
    for _, t, _, _ in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    return sets


def plain(rows, n=5, threshold=0.8):
    sets = word_sets(rows, n)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    out = []
    for k, (i, _, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, min(ids) if ids and sets[k] else i, links[k]))
    return sorted(out, key=str)


def edited(text, r, changes):
    words = text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = prose(r.random(), 1)
    return " ".join(words)


def corpus(seed=1):
    """Copies, chains of edits, texts that share a long passage, unrelated texts."""
    r = random.Random(seed)
    rows, passage = awkward(seed), prose(99, 60)
    for g in range(6):
        text = prose(1000 + g, r.choice([30, 120, 300]))
        for k in range(r.choice([2, 5, 25])):
            rows.append((len(rows) + 100, edited(text, r, r.randrange(4)) if k % 3 else text, None, None))
            if k % 5 == 0:
                text = edited(text, r, 2)
    rows += [(len(rows) + 100 + k, prose(k, 20) + " " + passage + " " + prose(k + 50, 15), None, None) for k in range(30)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2, 7, 256])
def test_classes_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = corpus()
    got = jaccard_join.classes(make_docs(spark, rows).repartition(4)).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain(rows)


@pytest.mark.parametrize("limit", [1, 500, 5_000])
def test_blocks_are_bounded_by_the_size_of_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", limit)
    rows = corpus(4)
    got = jaccard_join.classes(make_docs(spark, rows).repartition(4)).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain(rows)


def test_a_very_long_text_in_a_bucket(spark, monkeypatch):
    """Its block is split off from others, links stay, and blocks are never more than nodes."""
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 50_000)
    long = prose(90, 60_000)
    rows = corpus(5) + [(5_000, long, None, None), (5_001, long + " and more", None, None), (5_002, long[:-300], None, None)]
    got = jaccard_join.classes(make_docs(spark, rows).repartition(3)).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain(rows)
    nodes = spark.createDataFrame([(k, [1], 10**9 if k == 3 else 10) for k in range(6)], "node long, bands array<long>, bytes long")
    units = jaccard_join._units(nodes.select("node", "bands"), nodes.select("node", "bytes")).collect()
    assert len(units) > 6 and {(r.low, r.high) for r in units} <= {(a, b) for a in range(6) for b in range(a, 6)}


def test_other_thresholds(spark):
    rows = corpus(2)
    got = jaccard_join.classes(make_docs(spark, rows), n=3, threshold=0.5).collect()
    assert sorted((tuple(x) for x in got), key=str) == plain(rows, 3, 0.5)


def test_distinct_keeps_one_of_each_class(spark):
    rows = corpus(3)
    docs = make_docs(spark, rows)
    kept = jaccard_join.distinct(docs)
    assert kept.schema == docs.schema
    sets, want = word_sets(rows), set()
    classes = dict.fromkeys(c for (_, c, _), _ in zip(plain(rows), rows, strict=True) if c is not None)
    got = kept.collect()
    with_words = [x for x in got if (x.text or "").encode().split()]
    assert sorted(x.doc_id for x in with_words) == sorted(c for c in classes if any(i == c and s for (i, *_), s in zip(rows, sets, strict=True)))
    assert len(got) - len(with_words) == sum(not s for s in sets) and want == set()


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_rows_are_picked_by_number(spark, monkeypatch, most):
    """The numbers of several partitions, at the ends of words of 64, repeated and null; columns may have any name."""
    monkeypatch.setattr(jaccard_join, "BROADCAST_WORDS", most)
    numbers = [(p << 40) + k for p in (0, 1, 77, 2**23 - 1) for k in range(200)]
    table = spark.createDataFrame([(n, f"t{n}", "w") for n in numbers], "row long, text string, word string")
    wanted = [n for n in numbers if n % 64 in (0, 1, 63) or n % 7 == 3]
    got = jaccard_join.with_rows(table, "row", spark.createDataFrame([(n,) for n in [*wanted, *wanted[:9], None, 5 << 40]], "r long"))
    assert got.columns == table.columns and sorted(r.row for r in got.collect()) == wanted
    assert jaccard_join.with_rows(table, "row", spark.createDataFrame([], "r long")).count() == 0


def test_texts_that_share_no_bucket_are_not_shuffled(spark, conf):
    """Documents that stay are not shuffled either, though tables are too large to be broadcast by their size."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    kept = jaccard_join.distinct(make_docs(spark, corpus(6)))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan.replace("BroadcastExchange", "")


def test_empty_table(spark):
    assert jaccard_join.classes(make_docs(spark, [])).count() == 0
    assert jaccard_join.distinct(make_docs(spark, [])).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9])
def test_banding_reaches_the_recall(threshold):
    bands, rows = jaccard_join.bands_for(threshold)
    assert bands * rows <= jaccard_join.MOST_HASHES and 1 - (1 - threshold**rows) ** bands >= jaccard_join.RECALL
    assert 1 - (1 - threshold ** (rows + 1)) ** (jaccard_join.MOST_HASHES // (rows + 1)) < jaccard_join.RECALL


def test_bands_agree_as_often_as_they_should():
    """Of pairs with similarity s, a band of r rows agrees in a share s ** r."""
    r = np.random.default_rng(5)
    make, hits = jaccard_join.Bands(20, 4), []
    for _ in range(150):
        grams = r.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = np.sort(grams[:270]), np.sort(grams[30:])
        hits.append((make.keys(a) == make.keys(b)).mean())
    assert abs(np.mean(hits) - 0.8**4) < 0.04


def test_components(spark):
    edges = [(k + 1, k) for k in range(40)] + [(100, 105), (105, 103), (7, 7), (200, 300), (300, 200)]
    got = {r.node: r.root for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k <= 40} == dict.fromkeys(range(1, 41), 0)
    assert got[105] == got[103] == 100 and got[300] == 200 and 100 not in got


def test_units_hold_every_pair_of_a_bucket_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    nodes = spark.createDataFrame([(k, [1, 2, k + 10]) for k in range(20)], "node long, bands array<long>")
    units = {}
    for r in jaccard_join._units(nodes).collect():
        units.setdefault((r.bucket, r.low, r.high), []).append((r.node, r.block))
    assert {b for b, _, _ in units} == {1}  # the second bucket has the same members
    pairs = []
    for (_, low, high), members in units.items():
        pairs += [tuple(sorted((a, b))) for a, x in members for b, y in members if a < b and (low == high or x != y)]
    assert sorted(pairs) == [(a, b) for a in range(20) for b in range(a + 1, 20)]
