"""Hard negatives against plain loops, with odd rows, ties and many equal vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=10):
    known = {}
    for i, vector, label in sorted((r for r in rows if None not in r), key=repr):
        if all(x is not None and math.isfinite(x) for x in vector):
            label = (label + 1) % 10 if i % 7 == 0 else label
            known.setdefault(i, []).append((label, [math.floor(256 * x) for x in vector]))
    known = {i: min(v) for i, v in known.items()}
    found = []
    for a, (label, vector) in known.items():
        if a % 100:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, l) for i, (l, v) in known.items() if i != a]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for score, p, _ in [r for r in scored if r[2] == label][:positives]:
            fits = [r for r in scored if r[2] != label and 30 * score <= 100 * r[0] <= 90 * score]
            found += [(a, p, n + 1, i, score, s) for n, (s, i, _) in enumerate(fits[:negatives])]
    return sorted(found)


def rows_of(n=900, dims=6):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(10, dims))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 10))
        vector = centres[label] + rng.normal(size=dims) * 0.4
        if i % 3 == 0:  # one vector holds a third of all rows
            vector, label = centres[0], label if i % 2 else 3
        rows.append((i, [float(np.float32(x)) for x in np.round(vector, 2)], label))
    odd = [float("nan")] + [0.5] * (dims - 1)
    rows += [(1000, None, 1), (1100, odd, 1), (1200, [float("inf")] * dims, 2), (1300, [None] * dims, 3), (None, [0.1] * dims, 3),
             (1400, [1.0] * dims, None), (1500, [1.0, 1.0], 4), (1600, [], 4), (1700, [0.0] * dims, 4), rows[100], rows[200],
             (300, [2.0] * dims, 9), (1800, [-1.0] * dims, 77)]
    return rows


def run(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(7)
    frame = frame.withColumns({c: F.lit("x") for c in ("id", "vector", "tile", "page", "score", "windows")})
    return sorted(map(tuple, hn.report(frame).collect()))


@pytest.mark.parametrize("leaf, fanout, block", [(128, 8, 256), (5, 3, 2)])
def test_against_plain_loops(spark, monkeypatch, leaf, fanout, block):
    monkeypatch.setattr(hn, "LEAF", leaf)
    monkeypatch.setattr(hn, "FANOUT", fanout)
    monkeypatch.setattr(hn, "BLOCK", block)
    rows = rows_of()
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_lone_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, None, 1), (100, [1.0], 5)]) == []
    assert run(spark, [(100, [1.0], 5), (101, [1.0], 5), (102, [0.5], 6)]) == [(100, 101, 1, 102, 65536, 32768)]


def test_whole_numbers_beyond_floats(spark):
    big = float(1 << 17)
    rows = [(100 * i, [big - i, big + i, 1.0], i % 2) for i in range(6)]
    rows += [(701, [1.0, 1.0, 1.0], 0), (702, [big * 0.75, 1.0, 0.0], 0), (703, [big * 0.625, 1.0, 0.0], 1)]
    assert run(spark, rows) == brute(rows)
    too_large = spark.createDataFrame([(1, [float(1 << 20)])], "vec_id long, v array<float>")
    assert too_large.where(hn.whole_vectors(F.col("v")).isNotNull()).count() == 0


def test_packing_and_intervals():
    rng = np.random.default_rng(3)
    vectors, labels = rng.integers(-50, 50, (3_000, 4)), rng.integers(0, 5, 3_000)
    keys = np.column_stack((labels, vectors))
    leaves = hn.leaves_of(keys, 50)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(3_000)) and max(map(len, leaves)) <= 50
    assert len(leaves) <= 2 * 60
    cuts = hn.tiles_of(keys, 9)
    sizes = np.bincount(hn.tile_of(keys, cuts), minlength=9)
    assert sizes.sum() == 3_000 and (sizes > 0).all() and sizes.max() <= 3 * sizes.mean()
    order = np.concatenate(leaves)
    starts = np.cumsum([0, *map(len, leaves[:-1])])
    tree = hn.Tree(np.arange(3_000), labels[order], vectors[order], starts)
    asked = rng.integers(-50, 50, (20, 4))
    scores = asked @ vectors[order].T
    for kind in (np.float64, np.int64):
        low, high = hn.intervals(asked, tree.leaf[0], tree.leaf[1], kind)
        for q in range(20):
            assert (np.minimum.reduceat(scores[q], starts) >= low[q]).all()
            assert (np.maximum.reduceat(scores[q], starts) <= high[q]).all()


def test_queue_prunes_boxes():
    """With separate clusters the queue scores few leaves."""
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.integers(0, 20, (500, 2)) + 1_000 * np.array(c) for c in ((1, 0), (0, 1), (1, 1), (-1, -1))])
    labels = np.repeat([0, 1, 2, 3], 500)
    leaves = hn.leaves_of(np.column_stack((labels, vectors)), 25)
    order = np.concatenate(leaves)
    tree = hn.Tree(order, labels[order], vectors[order], np.cumsum([0, *map(len, leaves[:-1])]))
    asked = np.array([1, 1])
    bounds = [b[0] for box in (tree.page, tree.leaf) for b in hn.intervals(asked[None], box[0], box[1], np.int64)]
    probe = hn.Probe(tree, tree.vectors, asked, 0, 0, bounds)
    best = probe.best(5, False, 100, 1_030)
    want = sorted(((int(s), int(i)) for i, s in enumerate(vectors @ asked) if labels[i] and 100 <= s <= 1_030), key=lambda r: (-r[0], r[1]))[:5]
    assert best == want
    assert len(probe.scores) <= 10 < len(leaves)
