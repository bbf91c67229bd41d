"""Hard negatives against all pairs in plain integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
LONG = (1 << 63) - 1


def plain(rows, every=5, positives=5, count=3, low=50, high=95):
    fine = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine[i, label, tuple(int(math.floor(256 * float(np.float32(x)))) for x in v)] = None
    out = []
    score = lambda v, w: max(-LONG - 1, min(LONG, sum(x * y for x, y in zip(v, w, strict=False))))
    for a, al, av in fine:
        if a % every:
            continue
        scored = sorted(((-score(av, v), i, label) for i, label, v in fine if i != a), key=lambda x: x[:2])
        for p, pid, _ in [x for x in scored if x[2] == al][:positives]:
            fits = [(s, i) for s, i, label in scored if label != al and low * -p <= 100 * -s <= high * -p][:count]
            out += [(a, pid, k, i, -p, -s) for k, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def answers(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


@pytest.mark.parametrize("block", [16_384, 40])
def test_against_plain(spark, monkeypatch, block):
    for name, n in (("ROWS", block), ("QUERIES", 16), ("LEAF", 4)):
        monkeypatch.setattr(negatives, name, n)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in (centres[i % 4] * rng.uniform(0.3, 1.5) + rng.normal(size=6) * 0.3)], int(rng.integers(0, 3))) for i in range(150)]
    same = [0.5, 0.25, -0.5, 0.125, 0.0, 1.0]
    rows += [(200 + i, same, i % 2) for i in range(60)]  # ties at every rank
    rows += [(300, None, 1), (301, [None] + same[1:], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1), (304, same, None), (None, same, 1), (305, [0.0] * 6, 1), (306, [1.0, 2.0], 0), (310, same + [3.0], 2), (311, [], 1), rows[7], rows[5]]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("mine")).withColumn("v", F.lit(0)).repartition(4)
    assert answers(negatives.mine(df, F.col("vec_id") % 5 == 0)) == plain(rows)


def test_large_components(spark):
    """Products beyond doubles are exact, beyond a long they stop at its end."""
    rng = random.Random(4)
    rows = [(i, [rng.uniform(0.9, 1) * s for _ in range(4)], i % 2) for i, s in enumerate([1e5, 3e5, 1e5, 1e6, 2e6, 1e30, 2e5, 3e38, 1e5, 5e5, 1e6, 4e6])]
    assert answers(negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0)) == plain(rows)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, F.col("vec_id") % 5 == 0).count() == 0
    one = spark.createDataFrame([(1, [1.0], 2)], SCHEMA)
    assert negatives.mine(one, F.col("vec_id") % 5 == 0).count() == 0 and negatives.mine(one, F.lit(True)).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_tree(seed):
    """Walks with windows against all rows; balls outside are left closed."""
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(1, 900)), 5
    x = np.floor(256 * rng.normal(size=(n, d)) * rng.uniform(0.1, 2, (n, 1)))
    labels, ids = rng.integers(0, 3, n), rng.permutation(n)
    tree = negatives.Tree.load(negatives.Tree(ids, labels, x, leaf=8).dump())
    for i in range(len(tree.radius)):  # every ball holds the rows below it
        level = int(np.log2(i + 1))
        step = 2 ** (tree.depth - level)
        lo, hi = tree.bounds[(i + 1 - 2**level) * step], tree.bounds[(i + 2 - 2**level) * step]
        assert hi == lo or np.sqrt(((tree.x[lo:hi] - tree.centre[i]) ** 2).sum(1).max()) <= tree.radius[i] + 1e-6
    q = np.floor(256 * rng.normal(size=(20, d)))
    q_ids, q_labels = rng.integers(0, n, 20), rng.integers(0, 4, 20)
    low = rng.integers(-50_000, 50_000, 20)
    high = low + rng.integers(0, 90_000, 20)
    for same in (True, False):
        asked, row, score = tree.search(q, q_ids, q_labels, same, 3, low, high)
        for j in range(20):
            s = (x @ q[j]).astype(int)
            want = sorted((-int(s[i]), int(ids[i])) for i in range(n) if low[j] <= s[i] <= high[j] and (labels[i] == q_labels[j]) == same and ids[i] != q_ids[j])[:3]
            assert [(-int(v), int(tree.ids[r])) for a, r, v in zip(asked, row, score, strict=True) if a == j] == want
