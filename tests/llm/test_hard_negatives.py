import math
import random

import numpy as np

from railweave.llm import hard_negatives

EMB = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, top=5):
    seen = {}
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        lab = (label + 1) % 10 if vec_id % 7 == 0 else label
        q = [math.floor(float(np.float32(x)) * 256) for x in vec]
        seen[vec_id] = min(seen.get(vec_id, (lab, q)), (lab, q))
    out = []
    for a, (la, qa) in seen.items():
        if a % every:
            continue
        score = {v: sum(x * y for x, y in zip(qa, q)) for v, (l, q) in seen.items() if len(q) == len(qa)}
        pos = sorted((-score[v], v) for v, (l, q) in seen.items() if l == la and v != a and v in score)[:top]
        for ps, p in ((-s, v) for s, v in pos):
            neg = sorted((-score[v], v) for v, (l, q) in seen.items() if l != la and v in score and 80 * ps <= 100 * score[v] <= 100 * ps)[:top]
            out += [(a, p, r + 1, v, ps, -s) for r, (s, v) in enumerate(neg)]
    return sorted(out)


def table(n=900, dim=16, seed=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(10)]
    rows = []
    for i in range(n):
        lab = r.randrange(10)
        rows.append((i, [c + r.gauss(0, 0.6) for c in centres[lab]], lab))
    rows += [(1000, [0.5] * dim, 3), (1001, [0.5] * dim, 4), (1002, [0.5] * dim, 3), (1100, [0.5] * dim, 3)]  # ties
    rows += [(1200, None, 1), (1300, [float("nan")] * dim, 1), (1400, [1.0] * dim, None), (None, [1.0] * dim, 2), (1500, [0.1] * (dim - 1) + [None], 2)]
    rows += [(200, rows[200][1], rows[200][2]), (300, [0.2] * 3, 1)]  # a repeated row, another dimension
    return rows


def test_equals_brute_force_over_many_shards_and_blocks(spark):
    rows = table()
    df = spark.createDataFrame(rows, EMB)
    got = hard_negatives.mine(df, shard_rows=128, block_rows=3).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_one_shard_and_empty_table(spark):
    rows = table(300, 8, 9)
    assert sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(rows, EMB)).collect())) == brute(rows)
    assert hard_negatives.mine(spark.createDataFrame([], EMB)).count() == 0


def test_intervals_hold_the_exact_score():
    r = np.random.default_rng(1)
    q = np.floor(r.standard_normal((500, 64)) * 256).astype(np.int64)
    codes = hard_negatives.Codes(q)
    for a in np.floor(r.standard_normal((20, 64)) * 256).astype(np.int64):
        lower, upper = codes.interval(a)
        exact = q @ a
        assert (lower <= exact).all() and (exact <= upper).all()
