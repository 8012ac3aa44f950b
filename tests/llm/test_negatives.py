"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from corpuslake.llm import negatives
from corpuslake.llm.queries import QUERIES


def brute(rows, positives=5, each=3, every=50):
    """rows: (id, label, list of whole numbers); ids are distinct."""
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, label, x in rows:
        if i % every:
            continue
        scored = [(-dot(x, y), j, other) for j, other, y in rows if j != i]
        scored.sort()
        for s, j, _ in [r for r in scored if r[2] == label][:positives]:
            hard = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s]
            out += [(i, j, n, k, -s, -t) for n, (t, k, _) in enumerate(hard[:each], 1)]
    return sorted(out)


def quantised(vector):
    return [math.floor(256 * float(np.float32(c))) for c in vector]


def run(spark, rows, every=50, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(map(tuple, negatives.mine(df, F.col("vec_id") % every == 0, **options).collect()))


def clustered(n, size, labels=4, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, size)) * 0.2
    label = draw.integers(0, labels, n)
    x = centres[label] + draw.normal(size=(n, size)) * 0.1 + 0.3
    x[: n // 20] = x[0]  # a crowd of equal vectors
    return [(i, int(label[i]), x[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("size", [1, 5, 64, 97])
def test_all_pairs(spark, size):
    rows = clustered(500, size)
    got = run(spark, rows, every=5)
    assert got == brute([(i, label, quantised(x)) for i, label, x in rows], every=5)
    assert len(got) > 100


def test_blocks_and_tiles_of_any_size(spark, monkeypatch):
    rows = clustered(400, 24, seed=2)
    want = brute([(i, label, quantised(x)) for i, label, x in rows], every=4)
    monkeypatch.setattr(negatives, "BLOCK", 30)
    monkeypatch.setattr(negatives, "LEAST_BLOCK", 30)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 7)
    monkeypatch.setattr(negatives, "TILE_ROWS", 11)
    assert run(spark, rows, every=4) == want


def test_bounds_hold_at_every_level():
    draw = np.random.default_rng(3)
    a, b = np.floor(draw.normal(size=(2, 60, 50)) * 300 + 100)
    sides = [negatives.Side(x, *negatives.summaries(x)) for x in (a, b)]
    exact, width = a @ b.T, np.inf
    for (ma, da), (mb, db) in zip(sides[0].levels, sides[1].levels, strict=True):
        middle, reach = ma @ mb.T, da @ db.T
        assert (np.abs(exact - middle) <= reach * (1 + 1e-9) + 0.5).all()
        assert reach.mean() < width
        width = reach.mean()
    assert len(sides[0].levels) == 5


def test_bounds_spare_exact_scores():
    """Where vectors differ by segment means, few pairs reach the exact score, and what is asked for is among them."""
    draw = np.random.default_rng(4)
    x = np.repeat(draw.normal(size=(1000, 4)), 16, axis=1) + draw.normal(size=(1000, 64)) * 0.01
    x = np.floor(x * 256)
    side, ids = negatives.Side(x, *negatives.summaries(x)), np.arange(1000)
    exact = (x[:50] @ x.T).astype(int)
    others = ids[:50, None] != ids
    floor = np.sort(np.where(others, exact, -(10**9)), axis=1)[:, -5]
    for least, k in ((floor, 0), (np.full(50, -np.inf), 5)):
        got = negatives.refined(side.part(slice(0, 50)), side, others, least, np.full(50, np.inf), k)
        there = got != negatives.NONE
        assert there.mean() < 0.1 and (got[there] == exact[there]).all()
        assert there[others & (exact >= floor[:, None])].all()


def test_rows_that_take_no_part(spark):
    rows = [
        (0, 1, [1.0, 0.5]), (50, 1, [1.0, 0.25]), (3, 2, [0.75, 0.0]), (4, None, [0.75, 0.0]), (5, 2, None), (None, 2, [0.75, 0.1]),
        (6, 2, [0.75, None]), (7, 2, [0.75, float("nan")]), (8, 2, [float("inf"), 0.0]), (9, 2, [1e30, 0.0]),
        (10, 3, [0.75]), (11, 3, []), (3, 2, [0.75, 0.0]), (12, 2, [0.75, 0.0]), (100, 9, [1.0, 1.0]),
    ]
    sound = [(0, 1, [256, 128]), (50, 1, [256, 64]), (3, 2, [192, 0]), (10, 3, [192, 0]), (11, 3, [0, 0]), (12, 2, [192, 0]), (100, 9, [256, 256])]
    got = run(spark, rows)
    assert got == brute(sound) and {r[3] for r in got} >= {3, 10}
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    clash = df.withColumns({c: F.lit("x") for c in ("id", "vector", "anchor", "score", "rank", "anchor_id", "g", "h")})
    assert sorted(map(tuple, negatives.mine(clash, F.col("vec_id") % 50 == 0).collect())) == got
    assert negatives.mine(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert run(spark, rows, every=1000_000)  # anchor 0 alone
    assert negatives.mine(df, F.lit(None).cast("boolean")).collect() == []


def test_large_entries_stay_exact(spark):
    draw = random.Random(5)
    rows = [(i, i % 3, [draw.uniform(-60_000, 60_000) for _ in range(40)]) for i in range(120)]
    assert run(spark, rows, every=10) == brute([(i, label, quantised(x)) for i, label, x in rows], every=10)


def test_query_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    plain = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, quantised(r.embedding)) for r in rows]
    out = QUERIES["op13_hard_negatives"](spark, DATA)
    assert dict(out.dtypes)["rank"] == "int" and sorted(map(tuple, out.collect())) == brute(plain)
