import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cyclecount.llm import projections

SCHEMA = "vec_id long, embedding array<float>, label int, score string, cell int"


def brute(rows, picked, k):
    """Every row but the query's own, by its place in the table."""
    ok = []
    for at, (i, v, *_) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok.append((at, i, np.array(v, dtype=np.float32).astype(float)))
    width = max((len(v) for *_, v in ok), default=0)
    m = np.array([np.pad(v, (0, width - len(v))) for *_, v in ok])
    out = {}
    for at, i, v in ok:
        if picked(i):
            far = np.sqrt(((m - np.pad(v, (0, width - len(v)))) ** 2).sum(1))
            near = sorted((far[n], j is None, j or 0, j) for n, (b, j, _) in enumerate(ok) if b != at)
            out.setdefault(i, []).append([(float(x[0]), x[3]) for x in near[:k]])
    return out


def run(spark, rows, k=10, **names):
    df = spark.createDataFrame([(*r, 0, "clash", 7) for r in rows], SCHEMA)
    got = projections.nearest(df, df.where("vec_id % 5 = 0"), k=k, **names).collect()
    assert all(r["rank"] >= 1 for r in got)
    out = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def same(got, want):
    """Rows repeated with their id give several equal lists, which come rank by rank."""
    assert got.keys() == {i for i, lists in want.items() if lists[0]}
    for i, lists in want.items():
        expected = [x for hits in zip(*lists, strict=True) for x in hits]
        assert [x[1] for x in got.get(i, [])] == [x[1] for x in expected]
        assert np.allclose([x[0] for x in got.get(i, [])], [x[0] for x in expected], rtol=1e-12, atol=0)


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(projections, "BLOCK_BYTES", 8 * 6 * 40)
    monkeypatch.setattr(projections, "LEAF", 8)
    monkeypatch.setattr(projections, "SAMPLE", 100)
    monkeypatch.setattr(projections, "CELLS", 4)
    monkeypatch.setattr(projections, "QUERIES", 16)


def corpus():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(160)]  # one common vector, many ids
    rows += [(1000, None), (1005, [1.0, None]), (1010, [float("nan")] * 6), (1015, [float("inf")] * 6), (1020, [0.0] * 6)]
    rows += [(1025, []), (1030, [0.5]), (None, [1.0] * 6), (None, rows[5][1]), (1035, [3000.0] * 6), (15, [0.1] * 6)]
    return rows


def test_all_found_when_the_test_is_nearly_sure(spark, small):
    rows = corpus() + [corpus()[10]] * 3
    same(run(spark, rows, sure=1 - 1e-12), brute(rows, lambda i: i is not None and i % 5 == 0, 10))


def test_few_rows_empty_table_and_no_queries(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (5, [2.0, -1.0])]
    same(run(spark, rows), brute(rows, lambda i: i % 5 == 0, 10))
    assert run(spark, []) == {}
    assert run(spark, [(0, [0.0]), (5, None)]) == {}
    assert run(spark, [(1, [1.0]), (2, [2.0])]) == {}
    assert run(spark, [(5, [1.0])]) == {}


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_recall_and_share_verified(spark, monkeypatch, spread):
    monkeypatch.setattr(projections, "BLOCK_BYTES", 8 * 32 * 200)
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((20, 32))
    m = (centres[rng.integers(0, 20, 4000)] + spread * rng.standard_normal((4000, 32))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = df.where("vec_id % 50 = 0")
    got = {}
    for r in projections.nearest(df, asked).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, lambda i: i % 50 == 0, 10)
    hits = [len(got[i] & {x[1] for x in want[i][0]}) / 10 for i in want]
    assert sum(hits) / len(hits) >= 0.9
    share = projections.verified(df, asked).agg(F.avg("verified")).first()[0] / 4000
    assert share < (0.1 if spread < 1 else 0.9)


def test_chi_square():
    # closed forms: 2 degrees 1 - exp(-x/2), 4 degrees 1 - exp(-x/2)(1 + x/2)
    for x in (0.1, 1.0, 5.0, 30.0):
        assert math.isclose(projections.chi_square_cdf(x, 2), 1 - math.exp(-x / 2), rel_tol=1e-12)
        assert math.isclose(projections.chi_square_cdf(x, 4), 1 - math.exp(-x / 2) * (1 + x / 2), rel_tol=1e-12)
    assert math.isclose(projections.chi_square_cdf(projections.chi_square_quantile(0.95, 16), 16), 0.95)


def test_leaves_hold_every_point_once():
    points = np.random.default_rng(1).standard_normal((777, 5))
    order, starts = projections.leaf_order(points, 16)
    assert sorted(order.tolist()) == list(range(777))
    assert max(np.diff(np.append(starts, 777))) <= 16
