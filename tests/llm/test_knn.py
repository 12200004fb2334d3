import math
import random

import pytest

from cyclecount.llm import knn

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, picked, k):
    import numpy as np

    ok = []
    for i, v in dict.fromkeys((i, None if v is None else tuple(v)) for i, v, *_ in rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, tuple(math.floor(1024.0 * float(np.float32(x))) for x in v)))
    out = []
    for i, v in ok:
        if picked(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in ok if (j, w) != (i, v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=10, **names):
    df = spark.createDataFrame([(*r, 0, "clash") for r in rows], SCHEMA)
    got = knn.top_k(df, df.where("vec_id % 5 = 0"), k=k, **names)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(knn, "PER_GROUP", 8)
    monkeypatch.setattr(knn, "BLOCK", 100)
    monkeypatch.setattr(knn, "QUERIES", 16)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, spread) for x in rng.choice(centres)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(60)]  # one common vector, many ids
    rows += [(1000, None), (1005, [1.0, None]), (1010, [float("nan")] * 6), (1015, [float("inf")] * 6), rows[10]]
    rows += [(1020, []), (1025, [0.5]), (None, [1.0] * 6), (15, [0.1] * 6), (1030, [3000.0] * 6)]
    assert run(spark, rows, n_pivots=16) == brute(rows, lambda i: i % 5 == 0, 10)


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (5, [2.0, -1.0])]
    assert run(spark, rows) == brute(rows, lambda i: i % 5 == 0, 10)
    assert run(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**14 + i), float(-(2**13) * i), 7.0]) for i in range(12)]
    assert run(spark, rows, k=3) == brute(rows, lambda i: i % 5 == 0, 3)


def test_tight_clusters_are_met_by_their_own_queries(spark, monkeypatch):
    import numpy as np
    from pyspark.sql import functions as F

    monkeypatch.setattr(knn, "PER_GROUP", 16)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(50, 16))
    rows = [(i, [float(x) for x in centres[i % 50] + rng.normal(scale=0.02, size=16)]) for i in range(10_000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    asked = df.where("vec_id % 20 = 0 or vec_id % 37 = 0")
    points, _, wanted = knn.prepared(df, asked, 10, "vec_id", "embedding", 1024)
    dealt = knn.deal(points, wanted, 10)
    met = dealt.groupBy("cell", "chunk", "block").agg(
        F.sum(F.col("asks").cast("long")).alias("q"), F.sum((~F.col("asks")).cast("long")).alias("x")
    )
    groups, products, replicated = met.agg(F.countDistinct("cell"), F.sum(F.col("q") * F.col("x")), F.sum("x")).first()
    assert products < 0.1 * wanted.count() * len(rows)
    assert replicated < 0.1 * groups * len(rows)
    got = sorted(tuple(r) for r in knn.top_k(df, asked).collect())
    whole = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64)
    want = []
    for q in [i for i in range(len(rows)) if i % 20 == 0 or i % 37 == 0]:
        scores = whole @ whole[q]
        best = [j for j in np.lexsort((np.arange(len(rows)), -scores))[:11].tolist() if j != q][:10]
        want += [(q, r + 1, j, int(scores[j])) for r, j in enumerate(best)]
    assert got == want


def test_groups_join_only_where_that_saves_work(monkeypatch):
    import numpy as np

    monkeypatch.setattr(knn, "PER_GROUP", 100)
    sizes, asks = np.full(4, 1000.0), np.full(4, 50)
    assert sorted(map(sorted, knn.grouped(np.eye(4, dtype=bool), sizes, asks))) == [[0], [1], [2], [3]]
    assert len(knn.grouped(np.ones((4, 4), dtype=bool), sizes, asks)) == 1
