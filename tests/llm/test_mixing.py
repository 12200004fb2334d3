import pytest
from pyspark.sql import functions as F

from cyclecount.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


def plan(spark, rows):
    return {r.doc_id: r for r in mixing.plan_mix(spark.createDataFrame(rows, SCHEMA)).collect()}


def doc(i, n, source, text=None):
    return (i, "w " * n if text is None else text, "en", source, 0, "clash")


def test_targets_follow_weights_and_caps(spark):
    rows = [doc(i, 10, "a") for i in range(30)] + [doc(100 + i, 10, "b") for i in range(30)]
    rows += [doc(200 + i, 10, "c") for i in range(3)]
    got = plan(spark, rows)
    # 630 words, weights 1:2:3; c stops at 90, the other 540 words are shared 1:2
    assert got[0].target == pytest.approx(180) and got[100].target == pytest.approx(360)
    assert got[200].target == pytest.approx(90)
    for lo, hi, want in ((0, 100, 180), (100, 200, 360), (200, 300, 90)):
        taken = sum(r.taken for k, r in got.items() if lo <= k < hi)
        assert abs(taken - want) <= 10
    assert all(r.taken <= 3 * r.size for r in got.values())


def test_nulls_empty_texts_and_null_source(spark):
    rows = [(None, None, None, None, None, None), doc(1, 0, "a", ""), doc(2, 5, None), doc(3, 5, "a"), doc(3, 5, "a")]
    got = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 5
    assert sorted(r.size for r in got) == [0, 0, 5, 5, 5]
    assert sorted({r.source_size for r in got}) == [5, 10]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.plan_mix(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def test_mix_gives_copies_in_position_order(spark):
    rows = [doc(i, 10, "a") for i in range(20)] + [doc(100 + i, 10, "b") for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(df)
    assert out.columns == df.columns
    got = [r.doc_id for r in out.collect()]
    copies = {r.doc_id: len(r.positions) for r in mixing.plan_mix(df).collect()}
    assert {k: got.count(k) for k in copies} == copies
    # the even rank ramps down and the odd rank up: b's documents come late
    where = [i for i, k in enumerate(got) if k >= 100]
    assert sum(where) / len(where) > sum(i for i, k in enumerate(got) if k < 100) / (len(got) - len(where))


def test_invert_is_the_inverse_of_the_integral(spark):
    knots = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in ((0.0, 0.0), (0.5, 2.0), (1.0, 1.0))])
    df = spark.range(0, 101).select((F.col("id") / 100 * 1.25).alias("d"), mixing.segments(knots).alias("s"))
    for r in df.select("d", mixing.invert(F.col("s"), F.col("d")).alias("t")).collect():
        t = r.t
        area = 2 * t * t if t <= 0.5 else 0.5 + 2 * (t - 0.5) - (t - 0.5) ** 2
        assert area == pytest.approx(r.d, abs=1e-9)
