"""Properties on the demo inputs built from the sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import abc, categories, counts, features, movements
from cyclecount.plans import demo

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def curve(spark):
    return abc.abc_curve(demo.stock(spark, SF), demo.costs(spark, SF)).cache()


def test_running_share_monotone_and_ends_at_one(curve):
    rows = curve.orderBy(F.desc("Valor_Estoque"), "Código", "Descrição").collect()
    shares = [r["Pct_Acumulada"] for r in rows]
    assert all(a <= b for a, b in zip(shares, shares[1:]))
    assert abs(shares[-1] - 1.0) < 1e-9
    classes = [r["Curva_ABC"] for r in rows]
    assert classes == sorted(classes)  # A block, then B, then C


def test_class_sizes_sum_to_items(curve):
    summary = abc.class_summary(curve).collect()
    assert sum(r["n_items"] for r in summary) == curve.count()
    assert abs(sum(r["value_share"] for r in summary) - 1.0) < 1e-9


def test_history_sets_partition_the_items(spark, curve):
    items = features.abc_items(curve)
    daily = counts.daily_counts(counts.clean_counts(demo.counts(spark, SF)))
    counted = categories.active_since(features.standardized_daily(daily), demo.SINCE, F.col("Data INV"))
    moved = movements.movement_rows(demo.movements(spark, SF))
    moved = categories.active_since(moved, demo.SINCE, C.month_start("Ano", "Mês"))
    w = {r[0] for r in categories.items_with_history(items, counted, moved).collect()}
    wo = {r[0] for r in categories.items_without_history(items, counted, moved).collect()}
    every = {r[0] for r in items.select("Código").collect()}
    assert w and wo and not (w & wo) and (w | wo) == every


def test_last_count_one_row_per_key(spark):
    last = counts.last_counts(demo.counts(spark, SF))
    keys = last.groupBy(*[F.col(f"`{k}`") for k in counts.KEY_COLS]).count()
    assert keys.where(F.col("count") > 1).count() == 0
    assert last.count() == keys.count()
