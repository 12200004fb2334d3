"""Options where the reference's behaviour is the default and another is offered."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import features, planning, validation


def daily(spark, rows):
    df = spark.createDataFrame(rows, "`Código` string, d string, `Quantidade Fisica` double, `Lógica` double, Curva_ABC string")
    d = F.to_date("d")
    return df.withColumns({"Data INV": d, "Ano": F.year(d), "Mês": F.month(d)}).drop("d")


def test_trend_by_month(spark):
    rows = [("1", "2020-01-05", 10.0, 1.0, "A"), ("1", "2020-01-20", 20.0, 1.0, "A"), ("1", "2021-01-03", 30.0, 1.0, "A")]
    got = features.time_features(daily(spark, rows), by="month").orderBy("Data INV").collect()
    assert [r["Tendencia_Anual"] for r in got] == [0.0, 0.0, pytest.approx(50.0)]


def test_class_stats_on_training_years(spark):
    rows = [("1", "2020-01-05", 10.0, 1.0, "A"), ("1", "2020-02-05", 14.0, 1.0, "A"), ("2", "2021-01-03", 99.0, 1.0, "B")]
    got = {r[0]: r for r in features.class_stats(daily(spark, rows), before_year=2021).collect()}
    assert got["A"]["Media_ABC"] == 12.0 and got["B"]["Media_ABC"] == 12.0


def test_cleaned_actuals(spark):
    cols = ["NOK", "Status", "Código", "Locação", "UdE", "Compartimento", "Status Inventario", "Atualização", "Contagem",
            "Física", "Quantidade Fisica", "Custo", "Lógica"]
    rows = [
        ("", "FECHADO", "5", "A.1", "7", "1", "FECHADO", "1/2/2025 8:00", "1", None, "4", "1,0", "4"),
        ("", "FECHADO", "5", "A.1", "7", "1", "FECHADO", "1/2/2025 9:00", "2", None, "6", "1,0", "4"),
        ("", "ABERTO", "5", "A.2", "7", "1", "FECHADO", "1/2/2025 9:00", "1", None, "100", "1,0", "4"),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    assert validation.actual_ytd(raw, 2025, 2).first()["Real_YTD"] == 110
    assert validation.actual_ytd(raw, 2025, 2, cleaned=True).first()["Real_YTD"] == 6


def test_default_capacity(spark):
    df = daily(spark, [("1", "2020-01-05", 10.0, 100.0, "A")])
    got = planning.capacity_map(planning.capacity_by_month(df, default_capacity={1: 7, 2: 8}))
    assert (got[1], got[2], got[3]) == (90, 8, 0)


def test_money_locale_and_exact_costs(spark):
    row = spark.range(1).select(
        C.parse_money_ptbr(F.lit("1.234,5678")).alias("pt"),
        C.parse_money_ptbr(F.lit("1,234.5678"), locale="en").alias("en"),
        C.value_of(C.parse_money_ptbr(F.lit("0,0349")), F.lit(100000)).alias("v"),
        C.to_whole(F.lit("2024.0")).alias("y"),
        C.to_whole(F.lit("NaN")).alias("nan"),
        C.to_whole(F.lit("1e30")).alias("big"),
        C.to_number(F.lit("340123450000000018"), C.WHOLE).alias("unit"),
    ).first()
    assert row["pt"] == row["en"] == Decimal("1234.5678") and row["v"] == Decimal("3490.00")
    assert (row["y"], row["nan"], row["big"], row["unit"]) == (2024, None, None, 340123450000000018)
