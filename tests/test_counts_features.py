from decimal import Decimal

from pyspark.sql import functions as F

from cyclecount.operators import counts, features, movements

COUNT_COLS = [
    "NOK", "Status", "Código", "Locação", "UdE", "Compartimento", "Status Inventario",
    "Atualização", "Contagem", "Física", "Quantidade Fisica", "Custo", "Lógica",
]


def raw_counts(spark, rows):
    schema = ", ".join(f"`{c}` string" for c in COUNT_COLS)
    return spark.createDataFrame(rows, schema)


def row(contagem, fis="3", qf="5", status="FECHADO", nok=None, custo="1.000,50", ts="2/3/2024 10:00"):
    return (nok, status, "12", "R1.01", "7", "1", "FECHADO", ts, contagem, fis, qf, custo, "4")


def test_last_count_keeps_highest_round(spark):
    df = raw_counts(spark, [row("1", fis="1"), row("2", fis="2"), row(None, fis="9")])
    (r,) = counts.last_counts(df).collect()
    assert r["Contagem"] == 2 and r["Física"] == Decimal("2.000")
    assert r["Código"] == "0000000000012" and r["Estante"] == "R1"


def test_filters_and_valuation(spark):
    df = raw_counts(
        spark,
        [row("1"), row("1", status="ABERTO", ts="3/3/2024 10:00"), row("1", nok="x", ts="4/3/2024 10:00")],
    )
    (v,) = counts.clean_counts(df).collect()
    assert v["Status Controle"] == "Valor Consultivado"
    assert v["Custo"] == Decimal("1000.50")
    assert v["Valor Logica"] == Decimal("4002.00")
    assert v["Valor Fisico"] == Decimal("3001.50")
    assert v["Vlr Delta"] == Decimal("-1000.50") and v["Delta ABS"] == Decimal("1000.50")


def test_check_parsed_raises(spark):
    df = raw_counts(spark, [row("1", ts="not a date")])
    try:
        counts.check_parsed(counts.typed_counts(df))
    except ValueError as e:
        assert "Atualização" in str(e)
    else:
        raise AssertionError("expected a ValueError")


def _daily(spark, qs, code="1", start_year=2020):
    rows = []
    for i, q in enumerate(qs):
        y, m = start_year + i // 12, i % 12 + 1
        rows.append((code, f"{y}-{m:02d}-15", y, m, q))
    return spark.createDataFrame(rows, "`Código` string, d string, Ano int, `Mês` int, q string").select(
        "Código",
        F.to_date("d").alias("Data INV"),
        "Ano",
        "Mês",
        F.col("q").cast("decimal(18,3)").alias("Quantidade Fisica"),
        F.lit(1).cast("decimal(18,3)").alias("Lógica"),
    )


def test_moving_mean_three(spark):
    tf = features.time_features(_daily(spark, ["1", None, "3", "0", "5"]))
    got = [r["Media_Movel_3M"] for r in tf.orderBy("Ano", "Mês").collect()]
    assert got == [0.0, 1.0, 1.0, 2.0, 1.5]


def test_trend_twelve(spark):
    qs = ["10"] + ["12"] * 11 + ["15"]
    got = [r["Tendencia_Anual"] for r in features.time_features(_daily(spark, qs)).orderBy("Ano", "Mês").collect()]
    assert got[-1] == 50.0 and all(v == 0.0 for v in got[:-1])


def test_trend_base_zero(spark):
    qs = ["0"] + ["12"] * 11 + ["15"]
    got = [r["Tendencia_Anual"] for r in features.time_features(_daily(spark, qs)).orderBy("Ano", "Mês").collect()]
    assert got[-1] == 0.0


def test_std_of_single_row_class_uses_global(spark):
    df = spark.createDataFrame(
        [("A", Decimal("1")), ("A", Decimal("3")), ("B", Decimal("10"))],
        "Curva_ABC string, `Quantidade Fisica` decimal(18,3)",
    )
    got = {r["Curva_ABC"]: (r["Media_ABC"], r["Desvio_ABC"]) for r in features.class_stats(df).collect()}
    import statistics

    assert got["A"] == (2.0, statistics.stdev([1, 3]))
    assert got["B"][0] == 10.0
    assert abs(got["B"][1] - statistics.stdev([1, 3, 10])) < 1e-12


def test_movement_pivot_fills_absent_types(spark):
    rows = [
        (2024, 1, "0012", "Entrada no Estoque", 1.0, 5.0),
        (2024, 1, "0012", "Saída por Venda", 2.0, 3.0),
        (2024, 1, "0012", "Saída por Venda", 2.0, 3.0),  # exact duplicate, removed
    ]
    mov = spark.createDataFrame(
        rows, "Ano int, Mes int, CD_ARTICOLO string, Tipo_Movimento string, Qtd_Movimentos double, Total_Qtde double"
    )
    (r,) = movements.movement_features(mov, types=list(movements.EXPECTED_TYPES)).collect()
    assert r["Código"] == "12"
    assert r["Entrada no Estoque_Total_Qtde_Mensal"] == Decimal("5.000")
    assert r["Saída por Venda_Qtd_Movimentos_Mensal"] == Decimal("2.000")
    assert r["Entrada na Quarentena_Total_Qtde_Mensal"] == 0
    assert r["Num_Tipos_Mov_Mensal"] == 2
    assert r["Total_Geral_Qtde_Mensal"] == Decimal("8.000")
