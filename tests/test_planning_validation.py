import random
from decimal import Decimal

from cyclecount.operators import planning, validation


def todo_frame(spark, qtys, prios=None, values=None):
    prios = prios or [3] * len(qtys)
    values = values or [Decimal(1000 - i) for i in range(len(qtys))]
    rows = [(f"c{i:04d}", p, v, q) for i, (q, p, v) in enumerate(zip(qtys, prios, values))]
    return spark.createDataFrame(rows, "`Código` string, Prioridade_Curva int, Valor_Estoque decimal(18,2), Qtd_Int long")


def loop(rows, capacity, year, month):
    order = sorted(rows, key=lambda r: (-r[1], -r[2], r[0]))
    placed = {}
    for y, m in planning.planning_months(year, month):
        used, cap = 0, capacity.get(m, 0)
        for code, _, _, q in order:
            if code in placed:
                continue
            if used + q <= cap:
                placed[code] = (y, m)
                used += q
        if len(placed) == len(order):
            break
    return placed


def test_allocation_skips_misfits(spark):
    todo = todo_frame(spark, [6, 5, 3])
    res = planning.allocate(spark, todo, {11: 10, 12: 5}, 2024, 11)
    got = {r["Código"]: (r["Ano_Previsto"], r["Mês_Previsto"]) for r in res.allocation.collect()}
    assert got == {"c0000": (2024, 11), "c0002": (2024, 11), "c0001": (2024, 12)}
    summary = [tuple(r) for r in res.summary.orderBy("Ano", "Mês").collect()]
    assert summary == [(2024, 11, 2, 9, 10), (2024, 12, 1, 5, 5)]


def test_allocation_zero_quantity_zero_capacity(spark):
    res = planning.allocate(spark, todo_frame(spark, [0]), {m: 0 for m in range(1, 13)}, 2024, 3)
    assert [(r["Ano_Previsto"], r["Mês_Previsto"]) for r in res.allocation.collect()] == [(2024, 3)]


def test_allocation_equals_loop_random(spark):
    rnd = random.Random(7)
    for case in range(3):
        n = 120
        qtys = [rnd.choice([0, 1, 2, 3, 5, 8, 13, 40, 90]) for _ in range(n)]
        prios = [rnd.choice([0, 1, 2, 3]) for _ in range(n)]
        values = [Decimal(rnd.randint(0, 50)) for _ in range(n)]
        cap = {m: rnd.randint(0, 120) for m in range(1, 13)}
        todo = todo_frame(spark, qtys, prios, values)
        rows = [(r[0], r[1], r[2], r[3]) for r in todo.collect()]
        res = planning.allocate(spark, todo, cap, 2024, 5, chunk_rows=15)
        got = {r["Código"]: (r["Ano_Previsto"], r["Mês_Previsto"]) for r in res.allocation.collect()}
        exp = loop(rows, cap, 2024, 5)
        assert got == exp, case
        # never over capacity, each item once
        per = {}
        for code, ym in got.items():
            per[ym] = per.get(ym, 0) + dict((r[0], r[3]) for r in rows)[code]
        assert all(v <= cap[m] for (y, m), v in per.items())


def test_ytd_metrics_fixture(spark):
    counts_raw = spark.createDataFrame(
        [("1", "5/1/2025 10:00", "10"), ("2", "6/2/2025 10:00", "0"), ("3", "7/2/2025 10:00", "5"),
         ("4", "7/9/2025 10:00", "99")],
        "`Código` string, `Atualização` string, `Quantidade Fisica` string",
    )
    fc = spark.createDataFrame(
        [("M", "1", 2025, 1, 8.0), ("M", "2", 2025, 2, 2.0), ("M", "9", 2025, 2, 4.0)],
        "Model_Name string, `Código` string, Ano_Previsto int, `Mês_Previsto` int, Previsao_Quantidade double",
    )
    detail, metrics, best = validation.ytd_validation(counts_raw, fc, 2025, 2)
    (m,) = metrics.collect()
    assert m["MAE"] == 3.0
    assert abs(m["WMAPE"] - 60.0) < 1e-9 and abs(m["MAPE"] - 60.0) < 1e-9
    assert m["Diferenca_Total"] == Decimal("-5.000")
    assert best.collect()[0]["Model_Name"] == "M"
    assert detail.count() == 3


def test_latest_year_month(spark):
    df = spark.createDataFrame([("1/2/2024 3:05",), ("31/12/2024 23:59",), ("bad",)], "`Atualização` string")
    assert validation.latest_year_month(df) == (2024, 12)


def test_delta_summary_signs_and_tax(spark):
    from cyclecount.operators import counts

    rows = [(2024, 1, "Valor Consultivado", Decimal("10.00"), Decimal("10.00")),
            (2024, 1, "Valor Consultivado", Decimal("-4.50"), Decimal("4.50")),
            (2024, 1, "Custo Evitado", Decimal("0.10"), Decimal("0.10"))]
    df = spark.createDataFrame(
        rows, "Ano int, `Mês` int, `Status Controle` string, `Vlr Delta` decimal(18,2), `Delta ABS` decimal(18,2)"
    )
    got = {r["Status Controle"]: r for r in counts.delta_summary(df).collect()}
    c = got["Valor Consultivado"]
    assert (c["n_counts"], c["positive_delta"], c["negative_delta"], c["net_delta"], c["abs_delta"]) == (
        2, Decimal("10.00"), Decimal("-4.50"), Decimal("5.50"), Decimal("14.50"))
    assert c["tax"] == Decimal("2.61")  # 14.50 x 0.18 = 2.61
    assert got["Custo Evitado"]["tax"] == Decimal("0.02")  # 0.018 -> half-even to cents


def test_widen_by_model(spark):
    detail = spark.createDataFrame(
        [("A", "1", Decimal("10"), Decimal("8"), Decimal("-2"), Decimal("2"), 20.0),
         ("B", "1", Decimal("10"), Decimal("10"), Decimal("0"), Decimal("0"), 0.0)],
        "Model_Name string, `Código` string, Real_YTD decimal(18,3), Prev_YTD decimal(18,3), "
        "Erro decimal(18,3), Erro_Abs decimal(18,3), APE double",
    )
    (r,) = validation.widen_by_model(detail, ["A", "B"]).collect()
    assert r["A_Prev_YTD"] == Decimal("8.000") and r["B_Erro"] == Decimal("0.000") and r["A_APE"] == 20.0
