import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cyclecount.operators import abc
from cyclecount.sources import readers, writers


def write(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_stock_and_costs_csv(spark, tmp_dir):
    write(f"{tmp_dir}/stock.csv", "Produto;Descr. Produto;Estoqueada;Locação;Extra\n"
          "00012;Parafuso;10;A.1;x\n00012;Parafuso;5;A.2;y\n007;Porca;1;B.1;z\n", "latin-1")
    write(f"{tmp_dir}/costs.csv", "Material;Custo Médio;Ano;Período\n00012;2.5;2024;1\n007;4;2023;12\n", "latin-1")
    stock = readers.read_stock(spark, f"{tmp_dir}/stock.csv")
    assert stock.columns == ["Produto", "Descr. Produto", "Estoqueada", "Locação"]
    assert all(t == "string" for _, t in stock.dtypes)
    costs = readers.read_costs(spark, f"{tmp_dir}/costs.csv")
    curve = {r["Código"]: r for r in abc.abc_curve(stock, costs).collect()}
    assert curve["00012"]["Valor_Estoque"] == Decimal("37.50")
    assert curve["00012"]["Qtde_Locacao"] == 2
    writers.write_abc_curve(abc.abc_curve(stock, costs), f"{tmp_dir}/abc", fmt="csv")
    back = spark.read.options(header="true", sep=";").csv(f"{tmp_dir}/abc")
    assert back.columns[:3] == ["Desenho", "Descrição", "Qtde. Locação"] and back.count() == 2


def test_counts_from_files_with_different_headers(spark, tmp_dir):
    rest = "Locação;UdE;Compartimento;Status Inventario;Contagem;Física;Quantidade Fisica;Custo"
    write(f"{tmp_dir}/h.csv", f"Código;Status;Atualização;Lógica;{rest}\n12;FECHADO;1/2/2024 3:05;4;;;;;;;;\n", "latin-1")
    write(f"{tmp_dir}/c.csv", "Status;Código;NOK\nFECHADO;13;\n", "latin-1")
    skipped = []
    with pytest.warns(UserWarning, match="missing.csv"):
        df = readers.read_counts(spark, [f"{tmp_dir}/h.csv", f"{tmp_dir}/missing.csv", f"{tmp_dir}/c.csv"], skipped)
    assert skipped == [f"{tmp_dir}/missing.csv"]
    with pytest.raises(ValueError, match="Locação"):
        readers.read_counts(spark, [f"{tmp_dir}/c.csv"])
    got = sorted((r["Código"], r["Lógica"]) for r in df.collect())
    assert got == [("12", "4"), ("13", None)]
    assert set(readers.COUNT_COLS) <= set(df.columns)
    with pytest.warns(UserWarning):
        assert readers.read_counts(spark, [f"{tmp_dir}/none.csv"]) is None
    assert readers.read_count_timestamps(spark, f"{tmp_dir}/h.csv").columns == ["Atualização"]


def test_movement_folder(spark, tmp_dir):
    head = "Ano,Mes,CD_ARTICOLO,Tipo_Movimento,Qtd_Movimentos,Total_Qtde\n"
    write(f"{tmp_dir}/mov/a.csv", head + "2024,1,0012,Saída por Venda,1,3\n", "utf-8")
    write(f"{tmp_dir}/mov/b.csv", head + "2024,2,0013,Entrada no Estoque,2,4\n", "utf-8")
    write(f"{tmp_dir}/mov/notes.txt", "ignored", "utf-8")
    df = readers.read_movements(spark, f"{tmp_dir}/mov")
    assert sorted(r["Tipo_Movimento"] for r in df.collect()) == ["Entrada no Estoque", "Saída por Venda"]
    assert readers.read_movements(spark, f"{tmp_dir}/mov", by_file=True).count() == 2


def test_empty_movement_folder(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/none")
    for by_file in (False, True):
        df = readers.read_movements(spark, f"{tmp_dir}/none", by_file=by_file)
        assert df.columns == readers.MOVEMENT_COLS and df.count() == 0


def test_movement_files_with_different_headers(spark, tmp_dir):
    write(f"{tmp_dir}/mv/a.csv", "Ano,Mes,CD_ARTICOLO,Tipo_Movimento,Qtd_Movimentos,Total_Qtde\n2024,1,1,X,1,3\n",
          "utf-8")
    write(f"{tmp_dir}/mv/b.csv", "CD_ARTICOLO,Ano,Mes,Tipo_Movimento,Total_Qtde\n2,2024,2,Y,4\n", "utf-8")
    with pytest.raises(Exception):
        readers.read_movements(spark, f"{tmp_dir}/mv").collect()
    got = sorted((r["CD_ARTICOLO"], r["Mes"], r["Qtd_Movimentos"])
                 for r in readers.read_movements(spark, f"{tmp_dir}/mv", by_file=True).collect())
    assert got == [("1", "1", "1"), ("2", "2", None)]


def test_forecast_plan_round_trip(spark, tmp_dir):
    from cyclecount.operators.forecasting import PLAN_COLS

    rows = [("12", "Ridge (v2)", 2024, 5, "A", 3, Decimal("1.00"), Decimal("3.00"), Decimal("2.000"),
             Decimal("2.00"), Decimal("-1.00"), Decimal("1.00"), Decimal("0.18"))]
    schema = (
        "`Código` string, Model_Name string, Ano_Previsto int, `Mês_Previsto` int, Curva_ABC string, "
        "`Lógica_ABC` long, `Custo_Unitário` decimal(18,2), Valor_Estoque decimal(18,2), "
        "Previsao_Quantidade decimal(18,3), `Valor Fisico Previsto` decimal(18,2), "
        "`Vlr Delta Previsto` decimal(18,2), `Delta ABS Previsto` decimal(18,2), "
        "`TOTAL IMPOSTO Previsto` decimal(18,2)"
    )
    plan = spark.createDataFrame(rows, schema)
    assert plan.columns == PLAN_COLS
    writers.write_forecast_plan(plan, f"{tmp_dir}/plan")
    back = readers.read_forecasts(spark, f"{tmp_dir}/plan")
    (r,) = back.collect()
    assert r["Model_Name"] == "Ridge (v2)" and r["Código"] == "12"
    label = plan.select(writers.model_label("Model_Name")).first()[0]
    assert label == "Prev_Ridge_v2"


def test_counts_daily_partitioned(spark, tmp_dir):
    df = spark.createDataFrame([("1", 2023, 5), ("2", 2024, 6)], "`Código` string, Ano int, `Mês` int")
    writers.write_counts_daily(df, f"{tmp_dir}/daily")
    back = spark.read.parquet(f"{tmp_dir}/daily")
    assert back.where(F.col("Ano") == 2024).count() == 1


def _counts_text(n, head=None, tail=""):
    cols = ["NOK", "Status", "Código", "Locação", "UdE", "Compartimento", "Status Inventario", "Atualização",
            "Contagem", "Física", "Quantidade Fisica", "Custo", "Lógica"]
    rows = [f";FECHADO;{i};A.1;1;1;FECHADO;1/2/2024 3:05;1;;2;1,00;3" for i in range(n)]
    return ";".join(head or cols) + "\n" + "\n".join(rows) + "\n" + tail


def test_files_that_break_while_being_read(spark, tmp_dir):
    import gzip

    write(f"{tmp_dir}/a.csv", _counts_text(5, tail=";FECHADO;9\n"), "latin-1")
    write(f"{tmp_dir}/dir/one.csv", _counts_text(3), "latin-1")
    write(f"{tmp_dir}/dir/two.csv", _counts_text(4), "latin-1")
    write(f"{tmp_dir}/empty.csv", "", "latin-1")
    whole = gzip.compress(_counts_text(50_000).encode("latin-1"))
    for name in ("b", "c c"):
        with open(f"{tmp_dir}/{name}.csv.gz", "wb") as f:
            f.write(whole[: len(whole) // 2])
    with open(f"{tmp_dir}/d.csv.gz", "wb") as f:
        f.write(whole)
    with open(f"{tmp_dir}/junk.csv.gz", "wb") as f:
        f.write(b"not compressed at all")
    paths = [f"{tmp_dir}/{p}" for p in ("a.csv", "b.csv.gz", "dir", "none.csv", "c c.csv.gz", "d.csv.gz", "junk.csv.gz", "empty.csv")]
    df, report = readers.read_counts_reported(spark, paths)
    got = [tuple(r)[1:] for r in report.collect()]
    assert got == [
        ("read", 1, 6, 1), ("broken", 0, 0, 0), ("read", 2, 7, 0), ("missing", 0, 0, 0), ("broken", 0, 0, 0),
        ("read", 1, 50_000, 0), ("unreadable", 0, 0, 0), ("unreadable", 0, 0, 0),
    ]
    assert df.count() == 6 + 7 + 50_000
    assert readers.read_counts_reported(spark, paths[1:2])[0] is None


def test_headers_take_one_job(spark, tmp_dir):
    paths = []
    for i in range(6):
        write(f"{tmp_dir}/{i}.csv", _counts_text(2), "latin-1")
        paths.append(f"{tmp_dir}/{i}.csv")
    assert _jobs(spark, lambda: readers._headers(spark, paths, readers.COUNT_FILE_OPTIONS)) == 1


def _jobs(spark, action):
    import uuid

    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup(uuid.uuid4().hex, "others")


def test_parsed_columns_are_observed_by_the_write(spark, tmp_dir):
    from pyspark.sql import Observation

    from cyclecount.operators import counts

    write(f"{tmp_dir}/a.csv", _counts_text(5), "latin-1")
    raw = readers.read_counts(spark, [f"{tmp_dir}/a.csv"])

    def daily(observed=None, source=raw):
        return counts.daily_counts(counts.clean_counts(source, observed=observed))

    seen = Observation("parsed")
    with_it = _jobs(spark, lambda: writers.write_counts_daily(daily(seen), f"{tmp_dir}/x"))
    counts.raise_if_unparsed(seen)
    assert seen.get == {"rows": 5, "Atualização": 5, "Custo": 5}
    assert with_it == _jobs(spark, lambda: writers.write_counts_daily(daily(), f"{tmp_dir}/y"))
    bad = Observation("bad")
    daily(bad, raw.withColumn("Custo", F.lit("n/a"))).write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="Custo"):
        counts.raise_if_unparsed(bad)


def test_an_export_of_several_files_is_truncated_in_tasks(spark, tmp_dir):
    from cyclecount.plans import checks

    rows = spark.range(0, 30_000, 1, 3).select(*[F.concat(F.lit(c[0]), F.col("id").cast("string")).alias(c) for c in readers.COUNT_COLS])
    whole = f"{tmp_dir}/whole"
    rows.write.options(**readers.COUNT_FILE_OPTIONS, compression="gzip").csv(whole)
    cut = checks._truncated(spark, whole)
    size = lambda d: {f: os.path.getsize(f"{d}/{f}") for f in os.listdir(d) if f.startswith("part-")}
    assert len(size(cut.removeprefix("file:"))) == 3
    assert size(cut.removeprefix("file:")) == {f: n // 2 for f, n in size(whole).items()}
    df, report = readers.read_counts_reported(spark, [whole, cut])
    assert {(r["path"], r["status"], r["files"], r["rows"]) for r in report.collect()} == {(whole, "read", 3, 30_000), (cut, "broken", 0, 0)}
    assert df.count() == 30_000
