"""Writers (K1-K6). Outputs keep their column order; large outputs are written in
parallel by range partitions, sorted inside each file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators.forecasting import PLAN_COLS

# Export column names of the ABC curve, in order.
ABC_EXPORT = [
    ("Código", "Desenho"),
    ("Descrição", "Descrição"),
    ("Qtde_Locacao", "Qtde. Locação"),
    ("Lógica_ABC", "Soma de Estoqueada"),
    ("Custo_Unitário", "Custo Médio"),
    ("Valor_Estoque", "Soma de Valor Total"),
    ("Pct_Individual", "% individual"),
    ("Pct_Acumulada", "% acumulada"),
    ("Curva_ABC", "Curva ABC"),
]
CATEGORY_COLS = ["Código", "Inventario", "Movimentacao", "Curva_ABC", "Lógica_ABC"]
METRIC_COLS = ["Modelo", "MAE", "RMSE", "R2"]


def _writer(df: DataFrame, fmt: str, mode: str):
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true").option("sep", ";")
    return w


def write_abc_curve(curve: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1: the ABC curve with its nine export columns, by value descending."""
    out = curve.select(*[C.col(src).alias(dst) for src, dst in ABC_EXPORT])
    out = out.orderBy(F.desc("Soma de Valor Total"), "Desenho")
    _writer(out, fmt, mode).save(path)


def write_counts_daily(daily: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: daily count aggregates as Parquet partitioned by year; a year's rows are spread by
    ranges of the item code."""
    daily.repartitionByRange("Ano", "Código").write.mode(mode).partitionBy("Ano").parquet(path)


def model_label(name) -> F.Column:
    """Path-safe model label: ``Prev_`` + name, spaces/dashes -> ``_``, other symbols dropped."""
    c = F.concat(F.lit("Prev_"), F.col(name) if isinstance(name, str) else name)
    c = F.regexp_replace(c, "[ -]", "_")
    return F.regexp_replace(c, "[^0-9A-Za-z_]", "")


def write_forecast_plan(plan: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: one folder per model, rows sorted by (year, month, item) within files.

    Range partitioning on (model, year, month, item) spreads a large model over
    many tasks instead of one task per model.
    """
    out = plan.select(*PLAN_COLS).withColumn("Model_Label", model_label("Model_Name"))
    keys = ["Model_Name", "Ano_Previsto", "Mês_Previsto", "Código"]
    out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.write.mode(mode).partitionBy("Model_Name").parquet(path)


def write_model_metrics(metrics: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """K4: one row per model with MAE, RMSE, R2 (header written even when empty)."""
    out = metrics.select(*[C.col(c) for c in METRIC_COLS]).orderBy("Modelo")
    _writer(out.coalesce(1), fmt, mode).save(path)


def write_item_category(categories: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K5: item categories (code, count history, movement history, class, book quantity)."""
    _writer(categories.select(*[C.col(c) for c in CATEGORY_COLS]), fmt, mode).save(path)


def write_ytd(detail: DataFrame, metrics: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K6: YTD detail sorted by actual quantity descending, and the per-model summary."""
    d = detail.orderBy(F.desc("Real_YTD"), "Model_Name", "Código")
    _writer(d, fmt, mode).save(f"{path.rstrip('/')}/detail")
    _writer(metrics.coalesce(1), fmt, mode).save(f"{path.rstrip('/')}/metrics")
