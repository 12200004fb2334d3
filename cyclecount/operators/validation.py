"""Year-to-date check of forecasts against actual counts (C9: G19, F6, G11-G13, G15, J12, J13, P26)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import counts

def latest_year_month(counts_raw: DataFrame, today: _dt.date | None = None) -> tuple[int, int]:
    """(year, month) of the newest parsable count timestamp; else last calendar month."""
    ts = C.parse_minute_ts("Atualização")
    row = counts_raw.select(F.max(ts).alias("t")).first()
    if row is not None and row["t"] is not None:
        return row["t"].year, row["t"].month
    today = today or _dt.date.today()
    return (today.year - 1, 12) if today.month == 1 else (today.year, today.month - 1)


def actual_ytd(counts_raw: DataFrame, year: int, month: int, cleaned: bool = False) -> DataFrame:
    """F6 + G11: counted quantity per item summed over ``year`` months 1..``month``.

    As in the validation script, the raw rows are used without the status filter
    or the last-count pick; ``cleaned=True`` takes the closed rows' last counts (C2).
    """
    if cleaned:
        last = counts.clean_counts(counts_raw)
        window = last.where((F.col("Ano") == F.lit(year)) & (F.col("Mês") <= F.lit(month)))
        return window.groupBy(C.standardize_code("Código").alias("Código")).agg(
            F.coalesce(F.sum("Quantidade Fisica"), F.lit(0)).cast(C.QTY_TOTAL).alias("Real_YTD")
        )
    ts = C.parse_minute_ts("Atualização")
    rows = counts_raw.where(
        C.col("Código").isNotNull() & C.col("Atualização").isNotNull() & C.col("Quantidade Fisica").isNotNull()
    ).select(
        C.standardize_code("Código").alias("Código"),
        ts.alias("_ts"),
        F.coalesce(C.to_quantity("Quantidade Fisica"), F.lit(0).cast(C.QTY)).alias("_q"),
    )
    ytd = rows.where(
        F.col("_ts").isNotNull() & (F.year("_ts") == F.lit(year)) & (F.month("_ts") <= F.lit(month))
    )
    return ytd.groupBy("Código").agg(F.sum("_q").cast(C.QTY_TOTAL).alias("Real_YTD"))


def forecast_ytd(forecasts: DataFrame, year: int, month: int) -> DataFrame:
    """F6 + G12: forecast per model and item summed over the same window."""
    f = forecasts.select(
        C.col("Model_Name").cast("string").alias("Model_Name"),
        C.standardize_code("Código").alias("Código"),
        C.to_whole("Ano_Previsto", fill=-1).alias("_y"),
        C.to_whole("Mês_Previsto", fill=-1).alias("_m"),
        F.coalesce(C.to_quantity("Previsao_Quantidade"), F.lit(0).cast(C.QTY)).alias("_p"),
    )
    w = f.where((F.col("_y") == F.lit(year)) & (F.col("_m") <= F.lit(month)))
    return w.groupBy("Model_Name", "Código").agg(F.sum("_p").cast(C.QTY_TOTAL).alias("Prev_YTD"))


def model_names(forecasts: DataFrame) -> DataFrame:
    """The distinct model names, one row each."""
    names = forecasts.select(C.col("Model_Name").cast("string").alias("Model_Name"))
    return names.where(F.col("Model_Name").isNotNull()).distinct()


def ytd_detail(actual: DataFrame, prev: DataFrame, models: DataFrame | list[str]) -> DataFrame:
    """J12 + P26: one row per (model, actual item): forecast (0 if none), errors, APE.

    Each item's row carries the list of models, one aggregate over the models' names, and is
    exploded: the output has models x items rows by definition."""
    if isinstance(models, list):
        names = F.array(*[F.lit(m) for m in models])
        listed = actual.withColumn("_models", names)
    else:
        names = models.agg(F.sort_array(F.collect_set("Model_Name")).alias("_models"), F.lit(1).alias("_one"))
        listed = actual.withColumn("_one", F.lit(1)).join(F.broadcast(names), "_one")
    base = listed.select("Código", "Real_YTD", F.explode("_models").alias("Model_Name"))
    j = base.join(prev, ["Model_Name", "Código"], "left")
    p = F.coalesce("Prev_YTD", F.lit(0).cast(C.QTY_TOTAL)).cast(C.QTY_TOTAL)
    err = (p - F.col("Real_YTD")).cast(C.QTY_TOTAL)
    return j.select(
        "Model_Name",
        "Código",
        "Real_YTD",
        p.alias("Prev_YTD"),
        err.alias("Erro"),
        F.abs(err).cast(C.QTY_TOTAL).alias("Erro_Abs"),
        C.abs_pct_error("Real_YTD", F.abs(err)).alias("APE"),
    )


def ytd_metrics(detail: DataFrame) -> DataFrame:
    """Per model MAE, WMAPE (%), MAPE (% over actual > 0), totals and difference."""
    n = F.count(F.lit(1))
    sum_abs = F.sum("Erro_Abs")
    total_real = F.sum("Real_YTD")
    total_prev = F.sum("Prev_YTD")
    g = detail.groupBy("Model_Name").agg(
        n.alias("_n"),
        sum_abs.alias("_sa"),
        total_real.cast(C.QTY_TOTAL).alias("Total_Real"),
        total_prev.cast(C.QTY_TOTAL).alias("Total_Previsto"),
        F.sum("APE").alias("_ape_s"),
        F.count("APE").alias("_ape_n"),
    )
    return g.select(
        "Model_Name",
        (F.col("_sa").cast("double") / F.col("_n").cast("double")).alias("MAE"),
        F.when(F.col("Total_Real") != 0, F.col("_sa").cast("double") / F.col("Total_Real").cast("double") * 100.0)
        .alias("WMAPE"),
        F.when(F.col("_ape_n") > 0, F.col("_ape_s") / F.col("_ape_n").cast("double")).alias("MAPE"),
        "Total_Real",
        "Total_Previsto",
        (F.col("Total_Previsto") - F.col("Total_Real")).cast(C.QTY_TOTAL).alias("Diferenca_Total"),
    )


def best_model(metrics: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The model with the lowest MAE; one row, or none. Ties go to the model that comes
    first in ``order`` (models not in it come after, by name)."""
    m = metrics.where(F.col("MAE").isNotNull())
    place = F.lit(len(order or []))
    for i, name in reversed(list(enumerate(order or []))):
        place = F.when(F.col("Model_Name") == name, F.lit(i)).otherwise(place)
    return m.agg(
        F.min_by("Model_Name", F.struct("MAE", place, "Model_Name")).alias("Model_Name"),
        F.min("MAE").alias("MAE"),
    ).where(F.col("Model_Name").isNotNull())


def widen_by_model(detail: DataFrame, models: list[str]) -> DataFrame:
    """One row per item with the forecast, errors and APE of every model as columns."""
    return (
        detail.groupBy("Código", "Real_YTD")
        .pivot("Model_Name", models)
        .agg(
            F.first("Prev_YTD").alias("Prev_YTD"),
            F.first("Erro").alias("Erro"),
            F.first("Erro_Abs").alias("Erro_Abs"),
            F.first("APE").alias("APE"),
        )
    )


def ytd_validation(
    counts_raw: DataFrame,
    forecasts: DataFrame,
    year: int,
    month: int,
    order: list[str] | None = None,
    cleaned: bool = False,
):
    """(detail, metrics, best) for the year-to-date window; ``order`` settles ties and
    ``cleaned`` chooses the actual counts (``actual_ytd``)."""
    models = model_names(forecasts)
    detail = ytd_detail(actual_ytd(counts_raw, year, month, cleaned), forecast_ytd(forecasts, year, month), models)
    metrics = ytd_metrics(detail)
    return detail, metrics, best_model(metrics, order)
