"""Per-item time-series features on the daily counts (C6: J8, J9, P7, W4, W5, G8, J5, P17, P18, F5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import movements, stats

ABC_INFO = ["Curva_ABC", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque"]
TIME_FEATURES = ["Tendencia_Anual", "Media_Movel_3M", "Media_Movel_6M", "Media_ABC", "Desvio_ABC"]
VALUE_COLS = ["Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS"]
TARGET = "Quantidade Fisica"


def abc_items(curve: DataFrame) -> DataFrame:
    """One row per standardized item code from the ABC curve.

    The curve is per (item, description) and code standardization can merge
    items, so joins on the code alone would multiply rows. Quantities and values
    are summed, the cost is the highest and the class is that of the most
    valuable row (ties: the better class).
    """
    c = curve.withColumn("Código", C.standardize_code("Código"))
    return c.groupBy("Código").agg(
        F.sum("Lógica_ABC").cast(C.QTY_TOTAL).alias("Lógica_ABC"),
        F.max("Custo_Unitário").alias("Custo_Unitário"),
        F.sum("Valor_Estoque").cast(C.MONEY_TOTAL).alias("Valor_Estoque"),
        F.sum("Qtde_Locacao").alias("Qtde_Locacao"),
        F.max_by("Curva_ABC", F.struct(F.col("Valor_Estoque"), -F.ascii("Curva_ABC"))).alias("Curva_ABC"),
    )


def standardized_daily(daily: DataFrame) -> DataFrame:
    """Daily counts with the 13-wide code standardized (leading zeros removed)."""
    return daily.withColumn("Código", C.standardize_code("Código"))


def with_abc(daily_std: DataFrame, items: DataFrame) -> DataFrame:
    """J8 + P17: daily counts left-joined to the item's ABC info; 'Unknown' / 0 fill."""
    j = daily_std.join(items.select("Código", *ABC_INFO), "Código", "left")
    return j.withColumns(
        {
            "Curva_ABC": F.coalesce("Curva_ABC", F.lit(C.UNKNOWN_CLASS)),
            "Lógica_ABC": F.coalesce("Lógica_ABC", F.lit(0).cast(C.QTY)),
            "Custo_Unitário": F.coalesce("Custo_Unitário", F.lit(0).cast(C.COST)),
            "Valor_Estoque": F.coalesce("Valor_Estoque", F.lit(0).cast(C.MONEY)),
        }
    )


def _item_window() -> Window:
    # rows of an item in time order; several count dates in one month keep date order
    return Window.partitionBy("Código").orderBy("_month", "Data INV", TARGET, "Lógica")


def time_features(
    df: DataFrame, lag: int = 12, windows: tuple[int, ...] = (3, 6), by: str = "row"
) -> DataFrame:
    """W4 + W5 per item, in row order (one row per count date).

    Tendencia_Anual: percent change against the row ``lag`` rows back, after
    carrying the last known value forward; division by zero or no such row -> 0.
    ``by="month"`` compares with the last row of the month ``lag`` months back instead.
    Media_Movel_kM: mean of the up to k previous rows (current row excluded);
    none -> 0. An item has at most one row per day, so every window partition is
    bounded by the calendar, whatever the item's share of the data.
    """
    q = C.col(TARGET)
    w = _item_window()
    d = df.withColumn("_month", C.month_start("Ano", "Mês")).where(F.col("_month").isNotNull())
    filled = F.last(q, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_qf", filled)
    if by == "month":
        number = F.year("_month") * 12 + F.month("_month")
        month = Window.partitionBy("Código").orderBy(number).rangeBetween(-lag, -lag)
        latest = F.max(F.struct("Data INV", TARGET, "Lógica", "_qf")).over(month)
        prev = latest.getField("_qf")
    else:
        prev = F.lag("_qf", lag).over(w)
    pct = F.try_divide(F.col("_qf").cast("double"), prev.cast("double")) - F.lit(1.0)
    out = d.withColumn("Tendencia_Anual", F.coalesce(C.finite_or_null(pct * F.lit(100.0)), F.lit(0.0)))
    for k in windows:
        frame = w.rowsBetween(-k, -1)
        s = F.sum(q.cast(C.QTY)).over(frame)
        n = F.count(q).over(frame)
        out = out.withColumn(f"Media_Movel_{k}M", F.coalesce(stats.mean_of(n, s), F.lit(0.0)))
    return out.drop("_month", "_qf")


def class_stats(df: DataFrame, before_year: int | None = None) -> DataFrame:
    """G8 + G9: per ABC class mean and sample std of the target; NULL -> global value.
    ``before_year`` takes them from earlier years only (the training years); a class without
    rows there keeps its place and has the global values.

    The global moments are the sums of the class moments, taken by a window over
    the class table (at most a handful of rows: A, B, C, Unknown). That table is
    then joined back with a broadcast bounded by the class labels.
    """
    target = C.col(TARGET) if before_year is None else F.when(F.col("Ano") < F.lit(before_year), C.col(TARGET))
    g = df.groupBy("Curva_ABC").agg(*stats.moment_aggs(target, "_m"))
    every = Window.partitionBy()
    n, s, s2 = F.col("_m_n"), F.col("_m_s"), F.col("_m_s2")
    gn, gs, gs2 = F.sum(n).over(every), F.sum(s).over(every), F.sum(s2).over(every)
    return g.select(
        "Curva_ABC",
        F.coalesce(stats.mean_of(n, s), stats.mean_of(gn, gs)).alias("Media_ABC"),
        F.coalesce(stats.std_of(n, s, s2), stats.std_of(gn, gs, gs2)).alias("Desvio_ABC"),
    )


def build_features(
    daily: DataFrame,
    curve: DataFrame,
    mov_features: DataFrame | movements.Sums | None,
    with_history: DataFrame,
    placeholder_types: tuple[str, ...] = movements.EXPECTED_TYPES,
    items: DataFrame | None = None,
    stats_before_year: int | None = None,
    trend_by: str = "row",
) -> DataFrame:
    """The feature table for items with history.

    daily: counts_daily (13-wide codes); curve: the ABC curve; mov_features: the
    movement feature table, or its sums, whose totals are then made for the joined rows only
    (or None); with_history: one-column ``Código`` frame;
    ``stats_before_year`` and ``trend_by``: see ``class_stats`` and ``time_features``;
    items: ``abc_items(curve)`` when the caller already has it materialized.
    """
    items = abc_items(curve) if items is None else items
    base = with_abc(standardized_daily(daily), items).join(with_history, "Código", "left_semi")
    tf = time_features(base, by=trend_by)
    # class statistics need only class and target: taken from the rows before the windows
    tf = tf.join(F.broadcast(class_stats(base, stats_before_year)), "Curva_ABC", "left")
    # the rows have history, so movements of other items find none of them
    if isinstance(mov_features, movements.Sums):
        mcols = movements.feature_columns(mov_features.types)
        out = mov_features.of(tf.join(mov_features.rows, movements.KEYS, "left"))
    elif mov_features is not None:
        mcols = [c for c in mov_features.columns if c not in movements.KEYS]
        out = tf.join(mov_features, movements.KEYS, "left")
        out = out.fillna(0, subset=mcols)
    else:
        mcols = movements.feature_columns(placeholder_types)
        out = tf.withColumns({c: F.lit(0.0) for c in mcols})
    out = out.fillna(0, subset=TIME_FEATURES + VALUE_COLS).fillna(C.UNKNOWN_CLASS, subset=["Curva_ABC"])
    out = out.dropna(subset=["Código", "Ano", "Mês", TARGET])
    lead = ["Código", "Data INV", "Ano", "Mês", "Lógica", TARGET] + VALUE_COLS + ABC_INFO + TIME_FEATURES
    return out.select(*lead, *mcols)
