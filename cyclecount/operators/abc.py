"""ABC classification of items by stock value (C1 and its parts W1, J1, P12, G1, G2, W3)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import prefix

# Class cuts on the running share of stock value.
DEFAULT_CUT_A = Decimal("0.80")
DEFAULT_CUT_B = Decimal("0.95")


def latest_cost(
    costs: DataFrame,
    item: str = "Material",
    cost: str = "Custo Médio",
    year: str = "Ano",
    month: str = "Mes",
    out_item: str = "Produto",
    out_cost: str = "Custo Médio",
) -> DataFrame:
    """The most recent cost of each item, by (year, month) descending, nulls last.

    Written as one aggregate (``max_by`` over a struct ordering) instead of a
    ``row_number`` window so a hot item is combined map-side before the shuffle.
    Ties on (year, month) are broken by the larger cost, making the pick
    deterministic.
    """
    c = costs.select(
        C.strip_ws(item).alias("_item"),
        C.to_number(cost, C.COST, number=C.is_number(costs, cost)).alias("_cost"),
        C.to_whole(year, number=C.is_number(costs, year)).alias("_y"),
        C.to_whole(month, number=C.is_number(costs, month)).alias("_m"),
    ).where(F.col("_item").isNotNull())
    return c.groupBy("_item").agg(
        F.max_by("_cost", F.struct("_y", "_m", "_cost")).alias(out_cost)
    ).withColumnRenamed("_item", out_item)


def stock_by_item(
    stock: DataFrame,
    item: str = "Produto",
    desc: str = "Descr. Produto",
    qty: str = "Estoqueada",
    location: str = "Locação",
) -> DataFrame:
    """G1 part 1: per (item, description): total quantity and distinct locations.

    Rows with a missing item or description are dropped (a pandas group-by drops
    null keys).
    """
    s = stock.select(
        C.strip_ws(item).alias("Código"),
        C.col(desc).cast("string").alias("Descrição"),
        C.to_quantity(qty, C.is_number(stock, qty)).alias("_qty"),
        C.col(location).cast("string").alias("_loc"),
    ).where(F.col("Código").isNotNull() & F.col("Descrição").isNotNull())
    return s.groupBy("Código", "Descrição").agg(
        F.coalesce(F.sum("_qty"), F.lit(0)).cast(C.QTY_TOTAL).alias("Lógica_ABC"),
        F.countDistinct("_loc").alias("Qtde_Locacao"),
    )


def stock_valued(stock: DataFrame, costs: DataFrame, **names) -> DataFrame:
    """J1 + P12 + G1: item totals joined to the latest cost; value = qty x cost.

    Aggregating stock per item *before* the join means the join sees one row per
    item instead of one per stock row. The latest-cost table has one row per item
    and grows with the catalogue, so no broadcast is forced: AQE converts the join
    to a broadcast at run time only when the measured side is small.
    """
    cost_names = {k: v for k, v in names.items() if k in ("item", "cost", "year", "month")}
    stock_names = {k: v for k, v in names.items() if k in ("s_item", "desc", "qty", "location")}
    items = stock_by_item(stock, **{k.removeprefix("s_"): v for k, v in stock_names.items()})
    lc = latest_cost(costs, **cost_names).withColumnRenamed("Produto", "Código")
    j = items.join(lc, "Código", "left")
    return j.select(
        "Código",
        "Descrição",
        "Qtde_Locacao",
        "Lógica_ABC",
        F.coalesce(F.col("Custo Médio"), F.lit(0).cast(C.COST)).alias("Custo_Unitário"),
        F.coalesce(C.value_of("Custo Médio", "Lógica_ABC"), F.lit(0).cast(C.MONEY)).alias("Valor_Estoque"),
    )


def classify(
    valued: DataFrame,
    cut_a: Decimal = DEFAULT_CUT_A,
    cut_b: Decimal = DEFAULT_CUT_B,
    value: str = "Valor_Estoque",
    order_tiebreak: tuple[str, ...] = ("Código", "Descrição"),
) -> DataFrame:
    """G2 + W3 + classes: share, running share by value descending, class A/B/C.

    A is ``running value <= cut_a * total``, B ``<= cut_b * total``, else C
    (compared in exact decimals). With total <= 0 every share is 0 and every item
    is A. ``valued`` is written once, by ranges of its order.
    """
    order = [prefix.SortKey(value, False)] + [prefix.SortKey(c, True) for c in order_tiebreak]
    run = prefix.running_sum(valued, order, value, "_cum", total_out="_total")
    total = F.col("_total")
    positive = total > 0
    cum = F.col("_cum")
    ca = F.lit(cut_a).cast("decimal(10,4)")
    cb = F.lit(cut_b).cast("decimal(10,4)")
    klass = (
        F.when(~positive, F.lit("A"))
        .when(cum <= total * ca, F.lit("A"))
        .when(cum <= total * cb, F.lit("B"))
        .otherwise(F.lit("C"))
    )
    share = F.when(positive, F.col(value).cast("double") / total.cast("double")).otherwise(F.lit(0.0))
    running = F.when(positive, cum.cast("double") / total.cast("double")).otherwise(F.lit(0.0))
    return run.select(
        *[c for c in valued.columns],
        share.alias("Pct_Individual"),
        running.alias("Pct_Acumulada"),
        klass.alias("Curva_ABC"),
    )


def abc_curve(
    stock: DataFrame,
    costs: DataFrame,
    cut_a: Decimal = DEFAULT_CUT_A,
    cut_b: Decimal = DEFAULT_CUT_B,
    **names,
) -> DataFrame:
    """The ABC curve of the current stock.

    Columns: Código, Descrição, Qtde_Locacao, Lógica_ABC, Custo_Unitário,
    Valor_Estoque, Pct_Individual, Pct_Acumulada, Curva_ABC (one row per
    item and description).
    """
    return classify(stock_valued(stock, costs, **names), cut_a, cut_b)


def class_summary(curve: DataFrame) -> DataFrame:
    """Items, stock value and value share per ABC class."""
    per = curve.groupBy("Curva_ABC").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("Lógica_ABC").cast(C.QTY_TOTAL).alias("total_qty"),
        F.sum("Valor_Estoque").cast(C.MONEY_TOTAL).alias("total_value"),
    )
    # at most four class rows reach this window, so one partition is bounded
    t = F.sum("total_value").over(Window.partitionBy())
    return per.select(
        "Curva_ABC",
        "n_items",
        "total_qty",
        "total_value",
        F.when(t > 0, F.col("total_value").cast("double") / t.cast("double"))
        .otherwise(F.lit(0.0))
        .alias("value_share"),
    )
