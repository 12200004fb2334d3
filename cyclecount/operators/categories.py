"""Item history sets and categories (C5: X3-X5, J9-J10, F4, P23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclecount.functions import columns as C


def codes(df: DataFrame, code: str = "Código") -> DataFrame:
    """Distinct, non-null item codes as a one-column frame ``Código``."""
    return df.select(C.col(code).alias("Código")).where(F.col("Código").isNotNull()).distinct()


def active_since(rows: DataFrame, since: str, date: Column, code: str = "Código") -> DataFrame:
    """Items whose latest date, over all rows, is not before ``since`` (``yyyy-MM-dd``)."""
    latest = rows.groupBy(C.col(code).alias("Código")).agg(F.max(date).alias("_latest"))
    return latest.where(F.col("_latest") >= F.lit(since).cast("date")).select("Código")


def history_codes(counted: DataFrame, moved: DataFrame) -> DataFrame:
    """Codes that were counted or moved (distinct)."""
    return codes(counted).union(codes(moved)).distinct()


def items_with_history(stock_items: DataFrame, counted: DataFrame, moved: DataFrame) -> DataFrame:
    """Stock codes that were counted or moved (a semi join; no Python sets)."""
    return codes(stock_items).join(history_codes(counted, moved), "Código", "left_semi")


def items_without_history(stock_items: DataFrame, counted: DataFrame, moved: DataFrame) -> DataFrame:
    """Stock codes never counted and never moved (an anti join)."""
    return codes(stock_items).join(history_codes(counted, moved), "Código", "left_anti")


def item_category(abc_items: DataFrame, counted: DataFrame, moved: DataFrame) -> DataFrame:
    """Eligible items (book quantity > 0) labelled by count and movement history.

    Columns: Código, Curva_ABC, Lógica_ABC, Inventario, Movimentacao.
    """
    counted_flags = codes(counted).withColumn("_counted", F.lit(True))
    moved_flags = codes(moved).withColumn("_moved", F.lit(True))
    eligible = abc_items.where(C.col("Lógica_ABC") > 0).select("Código", "Curva_ABC", "Lógica_ABC")
    j = eligible.join(counted_flags, "Código", "left").join(moved_flags, "Código", "left")
    return j.select(
        "Código",
        "Curva_ABC",
        "Lógica_ABC",
        C.membership_label(F.coalesce("_counted", F.lit(False)), C.LABEL_COUNTED, C.LABEL_NEVER_COUNTED).alias(
            "Inventario"
        ),
        C.membership_label(F.coalesce("_moved", F.lit(False)), C.LABEL_MOVED, C.LABEL_NOT_MOVED).alias(
            "Movimentacao"
        ),
    )
