"""Count records: clean, keep the last count per key, value, aggregate.

Input is the raw count file schema (all text): NOK, Status, Código, Locação, UdE,
Compartimento, Status Inventario, Atualização, Contagem, Física, Quantidade Fisica,
Lógica, Custo. Extra columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cyclecount.functions import columns as C

KEY_COLS = ["Data INV", "Código", "Locação", "UdE", "Compartimento", "Status Inventario"]
# The key with its most selective parts first, as sorting compares them in this order.
GROUP_ORDER = ["UdE", "Código", "Locação", "Data INV", "Compartimento", "Status Inventario"]
MEASURES = ["Lógica", "Quantidade Fisica", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS"]


def filter_closed(raw: DataFrame) -> DataFrame:
    """F1 + F2: item, location and unit present; NOK empty; Status FECHADO."""
    nok = C.col("NOK")
    return raw.where(
        C.col("Código").isNotNull()
        & C.col("Locação").isNotNull()
        & C.col("UdE").isNotNull()
        & (nok.isNull() | (nok == ""))
        & (C.col("Status") == C.STATUS_CLOSED)
    )


def typed_counts(raw: DataFrame) -> DataFrame:
    """Typed projection of the closed count rows (codes 13 wide)."""
    ts = C.parse_minute_ts("Atualização")
    return filter_closed(raw).select(
        C.fixed_code("Código").alias("Código"),
        C.col("Locação").cast("string").alias("Locação"),
        C.rack("Locação").alias("Estante"),
        C.to_number("UdE", C.WHOLE).alias("UdE"),
        C.to_number("Compartimento", C.WHOLE).alias("Compartimento"),
        C.col("Status Inventario").cast("string").alias("Status Inventario"),
        ts.alias("Atualização"),
        F.to_date(ts).alias("Data INV"),
        F.year(ts).alias("Ano"),
        F.month(ts).alias("Mês"),
        C.to_whole("Contagem").alias("Contagem"),
        C.to_quantity("Física").alias("Física"),
        C.to_quantity("Quantidade Fisica").alias("Quantidade Fisica"),
        C.to_quantity("Lógica").alias("Lógica"),
        C.parse_money_ptbr("Custo").alias("Custo"),
    )


def check_parsed(typed: DataFrame, cols: tuple[str, ...] = ("Atualização", "Custo")) -> None:
    """F8: raise when a parsed column is NULL on every row (one aggregate pass)."""
    row = typed.agg(*[F.count(C.col(c)).alias(c) for c in cols], F.count(F.lit(1)).alias("_n")).first()
    if row and row["_n"]:
        empty = [c for c in cols if row[c] == 0]
        if empty:
            raise ValueError(f"column(s) entirely unparsable: {empty}")


PARSED = ("Atualização", "Custo")


def raise_if_unparsed(observed: Observation) -> None:
    """F8 without a job of its own: after an action on counts cleaned with ``observed``, raise when
    a parsed column was NULL on every row."""
    got = observed.get
    empty = [c for c in PARSED if got["rows"] and not got[c]]
    if empty:
        raise ValueError(f"column(s) entirely unparsable: {empty}")


def last_counts(raw: DataFrame, observed: Observation | None = None) -> DataFrame:
    """The last count of each key (Contagem desc, then Atualização desc, nulls last).

    The key is kept as six columns (date, code, location, unit, compartment,
    status); rows with any key part missing are dropped. The pick is one
    aggregate of ``max(struct(order..., payload...))``: a hot key is combined
    map-side before the shuffle instead of sorting all its rows in one task, and
    the remaining fields break ties so the result is deterministic. ``observed`` takes the
    typed rows and how many of them have each parsed column, along with whatever action runs.
    """
    t = typed_counts(raw)
    if observed is not None:
        t = t.observe(observed, F.count(F.lit(1)).alias("rows"), *[F.count(C.col(c)).alias(c) for c in PARSED])
    # rack, year and month follow from the location and the time. Whether the key is whole goes
    # along: as a filter on the typed rows it would parse every key part a second time.
    payload = ["Contagem", "Atualização", "Física", "Quantidade Fisica", "Lógica", "Custo"]
    whole = reduce(Column.__and__, [C.col(k).isNotNull() for k in KEY_COLS]).alias("_whole")
    best = t.groupBy(*[C.col(k) for k in GROUP_ORDER]).agg(F.max(F.struct(*[C.col(c) for c in payload], whole)).alias("_last"))
    last = best.where(F.col("_last._whole")).select(
        *[C.col(k) for k in KEY_COLS], *[F.col("_last").getField(c).alias(c) for c in payload]
    )
    parts = {"Estante": C.rack("Locação"), "Ano": F.year("Atualização"), "Mês": F.month("Atualização")}
    return last.select("*", *[c.alias(name) for name, c in parts.items()])


def value_counts(last: DataFrame, drop_cancelled: bool = False) -> DataFrame:
    """Control label, counted quantity, book/counted value and deltas.

    Unit costs keep all their decimals; money is rounded once, half-even, to cents; the deltas are
    taken from the unrounded values. ``drop_cancelled`` removes ANULADO counts (the
    reference's filter compares the wrong column and keeps them; default keeps).
    """
    qty = C.counted_quantity("Física", "Quantidade Fisica")
    cost = C.col("Custo").cast(C.COST)
    book_raw = cost * C.col("Lógica").cast(C.QTY)
    counted_raw = cost * qty.cast(C.QTY)
    delta_raw = counted_raw - book_raw
    out = last.select(
        "Código",
        "Data INV",
        "Ano",
        "Mês",
        "Locação",
        "Status Inventario",
        C.control_label("Status Inventario").alias("Status Controle"),
        "Lógica",
        qty.alias("Quantidade Fisica"),
        C.money(cost).alias("Custo"),
        C.money(book_raw).alias("Valor Logica"),
        C.money(counted_raw).alias("Valor Fisico"),
        C.money(delta_raw).alias("Vlr Delta"),
        C.money(F.abs(delta_raw)).alias("Delta ABS"),
    )
    if drop_cancelled:
        out = out.where(C.col("Status Inventario") != C.STATUS_CANCELLED)
    return out


def daily_counts(valued: DataFrame) -> DataFrame:
    """Per (item, count date, year, month) sums of the six measures (NULL sum -> 0)."""
    aggs = []
    for m in MEASURES:
        dtype = C.QTY_TOTAL if m in ("Lógica", "Quantidade Fisica") else C.MONEY_TOTAL
        aggs.append(F.coalesce(F.sum(C.col(m)), F.lit(0)).cast(dtype).alias(m))
    return valued.groupBy("Código", "Data INV", "Ano", "Mês").agg(*aggs)


def clean_counts(raw: DataFrame, drop_cancelled: bool = False, observed: Observation | None = None) -> DataFrame:
    """Raw count rows -> valued last counts."""
    return value_counts(last_counts(raw, observed), drop_cancelled)


def delta_summary(
    valued: DataFrame,
    by: tuple[str, ...] = ("Ano", "Mês", "Status Controle"),
    tax_rate: Decimal = Decimal("0.18"),
) -> DataFrame:
    """Positive, negative, net and absolute value deltas and the tax on them, per group.

    From the project page (not fixed by reference code): the tax applies to the
    absolute delta of each group.
    """
    d = C.col("Vlr Delta")
    return valued.groupBy(*[C.col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("n_counts"),
        F.coalesce(F.sum(F.when(d > 0, d)), F.lit(0)).cast(C.MONEY_TOTAL).alias("positive_delta"),
        F.coalesce(F.sum(F.when(d < 0, d)), F.lit(0)).cast(C.MONEY_TOTAL).alias("negative_delta"),
        F.coalesce(F.sum(d), F.lit(0)).cast(C.MONEY_TOTAL).alias("net_delta"),
        F.coalesce(F.sum(C.col("Delta ABS")), F.lit(0)).cast(C.MONEY_TOTAL).alias("abs_delta"),
        F.bround(F.coalesce(F.sum(C.col("Delta ABS")), F.lit(0)).cast(C.MONEY_TOTAL) * F.lit(tax_rate).cast("decimal(6,4)"), 2)
        .cast(C.MONEY_TOTAL)
        .alias("tax"),
    )
