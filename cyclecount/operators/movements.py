"""Monthly movement features per item (C4: X2, P1, P3, F5, G4-G7, J3/J4 folded).

Input: movement export rows with Ano, Mes, CD_ARTICOLO, Tipo_Movimento,
Qtd_Movimentos, Total_Qtde. Output: one row per (Código, Ano, Mês) with, per
movement type ``t``, ``t_Total_Qtde_Mensal`` and ``t_Qtd_Movimentos_Mensal``, then
Total_Geral_Qtde_Mensal, Total_Geral_Qtd_Movimentos_Mensal, Num_Tipos_Mov_Mensal.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclecount.functions import columns as C

# The six movement types the feature table always carries.
EXPECTED_TYPES = (
    "Entrada na Quarentena",
    "Entrada no Estoque",
    "Movimentação Interna",
    "Movimentação com Quarentena",
    "Saída da Quarentena",
    "Saída por Venda",
)
QTY_SUFFIX = "_Total_Qtde_Mensal"
COUNT_SUFFIX = "_Qtd_Movimentos_Mensal"
TOTAL_COLS = ["Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal", "Num_Tipos_Mov_Mensal"]
KEYS = ["Código", "Ano", "Mês"]
# measures of a movement, with the endings of their columns by type
SUMMED = {"Total_Qtde": QTY_SUFFIX, "Qtd_Movimentos": COUNT_SUFFIX}


def feature_columns(types) -> list[str]:
    return [f"{t}{QTY_SUFFIX}" for t in types] + [f"{t}{COUNT_SUFFIX}" for t in types] + TOTAL_COLS


def movement_rows(mov: DataFrame, dedup: bool = True) -> DataFrame:
    """P1 + X2 + P3 + F5: standardized code, exact duplicates removed, numbers parsed.

    Duplicates are removed on the rows as read (after the code is standardized),
    which also drops legitimately equal movements (``dedup=False`` keeps them).
    """
    m = mov.select(
        C.col("Ano").alias("Ano"),
        C.col("Mes").alias("Mês"),
        C.standardize_code("CD_ARTICOLO").alias("Código"),
        C.col("Tipo_Movimento").cast("string").alias("Tipo_Movimento"),
        C.col("Qtd_Movimentos").alias("Qtd_Movimentos"),
        C.col("Total_Qtde").alias("Total_Qtde"),
    )
    if dedup:
        m = m.dropDuplicates()
    number = {c: C.is_number(m, c) for c in m.columns}
    return m.select(
        C.to_whole("Ano", fill=0, number=number["Ano"]).alias("Ano"),
        C.to_whole("Mês", fill=0, number=number["Mês"]).alias("Mês"),
        "Código",
        "Tipo_Movimento",
        *[
            F.coalesce(C.to_quantity(c, number[c]), F.lit(0).cast(C.QTY)).alias(c)
            for c in ("Qtd_Movimentos", "Total_Qtde")
        ],
    ).dropna(subset=["Código", "Tipo_Movimento"])


def movement_types(mov: DataFrame) -> list[str]:
    """Distinct movement types present, sorted: the columns of the wide table. Where types
    are many, keep the long form of ``by_type``, or widen over a list of one's own.

    Read from the raw rows (those with a code and a type, as the feature rows
    keep): the same set as after de-duplication, without its shuffle.
    """
    # a code is null as read or not at all: nothing has to be parsed for it
    t = mov.where(C.col("CD_ARTICOLO").isNotNull() & C.col("Tipo_Movimento").isNotNull())
    t = t.select(C.col("Tipo_Movimento").cast("string").alias("t")).distinct()
    return sorted(r[0] for r in t.collect())


def by_type(rows: DataFrame) -> DataFrame:
    """Per (item, year, month, type): summed quantity and summed movement count."""
    return rows.groupBy(*KEYS, "Tipo_Movimento").agg(
        F.sum("Total_Qtde").cast(C.QTY_TOTAL).alias("Total_Qtde_Mov"),
        F.sum("Qtd_Movimentos").cast(C.QTY_TOTAL).alias("Qtd_Mov_Count"),
    )


def totals(rows: DataFrame) -> DataFrame:
    """G6 + G7: per (item, year, month): total quantity, total count, distinct types."""
    return rows.groupBy(*KEYS).agg(*_total_aggs())


def _total_aggs():
    return [
        F.sum("Total_Qtde").cast(C.QTY_TOTAL).alias("Total_Geral_Qtde_Mensal"),
        F.sum("Qtd_Movimentos").cast(C.QTY_TOTAL).alias("Total_Geral_Qtd_Movimentos_Mensal"),
        # at most one entry per movement type: a bounded set, no Expand for DISTINCT
        F.size(F.collect_set("Tipo_Movimento")).cast("long").alias("Num_Tipos_Mov_Mensal"),
    ]


def movement_features(mov: DataFrame, types: list[str] | None = None, dedup: bool = True) -> DataFrame:
    """C4: the monthly movement feature table.

    The reference pivots twice, groups a third time and joins the pieces; here
    the pivot is written as conditional sums so that the type pivot, the totals
    and the distinct-type count are ONE aggregation over the de-duplicated rows
    (two shuffles in all: de-duplication, then the item-month aggregate, both
    with map-side partial aggregation). ``types`` defaults to the types present; then every
    row has one of them, so the totals are the sums of the types and their number is that of
    the bits set. All buffers are whole numbers, which a hash aggregate updates in place.
    """
    every = types is None
    if types is None:
        types = movement_types(mov)
    if not every or not types:
        rows, t = movement_rows(mov, dedup), F.col("Tipo_Movimento")
        zero = F.lit(0).cast(C.QTY)
        aggs = [
            F.coalesce(F.sum(F.when(t == ty, F.col(m))), zero).cast(C.QTY_TOTAL).alias(f"{ty}{suffix}")
            for m, suffix in SUMMED.items()
            for ty in types
        ]
        return rows.groupBy(*KEYS).agg(*aggs, *_total_aggs())
    return movement_sums(mov, types, dedup).features()


@dataclass(frozen=True)
class Sums:
    """The movement feature table before its totals are decimals: per (Código, Ano, Mês) the whole
    numbers ``_parts`` of each type's sums, and the types seen as bits. A table that is written or
    joined carries these; ``of`` makes the features of the rows that remain."""

    rows: DataFrame
    types: list[str]

    def features(self) -> DataFrame:
        return self.of(self.rows).select(*KEYS, *feature_columns(self.types))

    def of(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the feature columns in place of the sums; 0 where a row has no sums."""

        def total(m: str, of: Iterable[int]) -> Column:
            return F.struct(*[reduce(Column.__add__, [F.col(f"_s{i}_{m}_{k}") for i in of]).alias(f"p{k}") for k in range(2)])

        every = range(len(self.types))
        each = [(m, [i], f"{ty}{suffix}") for m, suffix in SUMMED.items() for i, ty in enumerate(self.types)]
        each += [(m, every, name) for m, name in zip(SUMMED, TOTAL_COLS)]
        # one expression over an array: written out by column, the code of a row is too long for the JVM
        # to compile, and longer with every type
        found = F.transform(F.array(*[total(m, of) for m, of, _ in each]), lambda x: _whole(x["p0"], x["p1"]))
        bits = [F.coalesce(F.bit_count(f"_seen{a}"), F.lit(0)) for a in range(0, len(self.types), BITS)]
        kinds = reduce(Column.__add__, bits).cast("long")
        sums = [c for c in self.rows.columns if c not in KEYS]
        wide = rows.withColumns({"_found": found, TOTAL_COLS[2]: kinds}).drop(*sums)
        zero = F.lit(0).cast(C.QTY_TOTAL)
        return wide.withColumns({name: F.coalesce(F.get("_found", F.lit(i)), zero) for i, (_, _, name) in enumerate(each)}).drop("_found")


def movement_sums(mov: DataFrame, types: list[str], dedup: bool = True) -> Sums:
    """The sums of the movement features by type, for all ``types`` present (at least one)."""
    t = F.col("Tipo_Movimento")
    parts = {(m, k): f"_{m}_{k}" for m in SUMMED for k in range(2)}
    rows = movement_rows(mov, dedup)
    split = rows.select(*KEYS, t, *[part.alias(parts[m, k]) for m in SUMMED for k, part in enumerate(_parts(F.col(m)))])
    sums = [
        F.sum(F.when(t == ty, F.col(part)).otherwise(F.lit(0))).alias(f"_s{i}{part}")
        for i, ty in enumerate(types)
        for part in parts.values()
    ]
    seen = [  # a bit a type, so many to a number
        F.bit_or(F.coalesce(*[F.when(t == ty, F.lit(1 << b)) for b, ty in enumerate(types[a : a + BITS])], F.lit(0))).alias(f"_seen{a}")
        for a in range(0, len(types), BITS)
    ]
    return Sums(split.groupBy(*KEYS).agg(*sums, *seen), types)


#: Types that share a number of bits.
BITS = 62


def _parts(quantity: Column) -> tuple[Column, Column]:
    """A quantity (decimal(20,6)) as whole numbers: its ten thousands, and millionths of the rest.
    Both have at most ten digits, so their sums stay exact for more rows than a total has room for."""
    high = (quantity.cast("long") / F.lit(10**4)).cast("long")
    rest = (quantity - (high * F.lit(10**4)).cast("decimal(15,0)")) * F.lit(10**6)
    return high, rest.cast("long")


def _whole(high: Column, rest: Column) -> Column:
    """The total of summed ``_parts``; one that is small enough is put together as a whole number.
    A type that an item-month lacks has 0, which needs no arithmetic."""
    none = (high == F.lit(0)) & (rest == F.lit(0))
    millionth = F.lit(Decimal("0.000001"))
    small = (high * F.lit(10**10) + rest).cast("decimal(19,0)") * millionth
    wide = high.cast("decimal(19,0)") * F.lit(Decimal(10**4)) + rest.cast("decimal(19,0)") * millionth
    room = high.between(-(10**8), 10**8) & rest.between(-(10**18), 10**18)
    return F.when(none, F.lit(0).cast(C.QTY_TOTAL)).when(room, small.cast(C.QTY_TOTAL)).otherwise(wide.cast(C.QTY_TOTAL))
