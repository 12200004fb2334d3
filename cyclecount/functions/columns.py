"""Scalar column functions: ``Column -> Column``, all built-in Spark expressions.

Nothing here runs Python per row; every function composes ``pyspark.sql.functions``
so it stays inside whole-stage codegen. ANSI mode is on in Spark 4, so every parse
uses a ``try_*`` form that turns bad input into NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# count status -> control label
STATUS_CANCELLED = "ANULADO"
STATUS_CLOSED = "FECHADO"
LABEL_AVOIDED_COST = "Custo Evitado"
LABEL_CONFIRMED_VALUE = "Valor Consultivado"
LABEL_OTHER = "-"
# ABC class -> planning priority (unknown class 0)
CLASS_PRIORITY = {"A": 3, "B": 2, "C": 1, "Unknown": 0}
UNKNOWN_CLASS = "Unknown"
# item category labels
LABEL_COUNTED = "Já Inventariado"
LABEL_NEVER_COUNTED = "Nunca Inventariado"
LABEL_MOVED = "Movimentação Recente"
LABEL_NOT_MOVED = "Sem Movimentação"
# minute timestamp pattern of the count files (day/month/year hour:minute)
MINUTE_TS_PATTERN = "d/M/yyyy H:mm"
# width of the fixed item code
FIXED_CODE_WIDTH = 13
# tax rate on the absolute forecast delta
DEFAULT_TAX_RATE = 0.18
# ---------------------------------------------------------------------------

# Results: money in cents and quantities; totals of them; unit costs as they are given.
MONEY = "decimal(18,2)"
QTY = "decimal(20,6)"
COST = "decimal(20,8)"
MONEY_TOTAL = "decimal(28,2)"
QTY_TOTAL = "decimal(28,6)"
# Parts of keys that are whole numbers of any length.
WHOLE = "decimal(38,0)"


def col(name: str) -> Column:
    """Column by exact name (quoted, so names with ``.`` or spaces work)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(c: Column | str) -> Column:
    return col(c) if isinstance(c, str) else c


WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def strip_ws(col: Column | str) -> Column:
    """Trim leading/trailing whitespace (``str.strip``'s set), not only spaces."""
    return F.btrim(_c(col).cast("string"), F.lit(WHITESPACE))


def standardize_code(col: Column | str) -> Column:
    """Item code as text, trimmed, leading zeros removed, ``''`` -> ``'0'``.

    NULL stays NULL (the reference turns it into the text ``'nan'``; we keep it
    missing so later null filters can drop it).
    """
    stripped = F.ltrim(strip_ws(col), F.lit("0"))
    return F.when(stripped == "", F.lit("0")).otherwise(stripped)


def fixed_code(col: Column | str, width: int = FIXED_CODE_WIDTH) -> Column:
    """Left-pad with zeros and keep the LAST ``width`` characters.

    ``lpad`` would keep the first ``width`` characters of a longer code, so this is
    written as ``right(zeros || code, width)``.
    """
    text = _c(col).cast("string")
    return F.right(F.concat(F.lit("0" * width), text), F.lit(width))


def is_number(df: DataFrame, name: str) -> bool:
    """Whether a column is stored as a number that parses to the same value without its text
    (a float's shortest text isn't its value, so a float isn't one)."""
    types = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.DecimalType)
    return any(f.name == name and isinstance(f.dataType, types) for f in df.schema.fields)


def to_number(col: Column | str, dtype: str = "double", fill: float | None = None, number: bool = False) -> Column:
    """Coercing numeric parse (bad text -> NULL), optional fill value. ``number`` skips the
    way over text for a column that ``is_number``."""
    parsed = (_c(col) if number else strip_ws(col)).try_cast(dtype)
    return parsed if fill is None else F.coalesce(parsed, F.lit(fill).cast(dtype))


def to_quantity(col: Column | str, number: bool = False) -> Column:
    """Quantity as an exact decimal, so sums do not depend on summation order."""
    return to_number(col, QTY, number=number)


def parse_money_ptbr(col: Column | str, dtype: str = COST, locale: str = "pt-BR") -> Column:
    """Pt-BR money text ``1.234,56`` -> 1234.56 (drop ``.``, ``,`` -> ``.``), to all its
    decimals. ``locale="en"`` reads ``1,234.56``."""
    text = F.translate(strip_ws(col), ",.", ".") if locale == "pt-BR" else F.translate(strip_ws(col), ",", "")
    return text.try_cast(dtype)


def parse_minute_ts(col: Column | str, pattern: str = MINUTE_TS_PATTERN) -> Column:
    """P5: ``d/M/yyyy H:mm`` text -> timestamp; unparsable -> NULL.

    Single-letter fields accept both ``1/2/2024 3:05`` and ``31/12/2024 23:59``.
    """
    return F.try_to_timestamp(strip_ws(col), F.lit(pattern))


def date_parts(ts: Column | str) -> dict[str, Column]:
    """Date, year and month of a timestamp."""
    t = _c(ts)
    return {"date": F.to_date(t), "year": F.year(t), "month": F.month(t)}


def month_start(year: Column | str, month: Column | str) -> Column:
    """Year + month -> first day of that month (NULL if either is NULL)."""
    return F.try_make_timestamp_ntz(
        _c(year).cast("int"), _c(month).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def rack(location: Column | str) -> Column:
    """Text before the first ``.`` of a location."""
    return F.substring_index(_c(location).cast("string"), ".", 1)


def count_key(*parts: Column | str) -> Column:
    """``part1_part2_...``; NULL when any part is NULL (``concat``, not ``concat_ws``)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("_"))
        cols.append(_c(p).cast("string"))
    return F.concat(*cols)


def control_label(status: Column | str) -> Column:
    """P10: ANULADO -> avoided cost, FECHADO -> confirmed value, else ``-``."""
    s = _c(status)
    return (
        F.when(s == STATUS_CANCELLED, F.lit(LABEL_AVOIDED_COST))
        .when(s == STATUS_CLOSED, F.lit(LABEL_CONFIRMED_VALUE))
        .otherwise(F.lit(LABEL_OTHER))
    )


def counted_quantity(physical: Column | str, fallback: Column | str) -> Column:
    """Counted quantity = ``Física`` when present, else ``Quantidade Fisica``."""
    return F.coalesce(_c(physical), _c(fallback))


def money(amount: Column) -> Column:
    """Round money to cents, half to even (NumPy's rounding)."""
    return F.bround(amount, 2).cast(MONEY)


def value_of(cost: Column | str, qty: Column | str) -> Column:
    """Cost x quantity in exact decimals, rounded once, half-even, to cents."""
    return money(_c(cost).cast(COST) * _c(qty).cast(QTY))


def to_whole(col: Column | str, dtype: str = "int", fill: int | None = None, number: bool = False) -> Column:
    """Whole number from text or number (``2024.0`` -> 2024); NaN, infinities, what
    doesn't fit and bad text -> NULL (then the optional fill value)."""
    parsed = to_number(col, number=number).try_cast(dtype)
    return parsed if fill is None else F.coalesce(parsed, F.lit(fill).cast(dtype))


def round_half_even_long(col: Column | str) -> Column:
    """Round to an integer, half to even (0.5 -> 0, 1.5 -> 2, 2.5 -> 2)."""
    return F.bround(_c(col), 0).cast("long")


def finite_or_null(col: Column | str) -> Column:
    """NaN and +-Inf -> NULL (so a later fill or average can handle it)."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def class_priority(abc_class: Column | str) -> Column:
    """ABC class -> planning priority 3/2/1, anything else 0."""
    c = _c(abc_class)
    expr = F.lit(0)
    for label, prio in CLASS_PRIORITY.items():
        if prio:
            expr = F.when(c == label, F.lit(prio)).otherwise(expr)
    return expr.cast("int")


def clip_at_zero(col: Column | str) -> Column:
    """``max(0, x)``; NaN is nulled first (``greatest(0, NaN)`` is NaN in Spark)."""
    return F.greatest(F.lit(0.0), finite_or_null(col))


def membership_label(flag: Column | str, yes: str, no: str) -> Column:
    """Boolean membership flag -> one of two labels."""
    return F.when(_c(flag), F.lit(yes)).otherwise(F.lit(no))


def abs_pct_error(actual: Column | str, abs_error: Column | str) -> Column:
    """Absolute percentage error, only where actual > 0 (else NULL)."""
    a = _c(actual)
    return F.when(a > 0, _c(abs_error).cast("double") / a.cast("double") * 100.0)
