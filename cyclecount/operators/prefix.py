"""Global running sums without a single-partition window.

``sum(v) over (order by k rows unbounded preceding)`` with no ``partition by`` plans as
``Exchange SinglePartition``: every row goes through one task. This module computes the same
column, at every size, in these steps:

1. Deal the rows by ranges of the *whole* composite order (``repartitionByRange``), so a value
   shared by a third of the rows is still split by the tie-break columns, and write them once
   to the shared checkpoint folder with their range's number as a column. Written, the number
   can't change when a stage runs again.
2. Sum each range (one row a range) and turn the sums into offsets.
3. Add each range's offset to an ordinary window running sum ``partition by range``.

Only the table of ranges, as many rows as shuffle partitions, is ever in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclecount.session import scratch_path

BUCKET = "_pfx_range"


@dataclass(frozen=True)
class SortKey:
    """One sort key of a total order: column name, direction."""

    name: str
    ascending: bool = True


def _keys(order: list[SortKey | tuple[str, bool] | str]) -> list[SortKey]:
    out = []
    for k in order:
        if isinstance(k, SortKey):
            out.append(k)
        elif isinstance(k, str):
            out.append(SortKey(k, True))
        else:
            out.append(SortKey(k[0], bool(k[1])))
    return out


def sort_columns(order: list[SortKey]) -> list[Column]:
    return [F.col(k.name).asc() if k.ascending else F.col(k.name).desc() for k in order]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: its lineage is cut,
    and later reads keep column and file pruning."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_ranges(
    df: DataFrame, order: list[SortKey | tuple[str, bool] | str], n_ranges: int | None = None
) -> DataFrame:
    """Add ``_pfx_range``: the number of the row's range of the total order, ascending, of
    ``n_ranges`` (else as many as shuffle partitions). The result is written once."""
    columns = sort_columns(_keys(order))
    dealt = df.repartitionByRange(n_ranges, *columns) if n_ranges else df.repartitionByRange(*columns)
    return written(dealt.withColumn(BUCKET, F.spark_partition_id()), "ranges")


def running_sum(
    df: DataFrame,
    order: list[SortKey | tuple[str, bool] | str],
    value: str | Column,
    out: str,
    keep_bucket: bool = False,
    total_out: str | None = None,
) -> DataFrame:
    """``out`` = running sum of ``value`` over the total ``order`` (inclusive).

    ``order`` must be a *total* order (end it with a unique key). ``total_out`` adds the grand
    total taken from the ranges' sums (no extra pass, no cross join).
    """
    keys = _keys(order)
    b = df if BUCKET in df.columns else with_ranges(df, keys)
    b = b.withColumn("_pfx_v", F.col(value) if isinstance(value, str) else value)
    w = (
        Window.partitionBy(BUCKET)
        .orderBy(*sort_columns(keys))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = b.groupBy(BUCKET).agg(F.sum("_pfx_v").alias("_pfx_t"))
    # one row a range reaches this window and the broadcast
    offsets = totals.select(
        BUCKET,
        F.coalesce(
            F.sum("_pfx_t").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast(totals.schema["_pfx_t"].dataType),
        ).alias("_pfx_off"),
        F.sum("_pfx_t").over(Window.partitionBy()).alias("_pfx_total"),
    )
    res = (
        b.join(F.broadcast(offsets), BUCKET, "inner")
        .withColumn(out, F.col("_pfx_off") + F.sum("_pfx_v").over(w))
        .drop("_pfx_v", "_pfx_off")
    )
    res = res.withColumnRenamed("_pfx_total", total_out) if total_out else res.drop("_pfx_total")
    return res if keep_bucket else res.drop(BUCKET)
