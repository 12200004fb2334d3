"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.session import open_folder, scratch_path  # noqa: F401 - the operators take it from here

#: Word pattern of the contracts: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage, fixes partition ids and random row ids, and keeps column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Limit the rows of one Arrow batch: whole texts make 10,000-row batches too large."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def crc_of_id(col: str = "doc_id") -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary"))


def prefix_sums(df: DataFrame, values: dict[str, str], groups: list[str], order: list[Column]) -> DataFrame:
    """For each ``{column: out}`` of ``values`` add ``out``: the column's sum over the rows of
    the same group that come earlier.

    The rows are dealt by ranges of (groups, order), so a group with a third of the rows is
    split. Each range gets a local running sum; what its group holds in earlier ranges comes
    from one total a (group, range).
    """
    keys = [*groups, "_range"]
    dealt = df.repartitionByRange(*[F.col(g).asc_nulls_first() for g in groups], *order)
    dealt = materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy(*keys).agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_off_{v}") for v in values],
    )
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumns({f"_loc_{v}": F.coalesce(F.sum(v).over(local), F.lit(0)) for v in values})
    same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return summed.join(offsets, same).select(
        *df.columns, *[(F.col(f"_loc_{v}") + F.col(f"_off_{v}")).alias(out) for v, out in values.items()]
    )


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Label of each of ``n`` nodes: the smallest node it reaches over edges a-b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        keep = la != lb
        if not keep.any():
            break
        a, b, la, lb = a[keep], b[keep], la[keep], lb[keep]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node reached.

    Alternates the two star steps of the distributed connected-components algorithm: each
    node's larger neighbours, then its smaller ones, are pointed at the smallest node
    nearby. Rounds are written to the shared folder; the number of rounds is logarithmic
    in the diameter.
    """
    e = edges.where(F.col("a") != F.col("b"))
    e = materialize(
        e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    before = None
    while True:
        # Large star: every neighbour above a node goes to the node's smallest.
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        star = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").distinct()
        # Small star: every neighbour below a node, and the node, go to the smallest.
        low = star.groupBy("b").agg(F.min("a").alias("m"))
        back = star.join(low, "b")
        e = back.select(F.col("m").alias("p"), F.col("a").alias("q")).unionByName(
            low.select(F.col("m").alias("p"), F.col("b").alias("q"))
        )
        e = e.where(F.col("p") != F.col("q")).select(F.col("p").alias("a"), F.col("q").alias("b")).distinct()
        e = materialize(e, "edges")
        state = e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
