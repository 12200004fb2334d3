"""Exact moments and data profiles.

Means and sample standard deviations are built from exact decimal sums
(count, sum x, sum x^2), converted to double once at the end. The result then
does not depend on how rows were split across partitions or merged, which a
streaming variance update does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import prefix

SCALE = 3  # decimals of the quantities these moments are taken on
MOMENT = "decimal(18,3)"


def moment_aggs(x: Column, prefix: str) -> list[Column]:
    """Aggregates ``{prefix}_n``, ``{prefix}_s``, ``{prefix}_s2`` of a decimal column."""
    d = x.cast(MOMENT)
    return [
        F.count(d).alias(f"{prefix}_n"),
        F.sum(d).alias(f"{prefix}_s"),
        F.sum(d * d).alias(f"{prefix}_s2"),
    ]


def mean_of(n: Column, s: Column) -> Column:
    return F.when(n > 0, s.cast("double") / n.cast("double"))


def std_of(n: Column, s: Column, s2: Column) -> Column:
    """Sample std (n - 1) from exact sums; NULL for fewer than two values. Sums too large for
    an exact difference of products (n * s2 from about 1e32) give it in doubles."""
    unit = F.lit(10 ** (2 * SCALE)).cast("decimal(20,0)")
    exact = F.try_subtract(F.try_multiply(n.cast("decimal(20,0)"), s2), F.try_multiply(s, s))
    exact = F.try_multiply(exact, unit).try_cast("decimal(38,0)").cast("double")
    wide = [c.cast("double") for c in (n, s, s2)]
    rough = F.greatest((wide[0] * wide[2] - wide[1] * wide[1]) * F.lit(float(10 ** (2 * SCALE))), F.lit(0.0))
    den = wide[0] * (wide[0] - F.lit(1.0))
    return F.when(n > 1, F.sqrt(F.coalesce(exact, rough) / den / F.lit(float(10 ** (2 * SCALE)))))


def target_profile(df: DataFrame, target: str = "Quantidade Fisica") -> DataFrame:
    """One row: rows, distinct values, zeros, mean, std, min, quartiles, max.

    Everything comes from the table of distinct values and their counts, written once; a
    quartile (linear, position p * (n - 1)) needs the values whose ranks enclose it, found by
    running counts over that table, without a buffer or a window in one task.
    """
    values = df.groupBy(C.col(target).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    known = values.where(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))
    ranked = prefix.running_sum(known, [prefix.SortKey("v")], "n", "upto", total_out="total").select(
        F.col("v"), "n", "upto", "total"
    )
    ranked = prefix.written(ranked, "profile")

    def at(p: float) -> Column:
        place = F.lit(p) * (F.col("total") - 1)
        low, high = F.floor(place), F.ceil(place)
        first = F.col("upto") - F.col("n")  # ranks first .. upto - 1 hold this value
        v = F.col("v").cast("double")
        return F.struct(
            F.max(F.when((first <= low) & (low < F.col("upto")), v)).alias("a"),
            F.max(F.when((first <= high) & (high < F.col("upto")), v)).alias("b"),
            F.max(place - low).alias("part"),
        )

    def between(q: str) -> Column:
        a, b, part = (F.col(q).getField(f) for f in ("a", "b", "part"))
        return F.when(part == 0, a).otherwise(a + (b - a) * part)

    d = F.col("v").cast(MOMENT)
    n = F.col("n")
    got = ranked.agg(
        F.sum(n).alias("_n"),
        F.sum(d * n).alias("_s"),
        F.sum(d * d * n).alias("_s2"),
        F.count(n).alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("v") == 0, n)), F.lit(0)).alias("n_zeros"),
        F.min("v").cast(C.QTY_TOTAL).alias("min"),
        F.max("v").cast(C.QTY_TOTAL).alias("max"),
        *[at(p).alias(q) for q, p in (("_q1", 0.25), ("_q2", 0.5), ("_q3", 0.75))],
    )
    rows = values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.lit(1).alias("_one"))
    return got.withColumn("_one", F.lit(1)).join(rows, "_one").select(
        "n_rows",
        "n_distinct",
        "n_zeros",
        mean_of(F.col("_n"), F.col("_s")).alias("mean"),
        std_of(F.col("_n"), F.col("_s"), F.col("_s2")).alias("std"),
        "min",
        between("_q1").alias("p25"),
        between("_q2").alias("p50"),
        between("_q3").alias("p75"),
        "max",
    )


def exact_quantiles(df: DataFrame, cols: list[str], probabilities: list[float]) -> DataFrame:
    """feature, p, value: exact quantiles (linear between ranks, position p * (n - 1)) of the
    finite values of every column, in a fixed number of passes whatever the columns.

    All columns become one table of (column, value, count), combined before the shuffle and
    written by ranges, with running counts over it; a quantile is read from the values whose
    ranks enclose it. A column without values has no rows."""
    long = F.array(*[F.struct(F.lit(i).alias("c"), C.finite_or_null(C.col(c).cast("double")).alias("v")) for i, c in enumerate(cols)])
    values = df.select(F.explode(long).alias("x")).select("x.*").where(F.col("v").isNotNull())
    values = values.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    order = [prefix.SortKey("c"), prefix.SortKey("v")]
    ranked = prefix.written(prefix.running_sum(values, order, "n", "upto"), "quantiles")
    # one row a column
    size = ranked.groupBy("c").agg(F.sum("n").alias("total"), F.min(F.col("upto") - F.col("n")).alias("start"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "c int, feature string")
    place = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p")
    wanted = F.broadcast(size.join(F.broadcast(names), "c").select("c", "feature", "total", "start", place))
    at = F.col("p") * (F.col("total") - 1)
    first, upto = F.col("upto") - F.col("n") - F.col("start"), F.col("upto") - F.col("start")
    holds = lambda rank: (first <= rank) & (rank < upto)
    met = ranked.join(wanted, "c").where(holds(F.floor(at)) | holds(F.ceil(at)))
    ends = met.groupBy("feature", "p").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.max(at - F.floor(at)).alias("part"))
    # a quantile's two ranks are the same or next to each other
    value = F.when(F.col("part") == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("part"))
    return ends.select("feature", "p", value.alias("value"))


def constant_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric columns whose sample std is 0, i.e. at least two values, all equal.

    Tested as ``min == max`` over the non-null values: exact for every numeric
    type, one aggregate pass for all columns. Output: feature, n, value.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = C.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    row_df = df.agg(*aggs)
    stacked = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"_n{i}").alias("n"),
            F.col(f"_lo{i}").alias("lo"),
            F.col(f"_hi{i}").alias("hi"),
        )
        for i, c in enumerate(cols)
    ]
    long = row_df.select(F.explode(F.array(*stacked)).alias("r")).select("r.*")
    return long.where((F.col("n") >= 2) & (F.col("lo") == F.col("hi"))).select(
        "feature", "n", F.col("lo").alias("value")
    )


def feature_correlation(df: DataFrame, cols: list[str], target: str, k: int = 30) -> DataFrame:
    """G18 + O5: Pearson correlation of each feature with the target; top and bottom ``k``.

    One aggregate pass computes every correlation (``F.corr`` per column); the
    result has one row per feature, so ranking it is bounded work.
    """
    y = C.col(target).cast("double")
    row_df = df.agg(*[F.corr(C.col(c).cast("double"), y).alias(f"_r{i}") for i, c in enumerate(cols)])
    stacked = [F.struct(F.lit(c).alias("feature"), F.col(f"_r{i}").alias("corr")) for i, c in enumerate(cols)]
    long = row_df.select(F.explode(F.array(*stacked)).alias("r")).select("r.feature", "r.corr")
    return strongest(long.where(F.col("feature") != target), k)


def category_correlation(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """feature, value, corr: Pearson correlation of each category's 0/1 column with the target,
    from the count and the sum of each category; no 0/1 column is made."""
    y = C.col(target).cast("double")
    long = F.array(*[F.struct(F.lit(c).alias("feature"), C.col(c).cast("string").alias("value")) for c in cols])
    rows = df.where(y.isNotNull()).select(F.explode(long).alias("x"), y.alias("y"))
    per = rows.groupBy("x.feature", "x.value").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    whole = df.where(y.isNotNull()).agg(F.count(F.lit(1)).alias("rows"), F.avg(y).alias("mean"), F.var_pop(y).alias("var"))
    share = F.col("n") / F.col("rows")
    spread = F.sqrt(share * (1 - share) * F.col("var"))
    met = per.withColumn("_one", F.lit(1)).join(F.broadcast(whole.withColumn("_one", F.lit(1))), "_one")  # one row
    return met.select(
        "feature", "value", F.when(spread > 0, (F.col("s") - F.col("n") * F.col("mean")) / F.col("rows") / spread).alias("corr")
    )


def strongest(correlations: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest (side top) and lowest (bottom) of feature, corr."""
    known = correlations.where(F.col("corr").isNotNull() & ~F.isnan("corr"))
    # one row per feature reaches these windows: a bounded single partition
    ranked = known.select(        "feature",
        "corr",
        F.row_number().over(Window.orderBy(F.desc("corr"), "feature")).alias("_top"),
        F.row_number().over(Window.orderBy(F.asc("corr"), "feature")).alias("_bottom"),
    )
    sides = F.filter(
        F.array(
            F.when(F.col("_top") <= k, F.lit("top")),
            F.when(F.col("_bottom") <= k, F.lit("bottom")),
        ),
        lambda x: x.isNotNull(),
    )
    return ranked.select("feature", "corr", F.explode(sides).alias("side"))
