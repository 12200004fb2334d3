"""Registered queries for sources, sinks, and operators' rarer branches.

Sources and sinks are written from the driver's tables to the shared scratch folder and read
back by the library's own readers; the others feed an operator an input on which a branch
that the main queries seldom reach decides the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.learning import models as learning_models
from cyclecount.learning import gram, train, trees
from cyclecount.operators import abc, categories, counts, features, forecasting, movements, stats, validation
from cyclecount.plans import demo
from cyclecount.plans import queries as Q
from cyclecount.plans.queries import register
from cyclecount.session import scratch_path
from cyclecount.sources import readers, writers


def _csv(df: DataFrame, label: str, options: dict[str, str]) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).csv(path)
    return path


# -------------------------------------------------------------- sources and sinks


@register("abc_from_files")
def q_abc_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + C1 + K1: stock and costs written as files, read, classified, exported, read."""
    stock = readers.read_stock(spark, _csv(demo.stock(spark, sf_dir), "stock", readers.STOCK_FILE_OPTIONS))
    costs = demo.costs(spark, sf_dir).withColumnRenamed("Mes", "Período")
    costs = readers.read_costs(spark, _csv(costs, "costs", readers.STOCK_FILE_OPTIONS))
    path = scratch_path(spark, "abc-export")
    writers.write_abc_curve(abc.abc_curve(stock, costs), path)
    return spark.read.parquet(path)


@register("counts_from_files")
def q_counts_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + C2 + C3 + K2: counts written as two exports with different headers, read, valued,
    summed by day, written by year, read."""
    raw = demo.counts(spark, sf_dir)
    odd = F.col("Compartimento").isin("1", "3", "5", "7")
    first = _csv(raw.where(odd), "counts", readers.COUNT_FILE_OPTIONS)
    other = _csv(raw.where(~odd).select(*reversed(raw.columns)), "counts", readers.COUNT_FILE_OPTIONS)
    daily = counts.daily_counts(counts.clean_counts(readers.read_counts(spark, [first, other])))
    path = scratch_path(spark, "daily-export")
    writers.write_counts_daily(daily, path)
    return spark.read.parquet(path)


@register("newest_count_month")
def q_newest_count_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + G19: year and month of the newest count, from the timestamp column of a file."""
    path = _csv(demo.counts(spark, sf_dir), "counts", readers.COUNT_FILE_OPTIONS)
    year, month = validation.latest_year_month(readers.read_count_timestamps(spark, path))
    return demo.counts(spark, sf_dir).agg(F.lit(year).alias("year"), F.lit(month).alias("month"))


@register("movements_from_files")
def q_movements_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + X2 + G6 + G7: movements written as a folder of files, read, summed."""
    path = _csv(demo.movements(spark, sf_dir), "movements", readers.MOVEMENT_FILE_OPTIONS)
    # a folder name with the suffix the reader looks for is not needed: Spark's files have it
    return movements.totals(movements.movement_rows(readers.read_movements(spark, path)))


@register("ytd_from_files")
def q_ytd_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + C9 + K6: forecasts written by model, read, compared with the counts, written, read."""
    path = scratch_path(spark, "forecasts")
    demo.forecasts(spark, sf_dir).write.partitionBy("Model_Name").parquet(path)
    raw = demo.counts(spark, sf_dir)
    year, month = validation.latest_year_month(raw)
    detail, metrics, _ = validation.ytd_validation(raw, readers.read_forecasts(spark, path), year, month)
    out = scratch_path(spark, "ytd-export")
    writers.write_ytd(detail, metrics, out)
    return spark.read.parquet(f"{out}/detail")


@register("category_written")
def q_category_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 + K5: item categories written and read back."""
    path = scratch_path(spark, "category-export")
    writers.write_item_category(Q.q_item_category(spark, sf_dir), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- rarer branches


@register("counts_without_cancelled")
def q_counts_without_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """valued last counts without cancelled ones."""
    return counts.clean_counts(demo.counts(spark, sf_dir), drop_cancelled=True)


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "lineitem")


@register("class_stats_single")
def q_class_stats_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class statistics where one class has a single row and takes the global deviation."""
    li = _line_rows(spark, sf_dir)
    single = (F.col("l_orderkey") == 1) & (F.col("l_linenumber") == 3)
    rows = li.select(
        F.when(single, F.lit("Z")).otherwise(F.col("l_returnflag")).alias("Curva_ABC"),
        F.col("l_quantity").cast(C.QTY).alias("Quantidade Fisica"),
    )
    return features.class_stats(rows)


@register("constant_columns")
def q_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a constant, an almost constant, a null and an ordinary column, the constant."""
    rows = _line_rows(spark, sf_dir).select(
        F.lit(7.0).alias("same"),
        F.when(F.col("l_orderkey") == 1, F.lit(7.000001)).otherwise(F.lit(7.0)).alias("almost"),
        F.lit(None).cast("double").alias("none"),
        F.col("l_quantity").alias("ordinary"),
    )
    return stats.constant_features(rows, rows.columns)


@register("top_features")
def q_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G18 + O5: the two features most and least correlated with the line price."""
    cols = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]
    out = stats.feature_correlation(_line_rows(spark, sf_dir), cols, "l_extendedprice", k=2)
    return out.withColumn("corr", F.round("corr", 6))


@register("valuation_edges")
def q_valuation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P24 + P25: forecasts below zero, NaN and missing ones, valued at four-decimal costs."""
    q = F.col("l_quantity") - F.lit(25.0)
    rows = _line_rows(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 6, F.lit(None).cast("double"))
        .when(F.col("l_linenumber") == 7, F.lit(float("nan")))
        .otherwise(q)
        .alias("Previsao_Quantidade"),
        (F.col("l_suppkey").cast(C.COST) * F.lit("0.0349").cast("decimal(6,4)")).cast(C.COST).alias("Custo_Unitário"),
        F.col("l_linenumber").cast(C.MONEY).alias("Valor_Estoque"),
    )
    return forecasting.valuation(rows)


@register("forecast_plan_fallback")
def q_forecast_plan_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 + P25 + C8: the plan of the items without recent history at their book quantity."""
    curve, items, daily, counted, moved, _ = Q._history_inputs(spark, sf_dir, demo.SINCE, measures=["Lógica"])
    without = categories.items_without_history(items, counted, moved)
    eligible = items.where(F.col("Lógica_ABC") > 0).join(without, "Código", "left_semi")
    fc = forecasting.fallback_forecast(eligible, list(learning_models.MODEL_NAMES))
    alloc = Q._allocate(spark, items, features.standardized_daily(daily)).allocation
    return forecasting.forecast_plan(fc, items, alloc)


# ------------------------------------------------------------------- learning steps


@register("naive_metrics")
def q_naive_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE, RMSE and R2 (rounded to 1e-6) of the book quantity as a forecast of the count."""
    rows = counts.clean_counts(demo.counts(spark, sf_dir)).select(
        F.col("Lógica").cast("double").alias("prediction"), F.col("Quantidade Fisica").cast("double").alias("label")
    )
    got = train.regression_metrics(rows.where(F.col("label").isNotNull() & F.col("prediction").isNotNull()))
    return got.select("n", *[F.round(c, 6).alias(c) for c in ("MAE", "RMSE", "R2")])


@register("month_folds")
def q_month_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: five expanding folds cut at month boundaries, with the rows that each trains on."""
    li = _line_rows(spark, sf_dir)
    rows = li.select(F.year("l_shipdate").alias("Ano"), F.month("l_shipdate").alias("Mês"))
    folds = train.month_folds(rows, 5)
    cuts = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(folds)], "fold int, train_end int, valid_end int")
    months = rows.groupBy((F.col("Ano") * 12 + F.col("Mês")).alias("k")).count()
    return months.join(F.broadcast(cuts), F.col("k") <= F.col("valid_end")).groupBy("fold", "train_end", "valid_end").agg(
        F.sum(F.when(F.col("k") <= F.col("train_end"), F.col("count")).otherwise(0)).alias("n_train"),
        F.sum(F.when(F.col("k") > F.col("train_end"), F.col("count")).otherwise(0)).alias("n_valid"),
    )


@register("temporal_split")
def q_temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + G20: rows and quantity of the training years and of the last year."""
    rows = _line_rows(spark, sf_dir).select(F.year("l_shipdate").alias("Ano"), F.col("l_quantity").cast("long").alias("q"))
    before, last, year = train.temporal_split(rows)
    parts = before.withColumn("part", F.lit("train")).unionByName(last.withColumn("part", F.lit("test")))
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.sum("q").alias("q"), F.lit(year).alias("test_year"))


@register("scaled_features")
def q_scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M4 + P19: a column scaled by median and quartiles, and one-hot columns, from the
    preprocessor fitted on the same rows; infinities and NaN become 0 first."""
    li = _line_rows(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit(float("inf")))
        .when(F.col("l_linenumber") == 6, F.lit(float("nan")))
        .otherwise(F.col("l_quantity"))
        .alias("x"),
        "l_returnflag",
    )
    clean = train.clean_features(li, ["x"], ["l_returnflag"])
    pre = train.Preprocessor(["x"], ["l_returnflag"]).fit(clean)
    v = vector_to_array("features")
    names = [s.replace("num__", "").replace("cat__", "") for s in pre.slots]
    out = pre.transform(clean).select("l_orderkey", "l_linenumber", v.alias("v"))
    return out.select("l_orderkey", "l_linenumber", *[F.get("v", F.lit(i)).alias(f"f{i}") for i in range(len(names))])


@register("linear_closed_form")
def q_linear_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the linear model's slope and intercept of line price on quantity (rounded to 1e-4)."""
    rows = _line_rows(spark, sf_dir).select("l_quantity", F.col("l_extendedprice").alias("label"))
    design = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)
    model = train._linear({}).fit(design)
    return rows.agg(
        F.count("*").alias("n"),
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 4).alias("intercept"),
    )


#: Fixed penalties of the two queries below; their SQL twins repeat them.
SEARCH_CANDIDATES = {
    "Linear Regression": [{"fitIntercept": True}, {"fitIntercept": False}],
    "Ridge": [{"alpha": a} for a in (1.0, 1000.0, 100000.0)],
    "Lasso": [{"alpha": a} for a in (0.01, 0.5, 5.0)],
}
PATH_ALPHAS = (20.0, 5.0, 0.1, 0.02, 0.001)


def _price_design(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line price (thousands) by quantity and discount (percent), with the month shipped."""
    rows = _line_rows(spark, sf_dir).select(
        F.year("l_shipdate").alias("Ano"),
        F.month("l_shipdate").alias("Mês"),
        "l_quantity",
        F.round(F.col("l_discount") * 100).alias("pct"),
        (F.col("l_extendedprice") / 1000.0).alias("label"),
    )
    return VectorAssembler(inputCols=["l_quantity", "pct"], outputCol="features").transform(rows)


@register("linear_search")
def q_linear_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M8 + M9: every linear, ridge and lasso candidate on every time fold, fitted from sums
    by month, with its coefficients, its error on the fold (rounded to 1e-6) and the choice."""
    design = _price_design(spark, sf_dir)
    folds = train.month_folds(design, 5)
    found = gram.search(design, SEARCH_CANDIDATES, folds)
    rows = []
    for kind, candidates in SEARCH_CANDIDATES.items():
        best = found.best(kind)[0]
        for i, c in enumerate(candidates):
            for j, fold in enumerate(found.fits[kind]):
                w = fold[i].coefficients
                mae = float(found.maes[kind][j][i])
                rows.append((kind, i, j, float(w[0]), float(w[1]), fold[i].intercept, mae, i == best))
    schema = "model string, candidate int, fold int, w_quantity double, w_discount double, intercept double, mae double, chosen boolean"
    out = spark.createDataFrame(rows, schema)
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("w_quantity", "w_discount", "intercept", "mae")})


@register("lasso_path")
def q_lasso_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the lasso's path over all months, with each feature's covariance with what the fit
    leaves, which the optimum keeps within the penalty and at it for features in use."""
    _, sums = gram.month_sums(_price_design(spark, sf_dir))
    whole = sums.sum(0)
    n, _, _, xx, xy, _ = gram._centred(whole)
    rows = []
    for alpha, fit in zip(PATH_ALPHAS, gram.solve(whole, "Lasso", [{"alpha": a} for a in PATH_ALPHAS]), strict=True):
        w = fit.coefficients.toArray()
        left = (xy - xx @ w) / n
        for name, value, cov in zip(("l_quantity", "pct"), w.tolist(), left.tolist(), strict=True):
            optimal = abs(cov) <= alpha * (1 + 1e-9) if value == 0 else abs(cov - alpha * (1 if value > 0 else -1)) <= 1e-9 * max(1, alpha)
            rows.append((alpha, name, value, cov, optimal))
    out = spark.createDataFrame(rows, "alpha double, feature string, weight double, covariance double, optimal boolean")
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("weight", "covariance")})


@register("tree_columns")
def q_tree_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: a tree of two levels on line price, compiled to nodes; the rows of each leaf by the
    column expression over plain columns, with the root's split."""
    names = ["l_quantity", "discount", "tax"]
    rows = _line_rows(spark, sf_dir).select(
        "l_quantity",
        F.round(F.col("l_discount") * 100).alias("discount"),
        F.round(F.col("l_tax") * 100).alias("tax"),
        (F.col("l_extendedprice") / 1000.0).alias("label"),
    )
    design = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = trees.TreeFit({"maxDepth": 2, "maxBins": 64}, 42).fit(design)
    paths, stack = [], [(int(forest.roots[0]), "")]
    while stack:
        node, path = stack.pop()
        if forest.feature[node] < 0:
            paths.append((node, path))
        else:
            stack += [(int(forest.left[node]), path + "L"), (int(forest.right[node]), path + "R")]
    root = int(forest.roots[0])
    leaf = F.get(forest.leaves(F.array(*names)), F.lit(0))
    per = rows.groupBy(leaf.alias("node")).agg(F.count("*").alias("n"), F.round(F.avg("label"), 6).alias("mean"))
    found = per.join(F.broadcast(spark.createDataFrame(paths, "node int, path string")), "node")
    return found.select(
        "path", "n", "mean",
        F.lit(names[forest.feature[root]]).alias("root_feature"),
        F.round(F.lit(float(forest.threshold[root])), 6).alias("root_threshold"),
    )


@register("exact_quantiles")
def q_exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20 + G21 + M3: exact quantiles of several columns side by side, one with gaps and
    infinities, one constant, one all null."""
    li = _line_rows(spark, sf_dir)
    gaps = F.when(F.col("l_linenumber") == 2, None).when(F.col("l_linenumber") == 3, F.lit(float("inf")))
    rows = li.select(
        "l_quantity", "l_extendedprice", gaps.otherwise(F.col("l_discount")).alias("gaps"),
        F.lit(3.0).alias("same"), F.lit(None).cast("double").alias("none"),
    )
    got = stats.exact_quantiles(rows, rows.columns, [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0])
    return got.withColumn("value", F.round("value", 6))


@register("processed_feature_correlation")
def q_processed_feature_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G18 + O5 on processed columns: scaled numbers and one-hot slots, on the training years."""
    feats = Q.prefix.written(Q.q_features(spark, sf_dir), "features")
    train_rows, _, _ = train.temporal_split(feats)
    return train.processed_correlation(train_rows, k=30).withColumn("corr", F.round("corr", 6))


@register("parsed_counts")
def q_parsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: rows and parsed values of the closed counts, observed by the write of the daily counts."""
    observed = Observation("parsed")
    daily = counts.daily_counts(counts.clean_counts(demo.counts(spark, sf_dir), observed=observed))
    writers.write_counts_daily(daily, scratch_path(spark, "daily-export"))
    counts.raise_if_unparsed(observed)
    got = observed.get
    return spark.createDataFrame(
        [(got["rows"], got["Atualização"], got["Custo"])], "rows long, timestamps long, costs long"
    )


@register("plan_written")
def q_plan_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the plan written by model and read back with each row's place in its file: rows and
    rows out of order (year, month, item) by model."""
    path = scratch_path(spark, "plan-export")
    writers.write_forecast_plan(q_forecast_plan_fallback(spark, sf_dir), path)
    rows = readers.read_forecasts(spark, path)
    rows = rows.withColumns({"_file": F.col("_metadata.file_path"), "_place": F.col("_metadata.row_index")})
    keys = F.struct("Ano_Previsto", "Mês_Previsto", "Código")
    before = F.lag(keys).over(Window.partitionBy("Model_Name", "_file").orderBy("_place"))
    rows = rows.withColumn("_bad", F.coalesce((before > keys).cast("long"), F.lit(0)))
    return rows.groupBy("Model_Name").agg(
        F.count("*").alias("n"), F.sum("_bad").alias("out_of_order"), F.min(keys)["Código"].alias("first_item"),
        F.max(keys)["Código"].alias("last_item"),
    )


@register("metrics_written")
def q_metrics_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: metrics of two naive forecasts written with their header and read back, with the place
    of each row in the file."""
    rows = counts.clean_counts(demo.counts(spark, sf_dir)).select(
        F.col("Lógica").cast("double").alias("book"), F.col("Quantidade Fisica").cast("double").alias("label")
    )
    rows = rows.where(F.col("label").isNotNull() & F.col("book").isNotNull())
    forecasts = {"Logica": F.col("book"), "Dobro": F.col("book") * 2}
    parts = [
        train.regression_metrics(rows.withColumn("prediction", p)).withColumn("Modelo", F.lit(name))
        for name, p in forecasts.items()
    ]
    path = scratch_path(spark, "metrics-export")
    writers.write_model_metrics(parts[0].unionByName(parts[1]), path)
    back = spark.read.options(header="true", sep=";").csv(path)
    place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))  # one row a model
    return back.select("Modelo", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("MAE", "RMSE", "R2")], place.alias("place"))


@register("ytd_metrics_written")
def q_ytd_metrics_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the summary half of the year-to-date comparison, written and read back."""
    raw = demo.counts(spark, sf_dir)
    year, month = validation.latest_year_month(raw)
    detail, metrics, _ = validation.ytd_validation(raw, demo.forecasts(spark, sf_dir), year, month)
    out = scratch_path(spark, "ytd-export")
    writers.write_ytd(detail, metrics, out)
    return spark.read.parquet(f"{out}/metrics").withColumn("MAPE", F.round("MAPE", 6))


#: Bytes that a task holds of a file it copies.
COPY_BYTES = 1 << 20


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a file or folder named as Hadoop does."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (pafs.LocalFileSystem(), path) if "://" not in path else pafs.FileSystem.from_uri(path)


def _truncated(spark: SparkSession, folder: str) -> str:
    """A copy of the folder in which each file ends halfway. The files are copied in tasks, a
    buffer at a time."""
    target = scratch_path(spark, "truncated")
    files = spark.read.format("binaryFile").load(folder).select("path", "length")

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, out = _opened(target)
        fs.create_dir(out, recursive=True)
        for pdf in batches:
            for path, length in zip(pdf["path"], pdf["length"], strict=True):
                source_fs, source = _opened(path)
                left = int(length) // 2
                with source_fs.open_input_stream(source, compression=None) as file, fs.open_output_stream(
                    f"{out}/{source.rpartition('/')[2]}", compression=None
                ) as sink:
                    while left and (part := file.read(min(left, COPY_BYTES))):
                        sink.write(part)
                        left -= len(part)
            yield pdf[["length"]]

    files.mapInPandas(copy, "length long").agg(F.sum("length")).collect()
    return target


@register("counts_report")
def q_counts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: two whole exports, one with short rows, one whose files end in the middle, and a missing
    one: what was read of each, and the rows of the whole ones together."""
    raw = demo.counts(spark, sf_dir)
    odd = F.col("Compartimento").isin("1", "3", "5", "7")
    first = _csv(raw.where(odd), "counts", readers.COUNT_FILE_OPTIONS)
    other = _csv(raw.where(~odd).select(*reversed(raw.columns)), "counts", readers.COUNT_FILE_OPTIONS)
    zipped = _csv(raw, "counts", readers.COUNT_FILE_OPTIONS | {"compression": "gzip"})
    lines = raw.select(F.concat_ws(";", F.coalesce("NOK", F.lit("")), "Status", "Código").alias("value")).where(F.col("Código") == "7")
    lines = Q.prefix.written(lines, "short")  # found side by side: only these rows go to one task
    header = spark.createDataFrame([(";".join(raw.columns),)], "value string")
    short = scratch_path(spark, "counts")
    header.unionAll(lines).coalesce(1).write.options(encoding="ISO-8859-1").csv(short, quote="", sep="\u0001")
    paths = [first, _truncated(spark, zipped), other, f"{short}-none", short]
    df, report = readers.read_counts_reported(spark, paths)
    names = spark.createDataFrame(list(zip(paths, ["first", "broken", "other", "none", "short"])), "path string, name string")
    total = df.agg(F.count("*").alias("all_rows"), F.count("Código").alias("all_codes")).withColumn("_one", F.lit(1))
    out = report.join(names, "path").withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return out.select("name", "status", "rows", "bad_rows", "all_rows", "all_codes")
