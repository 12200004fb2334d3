"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator family.

Each query builds its stand-in inputs from the driver's tables (``demo``) and runs
the library operator on them. Column names and types are final here and equal
those of the DuckDB oracle in ``cyclecount.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import abc, categories, counts, features, forecasting, movements, planning, prefix, stats, validation
from cyclecount.plans import demo, pipeline
from cyclecount.session import ensure_checkpoint_dir, ensure_partitions, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


def _prep(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ensure_partitions(spark)


# --------------------------------------------------------------------------- ABC


@register("abc_curve")
def q_abc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ABC curve of the stock snapshot valued at each item's latest cost."""
    _prep(spark)
    return abc.abc_curve(demo.stock(spark, sf_dir), demo.costs(spark, sf_dir))


@register("abc_class_summary")
def q_abc_class_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items, quantity, value and value share per ABC class."""
    _prep(spark)
    return abc.class_summary(abc.abc_curve(demo.stock(spark, sf_dir), demo.costs(spark, sf_dir)))


@register("latest_cost")
def q_latest_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest cost per item by (year, month) descending."""
    return abc.latest_cost(demo.costs(spark, sf_dir))


@register("stock_valued")
def q_stock_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + J1 + P12: per-item stock totals valued at the latest cost."""
    return abc.stock_valued(demo.stock(spark, sf_dir), demo.costs(spark, sf_dir))


# ------------------------------------------------------------------------ counts


@register("counts_last")
def q_counts_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + F2 + P2-P9 + W2: last count per six-part key of the closed count rows."""
    last = counts.last_counts(demo.counts(spark, sf_dir))
    return last.withColumns(
        {
            "Atualização": F.date_format("Atualização", "yyyy-MM-dd HH:mm"),
            "UdE": F.col("UdE").cast("string"),
            "Compartimento": F.col("Compartimento").cast("string"),
        }
    )


@register("counts_valued")
def q_counts_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valued last counts (control label, counted quantity, values, deltas)."""
    return counts.clean_counts(demo.counts(spark, sf_dir))


@register("counts_daily")
def q_counts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item and count date sums of quantities and values."""
    return counts.daily_counts(counts.clean_counts(demo.counts(spark, sf_dir)))


@register("delta_summary")
def q_delta_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive / negative / net / absolute deltas and tax per month and control label."""
    return counts.delta_summary(counts.clean_counts(demo.counts(spark, sf_dir)))


# --------------------------------------------------------------------- movements


@register("movement_by_type")
def q_movement_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 + G4: de-duplicated movements summed per item, month and type."""
    return movements.by_type(movements.movement_rows(demo.movements(spark, sf_dir)))


@register("movement_totals")
def q_movement_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6 + G7: total quantity, total count and distinct types per item and month."""
    return movements.totals(movements.movement_rows(demo.movements(spark, sf_dir)))


@register("movement_pivot")
def q_movement_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movement feature table (types pivoted to columns, 0 filled, totals)."""
    return movements.movement_features(demo.movements(spark, sf_dir))


# -------------------------------------------------------------------- categories


def _stock_and_counts(spark: SparkSession, sf_dir: str, measures: list[str] | None = None):
    """(curve, ABC items, daily counts); items and daily are read more than once
    downstream, so each is written once per call. With ``measures`` only these of the daily
    sums are read downstream, so the others aren't written."""
    curve = abc.abc_curve(demo.stock(spark, sf_dir), demo.costs(spark, sf_dir))
    items = prefix.written(features.abc_items(curve), "items")
    daily = counts.daily_counts(counts.clean_counts(demo.counts(spark, sf_dir)))
    if measures is not None:
        daily = daily.select("Código", "Data INV", "Ano", "Mês", *measures)
    daily = prefix.written(daily, "daily")
    return curve, items, daily


def _history_inputs(spark: SparkSession, sf_dir: str, since: str | None = None, feature_table: bool = False, measures: list[str] | None = None):
    """(curve, ABC items, daily counts, counted codes, moved codes, sums of the movement features);
    each stage is computed once per call. With ``since`` only items whose latest count or
    movement, over all rows, isn't older stand as counted or moved.

    With ``feature_table`` the sums of the movement feature table are built (and written
    once), and the moved codes are taken from them; otherwise they come from the
    de-duplicated movement rows and no feature table is built.
    ``measures``: see ``_stock_and_counts``."""
    curve, items, daily = _stock_and_counts(spark, sf_dir, measures)
    counted = features.standardized_daily(daily)
    mov = demo.movements(spark, sf_dir)
    if feature_table:
        # the feature table's codes are exactly the moved items
        mov_feat = _written_movements(mov)
        rows = mov_feat.rows if isinstance(mov_feat, movements.Sums) else mov_feat
        return curve, items, daily, counted, rows.select("Código"), mov_feat
    moved = movements.movement_rows(mov)
    if since:
        counted = categories.active_since(counted, since, F.col("Data INV"))
        moved = categories.active_since(moved, since, C.month_start("Ano", "Mês"))
    return curve, items, daily, counted, moved, None


def _written_movements(mov: DataFrame) -> movements.Sums | DataFrame:
    """The sums of the movement features, written once (without movements: the empty table)."""
    types = movements.movement_types(mov)
    if not types:
        return prefix.written(movements.movement_features(mov, types), "movements")
    sums = movements.movement_sums(mov, types)
    return movements.Sums(prefix.written(sums.rows, "movements"), types)


@register("items_with_history")
def q_items_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock items whose latest count or movement isn't before a date."""
    _prep(spark)
    _, items, _, counted, moved, _ = _history_inputs(spark, sf_dir, demo.SINCE, measures=[])
    return categories.items_with_history(items, counted, moved)


@register("items_without_history")
def q_items_without_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock items neither counted nor moved since a date."""
    _prep(spark)
    _, items, _, counted, moved, _ = _history_inputs(spark, sf_dir, demo.SINCE, measures=[])
    return categories.items_without_history(items, counted, moved)


@register("item_category")
def q_item_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible items labelled by whether they were counted and moved since a date."""
    _prep(spark)
    _, items, _, counted, moved, _ = _history_inputs(spark, sf_dir, demo.SINCE, measures=[])
    return categories.item_category(items, counted, moved)


# ---------------------------------------------------------------------- features


def _feature_inputs(spark: SparkSession, sf_dir: str):
    curve, items, daily, counted, moved, mov_feat = _history_inputs(
        spark, sf_dir, feature_table=True
    )
    # read by the rows, the class statistics and the movements
    with_hist = prefix.written(categories.items_with_history(items, counted, moved), "history")
    return curve, items, daily, with_hist, mov_feat


def _base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of items with history, with their ABC info (no movement features)."""
    _, items, daily, counted, moved, _ = _history_inputs(spark, sf_dir, measures=["Quantidade Fisica", "Lógica"])
    with_hist = categories.items_with_history(items, counted, moved)
    return features.with_abc(counted, items).join(with_hist, "Código", "left_semi")


@register("trend_12")
def q_trend_12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item, percent change of the counted quantity against 12 rows back."""
    _prep(spark)
    tf = features.time_features(_base_rows(spark, sf_dir))
    return tf.select("Código", "Data INV", "Quantidade Fisica", "Tendencia_Anual")


@register("moving_averages")
def q_moving_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item, mean of the 3 and 6 previous rows (current row excluded)."""
    _prep(spark)
    tf = features.time_features(_base_rows(spark, sf_dir))
    return tf.select("Código", "Data INV", "Quantidade Fisica", "Media_Movel_3M", "Media_Movel_6M")


@register("class_stats")
def q_class_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 + G9: mean and sample std of the counted quantity per ABC class (global fallback)."""
    _prep(spark)
    return features.class_stats(_base_rows(spark, sf_dir))


@register("features")
def q_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full feature table of items with history."""
    _prep(spark)
    curve, items, daily, with_hist, mov_feat = _feature_inputs(spark, sf_dir)
    return features.build_features(daily, curve, mov_feat, with_hist, items=items)


# ---------------------------------------------------------------------- planning


def _planning_inputs(spark: SparkSession, sf_dir: str):
    """(ABC items, standardized daily counts) of the full history."""
    _, items, daily = _stock_and_counts(spark, sf_dir, ["Lógica"])
    return items, features.standardized_daily(daily)


@register("capacity_by_month")
def q_capacity_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly counting capacity = int(0.9 x mean monthly book quantity)."""
    _prep(spark)
    daily = counts.daily_counts(counts.clean_counts(demo.counts(spark, sf_dir)))
    return planning.capacity_by_month(features.standardized_daily(daily))


@register("items_to_count")
def q_items_to_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + J11: eligible items not yet counted in the as-of year, with priority."""
    _prep(spark)
    items, daily_std = _planning_inputs(spark, sf_dir)
    return planning.items_to_count(items, daily_std, demo.AS_OF_YEAR)


def _allocate(spark: SparkSession, items: DataFrame, daily_std: DataFrame) -> planning.Allocation:
    todo = planning.items_to_count(items, daily_std, demo.AS_OF_YEAR)
    cap = planning.capacity_map(planning.capacity_by_month(daily_std))
    return planning.allocate(spark, todo, cap, demo.AS_OF_YEAR, demo.AS_OF_MONTH)


@register("allocation")
def q_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: items placed into planning months under the monthly capacity (greedy with skips)."""
    _prep(spark)
    return _allocate(spark, *_planning_inputs(spark, sf_dir)).allocation


@register("plan_summary")
def q_plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: per planning month: items placed, pieces placed, capacity."""
    _prep(spark)
    return _allocate(spark, *_planning_inputs(spark, sf_dir)).summary


# ------------------------------------------------------------------- forecasting


@register("last_feature_row")
def q_last_feature_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item's most recent feature row."""
    return forecasting.last_feature_row(q_features(spark, sf_dir))


def _fallback(spark: SparkSession, sf_dir: str):
    from cyclecount.learning import models as learning_models

    _, items, _, counted, moved, _ = _history_inputs(spark, sf_dir, demo.SINCE, measures=[])
    without = categories.items_without_history(items, counted, moved)
    eligible = items.where(F.col("Lógica_ABC") > 0).join(without, "Código", "left_semi")
    return items, forecasting.fallback_forecast(eligible, list(learning_models.MODEL_NAMES))


@register("fallback_forecast")
def q_fallback_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without history forecast at their book quantity under every model name."""
    _prep(spark)
    return _fallback(spark, sf_dir)[1]


@register("forecast_valuation")
def q_forecast_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 + P24 + P25: forecasts with item info, forecast value, delta, absolute delta, tax."""
    _prep(spark)
    items, fc = _fallback(spark, sf_dir)
    return forecasting.valuation(forecasting.with_item_info(fc, items))


# -------------------------------------------------------------------- validation


def _ytd(spark: SparkSession, sf_dir: str):
    raw = demo.counts(spark, sf_dir)
    year, month = validation.latest_year_month(raw)
    return validation.ytd_validation(raw, demo.forecasts(spark, sf_dir), year, month)


@register("ytd_detail")
def q_ytd_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 / J12 + P26: per model and counted item: YTD actual, forecast, error, APE."""
    return _ytd(spark, sf_dir)[0]


@register("ytd_metrics")
def q_ytd_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model MAE, WMAPE, MAPE (rounded to 1e-6), totals and difference."""
    return _ytd(spark, sf_dir)[1].withColumn("MAPE", F.round("MAPE", 6))


@register("best_model")
def q_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model with the lowest YTD MAE."""
    return _ytd(spark, sf_dir)[2]


# ---------------------------------------------------------------------- learning

# All six models at the full search: up to 50 candidates on 5 folds, the boosted ones at their full
# tree counts with early stopping.
def _fitted(spark: SparkSession, feats: DataFrame):
    """The six models, written and read back: what scores is what was saved."""
    from cyclecount.learning import scoring

    path = scratch_path(spark, "models")
    scoring.save(spark, scoring.fit(feats), path)
    return scoring.load(spark, path)


@register("model_metrics")
def q_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE, RMSE, R2 on the last year, CV MAE and chosen params of the six models."""
    from cyclecount.learning import scoring

    _prep(spark)
    feats = prefix.written(q_features(spark, sf_dir), "features")
    return scoring.metrics(spark, _fitted(spark, feats))


@register("feature_importance")
def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each model's top 20 features by importance or coefficient magnitude."""
    from cyclecount.learning import scoring

    _prep(spark)
    feats = prefix.written(q_features(spark, sf_dir), "features")
    return scoring.importances(spark, _fitted(spark, feats))


@register("ml_forecast")
def q_ml_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six models on each eligible item's last feature row, clipped at 0."""
    from cyclecount.learning import scoring

    _prep(spark)
    curve, items, daily, with_hist, mov_feat = _feature_inputs(spark, sf_dir)
    feats = prefix.written(features.build_features(daily, curve, mov_feat, with_hist, items=items), "features")
    eligible = items.where(F.col("Lógica_ABC") > 0).join(with_hist, "Código", "left_semi")
    return scoring.score_items(feats, eligible, _fitted(spark, feats))


@register("forecast_plan")
def q_forecast_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and fallback forecasts of the allocated items, valued, with month and tax.
    Every shared stage is computed once."""
    from cyclecount.learning import scoring

    _prep(spark)
    curve, items, daily, with_hist, mov_feat = _feature_inputs(spark, sf_dir)
    feats = prefix.written(features.build_features(daily, curve, mov_feat, with_hist, items=items), "features")
    fitted = _fitted(spark, feats)
    fc = pipeline.forecasting_inputs(items, with_hist, feats, fitted, scoring.trained_names(fitted))
    alloc = _allocate(spark, items, features.standardized_daily(daily)).allocation
    return forecasting.forecast_plan(fc, items, alloc)


# ------------------------------------------------------------------ data profile


@register("target_profile")
def q_target_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct values, zeros, mean, std, min, quartiles, max of the target."""
    _prep(spark)
    return stats.target_profile(q_features(spark, sf_dir))


def _numeric_features(df: DataFrame) -> list[str]:
    from cyclecount.learning.train import feature_columns

    return feature_columns(df)[0]


@register("constant_features")
def q_constant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric feature columns with a single value (sample std 0)."""
    _prep(spark)
    f = prefix.written(q_features(spark, sf_dir), "features")
    return stats.constant_features(f, _numeric_features(f))


@register("feature_correlation")
def q_feature_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G18 + O5: Pearson correlation (rounded to 1e-6) of each feature with the target on the training years; top/bottom 30."""
    from cyclecount.learning.train import TARGET, temporal_split

    _prep(spark)
    f = prefix.written(q_features(spark, sf_dir), "features")
    train_rows, _, _ = temporal_split(f)
    out = stats.feature_correlation(train_rows, _numeric_features(f), TARGET, k=30)
    return out.withColumn("corr", F.round("corr", 6))


# ------------------------------------------------------------- scalar functions


@register("standardize_codes")
def q_standardize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded, space-wrapped part keys -> standardized codes (one row per line item)."""
    li = demo.table(spark, sf_dir, "lineitem")
    raw = F.concat(F.lit(" "), F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lit(" "))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"), C.standardize_code(raw).alias("code"))


@register("fixed_codes")
def q_fixed_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + P8 + P9: 13-wide codes (last 13 characters), rack of a location, null-propagating key."""
    li = demo.table(spark, sf_dir, "lineitem")
    raw = F.concat(F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
                   F.col("l_suppkey").cast("string"))
    loc = F.concat(F.col("l_suppkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    return li.select(
        "l_orderkey",
        "l_linenumber",
        raw.alias("raw"),
        C.fixed_code(raw).alias("fixed"),
        C.rack(loc).alias("rack"),
        C.count_key(C.fixed_code(raw), loc, F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))).alias("key"),
    )


@register("parse_ptbr")
def q_parse_ptbr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pt-BR money text (thousands '.', decimal ',') of the line price -> decimal."""
    li = demo.table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    text = F.concat(
        F.translate(F.format_number((cents / F.lit(100)).cast("long"), 0), ",", "."),
        F.lit(","),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("text"), C.parse_money_ptbr(text).alias("value"))


@register("parse_timestamps")
def q_parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + P6 + P7: minute text -> timestamp -> date, year, month, first of month."""
    o = demo.table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "d/M/yyyy H:mm")
    ts = C.parse_minute_ts(text)
    parts = C.date_parts(ts)
    return o.select(
        "o_orderkey",
        text.alias("text"),
        parts["date"].alias("date"),
        parts["year"].alias("year"),
        parts["month"].alias("month"),
        C.month_start(parts["year"], parts["month"]).alias("month_start"),
    )


@register("ytd_detail_wide")
def q_ytd_detail_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The YTD detail with one column group (forecast, error, |error|, APE) per model."""
    raw = demo.counts(spark, sf_dir)
    fc = demo.forecasts(spark, sf_dir)
    year, month = validation.latest_year_month(raw)
    detail, _, _ = validation.ytd_validation(raw, fc, year, month)
    return validation.widen_by_model(detail, sorted(demo.FORECAST_MODELS))


@register("features_without_movements")
def q_features_without_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 + P18: the feature table when no movement export exists (expected movement columns are 0)."""
    _prep(spark)
    curve, items, daily, with_hist, _ = _feature_inputs(spark, sf_dir)
    return features.build_features(daily, curve, None, with_hist, items=items)
