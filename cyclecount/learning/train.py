"""Training, evaluation and scoring of the counted-quantity regressors.

Everything runs as Spark jobs: preprocessing statistics come from one
aggregate, models are columns once they are fitted, and the test metrics of all
models are one aggregate over their predictions.
The hyperparameter search is a seeded random search over expanding time folds
cut at month boundaries. Linear models are searched from sums by month; the fits of trees and
boosted trees are the tasks of one job.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclecount.functions import columns as C
from cyclecount.learning import boosting, gram, trees
from cyclecount.learning.models import MODEL_NAMES
from cyclecount.operators import stats

TARGET = "Quantidade Fisica"
# Columns never used as features (ids, target, item info).
ALWAYS_EXCLUDED = (
    "Código",
    "Mês",
    TARGET,
    "Data INV",
    "Lógica_ABC",
    "Custo_Unitário",
    "Valor_Estoque",
    "Ano_Previsto",
    "Mês_Previsto",
)
# Columns derived from the counted quantity itself (the target); excluded unless asked.
LEAKAGE = ("Valor Fisico", "Vlr Delta", "Delta ABS")


@dataclass(frozen=True)
class SearchBudget:
    """Search effort. Defaults follow the reference: up to 50 candidates, 5 folds."""

    max_candidates: int = 50
    max_splits: int = 5
    seed: int = 42
    parallelism: int = 4


# --------------------------------------------------------------------- M1, M2


def feature_columns(df: DataFrame, allow_leakage: bool = False) -> tuple[list[str], list[str]]:
    """M1: (numeric, categorical) feature columns in table order."""
    skip = set(ALWAYS_EXCLUDED) | (set() if allow_leakage else set(LEAKAGE))
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
    return numeric, categorical


def clean_features(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """P19 + P17: +-Inf/NaN -> NULL -> 0 for numbers, 'Unknown' for categories."""
    cols = {c: F.coalesce(C.finite_or_null(C.col(c).cast("double")), F.lit(0.0)) for c in numeric}
    cols.update({c: F.coalesce(C.col(c).cast("string"), F.lit(C.UNKNOWN_CLASS)) for c in categorical})
    return df.withColumns(cols)


def temporal_split(df: DataFrame, year_col: str = "Ano") -> tuple[DataFrame, DataFrame, int | None]:
    """M2: last year = test, earlier years = train; fewer than two years -> all train."""
    row = df.agg(F.countDistinct(year_col).alias("n"), F.max(year_col).alias("last")).first()
    if row is None or row["n"] is None or row["n"] < 2:
        return df, df.limit(0), None
    last = int(row["last"])
    return df.where(F.col(year_col) < last), df.where(F.col(year_col) == last), last


def processed_correlation(df: DataFrame, target: str = TARGET, k: int = 30) -> DataFrame:
    """G18 + O5: correlation with the target of the processed features: the scaled numbers (which
    scaling leaves as they are) and every category's one-hot slot; the ``k`` highest and lowest."""
    numeric, categorical = feature_columns(df)
    clean = clean_features(df, numeric, categorical)
    y = C.col(target).cast("double")
    row = clean.agg(*[F.corr(C.col(c), y).alias(f"_r{i}") for i, c in enumerate(numeric)])
    slots = [F.struct(F.lit(f"num__{c}").alias("feature"), F.col(f"_r{i}").alias("corr")) for i, c in enumerate(numeric)]
    long = row.select(F.explode(F.array(*slots)).alias("r")).select("r.*")
    if categorical:
        hot = stats.category_correlation(clean, categorical, target)
        long = long.unionByName(hot.select(F.concat(F.lit("cat__"), "feature", F.lit("_"), "value").alias("feature"), "corr"))
    return stats.strongest(long, k)


# --------------------------------------------------------------------- M3, M4


@dataclass
class Preprocessor:
    """M3 + M4: robust scaling of numbers, one-hot of categories, one vector column."""

    numeric: list[str]
    categorical: list[str]
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)
    stages: list[Transformer] = field(default_factory=list)
    slots: list[str] = field(default_factory=list)

    def fit(self, train: DataFrame) -> "Preprocessor":
        # exact medians and quartiles of all columns in the same few passes
        if self.numeric:
            got = {(r["feature"], r["p"]): r["value"] for r in stats.exact_quantiles(train, self.numeric, [0.25, 0.5, 0.75]).collect()}
            for c in self.numeric:
                q25, q50, q75 = [float(got.get((c, p), 0.0)) for p in (0.25, 0.5, 0.75)]
                iqr = q75 - q25
                self.center[c] = q50
                # a zero spread scales by 1 (a zero-IQR feature keeps its information)
                self.scale[c] = iqr if iqr != 0 else 1.0
        self.stages = []
        self.slots = [f"num__{c}" for c in self.numeric]
        ohe_cols = []
        for i, c in enumerate(self.categorical):
            idx = StringIndexer(inputCol=c, outputCol=f"_idx{i}", handleInvalid="keep", stringOrderType="alphabetAsc")
            im = idx.fit(train)
            ohe = OneHotEncoder(inputCol=f"_idx{i}", outputCol=f"_ohe{i}", dropLast=True).fit(im.transform(train))
            self.stages += [im, ohe]
            ohe_cols.append(f"_ohe{i}")
            self.slots += [f"cat__{c}_{label}" for label in im.labels]
        scaled = [f"_sc{i}" for i in range(len(self.numeric))]
        self.stages.append(VectorAssembler(inputCols=scaled + ohe_cols, outputCol="features", handleInvalid="keep"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df.withColumns(
            {
                f"_sc{i}": (C.col(c).cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])
                for i, c in enumerate(self.numeric)
            }
        )
        for st in self.stages:
            out = st.transform(out)
        return out


# --------------------------------------------------------------------- M5-M7


def _linear(params):
    return LinearRegression(
        featuresCol="features", labelCol="label", regParam=0.0, elasticNetParam=0.0,
        fitIntercept=bool(params.get("fitIntercept", True)), standardization=False, solver="normal",
    )


# The search spaces, ("int", lo, hi) | ("uniform", lo, hi) | ("log", lo, hi) |
# ("choice", [...]).
SPACES: dict[str, dict[str, tuple]] = {
    "GBT Depthwise": {"maxIter": ("int", 100, 500), "maxDepth": ("int", 3, 10), "stepSize": ("log", 0.01, 0.3)},
    "GBT Subsampled": {
        "maxIter": ("int", 100, 1000),
        "maxDepth": ("int", 5, 15),
        "minInstancesPerNode": ("int", 10, 100),
        "stepSize": ("uniform", 0.01, 0.3),
        "featureFraction": ("uniform", 0.7, 1.0),
        "minInfoGain": ("uniform", 0.0, 0.1),
        "numLeaves": ("int", 20, 100),
        "l1": ("uniform", 0.0, 1.0),
        "l2": ("uniform", 0.0, 1.0),
        "subsamplingRate": ("choice", [0.8]),
    },
    "Linear Regression": {"fitIntercept": ("choice", [True, False])},
    "Ridge": {"alpha": ("log", 0.1, 10.0), "maxIter": ("int", 1000, 50000)},
    "Lasso": {"alpha": ("log", 0.1, 10.0), "maxIter": ("int", 1000, 50000)},
    "Decision Tree": {"maxDepth": ("int", 5, 30)},
}


def sample_candidates(space: dict[str, tuple], n: int, rng: np.random.Generator) -> list[dict[str, Any]]:
    """M8: ``n`` distinct seeded random draws from a search space."""
    out: list[dict[str, Any]] = []
    seen = set()
    for _ in range(n * 4):
        cand = {}
        for name, spec in sorted(space.items()):
            kind = spec[0]
            if kind == "int":
                cand[name] = int(rng.integers(spec[1], spec[2] + 1))
            elif kind == "uniform":
                cand[name] = float(rng.uniform(spec[1], spec[2]))
            elif kind == "log":
                cand[name] = float(math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2]))))
            else:
                cand[name] = spec[1][int(rng.integers(0, len(spec[1])))]
        key = tuple(sorted(cand.items()))
        if key not in seen:
            seen.add(key)
            out.append(cand)
        if len(out) >= n:
            break
    return out


# --------------------------------------------------------------------- M8, M9


def month_folds(train: DataFrame, n_splits: int) -> list[tuple[int, int]]:
    """M9: expanding folds cut at month boundaries: (train up to key, validate up to key).

    Month keys are year*12+month; the list of months is bounded by the calendar.
    """
    months = sorted(
        r[0] for r in train.select((F.col("Ano") * 12 + F.col("Mês")).alias("k")).distinct().collect()
    )
    if len(months) < 2:
        return []
    n_splits = max(1, min(n_splits, len(months) - 1))
    block = len(months) // (n_splits + 1)
    first = len(months) - block * n_splits
    folds = []
    for i in range(n_splits):
        tr_end = months[first + i * block - 1]
        va_end = months[min(len(months) - 1, first + (i + 1) * block - 1)]
        folds.append((tr_end, va_end))
    return folds


@dataclass
class Trained:
    name: str
    model: Any
    params: dict[str, Any]
    cv_mae: float | None
    error: str | None = None


#: Models that are searched from sums by month.
LINEAR = ("Linear Regression", "Ridge", "Lasso")
BOOSTED = ("GBT Depthwise", "GBT Subsampled")


#: Rows for which a fit of trees has a part at least.
PART_ROWS = 250_000


def _tree_parts(spark, n_rows: int, budget: SearchBudget) -> int:
    """Most parts of the rows in a fit of trees: its share of the cores beside the other fits, or as
    many as the rows ask for. Every part of every pass sends the sums of all nodes of a level,
    however few rows it has, so parts beyond that only add to what is shuffled."""
    return max(1, math.ceil(spark.sparkContext.defaultParallelism / max(1, budget.parallelism)), math.ceil(n_rows / PART_ROWS))


def _mean_errors(maes: np.ndarray) -> np.ndarray:
    """Each candidate's error over the folds (rows) that have one; infinite without any."""
    seen = np.isfinite(maes)
    mean = np.where(seen, maes, 0.0).sum(0) / np.maximum(seen.sum(0), 1)
    return np.where(seen.any(0), mean, np.inf)


def _finite(score: float) -> float | None:
    return None if math.isnan(score) or math.isinf(score) else score


def _failed(name: str, e: Exception | str) -> Trained:
    """A failed model gets null metrics, as in the reference."""
    return Trained(name, None, {}, None, e if isinstance(e, str) else f"{type(e).__name__}: {e}"[:500])


def search_trees(
    design: DataFrame, candidates: dict[str, list[dict[str, Any]]], folds: list[tuple[int, int]], seed: int, parts: int | None = None
) -> dict[str, Trained]:
    """Every candidate of the tree and the boosted models on every fold, as tasks of one job (a fold's
    depths of the tree are one), then each model's best on all rows."""
    key = (F.col("Ano") * 12 + F.col("Mês")).cast("int")
    months = sorted(r[0] for r in design.select(key).distinct().collect())  # bounded by the calendar
    if not months:
        raise ValueError("no rows to learn from")
    share, folds = trees.BoostedFit.validation_share, [(int(a), int(b)) for a, b in folds]
    early = [boosting.span(months, a, b, share) for a, b in folds]
    whole = boosting.span(months, months[-1], months[-1], share)
    jobs: dict[str, list[boosting.Fit]] = {}
    for name, cands in candidates.items():
        if len(cands) < 2:  # one alone has no choice
            jobs[name] = []
        elif name in BOOSTED:
            jobs[name] = [boosting.Fit(c, each, seed) for each in early for c in cands]
        else:
            deepest, depths = {**cands[0], "maxDepth": max(c["maxDepth"] for c in cands)}, tuple(c["maxDepth"] for c in cands)
            jobs[name] = [boosting.Fit(deepest, boosting.Span(a, a, b), seed, depths) for a, b in folds]
    fits = [fit for mine in jobs.values() for fit in mine]
    last = [whole] if any(name in BOOSTED for name in candidates) else []
    binned = boosting.Binned(design, [*last, *(fit.span for fit in fits)])
    got, out, final = iter(binned.run(fits)), {}, {}
    for name, cands in candidates.items():
        mine = [next(got) for _ in jobs[name]]
        if error := next((r.error for r in mine if r.error), None):
            out[name] = _failed(name, error)
            continue
        mean = _mean_errors(np.array([r.maes for r in mine]).reshape(len(folds), -1)) if mine else np.array([np.nan])
        best = int(mean.argmin())
        out[name] = Trained(name, None, cands[best], _finite(float(mean[best])))
        if name in BOOSTED:
            final[name] = boosting.Fit(cands[best], whole, seed)
    for name, r in zip(final, binned.run(list(final.values()), trees=True), strict=True):
        out[name].model = r.forest
        if r.error:
            out[name] = _failed(name, r.error)
    for name, t in out.items():
        if name not in BOOSTED and not t.error:
            try:
                t.model = trees.TreeFit(t.params, seed, parts).fit(design)
            except Exception as e:  # noqa: BLE001
                out[name] = _failed(name, e)
    return out


def train_models(
    design: DataFrame,
    budget: SearchBudget = SearchBudget(),
    names: tuple[str, ...] = MODEL_NAMES,
    spaces: dict[str, dict[str, tuple]] | None = None,
) -> dict[str, Trained]:
    """M5-M9: search each model's space on time folds (objective MAE), refit the best. A model with
    a single candidate has nothing to choose and no error of the search.

    ``design`` has ``features``, ``label``, ``Ano``, ``Mês`` and is the training
    split. A failing model is reported with no model and its error (M10 gives it null metrics).
    """
    design = design.select("features", "label", "Ano", "Mês").persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = design.count()
    n_splits = min(budget.max_splits, max(2, n_rows // 2))
    folds = month_folds(design, n_splits)
    parts = _tree_parts(design.sparkSession, n_rows, budget)
    rng = np.random.default_rng(budget.seed)
    n_iter = min(budget.max_candidates, max(2, n_rows // max(1, len(folds) or 1)))
    candidates = {name: sample_candidates((spaces or SPACES)[name], n_iter, rng) for name in names}
    results: dict[str, Trained] = {}
    try:
        linear = [name for name in names if name in LINEAR]
        if linear:
            try:
                found = gram.search(design, {name: candidates[name] for name in linear}, folds)
                for name in linear:
                    i, score = found.best(name)
                    results[name] = Trained(name, found.final[name][i], candidates[name][i], _finite(score))
            except Exception as e:  # noqa: BLE001
                results |= {name: _failed(name, e) for name in linear}
        mine = {name: candidates[name] for name in names if name not in LINEAR}
        if mine:
            try:
                results |= search_trees(design, mine, folds, budget.seed, parts)
            except Exception as e:  # noqa: BLE001
                results |= {name: _failed(name, e) for name in mine}
    finally:
        design.unpersist()
    return {name: results[name] for name in names}


# --------------------------------------------------------------------- M10, M11


def _metric_columns(prediction: Column, label: Column, suffix: str = "") -> list[Column]:
    err = prediction - label
    return [
        F.avg(F.abs(err)).alias(f"MAE{suffix}"),
        F.sqrt(F.avg(err * err)).alias(f"RMSE{suffix}"),
        F.when(
            F.var_pop(label) * F.count(F.lit(1)) > 0,
            F.lit(1.0) - F.sum(err * err) / (F.var_pop(label) * F.count(F.lit(1))),
        ).alias(f"R2{suffix}"),
    ]


def regression_metrics(pred: DataFrame) -> DataFrame:
    """One row of n, MAE, RMSE and R2 of ``prediction`` against ``label`` (one aggregate);
    NULL without rows, R2 also for a constant label."""
    return pred.agg(F.count(F.lit(1)).alias("n"), *_metric_columns(F.col("prediction"), F.col("label")))


def predictions(trained: dict[str, Trained], names: tuple[str, ...] = MODEL_NAMES) -> dict[str, Column]:
    """Each fitted model's prediction as a column over ``features``."""
    fitted = [n for n in names if trained.get(n) is not None and trained[n].model is not None]
    return {n: trained[n].model.prediction(F.col("features")) for n in fitted}


def evaluate(trained: dict[str, Trained], test: DataFrame | None, names: tuple[str, ...] = MODEL_NAMES) -> list[tuple]:
    """MAE, RMSE, R2 on the test split per model (NULL when not available): all models'
    predictions in one scan, all their metrics in one aggregate."""
    columns = predictions(trained, names)
    got: dict[str, Any] = {}
    if test is not None and columns:
        side_by_side = test.select("label", *[p.alias(f"_p{i}") for i, p in enumerate(columns.values())])
        parts = [_metric_columns(F.col(f"_p{i}"), F.col("label"), f"_{i}") for i in range(len(columns))]
        row = side_by_side.agg(*[c for part in parts for c in part]).first()
        got = {n: [row[f"{m}_{i}"] for m in ("MAE", "RMSE", "R2")] for i, n in enumerate(columns)}
    rows = []
    for order, name in enumerate(names):
        t = trained.get(name)
        cv, error = (None, None) if t is None else (t.cv_mae, t.error)
        rows.append((name, order, *got.get(name, [None] * 3), cv, str(t.params if t else {}), error))
    return rows


def metrics_frame(spark, rows) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("Modelo", T.StringType()),
            T.StructField("Ordem", T.IntegerType()),
            T.StructField("MAE", T.DoubleType()),
            T.StructField("RMSE", T.DoubleType()),
            T.StructField("R2", T.DoubleType()),
            T.StructField("CV_MAE", T.DoubleType()),
            T.StructField("Params", T.StringType()),
            T.StructField("Error", T.StringType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def best_model_name(metric_rows) -> str | None:
    """Lowest test MAE; ties and missing metrics resolved by model order."""
    valid = [(r[2], r[1], r[0]) for r in metric_rows if r[2] is not None]
    return min(valid)[2] if valid else None


def importances(spark, trained: dict[str, Trained], slots: list[str], k: int = 20) -> DataFrame:
    """Per model the top ``k`` features by |importance| or |coefficient|."""
    rows = []
    for name, t in trained.items():
        if t.model is None:
            continue
        if hasattr(t.model, "featureImportances"):
            vals, kind = t.model.featureImportances.toArray(), "importance"
        elif hasattr(t.model, "coefficients"):
            vals, kind = t.model.coefficients.toArray(), "coefficient"
        else:
            continue
        ranked = sorted(zip(slots, vals.tolist()), key=lambda x: (-abs(x[1]), x[0]))[:k]
        rows += [(name, kind, rank + 1, f, float(v)) for rank, (f, v) in enumerate(ranked)]
    schema = T.StructType(
        [
            T.StructField("Modelo", T.StringType()),
            T.StructField("Tipo", T.StringType()),
            T.StructField("Rank", T.IntegerType()),
            T.StructField("Feature", T.StringType()),
            T.StructField("Valor", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)
