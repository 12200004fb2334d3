"""Operator 3: quality classifier on document statistics.

Statistics of a text's bytes, words and lines are standardized over all documents and mapped
to random Fourier features, which approximate a Gaussian kernel. Each partition sums its
part of the normal equations of a ridge regression on the labels; the sums are added up and
solved once. Labelled rows form two halves by hash: each half's solution scores the other,
and isotonic regression on these scores (counted on a fixed grid) calibrates the scores of
the solution over both halves.

Labels come only from rows that aren't held out; label, language, source and key are no
inputs. Defined cases: a null text is an empty text; null labels and labels of unknown
documents are not used; a null key isn't held out; without any label every score is 0.5; repeated documents and labels
count as often as they stand there; an empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclecount.llm.common import bounded_batches, crc_of_id, materialize, table

FEATURES, RIDGE, GAMMA, SEED = 192, 1.0, 0.05, 7
HOLD_OUT, THRESHOLD = 5, 0.3
#: Isotonic regression counts scores on a grid of this step.
GRID = 0.002

_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_SPACE = np.array([9, 10, 11, 12, 13, 32])
_PUNCT = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
N_STATS = 22


def statistics(data: bytes | None) -> np.ndarray:
    """The statistics of one text, given as UTF-8."""
    data = data or b""
    h = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n = max(1, len(data))
    words = data.split()
    lines = data.split(b"\n")
    w = max(1, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    upper, lower, digit = h[_UPPER].sum(), h[_LOWER].sum(), h[_DIGIT].sum()
    share = h[h > 0] / n
    return np.array(
        [
            np.log1p(len(data)),
            np.log1p(len(words)),
            sizes.mean(),
            sizes.std(),
            np.log1p(sizes.max()),
            (sizes <= 3).sum() / w,
            len(set(words)) / w,
            len(set(words)) / np.sqrt(w),
            upper / max(1, upper + lower),
            digit / n,
            h[_PUNCT].sum() / n,
            h[33] / w,  # !
            h[124] / w,  # |
            (h[44] + h[46]) / w,  # , .
            h[_SPACE].sum() / n,
            h[128:].sum() / n,
            -(share * np.log(share)).sum(),
            np.log1p(len(lines)),
            len(set(lines)) / len(lines),
            np.log1p(w / len(lines)),
            (h[60] + h[62] + h[123] + h[125] + h[59] + h[61]) / w,  # < > { } ; =
            h[47] / w,  # /
        ]
    )


@dataclass
class Model:
    """Standardization, random features, ridge weights and calibration knots."""

    mean: np.ndarray
    std: np.ndarray
    weights: np.ndarray
    xs: np.ndarray
    ys: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        if not len(self.xs):
            return np.full(len(stats), 0.5)
        raw = features(stats, self.mean, self.std) @ self.weights
        return np.clip(np.interp(raw, self.xs, self.ys), 0.0, 1.0)


def features(stats: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Random Fourier features of the standardized statistics, and these themselves."""
    rng = np.random.default_rng(SEED)
    turn = rng.normal(scale=np.sqrt(2 * GAMMA), size=(N_STATS, FEATURES))
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / std, -8, 8)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ turn + phase) * 4, z, np.ones((len(z), 1))])


def document_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and stats of every document, written once."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([statistics(t) for t in part], dtype=object)

    return materialize(docs.select(F.col(key), of(F.col(text).cast("binary")).alias("stats")), "quality-stats")


def pool(grid: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: block centres and means."""
    blocks: list[list[float]] = []
    for x, a, k in zip(grid.tolist(), ones.tolist(), n.tolist(), strict=True):
        blocks.append([x * k, a, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Model:
    """Fit on the labelled documents whose key isn't held out."""
    width = N_STATS + FEATURES + 1
    sums = stats.agg(
        F.count("*").alias("n"),
        *[F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(N_STATS)],
        *[F.sum(F.pow(F.get("stats", F.lit(i)), 2)).alias(f"q{i}") for i in range(N_STATS)],
    ).first()
    n = max(1, sums["n"])
    mean = np.array([(sums[f"s{i}"] or 0.0) / n for i in range(N_STATS)])
    var = np.array([(sums[f"q{i}"] or 0.0) / n for i in range(N_STATS)]) - mean**2
    std = np.where(var > 1e-12, np.sqrt(np.maximum(var, 1e-12)), 1.0)
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("y"))
    known = known.where(F.col("y").isNotNull() & (crc_of_id("_key") % HOLD_OUT != 0))
    rows = stats.join(known, F.col(key) == F.col("_key")).select(
        "stats", "y", (F.xxhash64(F.col(key)).bitwiseAND(F.lit(1).cast("long"))).cast("int").alias("half")
    )
    rows = materialize(rows, "quality-train")

    def sum_equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, width, width + 1))
        for pdf in batches:
            if len(pdf):
                phi = features(np.stack(pdf["stats"].to_numpy()), mean, std)
                for half in (0, 1):
                    own = phi[pdf["half"].to_numpy() == half]
                    y = pdf["y"].to_numpy()[pdf["half"].to_numpy() == half]
                    total[half] += np.hstack([own.T @ own, (own.T @ y)[:, None]])
        at = [(half, i) for half in (0, 1) for i in range(width)]
        yield pd.DataFrame(
            {"half": [a for a, _ in at], "i": [i for _, i in at], "sums": [total[a, i].tobytes() for a, i in at]}
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in pdf["sums"])
        return pd.DataFrame({"half": pdf["half"][:1], "i": pdf["i"][:1], "sums": [total.tobytes()]})

    schema = "half int, i int, sums binary"
    parts = rows.mapInPandas(sum_equations, schema).groupBy("half", "i").applyInPandas(add, schema)
    equations = np.zeros((2, width, width + 1))
    for r in parts.collect():  # 2 * width rows
        equations[r["half"], r["i"]] = np.frombuffer(r["sums"])
    penalty = RIDGE * np.eye(width)
    penalty[-1, -1] = 1e-6

    def solve(eq: np.ndarray) -> np.ndarray:
        return np.linalg.solve(eq[:, :width] + penalty, eq[:, width])

    other = [solve(equations[1]), solve(equations[0])]  # each half is scored by the other's

    @F.pandas_udf("int")
    def cell(stats_: pd.Series, half: pd.Series) -> pd.Series:
        if not len(stats_):
            return pd.Series([], dtype="int32")
        phi = features(np.stack(stats_.to_numpy()), mean, std)
        raw = np.where(half.to_numpy() == 0, phi @ other[0], phi @ other[1])
        return pd.Series(np.round(np.clip(raw, -1, 2) / GRID).astype("int32"))

    counted = rows.groupBy(cell("stats", "half").alias("cell")).agg(F.sum("y").alias("ones"), F.count("*").alias("n"))
    grid = sorted((r["cell"], r["ones"], r["n"]) for r in counted.collect())  # at most 3 / GRID rows
    if not grid:
        return Model(mean, std, np.zeros(width), np.array([]), np.array([]))
    cells, ones, n_ = (np.array(c, dtype=float) for c in zip(*grid, strict=True))
    xs, ys = pool(cells * GRID, ones, n_)
    return Model(mean, std, solve(equations.sum(axis=0)), xs, ys)


def score_statistics(stats: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model.score(np.stack(part.to_numpy())) if len(part) else [], dtype="float64")

    return of(stats)


def score_text(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            stats = np.stack([statistics(t) for t in part]) if len(part) else []
            yield pd.Series(model.score(stats) if len(part) else [], dtype="float64")

    return of(text.cast("binary"))


def keep_good(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents whose score is at least ``threshold``. Texts are read twice, once for
    the statistics to fit on and once to score, and never shuffled."""
    model = fit(document_statistics(docs, key, text), labels, key)
    return docs.where(score_text(F.col(text), model) >= threshold)


def op3_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: score of every document, learned from the labels not held out."""
    stats = document_statistics(table(spark, sf_dir, "documents"))
    model = fit(stats, table(spark, sf_dir, "labels"))
    out = stats.select(
        "doc_id",
        F.coalesce(crc_of_id() % HOLD_OUT == 0, F.lit(False)).alias("held_out"),
        score_statistics(F.col("stats"), model).alias("score"),
    )
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
