"""Readers (S1-S6). Every column is read as text (no inference) and typed later by
the operators' cleaning projections, so codes keep their leading zeros."""

from __future__ import annotations

import functools
import re
import warnings
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclecount.functions import columns as C

# The source files' dialects.
COUNT_FILE_OPTIONS = {"sep": ";", "encoding": "ISO-8859-1", "header": "true"}
STOCK_FILE_OPTIONS = {"sep": ";", "encoding": "ISO-8859-1", "header": "true"}
MOVEMENT_FILE_OPTIONS = {"sep": ",", "encoding": "UTF-8", "header": "true"}

STOCK_COLS = ["Produto", "Descr. Produto", "Estoqueada", "Locação"]
COST_COLS = ["Material", "Custo Médio", "Ano", "Período"]
COUNT_COLS = [
    "NOK", "Status", "Código", "Locação", "UdE", "Compartimento", "Status Inventario",
    "Atualização", "Contagem", "Física", "Quantidade Fisica", "Custo", "Lógica",
]
MOVEMENT_COLS = ["Ano", "Mes", "CD_ARTICOLO", "Tipo_Movimento", "Qtd_Movimentos", "Total_Qtde"]
FORECAST_COLS = ["Model_Name", "Código", "Ano_Previsto", "Mês_Previsto", "Previsao_Quantidade"]


def _csv(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> DataFrame:
    return spark.read.options(**options, inferSchema="false", enforceSchema="false").csv(path)


def _require(df: DataFrame, cols: Iterable[str], what: str) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}")
    return df


def read_stock(spark: SparkSession, path: str) -> DataFrame:
    """Stock snapshot, ``;``-separated ISO-8859-1 CSV."""
    df = _require(_csv(spark, path, STOCK_FILE_OPTIONS), STOCK_COLS, "stock")
    return df.select(*[C.col(c) for c in STOCK_COLS])


def read_costs(spark: SparkSession, path: str, fmt: str = "csv", options: dict[str, str] | None = None) -> DataFrame:
    """Monthly cost history (Material, Custo Médio, Ano, Período -> Mes).

    The reference reads a workbook; here the same columns come from CSV or Parquet.
    """
    if fmt == "csv":
        df = _csv(spark, path, options or {"sep": ";", "encoding": "ISO-8859-1", "header": "true"})
    else:
        df = spark.read.format(fmt).options(**(options or {})).load(path)
    df = _require(df, COST_COLS, "costs")
    return df.select(
        C.col("Material"), C.col("Custo Médio"), C.col("Ano"), C.col("Período").alias("Mes")
    )


#: Most columns of a count file.
HEADER_COLS = 256


def _headers(spark: SparkSession, paths: list[str], options: dict[str, str]) -> dict[str, tuple[str, ...] | None]:
    """The first line of each path's files, all in one job that stops after a line; None for a
    path that doesn't exist, and () for one whose files can't be read or are empty."""
    out: dict[str, tuple[str, ...] | None] = {}
    lines = []
    schema = ", ".join(f"c{i} string" for i in range(HEADER_COLS))
    for i, p in enumerate(paths):
        try:
            rows = spark.read.options(**options | {"header": "false"}, ignoreCorruptFiles="true").schema(schema).csv(p)
            # one task a path, which stops after a line: no exchange before the limit
            first = rows.where(F.col("_metadata.file_block_start") == 0).coalesce(1).limit(1)
            lines.append(first.select(F.lit(i).alias("i"), F.array(*rows.columns).alias("names")))
            out[p] = ()
        except AnalysisException:
            out[p] = None
    if lines:
        for r in functools.reduce(lambda a, b: a.unionAll(b), lines).collect():
            names = list(r["names"])
            while names and names[-1] is None:
                names.pop()
            out[paths[r["i"]]] = tuple(n if n is not None else f"_c{k}" for k, n in enumerate(names))
    return out


def _stacked(spark: SparkSession, headers: dict[str, tuple[str, ...]], file_col: bool = False) -> list[DataFrame]:
    """One scan a header; with ``file_col`` also the file and whether the row's shape is bad."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p, names in headers.items():
        by_header.setdefault(names, []).append(p)
    frames = []
    for names, files in by_header.items():
        if not file_col:
            frames.append(_csv(spark, files, COUNT_FILE_OPTIONS))
            continue
        schema = ", ".join(f"`{n}` string" for n in [*names, "_bad"])
        # a header that isn't the first file's would be read as a row: each header has its scan
        # all columns are parsed, or short rows would go unseen
        rows = spark.read.options(
            **COUNT_FILE_OPTIONS, columnNameOfCorruptRecord="_bad", enforceSchema="true", columnPruning="false"
        )
        rows = rows.schema(schema).csv(files)
        frames.append(rows.withColumns({"_file": F.col("_metadata.file_path"), "_bad": F.col("_bad").isNotNull()}))
    return frames


def read_counts(spark: SparkSession, paths: list[str], skipped: list[str] | None = None) -> DataFrame | None:
    """S3: several count files stacked by column name.

    The headers are read in one job. Files with equal headers are read in one scan, so the plan has
    a branch for each header, not for each file; ``unionByName(allowMissingColumns=True)`` aligns
    the branches. Missing or unreadable files are skipped with a warning (and named in
    ``skipped``). A required column that no file has is an error: without ``Status`` or ``NOK``
    every row would be dropped, or kept, unseen. Returns None when no file could be read.
    A file that only breaks further on fails the job that reads it: ``read_counts_reported``
    finds and skips those.
    """
    headers = _headers(spark, paths, COUNT_FILE_OPTIONS)
    good = {p: h for p, h in headers.items() if h}
    for p in paths:
        if p not in good:
            warnings.warn(f"count file skipped: {p} ({'missing' if headers[p] is None else 'unreadable'})", stacklevel=2)
            if skipped is not None:
                skipped.append(p)
    if not good:
        return None
    out = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _stacked(spark, good))
    return _require(out, COUNT_COLS, "counts")


_BROKEN = re.compile(r"FAILED_READ_FILE[^\]]*\][^\n]*?reading file (\S+?)\.?(?:\s|$)")


def read_counts_reported(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """S3 with files that break while being read: the counts of the whole files, and a report with
    a row for each path: path, status (read, missing, unreadable, broken), files, rows, bad_rows.

    The rows are counted by file in one pass over everything. A file that can't be read to its
    end fails that pass and is named by the error; its path is left out and the pass repeated, so
    a broken file costs one repetition and whole files nothing. Rows with too few or too many
    fields count as bad; they are kept, with nulls or without the surplus.
    """
    headers = _headers(spark, paths, COUNT_FILE_OPTIONS)
    status = {p: "missing" if h is None else "unreadable" for p, h in headers.items()}
    good = {p: h for p, h in headers.items() if h}
    counted: list[tuple[str, int, int]] = []
    while good:
        frames = _stacked(spark, good, file_col=True)
        per = [
            f.groupBy("_file").agg(
                F.count(F.lit(1)).alias("n"), F.sum(F.col("_bad").cast("long")).alias("bad"), F.count(f.columns[0]).alias("_c")
            )
            for f in frames
        ]
        try:
            counted = [(r["_file"], r["n"], r["bad"]) for r in functools.reduce(lambda a, b: a.unionByName(b), per).collect()]
            break
        except Exception as e:  # noqa: BLE001 - only failures to read a file are handled here
            found = _BROKEN.search(str(e))
            hit = [p for p in good if found and _within(found.group(1), p)]
            if not hit:
                raise
            for p in hit:
                status[p] = "broken"
                del good[p]
    rows = []
    for p in paths:
        mine = [(n, bad) for f, n, bad in counted if p in good and _within(f, p)]
        if p in good:
            rows.append((p, "read", len(mine), sum(n for n, _ in mine), sum(bad for _, bad in mine)))
        else:
            rows.append((p, status[p], 0, 0, 0))
    report = spark.createDataFrame(rows, "path string, status string, files int, rows long, bad_rows long")
    if not good:
        return None, report
    frames = [f.drop("_file", "_bad") for f in _stacked(spark, good, file_col=True)]
    out = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return _require(out, COUNT_COLS, "counts"), report


def _within(file: str, path: str) -> bool:
    """Whether ``file``, as Spark names it, is ``path`` or lies in it."""
    plain = lambda x: unquote(re.sub(r"^file:/+", "/", x)).rstrip("/")
    return plain(file) == plain(path) or plain(file).startswith(plain(path) + "/")


def read_count_timestamps(spark: SparkSession, path: str) -> DataFrame:
    """Only the ``Atualização`` column of a count file (CSV column pruning)."""
    return _csv(spark, path, COUNT_FILE_OPTIONS).select(C.col("Atualização"))


def read_movements(spark: SparkSession, folder: str, by_file: bool = False) -> DataFrame:
    """Every ``*.csv`` in a folder (``,``, UTF-8), stacked.

    A folder without such files gives an empty frame with the movement columns. One scan of
    the whole folder by default; header checking is on, so files whose
    header differs from the first fail loudly. ``by_file=True`` reads file by file
    and aligns by name (for a handful of files with different headers).
    """
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in MOVEMENT_COLS))
    if not by_file:
        try:
            df = spark.read.options(
                **MOVEMENT_FILE_OPTIONS, inferSchema="false", enforceSchema="false", pathGlobFilter="*.csv"
            ).csv(folder)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):
                return empty
            raise
        return _require(df, ["CD_ARTICOLO"], "movements").select(
            *[C.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in MOVEMENT_COLS]
        )
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(folder)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(
        st.getPath().toString() for st in fs.listStatus(hpath) if st.getPath().getName().endswith(".csv")
    )
    frames = [_csv(spark, f, MOVEMENT_FILE_OPTIONS) for f in files]
    if not frames:
        return empty
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    out = _require(out, ["CD_ARTICOLO"], "movements")
    return out.select(
        *[C.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in MOVEMENT_COLS]
    )


def read_forecasts(spark: SparkSession, path: str) -> DataFrame:
    """Forecast table partitioned by ``Model_Name`` (the name comes from the folder)."""
    df = spark.read.option("basePath", path).parquet(path)
    return _require(df, FORECAST_COLS, "forecasts").select(*[C.col(c) for c in FORECAST_COLS])
