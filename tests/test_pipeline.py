"""End to end: files in the source formats -> readers -> forecast and plan -> writers -> validation."""

from pyspark.sql import functions as F

from cyclecount.learning.train import SPACES, SearchBudget
from cyclecount.plans import demo, pipeline
from cyclecount.sources import readers

SF = "/root/testdata/sf0.001"


def _csv(df, path, sep, encoding):
    (df.coalesce(1).write.mode("overwrite").option("header", "true").option("sep", sep)
     .option("encoding", encoding).csv(path))


def test_forecast_plan_and_validation_from_files(spark, tmp_dir):
    ts = F.to_timestamp(F.col("Atualização"), "d/M/yyyy H:mm")
    counts = demo.counts(spark, SF)
    _csv(demo.stock(spark, SF).withColumn("Estoqueada", F.col("Estoqueada").cast("string")),
         f"{tmp_dir}/stock", ";", "ISO-8859-1")
    _csv(demo.costs(spark, SF).withColumnRenamed("Mes", "Período"), f"{tmp_dir}/costs", ";", "ISO-8859-1")
    _csv(counts.where(ts < F.lit("2000-01-01").cast("timestamp")), f"{tmp_dir}/counts_hist", ";", "ISO-8859-1")
    _csv(counts.where(ts >= F.lit("2000-01-01").cast("timestamp")), f"{tmp_dir}/counts_now", ";", "ISO-8859-1")
    _csv(demo.movements(spark, SF), f"{tmp_dir}/movements", ",", "UTF-8")

    inputs = pipeline.read_inputs(
        spark, f"{tmp_dir}/stock", f"{tmp_dir}/costs",
        [f"{tmp_dir}/counts_hist", f"{tmp_dir}/missing", f"{tmp_dir}/counts_now"], f"{tmp_dir}/movements",
    )
    small = {**SPACES, **{m: {**SPACES[m], "maxIter": ("int", 3, 6)} for m in ("GBT Depthwise", "GBT Subsampled")}}
    res = pipeline.forecast_and_plan(
        spark, inputs, 2001, 1, budget=SearchBudget(max_candidates=2, max_splits=2, parallelism=2), spaces=small
    )
    plan = res.forecast_plan.collect()
    assert plan, "some items are placed"
    assert {r["Model_Name"] for r in plan} <= {r[0] for r in res.metrics.select("Modelo").collect()}
    summary = res.plan_summary.collect()
    assert all(r["Pecas_Logica_Alocada"] <= r["Capacidade_Pecas_Logica"] for r in summary)
    assert res.best_model is not None

    pipeline.write_results(res, f"{tmp_dir}/out")
    back = readers.read_forecasts(spark, f"{tmp_dir}/out/forecast_plan")
    assert back.count() == len(plan)
    detail, metrics, best = ytd = pipeline.validate(spark, inputs.counts, back)
    pipeline.write_results(res, f"{tmp_dir}/again", ytd)
    assert spark.read.parquet(f"{tmp_dir}/again/ytd/detail").count() == detail.count()
    assert metrics.count() == back.select("Model_Name").distinct().count()
    assert best.count() == 1
