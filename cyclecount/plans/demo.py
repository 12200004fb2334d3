"""Stand-in inputs built from the driver's star-schema tables.

The library's inputs are a stock snapshot, a cost history, count records,
movement exports and forecast tables. The test data has none of these, so this
module shapes rows of ``lineitem`` and ``part`` into those schemas (mapping in
per month for the cost table); every step of the analytics runs in the operators
on whatever rows arrive here.

Each builder has a DuckDB twin in ``cyclecount.plans.oracle`` so the same inputs
can be rebuilt on the SQL side.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Scenario parameters of the demo (not properties of the data).
AS_OF_YEAR = 2001
AS_OF_MONTH = 1
SINCE = "2001-09-01"  # items whose latest count or movement is older have no recent history
FORECAST_MODELS = ("Logica", "Ajustado")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(col) -> F.Column:
    """Money in whole cents from a 2-decimal double (exact after rounding)."""
    return F.round(col * 100).cast("long")


def _ten_thousandths(n) -> F.Column:
    return (n.cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")


def stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock snapshot: one row per line item: item, description, quantity, location."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return li.join(part, li.l_partkey == part.p_partkey, "inner").select(
        F.col("l_partkey").cast("string").alias("Produto"),
        F.col("p_name").alias("Descr. Produto"),
        F.col("l_quantity").alias("Estoqueada"),
        F.col("l_suppkey").cast("string").alias("Locação"),
    )


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly average unit cost per item to four decimals; years as spreadsheets write them:
    plain, as ``2001.0``, or missing as ``NaN``."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(
        F.col("l_partkey").alias("p"),
        F.year("l_shipdate").alias("y"),
        F.month("l_shipdate").alias("m"),
    ).agg(
        F.sum(_cents(F.col("l_extendedprice"))).alias("cents"),
        F.sum(F.col("l_quantity").cast("long")).alias("q"),
    )
    return g.select(
        F.col("p").cast("string").alias("Material"),
        _ten_thousandths(F.expr("cents * 100 div q")).alias("Custo Médio"),
        F.when((F.col("p") + F.col("m")) % 97 == 5, F.lit("NaN"))
        .when(F.col("p") % 2 == 0, F.concat(F.col("y").cast("string"), F.lit(".0")))
        .otherwise(F.col("y").cast("string"))
        .alias("Ano"),
        F.col("m").alias("Mes"),
    )


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw count records, all columns as text like the ``;`` count files: unit costs with
    four decimals, 18-digit handling units, and a few marked, blank or unreadable fields."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.expr("cast(round(l_extendedprice * 100) as bigint) * 100 div cast(l_quantity as bigint)")
    int_part = F.format_number(F.expr("cast(round(l_extendedprice * 100) as bigint) * 100 div cast(l_quantity as bigint) div 10000"), 0)
    money_text = F.concat(
        F.translate(int_part, ",", "."), F.lit(","), F.lpad((unit % 10000).cast("string"), 4, "0")
    )
    return li.select(
        F.when(F.col("l_orderkey") % 41 == 1, F.lit("X")).when(F.col("l_orderkey") % 41 == 2, F.lit("")).alias("NOK"),
        F.when(F.col("l_linestatus") == "F", F.lit("FECHADO")).otherwise(F.lit("ABERTO")).alias("Status"),
        F.col("l_partkey").cast("string").alias("Código"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias(
            "Locação"
        ),
        (F.col("l_orderkey") + F.lit(340123450000000000)).cast("string").alias("UdE"),
        F.when(F.col("l_orderkey") % 53 == 3, F.lit("NaN"))
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("Compartimento"),
        F.when(F.col("l_returnflag") == "A", F.lit("ANULADO"))
        .when(F.col("l_returnflag") == "R", F.lit("FECHADO"))
        .otherwise(F.lit("PENDENTE"))
        .alias("Status Inventario"),
        F.date_format("l_shipdate", "d/M/yyyy H:mm").alias("Atualização"),
        F.round(F.col("l_tax") * 100).cast("int").cast("string").alias("Contagem"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
        .otherwise((F.col("l_quantity") * (1 - F.col("l_discount"))).cast("decimal(18,2)").cast("string"))
        .alias("Física"),
        F.col("l_quantity").cast("long").cast("string").alias("Quantidade Fisica"),
        money_text.alias("Custo"),
        F.col("l_quantity").cast("long").cast("string").alias("Lógica"),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movement export rows: year, month, zero-padded item code, type, count, quantity."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.year("l_shipdate").alias("Ano"),
        F.month("l_shipdate").alias("Mes"),
        F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("CD_ARTICOLO"),
        F.concat("l_returnflag", "l_linestatus").alias("Tipo_Movimento"),
        F.lit(1.0).alias("Qtd_Movimentos"),
        F.col("l_quantity").alias("Total_Qtde"),
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast table (Model_Name, Código, Ano_Previsto, Mês_Previsto, Previsao_Quantidade).

    Two forecast series per line item: the book quantity and the quantity net of the tax
    rate, as two "models".
    """
    li = table(spark, sf_dir, "lineitem")
    base = li.select(
        F.col("l_partkey").cast("string").alias("Código"),
        F.year("l_shipdate").alias("Ano_Previsto"),
        F.month("l_shipdate").alias("Mês_Previsto"),
        F.col("l_quantity").cast("decimal(18,3)").alias("q"),
        (F.col("l_quantity") * (1 - F.col("l_tax"))).cast("decimal(18,2)").cast("decimal(18,3)").alias("qa"),
    )
    a = base.select(
        F.lit(FORECAST_MODELS[0]).alias("Model_Name"), "Código", "Ano_Previsto", "Mês_Previsto",
        F.col("q").alias("Previsao_Quantidade"),
    )
    b = base.select(
        F.lit(FORECAST_MODELS[1]).alias("Model_Name"), "Código", "Ano_Previsto", "Mês_Previsto",
        F.col("qa").alias("Previsao_Quantidade"),
    )
    return a.unionByName(b)
