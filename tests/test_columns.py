from decimal import Decimal

from pyspark.sql import functions as F

from cyclecount.functions import columns as C


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_standardize_code(spark):
    got = one(spark, [(" 00012 ",), ("000",), (None,), ("\t7\n",)], "c string", C.standardize_code("c"))
    assert got == ["12", "0", None, "7"]


def test_fixed_code_keeps_last_13(spark):
    got = one(spark, [("123",), ("12345678901234",)], "c string", C.fixed_code("c"))
    assert got == ["0000000000123", "2345678901234"]


def test_money_ptbr(spark):
    got = one(spark, [("1.234,56",), ("12,5",), ("x",)], "c string", C.parse_money_ptbr("c"))
    assert got == [Decimal("1234.56"), Decimal("12.50"), None]


def test_minute_timestamp(spark):
    df = spark.createDataFrame([("31/12/2024 23:59",), ("1/2/2024 3:05",), ("bad",)], "c string")
    got = [r[0] for r in df.select(F.date_format(C.parse_minute_ts("c"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2024-12-31 23:59", "2024-02-01 03:05", None]


def test_counted_quantity(spark):
    rows = [(None, 5.0), (0.0, 5.0), (7.0, 5.0)]
    got = one(spark, rows, "f double, q double", C.counted_quantity("f", "q"))
    assert got == [5.0, 0.0, 7.0]


def test_half_even(spark):
    got = one(spark, [(0.5,), (1.5,), (2.5,)], "x double", C.round_half_even_long("x"))
    assert got == [0, 2, 2]


def test_money_half_even_on_decimals(spark):
    got = one(spark, [(Decimal("2.345"),), (Decimal("2.355"),)], "x decimal(18,3)", C.money(F.col("x")))
    assert got == [Decimal("2.34"), Decimal("2.36")]


def test_control_label_and_priority(spark):
    rows = [("ANULADO", "A"), ("FECHADO", "B"), ("X", "C"), (None, None)]
    df = spark.createDataFrame(rows, "s string, k string")
    got = [tuple(r) for r in df.select(C.control_label("s"), C.class_priority("k")).collect()]
    assert got == [("Custo Evitado", 3), ("Valor Consultivado", 2), ("-", 1), ("-", 0)]


def test_rack_and_key(spark):
    df = spark.createDataFrame([("R1.2.3", "a"), ("R9", None)], "loc string, b string")
    got = [tuple(r) for r in df.select(C.rack("loc"), C.count_key("loc", "b")).collect()]
    assert got == [("R1", "R1.2.3_a"), ("R9", None)]


def test_clip_nan(spark):
    got = one(spark, [(-1.0,), (float("nan"),), (3.0,)], "x double", C.clip_at_zero("x"))
    assert got == [0.0, 0.0, 3.0]


def test_codes_and_money_need_no_regular_expressions(spark):
    texts = [None, "", "0", "000", " 00120 ", "\t007\n", "1.234,56", "1,234.56", "0,5", "12", ".,", "00\n00", "a0b", "0 0", "1.2.3,4,5", "\xa00x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    trimmed = C.strip_ws("t")
    zeros = F.regexp_replace(trimmed, r"^0+", "")
    pt = F.regexp_replace(F.regexp_replace(trimmed, r"\.", ""), ",", ".").try_cast(C.COST)
    en = F.regexp_replace(F.regexp_replace(trimmed, ",", ""), r"\.", ".").try_cast(C.COST)
    new = df.select(C.standardize_code("t"), C.parse_money_ptbr("t"), C.parse_money_ptbr("t", locale="en"))
    assert "regexp" not in new._jdf.queryExecution().optimizedPlan().toString()
    old = df.select(F.when(zeros == "", F.lit("0")).otherwise(zeros), pt, en)
    assert [tuple(r) for r in new.collect()] == [tuple(r) for r in old.collect()]
