"""Movement sums in whole numbers, numbers read as they are, and shuffles that start with many parts."""

from decimal import Decimal

from pyspark.sql import functions as F

from cyclecount.functions import columns as C
from cyclecount.operators import counts, movements
from cyclecount.session import INITIAL_CONF, PARTITIONS, ensure_partitions

SCHEMA = "Ano string, Mes string, CD_ARTICOLO string, Tipo_Movimento string, Qtd_Movimentos string, Total_Qtde string"


def rows():
    big = "99999999999999.999999"
    values = [big, "-" + big, big, "-12345.678901", "9999.9999995", "-10000", "0.0000005", "1e3", "NaN", "x", None, " 7 "]
    return [("2001", str(i % 2), f"00{i // 5}", t, str(i), v) for i, v in enumerate(values) for t in ("a", "b", None, "c")]


def exact(rows):
    """Sums by key and type in Python's decimals."""
    want = {}
    for year, month, code, kind, _, value in rows:
        if kind is None:
            continue
        try:
            v = Decimal(value).quantize(Decimal("0.000001"), "ROUND_HALF_UP") if value and value != "NaN" else Decimal(0)
        except ArithmeticError:
            v = Decimal(0)
        sums = want.setdefault((code.lstrip("0") or "0", int(year), int(month)), {})
        sums[kind] = sums.get(kind, 0) + v
    return want


def test_sums_of_any_size_are_exact_without_a_set_a_group(spark):
    data = rows() + [("2001", "3", "9", "a", str(i), "99999999999999.999999") for i in range(200)]
    got = movements.movement_features(spark.createDataFrame(data, SCHEMA))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    want = exact(data)
    found = {(r["Código"], r["Ano"], r["Mês"]): r for r in got.collect()}
    assert found.keys() == want.keys()
    for key, sums in want.items():
        r = found[key]
        for kind in "abc":
            assert r[f"{kind}_Total_Qtde_Mensal"] == sums.get(kind, 0)
        assert r["Total_Geral_Qtde_Mensal"] == sum(sums.values())
        assert r["Num_Tipos_Mov_Mensal"] == len(sums)


def test_more_types_than_bits_of_a_number(spark):
    data = [("2001", "1", "5", f"t{i:03}", "1", str(i)) for i in range(130)] + [("2001", "2", "5", "t129", "1", "4")]
    got = {r["Mês"]: r for r in movements.movement_features(spark.createDataFrame(data, SCHEMA)).collect()}
    assert (got[1]["Num_Tipos_Mov_Mensal"], got[2]["Num_Tipos_Mov_Mensal"]) == (130, 1)
    assert got[1]["Total_Geral_Qtde_Mensal"] == sum(range(130)) and got[2]["t129_Total_Qtde_Mensal"] == 4


def test_listed_types_leave_the_totals_whole(spark):
    got = movements.movement_features(spark.createDataFrame(rows(), SCHEMA), ["a"])
    every = movements.movement_features(spark.createDataFrame(rows(), SCHEMA))
    same = ["Código", "Ano", "Mês", "a_Total_Qtde_Mensal", *movements.TOTAL_COLS]
    assert sorted(got.select(same).collect()) == sorted(every.select(same).collect())


def test_numbers_parse_like_their_text(spark):
    values = [0.1, -2.5, 1e-7, 5e-7, 1e20, 1e14, float("nan"), float("inf"), None, 12345.6789015]
    df = spark.createDataFrame([(v,) for v in values], "d double").withColumn("n", F.expr("try_cast(d as long)"))
    df = df.withColumn("f", F.col("d").cast("float"))
    assert [C.is_number(df, c) for c in ("d", "n", "f", "none")] == [True, True, False, False]
    for c in ("d", "n"):
        both = df.select(C.to_quantity(c).alias("a"), C.to_quantity(c, True).alias("b"), C.to_whole(c).alias("x"), C.to_whole(c, number=True).alias("y"))
        assert all(r["a"] == r["b"] and r["x"] == r["y"] for r in both.collect())
    # a column kept as numbers makes no text of them
    rows = df.select(F.lit(1).alias("Ano"), F.lit(2).alias("Mes"), F.lit("7").alias("CD_ARTICOLO"), F.lit("a").alias("Tipo_Movimento"),
                     F.col("n").alias("Qtd_Movimentos"), F.col("d").alias("Total_Qtde"))
    plan = movements.movement_rows(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan


def test_key_parts_are_parsed_once(spark):
    cols = ["NOK", "Status", "Código", "Locação", "UdE", "Compartimento", "Status Inventario", "Atualização",
            "Contagem", "Física", "Quantidade Fisica", "Lógica", "Custo"]
    row = ["", "FECHADO", "7", "R1.2", "5", "1", "FECHADO", "1/2/2024 3:05", "1", "2", "2", "3", "1,5"]
    broken = [[*row[:i], bad, *row[i + 1 :]] for i, bad in ((4, "x"), (5, "NaN"), (6, None), (7, "soon"))]
    last = counts.last_counts(spark.createDataFrame([row, [*row[:8], "2", *row[9:]], *broken], ", ".join(f"`{c}` string" for c in cols)))
    (got,) = last.collect()
    assert (got["Contagem"], got["Estante"], got["Ano"], got["Mês"], str(got["Data INV"])) == (2, "R1", 2024, 2, "2024-02-01")
    plan = last._jdf.queryExecution().optimizedPlan()
    while plan.children().size():
        if plan.nodeName() == "Filter":
            assert "gettimestamp" not in plan.toString().split("\n")[0] and "decimal(38,0)" not in plan.toString().split("\n")[0]
        plan = plan.children().apply(0)


def test_shuffles_start_with_many_parts_unless_named(spark):
    before = spark.conf.get(INITIAL_CONF, None)
    try:
        spark.conf.unset(INITIAL_CONF)
        ensure_partitions(spark)
        assert spark.conf.get(INITIAL_CONF) == str(PARTITIONS)
        spark.conf.set(INITIAL_CONF, "7")
        ensure_partitions(spark)
        assert spark.conf.get(INITIAL_CONF) == "7"
    finally:
        spark.conf.unset(INITIAL_CONF) if before is None else spark.conf.set(INITIAL_CONF, before)


def test_code_of_a_row_does_not_grow_with_the_types(spark):
    rows = [(2024, 1, "007", f"t{i}", 1.0, float(i)) for i in range(20)]
    mov = spark.createDataFrame(rows, "Ano int, Mes int, CD_ARTICOLO string, Tipo_Movimento string, Qtd_Movimentos double, Total_Qtde double")
    out = movements.movement_features(mov)
    row = out.first()
    assert [float(row[f"t{i}_Total_Qtde_Mensal"]) for i in range(20)] == [float(i) for i in range(20)]
    assert (float(row["Total_Geral_Qtde_Mensal"]), row["Num_Tipos_Mov_Mensal"]) == (190.0, 20)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [")[0]
    assert plan.count("CASE WHEN") <= 2  # one for any number of totals


def test_sums_joined_as_whole_numbers_make_the_same_features(spark):
    mov = spark.createDataFrame(rows(), SCHEMA)
    want = movements.movement_features(mov)
    sums = movements.movement_sums(mov, movements.movement_types(mov))
    assert {t for c, t in sums.rows.dtypes if c not in movements.KEYS} <= {"bigint", "int"}
    missing = spark.createDataFrame([("none", 2024, 1)], want.select(*movements.KEYS).schema)
    got = sums.of(want.select(*movements.KEYS).union(missing).join(sums.rows, movements.KEYS, "left")).select(*want.columns)
    assert [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert sorted(got.where("`Código` != 'none'").collect()) == sorted(want.collect())
    (none,) = got.where("`Código` = 'none'").collect()
    assert set(none[3:]) == {0}
