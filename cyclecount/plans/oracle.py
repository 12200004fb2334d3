"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each entry rebuilds the same stand-in inputs from the pre-registered driver views
and computes the operator's result independently in SQL. Names and types of the
output columns equal the Spark query's.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- inputs

STOCK = """
stock AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "Produto", p_name AS "Descr. Produto",
         l_quantity AS "Estoqueada", CAST(l_suppkey AS VARCHAR) AS "Locação"
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

COSTS = """
costs AS (
  SELECT CAST(p AS VARCHAR) AS "Material",
         CAST(CAST(cents * 100 // q AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS "Custo Médio",
         CASE WHEN (p + m) % 97 = 5 THEN 'NaN' WHEN p % 2 = 0 THEN y || '.0' ELSE y || '' END AS "Ano", m AS "Mes"
  FROM (SELECT l_partkey AS p, year(l_shipdate) AS y, month(l_shipdate) AS m,
               SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS cents,
               SUM(CAST(l_quantity AS BIGINT)) AS q
        FROM lineitem GROUP BY 1, 2, 3)
)"""

LATEST_COST = """
latest_cost AS (
  SELECT "Produto", "Custo Médio" FROM (
    SELECT trim("Material") AS "Produto", CAST("Custo Médio" AS DECIMAL(20,8)) AS "Custo Médio",
           ROW_NUMBER() OVER (PARTITION BY trim("Material")
                              ORDER BY TRY_CAST(TRY_CAST("Ano" AS DOUBLE) AS INTEGER) DESC NULLS LAST,
                                       "Mes" DESC NULLS LAST,
                                       "Custo Médio" DESC NULLS LAST) AS rn
    FROM costs WHERE "Material" IS NOT NULL)
  WHERE rn = 1
)"""

VALUED = """
items AS (
  SELECT trim("Produto") AS code, "Descr. Produto" AS descr,
         CAST(COALESCE(SUM(CAST("Estoqueada" AS DECIMAL(18,3))), 0) AS DECIMAL(18,3)) AS qty,
         COUNT(DISTINCT "Locação") AS nloc
  FROM stock WHERE "Produto" IS NOT NULL AND "Descr. Produto" IS NOT NULL
  GROUP BY 1, 2
),
valued AS (
  SELECT code AS "Código", descr AS "Descrição", nloc AS "Qtde_Locacao", qty AS "Lógica_ABC",
         COALESCE(lc."Custo Médio", CAST(0 AS DECIMAL(20,8))) AS "Custo_Unitário",
         COALESCE(CAST(round_even(CAST(lc."Custo Médio" AS DECIMAL(38,8)) * CAST(qty AS DECIMAL(38,3)), 2)
                       AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2))) AS "Valor_Estoque"
  FROM items LEFT JOIN latest_cost lc ON lc."Produto" = items.code
)"""

CURVE = """
ranked AS (
  SELECT *, SUM("Valor_Estoque") OVER (ORDER BY "Valor_Estoque" DESC, "Código", "Descrição"
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
            SUM("Valor_Estoque") OVER () AS total
  FROM valued
),
curve AS (
  SELECT "Código", "Descrição", "Qtde_Locacao", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque",
         CASE WHEN total > 0 THEN CAST("Valor_Estoque" AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0.0 END
           AS "Pct_Individual",
         CASE WHEN total > 0 THEN CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0.0 END AS "Pct_Acumulada",
         CASE WHEN NOT (total > 0) THEN 'A'
              WHEN cum <= total * CAST(0.80 AS DECIMAL(10,4)) THEN 'A'
              WHEN cum <= total * CAST(0.95 AS DECIMAL(10,4)) THEN 'B'
              ELSE 'C' END AS "Curva_ABC"
  FROM ranked
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ABC_BASE = with_(STOCK, COSTS, LATEST_COST, VALUED, CURVE)

ORACLE: dict[str, str] = {
    "abc_curve": ABC_BASE + "\nSELECT * FROM curve",
    "abc_class_summary": ABC_BASE
    + """
, per AS (
  SELECT "Curva_ABC", COUNT(*) AS n_items, CAST(SUM("Lógica_ABC") AS DECIMAL(18,3)) AS total_qty,
         CAST(SUM("Valor_Estoque") AS DECIMAL(18,2)) AS total_value
  FROM curve GROUP BY 1)
SELECT "Curva_ABC", n_items, total_qty, total_value,
       CASE WHEN SUM(total_value) OVER () > 0
            THEN CAST(total_value AS DOUBLE) / CAST(SUM(total_value) OVER () AS DOUBLE) ELSE 0.0 END
         AS value_share
FROM per""",
    "latest_cost": with_(COSTS, LATEST_COST) + "\nSELECT * FROM latest_cost",
    "stock_valued": with_(STOCK, COSTS, LATEST_COST, VALUED) + "\nSELECT * FROM valued",
}

# --------------------------------------------------------------------------- counts


def counts_raw() -> str:
    return """
counts_raw AS (
  SELECT CASE WHEN l_orderkey % 41 = 1 THEN 'X' WHEN l_orderkey % 41 = 2 THEN '' END AS "NOK",
         CASE WHEN l_linestatus = 'F' THEN 'FECHADO' ELSE 'ABERTO' END AS "Status",
         CAST(l_partkey AS VARCHAR) AS "Código",
         CAST(l_suppkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS "Locação",
         CAST(l_orderkey + 340123450000000000 AS VARCHAR) AS "UdE",
         CASE WHEN l_orderkey % 53 = 3 THEN 'NaN' ELSE CAST(l_linenumber AS VARCHAR) END AS "Compartimento",
         CASE l_returnflag WHEN 'A' THEN 'ANULADO' WHEN 'R' THEN 'FECHADO' ELSE 'PENDENTE' END
           AS "Status Inventario",
         strftime(l_shipdate, '%-d/%-m/%Y %-H:%M') AS "Atualização",
         CAST(CAST(ROUND(l_tax * 100) AS INTEGER) AS VARCHAR) AS "Contagem",
         CASE WHEN l_discount = 0 THEN NULL
              ELSE CAST(CAST(l_quantity * (1 - l_discount) AS DECIMAL(18,2)) AS VARCHAR) END AS "Física",
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "Quantidade Fisica",
         replace(format('{:,}', unit // 10000), ',', '.') || ',' || lpad(CAST(unit % 10000 AS VARCHAR), 4, '0')
           AS "Custo",
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS "Lógica"
  FROM (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) * 100 // CAST(l_quantity AS BIGINT) AS unit
        FROM lineitem)
)"""


COUNTS_TYPED = r"""
closed AS (
  SELECT * FROM counts_raw
  WHERE "Código" IS NOT NULL AND "Locação" IS NOT NULL AND "UdE" IS NOT NULL
    AND ("NOK" IS NULL OR "NOK" = '') AND "Status" = 'FECHADO'
),
typed AS (
  SELECT right('0000000000000' || "Código", 13) AS "Código",
         "Locação", split_part("Locação", '.', 1) AS "Estante",
         TRY_CAST(trim("UdE") AS DECIMAL(38,0)) AS "UdE",
         TRY_CAST(trim("Compartimento") AS DECIMAL(38,0)) AS "Compartimento",
         "Status Inventario",
         try_strptime(trim("Atualização"), '%d/%m/%Y %H:%M') AS ts,
         CAST(trunc(TRY_CAST(trim("Contagem") AS DOUBLE)) AS INTEGER) AS "Contagem",
         TRY_CAST(trim("Física") AS DECIMAL(18,3)) AS "Física",
         TRY_CAST(trim("Quantidade Fisica") AS DECIMAL(18,3)) AS "Quantidade Fisica",
         TRY_CAST(trim("Lógica") AS DECIMAL(18,3)) AS "Lógica",
         TRY_CAST(replace(replace(trim("Custo"), '.', ''), ',', '.') AS DECIMAL(20,8)) AS "Custo"
  FROM closed
),
typed2 AS (
  SELECT *, CAST(ts AS DATE) AS "Data INV", CAST(year(ts) AS INTEGER) AS "Ano",
         CAST(month(ts) AS INTEGER) AS "Mês"
  FROM typed
),
last_counts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY "Data INV", "Código", "Locação", "UdE", "Compartimento", "Status Inventario"
      ORDER BY "Contagem" DESC NULLS LAST, ts DESC NULLS LAST, "Física" DESC NULLS LAST,
               "Quantidade Fisica" DESC NULLS LAST, "Lógica" DESC NULLS LAST, "Custo" DESC NULLS LAST,
               "Estante" DESC NULLS LAST, "Ano" DESC NULLS LAST, "Mês" DESC NULLS LAST) AS rn
    FROM typed2
    WHERE "Data INV" IS NOT NULL AND "Código" IS NOT NULL AND "Locação" IS NOT NULL AND "UdE" IS NOT NULL
      AND "Compartimento" IS NOT NULL AND "Status Inventario" IS NOT NULL)
  WHERE rn = 1
),
valued_counts AS (
  SELECT "Código", "Data INV", "Ano", "Mês", "Locação", "Status Inventario",
         CASE "Status Inventario" WHEN 'ANULADO' THEN 'Custo Evitado'
              WHEN 'FECHADO' THEN 'Valor Consultivado' ELSE '-' END AS "Status Controle",
         "Lógica", qf AS "Quantidade Fisica",
         CAST(round_even("Custo", 2) AS DECIMAL(18,2)) AS "Custo",
         CAST(round_even(book, 2) AS DECIMAL(18,2)) AS "Valor Logica",
         CAST(round_even(counted, 2) AS DECIMAL(18,2)) AS "Valor Fisico",
         CAST(round_even(counted - book, 2) AS DECIMAL(18,2)) AS "Vlr Delta",
         CAST(round_even(abs(counted - book), 2) AS DECIMAL(18,2)) AS "Delta ABS"
  FROM (SELECT *, COALESCE("Física", "Quantidade Fisica") AS qf,
               CAST("Custo" AS DECIMAL(38,8)) * CAST("Lógica" AS DECIMAL(38,3)) AS book,
               CAST("Custo" AS DECIMAL(38,8)) * CAST(COALESCE("Física", "Quantidade Fisica") AS DECIMAL(38,3))
                 AS counted
        FROM last_counts)
),
counts_daily AS (
  SELECT "Código", "Data INV", "Ano", "Mês",
         CAST(COALESCE(SUM("Lógica"), 0) AS DECIMAL(18,3)) AS "Lógica",
         CAST(COALESCE(SUM("Quantidade Fisica"), 0) AS DECIMAL(18,3)) AS "Quantidade Fisica",
         CAST(COALESCE(SUM("Valor Logica"), 0) AS DECIMAL(18,2)) AS "Valor Logica",
         CAST(COALESCE(SUM("Valor Fisico"), 0) AS DECIMAL(18,2)) AS "Valor Fisico",
         CAST(COALESCE(SUM("Vlr Delta"), 0) AS DECIMAL(18,2)) AS "Vlr Delta",
         CAST(COALESCE(SUM("Delta ABS"), 0) AS DECIMAL(18,2)) AS "Delta ABS"
  FROM valued_counts GROUP BY 1, 2, 3, 4
)"""

COUNTS_BASE = with_(counts_raw(), COUNTS_TYPED)

ORACLE.update(
    {
        "counts_last": COUNTS_BASE
        + """
SELECT "Data INV", "Código", "Locação", CAST("UdE" AS VARCHAR) AS "UdE",
       CAST("Compartimento" AS VARCHAR) AS "Compartimento", "Status Inventario", "Contagem",
       strftime(ts, '%Y-%m-%d %H:%M') AS "Atualização", "Física", "Quantidade Fisica", "Lógica", "Custo",
       "Estante", "Ano", "Mês"
FROM last_counts""",
        "counts_valued": COUNTS_BASE + "\nSELECT * FROM valued_counts",
        "counts_daily": COUNTS_BASE + "\nSELECT * FROM counts_daily",
        "delta_summary": COUNTS_BASE
        + """
SELECT "Ano", "Mês", "Status Controle", COUNT(*) AS n_counts,
       CAST(COALESCE(SUM(CASE WHEN "Vlr Delta" > 0 THEN "Vlr Delta" END), 0) AS DECIMAL(18,2)) AS positive_delta,
       CAST(COALESCE(SUM(CASE WHEN "Vlr Delta" < 0 THEN "Vlr Delta" END), 0) AS DECIMAL(18,2)) AS negative_delta,
       CAST(COALESCE(SUM("Vlr Delta"), 0) AS DECIMAL(18,2)) AS net_delta,
       CAST(COALESCE(SUM("Delta ABS"), 0) AS DECIMAL(18,2)) AS abs_delta,
       CAST(round_even(CAST(COALESCE(SUM("Delta ABS"), 0) AS DECIMAL(38,2)) * CAST(0.18 AS DECIMAL(6,4)), 2)
            AS DECIMAL(18,2)) AS tax
FROM valued_counts GROUP BY 1, 2, 3""",
    }
)

# --------------------------------------------------------------------------- movements

DEMO_TYPES = ["AF", "AO", "NF", "NO", "RF", "RO"]  # the types present in the driver data


def std_code(x: str) -> str:
    inner = f"regexp_replace(trim({x}), '^0+', '')"
    return f"CASE WHEN {inner} = '' THEN '0' ELSE {inner} END"


def mov_rows() -> str:
    return f"""
mov_src AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS "Ano", CAST(month(l_shipdate) AS INTEGER) AS "Mes",
         lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS "CD_ARTICOLO",
         l_returnflag || l_linestatus AS "Tipo_Movimento",
         CAST(1.0 AS DOUBLE) AS "Qtd_Movimentos", l_quantity AS "Total_Qtde"
  FROM lineitem
),
mov_dedup AS (
  SELECT DISTINCT "Ano", "Mes", {std_code('"CD_ARTICOLO"')} AS "Código", "Tipo_Movimento",
         "Qtd_Movimentos", "Total_Qtde"
  FROM mov_src
),
mov_rows AS (
  SELECT CAST(trunc(COALESCE(TRY_CAST(CAST("Ano" AS VARCHAR) AS DOUBLE), 0)) AS INTEGER) AS "Ano",
         CAST(trunc(COALESCE(TRY_CAST(CAST("Mes" AS VARCHAR) AS DOUBLE), 0)) AS INTEGER) AS "Mês",
         "Código", "Tipo_Movimento",
         COALESCE(TRY_CAST(CAST("Qtd_Movimentos" AS VARCHAR) AS DECIMAL(18,3)), 0) AS "Qtd_Movimentos",
         COALESCE(TRY_CAST(CAST("Total_Qtde" AS VARCHAR) AS DECIMAL(18,3)), 0) AS "Total_Qtde"
  FROM mov_dedup WHERE "Código" IS NOT NULL AND "Tipo_Movimento" IS NOT NULL
)"""


def _pivot_cols(types) -> str:
    a = [
        f'CAST(COALESCE(SUM(CASE WHEN "Tipo_Movimento" = \'{t}\' THEN "Total_Qtde" END), 0) AS DECIMAL(18,3))'
        f' AS "{t}_Total_Qtde_Mensal"'
        for t in types
    ]
    b = [
        f'CAST(COALESCE(SUM(CASE WHEN "Tipo_Movimento" = \'{t}\' THEN "Qtd_Movimentos" END), 0) AS DECIMAL(18,3))'
        f' AS "{t}_Qtd_Movimentos_Mensal"'
        for t in types
    ]
    return ",\n         ".join(a + b)


MOV_TOTALS = """
         CAST(SUM("Total_Qtde") AS DECIMAL(18,3)) AS "Total_Geral_Qtde_Mensal",
         CAST(SUM("Qtd_Movimentos") AS DECIMAL(18,3)) AS "Total_Geral_Qtd_Movimentos_Mensal",
         CAST(COUNT(DISTINCT "Tipo_Movimento") AS BIGINT) AS "Num_Tipos_Mov_Mensal" """


def mov_features() -> str:
    return mov_rows() + f""",
mov_features AS (
  SELECT "Código", "Ano", "Mês",
         {_pivot_cols(DEMO_TYPES)},
         {MOV_TOTALS}
  FROM mov_rows GROUP BY 1, 2, 3
)"""


ORACLE.update(
    {
        "movement_by_type": "WITH "
        + mov_rows()
        + """
SELECT "Código", "Ano", "Mês", "Tipo_Movimento",
       CAST(SUM("Total_Qtde") AS DECIMAL(18,3)) AS "Total_Qtde_Mov",
       CAST(SUM("Qtd_Movimentos") AS DECIMAL(18,3)) AS "Qtd_Mov_Count"
FROM mov_rows GROUP BY 1, 2, 3, 4""",
        "movement_totals": "WITH "
        + mov_rows()
        + f"""
SELECT "Código", "Ano", "Mês", {MOV_TOTALS} FROM mov_rows GROUP BY 1, 2, 3""",
        "movement_pivot": "WITH " + mov_features() + "\nSELECT * FROM mov_features",
    }
)

# --------------------------------------------------------------------------- categories / features

ABC_ITEMS = f"""
abc_items AS (
  SELECT code AS "Código", CAST(SUM("Lógica_ABC") AS DECIMAL(18,3)) AS "Lógica_ABC",
         MAX("Custo_Unitário") AS "Custo_Unitário", CAST(SUM("Valor_Estoque") AS DECIMAL(18,2)) AS "Valor_Estoque",
         CAST(SUM("Qtde_Locacao") AS BIGINT) AS "Qtde_Locacao",
         first("Curva_ABC" ORDER BY "Valor_Estoque" DESC, "Curva_ABC" ASC) AS "Curva_ABC"
  FROM (SELECT *, {std_code('"Código"')} AS code FROM curve) GROUP BY code
)"""


def history(since: str | None = None) -> str:
    """With ``since``: only items whose latest count or movement isn't older count as such."""
    counted, moved = "daily_std", "mov_rows"
    if since:
        counted = f"""(SELECT "Código" FROM daily_std GROUP BY 1 HAVING max("Data INV") >= DATE '{since}')"""
        moved = f"""(SELECT "Código" FROM mov_rows GROUP BY 1 HAVING max(make_date("Ano", "Mês", 1)) >= DATE '{since}')"""
    return (
        with_(STOCK, COSTS, LATEST_COST, VALUED, CURVE, ABC_ITEMS, counts_raw(), COUNTS_TYPED)
        + ", "
        + mov_features()
        + f""",
daily_std AS (SELECT * REPLACE ({std_code('"Código"')} AS "Código") FROM counts_daily),
counted_codes AS (SELECT DISTINCT "Código" FROM {counted}),
moved_codes AS (SELECT DISTINCT "Código" FROM {moved}),
hist_codes AS (SELECT "Código" FROM counted_codes UNION SELECT "Código" FROM moved_codes),
with_hist AS (SELECT DISTINCT "Código" FROM abc_items WHERE "Código" IN (SELECT "Código" FROM hist_codes)),
without_hist AS (
  SELECT DISTINCT "Código" FROM abc_items WHERE "Código" NOT IN (SELECT "Código" FROM hist_codes))"""
    )


RECENT = history("2001-09-01")
FULL = history()

FEATURE_BASE = """,
base AS (
  SELECT d.*, COALESCE(a."Curva_ABC", 'Unknown') AS "Curva_ABC",
         COALESCE(a."Lógica_ABC", CAST(0 AS DECIMAL(18,3))) AS "Lógica_ABC",
         COALESCE(a."Custo_Unitário", CAST(0 AS DECIMAL(20,8))) AS "Custo_Unitário",
         COALESCE(a."Valor_Estoque", CAST(0 AS DECIMAL(18,2))) AS "Valor_Estoque"
  FROM daily_std d LEFT JOIN abc_items a ON a."Código" = d."Código"
  WHERE d."Código" IN (SELECT "Código" FROM with_hist)
),
tf AS (
  SELECT *,
    COALESCE(CASE WHEN isfinite(pct * 100.0) THEN pct * 100.0 END, 0.0) AS "Tendencia_Anual",
    COALESCE(CASE WHEN n3 > 0 THEN CAST(s3 AS DOUBLE) / CAST(n3 AS DOUBLE) END, 0.0) AS "Media_Movel_3M",
    COALESCE(CASE WHEN n6 > 0 THEN CAST(s6 AS DOUBLE) / CAST(n6 AS DOUBLE) END, 0.0) AS "Media_Movel_6M"
  FROM (
    SELECT *,
      CASE WHEN prev12 IS NULL OR prev12 = 0 THEN NULL
           ELSE CAST("Quantidade Fisica" AS DOUBLE) / CAST(prev12 AS DOUBLE) - 1.0 END AS pct
    FROM (
      SELECT *,
        lag("Quantidade Fisica", 12) OVER w AS prev12,
        SUM("Quantidade Fisica") OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS s3,
        COUNT("Quantidade Fisica") OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS n3,
        SUM("Quantidade Fisica") OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS s6,
        COUNT("Quantidade Fisica") OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS n6
      FROM base
      WINDOW w AS (PARTITION BY "Código" ORDER BY make_date("Ano", "Mês", 1), "Data INV",
                   "Quantidade Fisica", "Lógica")))
),
cls_m AS (
  SELECT "Curva_ABC", COUNT("Quantidade Fisica") AS n, SUM("Quantidade Fisica") AS s,
         SUM("Quantidade Fisica" * "Quantidade Fisica") AS s2
  FROM tf GROUP BY 1
),
cls AS (
  SELECT "Curva_ABC",
    COALESCE(CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / CAST(n AS DOUBLE) END,
             CASE WHEN gn > 0 THEN CAST(gs AS DOUBLE) / CAST(gn AS DOUBLE) END) AS "Media_ABC",
    COALESCE(CASE WHEN n > 1 THEN sqrt(CAST(CAST((n * s2 - s * s) * 1000000 AS DECIMAL(38,0)) AS DOUBLE)
                                     / CAST(n * (n - 1) AS DOUBLE) / 1000000.0) END,
             CASE WHEN gn > 1 THEN sqrt(CAST(CAST((gn * gs2 - gs * gs) * 1000000 AS DECIMAL(38,0)) AS DOUBLE)
                                     / CAST(gn * (gn - 1) AS DOUBLE) / 1000000.0) END) AS "Desvio_ABC"
  FROM (SELECT *, SUM(n) OVER () AS gn, SUM(s) OVER () AS gs, SUM(s2) OVER () AS gs2 FROM cls_m)
)"""

MOV_COLS = ", ".join(
    [f'COALESCE(m."{t}_Total_Qtde_Mensal", 0) AS "{t}_Total_Qtde_Mensal"' for t in DEMO_TYPES]
    + [f'COALESCE(m."{t}_Qtd_Movimentos_Mensal", 0) AS "{t}_Qtd_Movimentos_Mensal"' for t in DEMO_TYPES]
    + [
        f'COALESCE(m."{c}", 0) AS "{c}"'
        for c in ["Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal", "Num_Tipos_Mov_Mensal"]
    ]
)

FEATURES = (
    FULL
    + FEATURE_BASE
    + f""",
features AS (
  SELECT tf."Código", tf."Data INV", tf."Ano", tf."Mês", tf."Lógica", tf."Quantidade Fisica",
         tf."Valor Logica", tf."Valor Fisico", tf."Vlr Delta", tf."Delta ABS",
         tf."Curva_ABC", tf."Lógica_ABC", tf."Custo_Unitário", tf."Valor_Estoque",
         tf."Tendencia_Anual", tf."Media_Movel_3M", tf."Media_Movel_6M",
         COALESCE(cls."Media_ABC", 0.0) AS "Media_ABC", COALESCE(cls."Desvio_ABC", 0.0) AS "Desvio_ABC",
         {MOV_COLS}
  FROM tf LEFT JOIN cls ON cls."Curva_ABC" = tf."Curva_ABC"
  LEFT JOIN mov_features m ON m."Código" = tf."Código" AND m."Ano" = tf."Ano" AND m."Mês" = tf."Mês"
)"""
)

ORACLE.update(
    {
        "items_with_history": RECENT + "\nSELECT * FROM with_hist",
        "items_without_history": RECENT + "\nSELECT * FROM without_hist",
        "item_category": RECENT
        + """
SELECT "Código", "Curva_ABC", "Lógica_ABC",
       CASE WHEN "Código" IN (SELECT "Código" FROM counted_codes) THEN 'Já Inventariado'
            ELSE 'Nunca Inventariado' END AS "Inventario",
       CASE WHEN "Código" IN (SELECT "Código" FROM moved_codes) THEN 'Movimentação Recente'
            ELSE 'Sem Movimentação' END AS "Movimentacao"
FROM abc_items WHERE "Lógica_ABC" > 0""",
        "trend_12": FULL
        + FEATURE_BASE
        + '\nSELECT "Código", "Data INV", "Quantidade Fisica", "Tendencia_Anual" FROM tf',
        "moving_averages": FULL
        + FEATURE_BASE
        + '\nSELECT "Código", "Data INV", "Quantidade Fisica", "Media_Movel_3M", "Media_Movel_6M" FROM tf',
        "class_stats": FULL + FEATURE_BASE + "\nSELECT * FROM cls",
        "features": FEATURES + "\nSELECT * FROM features",
    }
)

# --------------------------------------------------------------------------- planning / forecasting

MODEL_NAMES = ["GBT Depthwise", "GBT Subsampled", "Linear Regression", "Ridge", "Lasso", "Decision Tree"]
MODELS_VALUES = ", ".join(f"('{m}', {i})" for i, m in enumerate(MODEL_NAMES))

CAPACITY = """,
cap_ym AS (
  SELECT year("Data INV") AS y, month("Data INV") AS "Mês", SUM(COALESCE("Lógica", 0)) AS s
  FROM daily_std WHERE "Data INV" IS NOT NULL GROUP BY 1, 2
),
cap_m AS (SELECT "Mês", SUM(s) AS ss, COUNT(*) AS ny FROM cap_ym GROUP BY 1),
capacity AS (
  SELECT CAST(r.m AS INTEGER) AS "Mês",
         COALESCE(CAST(ss AS DOUBLE) / CAST(ny AS DOUBLE), 0.0) AS "Media_Logica",
         CAST(trunc(COALESCE(CAST(ss AS DOUBLE) / CAST(ny AS DOUBLE), 0.0) * 0.9) AS BIGINT) AS "Capacidade"
  FROM range(1, 13) r(m) LEFT JOIN cap_m ON cap_m."Mês" = r.m
)"""

ITEMS_TO_COUNT = """,
items_to_count AS (
  SELECT "Código", COALESCE("Curva_ABC", 'Unknown') AS "Curva_ABC",
         COALESCE("Valor_Estoque", CAST(0 AS DECIMAL(18,2))) AS "Valor_Estoque", "Lógica_ABC",
         CAST(CASE COALESCE("Curva_ABC", 'Unknown') WHEN 'A' THEN 3 WHEN 'B' THEN 2 WHEN 'C' THEN 1 ELSE 0 END
              AS INTEGER) AS "Prioridade_Curva",
         CAST(round_even("Lógica_ABC", 0) AS BIGINT) AS "Qtd_Int"
  FROM abc_items
  WHERE "Lógica_ABC" > 0
    AND "Código" NOT IN (SELECT "Código" FROM daily_std WHERE year("Data INV") = 2001)
)"""

# Each item, in priority order, goes to the first of the 24 planning months with room for it.
ALLOCATION = """,
rooms AS (
  SELECT list(c."Capacidade" ORDER BY k) AS rooms
  FROM range(24) r(k) JOIN capacity c ON c."Mês" = k % 12 + 1
),
queue AS (
  SELECT "Código", "Qtd_Int",
         row_number() OVER (ORDER BY "Prioridade_Curva" DESC, "Valor_Estoque" DESC, "Código") AS rn
  FROM items_to_count
),
fit AS (
  SELECT 0::BIGINT AS rn, NULL::VARCHAR AS "Código", NULL::BIGINT AS q, NULL::INTEGER AS slot, rooms FROM rooms
  UNION ALL
  SELECT rn, "Código", q, slot,
         CASE WHEN slot IS NULL THEN rooms
              ELSE list_concat(rooms[:slot - 1], [rooms[slot] - q], rooms[slot + 1:]) END
  FROM (SELECT o.rn, o."Código", o."Qtd_Int" AS q, f.rooms,
               nullif(list_position([x >= o."Qtd_Int" FOR x IN f.rooms], true), 0)::INTEGER AS slot
        FROM fit f JOIN queue o ON o.rn = f.rn + 1)
),
allocation AS (
  SELECT "Código", (2001 + (slot - 1) // 12)::INTEGER AS "Ano_Previsto", ((slot - 1) % 12 + 1)::INTEGER AS "Mês_Previsto",
         q AS "Qtd_Int", slot
  FROM fit WHERE slot IS NOT NULL
)"""

LAST_ROW = """,
last_row AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY "Código" ORDER BY "Ano" DESC, "Mês" DESC, "Data INV" DESC,
                                 "Quantidade Fisica" DESC, "Lógica" DESC) AS rn
    FROM features) WHERE rn = 1
)"""

FALLBACK = f""",
fallback AS (
  SELECT a."Código", mn.name AS "Model_Name", CAST(a."Lógica_ABC" AS DOUBLE) AS "Previsao_Quantidade"
  FROM abc_items a, (VALUES {MODELS_VALUES}) mn(name, ord)
  WHERE a."Lógica_ABC" > 0 AND a."Código" IN (SELECT "Código" FROM without_hist)
),
fc_info AS (
  SELECT f.*, COALESCE(a."Curva_ABC", 'Unknown') AS "Curva_ABC",
         COALESCE(a."Lógica_ABC", CAST(0 AS DECIMAL(18,3))) AS "Lógica_ABC",
         COALESCE(a."Custo_Unitário", CAST(0 AS DECIMAL(20,8))) AS "Custo_Unitário",
         COALESCE(a."Valor_Estoque", CAST(0 AS DECIMAL(18,2))) AS "Valor_Estoque"
  FROM fallback f LEFT JOIN abc_items a ON a."Código" = f."Código"
),
valuation AS (
  SELECT "Código", "Model_Name", "Curva_ABC", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque",
         q AS "Previsao_Quantidade",
         CAST(round_even(v, 2) AS DECIMAL(18,2)) AS "Valor Fisico Previsto",
         CAST(round_even(v - "Valor_Estoque", 2) AS DECIMAL(18,2)) AS "Vlr Delta Previsto",
         CAST(round_even(abs(v - "Valor_Estoque"), 2) AS DECIMAL(18,2)) AS "Delta ABS Previsto",
         CAST(round_even(abs(v - "Valor_Estoque") * CAST(0.18 AS DECIMAL(6,4)), 2) AS DECIMAL(18,2))
           AS "TOTAL IMPOSTO Previsto"
  FROM (SELECT *, CAST("Custo_Unitário" AS DECIMAL(38,8)) * CAST(q AS DECIMAL(38,3)) AS v
        FROM (SELECT *, CAST(COALESCE(greatest(0.0, "Previsao_Quantidade"), 0.0) AS DECIMAL(18,3)) AS q
              FROM fc_info))
)"""

ORACLE.update(
    {
        "capacity_by_month": FULL + CAPACITY + "\nSELECT * FROM capacity",
        "items_to_count": FULL + ITEMS_TO_COUNT + "\nSELECT * FROM items_to_count",
        "allocation": FULL.replace("WITH ", "WITH RECURSIVE ", 1)
        + CAPACITY
        + ITEMS_TO_COUNT
        + ALLOCATION
        + '\nSELECT "Código", "Ano_Previsto", "Mês_Previsto", "Qtd_Int" FROM allocation',
        "plan_summary": FULL.replace("WITH ", "WITH RECURSIVE ", 1)
        + CAPACITY
        + ITEMS_TO_COUNT
        + ALLOCATION
        + """
SELECT (2001 + k // 12)::INTEGER AS "Ano", (k % 12 + 1)::INTEGER AS "Mês",
       COUNT(a."Código") AS "Itens_Alocados", COALESCE(SUM(a."Qtd_Int"), 0)::BIGINT AS "Pecas_Logica_Alocada",
       ANY_VALUE(c."Capacidade") AS "Capacidade_Pecas_Logica"
FROM range(24) r(k) JOIN capacity c ON c."Mês" = k % 12 + 1 LEFT JOIN allocation a ON a.slot = k + 1
WHERE k < (SELECT CASE WHEN COUNT(*) = 0 THEN 0 WHEN COUNT(*) > (SELECT COUNT(*) FROM allocation) THEN 24
                  ELSE (SELECT MAX(slot) FROM allocation) END FROM items_to_count)
GROUP BY k""",
        "last_feature_row": FEATURES + LAST_ROW + "\nSELECT * FROM last_row",
        "fallback_forecast": RECENT + FALLBACK + "\nSELECT * FROM fallback",
        "forecast_valuation": RECENT + FALLBACK + "\nSELECT * FROM valuation",
    }
)

# --------------------------------------------------------------------------- validation

YTD = (
    with_(counts_raw())
    + f""",
fc_src AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "Código", CAST(year(l_shipdate) AS INTEGER) AS "Ano_Previsto",
         CAST(month(l_shipdate) AS INTEGER) AS "Mês_Previsto",
         CAST(l_quantity AS DECIMAL(18,3)) AS q,
         CAST(CAST(l_quantity * (1 - l_tax) AS DECIMAL(18,2)) AS DECIMAL(18,3)) AS qa
  FROM lineitem
),
forecasts AS (
  SELECT 'Logica' AS "Model_Name", "Código", "Ano_Previsto", "Mês_Previsto", q AS "Previsao_Quantidade" FROM fc_src
  UNION ALL
  SELECT 'Ajustado', "Código", "Ano_Previsto", "Mês_Previsto", qa FROM fc_src
),
raw_ts AS (
  SELECT *, try_strptime(trim("Atualização"), '%d/%m/%Y %H:%M') AS ts FROM counts_raw
),
latest AS (SELECT year(max(ts)) AS y, month(max(ts)) AS m FROM raw_ts),
actual AS (
  SELECT {std_code('"Código"')} AS "Código",
         CAST(SUM(COALESCE(TRY_CAST(trim("Quantidade Fisica") AS DECIMAL(18,3)), 0)) AS DECIMAL(18,3)) AS "Real_YTD"
  FROM raw_ts, latest
  WHERE "Código" IS NOT NULL AND "Atualização" IS NOT NULL AND "Quantidade Fisica" IS NOT NULL
    AND ts IS NOT NULL AND year(ts) = latest.y AND month(ts) <= latest.m
  GROUP BY 1
),
prev AS (
  SELECT "Model_Name", "Código", CAST(SUM(p) AS DECIMAL(18,3)) AS "Prev_YTD"
  FROM (SELECT CAST("Model_Name" AS VARCHAR) AS "Model_Name", {std_code('"Código"')} AS "Código",
               CAST(trunc(COALESCE(TRY_CAST(CAST("Ano_Previsto" AS VARCHAR) AS DOUBLE), -1)) AS INTEGER) AS fy,
               CAST(trunc(COALESCE(TRY_CAST(CAST("Mês_Previsto" AS VARCHAR) AS DOUBLE), -1)) AS INTEGER) AS fm,
               COALESCE(TRY_CAST(CAST("Previsao_Quantidade" AS VARCHAR) AS DECIMAL(18,3)), 0) AS p
        FROM forecasts), latest
  WHERE fy = latest.y AND fm <= latest.m
  GROUP BY 1, 2
),
models AS (SELECT DISTINCT "Model_Name" FROM forecasts WHERE "Model_Name" IS NOT NULL),
detail AS (
  SELECT "Model_Name", "Código", "Real_YTD", p AS "Prev_YTD",
         CAST(p - "Real_YTD" AS DECIMAL(18,3)) AS "Erro",
         CAST(abs(p - "Real_YTD") AS DECIMAL(18,3)) AS "Erro_Abs",
         CASE WHEN "Real_YTD" > 0
              THEN CAST(abs(p - "Real_YTD") AS DOUBLE) / CAST("Real_YTD" AS DOUBLE) * 100.0 END AS "APE"
  FROM (SELECT a."Código", a."Real_YTD", mo."Model_Name",
               CAST(COALESCE(pr."Prev_YTD", 0) AS DECIMAL(18,3)) AS p
        FROM actual a CROSS JOIN models mo
        LEFT JOIN prev pr ON pr."Model_Name" = mo."Model_Name" AND pr."Código" = a."Código")
),
metrics AS (
  SELECT "Model_Name",
         CAST(SUM("Erro_Abs") AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS "MAE",
         CASE WHEN SUM("Real_YTD") <> 0
              THEN CAST(SUM("Erro_Abs") AS DOUBLE) / CAST(SUM("Real_YTD") AS DOUBLE) * 100.0 END AS "WMAPE",
         round(AVG("APE"), 6) AS "MAPE",
         CAST(SUM("Real_YTD") AS DECIMAL(18,3)) AS "Total_Real",
         CAST(SUM("Prev_YTD") AS DECIMAL(18,3)) AS "Total_Previsto",
         CAST(SUM("Prev_YTD") - SUM("Real_YTD") AS DECIMAL(18,3)) AS "Diferenca_Total"
  FROM detail GROUP BY 1
)"""
)

ORACLE.update(
    {
        "ytd_detail": YTD + "\nSELECT * FROM detail",
        "ytd_metrics": YTD + "\nSELECT * FROM metrics",
        "best_model": YTD
        + """
SELECT "Model_Name", "MAE" FROM metrics WHERE "MAE" IS NOT NULL
ORDER BY "MAE", "Model_Name" LIMIT 1""",
    }
)

# --------------------------------------------------------------------------- data profile

FEATURE_NUMERIC = (
    ["Ano", "Lógica", "Valor Logica", "Tendencia_Anual", "Media_Movel_3M", "Media_Movel_6M",
     "Media_ABC", "Desvio_ABC"]
    + [f"{t}_Total_Qtde_Mensal" for t in DEMO_TYPES]
    + [f"{t}_Qtd_Movimentos_Mensal" for t in DEMO_TYPES]
    + ["Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal", "Num_Tipos_Mov_Mensal"]
)

_CONST = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, COUNT(CAST("{c}" AS DOUBLE)) AS n, MIN(CAST("{c}" AS DOUBLE)) AS lo,
       MAX(CAST("{c}" AS DOUBLE)) AS hi FROM features"""
    for c in FEATURE_NUMERIC
)

_CORR = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS feature, corr(CAST("{c}" AS DOUBLE), CAST("Quantidade Fisica" AS DOUBLE)) AS c FROM train"""
    for c in FEATURE_NUMERIC
)

ORACLE.update(
    {
        "target_profile": FEATURES
        + """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT "Quantidade Fisica") AS n_distinct,
       COUNT(*) FILTER (WHERE "Quantidade Fisica" = 0) AS n_zeros,
       CAST(SUM("Quantidade Fisica") AS DOUBLE) / CAST(COUNT("Quantidade Fisica") AS DOUBLE) AS mean,
       sqrt(CAST(CAST((COUNT("Quantidade Fisica") * SUM("Quantidade Fisica" * "Quantidade Fisica")
                        - SUM("Quantidade Fisica") * SUM("Quantidade Fisica")) * 1000000 AS DECIMAL(38,0)) AS DOUBLE)
            / CAST(COUNT("Quantidade Fisica") * (COUNT("Quantidade Fisica") - 1) AS DOUBLE) / 1000000.0) AS std,
       CAST(MIN("Quantidade Fisica") AS DECIMAL(18,3)) AS min,
       quantile_cont(CAST("Quantidade Fisica" AS DOUBLE), 0.25) AS p25,
       quantile_cont(CAST("Quantidade Fisica" AS DOUBLE), 0.5) AS p50,
       quantile_cont(CAST("Quantidade Fisica" AS DOUBLE), 0.75) AS p75,
       CAST(MAX("Quantidade Fisica") AS DECIMAL(18,3)) AS max
FROM features""",
        "constant_features": FEATURES
        + f"""
SELECT feature, n, lo AS value FROM ({_CONST}) WHERE n >= 2 AND lo = hi""",
        "feature_correlation": FEATURES
        + f""",
train AS (SELECT * FROM features WHERE "Ano" < (SELECT MAX("Ano") FROM features)),
cors AS (SELECT * FROM ({_CORR}) WHERE c IS NOT NULL AND NOT isnan(c))
SELECT feature, round(c, 6) AS corr, 'top' AS side FROM (SELECT * FROM cors ORDER BY c DESC, feature LIMIT 30)
UNION ALL
SELECT feature, round(c, 6) AS corr, 'bottom' AS side FROM (SELECT * FROM cors ORDER BY c ASC, feature LIMIT 30)""",
    }
)

# --------------------------------------------------------------------------- scalar functions

ORACLE.update(
    {
        "standardize_codes": f"""
SELECT l_orderkey, l_linenumber, raw, {std_code('raw')} AS code
FROM (SELECT l_orderkey, l_linenumber, ' ' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || ' ' AS raw FROM lineitem)""",
        "fixed_codes": """
SELECT l_orderkey, l_linenumber, raw, right('0000000000000' || raw, 13) AS fixed,
       split_part(loc, '.', 1) AS rack,
       right('0000000000000' || raw, 13) || '_' || loc || '_' || (CASE WHEN l_returnflag <> 'N' THEN l_returnflag END)
         AS key
FROM (SELECT *, CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR) AS raw,
             CAST(l_suppkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS loc
      FROM lineitem)""",
        "parse_ptbr": """
SELECT l_orderkey, l_linenumber, text,
       TRY_CAST(replace(replace(text, '.', ''), ',', '.') AS DECIMAL(18,2)) AS value
FROM (SELECT l_orderkey, l_linenumber,
             replace(format('{:,}', cents // 100), ',', '.') || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
               AS text
      FROM (SELECT *, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem))""",
        "parse_timestamps": """
SELECT o_orderkey, text, CAST(ts AS DATE) AS date, CAST(year(ts) AS INTEGER) AS year,
       CAST(month(ts) AS INTEGER) AS month, make_date(year(ts), month(ts), 1) AS month_start
FROM (SELECT o_orderkey, text, try_strptime(text, '%d/%m/%Y %H:%M') AS ts
      FROM (SELECT o_orderkey, strftime(o_orderdate, '%-d/%-m/%Y %-H:%M') AS text FROM orders))""",
    }
)

# --------------------------------------------------------------------------- J13, P18

_WIDE = ",\n       ".join(
    f"""max(CASE WHEN "Model_Name" = '{m}' THEN "{c}" END) AS "{m}_{c}\""""
    for m in ["Ajustado", "Logica"]
    for c in ["Prev_YTD", "Erro", "Erro_Abs", "APE"]
)

EXPECTED_MOV_COLS = (
    [f"{t}_Total_Qtde_Mensal" for t in [
        "Entrada na Quarentena", "Entrada no Estoque", "Movimentação Interna",
        "Movimentação com Quarentena", "Saída da Quarentena", "Saída por Venda"]]
    + [f"{t}_Qtd_Movimentos_Mensal" for t in [
        "Entrada na Quarentena", "Entrada no Estoque", "Movimentação Interna",
        "Movimentação com Quarentena", "Saída da Quarentena", "Saída por Venda"]]
    + ["Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal", "Num_Tipos_Mov_Mensal"]
)

ORACLE.update(
    {
        "ytd_detail_wide": YTD
        + f"""
SELECT "Código", "Real_YTD",
       {_WIDE}
FROM detail GROUP BY "Código", "Real_YTD\"""",
        "features_without_movements": FULL
        + FEATURE_BASE
        + """
SELECT tf."Código", tf."Data INV", tf."Ano", tf."Mês", tf."Lógica", tf."Quantidade Fisica",
       tf."Valor Logica", tf."Valor Fisico", tf."Vlr Delta", tf."Delta ABS",
       tf."Curva_ABC", tf."Lógica_ABC", tf."Custo_Unitário", tf."Valor_Estoque",
       tf."Tendencia_Anual", tf."Media_Movel_3M", tf."Media_Movel_6M",
       COALESCE(cls."Media_ABC", 0.0) AS "Media_ABC", COALESCE(cls."Desvio_ABC", 0.0) AS "Desvio_ABC",
       """
        + ", ".join(f'CAST(0.0 AS DOUBLE) AS "{c}"' for c in EXPECTED_MOV_COLS)
        + """
FROM tf LEFT JOIN cls ON cls."Curva_ABC" = tf."Curva_ABC\"""",
    }
)
