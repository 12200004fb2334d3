"""DuckDB SQL twins of the queries in ``cyclecount.plans.checks``."""

from __future__ import annotations

from cyclecount.plans import oracle as O

LINE = "lineitem"
_EXPORT = ", ".join(
    f'"{a}" AS "{b}"'
    for a, b in [
        ("Código", "Desenho"), ("Descrição", "Descrição"), ("Qtde_Locacao", "Qtde. Locação"),
        ("Lógica_ABC", "Soma de Estoqueada"), ("Custo_Unitário", "Custo Médio"),
        ("Valor_Estoque", "Soma de Valor Total"), ("Pct_Individual", "% individual"),
        ("Pct_Acumulada", "% acumulada"), ("Curva_ABC", "Curva ABC"),
    ]
)

# Two features: least squares and ridge by Cramer's rule, lasso as the best of the nine sign
# patterns of two weights.
_PRICE = """
r AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) AS k, l_quantity::DOUBLE AS a, round(l_discount * 100)::DOUBLE AS b,
             l_extendedprice / 1000.0::DOUBLE AS y FROM lineitem)"""
_CENTRED = """
c AS (SELECT *, sa / n AS ma, sb / n AS mb, sy / n AS my, saa - sa * sa / n AS aa, sbb - sb * sb / n AS bb, sab - sa * sb / n AS ab,
             say - sa * sy / n AS ay, sby - sb * sy / n AS byy FROM s)"""
_SUMS = """count(*)::DOUBLE AS n, sum(a) AS sa, sum(b) AS sb, sum(y) AS sy, sum(a * a) AS saa, sum(b * b) AS sbb, sum(a * b) AS sab,
             sum(a * y) AS say, sum(b * y) AS sby"""
_LASSO = """
signs AS (SELECT p, q FROM (SELECT unnest([-1, 0, 1]) AS p), (SELECT unnest([-1, 0, 1]) AS q)),
tries AS (
  SELECT l.*, p, q,
         CASE WHEN p = 0 THEN 0.0::DOUBLE WHEN q = 0 THEN (ay - n * alpha * p) / aa
              ELSE ((ay - n * alpha * p) * bb - (byy - n * alpha * q) * ab) / (aa * bb - ab * ab) END AS wa,
         CASE WHEN q = 0 THEN 0.0::DOUBLE WHEN p = 0 THEN (byy - n * alpha * q) / bb
              ELSE ((byy - n * alpha * q) * aa - (ay - n * alpha * p) * ab) / (aa * bb - ab * ab) END AS wb
  FROM l, signs),
cost AS (SELECT *, (wa * wa * aa + 2 * wa * wb * ab + wb * wb * bb - 2 * wa * ay - 2 * wb * byy) / (2 * n) + alpha * (abs(wa) + abs(wb)) AS cost
         FROM tries WHERE sign(wa) = p AND sign(wb) = q)"""

def _best_splits(rows: str, out: str) -> str:
    """For each node of ``rows`` (node, q, d, t, y) the split with the greatest fall of squares."""
    return f"""
u{out} AS (SELECT node, f, v, count(*)::DOUBLE AS n, sum(y) AS s FROM (
      SELECT node, 0 AS f, q AS v, y FROM {rows} UNION ALL SELECT node, 1, d, y FROM {rows} UNION ALL SELECT node, 2, t, y FROM {rows})
      GROUP BY node, f, v),
g{out} AS (SELECT *, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER p AS nn, sum(s) OVER p AS ss, lead(v) OVER w AS next
      FROM u{out} WINDOW w AS (PARTITION BY node, f ORDER BY v), p AS (PARTITION BY node, f)),
{out} AS (SELECT node, f, (v + next) / 2 AS cut FROM (
      SELECT *, row_number() OVER (PARTITION BY node ORDER BY sl * sl / nl + (ss - sl) * (ss - sl) / (nn - nl) DESC, f, v) AS k
      FROM g{out} WHERE next IS NOT NULL) WHERE k = 1)"""


_SIDE = "node || CASE WHEN CASE f WHEN 0 THEN q WHEN 1 THEN d ELSE t END <= cut THEN 'L' ELSE 'R' END"

_QUANTILES = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS feature, {p}::DOUBLE AS p, round(quantile_cont({x}, {p}), 6) AS value FROM lineitem{where}"
    for name, x, where in (
        ("l_quantity", "l_quantity::DOUBLE", ""), ("l_extendedprice", "l_extendedprice::DOUBLE", ""),
        ("gaps", "l_discount::DOUBLE", " WHERE l_linenumber NOT IN (2, 3)"), ("same", "3.0::DOUBLE", ""),
    )
    for p in (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
)
_SLOTS = "\nUNION ALL\n".join(
    f"""SELECT 'num__{c}' AS feature, corr(coalesce("{c}"::DOUBLE, 0), "Quantidade Fisica"::DOUBLE) AS c FROM train"""
    for c in O.FEATURE_NUMERIC
)

ORACLE: dict[str, str] = {
    "exact_quantiles": _QUANTILES,
    "processed_feature_correlation": O.FEATURES
    + f""",
train AS (SELECT * FROM features WHERE "Ano" < (SELECT MAX("Ano") FROM features)),
hot AS (SELECT 'cat__Curva_ABC_' || v AS feature, corr((coalesce("Curva_ABC", 'Unknown') = v)::INT, "Quantidade Fisica"::DOUBLE) AS c
        FROM train, (SELECT DISTINCT coalesce("Curva_ABC", 'Unknown') AS v FROM train) GROUP BY v),
cors AS (SELECT * FROM ({_SLOTS} UNION ALL SELECT * FROM hot) WHERE c IS NOT NULL AND NOT isnan(c))
SELECT feature, round(c, 6) AS corr, 'top' AS side FROM (SELECT * FROM cors ORDER BY c DESC, feature LIMIT 30)
UNION ALL
SELECT feature, round(c, 6) AS corr, 'bottom' AS side FROM (SELECT * FROM cors ORDER BY c ASC, feature LIMIT 30)""",
    "parsed_counts": f"""
WITH {O.counts_raw()}
SELECT count(*) AS rows, count(try_strptime("Atualização", '%d/%m/%Y %H:%M')) AS timestamps,
       count(TRY_CAST(replace(replace("Custo", '.', ''), ',', '.') AS DOUBLE)) AS costs
FROM counts_raw WHERE "Código" IS NOT NULL AND "Locação" IS NOT NULL AND "UdE" IS NOT NULL
  AND coalesce("NOK", '') = '' AND "Status" = 'FECHADO'""",
    "metrics_written": O.COUNTS_BASE
    + """,
p AS (SELECT CAST("Lógica" AS DOUBLE) AS p, CAST("Quantidade Fisica" AS DOUBLE) AS y FROM valued_counts
      WHERE "Lógica" IS NOT NULL AND "Quantidade Fisica" IS NOT NULL),
m AS (SELECT 'Logica' AS m, p, y FROM p UNION ALL SELECT 'Dobro', p * 2, y FROM p)
SELECT m AS "Modelo", round(avg(abs(p - y)), 6) AS "MAE", round(sqrt(avg((p - y) * (p - y))), 6) AS "RMSE",
       round(1.0 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 6) AS "R2",
       (row_number() OVER (ORDER BY m))::INTEGER AS place FROM m GROUP BY m""",
    "ytd_metrics_written": O.ORACLE["ytd_metrics"],
    "counts_report": f"""
WITH {O.counts_raw()},
r AS (SELECT CASE WHEN "Compartimento" IN ('1', '3', '5', '7') THEN 'first' ELSE 'other' END AS part FROM counts_raw),
f AS (SELECT part AS name, 'read' AS status, count(*) AS rows, 0 AS bad_rows FROM r GROUP BY part
      UNION ALL SELECT 'short', 'read', count(*), count(*) FROM counts_raw WHERE "Código" = '7'
      UNION ALL SELECT 'broken', 'broken', 0, 0 UNION ALL SELECT 'none', 'missing', 0, 0)
SELECT name, status, rows::BIGINT AS rows, bad_rows::BIGINT AS bad_rows, (sum(rows) OVER ())::BIGINT AS all_rows,
       (sum(rows) OVER ())::BIGINT AS all_codes FROM f""",
    "tree_columns": f"""
WITH r0 AS (SELECT '' AS node, l_quantity::DOUBLE AS q, round(l_discount * 100)::DOUBLE AS d, round(l_tax * 100)::DOUBLE AS t,
                   l_extendedprice / 1000.0::DOUBLE AS y FROM lineitem),{_best_splits("r0", "b0")},
r1 AS (SELECT {_SIDE.replace("node", "r0.node", 1)} AS node, q, d, t, y FROM r0 JOIN b0 ON r0.node = b0.node),{_best_splits("r1", "b1")},
r2 AS (SELECT {_SIDE.replace("node", "r1.node", 1)} AS node, y FROM r1 JOIN b1 ON r1.node = b1.node)
SELECT r2.node AS path, count(*) AS n, round(avg(y), 6) AS mean,
       ['l_quantity', 'discount', 'tax'][any_value(b0.f) + 1] AS root_feature, round(any_value(b0.cut), 6) AS root_threshold
FROM r2, b0 GROUP BY r2.node""",
    "linear_search": f"""
WITH {_PRICE},
m AS (SELECT list(k ORDER BY k) AS m, len(m) AS n, n // 6 AS block, n - 5 * (n // 6) AS first FROM (SELECT DISTINCT k FROM r)),
f AS (SELECT i::INTEGER AS fold, m[first + i * block] AS upto, m[least(n, first + (i + 1) * block)] AS until FROM m, range(5) x(i)),
s AS (SELECT fold, {_SUMS} FROM f JOIN r ON k <= upto GROUP BY fold),{_CENTRED},
ls AS (
  SELECT 'Linear Regression' AS model, 0 AS candidate, fold, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS wa,
         (byy * aa - ay * ab) / (aa * bb - ab * ab) AS wb, NULL AS flat, ma, mb, my FROM c
  UNION ALL
  SELECT 'Linear Regression', 1, fold, (say * sbb - sby * sab) / (saa * sbb - sab * sab),
         (sby * saa - say * sab) / (saa * sbb - sab * sab), 0.0, ma, mb, my FROM c
  UNION ALL
  SELECT 'Ridge', i, fold, (ay * (bb + p) - byy * ab) / ((aa + p) * (bb + p) - ab * ab),
         (byy * (aa + p) - ay * ab) / ((aa + p) * (bb + p) - ab * ab), NULL, ma, mb, my
  FROM c, (SELECT unnest([0, 1, 2]) AS i, unnest([1.0, 1000.0, 100000.0])::DOUBLE AS p)),
l AS (SELECT c.*, i, alpha FROM c, (SELECT unnest([0, 1, 2]) AS i, unnest([0.01, 0.5, 5.0])::DOUBLE AS alpha)),{_LASSO},
w AS (
  SELECT *, coalesce(flat, my - wa * ma - wb * mb) AS w0 FROM (
    SELECT model, candidate, fold, wa, wb, flat, ma, mb, my FROM ls
    UNION ALL
    SELECT 'Lasso', i, fold, arg_min(wa, cost), arg_min(wb, cost), NULL, any_value(ma), any_value(mb), any_value(my)
    FROM cost GROUP BY i, fold)),
e AS (SELECT model, candidate, w.fold, any_value(wa) AS wa, any_value(wb) AS wb, any_value(w0) AS w0,
             avg(abs(w0 + wa * a + wb * b - y)) AS mae
      FROM w JOIN f ON w.fold = f.fold JOIN r ON r.k > f.upto AND r.k <= f.until GROUP BY 1, 2, 3),
best AS (SELECT model, arg_min(candidate, mae) AS best FROM (SELECT model, candidate, avg(mae) AS mae FROM e GROUP BY 1, 2) GROUP BY 1)
SELECT e.model, candidate::INTEGER AS candidate, fold, round(wa, 6) + 0.0::DOUBLE AS w_quantity, round(wb, 6) + 0.0::DOUBLE AS w_discount,
       round(w0, 6) + 0.0::DOUBLE AS intercept, round(mae, 6) + 0.0::DOUBLE AS mae, candidate = best AS chosen
FROM e JOIN best ON e.model = best.model""",
    "lasso_path": f"""
WITH {_PRICE},
s AS (SELECT {_SUMS} FROM r),{_CENTRED},
l AS (SELECT c.*, alpha FROM c, (SELECT unnest([20.0, 5.0, 0.1, 0.02, 0.001])::DOUBLE AS alpha)),{_LASSO},
w AS (SELECT alpha, arg_min(wa, cost) AS wa, arg_min(wb, cost) AS wb FROM cost GROUP BY alpha)
SELECT alpha, 'l_quantity' AS feature, round(wa, 6) + 0.0::DOUBLE AS weight, round((ay - aa * wa - ab * wb) / n, 6) + 0.0::DOUBLE AS covariance, true AS optimal FROM w, c
UNION ALL
SELECT alpha, 'pct', round(wb, 6) + 0.0::DOUBLE, round((byy - ab * wa - bb * wb) / n, 6) + 0.0::DOUBLE, true FROM w, c""",
    "abc_from_files": O.ABC_BASE + f"\nSELECT {_EXPORT} FROM curve",
    "counts_from_files": O.COUNTS_BASE + "\nSELECT * FROM counts_daily",
    "newest_count_month": "SELECT CAST(year(max(l_shipdate)) AS INTEGER) AS year, CAST(month(max(l_shipdate)) AS INTEGER) AS month FROM lineitem",
    "movements_from_files": O.ORACLE["movement_totals"],
    "ytd_from_files": O.ORACLE["ytd_detail"],
    "category_written": O.ORACLE["item_category"],
    "counts_without_cancelled": O.COUNTS_BASE
    + """\nSELECT * FROM valued_counts WHERE "Status Inventario" <> 'ANULADO'""",
    "class_stats_single": """
WITH r AS (
  SELECT CASE WHEN l_orderkey = 1 AND l_linenumber = 3 THEN 'Z' ELSE l_returnflag END AS c,
         CAST(l_quantity AS BIGINT)::HUGEINT AS q FROM lineitem),
g AS (SELECT c, count(*) AS n, sum(q) AS s, sum(q * q) AS s2 FROM r GROUP BY 1),
a AS (SELECT *, sum(n) OVER () AS gn, sum(s) OVER () AS gs, sum(s2) OVER () AS gs2 FROM g)
SELECT c AS "Curva_ABC", CAST(s AS DOUBLE) / CAST(n AS DOUBLE) AS "Media_ABC",
       CASE WHEN n > 1 THEN sqrt(CAST((n * s2 - s * s) * 1000000 AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1)) / 1000000.0)
            ELSE sqrt(CAST((gn * gs2 - gs * gs) * 1000000 AS DOUBLE) / (CAST(gn AS DOUBLE) * CAST(gn - 1 AS DOUBLE)) / 1000000.0) END
         AS "Desvio_ABC"
FROM a""",
    "constant_columns": "SELECT 'same' AS feature, count(*) AS n, 7.0::DOUBLE AS value FROM lineitem",
    "top_features": """
WITH c AS (
  SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'l_linenumber', 'l_suppkey']) AS feature,
         unnest([corr(l_quantity, l_extendedprice), corr(l_discount, l_extendedprice), corr(l_tax, l_extendedprice),
                 corr(l_linenumber, l_extendedprice), corr(l_suppkey, l_extendedprice)]) AS corr FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY corr DESC, feature) AS t, row_number() OVER (ORDER BY corr, feature) AS b FROM c)
SELECT feature, round(corr, 6) AS corr, 'top' AS side FROM r WHERE t <= 2
UNION ALL SELECT feature, round(corr, 6), 'bottom' FROM r WHERE b <= 2""",
    "valuation_edges": """
WITH r AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber IN (6, 7) THEN 0 ELSE greatest(CAST(l_quantity AS INTEGER) - 25, 0) END AS q,
         CAST(l_suppkey AS DECIMAL(20,8)) * CAST(0.0349 AS DECIMAL(6,4)) AS cost, CAST(l_linenumber AS DECIMAL(28,2)) AS stock
  FROM lineitem),
v AS (SELECT *, CAST(cost AS DECIMAL(38,8)) * q AS v FROM r)
SELECT l_orderkey, l_linenumber, CAST(q AS DOUBLE) AS "Previsao_Quantidade", CAST(cost AS DOUBLE) AS "Custo_Unitário",
       CAST(stock AS DOUBLE) AS "Valor_Estoque", CAST(round_even(v, 2) AS DOUBLE) AS "Valor Fisico Previsto",
       CAST(round_even(v - stock, 2) AS DOUBLE) AS "Vlr Delta Previsto",
       CAST(round_even(abs(v - stock), 2) AS DOUBLE) AS "Delta ABS Previsto",
       CAST(round_even(abs(v - stock) * CAST(0.18 AS DECIMAL(6,4)), 2) AS DOUBLE) AS "TOTAL IMPOSTO Previsto"
FROM v""",
    "forecast_plan_fallback": O.RECENT.replace("WITH ", "WITH RECURSIVE ", 1)
    + O.CAPACITY
    + O.ITEMS_TO_COUNT
    + O.ALLOCATION
    + O.FALLBACK
    + """
SELECT v."Código", v."Model_Name", a."Ano_Previsto", a."Mês_Previsto", v."Curva_ABC",
       CAST(round_even(v."Lógica_ABC", 0) AS BIGINT) AS "Lógica_ABC", CAST(v."Custo_Unitário" AS DOUBLE) AS "Custo_Unitário",
       CAST(v."Valor_Estoque" AS DOUBLE) AS "Valor_Estoque", CAST(v."Previsao_Quantidade" AS DOUBLE) AS "Previsao_Quantidade",
       CAST(v."Valor Fisico Previsto" AS DOUBLE) AS "Valor Fisico Previsto",
       CAST(v."Vlr Delta Previsto" AS DOUBLE) AS "Vlr Delta Previsto",
       CAST(v."Delta ABS Previsto" AS DOUBLE) AS "Delta ABS Previsto",
       CAST(v."TOTAL IMPOSTO Previsto" AS DOUBLE) AS "TOTAL IMPOSTO Previsto"
FROM valuation v JOIN allocation a ON a."Código" = v."Código\"""",
    "naive_metrics": O.COUNTS_BASE
    + """,
p AS (SELECT CAST("Lógica" AS DOUBLE) AS p, CAST("Quantidade Fisica" AS DOUBLE) AS y FROM valued_counts
      WHERE "Lógica" IS NOT NULL AND "Quantidade Fisica" IS NOT NULL)
SELECT count(*) AS n, round(avg(abs(p - y)), 6) AS "MAE", round(sqrt(avg((p - y) * (p - y))), 6) AS "RMSE",
       round(1.0 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 6) AS "R2" FROM p""",
    "month_folds": """
WITH k AS (SELECT year(l_shipdate) * 12 + month(l_shipdate) AS k FROM lineitem),
m AS (SELECT list(k ORDER BY k) AS m, len(m) AS n, n // 6 AS block, n - 5 * (n // 6) AS first FROM (SELECT DISTINCT k FROM k)),
f AS (SELECT i::INTEGER AS fold, m[first + i * block]::INTEGER AS train_end,
             m[least(n, first + (i + 1) * block)]::INTEGER AS valid_end FROM m, range(5) r(i))
SELECT fold, train_end, valid_end, count(*) FILTER (k <= train_end) AS n_train, count(*) FILTER (k > train_end) AS n_valid
FROM f JOIN k ON k <= valid_end GROUP BY 1, 2, 3""",
    "temporal_split": """
WITH r AS (SELECT year(l_shipdate) AS y, CAST(l_quantity AS BIGINT) AS q, max(year(l_shipdate)) OVER () AS last FROM lineitem)
SELECT CASE WHEN y < last THEN 'train' ELSE 'test' END AS part, count(*) AS n, sum(q)::BIGINT AS q,
       any_value(last)::INTEGER AS test_year FROM r GROUP BY 1""",
    "scaled_features": """
WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (6, 7) THEN 0.0 ELSE l_quantity END AS x, l_returnflag AS c FROM lineitem),
s AS (SELECT quantile_disc(x, 0.5) AS med, quantile_disc(x, 0.75) - quantile_disc(x, 0.25) AS iqr FROM r)
SELECT l_orderkey, l_linenumber, (x - med) / iqr AS f0, CAST(c = 'A' AS INTEGER)::DOUBLE AS f1,
       CAST(c = 'N' AS INTEGER)::DOUBLE AS f2, CAST(c = 'R' AS INTEGER)::DOUBLE AS f3 FROM r, s""",
    "linear_closed_form": """
SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""",
}

_PLAN = ORACLE["forecast_plan_fallback"]
ORACLE["plan_written"] = f"""
SELECT "Model_Name", count(*) AS n, 0::BIGINT AS out_of_order,
       arg_min("Código", ("Ano_Previsto", "Mês_Previsto", "Código")) AS first_item,
       arg_max("Código", ("Ano_Previsto", "Mês_Previsto", "Código")) AS last_item
FROM ({_PLAN}) GROUP BY 1"""

DECIMAL_OUTPUTS = {
    "ytd_metrics_written": ["Total_Real", "Total_Previsto", "Diferenca_Total"],
    "abc_from_files": ["Soma de Estoqueada", "Custo Médio", "Soma de Valor Total"],
    "counts_from_files": ["Lógica", "Quantidade Fisica", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS"],
    "movements_from_files": ["Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal"],
    "ytd_from_files": ["Real_YTD", "Prev_YTD", "Erro", "Erro_Abs"],
    "category_written": ["Lógica_ABC"],
    "counts_without_cancelled": ["Lógica", "Quantidade Fisica", "Custo", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS"],
}
DATE_OUTPUTS = {"counts_from_files": ["Data INV"], "counts_without_cancelled": ["Data INV"]}
