"""Decimal and date output columns of each SQL-checked query (fixed data, taken
from the Spark schemas). At the contract boundary both sides of the correctness
check cast decimals to DOUBLE and dates to ISO ``yyyy-MM-dd`` text; inside, every
sum and product stays exact decimal."""

DECIMAL_OUTPUTS: dict[str, list[str]] = {
    'abc_curve': ["Lógica_ABC", "Custo_Unitário", "Valor_Estoque"],
    'abc_class_summary': ["total_qty", "total_value"],
    'latest_cost': ["Custo Médio"],
    'stock_valued': ["Lógica_ABC", "Custo_Unitário", "Valor_Estoque"],
    'counts_last': ["Física", "Quantidade Fisica", "Lógica", "Custo"],
    'counts_valued': ["Lógica", "Quantidade Fisica", "Custo", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS"],
    'counts_daily': ["Lógica", "Quantidade Fisica", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS"],
    'delta_summary': ["positive_delta", "negative_delta", "net_delta", "abs_delta", "tax"],
    'movement_by_type': ["Total_Qtde_Mov", "Qtd_Mov_Count"],
    'movement_totals': ["Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal"],
    'movement_pivot': ["AF_Total_Qtde_Mensal", "AO_Total_Qtde_Mensal", "NF_Total_Qtde_Mensal", "NO_Total_Qtde_Mensal", "RF_Total_Qtde_Mensal", "RO_Total_Qtde_Mensal", "AF_Qtd_Movimentos_Mensal", "AO_Qtd_Movimentos_Mensal", "NF_Qtd_Movimentos_Mensal", "NO_Qtd_Movimentos_Mensal", "RF_Qtd_Movimentos_Mensal", "RO_Qtd_Movimentos_Mensal", "Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal"],
    'items_with_history': [],
    'items_without_history': [],
    'item_category': ["Lógica_ABC"],
    'trend_12': ["Quantidade Fisica"],
    'moving_averages': ["Quantidade Fisica"],
    'class_stats': [],
    'features': ["Lógica", "Quantidade Fisica", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque", "AF_Total_Qtde_Mensal", "AO_Total_Qtde_Mensal", "NF_Total_Qtde_Mensal", "NO_Total_Qtde_Mensal", "RF_Total_Qtde_Mensal", "RO_Total_Qtde_Mensal", "AF_Qtd_Movimentos_Mensal", "AO_Qtd_Movimentos_Mensal", "NF_Qtd_Movimentos_Mensal", "NO_Qtd_Movimentos_Mensal", "RF_Qtd_Movimentos_Mensal", "RO_Qtd_Movimentos_Mensal", "Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal"],
    'capacity_by_month': [],
    'items_to_count': ["Valor_Estoque", "Lógica_ABC"],
    'last_feature_row': ["Lógica", "Quantidade Fisica", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque", "AF_Total_Qtde_Mensal", "AO_Total_Qtde_Mensal", "NF_Total_Qtde_Mensal", "NO_Total_Qtde_Mensal", "RF_Total_Qtde_Mensal", "RO_Total_Qtde_Mensal", "AF_Qtd_Movimentos_Mensal", "AO_Qtd_Movimentos_Mensal", "NF_Qtd_Movimentos_Mensal", "NO_Qtd_Movimentos_Mensal", "RF_Qtd_Movimentos_Mensal", "RO_Qtd_Movimentos_Mensal", "Total_Geral_Qtde_Mensal", "Total_Geral_Qtd_Movimentos_Mensal"],
    'fallback_forecast': [],
    'forecast_valuation': ["Previsao_Quantidade", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque", "Valor Fisico Previsto", "Vlr Delta Previsto", "Delta ABS Previsto", "TOTAL IMPOSTO Previsto"],
    'ytd_detail': ["Real_YTD", "Prev_YTD", "Erro", "Erro_Abs"],
    'ytd_metrics': ["Total_Real", "Total_Previsto", "Diferenca_Total"],
    'best_model': [],
    'target_profile': ["min", "max"],
    'constant_features': [],
    'feature_correlation': [],
    'standardize_codes': [],
    'fixed_codes': [],
    'parse_ptbr': ["value"],
    'parse_timestamps': [],
    'ytd_detail_wide': ["Real_YTD", "Ajustado_Prev_YTD", "Ajustado_Erro", "Ajustado_Erro_Abs", "Logica_Prev_YTD", "Logica_Erro", "Logica_Erro_Abs"],
    'features_without_movements': ["Lógica", "Quantidade Fisica", "Valor Logica", "Valor Fisico", "Vlr Delta", "Delta ABS", "Lógica_ABC", "Custo_Unitário", "Valor_Estoque"],
}

DATE_OUTPUTS: dict[str, list[str]] = {
    'counts_last': ["Data INV"],
    'counts_valued': ["Data INV"],
    'counts_daily': ["Data INV"],
    'trend_12': ["Data INV"],
    'moving_averages': ["Data INV"],
    'features': ["Data INV"],
    'last_feature_row': ["Data INV"],
    'parse_timestamps': ["date", "month_start"],
    'features_without_movements': ["Data INV"],
}
