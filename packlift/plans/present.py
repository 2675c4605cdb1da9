"""Presentation of the reconciliations: names, defaults, differences, labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.plans.reconcile import (add_product_names, condition_sales, entity_names, recon_by_tin, recon_grouped,
                                     recon_scope, sold_tins)
from packlift.rules import CONDITION_RULES, DEFAULT_ENTITY_NAME, PromoRules
from packlift.sources.tables import PromoTables

# ---------------------------------------------------------------------------
# The column labels readers of the presentation queries expect
# (product name, client, buyer's legal entity, buyer TIN, multiple ours /
# declared, start, end, packs sold ours / declared, bonus per pack ours /
# declared, multiple difference, packs difference, bonus per pack difference,
# bonus sum ours / declared, bonus sum difference, correction).
# ---------------------------------------------------------------------------
PRODUCT = "Название товара"
CLIENT = "Клиент"
ENTITY = "Юридическое лицо покупателя"
TIN = "ИНН покупателя"
MULT_OURS = "Кратность по нашим данным"
MULT_DECLARED = "Кратность по данным итогов"
START = "Дата начала"
END = "Дата окончания"
QTY_OURS = "Продано упаковок по нашим данным"
QTY_DECLARED = "Продано упаковок по данным итогов"
BONUS_OURS = "Бонус за пакет по нашим данным"
BONUS_DECLARED = "Бонус за пакет по данным итогов"
MULT_DIFF = "Разница кратности"
QTY_DIFF = "Разница упаковок"
BONUS_DIFF = "Разница бонуса за упаковку"
SUM_OURS = "Сумма бонуса по нашим данным"
SUM_DECLARED = "Сумма бонуса по данным итогов"
SUM_DIFF = "Разница суммы бонуса"
CORRECTION = "Коррекция"
# ---------------------------------------------------------------------------


def _z(c: str) -> F.Column:
    return F.coalesce(F.col(c), F.lit(0))


def hot_by_tin(t: PromoTables, as_of: date | None = None, rules: PromoRules = CONDITION_RULES,
               recon: DataFrame | None = None) -> DataFrame:
    """Reconciliation by TIN for reading: 19 labelled columns; names as of
    today unless a date is given."""
    tins = None
    if recon is None:
        rs = recon_scope(t, rules)
        rows = condition_sales(t, rules, rs.scope)
        recon, tins = recon_by_tin(t, rules=rules, rs=rs, rows=rows), sold_tins(rows)
    df = add_product_names(recon, t, as_of)
    df = df.join(entity_names(t, tins), "tin_buyer", "left")
    return df.select(
        F.col("common_sku_name").alias(PRODUCT),
        "id_common_sku",
        F.col("client_name").alias(CLIENT),
        F.coalesce(F.col("legal_entity_name"), F.lit(DEFAULT_ENTITY_NAME)).alias(ENTITY),
        F.col("tin_buyer").alias(TIN),
        F.col("sales_multiple").alias(MULT_OURS),
        F.col("promo_multiple").alias(MULT_DECLARED),
        F.col("start_date").alias(START),
        F.col("end_date").alias(END),
        _z("quantity_sales").alias(QTY_OURS),
        _z("quantity_promo").alias(QTY_DECLARED),
        _z("sales_bonus").alias(BONUS_OURS),
        _z("promo_bonus").alias(BONUS_DECLARED),
        (F.col("promo_multiple") - F.col("sales_multiple")).alias(MULT_DIFF),
        (_z("quantity_promo") - _z("quantity_sales")).alias(QTY_DIFF),
        (_z("promo_bonus") - _z("sales_bonus")).alias(BONUS_DIFF),
        _z("sales_sum_bonus").alias(SUM_OURS),
        _z("promo_sum_bonus").alias(SUM_DECLARED),
        (_z("promo_sum_bonus") - _z("sales_sum_bonus")).alias(SUM_DIFF),
    )


def hot_grouped(t: PromoTables, as_of: date | None = None, rules: PromoRules = CONDITION_RULES,
                recon: DataFrame | None = None) -> DataFrame:
    """Grouped reconciliation for reading: 17 labelled columns, with the
    declared bonus sum floored to whole packs and the unfloored correction."""
    recon = recon_grouped(t, rules=rules) if recon is None else recon
    df = add_product_names(recon, t, as_of)
    pm, pb, sm, sb = F.col("promo_multiple"), F.col("promo_bonus"), F.col("sales_multiple"), F.col("sales_bonus")
    return df.select(
        F.col("common_sku_name").alias(PRODUCT),
        "id_common_sku",
        F.col("client_name").alias(CLIENT),
        X.promo_label("sales_multiple").alias(MULT_OURS),
        X.promo_label("promo_multiple").alias(MULT_DECLARED),
        F.col("start_date").alias(START),
        F.col("end_date").alias(END),
        F.col("quantity_sales").alias(QTY_OURS),
        F.col("quantity_promo").alias(QTY_DECLARED),
        F.col("sales_bonus").alias(BONUS_OURS),
        F.col("promo_bonus").alias(BONUS_DECLARED),
        (pm - sm).alias(MULT_DIFF),
        (_z("quantity_promo") - _z("quantity_sales")).alias(QTY_DIFF),
        (_z("promo_bonus") - sb).alias(BONUS_DIFF),
        F.col("sales_sum_bonus").alias(SUM_OURS),
        (X.floor_packs("quantity_promo", "promo_multiple") * pb).alias(SUM_DECLARED),
        X.ratio_difference(("quantity_promo", "promo_bonus", "promo_multiple"),
                           ("quantity_sales", "sales_bonus", "sales_multiple")).alias(CORRECTION),
    )
