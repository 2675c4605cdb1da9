"""Qualifying sales row by row, and their reconciliation with declared results.

``condition_sales``  sales in a promo window that meet the quantity rule, after
                     the exception list (by sale date), one row per (sale, pair);
``recon_by_tin``     sold vs declared per (common SKU, client, TIN, promo dates);
``recon_grouped``    the same without the TIN.

Sold and declared sides are each aggregated first (partial aggregation before
the shuffle); only the aggregates are joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.operators.bloom import among
from packlift.operators.exceptions import excluded
from packlift.operators.lookups import client_as_of
from packlift.operators.pairs import PromoScope, promo_scope
from packlift.plans.report import flag_scope
from packlift.rules import CONDITION_RULES, PromoRules
from packlift.sources.tables import PromoTables, live

CONDITION_COLUMNS = ["id_client", "id_sku", "id_common_sku", "operation_date", "start_date", "end_date",
                     "multiple", "tin_buyer", "sales_quantity"]
TIN_KEYS = ["id_common_sku", "id_client", "tin_buyer", "start_date", "end_date"]
GROUP_KEYS = ["id_common_sku", "id_client", "start_date", "end_date"]

@dataclass
class ReconScope:
    """Inputs of one reconciliation query.

    scope     pairs and SKU side of the qualifying-sales view
    price     live prices of live SKUs: (id_common_sku, bonus, start_date, id_client)
    sku_live  live SKUs of the pairs' common SKUs: (id_sku, id_common_sku)
    """

    scope: PromoScope
    price: DataFrame
    sku_live: DataFrame


def _price_side(t: PromoTables, sku_live: DataFrame) -> DataFrame:
    return (live(t.price).select("id_sku", "bonus", "sale_date", "id_client").join(sku_live, "id_sku")
            .select("id_common_sku", "bonus", F.col("sale_date").alias("start_date"), "id_client"))


def add_product_names(df: DataFrame, t: PromoTables, as_of: date | None) -> DataFrame:
    """Add the live common SKU name and the client name valid on ``as_of``; a
    missing or deleted name stays NULL and the row is kept."""
    return (df.join(live(t.common_sku).select("id_common_sku", "common_sku_name"), "id_common_sku", "left")
            .join(client_as_of(t, as_of), "id_client", "left"))


def entity_names(t: PromoTables, sold: DataFrame | None = None) -> DataFrame:
    """Live legal entities by TIN. With ``sold`` (rows with ``tin_buyer``), a
    Bloom filter of its TINs drops the other entities where they are read, so
    the join shuffles little more than the entities it finds."""
    names = live(t.entity).select(F.col("id_legal_entity").alias("tin_buyer"), "legal_entity_name")
    return names if sold is None else among(names, "tin_buyer", sold, "tin_buyer")


def recon_scope(t: PromoTables, rules: PromoRules = CONDITION_RULES) -> ReconScope:
    """Prices and declared results only ever meet sold rows of the pairs'
    common SKUs, so their SKU side is the pairs' live SKUs."""
    s = promo_scope(t, rules, "promo", exceptions=True)
    sku_live = s.sku.where("sku_live").drop("sku_live")
    return ReconScope(s, _price_side(t, sku_live), sku_live)


def condition_candidates(t: PromoTables, rules: PromoRules = CONDITION_RULES,
                         scope: PromoScope | None = None) -> DataFrame:
    """Promo-window sales of each pair that survive the exception list."""
    scope = scope or promo_scope(t, rules, "promo", exceptions=True)
    return flag_scope(t, scope, rules, sale_only=True).where(~excluded(rules.exception_policy))


def condition_sales(t: PromoTables, rules: PromoRules = CONDITION_RULES,
                    scope: PromoScope | None = None) -> DataFrame:
    """The 9-column qualifying-sales view (positive scored quantities)."""
    rows = condition_candidates(t, rules, scope).withColumn("sales_quantity", X.scored_quantity(rules))
    return rows.where(F.col("sales_quantity") > 0).select(*CONDITION_COLUMNS)


def condition_sales_bonus(t: PromoTables, rules: PromoRules = CONDITION_RULES,
                          rs: ReconScope | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Qualifying sales priced at the promo start's bonus (live prices of live
    SKUs; several prices per common SKU repeat the sale), with
    ``sum_bonus = bonus * floor(sales_quantity / multiple)``. ``rows`` are the
    qualifying sales, if already at hand (a view)."""
    rs = rs or recon_scope(t, rules)
    rows = condition_sales(t, rules, rs.scope) if rows is None else rows
    out = rows.join(rs.price, ["start_date", "id_client", "id_common_sku"])
    return out.withColumn("sum_bonus", F.col("bonus") * X.floor_packs("sales_quantity", "multiple"))


def sold_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Quantity and whole packs of the qualifying sales per group and multiple."""
    return (rows.groupBy(*keys, "multiple")
            .agg(F.sum("sales_quantity").alias("quantity"),
                 F.sum(X.floor_packs("sales_quantity", "multiple")).alias("packs")))


def sold_tins(rows: DataFrame) -> DataFrame:
    """The TINs with qualifying sales. Reads both sums of ``sold_groups``, so that its
    aggregate is the reconciliation's own and Spark runs it once for both."""
    return (sold_groups(rows, TIN_KEYS).where(F.col("quantity").isNotNull() | F.col("packs").isNotNull())
            .select("tin_buyer"))


def _sold(t: PromoTables, rules: PromoRules, rs: ReconScope | None, keys: list[str], rows: DataFrame | None) -> DataFrame:
    """Sums per group, bonus and multiple, as if every sale met every price of its promo start.

    Aggregated before the price join: the quantity and the whole packs are
    summed per group and multiple, the prices are counted per bonus, and one
    row of a group meets one row of a bonus. The sums are then multiplied, so a
    second price repeats no sale.
    """
    rs = rs or recon_scope(t, rules)
    rows = condition_sales(t, rules, rs.scope) if rows is None else rows
    groups = sold_groups(rows, keys)
    prices = rs.price.groupBy("start_date", "id_client", "id_common_sku", "bonus").agg(F.count(F.lit(1)).alias("prices"))
    return (groups.join(prices, ["start_date", "id_client", "id_common_sku"])
            .select(*keys, "bonus", "multiple", (F.col("quantity") * F.col("prices")).alias("quantity"),
                    (F.col("bonus") * (F.col("packs") * F.col("prices"))).alias("sum_bonus")))


def sold_by_tin(t: PromoTables, rules: PromoRules = CONDITION_RULES, rs: ReconScope | None = None,
                rows: DataFrame | None = None) -> DataFrame:
    return _sold(t, rules, rs, TIN_KEYS, rows)


def sold_grouped(t: PromoTables, rules: PromoRules = CONDITION_RULES, rs: ReconScope | None = None,
                 rows: DataFrame | None = None) -> DataFrame:
    return _sold(t, rules, rs, GROUP_KEYS, rows)


def _declared(t: PromoTables, rs: ReconScope | None) -> DataFrame:
    """Declared results of live SKUs, keyed by common SKU; inside a
    reconciliation only those of its pairs' clients, common SKUs and dates."""
    if rs is None:
        return t.result.join(live(t.sku).select("id_sku", "id_common_sku"), "id_sku")
    return rs.scope.restrict(t.result.join(rs.sku_live, "id_sku"), *GROUP_KEYS)


def results_by_tin(t: PromoTables, rs: ReconScope | None = None) -> DataFrame:
    """Declared per (TIN keys, multiple, bonus): quantity and the unfloored
    ``bonus * quantity / multiple``; as multiple and bonus are keys, the sum is
    multiplied first and divided once."""
    return (_declared(t, rs).groupBy(*TIN_KEYS, "multiple", "bonus")
            .agg(F.sum("quantity").alias("quantity_promo"))
            .withColumn("sum_bonus", F.col("quantity_promo") * F.col("bonus") / F.col("multiple")))


def results_grouped(t: PromoTables, rs: ReconScope | None = None) -> DataFrame:
    """Declared per (group keys, multiple, bonus): quantity and
    ``sum(quantity) * bonus``."""
    return (_declared(t, rs).groupBy(*GROUP_KEYS, "multiple", "bonus")
            .agg(F.sum("quantity").alias("quantity_promo"))
            .withColumn("sum_bonus", F.col("quantity_promo") * F.col("bonus")))


def recon_by_tin(t: PromoTables, matched_only: bool = False, rules: PromoRules = CONDITION_RULES,
                 rs: ReconScope | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Sold left-joined to declared on the five TIN keys (multiple and bonus
    are not keys, so several versions of either side pair up)."""
    rs = rs or recon_scope(t, rules)
    sold = sold_by_tin(t, rules, rs, rows).select(
        *TIN_KEYS, F.col("multiple").alias("sales_multiple"), F.col("bonus").alias("sales_bonus"),
        F.col("quantity").alias("quantity_sales"), F.col("sum_bonus").alias("sales_sum_bonus"))
    declared = results_by_tin(t, rs).select(
        *TIN_KEYS, F.col("multiple").alias("promo_multiple"), F.col("bonus").alias("promo_bonus"),
        "quantity_promo", F.col("sum_bonus").alias("promo_sum_bonus"))
    return sold.join(declared, TIN_KEYS, "inner" if matched_only else "left").select(
        *TIN_KEYS, "sales_multiple", "sales_bonus", "quantity_sales", "sales_sum_bonus",
        "promo_multiple", "promo_bonus", "quantity_promo", "promo_sum_bonus")


def recon_grouped(t: PromoTables, matched_only: bool = False, rules: PromoRules = CONDITION_RULES,
                  rs: ReconScope | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Sold left-joined to declared on the four group keys."""
    rs = rs or recon_scope(t, rules)
    sold = sold_grouped(t, rules, rs, rows).select(
        *GROUP_KEYS, F.col("multiple").alias("sales_multiple"), F.col("bonus").alias("sales_bonus"),
        F.col("quantity").alias("quantity_sales"), F.col("sum_bonus").alias("sales_sum_bonus"))
    declared = results_grouped(t, rs).select(
        *GROUP_KEYS, "quantity_promo", F.col("multiple").alias("promo_multiple"),
        F.col("bonus").alias("promo_bonus"))
    return sold.join(declared, GROUP_KEYS, "inner" if matched_only else "left").select(
        *GROUP_KEYS, "sales_multiple", "sales_bonus", "quantity_sales", "quantity_promo",
        "promo_multiple", "promo_bonus", "sales_sum_bonus")
