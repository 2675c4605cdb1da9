"""Dimension lookups of the reports (left joins)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.sources.tables import PromoTables, live


def client_names(t: PromoTables) -> DataFrame:
    """Distinct (client, name) of live clients, every version: a client renamed
    over time gets one row per name."""
    return live(t.client).select("id_client", "client_name").distinct()


def client_as_of(t: PromoTables, as_of: date | None = None) -> DataFrame:
    """Live clients valid on ``as_of`` (``valid_from <= as_of <= valid_to``);
    today when no date is given."""
    day = F.current_date() if as_of is None else F.lit(as_of)
    return (live(t.client).where(day.between(F.col("valid_from"), F.col("valid_to")))
            .select("id_client", "client_name"))


def bonus_prices(t: PromoTables) -> DataFrame:
    """Live bonus prices by (client, common SKU, sale date).

    Two priced SKUs under one common SKU give two rows; a price whose SKU is
    unknown keeps its row with a NULL common SKU, which no pair matches.
    """
    price = live(t.price).select("id_client", "id_sku", "sale_date", "bonus")
    return (price.join(t.sku.select("id_sku", "id_common_sku"), "id_sku", "left")
            .select("id_client", "id_common_sku", "sale_date", "bonus"))


def add_names(df: DataFrame, t: PromoTables, sku_side: DataFrame | None = None) -> DataFrame:
    """Add promotion type, client and common SKU names and the bonus at the
    promo start to rows keyed by pair (left joins: a renamed client or a second
    priced SKU gives a pair a second row).

    ``sku_side`` (the SKUs of the report's pairs) restricts the price list to
    prices that can match.
    """
    if sku_side is None:
        price = bonus_prices(t)
    else:
        price = (live(t.price).join(sku_side, "id_sku")
                 .select("id_client", "id_common_sku", "sale_date", "bonus"))
    price = price.withColumnRenamed("sale_date", "start_date")
    # The price list first: it is the join that may shuffle, and names repeat the rows.
    return (df.join(price, ["id_client", "id_common_sku", "start_date"], "left")
            .join(t.promo_type.select("id_promotion_type", "promotion_type_name"), "id_promotion_type", "left")
            .join(client_names(t), "id_client", "left")
            .join(t.common_sku.select("id_common_sku", "common_sku_name"), "id_common_sku", "left"))
