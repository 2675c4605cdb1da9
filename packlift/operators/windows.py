"""The one-pass window join: sales -> common SKU -> promo pairs.

Every report needs, per promo pair, the sales of the pair's client and common
SKU inside the promo window and (for most) the control window before it. The
two windows touch, so one range ``[control_start, end]`` covers both and a
single pass over the fact serves every measure; ``in_promo`` tells the windows
apart afterwards.

Plan shape (checked in tests): the fact is scanned once, with the live, client
and operation-type filters pushed to Parquet and the date range of the windows
as scalar subqueries, so that the range is found when the report runs and then
reaches Parquet too. The join with the pairs is an equi join on (common SKU,
client, year, bucket of days): pairs are unfolded to the few buckets their
window touches, so a sale meets the windows near its day and not all
promotions its key ever had; the exact window is the residual. The year is the
layout's partition column, so dynamic partition pruning skips years without a
window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.operators.pairs import PAIR_KEYS, PromoScope, day_bucket
from packlift.rules import PromoRules
from packlift.sources.tables import PromoTables, live

SALE_COLS = ["id_sku", "id_client", "tin_buyer", "operation_date", "quantity", "id_operation_type"]
TAGGED_COLS = PAIR_KEYS + ["id_sku", "tin_buyer", "operation_date", "quantity", "id_operation_type",
                           "multiple", "in_promo"]


def live_sales(t: PromoTables, rules: PromoRules, sale_only: bool = True) -> DataFrame:
    """Live rows of the sales fact for the rules' clients (and sales only)."""
    s = live(t.sale, "sentinel", rules.live_sentinel)
    if rules.clients is not None:
        s = s.where(F.col("id_client").isin(list(rules.clients)))
    if sale_only:
        s = s.where(F.col("id_operation_type") == rules.sale_operation_type)
    if rules.positive_only:
        s = s.where(F.col("quantity") > 0)
    return s


def with_common_sku(sales: DataFrame, sku_side: DataFrame) -> DataFrame:
    """Add ``id_common_sku`` to each sale (inner join on ``id_sku``);
    ``sku_side`` is (id_sku, id_common_sku)."""
    return sales.join(sku_side, "id_sku")


def tag_sales(t: PromoTables, scope: PromoScope, rules: PromoRules, *, sale_only: bool = True) -> DataFrame:
    """Sales of each pair's client and common SKU inside its window(s).

    ``scope.windows="both"``: ``[control_start, end]``; ``"promo"``:
    ``[start, end]``. A sale inside several pairs' windows is returned once
    per pair, as the reports count it in each promotion. Columns:
    ``TAGGED_COLS``.
    """
    sales = live_sales(t, rules, sale_only)
    sales = sales.where(F.col("operation_date").between(scope.bound("lo"), scope.bound("hi")))
    year = F.col("op_year") if "op_year" in sales.columns else F.year("operation_date").alias("op_year")
    sales = with_common_sku(sales.select(*SALE_COLS, year, day_bucket("operation_date").alias("bucket")),
                            scope.sku.drop("sku_live"))
    hit = (sales.join(scope.unfolded(), ["id_common_sku", "id_client", "op_year", "bucket"])
           .where((F.col("operation_date") >= F.col("window_start"))
                  & (F.col("operation_date") <= F.col("end_date"))))
    return hit.select(
        *PAIR_KEYS, "id_sku", "tin_buyer", "operation_date", "quantity", "id_operation_type",
        X.multiple(rules).alias("multiple"),
        (F.col("operation_date") >= F.col("start_date")).alias("in_promo"),
    )


def window_label(promo: str = "promo", control: str = "control") -> F.Column:
    return F.when(F.col("in_promo"), F.lit(promo)).otherwise(F.lit(control))
