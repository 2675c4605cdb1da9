"""The promo report: per promo pair, qualifying and total sales, packs and
active buyers in the promo and control windows, valued at the bonus price.

Plan: pairs (small) -> one tagged pass over the fact -> exception flags ->
two-stage aggregate -> pivot -> name and price lookups -> 21 columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.operators import measures as M
from packlift.operators.exceptions import add_flags, excluded
from packlift.operators.lookups import add_names
from packlift.operators.pairs import PAIR_KEYS, PromoScope, promo_scope
from packlift.operators.windows import tag_sales, window_label
from packlift.rules import REPORT_RULES, PromoRules
from packlift.sources.tables import PromoTables

SALE_VIEW_COLS = ["id_sku", "id_client", "tin_buyer", "operation_date", "quantity", "id_operation_type"]
PAIR_VIEW_COLS = ["id_common_sku", "id_promotion", "id_promotion_type", "start_date", "end_date"]

# Output columns of the report, in order.
REPORT_COLUMNS = [
    "id_common_sku", "common_sku_name", "id_client", "client_name", "id_promotion_type",
    "promotion_type_name", "start_date", "end_date", "sales_quantity_promo", "bonus",
    "sales_pack_promo", "sales_amount_promo", "sales_amount_pack_promo", "total_sales",
    "total_sales_amount", "total_sales_control_period", "total_sales_amount_control_period",
    "acb_promo", "acb_control_period", "sales_promo_control_period",
    "sales_amount_promo_control_period",
]

# Amount columns: name -> measure valued at the bonus.
AMOUNTS = {
    "sales_amount_promo": "sales_quantity_promo",
    "sales_amount_pack_promo": "sales_pack_promo",
    "total_sales_amount": "total_sales",
    "total_sales_amount_control_period": "total_sales_control_period",
    "sales_amount_promo_control_period": "sales_promo_control_period",
}


def flag_scope(t: PromoTables, scope: PromoScope, rules: PromoRules, sale_only: bool) -> DataFrame:
    """Tagged sales of a scope with the exception flags."""
    return _flags(tag_sales(t, scope, rules, sale_only=sale_only), scope)


def _flags(rows: DataFrame, scope: PromoScope) -> DataFrame:
    if scope.exc_keys is None:
        return rows.withColumn("exc_on_date", F.lit(False)).withColumn("exc_any", F.lit(False))
    return add_flags(rows, scope.exc_keys)


def flagged_sales(t: PromoTables, rules: PromoRules = REPORT_RULES, scope: PromoScope | None = None) -> DataFrame:
    """Every sale (any operation type) in either window of a pair, with the
    window and the exception flags."""
    scope = scope or promo_scope(t, rules, "both", exceptions=True)
    return flag_scope(t, scope, rules, sale_only=False)


def conditional_sales(flagged: DataFrame, rules: PromoRules = REPORT_RULES) -> DataFrame:
    """Sales that survive the report's exception policy (sales only)."""
    return flagged.where((F.col("id_operation_type") == rules.sale_operation_type)
                         & ~excluded(rules.exception_policy))


def combined_sales(flagged: DataFrame, rules: PromoRules = REPORT_RULES) -> DataFrame:
    """Conditional rows (labelled promo/control) followed by every row again
    (labelled total_promo/total_control), as one tagged multiset.

    One pass: each flagged row emits its total copy and, if it survives the
    exceptions, its conditional copy (``explode`` of a two-slot array).
    """
    cond = (F.col("id_operation_type") == rules.sale_operation_type) & ~excluded(rules.exception_policy)
    labels = F.array(F.when(cond, window_label("promo", "control")), window_label("total_promo", "total_control"))
    return (flagged.select(*SALE_VIEW_COLS, *PAIR_VIEW_COLS, F.explode(labels).alias("sales_type"))
            .where(F.col("sales_type").isNotNull()))


def sales_packs(combined: DataFrame, rules: PromoRules = REPORT_RULES) -> DataFrame:
    """Scored quantity and packs per combined row: totals pass the quantity,
    conditional rows apply the quantity rule."""
    m = X.multiple_sql(rules)
    total = F.col("sales_type").startswith("total")
    sq = F.when(total, F.col("quantity")).otherwise(X.scored_quantity(rules, m=m))
    return (combined.withColumn("sales_quantity", sq)
            .withColumn("sales_pack", X.packs("sales_quantity", X.multiple(rules))))


def report_pivot(t: PromoTables, rules: PromoRules = REPORT_RULES, scope: PromoScope | None = None) -> DataFrame:
    """Pair keys and the 12 measures (``n_<type>`` row counts kept).

    The rows are first pre-aggregated to (pair, TIN, sale date), the grain the
    exception outcome is constant on, so a shuffle for the exception join
    carries groups, not rows, and a hot buyer is bounded by its pairs x days.
    """
    scope = scope or promo_scope(t, rules, "both", exceptions=True)
    parts = M.combine_parts(M.parts(tag_sales(t, scope, rules, sale_only=False), rules))
    return M.stage2(M.stage1(_flags(parts, scope), rules))


def sales_type_agg(t: PromoTables, rules: PromoRules = REPORT_RULES) -> DataFrame:
    """One row per (sales type, pair) with sales_quantity, sales_pack, acb."""
    return M.unpivot(report_pivot(t, rules))


def report_columns(df: DataFrame) -> DataFrame:
    """The 21 report columns, amounts valued at the bonus."""
    amount = {name: (F.col(m) * F.col("bonus")).alias(name) for name, m in AMOUNTS.items()}
    return df.select(*[amount.get(c, F.col(c)) for c in REPORT_COLUMNS])


def report_new(t: PromoTables, rules: PromoRules = REPORT_RULES) -> DataFrame:
    """The report: 21 columns (``id_promotion`` is a key but not shown)."""
    scope = promo_scope(t, rules, "both", exceptions=True)
    pivot = report_pivot(t, rules, scope).select(*PAIR_KEYS, *[c for n in M.PIVOT_NAMES.values() for c in n])
    return report_columns(add_names(pivot, t, scope.sku))
