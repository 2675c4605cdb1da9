"""The legacy promo report, decorrelated.

Its definition is a set of per-pair scalar subqueries over the sales fact
(some with nested ``NOT IN`` / ``IN`` subqueries). Here it is one pass:

1. pairs of promotions starting on or after the cut-off;
2. the fact's sales tagged with every pair whose promo or control window
   holds them (one scan);
3. one aggregate per (pair, TIN) with conditional sums;
4. the per-pair ``NOT IN`` exclusion list applied at (pair, TIN) level -- it
   depends on the promo's start, not on the sale date, so it can come after
   the aggregate, on far fewer rows;
5. "took part in the promo" is a flag on the (pair, TIN) row, so the control
   measures need no second pass over the fact;
6. a left join from the pairs keeps pairs without sales (NULL sums, zero
   counts), and keeps duplicate pair rows as separate, equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.operators import measures as M
from packlift.operators.exceptions import START_KEYS, exceptions_common_sku, legacy_keep, legacy_lists
from packlift.operators.lookups import add_names
from packlift.operators.pairs import PAIR_KEYS, PromoScope, promo_pairs, promo_scope
from packlift.operators.windows import tag_sales
from packlift.plans.report import report_columns
from packlift.rules import LEGACY_RULES, PromoRules
from packlift.sources.tables import PromoTables

LEGACY_MEASURES = ["sales_quantity_promo", "sales_pack_promo", "acb_promo", "acb_control_period",
                   "sales_promo_control_period", "total_sales", "total_sales_control_period"]
COUNT_MEASURES = ["acb_promo", "acb_control_period"]


def legacy_pairs(t: PromoTables, rules: PromoRules = LEGACY_RULES) -> DataFrame:
    return promo_pairs(t, rules)


def legacy_buyers(t: PromoTables, rules: PromoRules = LEGACY_RULES, scope: PromoScope | None = None) -> DataFrame:
    """Stage 1 per (distinct pair, TIN) with the ``keep`` flag of the
    exclusion list."""
    scope = scope or legacy_scope(t, rules)
    s1 = M.legacy_stage1(tag_sales(t, scope, rules, sale_only=True), rules)
    exc = scope.restrict(exceptions_common_sku(t.exc, scope.sku), "id_client", "id_common_sku")
    flags, listed = legacy_lists(exc, scope.pairs)
    s1 = (s1.join(flags, START_KEYS, "left")
          .join(listed, [*START_KEYS, "tin_buyer"], "left"))
    return s1.select("*", legacy_keep().alias("keep")).drop("n_listed", "null_listed", "is_listed")


def legacy_scope(t: PromoTables, rules: PromoRules = LEGACY_RULES) -> PromoScope:
    return promo_scope(t, rules, "both", distinct=True)


def legacy_participants(t: PromoTables, rules: PromoRules = LEGACY_RULES) -> DataFrame:
    """Buyers who took part: a kept, qualifying promo-window sale, TIN known."""
    b = legacy_buyers(t, rules)
    return (b.where(F.col("keep") & (F.col("n_rule") > 0) & F.col("tin_buyer").isNotNull())
            .select(*PAIR_KEYS, "tin_buyer"))


def legacy_pair_measures(t: PromoTables, rules: PromoRules = LEGACY_RULES,
                         scope: PromoScope | None = None) -> DataFrame:
    """Every pair row (duplicates kept) with the seven measures; a pair without
    matching sales has NULL sums and zero counts."""
    scope = scope or legacy_scope(t, rules)
    per_pair = M.legacy_stage2(legacy_buyers(t, rules, scope))
    out = scope.pairs.join(per_pair, PAIR_KEYS, "left")
    return out.select(*PAIR_KEYS, *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c in COUNT_MEASURES
                                     else F.col(c) for c in LEGACY_MEASURES])


def report_legacy(t: PromoTables, rules: PromoRules = LEGACY_RULES) -> DataFrame:
    """The legacy report's 21 columns."""
    scope = legacy_scope(t, rules)
    return report_columns(add_names(legacy_pair_measures(t, rules, scope), t, scope.sku))
