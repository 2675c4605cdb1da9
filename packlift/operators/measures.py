"""Measures per promo pair: quantities, packs and active buyers (ACB).

The promo report wants, per pair and for four sales types (qualifying sales in
the promo / control window, all sales in the promo / control window), the sum
of quantities, the sum of packs and the count of distinct buyer TINs. Four
distinct counts over different filters would make Spark replicate every row
once per count (an Expand) and shuffle the copies; instead:

stage 1  group by (pair, TIN): conditional sums and row counts per type, with
         map-side partial aggregation, so a hot pair or TIN costs one row per
         task before the shuffle;
stage 2  group by pair: add the sums, count the TINs that had a row.

Stage 2 reads only stage 1's output (one row per pair and buyer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.operators.exceptions import excluded_sql
from packlift.operators.pairs import PAIR_KEYS
from packlift.rules import PromoRules

# Sales types, in report order: (label, conditional?, promo window?)
SALES_TYPES = (("promo", True, True), ("control", True, False),
               ("total_promo", False, True), ("total_control", False, False))

# Report column names of the pivot, per sales type: (quantity, packs, acb).
PIVOT_NAMES = {
    "promo": ("sales_quantity_promo", "sales_pack_promo", "acb_promo"),
    "control": ("sales_promo_control_period", "sales_pack_control", "acb_control_period"),
    "total_promo": ("total_sales", "sales_pack_total_promo", "acb_total_promo"),
    "total_control": ("total_sales_control_period", "sales_pack_total_control", "acb_total_control"),
}


# The two kinds of sums of one row or group: conditional (rule and exceptions) and total.
KINDS = ("cond", "total")
PART_COLS = [f"{m}_{kind}" for kind in KINDS for m in ("q", "p", "n")]


def parts(tagged: DataFrame, rules: PromoRules) -> DataFrame:
    """Per tagged row and kind ``k``: ``q_k`` (quantity it contributes, NULL if
    it does not count), ``p_k`` (its packs) and ``n_k`` (1 if it counts, else
    0), for the sales type of its window (``in_promo``). The exception list is
    not applied yet.

    Conditional types: sales only and the quantity rule met; totals: every
    row. A row whose scored quantity is 0 counts for no type, so one of
    quantity 0 counts for none and is left out where it is read.
    """
    scored = X.scored_sql(rules)
    exprs = []
    for kind in KINDS:
        conditional = kind == "cond"
        q = f"({scored})" if conditional else "quantity"
        flag = f"{q} <> 0"
        if conditional:
            flag += f" AND id_operation_type = {int(rules.sale_operation_type)}"
        exprs += [f"CASE WHEN {flag} THEN {q} END AS q_{kind}",
                  f"CASE WHEN {flag} THEN {X.packs_sql(q, 'multiple')} END AS p_{kind}",
                  f"CAST({flag} AS BIGINT) AS n_{kind}"]
    return (tagged.where(F.col("quantity") != 0)
            .selectExpr(*PAIR_KEYS, "tin_buyer", "operation_date", "in_promo", *exprs))


def combine_parts(rows: DataFrame) -> DataFrame:
    """Pre-aggregate ``parts`` to (pair, TIN, sale date): every exception
    policy gives one answer per such group, so the exception join can run on
    the groups instead of the rows. Map-side partial aggregation makes a hot
    buyer cost at most (its pairs x days) rows per task. A day lies in one
    window, so a group has the sums of that window only."""
    return (rows.groupBy(*PAIR_KEYS, "tin_buyer", "operation_date", "in_promo")
            .agg(*[F.expr(f"sum({c}) AS {c}") for c in PART_COLS]))


def stage1(flagged: DataFrame, rules: PromoRules) -> DataFrame:
    """Group (exception-flagged) parts by (pair, TIN): per type the sum of
    quantities, of packs, and the number of rows that counted; conditional
    types drop what the report's exception policy excludes."""
    keep = f"NOT ({excluded_sql(rules.exception_policy)})"
    aggs = []
    for label, conditional, promo_window in SALES_TYPES:
        kind = "cond" if conditional else "total"
        counts = "in_promo" if promo_window else "NOT in_promo"
        if conditional:
            counts += f" AND {keep}"
        aggs += [f"sum(CASE WHEN {counts} THEN q_{kind} END) AS q_{label}",
                 f"sum(CASE WHEN {counts} THEN p_{kind} END) AS p_{label}",
                 f"sum(CASE WHEN {counts} THEN n_{kind} ELSE 0 END) AS n_{label}"]
    return flagged.groupBy(*PAIR_KEYS, "tin_buyer").agg(*[F.expr(a) for a in aggs])


def stage2(s1: DataFrame) -> DataFrame:
    """Group by pair: the 12 pivot measures plus ``n_<type>`` row counts.

    A type without rows has NULL quantity, packs and ACB; a pair without
    rows of any type is absent.
    """
    aggs, cols = [], list(PAIR_KEYS)
    for label, _, _ in SALES_TYPES:
        qn, pn, an = PIVOT_NAMES[label]
        aggs += [f"sum(q_{label}) AS {qn}", f"sum(p_{label}) AS {pn}", f"sum(n_{label}) AS n_{label}",
                 f"count(CASE WHEN n_{label} > 0 AND tin_buyer IS NOT NULL THEN 1 END) AS _acb_{label}"]
        cols += [qn, pn, f"n_{label}", f"CASE WHEN n_{label} > 0 THEN _acb_{label} END AS {an}"]
    any_rows = "greatest(" + ", ".join(f"n_{label}" for label, _, _ in SALES_TYPES) + ") > 0"
    return (s1.groupBy(*PAIR_KEYS).agg(*[F.expr(a) for a in aggs])
            .where(any_rows).selectExpr(*cols))


def unpivot(s2: DataFrame) -> DataFrame:
    """Stage 2 as one row per (sales type, pair) that has rows."""
    parts = []
    for label, _, _ in SALES_TYPES:
        qn, pn, an = PIVOT_NAMES[label]
        parts.append(F.struct(F.lit(label).alias("sales_type"), F.col(f"n_{label}").alias("n"),
                              F.col(qn).alias("sales_quantity"), F.col(pn).alias("sales_pack"),
                              F.col(an).alias("acb")))
    return (s2.select(*PAIR_KEYS, F.explode(F.array(*parts)).alias("t"))
            .where(F.col("t.n") > 0)
            .select("t.sales_type", *PAIR_KEYS, "t.sales_quantity", "t.sales_pack", "t.acb"))


# --- legacy report -----------------------------------------------------------

def legacy_stage1(tagged: DataFrame, rules: PromoRules) -> DataFrame:
    """Group the (sales-only) tagged rows by (pair, TIN) for the legacy report.

    ``q_rule``/``p_rule``/``n_rule``: promo-window rows meeting the rule;
    ``q_ctrl``/``n_ctrl``: control-window rows (no rule); ``q_tot``,
    ``q_tot_ctrl``: every row of each window.
    """
    promo, control = F.col("in_promo"), ~F.col("in_promo")
    rule = promo & F.coalesce(X.qualifies(rules), F.lit(False))
    q = F.col("quantity")
    return tagged.groupBy(*PAIR_KEYS, "tin_buyer").agg(
        F.sum(F.when(rule, q)).alias("q_rule"),
        F.sum(F.when(rule, X.packs(q, "multiple"))).alias("p_rule"),
        F.count(F.when(rule, F.lit(1))).alias("n_rule"),
        F.sum(F.when(control, q)).alias("q_ctrl"),
        F.count(F.when(control, F.lit(1))).alias("n_ctrl"),
        F.sum(F.when(promo, q)).alias("q_tot"),
        F.sum(F.when(control, q)).alias("q_tot_ctrl"),
    )


def legacy_stage2(s1: DataFrame) -> DataFrame:
    """Group by pair. Needs ``keep`` (exception rule) on the stage-1 rows.

    A buyer took part when a kept row met the rule in the promo window; the
    control measures count only those buyers.
    """
    keep = F.col("keep")
    tin = F.col("tin_buyer").isNotNull()
    took_part = keep & (F.col("n_rule") > 0) & tin
    return s1.groupBy(*PAIR_KEYS).agg(
        F.sum(F.when(keep, F.col("q_rule"))).alias("sales_quantity_promo"),
        F.sum(F.when(keep, F.col("p_rule"))).alias("sales_pack_promo"),
        F.count(F.when(took_part, F.lit(1))).alias("acb_promo"),
        F.count(F.when(took_part & (F.col("n_ctrl") > 0), F.lit(1))).alias("acb_control_period"),
        F.sum(F.when(took_part, F.col("q_ctrl"))).alias("sales_promo_control_period"),
        F.sum("q_tot").alias("total_sales"),
        F.sum("q_tot_ctrl").alias("total_sales_control_period"),
    )
