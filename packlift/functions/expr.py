"""Column expressions of the promo domain.

All of them are built-in Spark column functions, so they stay inside
whole-stage codegen; none needs a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packlift.rules import PromoRules


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Each rule is stated once, as SQL expression text over column names; the
# Column helpers below wrap it with ``F.expr``, and the generated per-type
# measures compose the text (one parse per expression instead of a driver
# round trip per operator).

def _ints(xs) -> str:
    return ", ".join(str(int(x)) for x in xs)


def multiple_sql(rules: PromoRules, type_col: str = "id_promotion_type") -> str:
    """Promo multiple: ``type + offset`` (type 0 is "1+1", multiple 2)."""
    return f"({type_col} + {int(rules.multiple_offset)})"


def control_start_sql(start: str = "start_date", end: str = "end_date") -> str:
    """First day of the control window: ``start - (end - start)``.

    The control window ``[control_start, start - 1]`` is one day shorter than
    the promo window and empty for a one-day promo; it touches the promo
    window, so the two together are ``[control_start, end]``.
    """
    return f"date_sub({start}, datediff({end}, {start}))"


def qualifies_sql(rules: PromoRules, q: str = "quantity", m: str = "multiple", client: str = "id_client",
                  type_col: str = "id_promotion_type") -> str:
    """Quantity rule: whole multiples for the listed clients, else ``q >= m``.

    With ``rules.rule_types`` set, other promo types yield NULL (never true),
    as a rule table without an ``else`` branch does.
    """
    rule = f"{q} >= {m}"
    if rules.whole_multiple_clients:
        rule = f"CASE WHEN {client} IN ({_ints(rules.whole_multiple_clients)}) THEN {q} % {m} = 0 ELSE {rule} END"
    if rules.rule_types is not None:
        rule = f"CASE WHEN {type_col} IN ({_ints(rules.rule_types)}) THEN {rule} END"
    return rule


def scored_sql(rules: PromoRules, q: str = "quantity", m: str = "multiple", client: str = "id_client",
               type_col: str = "id_promotion_type") -> str:
    """Quantity if the rule holds, else 0."""
    return f"CASE WHEN {qualifies_sql(rules, q, m, client, type_col)} THEN {q} ELSE 0 END"


def packs_sql(q: str, m: str) -> str:
    """Whole packs ``trunc(q / m)`` as SQL text (see ``packs``)."""
    return f"CAST(({q}) / ({m}) AS BIGINT)"


def multiple(rules: PromoRules, type_col: str = "id_promotion_type") -> Column:
    return F.expr(multiple_sql(rules, type_col))


def control_start(start: str = "start_date", end: str = "end_date") -> Column:
    return F.expr(control_start_sql(start, end))


def qualifies(rules: PromoRules, q: str = "quantity", m: str = "multiple", client: str = "id_client",
              type_col: str = "id_promotion_type") -> Column:
    return F.expr(qualifies_sql(rules, q, m, client, type_col))


def scored_quantity(rules: PromoRules, q: str = "quantity", m: str = "multiple", client: str = "id_client",
                    type_col: str = "id_promotion_type") -> Column:
    return F.expr(scored_sql(rules, q, m, client, type_col))


def packs(q, m) -> Column:
    """Whole packs ``trunc(q / m)``, truncated toward zero (-7 / 3 -> -2).

    ``q`` is a decimal; its division by the integer multiple is exact to well
    below one unit of the quantity's scale, so the cast to bigint (which
    truncates toward zero) gives the integer quotient.
    """
    return (col(q) / col(m)).cast("bigint")


def floor_packs(q, m) -> Column:
    """``floor(q / m)``, as the reconciliation values bonuses (rounds down)."""
    return F.floor(col(q) / col(m))


def ratio_difference(a: tuple, b: tuple) -> Column:
    """``qa * ba / ma - qb * bb / mb`` of two (quantity, bonus, multiple)
    triples; an absent first term counts as 0, an absent second gives NULL.

    Everything is multiplied before the one division, in the widest decimals,
    so thirds are rounded once and nothing is narrowed.
    """
    (qa, ba, ma), (qb, bb, mb) = [[col(c) for c in t] for t in (a, b)]
    first, second = qa * ba, qb * bb
    both = (first * mb - second * ma) / (ma * mb)
    return F.when(first.isNull() | ma.isNull(), -second / mb).otherwise(both)


def promo_label(m) -> Column:
    """``(m - 1) || '+1'``; NULL when the multiple is NULL."""
    return F.concat((col(m) - 1).cast("string"), F.lit("+1"))
