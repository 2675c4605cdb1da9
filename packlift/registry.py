"""Every checked query, by name.

Each entry takes the derived input bundle and returns a DataFrame; ``queries``
wraps them as ``(spark, sf_dir) -> DataFrame`` over the test tables. Output
types follow one contract so that another engine's answer can be compared:
decimals become doubles (rounded to 6 places where a division made them
longer), counts and packs are bigints, keys and dates stay as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packlift.functions import expr as X
from packlift.operators import measures as M
from packlift.operators.exceptions import exceptions_common_sku
from packlift.operators.lookups import bonus_prices, client_as_of, client_names
from packlift.operators.pairs import PAIR_KEYS, promo_pairs, promo_scope
from packlift.operators.sinks import append_table, materialize, overwrite_table
from packlift.operators.windows import SALE_COLS, live_sales, tag_sales, window_label, with_common_sku
from packlift.plans import legacy as L
from packlift.plans import present as P
from packlift.plans import reconcile as C
from packlift.plans import report as R
from packlift.plans.views import VIEWS, create_tables, create_views
from packlift.rules import LEGACY_RULES, REPORT_RULES
from packlift.session import ensure_checkpoint_dir
from packlift.sources.tables import PromoTables
from packlift.sources.tpch import load_tpch, tpch_root

# Fixed "today" of every checked query, so that both engines agree.
AS_OF = date(2024, 6, 30)

QueryFn = Callable[[PromoTables], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def contract(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            if f.dataType.scale > 6:
                c = F.round(c, 6)
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn: QueryFn):
        return lambda spark, sf_dir: contract(fn(load_tpch(spark, sf_dir)))
    return ({name: wrap(fn) for name, fn in REGISTRY.items()}
            | {f"view_{name}": _through_view(name) for name in VIEWS})


# --- sources and filters ----------------------------------------------------

@register("src_sales_live")
def _src_sales_live(t):
    return live_sales(t, REPORT_RULES, sale_only=True).select(*SALE_COLS)


@register("promo_base")
def _promo_base(t):
    return promo_pairs(t, REPORT_RULES)


@register("promo_base_legacy")
def _promo_base_legacy(t):
    return L.legacy_pairs(t)


@register("sales_sku")
def _sales_sku(t):
    return with_common_sku(live_sales(t, REPORT_RULES, sale_only=False).select(*SALE_COLS),
                           t.sku.select("id_sku", "id_common_sku"))


@register("exceptions_common_sku")
def _exceptions_common_sku(t):
    return exceptions_common_sku(t.exc, t.sku.select("id_sku", "id_common_sku"))


@register("bonus_prices")
def _bonus_prices(t):
    return bonus_prices(t)


@register("client_distinct")
def _client_distinct(t):
    return client_names(t)


@register("client_as_of")
def _client_as_of(t):
    return client_as_of(t, AS_OF)


# --- windows, rules, exceptions ---------------------------------------------

_SALE_PAIR_COLS = PAIR_KEYS + ["id_sku", "tin_buyer", "operation_date", "quantity", "id_operation_type"]


@register("sales_windows")
def _sales_windows(t):
    tagged = tag_sales(t, promo_scope(t, REPORT_RULES, "both"), REPORT_RULES, sale_only=False)
    return tagged.select(*_SALE_PAIR_COLS, window_label().alias("sales_type"))


@register("qualifying_sales")
def _qualifying_sales(t):
    tagged = tag_sales(t, promo_scope(t, REPORT_RULES, "both"), REPORT_RULES, sale_only=True)
    return tagged.select(
        *_SALE_PAIR_COLS, "multiple", window_label().alias("sales_type"),
        (F.col("quantity") % F.col("multiple")).alias("remainder"),
        X.qualifies(REPORT_RULES).alias("qualifies"),
        X.scored_quantity(REPORT_RULES).alias("sales_quantity"))


@register("legacy_qualifying")
def _legacy_qualifying(t):
    tagged = tag_sales(t, promo_scope(t, LEGACY_RULES, "promo"), LEGACY_RULES, sale_only=True)
    return tagged.select(*_SALE_PAIR_COLS, X.qualifies(LEGACY_RULES).alias("qualifies"))


@register("combined_sales")
def _combined_sales(t):
    return R.combined_sales(R.flagged_sales(t))


@register("sales_packs")
def _sales_packs(t):
    return R.sales_packs(R.combined_sales(R.flagged_sales(t)))


@register("exceptions_anti")
def _exceptions_anti(t):
    return R.conditional_sales(R.flagged_sales(t)).select(*_SALE_PAIR_COLS, window_label().alias("sales_type"))


@register("exceptions_anti_p3")
def _exceptions_anti_p3(t):
    return C.condition_candidates(t).select(*_SALE_PAIR_COLS)


@register("legacy_exceptions")
def _legacy_exceptions(t):
    # Buyers with a promo-window sale (q_tot is the sum over those rows) and
    # whether the pair's NOT IN list keeps them.
    b = L.legacy_buyers(t)
    return b.where(F.col("q_tot").isNotNull()).select(*PAIR_KEYS, "tin_buyer", "keep")


# --- the promo report ---------------------------------------------------------

@register("sales_type_agg")
def _sales_type_agg(t):
    return R.sales_type_agg(t)


@register("report_pivot")
def _report_pivot(t):
    return R.report_pivot(t).drop(*[f"n_{label}" for label, _, _ in M.SALES_TYPES])


@register("report_new")
def _report_new(t):
    return R.report_new(t)


# --- the legacy report ----------------------------------------------------------

def _legacy_measure(name):
    def fn(t):
        return L.legacy_pair_measures(t).select(*PAIR_KEYS, name)
    return fn


for _key, _measure in [("legacy_quantity_promo", "sales_quantity_promo"), ("legacy_pack_promo", "sales_pack_promo"),
                       ("legacy_acb_promo", "acb_promo"), ("legacy_acb_control", "acb_control_period"),
                       ("legacy_quantity_control", "sales_promo_control_period"),
                       ("legacy_total", "total_sales"), ("legacy_total_control", "total_sales_control_period")]:
    register(_key)(_legacy_measure(_measure))


@register("legacy_participants")
def _legacy_participants(t):
    return L.legacy_participants(t)


@register("report_legacy")
def _report_legacy(t):
    return L.report_legacy(t)


# --- qualifying sales and reconciliation -------------------------------------

@register("condition_sales")
def _condition_sales(t):
    return C.condition_sales(t)


@register("condition_sales_bonus")
def _condition_sales_bonus(t):
    return C.condition_sales_bonus(t)


@register("sold_by_tin")
def _sold_by_tin(t):
    return C.sold_by_tin(t)


@register("sold_grouped")
def _sold_grouped(t):
    return C.sold_grouped(t)


@register("results_by_tin")
def _results_by_tin(t):
    return C.results_by_tin(t)


@register("results_grouped")
def _results_grouped(t):
    return C.results_grouped(t)


@register("recon_by_tin")
def _recon_by_tin(t):
    return C.recon_by_tin(t)


@register("recon_by_tin_matched")
def _recon_by_tin_matched(t):
    return C.recon_by_tin(t, matched_only=True)


@register("recon_grouped")
def _recon_grouped(t):
    return C.recon_grouped(t)


@register("recon_grouped_matched")
def _recon_grouped_matched(t):
    return C.recon_grouped(t, matched_only=True)


@register("hot_by_tin")
def _hot_by_tin(t):
    return P.hot_by_tin(t, AS_OF)


@register("hot_grouped")
def _hot_grouped(t):
    return P.hot_grouped(t, AS_OF)


# --- sinks and views ------------------------------------------------------------

def _table(df: DataFrame) -> tuple[str, str]:
    """A table name of its own and a data folder in the shared checkpoint folder."""
    name = f"packlift_{uuid.uuid4().hex}"
    return name, f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/packlift-tables/{name}"


@register("table_appended_twice")
def _table_appended_twice(t):
    df = promo_pairs(t, REPORT_RULES)
    name, path = _table(df)
    append_table(df, name, path)
    append_table(df.select(*reversed(df.columns)), name)
    return df.sparkSession.table(name)


@register("table_overwritten")
def _table_overwritten(t):
    df = C.results_grouped(t)
    name, path = _table(df)
    append_table(df, name, path)
    append_table(df, name)
    overwrite_table(df, name)
    return df.sparkSession.table(name)


@register("table_materialized")
def _table_materialized(t):
    df = R.report_new(t)
    return materialize(df, *_table(df))


def _through_view(name: str):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = tpch_root(spark, sf_dir)
        database = f"packlift_{root.rsplit('/', 1)[1]}"
        create_tables(spark, root, database)
        return contract(create_views(spark, database, AS_OF)[name])
    return fn
