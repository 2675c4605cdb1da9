"""The reconciliation as catalog views, each over the one below by name:
qualifying sales -> by TIN and grouped -> their presentations.

A view is SQL text over catalog tables (``create_tables``). It holds no files,
bounds, clients or dates of its creation, so whoever reads it, in whatever
session of the catalog, gets the report over the rows that its tables have
then. The plan is that of the DataFrame reports: pairs unfolded to day buckets,
an equi join with the exact window as residual, aggregation below the price
join. Names are as of the day of reading unless a date is given.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from packlift import schemas
from packlift.functions import expr as X
from packlift.operators.pairs import BUCKET_BITS
from packlift.plans import present as P
from packlift.plans.reconcile import CONDITION_COLUMNS, GROUP_KEYS, TIN_KEYS
from packlift.rules import CONDITION_RULES, DEFAULT_ENTITY_NAME, PromoRules

VIEWS = ("condition_sales", "recon_by_tin", "recon_grouped", "hot_by_tin", "hot_grouped")


def create_tables(spark: SparkSession, root: str, database: str) -> None:
    """Name the tables of a warehouse folder (``load_warehouse``'s layout) in the
    catalog; the sales fact is partitioned by ``op_year``. Existing names stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in schemas.TABLES.items():
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
        layout = ""
        if name == "sale":
            columns.append("op_year int")
            layout = "PARTITIONED BY (op_year)"
        if not spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"CREATE TABLE {database}.{name} ({', '.join(columns)}) USING parquet {layout} "
                      f"LOCATION '{root.rstrip('/')}/{name}'")
            if layout:
                spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")


def _list(values) -> str:
    return ", ".join(str(int(v)) for v in values)


def _condition_sales(db: str, rules: PromoRules) -> str:
    width = 1 << BUCKET_BITS
    clients = "" if rules.clients is None else f"AND id_client IN ({_list(rules.clients)})"
    cutoff = "" if rules.start_cutoff is None else f"AND p.start_date >= DATE'{rules.start_cutoff}'"
    positive = "AND s.quantity > 0" if rules.positive_only else ""
    return f"""
WITH pairs AS (
  SELECT l.id_common_sku, p.id_promotion_type, p.id_client, p.start_date, p.end_date,
         explode(sequence(shiftright(unix_date(p.start_date), {BUCKET_BITS}),
                          shiftright(unix_date(p.end_date), {BUCKET_BITS}))) AS bucket
  FROM {db}.lnk l JOIN {db}.promo p ON p.id_promotion = l.id_promotion
  WHERE l.delete_date IS NULL AND p.delete_date IS NULL AND p.end_date >= p.start_date {cutoff} {clients.replace('id_client', 'p.id_client')}),
windows AS (
  SELECT *, explode(sequence(year(greatest(start_date, date_from_unix_date(CAST(bucket * {width} AS INT)))),
                             year(least(end_date, date_from_unix_date(CAST(bucket * {width} + {width - 1} AS INT)))))) AS op_year
  FROM pairs),
sold AS (
  SELECT s.id_sku, s.id_client, s.tin_buyer, s.operation_date, s.quantity, s.op_year, k.id_common_sku,
         shiftright(unix_date(s.operation_date), {BUCKET_BITS}) AS bucket
  FROM {db}.sale s JOIN {db}.sku k ON k.id_sku = s.id_sku
  WHERE s.delete_date = DATE'{rules.live_sentinel}' AND s.id_operation_type = {int(rules.sale_operation_type)}
    {positive} {clients.replace('id_client', 's.id_client')}),
tagged AS (
  SELECT s.*, w.start_date, w.end_date, w.id_promotion_type, {X.multiple_sql(rules, 'w.id_promotion_type')} AS multiple
  FROM sold s JOIN windows w ON w.id_common_sku = s.id_common_sku AND w.id_client = s.id_client
    AND w.op_year = s.op_year AND w.bucket = s.bucket AND s.operation_date BETWEEN w.start_date AND w.end_date),
excepted AS (
  SELECT e.id_client, e.tin_buyer, k.id_common_sku, e.start_date AS exc_start, e.end_date AS exc_end
  FROM {db}.exc e JOIN {db}.sku k ON k.id_sku = e.id_sku),
scored AS (
  SELECT *, {X.scored_sql(rules)} AS sales_quantity
  FROM tagged t LEFT ANTI JOIN excepted e ON e.id_client = t.id_client AND e.tin_buyer = t.tin_buyer
    AND e.id_common_sku = t.id_common_sku AND t.operation_date BETWEEN e.exc_start AND e.exc_end)
SELECT {', '.join(CONDITION_COLUMNS)} FROM scored WHERE sales_quantity > 0"""


def _recon(db: str, sales: str, keys: list[str], declared_bonus: str | None) -> str:
    """Sold left-joined to declared; ``declared_bonus`` is the declared sum, if the view shows it."""
    on = " AND ".join(f"d.{k} = s.{k}" for k in keys)
    cols = ", ".join(keys)
    money = "" if declared_bonus is None else f", {declared_bonus} AS promo_sum_bonus"
    tail = ("s.quantity_sales, s.sales_sum_bonus, d.promo_multiple, d.promo_bonus, d.quantity_promo, d.promo_sum_bonus"
            if declared_bonus else
            "s.quantity_sales, d.quantity_promo, d.promo_multiple, d.promo_bonus, s.sales_sum_bonus")
    return f"""
WITH live_sku AS (SELECT id_sku, id_common_sku FROM {db}.sku WHERE delete_date IS NULL),
prices AS (
  SELECT p.sale_date AS start_date, p.id_client, k.id_common_sku, p.bonus, count(*) AS prices
  FROM {db}.price p JOIN live_sku k ON k.id_sku = p.id_sku WHERE p.delete_date IS NULL
  GROUP BY p.sale_date, p.id_client, k.id_common_sku, p.bonus),
groups AS (
  SELECT {cols}, multiple, sum(sales_quantity) AS quantity, sum(floor(sales_quantity / multiple)) AS packs
  FROM {db}.{sales} GROUP BY {cols}, multiple),
sold AS (
  SELECT {', '.join('g.' + k for k in keys)}, g.multiple AS sales_multiple, p.bonus AS sales_bonus,
         g.quantity * p.prices AS quantity_sales, p.bonus * (g.packs * p.prices) AS sales_sum_bonus
  FROM groups g JOIN prices p ON p.start_date = g.start_date AND p.id_client = g.id_client
    AND p.id_common_sku = g.id_common_sku),
results AS (
  SELECT {cols}, r.multiple AS promo_multiple, r.bonus AS promo_bonus, sum(r.quantity) AS quantity_promo
  FROM {db}.result r JOIN live_sku k ON k.id_sku = r.id_sku GROUP BY {cols}, r.multiple, r.bonus),
declared AS (SELECT *{money} FROM results)
SELECT {', '.join('s.' + k for k in keys)}, s.sales_multiple, s.sales_bonus, {tail}
FROM sold s LEFT JOIN declared d ON {on}"""


def _named(db: str, recon: str, as_of: date | None) -> str:
    day = "current_date()" if as_of is None else f"DATE'{as_of}'"
    return f"""
FROM {db}.{recon} r
LEFT JOIN {db}.common_sku c ON c.id_common_sku = r.id_common_sku AND c.delete_date IS NULL
LEFT JOIN {db}.client n ON n.id_client = r.id_client AND n.delete_date IS NULL
  AND {day} BETWEEN n.valid_from AND n.valid_to"""


def _labelled(columns: list[tuple[str, str]]) -> str:
    return "SELECT " + ",\n  ".join(f"{text} AS `{label}`" for text, label in columns)


def _hot_by_tin(db: str, as_of: date | None) -> str:
    def z(c):
        return f"coalesce(r.{c}, 0)"

    return _labelled([
        ("c.common_sku_name", P.PRODUCT), ("r.id_common_sku", "id_common_sku"), ("n.client_name", P.CLIENT),
        (f"coalesce(e.legal_entity_name, '{DEFAULT_ENTITY_NAME}')", P.ENTITY), ("r.tin_buyer", P.TIN),
        ("r.sales_multiple", P.MULT_OURS), ("r.promo_multiple", P.MULT_DECLARED),
        ("r.start_date", P.START), ("r.end_date", P.END),
        (z("quantity_sales"), P.QTY_OURS), (z("quantity_promo"), P.QTY_DECLARED),
        (z("sales_bonus"), P.BONUS_OURS), (z("promo_bonus"), P.BONUS_DECLARED),
        ("r.promo_multiple - r.sales_multiple", P.MULT_DIFF),
        (f"{z('quantity_promo')} - {z('quantity_sales')}", P.QTY_DIFF),
        (f"{z('promo_bonus')} - {z('sales_bonus')}", P.BONUS_DIFF),
        (z("sales_sum_bonus"), P.SUM_OURS), (z("promo_sum_bonus"), P.SUM_DECLARED),
        (f"{z('promo_sum_bonus')} - {z('sales_sum_bonus')}", P.SUM_DIFF),
    ]) + _named(db, "recon_by_tin", as_of) + f"""
LEFT JOIN {db}.entity e ON e.id_legal_entity = r.tin_buyer AND e.delete_date IS NULL"""


def _hot_grouped(db: str, as_of: date | None) -> str:
    promo, sales = "r.quantity_promo * r.promo_bonus", "r.quantity_sales * r.sales_bonus"
    correction = (f"CASE WHEN {promo} IS NULL OR r.promo_multiple IS NULL THEN -({sales}) / r.sales_multiple "
                  f"ELSE ({promo} * r.sales_multiple - {sales} * r.promo_multiple) / (r.promo_multiple * r.sales_multiple) END")
    return _labelled([
        ("c.common_sku_name", P.PRODUCT), ("r.id_common_sku", "id_common_sku"), ("n.client_name", P.CLIENT),
        ("concat(CAST(r.sales_multiple - 1 AS STRING), '+1')", P.MULT_OURS),
        ("concat(CAST(r.promo_multiple - 1 AS STRING), '+1')", P.MULT_DECLARED),
        ("r.start_date", P.START), ("r.end_date", P.END),
        ("r.quantity_sales", P.QTY_OURS), ("r.quantity_promo", P.QTY_DECLARED),
        ("r.sales_bonus", P.BONUS_OURS), ("r.promo_bonus", P.BONUS_DECLARED),
        ("r.promo_multiple - r.sales_multiple", P.MULT_DIFF),
        ("coalesce(r.quantity_promo, 0) - coalesce(r.quantity_sales, 0)", P.QTY_DIFF),
        ("coalesce(r.promo_bonus, 0) - r.sales_bonus", P.BONUS_DIFF),
        ("r.sales_sum_bonus", P.SUM_OURS), ("floor(r.quantity_promo / r.promo_multiple) * r.promo_bonus", P.SUM_DECLARED),
        (correction, P.CORRECTION),
    ]) + _named(db, "recon_grouped", as_of)


def view_sql(database: str, as_of: date | None = None, rules: PromoRules = CONDITION_RULES) -> dict[str, str]:
    """The five views' SQL texts over the tables of ``database``, in the order to create them."""
    return {
        "condition_sales": _condition_sales(database, rules),
        "recon_by_tin": _recon(database, "condition_sales", TIN_KEYS, "quantity_promo * promo_bonus / promo_multiple"),
        "recon_grouped": _recon(database, "condition_sales", GROUP_KEYS, None),
        "hot_by_tin": _hot_by_tin(database, as_of),
        "hot_grouped": _hot_grouped(database, as_of),
    }


def create_views(spark: SparkSession, database: str, as_of: date | None = None,
                 rules: PromoRules = CONDITION_RULES) -> dict[str, DataFrame]:
    """Create or replace the five views beside the tables of ``database``."""
    for name, text in view_sql(database, as_of, rules).items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text}")
    return {name: spark.table(f"{database}.{name}") for name in VIEWS}
