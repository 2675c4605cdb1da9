"""Reports see their tables as they are when they run, large decimals stay
exact, a hot key is split by the layout, and today is the default date."""

from __future__ import annotations

import tempfile
from dataclasses import fields
from datetime import date, timedelta
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from packlift import schemas
from packlift.plans import legacy as L
from packlift.plans import present as P
from packlift.plans import reconcile as C
from packlift.plans import report as R
from packlift.sources.tables import load_warehouse, write_sales_layout
from tests.fixtures import AS_OF, END, LIVE, START, TIN_A, TIN_B, Rows, m, q

REPORTS = {
    "report_new": R.report_new, "report_legacy": L.report_legacy, "condition_sales": C.condition_sales,
    "recon_by_tin": C.recon_by_tin, "recon_grouped": C.recon_grouped,
    "hot_by_tin": lambda t: P.hot_by_tin(t, AS_OF), "hot_grouped": lambda t: P.hot_grouped(t, AS_OF),
}


def store(spark, t) -> str:
    root = tempfile.mkdtemp(prefix="packlift-wh-", dir="/tmp")
    for f in fields(t):
        if f.name == "sale":
            write_sales_layout(t.sale, f"{root}/sale")
        else:
            getattr(t, f.name).write.parquet(f"{root}/{f.name}")
    return root


@pytest.mark.parametrize("name", REPORTS)
def test_a_second_report_sees_new_files(spark, name):
    rows = Rows(price=[(16, 10, START, m(5), None)]).sell(TIN_A, "2024-01-12", 6).sell(TIN_B, "2024-01-13", 3)
    root = store(spark, rows.tables(spark))
    seen = [sorted(map(tuple, REPORTS[name](load_warehouse(spark, root)).collect()), key=repr)]
    more = {
        "exc": [(16, 10, TIN_A, date(2024, 1, 1), date(2024, 2, 1))],
        "price": [(16, 11, START, m(7), None)],
    }
    for table, data in more.items():
        spark.createDataFrame(data, schemas.TABLES[table]).write.mode("append").parquet(f"{root}/{table}")
        seen.append(sorted(map(tuple, REPORTS[name](load_warehouse(spark, root)).collect()), key=repr))
    assert seen[1] != seen[0]
    if name != "condition_sales":      # the one report without prices
        assert seen[2] != seen[1]
    spark.createDataFrame([(2, 1, 16, START, END + timedelta(1), None)], schemas.PROMO).write.mode("append").parquet(f"{root}/promo")
    spark.createDataFrame([(2, 1, None)], schemas.LNK).write.mode("append").parquet(f"{root}/lnk")
    assert len(REPORTS[name](load_warehouse(spark, root)).collect()) > len(seen[2])
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_large_decimals(spark):
    getcontext().prec = 60
    big_bonus, big_quantity = Decimal(10) ** 12, Decimal(10) ** 14
    rows = Rows(price=[(16, 10, START, big_bonus, None)],
                result=[(10, 16, TIN_A, START, END, 3, big_bonus, big_quantity)])
    rows.sell(TIN_A, "2024-01-12", 9)
    t = rows.tables(spark)
    assert C.results_by_tin(t).collect()[0]["sum_bonus"] == (big_bonus * big_quantity / 3).quantize(Decimal("0.000001"))
    row = P.hot_grouped(t, AS_OF).collect()[0]
    assert row[P.CORRECTION] == ((big_bonus * big_quantity - 9 * big_bonus) / 3).quantize(Decimal("0.000001"))
    assert row[P.SUM_DECLARED] == big_bonus * (10 ** 14 // 3)


def test_thirds_are_rounded_once(spark):
    rows = Rows(result=[(10, 16, TIN_A, START, END, 3, m(1), q(1))], price=[(16, 10, START, m(1), None)])
    rows.sell(TIN_A, "2024-01-12", 5)
    assert P.hot_grouped(rows.tables(spark), AS_OF).collect()[0][P.CORRECTION] == Decimal("-1.333333")


def test_layout_splits_a_hot_day(spark):
    n = 40_000
    hot = F.col("id") % 10 != 0
    sale = spark.range(n).select(
        (F.col("id") % 500).alias("id_sku"), F.lit(16).alias("id_client"), (F.col("id") % 3000).alias("tin_buyer"),
        F.when(hot, F.lit(date(2024, 1, 12))).otherwise(F.expr("date_add(DATE '2024-01-01', CAST(id % 300 AS INT))")).alias("operation_date"),
        (F.col("id") % 97).cast("decimal(18,3)").alias("quantity"), F.lit(4).alias("id_operation_type"), F.lit(LIVE).alias("delete_date"))
    root = tempfile.mkdtemp(prefix="packlift-layout-", dir="/tmp")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_sales_layout(sale, f"{root}/sale")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(f"{root}/sale").groupBy(F.input_file_name()).count().collect()
    counts = [r["count"] for r in parts]
    assert sum(counts) == n and len(counts) > 1
    assert max(counts) <= 2.5 * n / len(counts)


def test_today_is_the_default_date(spark):
    today = date.today()
    rows = Rows(client=[(16, "Old", None, date(2000, 1, 1), today - timedelta(2)),
                        (16, "Now", None, today - timedelta(1), today + timedelta(1))])
    rows.sell(TIN_A, "2024-01-12", 3)
    t = rows.tables(spark)
    assert [r[P.CLIENT] for r in P.hot_by_tin(t).collect()] == ["Now"]
    assert [r[P.CLIENT] for r in P.hot_by_tin(t, date(2020, 1, 1)).collect()] == ["Old"]


def test_price_of_an_unknown_sku_stays(spark):
    from packlift.operators.lookups import bonus_prices

    t = Rows(price=[(16, 10, START, m(5), None), (16, 999, START, m(9), None)]).tables(spark)
    assert sorted((r["id_common_sku"], r["bonus"]) for r in bonus_prices(t).collect() if r["id_common_sku"]) == [(1, m(5))]
    assert [r["bonus"] for r in bonus_prices(t).where("id_common_sku IS NULL").collect()] == [m(9)]
