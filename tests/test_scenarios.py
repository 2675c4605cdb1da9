"""Hand scenarios: one per semantic point where the reports differ (the
expected values are worked out by hand from the report definitions)."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.plans import legacy as L
from packlift.plans import present as P
from packlift.plans import reconcile as C
from packlift.plans import report as R
from tests.fixtures import AS_OF, END, START, TIN_A, TIN_B, TIN_C, Rows, d, m, q


def pivot(spark, rows: Rows) -> dict:
    return {r["id_promotion"]: r.asDict() for r in R.report_pivot(rows.tables(spark)).collect()}


def legacy(spark, rows: Rows) -> list[dict]:
    return [r.asDict() for r in L.legacy_pair_measures(rows.tables(spark)).collect()]


def legacy_by_id(spark, rows: Rows) -> dict:
    return {r["id_promotion"]: r for r in legacy(spark, rows)}


def cond(spark, rows: Rows) -> list[dict]:
    return [r.asDict() for r in C.condition_sales(rows.tables(spark)).collect()]


def test_t25_threshold_rule_and_totals(spark):
    rows = Rows().sell(TIN_A, "2024-01-12", 5).sell(TIN_B, "2024-01-13", 2)
    p = pivot(spark, rows)[1]
    assert p["sales_quantity_promo"] == q(5)
    assert p["sales_pack_promo"] == 1
    assert p["acb_promo"] == 1
    assert p["total_sales"] == q(7)
    assert p["sales_pack_total_promo"] == 1
    assert p["acb_total_promo"] == 2


def test_t20_window_edges(spark):
    rows = Rows()
    for day in ["2023-12-31", "2024-01-01", "2024-01-10", "2024-01-11", "2024-01-21", "2024-01-22"]:
        rows.sell(TIN_A, day, 3)
    p = pivot(spark, rows)[1]
    assert p["sales_quantity_promo"] == q(6)
    assert p["sales_promo_control_period"] == q(6)
    assert p["total_sales"] == q(6)
    assert p["total_sales_control_period"] == q(6)


def test_t19_one_day_promo_has_no_control(spark):
    rows = Rows(promo=[(1, 1, 16, START, START, None)])
    rows.sell(TIN_A, "2024-01-10", 3).sell(TIN_A, "2024-01-11", 3)
    p = pivot(spark, rows)[1]
    assert p["sales_quantity_promo"] == q(3)
    assert p["sales_promo_control_period"] is None
    assert p["total_sales_control_period"] is None


def test_t21_end_before_start_gives_nothing(spark):
    rows = Rows(promo=[(1, 1, 16, END, START, None)])
    rows.sell(TIN_A, "2024-01-12", 3).sell(TIN_A, "2024-01-25", 3)
    assert pivot(spark, rows) == {}
    assert R.report_new(rows.tables(spark)).count() == 0
    assert C.condition_sales(rows.tables(spark)).count() == 0


def test_t9_whole_multiples_zero_and_negative(spark):
    rows = Rows(promo=[(1, 0, 36, START, END, None)])  # type 0: multiple 2
    for qty in (4, 3, 0, -2):
        rows.sell(TIN_A, "2024-01-12", qty, client=36)
    p1 = legacy(spark, rows)[0]
    assert p1["sales_quantity_promo"] == q(2)
    assert p1["sales_pack_promo"] == 1          # 2 + 0 - 1
    p2 = pivot(spark, rows)[1]
    assert p2["sales_quantity_promo"] == q(2)   # 4 - 2; the 0 row is dropped
    assert p2["sales_pack_promo"] == 1
    p3 = cond(spark, rows)
    assert [r["sales_quantity"] for r in p3] == [q(4)]


def test_t22_truncation_and_remainder():
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(q(-7), 3), (q(7), 3), (q(-6), 3)], "quantity decimal(18,3), m int")
    got = df.select(X.packs("quantity", "m").alias("p"), (F.col("quantity") % F.col("m")).alias("r")).collect()
    assert [(r["p"], r["r"]) for r in got] == [(-2, q(-1)), (2, q(1)), (-2, q(0))]


def test_t8_totals_by_operation_type(spark):
    rows = Rows().sell(TIN_A, "2024-01-12", -4, op=3).sell(TIN_B, "2024-01-12", 6, op=4)
    assert legacy(spark, rows)[0]["total_sales"] == q(6)
    assert pivot(spark, rows)[1]["total_sales"] == q(2)


def test_t4_type_outside_legacy_rules(spark):
    rows = Rows(promo=[(1, 3, 16, START, END, None)]).sell(TIN_A, "2024-01-12", 5)
    p1 = legacy(spark, rows)[0]
    assert p1["sales_quantity_promo"] is None and p1["acb_promo"] == 0
    p2 = pivot(spark, rows)[1]
    assert p2["sales_quantity_promo"] == q(5) and p2["sales_pack_promo"] == 1


def test_t3_pair_without_sales(spark):
    rows = Rows()
    p1 = legacy(spark, rows)
    assert len(p1) == 1
    r = p1[0]
    assert r["sales_quantity_promo"] is None and r["total_sales"] is None
    assert r["acb_promo"] == 0 and r["acb_control_period"] == 0
    assert pivot(spark, rows) == {}


def test_t1_start_cutoff(spark):
    rows = Rows(promo=[(1, 1, 16, d("2023-10-31"), d("2023-11-10"), None)], lnk=[(1, 1, None)],
                price=[])
    rows.sell(TIN_A, "2023-11-01", 3)
    assert legacy(spark, rows) == []
    assert 1 in pivot(spark, rows)


def test_t2_client_whitelists(spark):
    rows = Rows(promo=[(1, 1, 99, START, END, None), (2, 1, 28, START, END, None)],
                lnk=[(1, 1, None), (2, 1, None)])
    rows.sell(TIN_A, "2024-01-12", 3, client=99).sell(TIN_A, "2024-01-12", 3, client=28)
    p2 = pivot(spark, rows)
    assert set(p2) == {2}
    assert cond(spark, rows) == []
    assert {r["id_promotion"] for r in legacy(spark, rows) if r["sales_quantity_promo"]} == {1, 2}


def test_t5_exception_policies(spark):
    rows = Rows(exc=[
        (16, 11, TIN_A, d("2024-01-15"), d("2024-01-30")),   # covers the sale, not the start
        (16, 10, TIN_B, d("2023-01-01"), d("2023-01-31")),   # a year earlier
    ])
    rows.sell(TIN_A, "2024-01-16", 3)
    rows.sell(TIN_B, "2024-01-12", 3).sell(TIN_B, "2024-01-05", 3)
    p1 = legacy(spark, rows)[0]
    assert p1["sales_quantity_promo"] == q(6)               # both promo sales kept
    assert p1["sales_promo_control_period"] == q(3)         # B took part
    p2 = pivot(spark, rows)[1]
    assert p2["sales_quantity_promo"] == q(3)               # A's sale dropped
    assert p2["sales_promo_control_period"] is None         # B's control sale dropped
    assert p2["total_sales"] == q(6) and p2["total_sales_control_period"] == q(3)
    p3 = cond(spark, rows)
    assert [(r["tin_buyer"], r["sales_quantity"]) for r in p3] == [(TIN_B, q(3))]


def test_t6_null_tin_under_not_in(spark):
    rows = Rows(
        promo=[(1, 1, 16, START, END, None), (2, 1, 35, START, END, None), (3, 1, 28, START, END, None)],
        lnk=[(1, 1, None), (2, 1, None), (3, 1, None)],
        exc=[(35, 10, TIN_A, d("2024-01-01"), d("2024-01-31")),
             (28, 10, None, d("2024-01-01"), d("2024-01-31"))])
    for client in (16, 35, 28):
        rows.sell(None, "2024-01-12", 3, client=client).sell(TIN_B, "2024-01-12", 4, client=client)
    p1 = legacy_by_id(spark, rows)
    assert p1[1]["sales_quantity_promo"] == q(7)      # empty list keeps the NULL TIN sale
    assert p1[2]["sales_quantity_promo"] == q(4)      # non-empty list drops it
    assert p1[3]["sales_quantity_promo"] is None      # a NULL on the list drops all
    p2 = pivot(spark, rows)
    assert all(p2[i]["sales_quantity_promo"] == q(7) for i in (1, 2, 3))
    assert all(p2[i]["acb_promo"] == 1 for i in (1, 2, 3))


def test_t7_control_buyers(spark):
    rows = Rows().sell(TIN_A, "2024-01-12", 3).sell(TIN_A, "2024-01-05", 2).sell(TIN_B, "2024-01-05", 9)
    p1 = legacy(spark, rows)[0]
    assert p1["sales_promo_control_period"] == q(2) and p1["acb_control_period"] == 1
    p2 = pivot(spark, rows)[1]
    assert p2["sales_promo_control_period"] == q(9) and p2["acb_control_period"] == 1


def test_t10_promo_only(spark):
    rows = Rows().sell(TIN_A, "2024-01-12", 3)
    p2 = pivot(spark, rows)[1]
    assert p2["sales_promo_control_period"] is None and p2["acb_control_period"] is None
    assert legacy(spark, rows)[0]["acb_control_period"] == 0


def test_t11_all_zero_totals(spark):
    rows = Rows().sell(TIN_A, "2024-01-12", 0).sell(TIN_B, "2024-01-05", 0)
    assert legacy(spark, rows)[0]["total_sales"] == q(0)
    assert pivot(spark, rows) == {}


def test_t12_duplicate_link_rows(spark):
    rows = Rows(lnk=[(1, 1, None), (1, 1, None)]).sell(TIN_A, "2024-01-12", 3)
    p1 = legacy(spark, rows)
    assert len(p1) == 2 and p1[0] == p1[1] and p1[0]["sales_quantity_promo"] == q(3)
    p2 = pivot(spark, rows)
    assert len(p2) == 1
    assert p2[1]["sales_quantity_promo"] == q(6) and p2[1]["acb_promo"] == 1


def test_t23_overlapping_promos(spark):
    rows = Rows(promo=[(1, 1, 16, START, END, None), (2, 1, 16, d("2024-01-12"), d("2024-01-20"), None)],
                lnk=[(1, 1, None), (2, 1, None)]).sell(TIN_A, "2024-01-15", 3)
    p2 = pivot(spark, rows)
    assert p2[1]["sales_quantity_promo"] == q(3) and p2[2]["sales_quantity_promo"] == q(3)


def test_t14_price_fan_out(spark):
    rows = Rows(price=[(16, 10, START, m(5), None), (16, 11, START, m(6), None)]).sell(TIN_A, "2024-01-12", 3)
    out = R.report_new(rows.tables(spark)).collect()
    assert sorted(r["bonus"] for r in out) == [m(5), m(6)]
    assert sorted(r["sales_amount_promo"] for r in out) == [Decimal("15"), Decimal("18")]
    sold = C.sold_by_tin(rows.tables(spark)).collect()
    assert sorted((r["bonus"], r["quantity"]) for r in sold) == [(m(5), q(3)), (m(6), q(3))]
    rows.price = [(16, 10, START, m(5), None), (16, 11, START, m(5), None)]
    sold = C.sold_by_tin(rows.tables(spark)).collect()
    assert [(r["bonus"], r["quantity"]) for r in sold] == [(m(5), q(6))]


def test_t13_deleted_sku(spark):
    rows = Rows(sku=[(10, 1, None), (11, 1, d("2023-06-01"))],
                price=[(16, 11, START, m(7), None), (16, 10, START, m(5), None)])
    rows.sell(TIN_A, "2024-01-12", 3, sku=11)
    assert pivot(spark, rows)[1]["sales_quantity_promo"] == q(3)
    assert len(cond(spark, rows)) == 1
    sold = C.sold_by_tin(rows.tables(spark)).collect()
    assert [(r["bonus"], r["quantity"]) for r in sold] == [(m(5), q(3))]


def test_t15_client_versions(spark):
    rows = Rows(client=[(16, "Old Name", None, d("2000-01-01"), d("2020-12-31")),
                        (16, "New Name", None, d("2021-01-01"), d("9999-12-31"))],
                result=[(10, 16, TIN_A, START, END, 3, m(5), q(3))])
    rows.sell(TIN_A, "2024-01-12", 3)
    names = sorted(r["client_name"] for r in R.report_new(rows.tables(spark)).collect())
    assert names == ["New Name", "Old Name"]
    hot = P.hot_by_tin(rows.tables(spark), AS_OF).collect()
    assert [r[P.CLIENT] for r in hot] == ["New Name"]


def test_t16_t17_t18_reconciliation(spark):
    rows = Rows(result=[
        (10, 16, TIN_A, START, END, 3, m(5), q(7)),
        (10, 16, TIN_A, START, END, 4, m(5), q(2)),
        (10, 16, TIN_C, START, END, 3, m(5), q(9)),    # declared, nothing sold
    ])
    rows.sell(TIN_A, "2024-01-12", 6)
    by_tin = C.recon_by_tin(rows.tables(spark)).collect()
    assert len(by_tin) == 2                                    # one sold row, two declared versions
    assert {r["tin_buyer"] for r in by_tin} == {TIN_A}
    v3 = next(r for r in by_tin if r["promo_multiple"] == 3)
    assert v3["sales_sum_bonus"] == Decimal("10")              # 5 * floor(6 / 3)
    assert round(v3["promo_sum_bonus"], 6) == Decimal("11.666667")   # 5 * 7 / 3
    grouped = C.recon_grouped(rows.tables(spark)).collect()
    assert len(grouped) == 2
    g3 = next(r for r in grouped if r["promo_multiple"] == 3)
    assert g3["quantity_promo"] == q(16)                       # 7 + 9 over the group
    hot = {r[P.MULT_DECLARED]: r.asDict() for r in P.hot_grouped(rows.tables(spark), AS_OF).collect()}
    h = hot["2+1"]
    assert h[P.SUM_DECLARED] == Decimal("25")                  # floor(16 / 3) * 5
    assert round(h[P.CORRECTION], 6) == Decimal("16.666667")   # 16/3*5 - 6/3*5


def test_t24_default_entity_name(spark):
    rows = Rows(entity=[(TIN_A, "Gone LLC", d("2023-01-01"))]).sell(TIN_A, "2024-01-12", 3)
    hot = P.hot_by_tin(rows.tables(spark), AS_OF).collect()
    assert [r[P.ENTITY] for r in hot] == ["Одиночные аптеки"]


def test_deleted_sales_and_other_skus_ignored(spark):
    rows = (Rows().sell(TIN_A, "2024-01-12", 3, deleted=True)
            .sell(TIN_A, "2024-01-12", 3, sku=20).sell(TIN_B, "2024-01-12", 4))
    p = pivot(spark, rows)[1]
    assert p["total_sales"] == q(4) and p["acb_total_promo"] == 1


def test_report_columns_and_amounts(spark):
    rows = Rows().sell(TIN_A, "2024-01-12", 6).sell(TIN_B, "2024-01-03", 3)
    out = R.report_new(rows.tables(spark))
    assert out.columns == R.REPORT_COLUMNS
    r = out.collect()[0]
    assert r["promotion_type_name"] == "2+1" and r["client_name"] == "Pharma One"
    assert r["common_sku_name"] == "Aspirin" and r["bonus"] == m(5)
    assert r["sales_amount_promo"] == Decimal("30") and r["sales_amount_pack_promo"] == Decimal("10")
    assert r["sales_promo_control_period"] == q(3) and r["sales_amount_promo_control_period"] == Decimal("15")
    assert r["start_date"] == START and r["end_date"] == END
    assert date(2024, 1, 1) == X_control_start(spark)


def X_control_start(spark):
    df = spark.createDataFrame([(START, END)], "start_date date, end_date date")
    return df.select(X.control_start().alias("c")).first()["c"]


def test_rules_are_data(spark):
    from packlift.rules import REPORT_RULES

    rows = Rows(promo=[(1, 0, 36, START, END, None), (2, 1, 28, START, END, None)],
                lnk=[(1, 1, None), (2, 1, None)])
    rows.sell(TIN_A, "2024-01-12", 3, client=36).sell(TIN_A, "2024-01-12", 4, client=28)
    t = rows.tables(spark)
    default = {r["id_promotion"]: r for r in R.report_pivot(t).collect()}
    assert default[1]["sales_quantity_promo"] is None        # 3 is not a whole multiple of 2
    assert default[2]["sales_quantity_promo"] == q(4)
    variant = REPORT_RULES.with_(clients=(36,), whole_multiple_clients=())
    got = {r["id_promotion"]: r for r in R.report_pivot(t, variant).collect()}
    assert set(got) == {1}                                    # client 28 left the whitelist
    assert got[1]["sales_quantity_promo"] == q(3)             # threshold rule: 3 >= 2
