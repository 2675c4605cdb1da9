"""The warehouse path: the sales fact written in the year layout, read back
with the declared schemas, and restricted to a date range that prunes whole
year partitions."""

from __future__ import annotations

import tempfile
from dataclasses import fields
from datetime import date

from packlift.plans import report as R
from packlift.sources.tables import live, load_warehouse, sale_in_range, write_sales_layout
from tests.fixtures import TIN_A, TIN_B, Rows


def test_layout_round_trip_and_pruning(spark):
    rows = (Rows().sell(TIN_A, "2024-01-12", 3).sell(TIN_B, "2023-06-01", 5)
            .sell(TIN_B, "2022-03-01", 7).sell(TIN_A, "2024-01-05", 4))
    t = rows.tables(spark)
    root = tempfile.mkdtemp(prefix="packlift-wh-", dir="/tmp")
    for f in fields(t):
        df = getattr(t, f.name)
        if f.name == "sale":
            write_sales_layout(df, f"{root}/sale")
        else:
            df.write.parquet(f"{root}/{f.name}")
    w = load_warehouse(spark, root)
    assert sorted(r["op_year"] for r in w.sale.select("op_year").distinct().collect()) == [2022, 2023, 2024]
    assert w.sale.count() == 4

    pruned = sale_in_range(w.sale, date(2024, 1, 1), date(2024, 1, 21))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "op_year" in plan.split("PartitionFilters")[1].split("]")[0]
    assert pruned.count() == 2

    # the report reads the warehouse copy exactly as the in-memory tables
    assert sorted(map(tuple, R.report_new(w).collect()), key=repr) == \
        sorted(map(tuple, R.report_new(t).collect()), key=repr)


def test_live_styles(spark):
    t = Rows().sell(TIN_A, "2024-01-12", 3).sell(TIN_A, "2024-01-12", 3, deleted=True).tables(spark)
    assert live(t.sale, "sentinel", date(2000, 1, 1)).count() == 1
    assert live(t.promo).count() == 1


def test_line_items_meet_orders_once(spark, monkeypatch):
    """Sales, exceptions and declared results come from one stored join of line items and orders, and the
    layout's salt is no column of what is shuffled."""
    from pyspark.sql.readwriter import DataFrameWriter

    from packlift.sources.tpch import store_tpch

    written, plain = [], DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        written.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    store_tpch(spark, "/root/testdata/sf0.001", tempfile.mkdtemp(prefix="packlift-store-", dir="/tmp"))
    joins = [p for p in written if "l_orderkey" in p and "o_custkey" in p]
    assert len(joins) == 1, len(joins)
    layout, = [p for p in written if "RepartitionByExpression" in p]
    shuffled = layout.split("RepartitionByExpression", 1)[1].split("\n", 1)[1]
    assert "xxhash64" not in shuffled, shuffled
