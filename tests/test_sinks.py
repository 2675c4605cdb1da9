"""Sinks by table name: append (re-running duplicates rows), overwrite (truncate
and load), materialize (stored copy that later reads use), views (re-run the query)."""

from __future__ import annotations

import tempfile
import uuid
from datetime import date

import pytest

from packlift.operators import sinks
from packlift.plans import present as P
from packlift.plans import report as R
from packlift import schemas
from packlift.plans import reconcile as C
from packlift.plans.views import VIEWS, create_tables, create_views
from packlift.sources.tables import load_warehouse
from tests.fixtures import AS_OF, END, LIVE, START, TIN_A, TIN_B, Rows, m, q
from tests.test_freshness import store


def _target():
    return f"t_{uuid.uuid4().hex}", f"{tempfile.mkdtemp(prefix='packlift-sink-', dir='/tmp')}/data"


@pytest.fixture()
def report(spark):
    return R.report_new(Rows().sell(TIN_A, "2024-01-12", 3).tables(spark))


def test_append_twice_duplicates(spark, report):
    name, path = _target()
    sinks.append_table(report, name, path)
    sinks.append_table(report.select(*reversed(report.columns)), name)
    got = spark.table(name)
    assert got.count() == 2 * report.count() and got.distinct().count() == report.distinct().count()


def test_append_refuses_other_columns(spark, report):
    name, path = _target()
    sinks.append_table(report, name, path)
    with pytest.raises(ValueError):
        sinks.append_table(report.drop("bonus"), name)


def test_overwrite_replaces(spark, report):
    name, path = _target()
    sinks.append_table(report, name, path)
    sinks.append_table(report, name)
    sinks.overwrite_table(report, name)
    assert spark.table(name).count() == report.count()


def _failing(spark, report, name):
    from pyspark.sql import functions as F

    return report.withColumn("id_client", F.when(F.col("id_client") > 0, F.raise_error(F.lit("lost"))).cast("int"))


def test_a_failed_overwrite_leaves_the_old_rows(spark, report):
    name, path = _target()
    sinks.append_table(report, name, path)
    old = sorted(map(tuple, spark.table(name).collect()))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_table(_failing(spark, report, name), name)
    assert sorted(map(tuple, spark.table(name).collect())) == old
    assert sorted(map(tuple, spark.newSession().table(name).collect())) == old


def test_a_frame_that_reads_its_own_target_can_be_stored(spark, report):
    name, path = _target()
    sinks.append_table(report, name, path)
    for n in (2, 4, 8):
        own = spark.table(name)
        sinks.overwrite_table(own.unionByName(own), name)
        assert spark.table(name).count() == n * report.count()
        assert spark.newSession().table(name).count() == n * report.count()


def test_readers_of_the_replaced_rows_can_finish(spark, report):
    name, path = _target()
    sinks.append_table(report, name, path)
    reader = spark.table(name)
    sinks.overwrite_table(report.limit(0), name)
    assert reader.count() == report.count() and spark.table(name).count() == 0
    sinks.append_table(report, name)
    assert spark.table(name).count() == report.count()


def test_a_table_of_the_warehouse_folder_is_replaced(spark, report):
    name, _ = _target()
    sinks.append_table(report, name)
    sinks.overwrite_table(report.unionByName(report), name)
    sinks.overwrite_table(report, name)
    assert spark.table(name).count() == report.count()
    spark.sql(f"DROP TABLE {name}")


def test_materialize_reads_back_the_same_rows(spark, report):
    stored = sinks.materialize(report, *_target())
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, report.collect()))
    assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()


def _warehouse(spark, rows):
    """A catalog over the rows, and the tables as a report reads them."""
    root = store(spark, rows.tables(spark))
    database = f"db_{uuid.uuid4().hex}"
    create_tables(spark, root, database)
    return root, database


REPORTS = {"condition_sales": C.condition_sales, "recon_by_tin": C.recon_by_tin, "recon_grouped": C.recon_grouped,
           "hot_by_tin": lambda t: P.hot_by_tin(t, AS_OF), "hot_grouped": lambda t: P.hot_grouped(t, AS_OF)}


def _same(view, report):
    assert view.columns == report.columns
    assert [f.dataType for f in view.schema] == [f.dataType for f in report.schema]
    assert sorted(map(tuple, view.collect()), key=repr) == sorted(map(tuple, report.collect()), key=repr)


def test_views_equal_the_reports_and_see_appended_rows_from_another_session(spark):
    rows = Rows(result=[(10, 16, TIN_A, START, END, 3, m(5), q(6))], exc=[(16, 10, TIN_B, START, START)],
                price=[(16, 10, START, m(5), None), (16, 11, START, m(5), None), (16, 11, START, m(7), None)])
    rows.sell(TIN_A, "2024-01-12", 3).sell(TIN_B, "2024-01-11", 3).sell(TIN_B, "2024-01-12", 7).sell(None, "2024-01-13", 5)
    root, database = _warehouse(spark, rows)
    create_views(spark, database, AS_OF)
    other = spark.newSession()
    for name, report in REPORTS.items():
        _same(other.table(f"{database}.{name}"), report(load_warehouse(spark, root)))
    before = {name: other.table(f"{database}.{name}").count() for name in VIEWS}
    # A promotion of another client, before all earlier ones, and its sale: no bound of the creation holds.
    day = date(2022, 5, 4)
    more = {"promo": [(9, 0, 35, day, day, None)], "lnk": [(9, 2, None)], "price": [(35, 20, day, m(2), None)],
            "sale": [(20, 35, TIN_A, day, q(4), 4, LIVE, 2022)]}
    for table, data in more.items():
        schema = spark.table(f"{database}.{table}").schema
        spark.createDataFrame(data, schema).write.insertInto(f"{database}.{table}")
    for session in (spark, other, spark.newSession()):
        for table in schemas.TABLES:       # a session that has read a table keeps its file list until told
            session.sql(f"REFRESH TABLE {database}.{table}")
        for name, report in REPORTS.items():
            view = session.table(f"{database}.{name}")
            assert view.count() > before[name]
            _same(view, report(load_warehouse(spark, root)))


def test_a_view_reads_the_one_below_by_name(spark):
    _, database = _warehouse(spark, Rows().sell(TIN_A, "2024-01-12", 3))
    create_views(spark, database)
    spark.sql(f"ALTER VIEW {database}.condition_sales AS SELECT id_client, id_sku, 1 AS id_common_sku, "
              f"operation_date, DATE'2024-01-11' AS start_date, DATE'2024-01-21' AS end_date, 3 AS multiple, "
              f"tin_buyer, quantity * 10 AS sales_quantity FROM {database}.sale")
    assert [r["quantity_sales"] for r in spark.table(f"{database}.recon_by_tin").collect()] == [q(30)]


def test_views_have_the_reports_plan(spark):
    _, database = _warehouse(spark, Rows().sell(TIN_A, "2024-01-12", 3))
    view = create_views(spark, database)["condition_sales"]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "dynamicpruning" in plan


def test_session_views_rerun_their_query(spark, report):
    sinks.as_view(report, "report_view")
    assert sinks.read_view(spark, "report_view").count() == report.count()
