"""The physical plans we want at scale: one pruned fact scan, hash joins on
equi keys with the window as a residual (never a nested loop or a cartesian
product), two-stage aggregation without Expand, partition pruning on the
year layout."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from packlift import schemas
from packlift.operators.bloom import among
from packlift.operators.exceptions import stabbed_starts
from packlift.operators.pairs import day_bucket, promo_scope
from packlift.operators.windows import tag_sales
from packlift.plans import legacy as L
from packlift.plans import present as P
from packlift.plans import reconcile as C
from packlift.plans import report as R
from packlift.rules import REPORT_RULES
from packlift.sources.tpch import load_tpch
from tests.fixtures import START, TIN_A, Rows, m

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def plan_of(df) -> str:
    """The executed plan; after an action, AQE's final plan only (its printout
    also repeats the initial plan)."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        plan = plan.executedPlan()
    return plan.toString()


@pytest.fixture()
def tables(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return load_tpch(spark, SF)


def _sale_scans(plan: str) -> list[str]:
    """Scans of the sales fact (the only table with the op_year partition)."""
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "op_year#" in ln.split("]")[0]]


@pytest.mark.parametrize("build", [R.report_new, L.report_legacy, C.condition_sales])
def test_no_nested_loop_cartesian_or_expand(tables, build):
    plan = plan_of(build(tables))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "Expand"):
        assert bad not in plan, bad


@pytest.mark.parametrize("build", [R.report_new, L.report_legacy, C.condition_sales])
def test_one_pruned_fact_scan(tables, build):
    df = build(tables)
    df.collect()  # let AQE settle the final plan
    scans = _sale_scans(plan_of(df))
    assert len(scans) == 1, (len(scans), [s[:300] for s in scans])
    scan = scans[0]
    # the windows' date range is found when the report runs, and reaches the reader
    assert "operation_date" in scan.split("DataFilters")[1] and "subquery" in scan.split("DataFilters")[1].lower()
    assert "dynamicpruning" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    # only the columns the report needs reach the reader
    schema = scan.split("ReadSchema: ")[1]
    assert "delete_date" in schema and "quantity" in schema


def _scanned(spark, build, tables) -> dict[str, int]:
    """How often each input table is read by the report and by the storing of its scope."""
    seen = {}
    plans = []
    from packlift.operators import pairs

    plain = pairs.shared_table

    def watched(df, name):
        plans.append(plan_of(df))
        return plain(df, name)

    pairs.shared_table = watched
    try:
        df = build(tables)
    finally:
        pairs.shared_table = plain
    df.collect()
    plans.append(plan_of(df))
    for plan in plans:
        for name in schemas.TABLES:
            seen[name] = seen.get(name, 0) + plan.count(f"/{name}]")
    return seen


@pytest.mark.parametrize("build", [R.report_new, L.report_legacy, C.condition_sales, C.recon_by_tin,
                                   lambda t: P.hot_by_tin(t, date(2024, 6, 30))])
def test_promotions_links_and_skus_are_scanned_once(spark, tables, build):
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # the plan as it is run, with nothing left out
    try:
        seen = _scanned(spark, build, tables)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert (seen["promo"], seen["lnk"], seen["sku"], seen["sale"]) == (1, 1, 1, 1), seen


def test_days_without_a_window_are_not_read(spark):
    """The range of the windows' dates skips row groups of the fact, and years without a window are not opened."""
    import tempfile

    days = 720
    sale = spark.range(0, 400_000, 1, 1).select(
        F.lit(10).cast("long").alias("id_sku"), F.lit(16).alias("id_client"), F.col("id").alias("tin_buyer"),
        F.expr(f"date_add(DATE'2023-01-01', CAST(id * {days} / 400000 AS INT))").alias("operation_date"),
        F.lit(3).cast("decimal(18,3)").alias("quantity"), F.lit(4).alias("id_operation_type"),
        F.lit(date(2000, 1, 1)).alias("delete_date"), F.expr(f"year(date_add(DATE'2023-01-01', CAST(id * {days} / 400000 AS INT)))").alias("op_year"))
    root = tempfile.mkdtemp(prefix="packlift-prune-", dir="/tmp")
    sale.write.option("parquet.block.size", "200000").partitionBy("op_year").parquet(f"{root}/sale")
    t = Rows().tables(spark)
    t.sale = spark.read.parquet(f"{root}/sale")
    df = C.condition_sales(t)
    assert df.count() > 0
    df.collect()
    read = {}

    def walk(node):
        if node.nodeName().startswith("Scan") and "op_year" in node.toString():
            read[node.id()] = (node.metrics().get("numOutputRows").get().value(), node.metrics().get("numPartitions").get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        for inner in ("executedPlan", "plan"):
            try:
                walk(getattr(node, inner)())
            except Exception:
                continue

    walk(df._jdf.queryExecution().executedPlan())
    (rows, years), = read.values()
    assert years == 1 and rows < 400_000 / days * 11 * 5, (rows, years)


def test_sales_meet_the_windows_near_their_day(spark):
    """Three years, fifty promotions of one (common SKU, client): the rows that the join brings
    together are at most three times those inside a window (all history would be fifty times)."""
    start = [date(2022, 1, 1) + timedelta(days=21 * i) for i in range(50)]
    rows = Rows(promo=[(i, 1, 16, d, d + timedelta(days=10 + i % 9), None) for i, d in enumerate(start)],
                lnk=[(i, 1, None) for i in range(50)])
    for i in range(3 * 365):
        rows.sell(TIN_A, date(2022, 1, 1) + timedelta(days=i), 3)
    t = rows.tables(spark)
    scope = promo_scope(t, REPORT_RULES, "both")
    kept = tag_sales(t, scope, REPORT_RULES).count()
    sales = t.sale.select("id_client", F.year("operation_date").alias("op_year"), day_bucket("operation_date").alias("bucket"))
    met = sales.join(scope.unfolded(), ["id_client", "op_year", "bucket"]).count()
    assert kept > 1000 and met <= 3 * kept, (met, kept)
    # exactly the pairs whose window holds the sale's day
    valid = scope.valid().collect()
    assert kept == sum(p["window_start"] <= s[3] <= p["end_date"] for s in rows.sale for p in valid)


def test_report_fact_joins_are_equi_joins(tables):
    df = R.report_new(tables)
    df.collect()
    plan = plan_of(df)
    joins = [ln.strip() for ln in plan.splitlines() if "Join" in ln]
    # the window test is a residual condition of the (client, common SKU, year, bucket)
    # equi join with the pairs, not a filter on a product
    pair_join = [j for j in joins if "window_start" in j]
    assert pair_join and all("Inner" in j for j in pair_join)
    assert all(k in j for j in pair_join for k in ("id_common_sku", "id_client", "op_year", "bucket"))


def test_price_join_reads_one_row_a_group(spark):
    """Sums come before the prices: two prices of a common SKU repeat no sale."""
    rows = Rows(price=[(16, 10, START, m(5), None), (16, 11, START, m(5), None), (16, 11, START, m(7), None)])
    for i in range(200):
        rows.sell(TIN_A, START + timedelta(days=i % 10), 3 + i % 4)
    t = rows.tables(spark)
    plan = C.sold_by_tin(t)._jdf.queryExecution().optimizedPlan().toString()
    top, below = plan.split("Join Inner", 1)
    assert "Aggregate" not in top and below.index("Aggregate") < below.index("Join Inner")
    bonus = C.condition_sales_bonus(t).groupBy(*C.TIN_KEYS, "bonus", "multiple").agg(
        F.sum("sales_quantity").alias("quantity"), F.sum("sum_bonus").alias("sum_bonus"))
    cols = [*C.TIN_KEYS, "bonus", "multiple", "quantity", "sum_bonus"]
    assert (sorted(map(tuple, bonus.select(*cols).collect())) == sorted(map(tuple, C.sold_by_tin(t).select(*cols).collect())))


def test_legacy_list_rows_are_bounded_by_intervals_and_hits(spark):
    """A hot (client, common SKU): 40 promotions, 30 TINs with 50 raw exceptions each. No join brings
    an exception together with every promotion."""
    starts = [START + timedelta(days=i) for i in range(40)]
    exc = spark.createDataFrame([(16, 10, tin, START + timedelta(days=k % 7), START + timedelta(days=k % 7 + 1), 1)
                                 for tin in [*range(29), None] for k in range(50)],
                                "id_client int, id_sku long, tin_buyer long, start_date date, end_date date, id_common_sku int")
    pairs = spark.createDataFrame([(i, 1, 1, 16, d, d) for i, d in enumerate(starts)],
                                  "id_promotion int, id_promotion_type int, id_common_sku int, id_client int, start_date date, end_date date")
    stabbed = stabbed_starts(exc, pairs)
    want = {(tin, d) for tin in [*range(29), None] for d in starts if d <= START + timedelta(days=7)}
    got = [(r["tin_buyer"], r["start_date"]) for r in stabbed.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    joined = stabbed._jdf.queryExecution().executedPlan()
    rows = []

    def walk(node):
        if "Join" in node.nodeName():
            rows.append(node.metrics().get("numOutputRows").get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        for inner in ("finalPhysicalPlan", "plan"):
            try:
                walk(getattr(node, inner)())
            except Exception:
                continue

    walk(joined)
    assert rows and max(rows) <= 30, rows       # one merged interval a TIN meets one row of starts


def test_client_whitelist_pushed_to_scan(tables):
    df = R.report_new(tables)
    scan = _sale_scans(plan_of(df))[0]
    assert "In(id_client" in scan


def test_bloom_filter_lets_every_key_through_and_few_others(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k").unionByName(spark.createDataFrame([(None,)], "k long"))
    found = {r["id"] for r in among(spark.range(0, 30000), "id", keys, "k", 1 << 16).collect()}
    assert set(range(0, 3000, 3)) <= found and len(found) < 1000 + 300


def test_entities_without_sales_are_not_shuffled(spark):
    """A hundred times the sold entities: nearly none but the sold ones leaves the scan, and the sales are read once."""
    from packlift.sources.tables import load_warehouse
    from tests.test_freshness import store

    rows = Rows(entity=[(TIN_A + i, f"E{i}", None) for i in range(30_000)])
    for i in range(300):
        rows.sell(TIN_A + i * 97, START + timedelta(days=i % 10), 3)
    t = load_warehouse(spark, store(spark, rows.tables(spark)))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        df = P.hot_by_tin(t, date(2024, 6, 30))
        got = df.collect()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert sorted(r[P.ENTITY] for r in got) == sorted(f"E{i * 97}" for i in range(300))
    filtered, read, seen = [], {}, set()

    def walk(node):
        key = spark._jvm.System.identityHashCode(node)
        if key in seen:
            return
        seen.add(key)
        name = node.nodeName()
        if name == "Filter" and "getbit" in node.condition().toString():
            filtered.append(node.metrics().get("numOutputRows").get().value())
        if name.startswith("Scan") and "op_year" in node.schema().simpleString():
            read[key] = node.metrics().get("numOutputRows").get().value()
        for part in (node.children(), node.subqueries()):
            for i in range(part.size()):
                walk(part.apply(i))
        for inner in ("executedPlan", "plan", "child"):
            try:
                walk(getattr(node, inner)())
            except Exception:
                continue

    walk(df._jdf.queryExecution().executedPlan())
    assert filtered and max(filtered) <= 330, filtered
    # the filter's keys come from the reconciliation's own aggregate: the sales are read once
    assert sum(read.values()) == 300, read
