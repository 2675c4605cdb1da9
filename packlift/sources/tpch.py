"""Promotion tables derived from the TPC-H-like test tables.

The test data holds no promotions, so every input of the reports is derived
from ``lineitem``, ``orders``, ``part``, ``nation``, ``region`` and
``customer`` by fixed formulas (FIXTURES.md section 2). The derivation is pure
DataFrame work and scales with the source tables: the sales fact grows with
``lineitem``, the SKU dimension with ``part``.
"""

from __future__ import annotations

import hashlib
import inspect
import sys
import threading
from collections.abc import Callable
from dataclasses import fields
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packlift.session import ensure_checkpoint_dir, shared_table
from packlift.sources.tables import PromoTables, load_warehouse, write_sales_layout

# ---------------------------------------------------------------------------
# Fixed values of the fixture formulas
# ---------------------------------------------------------------------------
# key % 7 -> client id; remainder 6 maps to 99, a client outside every whitelist.
CLIENT_BY_REMAINDER = (16, 28, 35, 36, 37, 418, 99)
SALE_DAY0 = date(2023, 9, 1)        # operation_date = SALE_DAY0 + (orderkey*13 + line*29) % 360
PROMO_DAY0 = date(2023, 9, 20)      # start_date = PROMO_DAY0 + (partkey*37) % 300
DELETED = date(2024, 1, 1)          # delete_date of soft-deleted dimension rows
SALE_DELETED = date(2024, 2, 2)     # delete_date of deleted sales
LIVE_SALE = date(2000, 1, 1)        # live sentinel of the sales fact
TIN_BASE = 7_700_000_000            # tax ids are TIN_BASE + custkey
SKUS_PER_COMMON = 10                # parts 10k .. 10k+9 share common SKU k
# ---------------------------------------------------------------------------


def _client(key):
    c = F.lit(CLIENT_BY_REMAINDER[-1])
    for r in range(len(CLIENT_BY_REMAINDER) - 2, -1, -1):
        c = F.when(key % 7 == r, F.lit(CLIENT_BY_REMAINDER[r])).otherwise(c)
    return c.cast("int")


def _day(day0: date, offset):
    return F.date_add(F.lit(day0), offset.cast("int"))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive_sale(lineitem: DataFrame, orders: DataFrame, keep_keys: bool = False) -> DataFrame:
    """Sales fact: one sale per line item.

    What a line item alone decides is computed before the join. The line number,
    the client's place in ``CLIENT_BY_REMAINDER`` (3 bits) and whether the line
    was returned (1 bit) cross it as one number, since a shuffled row spends
    eight bytes on each field.
    """
    ok, rest = F.col("l_orderkey"), F.col("l_suppkey") % 7
    qty = (F.when(ok % 37 == 0, -F.col("l_quantity"))
           .when(ok % 31 == 0, F.lit(0.0))
           .otherwise(F.col("l_quantity") % 13))
    place = F.when(rest.between(0, len(CLIENT_BY_REMAINDER) - 2), rest).otherwise(len(CLIENT_BY_REMAINDER) - 1)
    returned = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    li = lineitem.select(
        ok, F.col("l_partkey").cast("bigint").alias("id_sku"), qty.cast("decimal(18,3)").alias("quantity"),
        (F.col("l_linenumber").cast("bigint") * 16 + place * 2 + returned).alias("line"))
    line = F.col("line")
    ln = F.shiftright(line, 4)
    place = F.shiftright(line.bitwiseAND(F.lit(15)), 1).cast("int")
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    cols = [
        "id_sku",
        F.get(F.array(*[F.lit(c) for c in CLIENT_BY_REMAINDER]), place).alias("id_client"),
        F.when(ok % 41 == 0, F.lit(None)).otherwise(F.lit(TIN_BASE) + F.col("o_custkey"))
        .cast("bigint").alias("tin_buyer"),
        _day(SALE_DAY0, (ok * 13 + ln * 29) % 360).alias("operation_date"),
        "quantity",
        F.when(line.bitwiseAND(F.lit(1)) == 1, 3).otherwise(4).cast("int").alias("id_operation_type"),
        F.when(ok % 19 == 0, F.lit(SALE_DELETED)).otherwise(F.lit(LIVE_SALE)).alias("delete_date"),
    ]
    if keep_keys:
        cols += [ok, ln.alias("l_linenumber")]
    return li.join(od, "l_orderkey").select(*cols)


def _common(pk):
    return F.floor(pk / SKUS_PER_COMMON).cast("int")


def derive_sku(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    return part.select(
        pk.cast("bigint").alias("id_sku"),
        _common(pk).alias("id_common_sku"),
        F.when(pk % 43 == 42, F.lit(DELETED)).cast("date").alias("delete_date"),
    )


def derive_common_sku(part: DataFrame) -> DataFrame:
    c = part.select(_common(F.col("p_partkey")).alias("id_common_sku")).distinct()
    return c.select(
        "id_common_sku",
        F.concat(F.lit("Common "), F.col("id_common_sku").cast("string")).alias("common_sku_name"),
        F.when(F.col("id_common_sku") % 10 == 9, F.lit(DELETED)).cast("date").alias("delete_date"),
    )


def derive_promo(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    start_off = (pk * 37) % 300
    length = F.when(pk % 20 == 5, F.lit(0)).when(pk % 50 == 7, F.lit(-2)).otherwise(F.col("p_size") % 28)
    return part.select(
        pk.cast("int").alias("id_promotion"),
        (pk % 4).cast("int").alias("id_promotion_type"),
        _client(pk).alias("id_client"),
        _day(PROMO_DAY0, start_off).alias("start_date"),
        _day(PROMO_DAY0, start_off + length).alias("end_date"),
        F.when(pk % 11 == 10, F.lit(DELETED)).cast("date").alias("delete_date"),
    )


def derive_lnk(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    first = part.select(pk.cast("int").alias("id_promotion"), _common(pk).alias("id_common_sku"),
                        F.lit(None).cast("date").alias("delete_date"))
    second = part.select(pk.cast("int").alias("id_promotion"), (_common(pk) + 3).alias("id_common_sku"),
                         F.when(pk % 13 == 12, F.lit(DELETED)).cast("date").alias("delete_date"))
    again = first.where(F.col("id_promotion") % 29 == 3)
    return first.unionByName(second).unionByName(again)


def derive_exc(sale_with_keys: DataFrame) -> DataFrame:
    s = sale_with_keys.where((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 9 == 0)
    length = F.when(F.col("l_orderkey") % 23 == 0, F.lit(-1)).otherwise(F.lit(25))
    start = F.date_sub("operation_date", 5)
    return s.select("id_client", "id_sku", "tin_buyer", start.alias("start_date"),
                    F.date_add(start, length).alias("end_date"))


def derive_pairs(promo: DataFrame, lnk: DataFrame) -> DataFrame:
    p = promo.where(F.col("delete_date").isNull()).drop("delete_date")
    k = lnk.where(F.col("delete_date").isNull()).drop("delete_date")
    return k.join(p, "id_promotion").select("id_promotion", "id_promotion_type", "id_common_sku",
                                            "id_client", "start_date", "end_date")


def derive_price(pairs: DataFrame) -> DataFrame:
    pid = F.col("id_promotion")
    first_sku = F.col("id_common_sku").cast("bigint") * SKUS_PER_COMMON
    base = [F.col("id_client"), first_sku.alias("id_sku"), F.col("start_date").alias("sale_date")]
    live_price = pairs.where(pid % 8 != 7).select(
        *base, (10 + pid % 7).cast("decimal(18,2)").alias("bonus"), F.lit(None).cast("date").alias("delete_date"))
    deleted = pairs.where(pid % 9 == 0).select(
        *base, F.lit(99).cast("decimal(18,2)").alias("bonus"), F.lit(DELETED).alias("delete_date"))
    fan_out = pairs.where(pid % 17 == 0).select(
        F.col("id_client"), (first_sku + 1).alias("id_sku"),
        F.col("start_date").alias("sale_date"), F.lit(12.5).cast("decimal(18,2)").alias("bonus"),
        F.lit(None).cast("date").alias("delete_date"))
    unknown_sku = pairs.where(pid % 23 == 0).select(
        F.col("id_client"), (-1 - first_sku).alias("id_sku"),
        F.col("start_date").alias("sale_date"), F.lit(7).cast("decimal(18,2)").alias("bonus"),
        F.lit(None).cast("date").alias("delete_date"))
    return live_price.unionByName(deleted).unionByName(fan_out).unionByName(unknown_sku)


def derive_result(sale: DataFrame, sku: DataFrame, pairs: DataFrame) -> DataFrame:
    s = sale.where((F.col("quantity") >= 2) & (F.col("id_operation_type") == 4)
                   & (F.col("tin_buyer") % 5 != 0))
    j = (s.join(sku.select("id_sku", "id_common_sku"), "id_sku")
         .join(pairs, ["id_common_sku", "id_client"])
         .where(F.col("operation_date").between(F.col("start_date"), F.col("end_date"))))
    pid, tin = F.col("id_promotion"), F.col("tin_buyer")
    return j.select(
        (F.col("id_common_sku").cast("bigint") * SKUS_PER_COMMON).alias("id_sku"),
        "id_client", "tin_buyer", "start_date", "end_date",
        (F.col("id_promotion_type") + F.when(pid % 6 == 5, 3).otherwise(2)).cast("int").alias("multiple"),
        (10 + pid % 7).cast("decimal(18,2)").alias("bonus"),
        (F.col("quantity") + F.when(tin % 3 == 0, 1).otherwise(0)).cast("decimal(18,3)").alias("quantity"),
    )


def derive_client(nation: DataFrame) -> DataFrame:
    nk = F.col("n_nationkey")
    current = nk < 7
    return nation.select(
        _client(nk).alias("id_client"),
        F.col("n_name").alias("client_name"),
        F.when(nk == 9, F.lit(DELETED)).cast("date").alias("delete_date"),
        F.when(current, F.lit(date(2021, 1, 1))).otherwise(F.lit(date(2000, 1, 1))).alias("valid_from"),
        F.when(current, F.lit(date(9999, 12, 31))).otherwise(F.lit(date(2020, 12, 31))).alias("valid_to"),
    )


def derive_promo_type(region: DataFrame) -> DataFrame:
    return region.select(
        F.col("r_regionkey").cast("int").alias("id_promotion_type"),
        F.concat((F.col("r_regionkey") + 1).cast("string"), F.lit("+1")).alias("promotion_type_name"),
    )


def derive_entity(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    return customer.select(
        (F.lit(TIN_BASE) + ck).cast("bigint").alias("id_legal_entity"),
        F.col("c_name").alias("legal_entity_name"),
        F.when(ck % 10 == 9, F.lit(DELETED)).cast("date").alias("delete_date"),
    )


def derive_tpch(spark: SparkSession, sf_dir: str, stage: Callable[[DataFrame, str], DataFrame] | None = None) -> PromoTables:
    """Every report input as a DataFrame over the test tables in ``sf_dir``.

    Sales, exceptions and declared results all come from the join of line items
    and orders; ``stage(df, name)`` may store it, so that it is shuffled once.
    """
    lineitem = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders")
    part = _read(spark, sf_dir, "part")
    sale_k = derive_sale(lineitem, orders, keep_keys=True)
    if stage is not None:
        sale_k = stage(sale_k, "sale-keyed")
    sale = sale_k.drop("l_orderkey", "l_linenumber")
    sku = derive_sku(part)
    promo = derive_promo(part)
    lnk = derive_lnk(part)
    pairs = derive_pairs(promo, lnk)
    return PromoTables(
        sale=sale,
        sku=sku,
        common_sku=derive_common_sku(part),
        promo=promo,
        lnk=lnk,
        exc=derive_exc(sale_k),
        price=derive_price(pairs),
        result=derive_result(sale, sku, pairs),
        client=derive_client(_read(spark, sf_dir, "nation")),
        promo_type=derive_promo_type(_read(spark, sf_dir, "region")),
        entity=derive_entity(_read(spark, sf_dir, "customer")),
    )


SOURCES = ("lineitem", "orders", "part", "nation", "region", "customer")
_STORE_LOCK = threading.Lock()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Name of the stored copy: this derivation, the source paths, their sizes and times."""
    h = hashlib.sha1(sf_dir.encode() + inspect.getsource(sys.modules[__name__]).encode())
    for name in SOURCES:
        fs, p = _fs(spark, f"{sf_dir}/{name}.parquet")
        st = fs.getContentSummary(p)
        h.update(f"{name}:{st.getLength()}:{fs.getFileStatus(p).getModificationTime()}".encode())
    return h.hexdigest()[:16]


def store_tpch(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Write the derived inputs under ``root`` in the warehouse layout (the
    sales fact partitioned by year), then a completion marker."""
    t = derive_tpch(spark, sf_dir, shared_table)
    for f in fields(t):
        df = getattr(t, f.name)
        if f.name == "sale":
            write_sales_layout(df, f"{root}/sale")
        else:
            df.write.mode("overwrite").parquet(f"{root}/{f.name}")
    fs, p = _fs(spark, f"{root}/_COMPLETE")
    fs.create(p, True).close()


def tpch_root(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the stored inputs for the test tables in ``sf_dir``, derived if not there yet."""
    ckpt = ensure_checkpoint_dir(spark)
    with _STORE_LOCK:
        root = f"{ckpt.rstrip('/')}/packlift-inputs/{_fingerprint(spark, sf_dir)}"
        fs, marker = _fs(spark, f"{root}/_COMPLETE")
        if not fs.exists(marker):
            store_tpch(spark, sf_dir, root)
    return root


def load_tpch(spark: SparkSession, sf_dir: str, stored: bool = True) -> PromoTables:
    """Report inputs for the test tables in ``sf_dir``.

    ``stored=True`` (default): derived once and written to the shared
    checkpoint folder (``spark.checkpoint.dir``) in the warehouse layout, then
    read from there, as reports read warehouse tables; later calls with the
    same, unchanged source files reuse the copy. ``stored=False``: the
    derivation itself, as one lazy plan per table.
    """
    if not stored:
        return derive_tpch(spark, sf_dir)
    return load_warehouse(spark, tpch_root(spark, sf_dir))
