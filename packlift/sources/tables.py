"""The input bundle, live-row filters and the partitioned sales layout."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packlift import schemas


@dataclass
class PromoTables:
    """Every input table of the reports, already typed and normalised.

    sale        sales fact (id_sku, id_client, tin_buyer, operation_date, quantity,
                id_operation_type, delete_date [, op_year partition column])
    sku         SKU -> common SKU
    common_sku  common SKU names
    promo       promotions
    lnk         promotion -> common SKU links
    exc         buyer exception list
    price       bonus price list
    result      declared promo results
    client      clients, with validity intervals
    promo_type  promotion type names
    entity      legal entities keyed by tax id
    """

    sale: DataFrame
    sku: DataFrame
    common_sku: DataFrame
    promo: DataFrame
    lnk: DataFrame
    exc: DataFrame
    price: DataFrame
    result: DataFrame
    client: DataFrame
    promo_type: DataFrame
    entity: DataFrame


def live(df: DataFrame, style: str = "null", sentinel: date | None = None) -> DataFrame:
    """Keep live rows: ``delete_date IS NULL`` ("null") or ``= sentinel`` ("sentinel")."""
    if style == "null":
        return df.where(F.col("delete_date").isNull())
    if style == "sentinel":
        return df.where(F.col("delete_date") == F.lit(sentinel))
    raise ValueError(f"unknown live style {style!r}")


def sale_in_range(sale: DataFrame, lo: date, hi: date) -> DataFrame:
    """Restrict the sales fact to ``[lo, hi]``.

    The date predicate reaches the Parquet scan as a pushed filter (row-group
    skipping); on the partitioned layout the ``op_year`` predicate also prunes
    whole partitions, which a data-driven window join cannot do by itself.
    """
    out = sale.where(F.col("operation_date").between(F.lit(lo), F.lit(hi)))
    if "op_year" in sale.columns:
        out = out.where(F.col("op_year").between(lo.year, hi.year))
    return out


def write_sales_layout(sale: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the sales fact partitioned by year, clustered by (client, date).

    Range partitioning on (year, client, date) and a salt from the row's other
    columns samples the keys, so neither a client nor a single (client, day)
    that holds a large share of the rows lands in one task; sorting inside each
    file keeps the Parquet min/max statistics tight, so client and date filters
    skip row groups. Columns are brought to the declared types first. The salt
    is an expression of the partitioning, not a column: eight random bytes a row
    are not shuffled.
    """
    typed = sale.select(*[F.col(f.name).cast(f.dataType) for f in schemas.SALE.fields])
    salt = F.xxhash64("id_sku", "tin_buyer", "quantity", "id_operation_type", "delete_date")
    (typed.repartitionByRange(F.year("operation_date"), "id_client", "operation_date", salt)
     .withColumn("op_year", F.year("operation_date"))
     .sortWithinPartitions("op_year", "id_client", "operation_date")
     .write.mode(mode).partitionBy("op_year").parquet(path))


def load_warehouse(spark: SparkSession, root: str) -> PromoTables:
    """Read the tables from ``root/<name>`` with their declared schemas.

    ``sale`` may be the year-partitioned layout of ``write_sales_layout``, whose
    partition column ``op_year`` is found beside the declared ones.
    """
    return PromoTables(**{name: spark.read.schema(schema).parquet(f"{root}/{name}")
                          for name, schema in schemas.TABLES.items()})
