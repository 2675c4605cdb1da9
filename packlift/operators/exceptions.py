"""Buyer exceptions: three policies over one exception list.

An exception names (client, SKU, buyer TIN, start, end). It is matched to
sales through the SKU's common SKU. The reports disagree on when it applies:

``sale_date``                  the sale date lies inside the exception (the
                               qualifying-sales view);
``sale_date_or_any_in_control`` promo-window sales as above; control-window
                               sales are excluded by *any* exception of their
                               (client, TIN, common SKU), whatever its dates
                               (the promo report);
``promo_start``                the promo's start date lies inside the exception,
                               tested as SQL ``tin NOT IN (list)`` per pair, with
                               its NULL rules (the legacy report).

A NULL TIN never equals anything, so under the first two policies a sale with
NULL TIN is never excluded and exception rows with NULL TIN never apply.

Scale: the exception list may be large. For the date policies it is reduced to
one row per (client, TIN, common SKU) holding that key's *merged* intervals,
clipped to the report's date range; merged intervals are disjoint, so a key
holds at most (days in range)/2 + 1 of them whatever the input size, and one
equi left join (no fan-out) flags each sale. The third policy reads the same
merged intervals: each meets the sorted start dates of its (client, common SKU)
once, so no exception is paired with every promotion of its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXC_KEYS = ["id_client", "tin_buyer", "id_common_sku"]
NULL_TIN_SPREAD = 256    # keys over which rows without a TIN are spread per (client, common SKU)


def exceptions_common_sku(exc: DataFrame, sku_side: DataFrame) -> DataFrame:
    """Exception rows with the common SKU of their SKU (inner join).

    ``sku_side`` is (id_sku, id_common_sku); a report passes only its pairs'
    SKUs, since no other exception can meet one of its sales.
    """
    return exc.join(sku_side, "id_sku").select(
        "id_client", "id_sku", "tin_buyer", "start_date", "end_date", "id_common_sku")


def _islands(exc_cs: DataFrame, lo: Column | None, hi: Column | None, keep_null_tin: bool) -> DataFrame:
    """``EXC_KEYS, s, e``: per key the disjoint union of its exception intervals
    (clipped to ``[lo, hi]`` when given); one row with NULL ends for a key none
    of whose intervals is a valid range.

    Duplicate intervals are dropped first (an aggregate with map-side combine,
    so a hot key costs no more than its distinct intervals); the union is then
    found by a running max of ``e`` in ``s`` order per key.
    """
    valid_s = F.col("start_date") if lo is None else F.greatest(F.col("start_date"), lo)
    valid_e = F.col("end_date") if hi is None else F.least(F.col("end_date"), hi)
    if not keep_null_tin:
        exc_cs = exc_cs.where(F.col("tin_buyer").isNotNull())
    iv = exc_cs.select(*EXC_KEYS, valid_s.alias("s"), valid_e.alias("e")).distinct()
    ok = F.col("s") <= F.col("e")
    w = Window.partitionBy(*EXC_KEYS).orderBy("s", "e")
    prev_end = F.max(F.when(ok, F.col("e"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = ok & (prev_end.isNull() | (F.col("s") > F.date_add(prev_end, 1)))
    return (iv.withColumn("island", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*EXC_KEYS, "island")
        .agg(F.min(F.when(ok, F.col("s"))).alias("s"), F.max(F.when(ok, F.col("e"))).alias("e"))
        .drop("island"))


def merged_intervals(exc_cs: DataFrame, lo: Column | None = None, hi: Column | None = None) -> DataFrame:
    """One row per (client, TIN, common SKU) with ``intervals``: the union of
    its exception intervals (clipped to ``[lo, hi]`` when given), as disjoint
    ``struct(s, e)`` (possibly empty when none is a valid range).

    Merged intervals are disjoint and at least a day apart, so a key holds at
    most (days spanned)/2 + 1 of them, a bound set by the calendar, not by the
    size of the list.
    """
    return _islands(exc_cs, lo, hi, False).groupBy(*EXC_KEYS).agg(
        F.collect_list(F.when(F.col("s").isNotNull(), F.struct("s", "e"))).alias("intervals"))


def add_flags(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``exc_on_date`` (an exception of the row's key covers its
    ``operation_date``) and ``exc_any`` (its key has any exception) from a
    ``merged_intervals`` table (one row per key: an equi left join, no fan-out).

    A row without a TIN matches no exception; such rows join under spread
    keys of their own, so they do not meet in one task.
    """
    d = F.col("operation_date")
    spread = F.when(F.col("tin_buyer").isNull(), 1 + F.pmod(F.xxhash64(*[c for c in rows.columns if c != "tin_buyer"]),
                                                            F.lit(NULL_TIN_SPREAD))).otherwise(0)
    return (rows.withColumn("_spread", spread)
            .join(keys.withColumn("_spread", F.lit(0).cast("bigint")), [*EXC_KEYS, "_spread"], "left")
            .withColumn("exc_on_date",
                        F.coalesce(F.exists("intervals", lambda iv: d.between(iv["s"], iv["e"])), F.lit(False)))
            .withColumn("exc_any", F.col("intervals").isNotNull())
            .drop("intervals", "_spread"))


def excluded_sql(policy: str) -> str:
    """Exclusion flag of a flagged row under a date policy, as SQL text."""
    if policy == "sale_date":
        return "exc_on_date"
    if policy == "sale_date_or_any_in_control":
        return "CASE WHEN in_promo THEN exc_on_date ELSE exc_any END"
    raise ValueError(f"not a per-row policy: {policy!r}")


def excluded(policy: str) -> F.Column:
    return F.expr(excluded_sql(policy))


START_KEYS = ["id_client", "id_common_sku", "start_date"]


def stabbed_starts(exc_cs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``START_KEYS, tin_buyer``: for each promo start date of a (client, common
    SKU), the TINs (NULL too) that have an exception on that day, each once.

    A merge of two sorted sides in place of a join of intervals with
    promotions. The starts of a (client, common SKU) are one sorted array of
    distinct days; every merged interval meets that row once and takes the
    slice of days inside it. Merged intervals of a TIN are disjoint, so a
    (TIN, start) comes out once: rows grow with merged intervals and with the
    result, whatever the numbers of promotions or of raw exceptions of a key.
    """
    starts = (pairs.select(*START_KEYS).distinct().groupBy("id_client", "id_common_sku")
              .agg(F.sort_array(F.collect_list("start_date")).alias("starts")))
    inside = F.filter("starts", lambda d: d.between(F.col("s"), F.col("e")))
    return (_islands(exc_cs, None, None, True).where(F.col("s").isNotNull())
            .join(starts, ["id_client", "id_common_sku"])
            .select("id_client", "id_common_sku", "tin_buyer", F.explode(inside).alias("start_date")))


def legacy_lists(exc_cs: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ``promo_start`` policy's exclusion lists, in two parts.

    A pair's list depends on its client, common SKU and start only, so it is
    made once per (client, common SKU, start): ``flags`` holds ``n_listed``
    (TINs on the list) and ``null_listed`` (a NULL TIN among them); ``listed``
    the non-NULL TINs.
    """
    stabbed = stabbed_starts(exc_cs, pairs)
    flags = stabbed.groupBy(*START_KEYS).agg(
        F.count(F.lit(1)).alias("n_listed"),
        F.max(F.col("tin_buyer").isNull()).alias("null_listed"))
    listed = stabbed.where(F.col("tin_buyer").isNotNull()).withColumn("is_listed", F.lit(True))
    return flags, listed


def legacy_keep(n_listed="n_listed", null_listed="null_listed", is_listed="is_listed") -> F.Column:
    """SQL ``tin NOT IN (list)`` as a keep flag: an empty list keeps every
    row (NULL TIN too); otherwise a NULL TIN, a TIN on the list, or any NULL on
    the list make the predicate NULL or false."""
    empty = F.coalesce(F.col(n_listed), F.lit(0)) == 0
    return empty | (F.col("tin_buyer").isNotNull() & ~F.coalesce(F.col(null_listed), F.lit(False))
                    & F.col(is_listed).isNull())
