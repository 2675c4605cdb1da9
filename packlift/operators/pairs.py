"""Promo pairs: one live (promotion, common SKU) row with the promo's terms,
and the scope they give a report: which clients, dates and SKUs can match."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packlift.functions import expr as X
from packlift.rules import PromoRules
from packlift.session import shared_table
from packlift.sources.tables import PromoTables, live

PAIR_KEYS = ["id_promotion", "id_promotion_type", "id_common_sku", "id_client", "start_date", "end_date"]

# Sales and windows meet in buckets of 2^4 = 16 days. A window unfolds to (its days) / 16 + 2 buckets at most; a
# sale meets the windows that touch its bucket, of which those that do not hold its day are the join's residual.
BUCKET_BITS = 4


def promo_pairs(t: PromoTables, rules: PromoRules | None = None) -> DataFrame:
    """Live link rows joined to live promotions (duplicates kept).

    With ``rules.start_cutoff`` only promotions starting on or after it.
    """
    promo = live(t.promo).drop("delete_date")
    if rules is not None and rules.start_cutoff is not None:
        promo = promo.where(F.col("start_date") >= F.lit(rules.start_cutoff))
    lnk = live(t.lnk).drop("delete_date")
    return lnk.join(promo, "id_promotion").select(*PAIR_KEYS)


def window_start(windows: str) -> F.Column:
    return X.control_start() if windows == "both" else F.col("start_date")


def day_bucket(day) -> F.Column:
    return F.shiftright(F.unix_date(X.col(day)), BUCKET_BITS)


@dataclass
class PromoScope:
    """The pairs of one report and what they allow its other inputs to skip.

    pairs    the pair table (duplicate links kept)
    sku      (id_sku, id_common_sku, sku_live) of the pairs' common SKUs
    windows  "both" (promo and control) or "promo"
    distinct whether a sale counts once per distinct pair (the legacy report) or once per link
    exc_keys the exception list as one row per (client, TIN, common SKU) with
             merged intervals inside the bounds, restricted to the pairs'
             clients and common SKUs

    ``pairs`` and ``sku`` are stored once when the scope is built, so promotions,
    links and SKUs are scanned once however often a report needs them. All else
    is lazy: nothing is collected, counted or kept between reports; how the
    sides are joined is left to Spark, which broadcasts by measured size and
    splits skewed shuffles.
    """

    pairs: DataFrame
    sku: DataFrame
    windows: str
    distinct: bool = False
    exc_keys: DataFrame | None = None

    def valid(self) -> DataFrame:
        """Pairs whose window is not empty, each once if the scope is distinct, with ``window_start``."""
        pairs = self.pairs.distinct() if self.distinct else self.pairs
        return (pairs.where(F.col("end_date") >= F.col("start_date"))
                .withColumn("window_start", window_start(self.windows)))

    def bound(self, which: str) -> F.Column:
        """The earliest window start ("lo") or latest end ("hi") as a scalar
        subquery: found when the report runs, before the scans it filters.
        NULL, so that no row passes, when no pair has a window.

        The two are written differently on purpose: Spark merges alike
        subqueries into one struct, whose fields do not reach the Parquet reader.
        """
        valid = self.pairs.where(F.col("end_date") >= F.col("start_date"))
        if which == "lo":
            return valid.agg(F.min(window_start(self.windows))).scalar()
        return valid.select("end_date").orderBy(F.col("end_date").desc()).limit(1).scalar()

    def unfolded(self) -> DataFrame:
        """``valid`` pairs, once per (year, day bucket) that their window touches."""
        width = 1 << BUCKET_BITS
        first_day = F.greatest("window_start", F.date_from_unix_date((F.col("bucket") * width).cast("int")))
        last_day = F.least("end_date", F.date_from_unix_date((F.col("bucket") * width + (width - 1)).cast("int")))
        return (self.valid()
                .select("*", F.explode(F.sequence(day_bucket("window_start"), day_bucket("end_date"))).alias("bucket"))
                .select("*", F.explode(F.sequence(F.year(first_day), F.year(last_day))).alias("op_year")))

    def restrict(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows of ``df`` whose ``keys`` occur in the pairs."""
        return df.join(self.pairs.select(*keys), list(keys), "left_semi")


def promo_scope(t: PromoTables, rules: PromoRules, windows: str = "both", exceptions: bool = False,
                distinct: bool = False) -> PromoScope:
    """Store the report's pairs and their SKUs, and build the scope on them."""
    from packlift.operators.exceptions import exceptions_common_sku, merged_intervals

    pairs = promo_pairs(t, rules)
    if rules.clients is not None:      # no other client's sale is read
        pairs = pairs.where(F.col("id_client").isin(list(rules.clients)))
    pairs = shared_table(pairs, "pairs")
    sku = shared_table(t.sku.select("id_sku", "id_common_sku", F.col("delete_date").isNull().alias("sku_live"))
                       .join(pairs.select("id_common_sku"), "id_common_sku", "left_semi"), "sku")
    scope = PromoScope(pairs, sku, windows, distinct)
    if exceptions:
        exc = scope.restrict(exceptions_common_sku(t.exc, sku), "id_client", "id_common_sku")
        scope.exc_keys = merged_intervals(exc, scope.bound("lo"), scope.bound("hi"))
    return scope
