"""Hand-made input tables for scenario tests.

Base set: client 16, promotion 1 of type 1 (multiple 3) on common SKU 1
(SKUs 10 and 11), promo window 2024-01-11 .. 2024-01-21, so the control
window is 2024-01-01 .. 2024-01-10; bonus 5.00 on SKU 10 from the start date.
Scenarios add or replace rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from packlift import schemas
from packlift.sources.tables import PromoTables

LIVE = date(2000, 1, 1)
GONE = date(2024, 3, 1)
START, END = date(2024, 1, 11), date(2024, 1, 21)
AS_OF = date(2024, 6, 30)


def d(s: str) -> date:
    return date.fromisoformat(s)


def q(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.001"))


def m(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


@dataclass
class Rows:
    sale: list = field(default_factory=list)
    sku: list = field(default_factory=lambda: [(10, 1, None), (11, 1, None), (20, 2, None)])
    common_sku: list = field(default_factory=lambda: [(1, "Aspirin", None), (2, "Brufen", None)])
    promo: list = field(default_factory=lambda: [(1, 1, 16, START, END, None)])
    lnk: list = field(default_factory=lambda: [(1, 1, None)])
    exc: list = field(default_factory=list)
    price: list = field(default_factory=lambda: [(16, 10, START, m(5), None)])
    result: list = field(default_factory=list)
    client: list = field(default_factory=lambda: [
        (16, "Pharma One", None, d("2021-01-01"), d("9999-12-31")),
        (28, "Pharma Two", None, d("2021-01-01"), d("9999-12-31")),
        (35, "Pharma Three", None, d("2021-01-01"), d("9999-12-31")),
        (36, "Pharma Four", None, d("2021-01-01"), d("9999-12-31")),
        (37, "Pharma Five", None, d("2021-01-01"), d("9999-12-31")),
    ])
    promo_type: list = field(default_factory=lambda: [(0, "1+1"), (1, "2+1"), (2, "3+1"), (3, "4+1")])
    entity: list = field(default_factory=lambda: [(7700000001, "Buyer One LLC", None)])

    def sell(self, tin, day, qty, sku=10, client=16, op=4, deleted=False):
        self.sale.append((sku, client, tin, d(day) if isinstance(day, str) else day, q(qty), op,
                          GONE if deleted else LIVE))
        return self

    def tables(self, spark) -> PromoTables:
        out = {}
        for name, schema in schemas.TABLES.items():
            out[name] = spark.createDataFrame(getattr(self, name), schema)
        return PromoTables(**out)


TIN_A, TIN_B, TIN_C = 7700000001, 7700000002, 7700000003
