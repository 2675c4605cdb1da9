"""Explicit schemas of the input tables (no inference at read)."""

from pyspark.sql import types as T

D = T.DateType()
I = T.IntegerType()
L = T.LongType()
S = T.StringType()
QTY = T.DecimalType(18, 3)
MONEY = T.DecimalType(18, 2)


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SALE = _s(("id_sku", L, False), ("id_client", I, False), ("tin_buyer", L, True),
          ("operation_date", D, False), ("quantity", QTY, False),
          ("id_operation_type", I, False), ("delete_date", D, False))
SKU = _s(("id_sku", L, False), ("id_common_sku", I, False), ("delete_date", D, True))
COMMON_SKU = _s(("id_common_sku", I, False), ("common_sku_name", S, False), ("delete_date", D, True))
PROMO = _s(("id_promotion", I, False), ("id_promotion_type", I, False), ("id_client", I, False),
           ("start_date", D, False), ("end_date", D, False), ("delete_date", D, True))
LNK = _s(("id_promotion", I, False), ("id_common_sku", I, False), ("delete_date", D, True))
EXC = _s(("id_client", I, False), ("id_sku", L, False), ("tin_buyer", L, True),
         ("start_date", D, False), ("end_date", D, False))
PRICE = _s(("id_client", I, False), ("id_sku", L, False), ("sale_date", D, False),
           ("bonus", MONEY, False), ("delete_date", D, True))
RESULT = _s(("id_sku", L, False), ("id_client", I, False), ("tin_buyer", L, False),
            ("start_date", D, False), ("end_date", D, False), ("multiple", I, False),
            ("bonus", MONEY, False), ("quantity", QTY, False))
CLIENT = _s(("id_client", I, False), ("client_name", S, False), ("delete_date", D, True),
            ("valid_from", D, False), ("valid_to", D, False))
PROMO_TYPE = _s(("id_promotion_type", I, False), ("promotion_type_name", S, False))
ENTITY = _s(("id_legal_entity", L, False), ("legal_entity_name", S, False), ("delete_date", D, True))

TABLES = {
    "sale": SALE, "sku": SKU, "common_sku": COMMON_SKU, "promo": PROMO, "lnk": LNK, "exc": EXC,
    "price": PRICE, "result": RESULT, "client": CLIENT, "promo_type": PROMO_TYPE, "entity": ENTITY,
}
