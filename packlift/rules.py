"""Business rules kept as data.

One ``PromoRules`` per report. The fixed values below must equal the ones the
reports were defined with; everything else in the library reads them from a
``PromoRules`` instance instead of hard-coding them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as stated for the reports to be right)
# ---------------------------------------------------------------------------
# Operation type of a sale in the sales fact.
SALE_OPERATION_TYPE = 4
# Live-row sentinel of the sales fact's delete_date (other tables use NULL).
LIVE_SENTINEL = date(2000, 1, 1)
# multiple = id_promotion_type + MULTIPLE_OFFSET (type 0 is "1+1").
MULTIPLE_OFFSET = 2
# Clients whose sales count only in whole multiples of the promo multiple;
# every other client counts sales whose quantity reaches the multiple.
WHOLE_MULTIPLE_CLIENTS = (36, 37)
# Client whitelist of the promo report.
REPORT_CLIENTS = (16, 28, 35, 36, 37, 418)
# Client whitelist of the qualifying-sales view and its reconciliations.
CONDITION_CLIENTS = (16, 35, 36, 37)
# Promo start cut-off of the legacy report.
LEGACY_START_CUTOFF = date(2023, 11, 1)
# Promotion types the legacy report knows a rule for; other types never qualify.
LEGACY_RULE_TYPES = (0, 1, 2)
# Default legal-entity name for buyers without one ("single pharmacies").
DEFAULT_ENTITY_NAME = "Одиночные аптеки"
# ---------------------------------------------------------------------------

# Exception policies (see operators/exceptions.py).
POLICY_SALE_DATE_OR_ANY_IN_CONTROL = "sale_date_or_any_in_control"
POLICY_SALE_DATE = "sale_date"
POLICY_PROMO_START = "promo_start"


@dataclass(frozen=True)
class PromoRules:
    """Parameters of one report.

    clients            client whitelist on the sales fact, ``None`` = all clients
    whole_multiple_clients  clients counted in whole multiples only
    sale_operation_type     operation type of a sale
    live_sentinel      live value of the sales fact's delete_date
    start_cutoff       keep promos starting on or after this date, ``None`` = all
    exception_policy   one of the POLICY_* names
    rule_types         promo types with a quantity rule, ``None`` = every type
    totals_sale_only   totals count sales only (True) or every operation type
    positive_only      drop rows whose quantity is not positive
    multiple_offset    multiple = type + offset
    """

    clients: tuple[int, ...] | None = REPORT_CLIENTS
    whole_multiple_clients: tuple[int, ...] = WHOLE_MULTIPLE_CLIENTS
    sale_operation_type: int = SALE_OPERATION_TYPE
    live_sentinel: date = LIVE_SENTINEL
    start_cutoff: date | None = None
    exception_policy: str = POLICY_SALE_DATE_OR_ANY_IN_CONTROL
    rule_types: tuple[int, ...] | None = None
    totals_sale_only: bool = False
    positive_only: bool = False
    multiple_offset: int = MULTIPLE_OFFSET

    def with_(self, **changes) -> PromoRules:
        return replace(self, **changes)


# The optimized promo report.
REPORT_RULES = PromoRules()

# The legacy promo report: all clients, promos from the cut-off, exceptions by
# promo start, rules for types 0-2 only, totals of sales only.
LEGACY_RULES = PromoRules(
    clients=None,
    start_cutoff=LEGACY_START_CUTOFF,
    exception_policy=POLICY_PROMO_START,
    rule_types=LEGACY_RULE_TYPES,
    totals_sale_only=True,
)

# The qualifying-sales view: its own whitelist, exceptions by sale date,
# positive quantities only.
CONDITION_RULES = PromoRules(
    clients=CONDITION_CLIENTS,
    exception_policy=POLICY_SALE_DATE,
    positive_only=True,
)
