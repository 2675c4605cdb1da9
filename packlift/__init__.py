"""packlift: "buy N, get X free" promotion analytics as Spark DataFrame jobs.

Layout
------
``sources``    read and normalise the input tables (warehouse layout or the
               TPC-H-derived test tables), live-row filters, pruning bounds.
``functions``  column expressions: multiple, windows, quantity rules, packs.
``operators``  reusable DataFrame operators: promo pairs, the one-pass window
               tagging join, exception policies, two-stage aggregates, lookups,
               sinks.
``plans``      the reports built from the operators: the promo report, the
               legacy report, qualifying sales, reconciliation, presentation,
               and the view stack.
``checks``     the DuckDB oracle SQL used by the correctness gate.
"""

from packlift.rules import CONDITION_RULES, LEGACY_RULES, REPORT_RULES, PromoRules

__all__ = ["PromoRules", "REPORT_RULES", "LEGACY_RULES", "CONDITION_RULES"]
