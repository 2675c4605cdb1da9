"""Reusable DataFrame operators: promo pairs and scope, the window join, exception policies, measures, lookups, sinks."""
